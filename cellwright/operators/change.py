"""Change-of-value filters, null-fill, window coalescing, runs."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import repeat

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.parse import glob_regex
from . import slices
from .query import ordering

DAY_US = 86_400_000_000


def cov_exact(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str], nan_equal: bool = False) -> DataFrame:
    """Rows of which some of cols differs from the key's row before; the first stays. A null differs
    from a value and, unless nan_equal, from another null."""
    w = Window.partitionBy(*keys).orderBy(*order)
    first = F.row_number().over(w) == 1
    same = F.lit(True)
    for c in cols:
        before = F.lag(c).over(w)
        same = same & (before.eqNullSafe(F.col(c)) if nan_equal else F.coalesce(before == F.col(c), F.lit(False)))
    return df.withColumn("_keep", first | ~same).where("_keep").drop("_keep")


def threshold(name: str, rules: Sequence[tuple[str, float]], default: float) -> Column:
    """The value of the first rule (glob, value) whose glob the name matches."""
    out = F.lit(float(default))
    for glob, value in reversed(rules):
        out = F.when(F.col(name).rlike(glob_regex(glob)), F.lit(float(value))).otherwise(out)
    return out


def passes(last: float | str | None, last_us: int, value: float | str, us: int, limit: float, kind: str, exact: bool, heartbeat_us: int | None) -> bool:
    """Whether a reading goes out, given the last one that did: the step of cov and of its stream form.
    NaN equals NaN; a change from or to NaN is a change."""
    if last is None:
        return True
    if heartbeat_us is not None and us - last_us >= heartbeat_us:
        return True
    if exact or value != value or last != last:
        return not (value == last or (value != value and last != last))
    if kind == "relative":
        return abs(value - last) / max(abs(last), 1e-6) > limit
    return abs(value - last) >= limit


def cov(df: DataFrame, keys: Sequence[str], us: str, value: str, rules: Sequence[tuple[str, float]] = (), default: float = 0.5, kind: str = "absolute", heartbeat_us: int | None = None, name: str | None = None, exact: Column | None = None, day_cut: bool = False, order: Sequence[str] = (), slice_rows: int | None = None) -> DataFrame:
    """Rows that differ enough from the last row of their key that was kept.

    kind "absolute": by at least the threshold; "relative": by more than that share of the last value.
    The threshold is that of the first rule whose glob matches column name (by default the last key).
    exact: where true, any change counts, as it does for strings. With heartbeat_us a row that long after the last kept one
    stays too. Nulls are left out. Rows of a key are sorted by us and order and read one after the
    other, so a key is one task's work. With slice_rows, keys of more rows are read in slices of about that many by
    as many tasks, with the same result (see slices; order must then be total). With day_cut each day of a key is its own
    series (and its first row is kept)."""
    name = name or keys[-1]
    limit = threshold(name, rules, default)
    rows = df.where(F.col(value).isNotNull() & F.col(us).isNotNull())
    text = dict(df.dtypes)[value] == "string"
    extra = {"_limit": limit, "_exact": F.lit(True) if text else exact if exact is not None else F.lit(False), "_value": F.col(value) if text else F.col(value).cast("double")}
    if day_cut:
        extra["_day"] = F.floor(F.col(us) / DAY_US)
    rows = rows.withColumns(extra)
    group = [*keys, *(["_day"] if day_cut else [])]
    sliced = slice_rows is not None
    if sliced:
        rows = slices.long_series(rows, group, us, slice_rows)
        rows = slices.with_entries(rows, group, slices.entries(rows, group, us, order, kind, heartbeat_us))
        group = [*group, "_slice"]
    fields = df.schema

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, last, last_us = None, None, None
        for pdf in batches:
            keep = []
            marks = list(zip(*[pdf[g].astype(object).where(pdf[g].notna(), None) for g in group], strict=True))
            entry = zip(pdf["_entry"].astype(object).where(pdf["_entry_us"].notna(), None), pdf["_entry_us"]) if sliced else repeat((None, None), len(pdf))
            for key, v, t, e, x, first in zip(marks, pdf["_value"], pdf[us], pdf["_limit"], pdf["_exact"], entry, strict=True):
                if key != now:
                    now, (last, last_us) = key, first
                ok = passes(last, last_us, v, t, e, kind, x, heartbeat_us)
                if ok:
                    last, last_us = v, t
                keep.append(ok)
            yield pdf.loc[keep, fields.fieldNames()]

    # one sort and one pass over each partition: no key's rows are gathered in memory
    return rows.repartition(*group).sortWithinPartitions(*group, us, *order).mapInPandas(run, fields)


def cov_sample_count(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """A row for each run of equal values: first and last place in order, and how many rows it stands for."""
    return run_encode(df, keys, order, value)


def run_encode(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """keys, value, begin, end (of the first order column) and length of each run of equal values;
    nulls are equal."""
    w = Window.partitionBy(*keys).orderBy(*order)
    fresh = F.when(F.row_number().over(w) == 1, 1).when(F.lag(value).over(w).eqNullSafe(F.col(value)), 0).otherwise(1)
    runs = df.withColumn("_fresh", fresh).withColumn("_run", F.sum("_fresh").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy(*keys, "_run").agg(F.first(value).alias(value), F.min(order[0]).alias("begin"), F.max(order[0]).alias("end"), F.count("*").alias("length")).drop("_run")


def null_fill(df: DataFrame, keys: Sequence[str], us: str, cols: Sequence[str], pct: float = 0.0, rules: Sequence[tuple[str, float]] = (), reset_s: int | None = 3_600, order: Sequence[str] = ()) -> DataFrame:
    """Wide rows with values set to null that do not differ from the column's last value written.

    State is kept by key and day of the event, and starts anew every reset_s seconds of the day. With
    pct 0 and no rules "differs" means unequal, and windows do it; else a value differs if it moved by
    more than that share of the last one written, the share being that of the first rule whose glob
    matches the column."""
    slot = F.floor(F.col(us) / DAY_US) if reset_s is None else F.floor(F.col(us) / (reset_s * 1_000_000))
    group = [*keys, "_slot"]
    rows = df.withColumn("_slot", slot)
    if not pct and not rules:
        w = Window.partitionBy(*group).orderBy(us, *order).rowsBetween(Window.unboundedPreceding, -1)
        before = {c: F.last(c, ignorenulls=True).over(w) for c in cols}
        return rows.withColumns({c: F.when(~F.coalesce(before[c] == F.col(c), F.lit(False)), F.col(c)) for c in cols}).drop("_slot")
    import re

    share = {c: next((s for g, s in rules if re.match(glob_regex(g), c)), pct) for c in cols}
    fields = df.schema

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, last = None, {}
        for pdf in batches:
            marks = list(zip(*[pdf[g] for g in group], strict=True))
            new = {c: pdf[c].astype(object).to_list() for c in cols}
            for i, key in enumerate(marks):
                if key != now:
                    now, last = key, {}
                for c in cols:
                    v = new[c][i]
                    if v is None or v != v:
                        continue
                    if passes(last.get(c), 0, v, 0, share[c], "relative", share[c] == 0, None):
                        last[c] = v
                    else:
                        new[c][i] = None
            yield pdf.assign(**new)[fields.fieldNames()]

    return rows.repartition(*group).sortWithinPartitions(*group, us, *order).mapInPandas(run, fields)


def coalesce_window(df: DataFrame, keys: Sequence[str], us: str, width_ms: int, order: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Messages of a key within one window of event time in one row: us is the window's first time over
    all its keys but the last one (the topic), cols those of the largest order."""
    slot = F.floor(F.col(us) / (width_ms * 1_000))
    at = ordering(df, order, nulls_first=True)
    one = df.groupBy(*keys, slot.alias("_slot")).agg(F.min(us).alias("_first"), *[F.max_by(F.col(f"`{c}`"), at).alias(c) for c in cols])
    w = Window.partitionBy(*keys[:-1], "_slot")
    return one.withColumn("_at", F.min("_first").over(w)).select(*keys, F.col("_at").alias(us), *[F.col(f"`{c}`") for c in cols])
