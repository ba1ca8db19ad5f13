"""Long series read in slices by many tasks, with the result of one reading from end to end.

What a change-of-value filter does in a slice depends on the last row kept before it, its entry. Whatever that was, the
first row of the slice that goes out is one of a few: values that lie near one entry lie in one interval, so it sets a new
largest or smallest value of the slice, or it comes within a heartbeat of the slice's first. From each such row
on the filter's course is known, and courses soon meet. So a slice is summed up by these rows and by where each course ends; the
summaries of a series are walked through in order, which gives each slice its true entry; and then all slices are read at once.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType


def passing(last: float, last_us: int, v: np.ndarray, us: np.ndarray, limit: np.ndarray, exact: np.ndarray, kind: str, heartbeat_us: int | None) -> np.ndarray:
    """change.passes for many readings against one that went out."""
    text = v.dtype == object
    nan, was = (np.zeros(len(v), bool), False) if text else (np.isnan(v), last != last)
    differs = ~((v == last) | (nan & was))
    if text:
        out = differs
    else:
        with np.errstate(invalid="ignore"):
            moved = np.abs(v - last) / max(abs(last), 1e-6) > limit if kind == "relative" else np.abs(v - last) >= limit
        out = np.where(exact | nan | was, differs, moved)
    return out if heartbeat_us is None else out | (us - last_us >= heartbeat_us)


class Course:
    """The readings of a slice, in order of time."""

    def __init__(self, v: np.ndarray, us: np.ndarray, limit: np.ndarray, exact: np.ndarray, kind: str, heartbeat_us: int | None):
        self.v, self.us, self.limit, self.exact, self.kind, self.heartbeat_us = v, us, limit, exact, kind, heartbeat_us

    def next(self, last: float, last_us: int, at: int) -> int:
        """The first reading from at on that goes out after one that did; the number of readings if none does."""
        step = 16
        while at < len(self.v):
            cut = slice(at, at + step)
            hit = passing(last, last_us, self.v[cut], self.us[cut], self.limit[cut], self.exact[cut], self.kind, self.heartbeat_us)
            if hit.any():
                return at + int(hit.argmax())
            at, step = at + step, min(2 * step, 1 << 14)
        return len(self.v)

    def firsts(self) -> np.ndarray:
        """Places of all readings that are the first to go out after some entry."""
        n = len(self.v)
        if self.v.dtype == object or self.exact.all():
            records = np.array([0, self.next(self.v[0], self.us[0], 1) if self.heartbeat_us is None else next_other(self.v)])
        elif (self.limit == self.limit[0]).all() and not self.exact.any():
            nan = np.isnan(self.v)
            low, high = np.where(nan, np.inf, self.v), np.where(nan, -np.inf, self.v)
            new = (low < np.concatenate([[np.inf], np.minimum.accumulate(low)[:-1]])) | (high > np.concatenate([[-np.inf], np.maximum.accumulate(high)[:-1]]))
            first_nan = int(nan.argmax()) if nan.any() else n
            records = np.flatnonzero(new & (np.arange(n) < first_nan))
            records = np.concatenate([records, [first_nan], [int((~nan).argmax())] if nan[0] and not nan.all() else []]).astype(np.int64)
        else:
            records = np.arange(n)
        if self.heartbeat_us is not None:
            beat = int(np.searchsorted(self.us, self.us[0] + self.heartbeat_us))  # goes out after any entry
            records = np.concatenate([records, np.arange(min(beat + 1, n))])
            records = records[records <= beat]
        records = np.unique(np.concatenate([[0], records]))
        return records[records < n]

    def ends(self, starts: np.ndarray) -> np.ndarray:
        """For each start, taken as gone out, the place of the last reading that does."""
        end: dict[int, int] = {}
        for start in starts[::-1].tolist():
            way, at = [], start
            while at not in end:
                way.append(at)
                on = self.next(self.v[at], self.us[at], at + 1)
                if on == len(self.v):
                    end[at] = at
                    break
                at = on
            for place in way:
                end[place] = end[at]
        return np.array([end[s] for s in starts.tolist()], np.int64)


def next_other(v: np.ndarray) -> int:
    """The first value that is not the first one, NaN being one value."""
    same = (v == v[0]) | ((v != v) & (v[0] != v[0]))
    return len(v) if same.all() else int((~same).argmax())


def long_series(rows: DataFrame, keys: Sequence[str], us: str, slice_rows: int) -> DataFrame:
    """rows with _slice: the number of its slice for a row of a series of more than slice_rows rows, else null. Slices of a
    series are equally long in time and have slice_rows rows in the mean."""
    per = rows.groupBy(*keys).agg(F.count("*").alias("_rows"), F.min(us).alias("_from"), F.max(us).alias("_to")).where(F.col("_rows") > slice_rows)
    width = F.expr(f"(_to - _from) div ((_rows + {slice_rows} - 1) div {slice_rows}) + 1")
    per = per.select(*[F.col(k).alias(f"_of_{k}") for k in keys], "_from", width.alias("_width"))
    same = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys]
    out = rows.join(F.broadcast(per), same, "left")  # at most one for each slice_rows rows of the table
    return out.withColumn("_slice", F.expr(f"({us} - _from) div _width")).drop("_from", "_width", *[f"_of_{k}" for k in keys])


def entries(sliced: DataFrame, keys: Sequence[str], us: str, order: Sequence[str], kind: str, heartbeat_us: int | None) -> DataFrame:
    """(_key columns, _slice, _entry, _entry_us) of each slice of the long series in sliced (_value, _limit, _exact, _slice): the last
    reading that goes out before it, null for the first slice."""
    is_text = dict(sliced.dtypes)["_value"] == "string"
    kind_of = "string" if is_text else "double"
    names = [f"_key{k}" for k in range(len(keys))]
    rows = sliced.where("_slice is not null").select(*[F.col(k).alias(n) for k, n in zip(keys, names)], "_slice", us, *[c for c in order if c != us], "_value", "_limit", "_exact")
    types = dict(rows.dtypes)
    key_types = ", ".join(f"{n} {types[n]}" for n in names)

    def describe(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([us, *[c for c in order if c != us]], kind="stable")
        course = Course(pdf["_value"].to_numpy(object if is_text else float), pdf[us].to_numpy(), pdf["_limit"].to_numpy(float), pdf["_exact"].to_numpy(bool), kind, heartbeat_us)
        first = course.firsts()
        end = course.ends(first)
        one = pdf[[*names, "_slice"]].iloc[:1].copy()
        for name, x in (("v", course.v[first]), ("us", course.us[first]), ("limit", course.limit[first]), ("exact", course.exact[first]), ("end_v", course.v[end]), ("end_us", course.us[end])):
            one[name] = [list(x)]
        return one

    fields = f"{key_types}, _slice long, v array<{kind_of}>, us array<long>, limit array<double>, exact array<boolean>, end_v array<{kind_of}>, end_us array<long>"
    summaries = rows.groupBy(*names, "_slice").applyInPandas(describe, fields)

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_slice")
        last, last_us, out = None, None, []
        array = lambda x: np.array(list(x), object if is_text else float)
        for r in pdf.itertuples(index=False):
            out.append((last, last_us))
            v, end = array(r.v), 0
            if last_us is not None:
                hit = passing(last, last_us, v, np.array(r.us), np.array(r.limit), np.array(r.exact, bool), kind, heartbeat_us)
                end = int(hit.argmax()) if hit.any() else None
            if end is not None:
                last, last_us = r.end_v[end], int(r.end_us[end])
        got = pdf[[*names, "_slice"]].reset_index(drop=True)
        got["_entry"] = pd.Series([x for x, _ in out], dtype=object)
        got["_entry_us"] = pd.Series([t for _, t in out], dtype="Int64")
        return got

    return summaries.groupBy(*names).applyInPandas(walk, f"{key_types}, _slice long, _entry {kind_of}, _entry_us long")


def with_entries(sliced: DataFrame, keys: Sequence[str], found: DataFrame) -> DataFrame:
    """sliced with _entry and _entry_us of each row's slice."""
    found = found.withColumnRenamed("_slice", "_of_slice")
    same: list[Column] = [F.col(k).eqNullSafe(F.col(f"_key{n}")) for n, k in enumerate(keys)]
    out = sliced.join(F.broadcast(found), [*same, F.col("_slice") == F.col("_of_slice")], "left")  # as few as slices
    return out.drop("_of_slice", *[f"_key{n}" for n in range(len(keys))])


def moving_average(df: DataFrame, keys: Sequence[str], us: str, value: str, alpha: float = 0.2, order: Sequence[str] = (), slice_rows: int = 500_000) -> DataFrame:
    """df with ema: alpha * value + (1 - alpha) * the ema before, which starts at the series' first value.

    A step is an affine map of what was before, and so is a row of steps: a slice is a factor and an offset, known without
    its entry. Slices are read by as many tasks, each from 0; their maps are composed in order, which is a row for
    each slice; and a row's ema is its own, and its entry times the factor up to it. Rows without a time or value
    have none and change nothing; rows of a series need a total order by us and order."""
    rows = df.withColumn("_value", F.when(F.col(us).isNotNull(), F.col(value).cast("double")))
    live = rows.where("_value is not null")
    per = live.groupBy(*keys).agg(F.count("*").alias("_rows"), F.min(us).alias("_from"), F.max(us).alias("_to"))
    width = F.expr(f"(_to - _from) div ((_rows + {slice_rows} - 1) div {slice_rows}) + 1")
    per = per.where(F.col("_rows") > slice_rows).select(*[F.col(k).alias(f"_of_{k}") for k in keys], "_from", width.alias("_width"))
    same = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys]
    live = live.join(F.broadcast(per), same, "left").withColumn("_slice", F.coalesce(F.expr(f"({us} - _from) div _width"), F.lit(0).cast("long")))
    live = live.drop("_from", "_width", *[f"_of_{k}" for k in keys])
    names = [f"_key{n}" for n in range(len(keys))]
    fields = live.schema
    sort = [*keys, "_slice", us, *[c for c in order if c != us]]
    stay = 1.0 - alpha

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """_own: the ema from an entry of 0, and _factor: what an entry is multiplied by, after each row."""
        now, own, factor = None, 0.0, 1.0
        for pdf in batches:
            owns, factors = [], []
            marks = zip(*[pdf[c].astype(object).where(pdf[c].notna(), None) for c in [*keys, "_slice"]], strict=True)
            for key, v in zip(marks, pdf["_value"], strict=True):
                if key != now:
                    now, own, factor = key, 0.0, 1.0
                own, factor = stay * own + alpha * v, stay * factor
                owns.append(own)
                factors.append(factor)
            yield pdf.assign(_own=owns, _factor=factors)

    added = StructType([*fields.fields, StructField("_own", DoubleType()), StructField("_factor", DoubleType())])
    told = live.repartition(*keys, "_slice").sortWithinPartitions(*sort).mapInPandas(read, added)
    order_of = F.struct(us, *[c for c in order if c != us])
    ends = told.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.col("_slice").alias("_of_slice")).agg(
        F.max_by(F.struct("_own", "_factor"), order_of).alias("last"), F.min_by("_value", order_of).alias("first")
    )

    def compose(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_of_slice")
        now, entry = float(pdf["first"].iloc[0]), []  # as if the first value had been the average before it
        for end in pdf["last"]:
            entry.append(now)
            now = end["_own"] + end["_factor"] * now
        return pdf[[*names, "_of_slice"]].assign(_entry=entry)

    types = dict(ends.dtypes)
    entry = ends.groupBy(*names).applyInPandas(compose, ", ".join(f"{n} {types[n]}" for n in names) + ", _of_slice long, _entry double")
    at = [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names)]
    told = told.join(entry, [*at, F.col("_slice") == F.col("_of_slice")])
    out = told.select(*df.columns, (F.col("_own") + F.col("_factor") * F.col("_entry")).alias("ema"))
    return out.unionByName(rows.where("_value is null").select(*df.columns, F.lit(None).cast("double").alias("ema")))
