"""Range and tag filters, latest values, buckets, histories."""

from __future__ import annotations

import fnmatch
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.time import bucket_start

_UNITS = {"ms": 1_000, "s": 1_000_000, "m": 60_000_000, "h": 3_600_000_000, "d": 86_400_000_000}


def period_us(period: str) -> int:
    """Microseconds of a duration like 30s, -1h, 5m, 2d."""
    m = re.fullmatch(r"-?(\d+)(ms|s|m|h|d)", period)
    if not m:
        raise ValueError(f"not a duration: {period}")
    return int(m[1]) * _UNITS[m[2]]


def in_range(df: DataFrame, us: str, t0: int, t1: int, closed: str = "both") -> DataFrame:
    """Rows with t0 <= us <= t1, or < t1 with closed="left"; null times match nothing."""
    c = F.col(us)
    return df.where((c >= t0) & ((c <= t1) if closed == "both" else (c < t1)))


def last_period(df: DataFrame, us: str, period: str = "-1h", as_of: int | None = None) -> DataFrame:
    """Rows of the period that ends at as_of, by default at the latest time in df."""
    length = period_us(period)
    if as_of is not None:
        return df.where((F.col(us) >= as_of - length) & (F.col(us) <= as_of))
    end = df.agg(F.max(us).alias("_end"))
    return df.crossJoin(F.broadcast(end)).where(F.col(us) >= F.col("_end") - length).drop("_end")


def with_tags(df: DataFrame, tags: dict[str, object], prefix: str = "") -> DataFrame:
    """Rows whose columns equal the tags, compared as text; nulls match nothing."""
    for name, value in tags.items():
        df = df.where(F.col(name).cast("string") == F.lit(prefix + str(value)))
    return df


def select_glob(df: DataFrame, include: Sequence[str], exclude: Sequence[str] = ()) -> DataFrame:
    """The columns that a pattern of include matches and none of exclude, in order."""
    hit = lambda c, globs: any(fnmatch.fnmatchcase(c, g) for g in globs)
    return df.select(*[F.col(f"`{c}`") for c in df.columns if hit(c, include) and not hit(c, exclude)])


#: Types whose values have one width, so that aggregates of them are hashed.
_FIXED = ("bigint", "int", "smallint", "tinyint", "double", "float", "boolean", "date", "timestamp", "timestamp_ntz")


def latest(df: DataFrame, keys: Sequence[str], ts: str, cols: Sequence[str] | None = None, per_column: bool = False, order: Sequence[str] = (), words: int = 1 << 14) -> DataFrame:
    """One row for each key: that of the largest ts, of equal ones of the largest order columns, nulls before all values. With
    per_column each column has its latest value that is not null, which may be of different rows.

    Where ts with at most one order column are whole numbers and all columns are of fixed width, one hashed aggregation finds
    them. Else the largest times are found by hashing, for each column if asked for. They make a bit filter of 64 * words
    bits, by which a second scan keeps the rows that may have one: these alone are shuffled and ordered. A row that
    passes by chance loses to its key's true one, so any size gives the same rows; with many more keys than 4 * words more pass."""
    cols, kinds = [c for c in (cols or df.columns) if c not in keys], dict(df.dtypes)
    exists = lambda c: F.col(f"`{c}`").isNotNull()
    if len(order) < 2 and all(kinds[c] in _WHOLE for c in (ts, *order)) and all(kinds[c] in _FIXED for c in cols):
        at = ordering(df, [ts, *order], nulls_first=True)
        return df.groupBy(*keys).agg(*[F.max_by(F.col(f"`{c}`"), F.when(exists(c), at) if per_column else at).alias(c) for c in cols])
    marks = cols if per_column else [None]
    none = ~F.coalesce(*[F.when(exists(c), True) for c in cols], F.lit(False)) if per_column else F.lit(False)
    named = lambda k, t: F.xxhash64(F.lit(k), F.col(t), *keys)
    tops = df.groupBy(*keys).agg(
        F.max(ts).alias("_top"), F.bool_and(none).alias("_none"), *[F.max(F.when(exists(c), F.col(ts)) if c else F.col(ts)).alias(f"_top{k}") for k, c in enumerate(marks)]
    )
    hashes = [named(k, f"_top{k}") for k in range(len(marks))] + ([F.when(F.col("_none"), named(-1, "_top"))] if per_column else [])
    seen = bit_filter(tops.select(F.explode(F.array(*hashes)).alias("h")).where("h is not null"), words)
    hit = none & in_filter(named(-1, ts), F.col("_seen"), words)
    for k, c in enumerate(marks):
        maybe = in_filter(named(k, ts), F.col("_seen"), words)
        hit = hit | (exists(c) & maybe if c else maybe)
    rows = df.crossJoin(F.broadcast(seen.withColumnRenamed("bits", "_seen"))).where(hit).drop("_seen")  # one row of fixed size
    by = Window.partitionBy(*keys).orderBy(*[F.desc_nulls_last(c) for c in (ts, *order)])
    rows = rows.withColumn("_nth", F.row_number().over(by))
    if per_column:
        whole = by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        rows = rows.withColumns({c: F.first(F.col(f"`{c}`"), ignorenulls=True).over(whole) for c in cols})
    return rows.where("_nth = 1").select(*keys, *[F.col(f"`{c}`") for c in cols])


def bit_filter(hashes: DataFrame, words: int) -> DataFrame:
    """One row, an array of words whole numbers: in one of them, three bits are set for each hash in column h."""
    bits = hashes.select(*[c.alias(n) for c, n in zip(_place(F.col("h"), words), ("word", "bits"))])
    bits = bits.union(hashes.sparkSession.range(words).select("id", F.lit(0).cast("long")))
    bits = bits.groupBy("word").agg(F.bit_or("bits").alias("bits"))
    return bits.agg(F.transform(F.array_sort(F.collect_list(F.struct("word", "bits"))), lambda x: x["bits"]).alias("bits"))


def _place(h: Column, words: int) -> tuple[Column, Column]:
    """The word of a hash and its bits, of other parts of the hash."""
    bit = lambda by: F.call_function("shiftleft", F.lit(1).cast("long"), (F.shiftrightunsigned(h, by) % 64).cast("int"))
    return F.pmod(h, F.lit(words)).cast("long"), bit(40).bitwiseOR(bit(46)).bitwiseOR(bit(52))


def in_filter(h: Column, filtered: Column, words: int) -> Column:
    """Whether a hash may be one of those that the filter was made of."""
    word, bits = _place(h, words)
    return F.get(filtered, word.cast("int")).bitwiseAND(bits) == bits


_WHOLE = ("bigint", "int", "smallint", "tinyint")


def ordering(df: DataFrame, columns: Sequence[str], nulls_first: bool = False) -> Column:
    """One value by which rows are ordered as by the columns. Of one column, or two of whole numbers, it has a fixed
    width, so that an aggregation by it is hashed; of others it is a struct, for which rows are sorted. With nulls_first
    whole numbers that are null come before all others; else the value may be null."""
    kinds = dict(df.dtypes)
    if len(columns) <= 2 and all(kinds.get(c) in _WHOLE for c in columns) and (nulls_first or len(columns) == 2):
        values = [F.col(c).cast("decimal(19,0)") for c in columns]
        if nulls_first:
            values = [F.coalesce(v, F.lit(str(-(1 << 63) - 1)).cast("decimal(19,0)")) for v in values]
        return values[0] if len(columns) == 1 else values[0] * F.lit(str(10**19)).cast("decimal(20,0)") + values[1]
    return F.col(columns[0]) if len(columns) == 1 else F.struct(*columns)


def bucket(df: DataFrame, us: str, every: str | int, aggs: Sequence[Column], by: Sequence[str] = (), mode: str = "floor", empty: bool = False) -> DataFrame:
    """aggs of each bucket of time and key, the bucket's start (or nearest multiple) in column bucket.
    With empty=True the buckets without rows between the first and the last of a key are there too,
    with nulls."""
    width = every if isinstance(every, int) else period_us(every)
    out = df.where(F.col(us).isNotNull()).groupBy(*by, bucket_start(F.col(us), width, mode).alias("bucket")).agg(*aggs)
    if not empty:
        return out
    ends = out.groupBy(*by).agg(F.min("bucket").alias("lo"), F.max("bucket").alias("hi"))
    spine = ends.select(*by, F.explode(F.sequence("lo", "hi", F.lit(width).cast("long"))).alias("bucket"))
    return spine.join(out, [*by, "bucket"], "left")


def history(df: DataFrame, us: str, t0: int, t1: int, limit: int, newest: bool = True, recent: DataFrame | None = None, keys: Sequence[str] = (), max_limit: int = 10_000, order: Sequence[str] = ()) -> DataFrame:
    """The newest, or oldest, rows of a range. recent: rows that are united with df by name; of rows of
    equal keys and time df's holds."""
    rows = in_range(df, us, t0, t1)
    if recent is not None:
        rows = dedup_priority([rows, in_range(recent, us, t0, t1)], [*keys, us])
    sort = [F.col(c).desc() if newest else F.col(c).asc() for c in (us, *order)]
    return rows.orderBy(*sort).limit(min(limit, max_limit))


def dedup_priority(dfs: Sequence[DataFrame], keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """All rows by name, but of each key only the first: of the earliest df, then of the least order."""
    out = None
    for rank, df in enumerate(dfs):
        df = df.withColumn("_rank", F.lit(rank))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    w = Window.partitionBy(*keys).orderBy("_rank", *order)
    return out.withColumn("_nth", F.row_number().over(w)).where("_nth = 1").drop("_rank", "_nth")


def series_points(df: DataFrame, us: str, signal: str, t0: int, t1: int, unit: str | None = None, limit: int = 2_000) -> DataFrame:
    """One signal's values that are not null in a closed range, oldest first; narrow tables have it in
    rows of point_name, wide ones in a column."""
    if "point_name" in df.columns:
        rows = df.where(F.col("point_name") == signal).withColumn("value", F.coalesce("value_f", F.col("value_i").cast("double")))
        rows = rows.withColumn("dtype", F.when(F.col("value_f").isNotNull(), "float").otherwise("integer"))
    else:
        rows = df.withColumn("value", F.col(f"`{signal}`").cast("double")).withColumn("dtype", F.lit("float"))
    if unit is not None:
        rows = with_tags(rows, {"unit_id": unit})
    rest = [F.col(f"`{c}`") for c, kind in rows.dtypes if c != us and not kind.startswith("map")]  # so that a cut among equal times is the same each time
    return in_range(rows.where("value is not null"), us, t0, t1).orderBy(us, *rest).limit(limit)


def snapshot_at(df: DataFrame, us: str, keys: Sequence[str], t: int, cols: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """For each key the row nearest in time to t, of equally near ones the earlier."""
    near = df.withColumn("_near", 2 * F.abs(F.col(us) - t) + (F.col(us) > t).cast("long"))  # of equally near ones the earlier is less
    at = ordering(near, ["_near", *order])
    return near.groupBy(*keys).agg(*[F.min_by(F.col(f"`{c}`"), at).alias(c) for c in [us, *cols]])


def sample_stride(df: DataFrame, keys: Sequence[str], order: Sequence[str], rows_wanted: int = 200) -> DataFrame:
    """Every n-th row of each key in order, n so that about rows_wanted stay; the first always does."""
    w = Window.partitionBy(*keys)
    rows = df.withColumn("_i", F.row_number().over(w.orderBy(*order)) - 1).withColumn("_n", F.count("*").over(w))
    step = F.greatest(F.lit(1), F.floor(F.col("_n") / rows_wanted))
    return rows.where(F.col("_i") % step == 0).drop("_i", "_n")


def union_by_name(*dfs: DataFrame) -> DataFrame:
    out = dfs[0]
    for df in dfs[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def schema_drift(df: DataFrame, known: Sequence[str]) -> DataFrame:
    """(column): those of df that are not known, in order."""
    return df.sparkSession.createDataFrame([(c,) for c in df.columns if c not in set(known)], "column string")


def saved_views(df: DataFrame, views: dict[str, str]) -> None:
    """Register df under a name for each view, with its condition."""
    for name, condition in views.items():
        df.where(condition).createOrReplaceTempView(name)
