"""Quantiles and distinct counts by sketches that are kept by day and merged.

A day's sketches are a few kilobytes for each key, however many rows it had. A month is answered from the stored days of
the month, without its rows. Ranks are off by about 1.7 / k**0.9 of the rows, distinct counts by about 1.04 / sqrt(2**lg_k).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .change import DAY_US

#: Size of quantile sketches (ranks to about 0.4 % at 800) and the logarithm of that of distinct counts (about 1.6 % at 12).
K, LG_K = 800, 12


def by_day(df: DataFrame, keys: Sequence[str], us: str, value: str, distinct: str | None = None, k: int = K, lg_k: int = LG_K) -> DataFrame:
    """(keys, day, n, least, most, quantiles, names): of each key and day the count and bounds of a value, a sketch of its
    quantiles and one of how many different values of column distinct (by default the value) there are. NaN and null
    values are left out, and rows without a time."""
    rows = df.where(F.col(us).isNotNull() & F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    x = F.col(value).cast("double")
    return rows.groupBy(*keys, F.floor(F.col(us) / DAY_US).cast("long").alias("day")).agg(
        F.count("*").alias("n"), F.min(x).alias("least"), F.max(x).alias("most"), F.kll_sketch_agg_double(x, k).alias("quantiles"),
        F.hll_sketch_agg(F.col(distinct or value).cast("string"), lg_k).alias("names"),
    )


def write_days(days: DataFrame, path: str) -> None:
    """Write sketches by day, in place of what there was of these days."""
    days.hint("rebalance", "day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)


def merged(days: DataFrame, keys: Sequence[str] = (), first: int | None = None, last: int | None = None) -> DataFrame:
    """One row for each key, over some of its days or all: like by_day without day. keys may be fewer than those the
    days have; of stored days only the folders from first to last are read."""
    if first is not None:
        days = days.where(F.col("day") >= first)
    if last is not None:
        days = days.where(F.col("day") <= last)
    return days.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most"), F.kll_merge_agg_double("quantiles").alias("quantiles"), F.hll_union_agg("names").alias("names"),
    )


def answers(sketches: DataFrame, shares: dict[str, float], keep: Sequence[str] = ()) -> DataFrame:
    """keep, n, least, most, a column for each name of shares (the quantile at its share) and distinct (an estimate)."""
    got = [F.kll_sketch_get_quantile_double("quantiles", F.lit(float(p))).alias(name) for name, p in shares.items()]
    return sketches.select(*keep, "n", "least", "most", *got, F.hll_sketch_estimate("names").alias("distinct"))
