"""Noise, integrity and consistency checks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .change import run_encode
from .joins import band_join
from .query import latest


def noise_cv(df: DataFrame, signal: str, value: str, top: int = 20) -> DataFrame:
    """(signal, n, mean, sd, cv): the signals of the largest coefficient of variation, those of no
    deviation left out; of a mean of 0 it is null and comes last."""
    out = df.groupBy(signal).agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("sd")).where("sd > 0")
    out = out.withColumn("cv", F.col("sd") / F.abs(F.nullif(F.col("mean"), F.lit(0.0))))
    return out.orderBy(F.col("cv").desc_nulls_last(), signal).limit(top)


def deltas(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """df with delta, the absolute difference from the key's value before (null for the first)."""
    return df.withColumn("delta", F.abs(F.col(value) - F.lag(value).over(Window.partitionBy(*keys).orderBy(*order))))


def delta_percentiles(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """n, p50, p95, p99 and largest of the deltas that are not 0, for each key."""
    return value_percentiles(deltas(df, keys, order, value).where("delta > 0"), keys, "delta")


def value_percentiles(rows: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """n, p50, p95, p99 and p100, the largest, of each key's values, interpolated. Exact: a key's values are
    counted by distinct value, and the values at the ranks around each share are read off the running count, so
    that no key's values are held at once."""
    counted = rows.groupBy(*keys, F.col(value).alias("delta")).agg(F.count("*").alias("c"))
    sizes = counted.groupBy(*[F.col(k).alias(f"_key_{k}") for k in keys]).agg(F.sum("c").alias("n"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_key_{k}"))
    upto = F.sum("c").over(Window.partitionBy(*keys).orderBy("delta").rowsBetween(Window.unboundedPreceding, 0))
    ranked = counted.withColumn("upto", upto).join(sizes, same)
    at = lambda rank: F.max(F.when((F.col("upto") > rank) & (F.col("upto") - F.col("c") <= rank), F.col("delta")))
    named, out = {"p50": 0.5, "p95": 0.95, "p99": 0.99}, [F.max("delta").alias("p100")]
    for name, share in named.items():
        place = (F.col("n") - 1) * share
        out += [at(F.floor(place)).alias(f"{name}_lo"), at(F.ceil(place)).alias(f"{name}_hi")]
    between = lambda c, share: F.col(f"{c}_lo") + (F.col(f"{c}_hi") - F.col(f"{c}_lo")) * ((F.col("n") - 1) * share - F.floor((F.col("n") - 1) * share))
    return ranked.groupBy(*keys, "n").agg(*out).select(*keys, "n", *[between(c, share).alias(c) for c, share in named.items()], "p100")


def frozen_runs(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, min_run: int = 20) -> DataFrame:
    """Runs of more than min_run equal values."""
    return run_encode(df, keys, order, value).where(F.col("length") > min_run)


def zscore(df: DataFrame, keys: Sequence[str], value: str, limit: float = 3.0) -> DataFrame:
    """Rows more than limit deviations from their key's mean, with mean, sd and z. The statistics are
    aggregated first and joined back, so no key's rows are gathered."""
    stats = df.groupBy(*keys).agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("sd")).where("sd > 0")
    rows = df.join(stats, list(keys))
    return rows.withColumn("z", F.abs(F.col(value) - F.col("mean")) / F.col("sd")).where(F.col("z") > limit)


def physics_residual(voltage: DataFrame, soc: DataFrame, us: str, tolerance_us: int, by: Sequence[str] = (), top: int = 40) -> DataFrame:
    """Pairs of a voltage and a state of charge at nearly the same time with the residual of
    v = mean(v) - mean(soc) / 2 + soc / 2, the largest first. Both tables have us, id and value."""
    v = voltage.select(*by, F.col(us).alias("v_us"), F.col("id").alias("v_id"), F.col("value").alias("v"))
    s = soc.select(*[F.col(c).alias(f"b_{c}") for c in by], F.col(us).alias("s_us"), F.col("id").alias("s_id"), F.col("value").alias("soc"))
    means = v.agg(F.avg("v").alias("v_mean")).crossJoin(s.agg(F.avg("soc").alias("soc_mean")))  # one row
    pairs = band_join(v, s, "v_us", "s_us", tolerance_us, by).crossJoin(F.broadcast(means))
    out = pairs.withColumn("residual", F.col("v") - (F.col("v_mean") - 0.5 * F.col("soc_mean") + 0.5 * F.col("soc")))
    return out.select("v_id", "s_id", "residual").orderBy(F.abs("residual").desc(), "v_id", "s_id").limit(top)


def null_counts(df: DataFrame) -> DataFrame:
    """(column, nulls) of each column that has any."""
    one = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    return one.unpivot([], [F.col(f"`{c}`") for c in df.columns], "column", "nulls").where("nulls > 0")


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(total, distinct, duplicates) of the key tuples, nulls being values."""
    per = df.groupBy(*keys).agg(F.count("*").alias("n"))
    one = per.agg(F.coalesce(F.sum("n"), F.lit(0).cast("long")).alias("total"), F.count("*").alias("distinct"))
    return one.select("total", "distinct", (F.col("total") - F.col("distinct")).alias("duplicates"))


def validate(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(check, ok, detail): has_rows, no_nulls in keys and no_duplicates, in one pass over key groups."""
    nulls = F.lit(False)
    for k in keys:
        nulls = nulls | F.col(k).isNull()
    one = df.groupBy(*keys).agg(F.count("*").alias("n")).agg(
        F.coalesce(F.sum("n"), F.lit(0).cast("long")).alias("rows"), F.coalesce(F.sum(F.when(nulls, F.col("n"))), F.lit(0).cast("long")).alias("nulls"), F.count("*").alias("d")
    )
    line = lambda name, ok, detail: F.struct(F.lit(name).alias("check"), ok.alias("ok"), detail.alias("detail"))
    rows = F.array(
        line("has_rows", F.col("rows") > 0, F.col("rows")),
        line("no_nulls", F.col("nulls") == 0, F.col("nulls")),
        line("no_duplicates", F.col("rows") == F.col("d"), F.col("rows") - F.col("d")),
    )
    return one.select(F.explode(rows).alias("r")).select("r.*")


def cross_counts(dfs: dict[str, DataFrame], tol: float = 0.01) -> DataFrame:
    """(store, rows, spread, ok): rows of each store, how far the counts spread as a share of the largest."""
    out = None
    for name, df in dfs.items():
        one = df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("store"), "rows")
        out = one if out is None else out.union(one)
    w = Window.partitionBy(F.lit(0))
    most, least = F.max("rows").over(w), F.min("rows").over(w)
    out = out.withColumn("spread", F.coalesce((most - least) / F.nullif(most, F.lit(0)), F.lit(0.0)))
    return out.withColumn("ok", F.col("spread") <= tol)


def health_grade(value: Column, bands: Sequence[tuple[float, str]], worst: str) -> Column:
    """The grade of the first band (limit, grade) that value is below; else worst, and so for null."""
    out = F.lit(worst)
    for limit, grade in reversed(bands):
        out = F.when(value < limit, grade).otherwise(out)
    return out


def fault_flags(latest: DataFrame, rules: DataFrame, name: str = "point_name", value: str = "value") -> DataFrame:
    """Rows of the latest values that break a rule (name, op, limit, fault); op is ">" or "<". rules is a
    configuration table of a few rows."""
    rows = latest.join(F.broadcast(rules), name)
    broken = F.when(F.col("op") == ">", F.col(value) > F.col("limit")).otherwise(F.col(value) < F.col("limit"))
    return rows.where(broken)


def imbalance(df: DataFrame, keys: Sequence[str], value: str, limit: float) -> DataFrame:
    """Keys whose values spread by more than limit."""
    return df.groupBy(*keys).agg((F.max(value) - F.min(value)).alias("spread")).where(F.col("spread") > limit)


def stale(df: DataFrame, keys: Sequence[str], us: str, as_of: int, limit_us: int, registry: DataFrame | None = None) -> DataFrame:
    """Keys last seen longer than limit_us before as_of; of a registry's keys also those never seen."""
    seen = df.groupBy(*keys).agg(F.max(us).alias("last_us"))
    if registry is None:
        return seen.where(as_of - F.col("last_us") > limit_us)
    fresh = seen.where(as_of - F.col("last_us") <= limit_us)
    return registry.select(*keys).distinct().join(fresh, list(keys), "left_anti").join(seen, list(keys), "left")


def migration_checks(a: DataFrame, b: DataFrame, us: str, value: str, site: str, rack: str, cell: Sequence[str], one: dict, low: float, high: float, window_us: int, order: Sequence[str] = ()) -> DataFrame:
    """(check, key, a, b, status) of four comparisons of a store with the one that it was moved to:

    current: the latest value of one cell (columns and values in one), to 0.001; count: values by site, exactly; alerts: cells
    whose latest value is below low or above high, exactly; mean: the mean by rack of that cell's site over the last
    window_us of its own side, to 0.05. A key that only one side has is MISSING."""
    tol = {"current": 0.001, "count": 0.0, "alerts": 0.0, "mean": 0.05}

    def figures(df: DataFrame) -> DataFrame:
        rows = df.where(F.col(value).isNotNull())
        row = lambda check, key, v: [F.lit(check).alias("check"), key.cast("string").alias("key"), v.cast("double").alias("v")]
        last = latest(rows, cell, us, [value], order=order)
        mine = reduce(lambda x, y: x & y, [F.col(c) == v for c, v in one.items()])
        current = last.where(mine).select(*row("current", F.concat_ws("/", *one), F.col(value)))
        count = rows.groupBy(site).agg(F.count("*").alias("n")).select(*row("count", F.col(site), F.col("n")))
        out = (F.col(value) < low) | (F.col(value) > high)
        alerts = last.agg(F.count_if(out).alias("n")).select(*row("alerts", F.lit("all"), F.col("n")))
        end = rows.agg(F.max(us).alias("_end"))  # one row
        recent = rows.where(F.col(site) == one[site]).crossJoin(F.broadcast(end)).where(F.col(us) > F.col("_end") - window_us)
        mean = recent.groupBy(rack).agg(F.avg(value).alias("m")).select(*row("mean", F.col(rack), F.col("m")))
        return current.union(count).union(alerts).union(mean)

    x, y = figures(a), figures(b).select(F.col("check").alias("_c"), F.col("key").alias("_k"), F.col("v").alias("b"))
    both = x.withColumnRenamed("v", "a").withColumn("_a", F.lit(1)).join(y.withColumn("_b", F.lit(1)), (F.col("check") == F.col("_c")) & F.col("key").eqNullSafe(F.col("_k")), "full_outer")
    check = F.coalesce("check", "_c")
    limit = reduce(lambda out, c: F.when(check == c, F.lit(tol[c])).otherwise(out), tol, F.lit(0.0))
    same = F.coalesce(F.abs(F.col("a") - F.col("b")) <= limit, F.lit(False))
    status = F.when(F.col("_a").isNull() | F.col("_b").isNull(), "MISSING").when(same, "OK").otherwise("DIFF")
    return both.select(check.alias("check"), F.coalesce("key", "_k").alias("key"), "a", "b", status.alias("status"))
