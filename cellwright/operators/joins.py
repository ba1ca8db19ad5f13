"""Joins in time: as-of, band, hot and cold, comparison, expected counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def asof_join(left: DataFrame, right: DataFrame, by: Sequence[str], us: str, cols: Sequence[str], how: str = "left", order: Sequence[str] = (), slice_us: int | None = None) -> DataFrame:
    """For each left row the cols of the latest right row of its key with time <= its own.

    Of right rows of equal time that of the largest order columns holds. Both sides are united and
    sorted once for each key; with slice_us a key is cut into slices of time, and each gets the last
    right row of the slices before it, so a key with most of the rows is many tasks' work. Null keys
    or times match nothing. how: left or inner."""
    width = slice_us or None
    slot = F.floor(F.col(us) / width) if width else F.lit(0)
    right = right.select(*by, us, F.struct(*(order or [F.lit(0)])).alias("_order"), F.struct(*cols).alias("_value"))
    whole = left.select(F.struct(*left.columns).alias("_row"))
    none = lambda df, c: F.lit(None).cast(df.schema[c].dataType).alias(c)
    r = right.where(F.col(us).isNotNull()).select(*by, us, F.lit(0).alias("_side"), "_order", "_value", none(whole, "_row"))
    l = left.select(*by, us, F.lit(1).alias("_side"), none(right, "_order"), none(right, "_value"), F.struct(*left.columns).alias("_row"))  # noqa: E741
    both = r.union(l).withColumn("_slot", slot)
    inside = Window.partitionBy(*by, "_slot").orderBy(us, "_side", "_order").rowsBetween(Window.unboundedPreceding, 0)
    seen = both.withColumn("_near", F.last("_value", ignorenulls=True).over(inside)).where("_side = 1")
    if width:
        ends = both.groupBy(*by, "_slot").agg(F.max_by("_value", F.when(F.col("_side") == 0, F.struct(us, "_order"))).alias("_end"))
        before = Window.partitionBy(*by).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
        carry = ends.withColumn("_far", F.last("_end", ignorenulls=True).over(before)).drop("_end")
        cond = [seen[c].eqNullSafe(carry[c]) for c in (*by, "_slot")]
        seen = seen.join(carry, cond, "left").select(seen["_row"], F.coalesce("_near", "_far").alias("_near"))
    known = F.lit(True)
    for c in by:
        known = known & F.col(f"_row.{c}").isNotNull()
    near = F.when(known & F.col(f"_row.{us}").isNotNull(), F.col("_near"))
    out = seen.select("_row.*", *[near[c].alias(c if c not in left.columns else f"{c}_right") for c in cols], near.isNotNull().alias("_hit"))
    return (out.where("_hit") if how == "inner" else out).drop("_hit")


def ffill(df: DataFrame, by: Sequence[str], order: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Nulls of cols filled with the key's last value before."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in cols})


def band_join(left: DataFrame, right: DataFrame, left_us: str, right_us: str, tolerance_us: int, by: Sequence[str] = ()) -> DataFrame:
    """Pairs whose times differ by less than the tolerance, and whose by columns (b_... on the right)
    are equal. Both sides are cut into cells as wide as the tolerance and the right one is put into
    three of them, so it is a join on equal cells; each pair meets once. Column names must differ."""
    l = left.withColumn("_cell", F.floor(F.col(left_us) / tolerance_us))  # noqa: E741
    at = F.floor(F.col(right_us) / tolerance_us)
    r = right.withColumn("_near", F.explode(F.array(at - 1, at, at + 1)))
    on = l["_cell"] == r["_near"]
    for c in by:
        on = on & (l[c] == r[f"b_{c}"])
    return l.join(r, on & (F.abs(l[left_us] - r[right_us]) < tolerance_us)).drop("_cell", "_near")


def hot_cold(cold: DataFrame, hot: DataFrame, us: str, cutoff: int, t0: int, t1: int, limit: int | None = None, keep_hot_only: bool = False) -> DataFrame:
    """Rows of [t0, t1]: of cold before the cutoff, of hot from it on, with cold's columns (and hot's
    own with keep_hot_only), sorted by time with nulls last, then limited."""
    a = cold.where((F.col(us) >= t0) & (F.col(us) <= t1) & (F.col(us) < cutoff))
    b = hot.where((F.col(us) >= t0) & (F.col(us) <= t1) & (F.col(us) >= cutoff))
    out = a.unionByName(b, allowMissingColumns=True)
    out = out if keep_hot_only else out.select(*cold.columns)
    rest = [F.col(f"`{c}`") for c, kind in out.dtypes if c != us and not kind.startswith("map")]  # equal times in one order, where a limit cuts
    out = out.orderBy(F.col(us).asc_nulls_last(), *rest)
    return out.limit(limit) if limit is not None else out


def compare(a: DataFrame, b: DataFrame, keys: Sequence[str], values: Sequence[str], tol: float = 0.0) -> DataFrame:
    """keys and status of every key of either side: OK, DIFF (a value differs by more than tol, or is
    null on one side) or MISSING (only one side has it). Keys compare null-safely."""
    x = a.select(*[F.col(k).alias(f"_a_{k}") for k in keys], *[F.col(v).alias(f"_av_{v}") for v in values], F.lit(1).alias("_ina"))
    y = b.select(*[F.col(k).alias(f"_b_{k}") for k in keys], *[F.col(v).alias(f"_bv_{v}") for v in values], F.lit(1).alias("_inb"))
    on = None
    for k in keys:
        same = F.col(f"_a_{k}").eqNullSafe(F.col(f"_b_{k}"))
        on = same if on is None else on & same
    both = x.join(y, on, "full_outer")
    equal = F.lit(True)
    for v in values:
        p, q = F.col(f"_av_{v}"), F.col(f"_bv_{v}")
        equal = equal & F.coalesce(F.abs(p - q) <= tol, p.isNull() & q.isNull())
    status = F.when(F.col("_ina").isNull() | F.col("_inb").isNull(), "MISSING").when(equal, "OK").otherwise("DIFF")
    return both.select(*[F.coalesce(f"_a_{k}", f"_b_{k}").alias(k) for k in keys], status.alias("status"))


def sync_check(rows: DataFrame, beats: DataFrame, us: str) -> DataFrame:
    """Published against found rows for each interval between heartbeats.

    beats: session_id, seq, us, interval_published, total_published. A row belongs to the interval of every
    session whose heartbeats it lies between: after the one before, and at or before the one that closes it.
    Sessions may overlap. Result: session_id, seq,
    published, found, dropped (of the interval alone, not below 0) and cumulative_loss (published
    since the session's first heartbeat less found since, in which late rows cancel out). The first
    heartbeat of a session only marks where it begins and is left out. What is found is the difference of how
    many rows there are up to both ends: rows and ends are sorted once in time, by the hour, without a range join."""
    w = Window.partitionBy("session_id").orderBy("us")
    spans = beats.select("session_id", "seq", F.col(us).alias("us"), "interval_published", "total_published").withColumn("from_us", F.lag("us").over(w)).withColumn("base", F.first("total_published").over(w))
    spans = spans.where("from_us is not null")
    ends = spans.select(F.explode(F.array("us", "from_us")).alias("t")).distinct()
    ticks = rows.where(F.col(us).isNotNull()).groupBy(F.col(us).alias("t")).agg(F.count("*").alias("n"))
    both = ends.select("t", F.lit(1).alias("end"), F.lit(0).cast("long").alias("n")).union(ticks.select("t", F.lit(0), "n"))
    both = both.withColumn("hour", F.floor(F.col("t") / 3_600_000_000))
    hours = both.groupBy("hour").agg(F.sum("n").alias("all"))  # one row an hour: its running sum is one small task
    hours = hours.select("hour", (F.sum("all").over(Window.orderBy("hour")) - F.col("all")).alias("before"))
    inside = F.sum("n").over(Window.partitionBy("hour").orderBy("t", "end").rowsBetween(Window.unboundedPreceding, 0))
    upto = both.withColumn("inside", inside).where("end = 1").join(hours, "hour").select("t", (F.col("inside") + F.col("before")).alias("upto"))
    out = spans.join(upto.withColumnsRenamed({"t": "us", "upto": "last"}), "us").join(upto.withColumnsRenamed({"t": "from_us", "upto": "first"}), "from_us")
    out = out.withColumn("found", F.col("last") - F.col("first"))
    total = F.sum("found").over(w.rowsBetween(Window.unboundedPreceding, 0))
    return out.withColumn("loss", F.col("total_published") - F.col("base") - total).select(
        "session_id", "seq", F.col("interval_published").alias("published"), "found",
        F.greatest(F.col("interval_published") - F.col("found"), F.lit(0).cast("long")).alias("dropped"), F.col("loss").alias("cumulative_loss"),
    )
