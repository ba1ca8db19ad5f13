"""Joins in time, windows, change-of-value and noise."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators import change as C
from ..operators import joins as J
from ..operators import quality as Q
from ..operators import query as R
from ..operators.slices import moving_average
from .registry import Tables, query, scratch
from .table_queries import DAY, HOUR, T0, T1

KEYS, ORDER = ["unit_id", "point_name"], ["us", "seq"]
_W = "PARTITION BY unit_id, point_name ORDER BY us, seq"


# ---- joins
@query("join_equi_bucketed", f""", A AS (SELECT unit_id, us // {DAY} AS b, avg(value_f) AS a FROM P WHERE point_name = 'view' GROUP BY ALL), B AS (SELECT unit_id, us // {DAY} AS b, avg(value_f) AS x FROM P WHERE point_name = 'click' GROUP BY ALL), D AS (SELECT unit_id, us // {DAY} AS b, max(value_i) AS m FROM P WHERE point_name = 'error' GROUP BY ALL)
SELECT unit_id, b, a, x, m FROM A JOIN B USING (unit_id, b) JOIN D USING (unit_id, b)""")
def _(t: Tables) -> DataFrame:
    part = lambda name, agg: R.bucket(t.points.where(F.col("point_name") == name), "us", "1d", [agg], ["unit_id"])
    out = part("view", F.avg("value_f").alias("a")).join(part("click", F.avg("value_f").alias("x")), ["unit_id", "bucket"]).join(part("error", F.max("value_i").alias("m")), ["unit_id", "bucket"])
    return out.select("unit_id", F.expr(f"bucket div {DAY}").alias("b"), "a", "x", "m")


@query("join_stats_back", ", S AS (SELECT point_name, avg(value_f) AS mean, max(value_f) AS most FROM P GROUP BY point_name) SELECT seq, value_f - mean AS off, most FROM P JOIN S USING (point_name) WHERE value_f > 2 * mean")
def _(t: Tables) -> DataFrame:
    stats = t.points.groupBy("point_name").agg(F.avg("value_f").alias("mean"), F.max("value_f").alias("most"))
    return t.points.join(stats, "point_name").where("value_f > 2 * mean").select("seq", (F.col("value_f") - F.col("mean")).alias("off"), "most")


@query("join_cross_params", ", M1 AS (SELECT avg(value_f) AS mean FROM P) SELECT unit_id, count(*) AS n FROM P CROSS JOIN M1 WHERE value_f > mean GROUP BY unit_id")
def _(t: Tables) -> DataFrame:
    one = F.broadcast(t.points.agg(F.avg("value_f").alias("mean")))  # one row
    return t.points.crossJoin(one).where("value_f > mean").groupBy("unit_id").agg(F.count("*").alias("n"))


@query("join_band", "SELECT a.seq AS a_seq, b.seq AS b_seq FROM P a JOIN P b ON abs(a.us - b.us) < 60000000 WHERE a.point_name = 'view' AND b.point_name = 'error'")
def _(t: Tables) -> DataFrame:
    a = t.points.where("point_name = 'view'").select(F.col("seq").alias("a_seq"), F.col("us").alias("a_us"))
    b = t.points.where("point_name = 'error'").select(F.col("seq").alias("b_seq"), F.col("us").alias("b_us"))
    return J.band_join(a, b, "a_us", "b_us", 60_000_000).select("a_seq", "b_seq")


def _sides(t: Tables) -> tuple[DataFrame, DataFrame]:
    left = t.points.where("point_name = 'view'").select("seq", "unit_id", "us")
    return left, t.points.where("point_name = 'click'").select("unit_id", "us", F.col("seq").alias("r_seq"), F.col("value_f").alias("soc"))


@query("join_asof_left", ", L AS (SELECT seq, unit_id, us FROM P WHERE point_name = 'view'), R AS (SELECT unit_id, us, seq AS r_seq, value_f AS soc FROM P WHERE point_name = 'click') SELECT L.seq, L.unit_id, R.r_seq, R.soc FROM L ASOF LEFT JOIN R ON L.unit_id = R.unit_id AND L.us >= R.us")
def _(t: Tables) -> DataFrame:
    return J.asof_join(*_sides(t), ["unit_id"], "us", ["r_seq", "soc"], order=["r_seq"], slice_us=DAY).drop("us")


_GAPS = "SELECT seq, unit_id, us, CASE WHEN value_i % 3 = 0 THEN value_f END AS v FROM P"


def _gaps(t: Tables) -> DataFrame:
    return t.points.select("seq", "unit_id", "us", F.when(F.col("value_i") % 3 == 0, F.col("value_f")).alias("v"))


@query("join_asof_ffill", f", G AS ({_GAPS}) SELECT seq, last_value(v IGNORE NULLS) OVER (PARTITION BY unit_id ORDER BY us, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS v FROM G")
def _(t: Tables) -> DataFrame:
    g = _gaps(t)
    known = g.where("v is not null").select("unit_id", "us", F.col("v").alias("filled"), F.col("seq").alias("k"))
    return J.asof_join(g, known, ["unit_id"], "us", ["filled"], order=["k"], slice_us=DAY).select("seq", F.col("filled").alias("v"))


@query("join_nearest_snapshot", f", R AS (SELECT *, row_number() OVER (PARTITION BY unit_id ORDER BY abs(us - {T0}), us, seq) AS rn FROM P) SELECT unit_id, us, value_f FROM R WHERE rn = 1")
def _(t: Tables) -> DataFrame:
    return R.snapshot_at(t.points, "us", ["unit_id"], T0, ["value_f"], ["seq"])


@query("join_hot_cold", f"SELECT seq, us, value_f FROM P WHERE us >= {T0} AND us <= {T1}")
def _(t: Tables) -> DataFrame:
    cold = t.points.select("seq", "us", "value_f")
    return J.hot_cold(cold, t.points.select("seq", "us", "value_f", "value_i"), "us", T0 + 3 * DAY, T0, T1)


@query("join_compare_full", ", A AS (SELECT unit_id, count(*) AS v FROM P WHERE CAST(unit_id AS BIGINT) <> 5 GROUP BY unit_id), B AS (SELECT unit_id, count(*) AS v FROM P WHERE value_i < 95 AND CAST(unit_id AS BIGINT) <> 6 GROUP BY unit_id) SELECT coalesce(A.unit_id, B.unit_id) AS unit_id, CASE WHEN A.v IS NULL OR B.v IS NULL THEN 'MISSING' WHEN abs(A.v - B.v) <= 2 THEN 'OK' ELSE 'DIFF' END AS status FROM A FULL JOIN B ON A.unit_id = B.unit_id")
def _(t: Tables) -> DataFrame:
    side = lambda cond: t.points.where(cond).groupBy("unit_id").agg(F.count("*").alias("v"))
    return J.compare(side("unit_id <> '5'"), side("value_i < 95 and unit_id <> '6'"), ["unit_id"], ["v"], 2)


_BEATS = f""", H AS (SELECT us // {HOUR} AS h, count(*) AS n FROM P GROUP BY 1), B0 AS (SELECT 's' || CAST(h // 240 AS VARCHAR) AS session_id, h AS seq, (h + 1) * {HOUR} - 1 AS us, n + CASE WHEN h % 5 = 0 THEN 2 ELSE 0 END AS interval_published FROM H),
B AS (SELECT *, CAST(sum(interval_published) OVER (PARTITION BY session_id ORDER BY us) AS BIGINT) AS total_published FROM B0),
S AS (SELECT *, lag(us) OVER (PARTITION BY session_id ORDER BY us) AS from_us, first_value(total_published) OVER (PARTITION BY session_id ORDER BY us) AS base FROM B),
X AS (SELECT S.session_id, S.seq, S.us, S.interval_published, S.total_published, S.base, count(P.us) AS found FROM S LEFT JOIN P ON P.us > S.from_us AND P.us <= S.us WHERE S.from_us IS NOT NULL GROUP BY ALL)
SELECT session_id, seq, interval_published AS published, found, greatest(interval_published - found, 0) AS dropped"""


def beats(t: Tables) -> DataFrame:
    """Hourly heartbeats made of events: every fifth hour claims two messages more than there are."""
    per = t.points.groupBy(F.expr(f"us div {HOUR}").alias("h")).agg(F.count("*").alias("n"))
    out = per.select(
        F.concat(F.lit("s"), F.expr("h div 240").cast("string")).alias("session_id"), F.col("h").alias("seq"), ((F.col("h") + 1) * HOUR - 1).alias("us"),
        (F.col("n") + F.when(F.col("h") % 5 == 0, 2).otherwise(0)).alias("interval_published"),
    )
    return out.withColumn("total_published", F.sum("interval_published").over(Window.partitionBy("session_id").orderBy("us")))


@query("join_expected_counts", _BEATS + " FROM X")
def _(t: Tables) -> DataFrame:
    return J.sync_check(t.points.select("us"), beats(t), "us").drop("cumulative_loss")


@query("dq_sync_disk", _BEATS + ", CAST(total_published - base - sum(found) OVER (PARTITION BY session_id ORDER BY us) AS BIGINT) AS cumulative_loss FROM X")
def _(t: Tables) -> DataFrame:
    return J.sync_check(t.points.select("us"), beats(t), "us")


# ---- windows
@query("win_latest_row", ", R AS (SELECT *, row_number() OVER (PARTITION BY site_id, cell_id ORDER BY us DESC, tie DESC, part DESC, power DESC) AS rn FROM C) SELECT site_id, cell_id, voltage FROM R WHERE rn = 1")
def _(t: Tables) -> DataFrame:
    return R.latest(t.cells.where("voltage is not null"), ["site_id", "cell_id"], "us", ["voltage"], order=["tie", "part", "power"])


@query("win_qualify_latest", "SELECT point_name, unit_id, us, value_f FROM P QUALIFY row_number() OVER (PARTITION BY point_name ORDER BY us DESC, seq DESC) = 1")
def _(t: Tables) -> DataFrame:
    return R.latest(t.points, ["point_name"], "us", ["unit_id", "us", "value_f"], order=["seq"])


@query("win_dedup_priority", f""", U AS (SELECT 0 AS rank, unit_id, us // {HOUR} AS hour, seq, value_f FROM P WHERE point_name IN ('view', 'click') UNION ALL SELECT 1, unit_id, us // {HOUR}, seq, value_f FROM P WHERE point_name IN ('click', 'error'))
SELECT unit_id, hour, seq, value_f FROM U QUALIFY row_number() OVER (PARTITION BY unit_id, hour ORDER BY rank, seq) = 1""")
def _(t: Tables) -> DataFrame:
    part = lambda *names: t.points.where(F.col("point_name").isin(*names)).select("unit_id", F.expr(f"us div {HOUR}").alias("hour"), "seq", "value_f")
    return R.dedup_priority([part("view", "click"), part("click", "error")], ["unit_id", "hour"], ["seq"])


@query("win_delta", f"SELECT seq, abs(value_f - lag(value_f) OVER ({_W})) AS delta FROM P")
def _(t: Tables) -> DataFrame:
    return Q.deltas(t.points, KEYS, ORDER, "value_f").select("seq", "delta")


_RUNS = """, K AS (SELECT *, value_i // 25 AS band FROM P), N AS (SELECT *, row_number() OVER (PARTITION BY unit_id ORDER BY us, seq) - row_number() OVER (PARTITION BY unit_id, band ORDER BY us, seq) AS g FROM K), Q AS (SELECT unit_id, band, g, min(us) AS "begin", max(us) AS "end", count(*) AS length FROM N GROUP BY unit_id, band, g)"""


def _banded(t: Tables) -> DataFrame:
    return t.points.withColumn("band", F.expr("value_i div 25"))


@query("win_runs", _RUNS + ' SELECT unit_id, band, "begin", "end", length FROM Q WHERE length > 3')
def _(t: Tables) -> DataFrame:
    return Q.frozen_runs(_banded(t), ["unit_id"], ORDER, "band", 3)


@query("run_encode", _RUNS + ' SELECT unit_id, band, "begin", "end", length FROM Q')
def _(t: Tables) -> DataFrame:
    return C.run_encode(_banded(t), ["unit_id"], ORDER, "band")


@query("dq_frozen", _RUNS + ' SELECT unit_id, band, "begin", "end", length FROM Q WHERE length > 2')
def _(t: Tables) -> DataFrame:
    return Q.frozen_runs(_banded(t), ["unit_id"], ORDER, "band", 2)


@query("cov_sample_count", _RUNS + ' SELECT unit_id, band, "begin", "end", length FROM Q')
def _(t: Tables) -> DataFrame:
    return C.cov_sample_count(_banded(t), ["unit_id"], ORDER, "band")


@query("win_context", f"SELECT seq, lag(value_f) OVER ({_W}) AS before, lead(value_f) OVER ({_W}) AS after, avg(value_f) OVER ({_W} ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING) AS around FROM P")
def _(t: Tables) -> DataFrame:
    w = Window.partitionBy(*KEYS).orderBy(*ORDER)
    return t.points.select("seq", F.lag("value_f").over(w).alias("before"), F.lead("value_f").over(w).alias("after"), F.avg("value_f").over(w.rowsBetween(-5, 5)).alias("around"))


_FILLED = f", G AS ({_GAPS}) SELECT seq, last_value(v IGNORE NULLS) OVER (PARTITION BY unit_id ORDER BY us, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS v FROM G"


@query("win_ffill", _FILLED)
def _(t: Tables) -> DataFrame:
    return J.ffill(_gaps(t), ["unit_id"], ORDER, ["v"]).select("seq", "v")


@query("compact_ffill", _FILLED)
def _(t: Tables) -> DataFrame:
    from ..sources import compact
    from .ingest_queries import scratch

    path = scratch(t.spark)
    _gaps(t).repartition(8).write.parquet(path)
    compact(t.spark, path, min_files=2, ffill_by=["unit_id"], ffill_order=ORDER)
    return t.spark.read.parquet(path).select("seq", "v")


@query("win_cumsum", f", B AS (SELECT point_name, us // {DAY} * {DAY} AS bucket, count(*) AS n FROM P GROUP BY ALL) SELECT point_name, bucket, CAST(sum(n) OVER (PARTITION BY point_name ORDER BY bucket) AS BIGINT) AS total FROM B")
def _(t: Tables) -> DataFrame:
    b = R.bucket(t.points, "us", "1d", [F.count("*").alias("n")], ["point_name"])
    return b.select("point_name", "bucket", F.sum("n").over(Window.partitionBy("point_name").orderBy("bucket")).alias("total"))


@query("win_derivative", f", L AS (SELECT seq, value_f, us, lag(value_f) OVER ({_W}) AS pv, lag(us) OVER ({_W}) AS pu FROM P) SELECT seq, CASE WHEN value_f >= pv AND us > pu THEN (value_f - pv) / ((us - pu) / 1000000.0) END AS per_s FROM L")
def _(t: Tables) -> DataFrame:
    w = Window.partitionBy(*KEYS).orderBy(*ORDER)
    rows = t.points.select("seq", "value_f", "us", F.lag("value_f").over(w).alias("pv"), F.lag("us").over(w).alias("pu"))
    slope = (F.col("value_f") - F.col("pv")) / ((F.col("us") - F.col("pu")) / F.lit(1e6))
    return rows.select("seq", F.when((F.col("value_f") >= F.col("pv")) & (F.col("us") > F.col("pu")), slope).alias("per_s"))


@query("win_ema", f""", B AS (SELECT point_name, us // {DAY} AS day, CAST(count(*) AS DOUBLE) AS n FROM P GROUP BY ALL), N AS (SELECT *, row_number() OVER (PARTITION BY point_name ORDER BY day) AS rn FROM B),
E AS (SELECT point_name, rn, day, n AS ema FROM N WHERE rn = 1 UNION ALL SELECT N.point_name, N.rn, N.day, 0.2 * N.n + 0.8 * E.ema FROM E JOIN N ON N.point_name = E.point_name AND N.rn = E.rn + 1)
SELECT point_name, day, round(ema, 6) AS ema FROM E""")
def _(t: Tables) -> DataFrame:
    b = R.bucket(t.points, "us", "1d", [F.count("*").cast("double").alias("n")], ["point_name"])
    ema = moving_average(b, ["point_name"], "bucket", "n", slice_rows=10)
    return ema.select("point_name", F.expr(f"bucket div {DAY}").alias("day"), F.round("ema", 6).alias("ema"))


@query("sk_month_from_days", """, D AS (SELECT point_name, abs(value_f - lag(value_f) OVER (PARTITION BY unit_id, point_name ORDER BY us, seq)) AS d FROM P)
SELECT point_name, count(*) AS n, min(d) AS least, max(d) AS most, TRUE AS near, TRUE AS about FROM D WHERE d > 0 GROUP BY point_name""")
def _(t: Tables) -> DataFrame:
    """Sizes of changes by point, from sketches that are written by day; near and about: whether quantiles and distinct
    counts are as close to the exact ones as they promise."""
    from ..operators import sketches as K

    w = Window.partitionBy("unit_id", "point_name").orderBy("us", "seq")
    moved = t.points.withColumn("d", F.abs(F.col("value_f") - F.lag("value_f").over(w))).where("d > 0")
    path = scratch(t.spark)
    K.write_days(K.by_day(moved, ["point_name"], "us", "d"), path)
    got = K.answers(K.merged(t.spark.read.parquet(path), ["point_name"]), {"p50": 0.5, "p95": 0.95, "p99": 0.99}, ["point_name"])
    both = moved.select("point_name", "d").join(F.broadcast(got.select("point_name", "p50", "p95", "p99", "distinct")), "point_name")
    below = [F.avg((F.col("d") <= F.col(p)).cast("double")).alias(f"up_{p}") for p in ("p50", "p95", "p99")]
    under = [F.avg((F.col("d") < F.col(p)).cast("double")).alias(f"lo_{p}") for p in ("p50", "p95", "p99")]
    exact = both.groupBy("point_name").agg(*below, *under, F.countDistinct("d").alias("c"), F.max("distinct").alias("e"))
    near = F.lit(True)
    for p, share in (("p50", 0.5), ("p95", 0.95), ("p99", 0.99)):
        near = near & (F.col(f"lo_{p}") <= share + 0.01) & (F.col(f"up_{p}") >= share - 0.01)
    exact = exact.select("point_name", near.alias("near"), (F.abs(F.col("e") - F.col("c")) <= 0.06 * F.col("c") + 1).alias("about"))
    return got.select("point_name", "n", "least", "most").join(exact, "point_name")


@query("win_running_avg", "SELECT seq, avg(value_f) OVER (PARTITION BY unit_id ORDER BY us, seq) AS mean FROM P")
def _(t: Tables) -> DataFrame:
    return t.points.select("seq", F.avg("value_f").over(Window.partitionBy("unit_id").orderBy(*ORDER)).alias("mean"))


# ---- change of value
@query("cov_exact_narrow", f", L AS (SELECT seq, value_i % 4 AS v, lag(value_i % 4) OVER ({_W}) AS p, row_number() OVER ({_W}) AS rn FROM P) SELECT seq, v FROM L WHERE rn = 1 OR v <> p")
def _(t: Tables) -> DataFrame:
    return C.cov_exact(t.points.withColumn("v", F.col("value_i") % 4), KEYS, ORDER, ["v"]).select("seq", "v")


@query("cov_exact_wide", f", V AS (SELECT seq, unit_id, point_name, us, value_i % 2 AS a, CASE WHEN value_i % 10 <> 0 THEN value_i // 50 END AS b FROM P), L AS (SELECT *, lag(a) OVER ({_W}) AS pa, lag(b) OVER ({_W}) AS pb, row_number() OVER ({_W}) AS rn FROM V) SELECT seq, a, b FROM L WHERE rn = 1 OR NOT coalesce(a = pa AND b = pb, FALSE)")
def _(t: Tables) -> DataFrame:
    rows = t.points.select("seq", *KEYS, "us", (F.col("value_i") % 2).alias("a"), F.when(F.col("value_i") % 10 != 0, F.expr("value_i div 50")).alias("b"))
    return C.cov_exact(rows, KEYS, ORDER, ["a", "b"]).select("seq", "a", "b")


def _walk(passes: str, over: str = _W, same: str = "N.unit_id = Z.unit_id AND N.point_name = Z.point_name") -> str:
    return f""", N AS (SELECT *, row_number() OVER ({over}) AS rn FROM P),
Z AS (SELECT unit_id, point_name, rn, seq, value_f AS last, us AS last_us, TRUE AS keep FROM N WHERE rn = 1 UNION ALL
SELECT N.unit_id, N.point_name, N.rn, N.seq, CASE WHEN {passes} THEN N.value_f ELSE Z.last END, CASE WHEN {passes} THEN N.us ELSE Z.last_us END, {passes}
FROM Z JOIN N ON {same} AND N.rn = Z.rn + 1)
SELECT seq FROM Z WHERE keep"""


@query("cov_relative", _walk("(abs(N.value_f - Z.last) / greatest(abs(Z.last), 0.000001) > 0.5)"))
def _(t: Tables) -> DataFrame:
    return C.cov(t.points, KEYS, "us", "value_f", default=0.5, kind="relative", order=["seq"]).select("seq")


RULES = [("view", 2000.0), ("c*", 500.0)]


@query("cov_epsilon_heartbeat", _walk(f"(N.us - Z.last_us >= {2 * DAY} OR abs(N.value_f - Z.last) >= CASE WHEN N.point_name = 'view' THEN 2000 WHEN N.point_name LIKE 'c%' THEN 500 ELSE 1000 END)"))
def _(t: Tables) -> DataFrame:
    return C.cov(t.points, KEYS, "us", "value_f", RULES, 1000.0, heartbeat_us=2 * DAY, order=["seq"]).select("seq")


@query("dedup_interval", _walk(f"(N.us - Z.last_us >= {5 * DAY} OR N.value_f <> Z.last)"))
def _(t: Tables) -> DataFrame:
    return C.cov(t.points, KEYS, "us", "value_f", exact=F.lit(True), heartbeat_us=5 * DAY, order=["seq"]).select("seq")


@query("cov_long_series", _walk(
    f"(N.us - Z.last_us >= {DAY // 24} OR abs(N.value_f - Z.last) >= 3000)", "PARTITION BY point_name ORDER BY us, seq", "N.point_name = Z.point_name"
))
def _(t: Tables) -> DataFrame:
    return C.cov(t.points, ["point_name"], "us", "value_f", default=3000.0, heartbeat_us=DAY // 24, order=["seq"], slice_rows=500).select("seq")


@query("null_fill", f""", V AS (SELECT seq, unit_id, us, us // {DAY} AS slot, value_i % 3 AS a, CASE WHEN value_i % 10 <> 0 THEN value_i % 2 END AS b FROM P),
L AS (SELECT *, last_value(a IGNORE NULLS) OVER w AS pa, last_value(b IGNORE NULLS) OVER w AS pb FROM V WINDOW w AS (PARTITION BY unit_id, slot ORDER BY us, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT seq, CASE WHEN coalesce(a = pa, FALSE) THEN NULL ELSE a END AS a, CASE WHEN coalesce(b = pb, FALSE) THEN NULL ELSE b END AS b FROM L""")
def _(t: Tables) -> DataFrame:
    rows = t.points.select("seq", "unit_id", "us", (F.col("value_i") % 3).alias("a"), F.when(F.col("value_i") % 10 != 0, F.col("value_i") % 2).alias("b"))
    return C.null_fill(rows, ["unit_id"], "us", ["a", "b"], reset_s=None, order=["seq"]).select("seq", "a", "b")


@query("coalesce_window", """, W AS (SELECT *, us // 600000000 AS slot FROM P), R AS (SELECT *, row_number() OVER (PARTITION BY unit_id, point_name, slot ORDER BY seq DESC) AS rn, min(us) OVER (PARTITION BY unit_id, slot) AS first_us FROM W)
SELECT unit_id, point_name, first_us AS us, value_f FROM R WHERE rn = 1""")
def _(t: Tables) -> DataFrame:
    return C.coalesce_window(t.points, KEYS, "us", 600_000, ["seq"], ["value_f"])


# ---- noise
@query("dq_delta_pct", f", L AS (SELECT point_name, abs(value_f - lag(value_f) OVER ({_W})) AS d FROM P) SELECT point_name, count(*) AS n, round(quantile_cont(d, 0.5), 3) AS p50, round(quantile_cont(d, 0.95), 3) AS p95, round(quantile_cont(d, 0.99), 3) AS p99, max(d) AS p100 FROM L WHERE d > 0 GROUP BY point_name")
def _(t: Tables) -> DataFrame:
    rows = Q.deltas(t.points, KEYS, ORDER, "value_f").where("delta > 0")
    out = Q.value_percentiles(rows, ["point_name"], "delta")
    return out.select("point_name", "n", *[F.round(c, 3).alias(c) for c in ("p50", "p95", "p99")], "p100")


@query("dq_zscore", ", S AS (SELECT unit_id, avg(value_f) AS m, stddev_samp(value_f) AS s FROM P GROUP BY unit_id) SELECT seq, round(abs(value_f - m) / s, 4) AS z FROM P JOIN S USING (unit_id) WHERE s > 0 AND abs(value_f - m) / s > 2.5")
def _(t: Tables) -> DataFrame:
    return Q.zscore(t.points, ["unit_id"], "value_f", 2.5).select("seq", F.round("z", 4).alias("z"))


@query("dq_physics", """, V AS (SELECT us, seq AS id, value_f AS v FROM P WHERE point_name = 'view'), S AS (SELECT us, seq AS id, value_f AS soc FROM P WHERE point_name = 'click'), A AS (SELECT (SELECT avg(v) FROM V) AS vm, (SELECT avg(soc) FROM S) AS sm)
SELECT V.id AS v_id, S.id AS s_id, round(v - (vm - 0.5 * sm + 0.5 * soc), 4) AS residual FROM V JOIN S ON abs(V.us - S.us) < 30000000 CROSS JOIN A ORDER BY abs(v - (vm - 0.5 * sm + 0.5 * soc)) DESC, v_id, s_id LIMIT 40""")
def _(t: Tables) -> DataFrame:
    side = lambda name: t.points.where(F.col("point_name") == name).select("us", F.col("seq").alias("id"), F.col("value_f").alias("value"))
    return Q.physics_residual(side("view"), side("click"), "us", 30_000_000).withColumn("residual", F.round("residual", 4))
