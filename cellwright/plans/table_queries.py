"""Filters, latest values, buckets, sorting, sets and reshaping."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators import joins as J
from ..operators import quality as Q
from ..operators import query as R
from ..operators import shape as S
from ..sources import read_store, scoped, trim_store, write_store
from .registry import Tables, query, scratch

HOUR, DAY = 3_600_000_000, 86_400_000_000
T0, T1 = 1_704_067_200_000_000 + 5 * DAY, 1_704_067_200_000_000 + 12 * DAY  # within January 2024, where events lie
C0, C1 = 820_454_400_000_000, 852_076_800_000_000  # the year 1996, for cells
TIES = ["tie", "part", "power"]
LAST = "ORDER BY us DESC, tie DESC, part DESC, power DESC"


# ---- sources
@query("src_parquet_union", "SELECT seq, us, unit_id, value_f, NULL::BIGINT AS value_i FROM P WHERE point_name = 'view' UNION ALL SELECT seq, us, unit_id, NULL, value_i FROM P WHERE point_name = 'click'")
def _(t: Tables) -> DataFrame:
    p, path = t.points, scratch(t.spark)
    p.where("point_name = 'view'").select("seq", "us", "unit_id", "value_f").write.parquet(f"{path}/views")
    p.where("point_name = 'click'").select("seq", "us", "unit_id", "value_i").write.parquet(f"{path}/clicks")
    return read_store(t.spark, f"{path}/views", f"{path}/clicks").select("seq", "us", "unit_id", "value_f", "value_i")


@query("src_date_scoped", f"SELECT seq, us, unit_id, point_name FROM P WHERE us >= {T0} AND us < {T0 + 2 * DAY}")
def _(t: Tables) -> DataFrame:
    path, first = scratch(t.spark), datetime.datetime.fromtimestamp(T0 / 1e6, datetime.UTC).date()
    dated = t.points.withColumn("date", F.to_date(F.timestamp_micros("us")))
    write_store(dated, path, ["date"])
    two = scoped(read_store(t.spark, path), str(first), str(first + datetime.timedelta(days=2)))
    return R.in_range(two, "us", T0, T0 + 2 * DAY, "left").select("seq", "us", "unit_id", "point_name")


@query("src_missing_ok", "SELECT seq, us FROM P WHERE us > 4102444800000000")
def _(t: Tables) -> DataFrame:
    # the store of a far year was never written
    p, path = t.points.select("seq", "us"), scratch(t.spark)
    p.where("us <= 4102444800000000").write.parquet(f"{path}/year=now")
    return read_store(t.spark, f"{path}/year=2100", schema=p.schema)


@query("src_filename_col")
def _(t: Tables) -> DataFrame:
    return t.table("events").groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count("*").alias("n"))


_FOOTER = ("event_id", "user_id", "value", "ts")


@query("src_parquet_footer", " UNION ALL ".join(
    f"SELECT '{c}' AS name, count(*) AS rows, CAST(count(*) - count({c}) AS BIGINT) AS nulls, CAST(min({x}) AS DOUBLE) AS least, CAST(max({x}) AS DOUBLE) AS most FROM events"
    for c in _FOOTER for x in [f"epoch_us({c})" if c == "ts" else c]
))
def _(t: Tables) -> DataFrame:
    from ..sources import column_footers

    chunks = column_footers(t.spark, f"{t.sf_dir}/events.parquet", _FOOTER)
    return chunks.groupBy(F.col("column").alias("name")).agg(F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"), F.min("least_n").alias("least"), F.max("most_n").alias("most"))


@query("downsample_task", f"SELECT unit_id, us // {HOUR} * {HOUR} AS bucket, avg(value_f) AS mean FROM P GROUP BY ALL")
def _(t: Tables) -> DataFrame:
    path = scratch(t.spark)
    hourly = R.bucket(t.points, "us", "1h", [F.avg("value_f").alias("mean")], ["unit_id"])
    write_store(hourly.withColumn("date", F.to_date(F.timestamp_micros("bucket"))), path, ["date"])
    return read_store(t.spark, path).select("unit_id", "bucket", "mean")


@query("retention_trim", "SELECT event_id AS seq FROM events WHERE CAST(ts AS DATE) > DATE '2024-01-30' - 7")
def _(t: Tables) -> DataFrame:
    path = scratch(t.spark)
    write_store(t.table("events").withColumn("date", F.to_date("ts")), path, ["date"])
    trim_store(t.spark, path, 7, "2024-01-30")
    return read_store(t.spark, path).select(F.col("event_id").alias("seq"))


# ---- projection and filters
@query("filter_time_closed", f"SELECT * FROM P WHERE us >= {T0} AND us <= {T1}")
def _(t: Tables) -> DataFrame:
    return R.in_range(t.points, "us", T0, T1)


@query("filter_time_halfopen", f"SELECT * FROM P WHERE us >= {T0} AND us < {T1}")
def _(t: Tables) -> DataFrame:
    return R.in_range(t.points, "us", T0, T1, "left")


@query("filter_relative", f"SELECT * FROM P WHERE us >= (SELECT max(us) FROM P) - {6 * HOUR}")
def _(t: Tables) -> DataFrame:
    return R.last_period(t.points, "us", "-6h")


@query("filter_tags", "SELECT * FROM C WHERE CAST(site_id AS VARCHAR) = '3' AND CAST(rack_id AS VARCHAR) = '2'")
def _(t: Tables) -> DataFrame:
    return R.with_tags(t.cells, {"site_id": 3, "rack_id": 2})


@query("filter_extra", "SELECT * FROM P WHERE point_name = 'error' AND unit_id = '10'")
def _(t: Tables) -> DataFrame:
    return R.with_tags(R.with_tags(t.points, {"point_name": "error"}), {"unit_id": "0"}, prefix="1")


@query("filter_dtype", "SELECT seq, topic FROM M WHERE topic NOT LIKE '%/string'")
def _(t: Tables) -> DataFrame:
    return t.messages.where(F.element_at(F.split("topic", "/"), -1) != "string").select("seq", "topic")


@query("filter_threshold_latest", f""", L AS (SELECT *, row_number() OVER (PARTITION BY site_id, rack_id, cell_id {LAST}) AS rn FROM C)
SELECT site_id, rack_id, cell_id, voltage FROM L WHERE rn = 1 AND (voltage < 3200 OR voltage > 4100)""")
def _(t: Tables) -> DataFrame:
    out = R.latest(t.cells, ["site_id", "rack_id", "cell_id"], "us", ["voltage"], order=TIES)
    return out.where("voltage < 3200 or voltage > 4100")


@query("filter_then_last", f""", L AS (SELECT *, row_number() OVER (PARTITION BY site_id, rack_id, cell_id {LAST}) AS rn FROM C WHERE temperature > 40)
SELECT site_id, rack_id, cell_id, temperature FROM L WHERE rn = 1""")
def _(t: Tables) -> DataFrame:
    return R.latest(t.cells.where("temperature > 40"), ["site_id", "rack_id", "cell_id"], "us", ["temperature"], order=TIES)


@query("filter_fault_count", "SELECT unit_id, point_name, count(*) AS n FROM P WHERE point_name IN ('view', 'click') AND value_i <> 0 GROUP BY ALL")
def _(t: Tables) -> DataFrame:
    return t.points.where("point_name in ('view', 'click') and value_i <> 0").groupBy("unit_id", "point_name").agg(F.count("*").alias("n"))


@query("select_fields", "SELECT seq, unit_id, value_f FROM P")
def _(t: Tables) -> DataFrame:
    return t.points.select("seq", "unit_id", "value_f")


@query("select_glob", "SELECT site_id, rack_id, voltage, power FROM C")
def _(t: Tables) -> DataFrame:
    return R.select_glob(t.cells, ["*_id", "v*", "p*"], ["cell*", "part"])


@query("saved_views", "SELECT site_id, count(*) AS n FROM C WHERE soc < 20 GROUP BY site_id")
def _(t: Tables) -> DataFrame:
    R.saved_views(t.cells, {"low_soc": "soc < 20"})
    return t.spark.sql("SELECT site_id, count(*) AS n FROM low_soc GROUP BY site_id")


# ---- aggregation
_MEANS = "avg(voltage) AS voltage, avg(temperature) AS temperature, avg(soc) AS soc, avg(power) AS power"


def _means() -> list:
    return [F.avg(c).alias(c) for c in ("voltage", "temperature", "soc", "power")]


@query("agg_bucket_mean", f"SELECT site_id, CAST(us / {30.0 * DAY} AS BIGINT) * {30 * DAY} AS bucket, {_MEANS} FROM C GROUP BY ALL")
def _(t: Tables) -> DataFrame:
    return R.bucket(t.cells, "us", "30d", _means(), ["site_id"], mode="nearest")


@query("agg_time_bucket", f"SELECT site_id, rack_id, us // {DAY} * {DAY} AS bucket, avg(voltage) AS voltage FROM C GROUP BY ALL ORDER BY bucket DESC, site_id, rack_id LIMIT 288")
def _(t: Tables) -> DataFrame:
    out = R.bucket(t.cells, "us", "1d", [F.avg("voltage").alias("voltage")], ["site_id", "rack_id"])
    return out.orderBy(F.desc("bucket"), "site_id", "rack_id").limit(288)


@query("agg_bucket_multi", f""", L AS (SELECT *, us // {DAY} * {DAY} AS bucket FROM P), R AS (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY us DESC, seq DESC) AS rn FROM L)
SELECT bucket, avg(value_f) AS mean, min(value_i) AS least, max(value_i) AS most, max(CASE WHEN rn = 1 THEN value_f END) AS last FROM R GROUP BY bucket""")
def _(t: Tables) -> DataFrame:
    aggs = [F.avg("value_f").alias("mean"), F.min("value_i").alias("least"), F.max("value_i").alias("most"), F.max_by("value_f", R.ordering(t.points, ["us", "seq"])).alias("last")]
    return R.bucket(t.points, "us", "1d", aggs)


@query("agg_ohlc", f""", L AS (SELECT *, us // {6 * HOUR} * {6 * HOUR} AS bucket FROM P), R AS (SELECT *, row_number() OVER (PARTITION BY point_name, bucket ORDER BY us, seq) AS a, row_number() OVER (PARTITION BY point_name, bucket ORDER BY us DESC, seq DESC) AS z FROM L)
SELECT point_name, bucket, max(CASE WHEN a = 1 THEN value_f END) AS open, max(value_f) AS high, min(value_f) AS low, max(CASE WHEN z = 1 THEN value_f END) AS close FROM R GROUP BY ALL""")
def _(t: Tables) -> DataFrame:
    at = R.ordering(t.points, ["us", "seq"])
    aggs = [F.min_by("value_f", at).alias("open"), F.max("value_f").alias("high"), F.min("value_f").alias("low"), F.max_by("value_f", at).alias("close")]
    return R.bucket(t.points, "us", "6h", aggs, ["point_name"])


@query("agg_ms_bucket", "SELECT unit_id, us // 250000 * 250000 AS bucket, avg(value_f) AS mean, count(*) AS n FROM P GROUP BY ALL")
def _(t: Tables) -> DataFrame:
    return R.bucket(t.points, "us", "250ms", [F.avg("value_f").alias("mean"), F.count("*").alias("n")], ["unit_id"])


@query("agg_window_mean_noempty", "SELECT point_name, us // 60000000 * 60000000 AS bucket, avg(value_f) AS mean FROM P GROUP BY ALL")
def _(t: Tables) -> DataFrame:
    return R.bucket(t.points, "us", "1m", [F.avg("value_f").alias("mean")], ["point_name"])


@query("agg_window_count", f""", B AS (SELECT point_name, us // {HOUR} * {HOUR} AS bucket, count(*) AS n FROM P GROUP BY ALL),
E AS (SELECT point_name, unnest(generate_series(min(bucket), max(bucket), {HOUR})) AS bucket FROM B GROUP BY point_name)
SELECT point_name, bucket, coalesce(n, 0) AS n FROM E LEFT JOIN B USING (point_name, bucket)""")
def _(t: Tables) -> DataFrame:
    return R.bucket(t.points, "us", "1h", [F.count("*").alias("n")], ["point_name"], empty=True).fillna(0, ["n"])


@query("agg_daily_mean", f"SELECT unit_id, us // {DAY} AS day, avg(value_f) AS mean FROM P GROUP BY ALL")
def _(t: Tables) -> DataFrame:
    return R.bucket(t.points, "us", "1d", [F.avg("value_f").alias("mean")], ["unit_id"]).select("unit_id", F.expr(f"bucket div {DAY}").alias("day"), "mean")


@query("agg_group_mean", f"SELECT site_id, {_MEANS} FROM C GROUP BY site_id")
def _(t: Tables) -> DataFrame:
    return t.cells.groupBy("site_id").agg(*_means())


@query("agg_influxql_time", f"SELECT site_id, rack_id, us // {7 * DAY} * {7 * DAY} AS bucket, {_MEANS} FROM C WHERE us >= {C0} AND us < {C1} GROUP BY ALL")
def _(t: Tables) -> DataFrame:
    return R.bucket(R.in_range(t.cells, "us", C0, C1, "left"), "us", "7d", _means(), ["site_id", "rack_id"])


@query("agg_latest_argmax", f""", L AS (SELECT *, row_number() OVER (PARTITION BY site_id, rack_id, cell_id {LAST}) AS rn, row_number() OVER (PARTITION BY site_id, rack_id, cell_id, temperature > 10 {LAST}) AS rt FROM C)
SELECT site_id, rack_id, cell_id, max(CASE WHEN rn = 1 THEN voltage END) AS voltage, max(CASE WHEN rt = 1 AND temperature > 10 THEN temperature END) AS temperature FROM L GROUP BY ALL""")
def _(t: Tables) -> DataFrame:
    rows = t.cells.withColumn("temperature", F.when(F.col("temperature") > 10, F.col("temperature")))
    return R.latest(rows, ["site_id", "rack_id", "cell_id"], "us", ["voltage", "temperature"], per_column=True, order=TIES)


@query("agg_solar_overview", f""", L AS (SELECT *, row_number() OVER (PARTITION BY site_id {LAST}) AS rn FROM C)
SELECT site_id, round(power / 1000, 1) AS power, round(soc / 10, 0) AS efficiency FROM L WHERE rn = 1""")
def _(t: Tables) -> DataFrame:
    out = R.latest(t.cells, ["site_id"], "us", ["power", "soc"], order=TIES)
    return out.select("site_id", F.round(F.col("power") / 1000, 1).alias("power"), F.round(F.col("soc") / 10, 0).alias("efficiency"))


@query("agg_fleet_health", """, U AS (SELECT 'points' AS source, unit_id AS id, us FROM P UNION ALL SELECT 'cells', CAST(site_id AS VARCHAR), us FROM C)
SELECT source, id, count(*) AS n, (SELECT max(us) FROM P) - max(us) AS age_us FROM U GROUP BY source, id""")
def _(t: Tables) -> DataFrame:
    both = t.points.select(F.lit("points").alias("source"), F.col("unit_id").alias("id"), "us").unionAll(t.cells.select(F.lit("cells"), F.col("site_id").cast("string"), "us"))
    now = F.broadcast(t.points.agg(F.max("us").alias("now")))
    out = both.groupBy("source", "id").agg(F.count("*").alias("n"), F.max("us").alias("last"))
    return out.crossJoin(now).select("source", "id", "n", (F.col("now") - F.col("last")).alias("age_us"))


@query("agg_write_rate", f"SELECT count(*) AS n FROM P WHERE us >= {T0} AND us < {T1} AND unit_id = '7'")
def _(t: Tables) -> DataFrame:
    return R.with_tags(R.in_range(t.points, "us", T0, T1, "left"), {"unit_id": 7}).agg(F.count("*").alias("n"))


@query("agg_rate_per_s", f"SELECT point_name, count(*) / {(T1 - T0) // 1_000_000}.0 AS per_s FROM P WHERE us >= {T0} AND us < {T1} GROUP BY point_name")
def _(t: Tables) -> DataFrame:
    return R.in_range(t.points, "us", T0, T1, "left").groupBy("point_name").agg((F.count("*") / F.lit((T1 - T0) / 1e6)).alias("per_s"))


@query("agg_reduction_pct", "SELECT count(*) AS baseline, count(*) FILTER (WHERE topic NOT LIKE '%/string') AS kept, 100.0 * (count(*) - count(*) FILTER (WHERE topic NOT LIKE '%/string')) / count(*) AS saved_pct FROM M")
def _(t: Tables) -> DataFrame:
    kept = F.count_if(~F.col("topic").endswith("/string"))
    return t.messages.agg(F.count("*").alias("baseline"), kept.alias("kept")).withColumn("saved_pct", F.lit(100.0) * (F.col("baseline") - F.col("kept")) / F.col("baseline"))


@query("agg_max_ts_gap", "SELECT unit_id, (SELECT max(us) FROM P) - max(us) AS gap_us FROM P GROUP BY unit_id")
def _(t: Tables) -> DataFrame:
    per = t.points.groupBy("unit_id").agg(F.max("us").alias("last"))
    return per.crossJoin(F.broadcast(per.agg(F.max("last").alias("now")))).select("unit_id", (F.col("now") - F.col("last")).alias("gap_us"))


@query("agg_distinct_cells", "SELECT count(DISTINCT site_id || '/' || rack_id || '/' || cell_id) AS cells, min(us) AS first_us, max(us) AS last_us FROM C")
def _(t: Tables) -> DataFrame:
    per = t.cells.groupBy("site_id", "rack_id", "cell_id").agg(F.min("us").alias("lo"), F.max("us").alias("hi"))
    return per.agg(F.count("*").alias("cells"), F.min("lo").alias("first_us"), F.max("hi").alias("last_us"))


@query("agg_file_interval", """, F AS (SELECT CAST(unit_id AS BIGINT) % 3 AS site, us // 86400000000 AS day, count(*) AS n, max(us) - min(us) AS span FROM P GROUP BY ALL)
SELECT CAST(site AS VARCHAR) AS site, count(*) AS files, avg(span) / 1e6 AS mean_s, max(span) / 1e6 AS most_s, avg(n) AS mean_rows, CAST(sum(n) AS BIGINT) AS rows FROM F GROUP BY 1""")
def _(t: Tables) -> DataFrame:
    from ..sources import file_intervals

    path = scratch(t.spark)
    rows = t.points.select((F.col("unit_id").cast("long") % 3).alias("site"), F.floor(F.col("us") / DAY).alias("day"), "us", "seq")
    rows.repartition("site", "day").write.partitionBy("site", "day").parquet(path)  # a file for each
    return file_intervals(t.spark, path, "us", ["site"])


@query("agg_overview", "SELECT point_name, count(*) AS n, count(DISTINCT unit_id) AS units, count(*) FILTER (WHERE value_i % 2 = 0) AS even, count(*) FILTER (WHERE value_i % 2 <> 0) AS odd, min(us) AS first_us, max(us) AS last_us FROM P GROUP BY point_name")
def _(t: Tables) -> DataFrame:
    return t.points.groupBy("point_name").agg(
        F.count("*").alias("n"), F.countDistinct("unit_id").alias("units"), F.count_if(F.col("value_i") % 2 == 0).alias("even"),
        F.count_if(F.col("value_i") % 2 != 0).alias("odd"), F.min("us").alias("first_us"), F.max("us").alias("last_us"),
    )


@query("agg_topic_formats", "SELECT topic, count(*) AS n FROM M GROUP BY topic ORDER BY n DESC, topic LIMIT 200")
def _(t: Tables) -> DataFrame:
    return t.messages.groupBy("topic").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "topic").limit(200)


@query("agg_distinct_signals", "SELECT DISTINCT point_name FROM P ORDER BY point_name")
def _(t: Tables) -> DataFrame:
    return t.points.select("point_name").distinct().orderBy("point_name")


@query("agg_storage_stats")
def _(t: Tables) -> DataFrame:
    from ..sources import storage_stats

    return storage_stats(t.spark, f"{t.sf_dir}/events.parquet")


@query("agg_storage_ratio")
def _(t: Tables) -> DataFrame:
    from ..sources import wire_ratio

    return wire_ratio(t.spark, f"{t.sf_dir}/events.parquet", "event_type", "props")


@query("agg_series_cardinality", "SELECT count(DISTINCT unit_id || '/' || point_name) AS series, count(DISTINCT unit_id) AS units, count(DISTINCT point_name) AS points FROM P")
def _(t: Tables) -> DataFrame:
    sets = t.points.select("unit_id", "point_name").distinct()
    return sets.agg(F.count("*").alias("series"), F.countDistinct("unit_id").alias("units"), F.countDistinct("point_name").alias("points"))


@query("agg_first_reading", """, F AS (SELECT unit_id, point_name, min(us) AS first_us, max(us) AS last_us FROM P GROUP BY ALL)
SELECT point_name, min(first_us) AS first_us, max(last_us) AS last_us, count(*) AS series FROM F GROUP BY point_name""")
def _(t: Tables) -> DataFrame:
    per = t.points.groupBy("unit_id", "point_name").agg(F.min("us").alias("first_us"), F.max("us").alias("last_us"))
    return per.groupBy("point_name").agg(F.min("first_us").alias("first_us"), F.max("last_us").alias("last_us"), F.count("*").alias("series"))


@query("agg_counter_rate", f""", K AS (SELECT unit_id, us // {DAY} AS day, us, sum(value_i) OVER (PARTITION BY unit_id ORDER BY us, seq) AS counter FROM P)
SELECT unit_id, day, CASE WHEN max(us) > min(us) THEN (max(counter) - min(counter)) / ((max(us) - min(us)) / 1000000.0) ELSE count(*) / 60.0 END AS per_s FROM K GROUP BY ALL""")
def _(t: Tables) -> DataFrame:
    w = Window.partitionBy("unit_id").orderBy("us", "seq")
    k = t.points.select("unit_id", "us", F.expr(f"us div {DAY}").alias("day"), F.sum("value_i").over(w).alias("counter"))
    elapsed = (F.max("us") - F.min("us")) / F.lit(1e6)
    rate = F.when(F.max("us") > F.min("us"), (F.max_by("counter", "us") - F.min_by("counter", "us")) / elapsed).otherwise(F.count("*") / F.lit(60.0))
    return k.groupBy("unit_id", "day").agg(rate.alias("per_s"))


@query("agg_rate_by_prefix", """SELECT split_part(topic, '/', 6) AS prefix, count(*) AS n, count(*) FILTER (WHERE payload = 'not json') AS bad, min(topic) AS example FROM M GROUP BY 1""")
def _(t: Tables) -> DataFrame:
    bad = F.count_if(F.try_parse_json("payload").isNull())
    return t.messages.groupBy(F.get(F.split("topic", "/"), F.lit(5)).alias("prefix")).agg(F.count("*").alias("n"), bad.alias("bad"), F.min("topic").alias("example"))


# ---- sort, limit, top-k
@query("topk_recent", f"SELECT seq, us, unit_id FROM P WHERE us BETWEEN {T0} AND {T1} ORDER BY us DESC, seq DESC LIMIT 1000")
def _(t: Tables) -> DataFrame:
    return R.history(t.points, "us", T0, T1, 1_000, order=["seq"]).select("seq", "us", "unit_id")


@query("topk_oldest", f"SELECT seq, us, unit_id FROM P WHERE us BETWEEN {T0} AND {T1} ORDER BY us, seq LIMIT 500")
def _(t: Tables) -> DataFrame:
    return R.history(t.points, "us", T0, T1, 500, newest=False, order=["seq"]).select("seq", "us", "unit_id")


@query("topk_cell_history", "SELECT us, tie, voltage FROM C WHERE site_id = 1 AND rack_id = 1 AND cell_id = 1 ORDER BY us DESC, tie DESC, part DESC, power DESC LIMIT 300")
def _(t: Tables) -> DataFrame:
    rows = R.with_tags(t.cells, {"site_id": 1, "rack_id": 1, "cell_id": 1})
    return rows.orderBy(*[F.desc(c) for c in ("us", *TIES)]).limit(300).select("us", "tie", "voltage")


@query("series_points", f"SELECT unit_id, us, value_f AS value, 'float' AS dtype FROM P WHERE point_name = 'view' AND us BETWEEN {T0} AND {T1} ORDER BY us LIMIT 2000")
def _(t: Tables) -> DataFrame:
    return R.series_points(t.points, "us", "view", T0, T1).select("unit_id", "us", "value", "dtype")


_SORTED = "SELECT seq, CASE WHEN value_i % 5 = 0 THEN NULL ELSE us END AS us FROM P"


@query("sort_nulls_last", _SORTED)
@query("sort_nulls_last_all", _SORTED)
def _(t: Tables) -> DataFrame:
    return t.points.select("seq", F.when(F.col("value_i") % 5 != 0, F.col("us")).alias("us")).orderBy(F.col("us").asc_nulls_last(), "seq")


@query("sample_stride", """, N AS (SELECT *, row_number() OVER (PARTITION BY point_name ORDER BY us, seq) - 1 AS i, count(*) OVER (PARTITION BY point_name) AS n FROM P)
SELECT seq, point_name FROM N WHERE i % greatest(1, n // 200) = 0""")
def _(t: Tables) -> DataFrame:
    return R.sample_stride(t.points, ["point_name"], ["us", "seq"]).select("seq", "point_name")


# ---- sets and reshaping
@query("union_all_byname", "SELECT unit_id, us, value_f, NULL::BIGINT AS value_i FROM P WHERE point_name = 'error' UNION ALL SELECT unit_id, us, NULL, value_i FROM P WHERE point_name = 'signup'")
def _(t: Tables) -> DataFrame:
    return R.union_by_name(t.points.where("point_name = 'error'").select("unit_id", "us", "value_f"), t.points.where("point_name = 'signup'").select("value_i", "us", "unit_id"))


@query("union_sources", "SELECT 'battery' AS source, site_id, us FROM C WHERE voltage > 4000 UNION ALL SELECT 'solar', site_id, us FROM C WHERE power > 5000000")
def _(t: Tables) -> DataFrame:
    side = lambda name, cond: t.cells.where(cond).select(F.lit(name).alias("source"), "site_id", "us")
    return side("battery", "voltage > 4000").unionAll(side("solar", "power > 5000000"))


_POINTS = ["click", "error", "purchase", "signup", "view"]


@query("pivot_device", """, R AS (SELECT *, row_number() OVER (PARTITION BY unit_id, us // 86400000000, point_name ORDER BY seq) AS rn FROM P)
SELECT unit_id, us // 86400000000 AS day, """ + ", ".join(f"max(CASE WHEN rn = 1 AND point_name = '{p}' THEN value_f END) AS {p}" for p in _POINTS) + " FROM R GROUP BY ALL")
def _(t: Tables) -> DataFrame:
    rows = t.points.withColumn("day", F.expr("us div 86400000000"))
    return S.to_wide(rows, ["unit_id", "day"], "point_name", "value_f", _POINTS, ["seq"], last=False)


_SIGNALS = {p: f"{'bms_1' if p in ('click', 'view') else 'pcs_1'}__{p}" for p in _POINTS}


_PIVOT = """, R AS (SELECT *, row_number() OVER (PARTITION BY us // 3600000000, unit_id, point_name ORDER BY seq DESC) AS rn FROM P)
SELECT unit_id, us // 3600000000 AS hour, """ + ", ".join(f"max(CASE WHEN rn = 1 AND point_name = '{p}' THEN value_f END) AS {s}" for p, s in _SIGNALS.items()) + " FROM R GROUP BY ALL"


@query("pivot_all", _PIVOT)
@query("pivot_all_units", _PIVOT)
def _(t: Tables) -> DataFrame:
    signal = F.concat(F.when(F.col("point_name").isin("view", "click"), "bms_1__").otherwise("pcs_1__"), "point_name")
    rows = t.points.select("unit_id", F.expr("us div 3600000000").alias("hour"), signal.alias("signal"), "value_f", "seq")
    return S.to_wide(rows, ["unit_id", "hour"], "signal", "value_f", list(_SIGNALS.values()), ["seq"])


@query("pivot_fields", "SELECT unit_id, us, " + ", ".join(f"max(CASE WHEN point_name = '{p}' THEN value_i END) AS {p}" for p in _POINTS) + " FROM P GROUP BY ALL")
def _(t: Tables) -> DataFrame:
    return S.to_wide(t.points, ["unit_id", "us"], "point_name", "value_i", _POINTS)


@query("pivot_dtype", "SELECT seq, max(CASE WHEN topic LIKE '%/float' THEN value_i END) AS \"float\", max(CASE WHEN topic LIKE '%/integer' THEN value_i END) AS \"integer\", max(CASE WHEN topic LIKE '%/string' THEN value_i END) AS \"string\" FROM M GROUP BY seq")
def _(t: Tables) -> DataFrame:
    rows = t.messages.withColumn("dtype", F.element_at(F.split("topic", "/"), -1))
    return S.to_wide(rows, ["seq"], "dtype", "value_i", ["float", "integer", "string"])


_SPARSE = "SELECT unit_id, us // 3600000000 AS hour, seq, CASE WHEN point_name IN ('view', 'error') THEN value_f END AS a, CASE WHEN point_name IN ('click', 'error') THEN value_i END AS b FROM P"


@query("pivot_merge_ts", f""", W AS ({_SPARSE}), R AS (SELECT *, row_number() OVER (PARTITION BY unit_id, hour, a IS NULL ORDER BY seq DESC) AS ra, row_number() OVER (PARTITION BY unit_id, hour, b IS NULL ORDER BY seq DESC) AS rb FROM W)
SELECT unit_id, hour, max(CASE WHEN ra = 1 THEN a END) AS a, max(CASE WHEN rb = 1 THEN b END) AS b FROM R GROUP BY ALL""")
def _(t: Tables) -> DataFrame:
    rows = t.points.select(
        "unit_id", F.expr("us div 3600000000").alias("hour"), "seq", F.when(F.col("point_name").isin("view", "error"), F.col("value_f")).alias("a"),
        F.when(F.col("point_name").isin("click", "error"), F.col("value_i")).alias("b"),
    )
    return S.merge_rows(rows, ["unit_id", "hour"], ["seq"], ["a", "b"])


@query("unpivot", "SELECT us, tie, part, 'voltage' AS name, voltage AS value FROM C UNION ALL SELECT us, tie, part, 'soc', soc FROM C")
def _(t: Tables) -> DataFrame:
    return S.to_long(t.cells, ["us", "tie", "part"], ["voltage", "soc"])


_SPLIT = "SELECT us, tie, voltage, power, NULL::DOUBLE AS temperature, NULL::DOUBLE AS soc FROM C UNION ALL SELECT us, tie, NULL, NULL, temperature, soc FROM C"


@query("split_fast_slow", _SPLIT)
@query("split_fast_slow_all", _SPLIT)
def _(t: Tables) -> DataFrame:
    parts = S.split_by_class(t.cells.select("us", "tie", "voltage", "power", "temperature", "soc"), ["us", "tie"], {"fast": ["v*", "p*"]}, "slow")
    return R.union_by_name(parts["fast"], parts["slow"])


@query("long_per_field", "SELECT us, tie, part, 'voltage' AS field, round(voltage / 1000, 6) AS value FROM C WHERE voltage > 4000 UNION ALL SELECT us, tie, part, 'power', round(power / 100, 6) FROM C WHERE voltage > 4000")
def _(t: Tables) -> DataFrame:
    rows = t.cells.where("voltage > 4000").select("us", "tie", "part", F.round(F.col("voltage") / 1000, 6).alias("voltage"), F.round(F.col("power") / 100, 6).alias("power"))
    return S.to_long(rows, ["us", "tie", "part"], ["voltage", "power"], "field", "value")


# ---- quality
@query("dq_cv", "SELECT point_name, count(value_f) AS n, avg(value_f) AS mean, round(stddev_samp(value_f), 4) AS sd FROM P GROUP BY point_name HAVING stddev_samp(value_f) > 0")
def _(t: Tables) -> DataFrame:
    return Q.noise_cv(t.points, "point_name", "value_f", 1_000).select("point_name", "n", "mean", F.round("sd", 4).alias("sd"))


@query("dq_nulls", "SELECT 'maybe' AS \"column\", count(*) FILTER (WHERE value_i % 9 = 0) AS nulls FROM P")
def _(t: Tables) -> DataFrame:
    return Q.null_counts(t.points.withColumn("maybe", F.when(F.col("value_i") % 9 != 0, 1)))


@query("dq_dupes", ", K AS (SELECT us, site_id, rack_id, cell_id, count(*) AS n FROM C GROUP BY ALL) SELECT CAST(sum(n) AS BIGINT) AS total, count(*) AS \"distinct\", CAST(sum(n) - count(*) AS BIGINT) AS duplicates FROM K")
def _(t: Tables) -> DataFrame:
    return Q.duplicates(t.cells, ["us", "site_id", "rack_id", "cell_id"])


@query("dq_partition_date")
def _(t: Tables) -> DataFrame:
    from ..sources import with_event_date, write_store
    from .ingest_queries import scratch

    path = scratch(t.spark)
    write_store(with_event_date(t.table("events")), path, ("date",))
    per = t.spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("file")).agg(F.to_date(F.min("ts")).alias("first"), F.to_date(F.max("ts")).alias("last"))
    return per.withColumn("folder", F.regexp_extract("file", r"date=(\d{4}-\d{2}-\d{2})", 1)).withColumn("ok", F.coalesce((F.col("first") == F.col("folder").try_cast("date")) & (F.col("last") == F.col("first")), F.lit(False)))


@query("dq_has_rows", "SELECT count(*) AS n, count(*) > 0 AS ok FROM P")
def _(t: Tables) -> DataFrame:
    return t.points.agg(F.count("*").alias("n")).withColumn("ok", F.col("n") > 0)


@query("dq_readable", "SELECT 'has_rows' AS \"check\", count(*) > 0 AS ok, count(*) AS detail FROM P UNION ALL SELECT 'no_nulls', count(*) FILTER (WHERE seq IS NULL) = 0, count(*) FILTER (WHERE seq IS NULL) FROM P UNION ALL SELECT 'no_duplicates', count(*) = count(DISTINCT seq), count(*) - count(DISTINCT seq) FROM P")
def _(t: Tables) -> DataFrame:
    return Q.validate(t.points, ["seq"])


@query("dq_cross_counts", """, N AS (SELECT 'all' AS store, count(*) AS rows FROM P UNION ALL SELECT 'most', count(*) FROM P WHERE value_i <> 1)
SELECT store, rows, ((SELECT max(rows) FROM N) - (SELECT min(rows) FROM N)) / CAST((SELECT max(rows) FROM N) AS DOUBLE) AS spread, ((SELECT max(rows) FROM N) - (SELECT min(rows) FROM N)) / CAST((SELECT max(rows) FROM N) AS DOUBLE) <= 0.01 AS ok FROM N""")
def _(t: Tables) -> DataFrame:
    return Q.cross_counts({"all": t.points, "most": t.points.where("value_i <> 1")})


@query("dq_count_compare", f"SELECT count(*) AS a, count(*) FILTER (WHERE value_i <> 1) AS b, count(*) - count(*) FILTER (WHERE value_i <> 1) AS delta, count(*) = count(*) FILTER (WHERE value_i <> 1) AS same FROM P WHERE us BETWEEN {T0} AND {T1}")
def _(t: Tables) -> DataFrame:
    rows = R.in_range(t.points, "us", T0, T1)
    both = rows.agg(F.count("*").alias("a")).crossJoin(rows.where("value_i <> 1").agg(F.count("*").alias("b")))
    return both.select("a", "b", (F.col("a") - F.col("b")).alias("delta"), (F.col("a") == F.col("b")).alias("same"))


@query("dq_stale_cells", f", A AS (SELECT max(us) AS now FROM P) SELECT unit_id, max(us) AS last_us FROM P, A GROUP BY unit_id, now HAVING now - max(us) > {12 * HOUR}")
def _(t: Tables) -> DataFrame:
    now = t.points.agg(F.max("us")).first()[0]
    return Q.stale(t.points, ["unit_id"], "us", now or 0, 12 * HOUR)


@query("anti_stale", f""", S AS (SELECT s_suppkey AS unit_id, s_name FROM supplier), L AS (SELECT CAST(unit_id AS BIGINT) AS unit_id, max(us) AS last_us FROM P GROUP BY 1)
SELECT S.unit_id, L.last_us FROM S LEFT JOIN L USING (unit_id) WHERE L.last_us IS NULL OR (SELECT max(us) FROM P) - L.last_us > {6 * HOUR}""")
def _(t: Tables) -> DataFrame:
    seen = t.points.withColumn("unit_id", F.col("unit_id").cast("long"))
    now = t.points.agg(F.max("us")).first()[0]
    return Q.stale(seen, ["unit_id"], "us", now or 0, 6 * HOUR, t.table("supplier").select(F.col("s_suppkey").alias("unit_id")))


@query("dq_schema_drift")
def _(t: Tables) -> DataFrame:
    return R.schema_drift(t.table("events"), ["event_id", "ts", "user_id", "value"])


@query("dq_health_grade", "SELECT unit_id, CASE WHEN (SELECT max(us) FROM P) - max(us) < 3600000000 THEN 'green' WHEN (SELECT max(us) FROM P) - max(us) < 43200000000 THEN 'amber' ELSE 'red' END AS grade FROM P GROUP BY unit_id")
def _(t: Tables) -> DataFrame:
    per = t.points.groupBy("unit_id").agg(F.max("us").alias("last"))
    aged = per.crossJoin(F.broadcast(per.agg(F.max("last").alias("now")))).withColumn("age", F.col("now") - F.col("last"))
    return aged.select("unit_id", Q.health_grade(F.col("age"), [(HOUR, "green"), (12 * HOUR, "amber")], "red").alias("grade"))


_FAULTS = [("view", ">", 4500.0, "overtemp"), ("click", "<", 300.0, "low_soc"), ("error", "<", 280.0, "undervolt")]


@query("dq_fault_flags", """, L AS (SELECT *, row_number() OVER (PARTITION BY unit_id, point_name ORDER BY us DESC, seq DESC) AS rn FROM P), F AS (SELECT * FROM (VALUES ('view', '>', 4500.0, 'overtemp'), ('click', '<', 300.0, 'low_soc'), ('error', '<', 280.0, 'undervolt')) AS v(point_name, op, lim, fault))
SELECT unit_id, point_name, fault, value_f AS value FROM L JOIN F USING (point_name) WHERE rn = 1 AND CASE WHEN op = '>' THEN value_f > lim ELSE value_f < lim END""")
def _(t: Tables) -> DataFrame:
    last = R.latest(t.points, ["unit_id", "point_name"], "us", ["value_f"], order=["seq"]).withColumnRenamed("value_f", "value")
    rules = t.spark.createDataFrame(_FAULTS, "point_name string, op string, limit double, fault string")
    return Q.fault_flags(last, rules).select("unit_id", "point_name", "fault", "value")


@query("dq_soc_imbalance", f", L AS (SELECT *, row_number() OVER (PARTITION BY site_id, rack_id {LAST}) AS rn FROM C) SELECT site_id, max(soc) - min(soc) AS spread FROM L WHERE rn = 1 GROUP BY site_id HAVING max(soc) - min(soc) > 50")
def _(t: Tables) -> DataFrame:
    return Q.imbalance(R.latest(t.cells, ["site_id", "rack_id"], "us", ["soc"], order=TIES), ["site_id"], "soc", 50)


def _figures(side: str, where: str) -> str:
    rows = f"(SELECT * FROM C WHERE {where})"
    last = f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY site_id, rack_id, cell_id {LAST}) AS rn FROM {rows}) WHERE rn = 1)"
    return f""", {side} AS (SELECT 'current' AS "check", '0/0/1' AS key, CAST(voltage AS DOUBLE) AS v, 0.001 AS tol FROM {last} WHERE site_id = 0 AND rack_id = 0 AND cell_id = 1
UNION ALL SELECT 'count', CAST(site_id AS VARCHAR), count(*), 0 FROM {rows} GROUP BY site_id
UNION ALL SELECT 'alerts', 'all', count(*) FILTER (WHERE voltage < 3200 OR voltage > 4100), 0 FROM {last}
UNION ALL SELECT 'mean', CAST(rack_id AS VARCHAR), avg(voltage), 0.05 FROM {rows} WHERE site_id = 0 AND us > (SELECT max(us) FROM {rows}) - {365 * DAY} GROUP BY rack_id)"""


@query("dq_migration_four", _figures("A", "TRUE") + _figures("B", "site_id <> 4 AND power > 100000") + """
SELECT coalesce(A."check", B."check") AS "check", coalesce(A.key, B.key) AS key, round(A.v, 6) AS a, round(B.v, 6) AS b, CASE WHEN A.key IS NULL OR B.key IS NULL THEN 'MISSING' WHEN abs(A.v - B.v) <= coalesce(A.tol, B.tol) THEN 'OK' ELSE 'DIFF' END AS status
FROM A FULL JOIN B ON A."check" = B."check" AND A.key = B.key""")
def _(t: Tables) -> DataFrame:
    moved = t.cells.where("site_id <> 4 and power > 100000")
    cell = ["site_id", "rack_id", "cell_id"]
    out = Q.migration_checks(t.cells, moved, "us", "voltage", "site_id", "rack_id", cell, {"site_id": 0, "rack_id": 0, "cell_id": 1}, 3200, 4100, 365 * DAY, TIES)
    return out.select("check", "key", F.round("a", 6).alias("a"), F.round("b", 6).alias("b"), "status")


@query("dq_migration_checks", f""", A AS (SELECT site_id, avg(voltage) AS v, count(*) AS n FROM C GROUP BY site_id), B AS (SELECT site_id, avg(voltage) AS v, count(*) AS n FROM C WHERE site_id <> 4 AND power > 100000 GROUP BY site_id)
SELECT coalesce(A.site_id, B.site_id) AS site_id, CASE WHEN A.site_id IS NULL OR B.site_id IS NULL THEN 'MISSING' WHEN abs(A.v - B.v) <= 0.5 THEN 'OK' ELSE 'DIFF' END AS mean_status, CASE WHEN A.site_id IS NULL OR B.site_id IS NULL THEN 'MISSING' WHEN A.n = B.n THEN 'OK' ELSE 'DIFF' END AS count_status FROM A FULL JOIN B ON A.site_id = B.site_id""")
def _(t: Tables) -> DataFrame:
    side = lambda df: df.groupBy("site_id").agg(F.avg("voltage").alias("v"), F.count("*").alias("n"))
    a, b = side(t.cells), side(t.cells.where("site_id <> 4 and power > 100000"))
    mean = J.compare(a, b, ["site_id"], ["v"], 0.5).withColumnRenamed("status", "mean_status")
    return mean.join(J.compare(a, b, ["site_id"], ["n"]).withColumnRenamed("status", "count_status"), "site_id")
