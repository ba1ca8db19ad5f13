"""Parsing of topics and payloads, sinks, compaction, streams."""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import streaming as ST
from ..functions import parse as X
from ..functions.time import from_micros, iso_time, micros
from ..operators import query as R
from ..operators import shape as S
from ..sources import KeyedTable, compact, layout_sizes, open_folders, publish_hot, read_hot, with_event_date, write_store
from .registry import Tables, query, scratch
from .series_queries import RULES, _walk
from .table_queries import DAY, HOUR


# ---- topics
@query("topic_kv", "SELECT seq, 'src' AS source_type, CAST(unit_id AS BIGINT) % 5 AS site, CAST(unit_id AS BIGINT) AS unit, NULL::BIGINT AS x, point_name AS field_name FROM M")
def _(t: Tables) -> DataFrame:
    k = X.topic_kv(F.col("kv"))
    rows = t.messages.select("seq", k["source_type"].alias("source_type"), k["ints"].alias("ints"), k["field_name"].alias("field_name"))
    return rows.select("seq", "source_type", *[F.col("ints")[n].alias(n) for n in ("site", "unit", "x")], "field_name")


@query("topic_positional", "SELECT seq, split_part(topic, '/', 3) AS site_id, unit_id, split_part(topic, '/', 6) AS device, point_name, NULL::VARCHAR AS extra FROM M")
def _(t: Tables) -> DataFrame:
    names = ["_", "_", "site_id", "_", "unit_id", "device", "_", "point_name", "_", "extra"]
    return t.messages.drop("unit_id", "point_name").select("seq", *[c.alias(n) for n, c in X.topic_positional(F.col("topic"), names).items()])


PATTERNS = [
    {"match": "ems/site/+/unit/+/bms/#", "segments": ["device", "instance", "point", "dtype"], "reverse": True},
    {"match": "ems/site/+/unit/+/+/+/+/+", "segments": ["_", "_", "site", "_", "unit", "device"]},
]


@query("topic_patterns", """SELECT seq, CASE WHEN topic LIKE '%/bms/%' THEN 'ems/site/+/unit/+/bms/#' ELSE 'ems/site/+/unit/+/+/+/+/+' END AS pattern, CASE WHEN topic LIKE '%/bms/%' THEN NULL ELSE split_part(topic, '/', 3) END AS site,
CASE WHEN topic LIKE '%/bms/%' THEN NULL ELSE unit_id END AS unit, split_part(topic, '/', 6) AS device, CASE WHEN topic LIKE '%/bms/%' THEN point_name END AS point FROM M""")
def _(t: Tables) -> DataFrame:
    return X.topic_patterns(t.messages, "topic", PATTERNS).select("seq", "pattern", "site", "unit", "device", "point")


@query("topic_unmatched", "SELECT 9 AS depth, 'ems' AS prefix, min(topic) AS example, count(*) AS n FROM M WHERE topic LIKE '%/pcs/%'")
def _(t: Tables) -> DataFrame:
    return X.unmatched_topics(t.messages, "topic", ["ems/site/+/unit/+/bms/#"])


@query("topic_to_measurement", "SELECT split_part(topic, '/', 6) || '_' || point_name AS measurement, split_part(topic, '/', 3) AS site, count(*) AS n FROM M GROUP BY 1, 2")
def _(t: Tables) -> DataFrame:
    names = {"match": "ems/site/+/unit/+/+/+/+/+", "segments": ["_", "_", "site", "_", "unit", "device", "_", "point"]}
    rows = X.topic_patterns(t.messages, "topic", [names])
    return rows.groupBy(F.concat_ws("_", "device", "point").alias("measurement"), "site").agg(F.count("*").alias("n"))


@query("topic_rename", "SELECT seq, replace(topic, '/', '.') AS subject FROM M")
def _(t: Tables) -> DataFrame:
    return t.messages.select("seq", F.replace("topic", F.lit("/"), F.lit(".")).alias("subject"))


GROUPS = {"battery": ["ems/site/+/unit/+/bms/#"], "errors": ["ems/site/+/unit/+/+/+/error/+"], "all": ["#"]}


@query("topic_group_select", "SELECT seq, topic FROM M WHERE topic LIKE '%/bms/%' OR topic LIKE '%/error/%'")
def _(t: Tables) -> DataFrame:
    return X.select_topics(t.messages, "topic", GROUPS, ["battery", "errors"]).select("seq", "topic")


@query("st_topic_select", "SELECT seq, topic FROM M WHERE topic LIKE '%/bms/%'")
def _(t: Tables) -> DataFrame:
    path = scratch(t.spark)
    t.messages.select("seq", "topic").repartition(4).write.parquet(f"{path}/in")
    stream = t.spark.readStream.schema("seq long, topic string").option("maxFilesPerTrigger", 2).parquet(f"{path}/in")
    live = X.topic_chosen("topic", GROUPS, ["battery"])
    ST.route(stream, {f"{path}/store": F.lit(True), f"{path}/live": live}, f"{path}/checkpoint").awaitTermination()
    return t.spark.read.parquet(f"{path}/live").select("seq", "topic")


@query("point_registry", ", N AS (SELECT DISTINCT point_name FROM P) SELECT point_name, lpad(lower(to_hex(row_number() OVER (ORDER BY point_name) - 1)), 4, '0') AS id FROM N")
def _(t: Tables) -> DataFrame:
    return S.point_registry(t.points, "point_name")


@query("topic_template", "SELECT CASE WHEN split_part(topic, '/', 3) = 'S1' THEN 'kept' ELSE 'site' END AS reason, count(*) AS n, count(DISTINCT unit_id) AS units, count(DISTINCT split_part(topic, '/', 6) || point_name) AS points FROM M GROUP BY 1")
def _(t: Tables) -> DataFrame:
    return S.topic_template(t.messages, "topic", "S1")


@query("seen_topics", "SELECT DISTINCT regexp_replace(topic, '/[^/]*$', '') AS topic FROM M ORDER BY 1 LIMIT 200")
def _(t: Tables) -> DataFrame:
    return t.messages.select(F.regexp_replace("topic", "/[^/]*$", "").alias("topic")).distinct().orderBy("topic").limit(200)


# ---- payloads
_VALUE = "CASE WHEN payload <> 'not json' THEN value_i END"


@query("json_flat", "SELECT seq, CAST(CASE WHEN payload <> 'not json' THEN us END AS DOUBLE) AS us_f, 0 AS strings FROM M WHERE payload <> 'not json'")
def _(t: Tables) -> DataFrame:
    rows = t.messages.withColumns(X.flat_fields(F.col("payload"))).where("floats is not null and payload <> 'not json'")
    return rows.select("seq", F.col("floats")["us"].alias("us_f"), F.size("strings").alias("strings"))


@query("json_value_unit", f"SELECT seq, {_VALUE} AS value FROM M")
def _(t: Tables) -> DataFrame:
    return t.messages.select("seq", X.json_value(F.col("payload"), "value").try_cast("long").alias("value"))


@query("json_bad", "SELECT seq, topic, value_i AS value FROM M WHERE payload <> 'not json'")
def _(t: Tables) -> DataFrame:
    out = X.parse_payload(t.messages.select("seq", "topic", "payload"), "payload", {"value": "long"}, "us", "epoch", "drop")
    return out.select("seq", "topic", "value")


@query("ts_iso8601", "SELECT seq, CASE WHEN value_i % 10 = 0 THEN NULL WHEN value_i % 10 = 1 THEN us // 1000000 * 1000000 ELSE us END AS us FROM P")
def _(t: Tables) -> DataFrame:
    text = F.date_format(F.timestamp_micros("us"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    text = F.when(F.col("value_i") % 10 == 0, F.lit("garbage-that-is-long-enough")).when(F.col("value_i") % 10 == 1, F.concat(F.substring(text, 1, 19), F.lit("Z"))).otherwise(F.concat(text, F.lit("Z")))
    zone = t.spark.conf.get("spark.sql.session.timeZone")
    rows = t.points.select("seq", F.when(F.lit(zone) == "UTC", text).otherwise(text).alias("text"))
    return rows.select("seq", F.unix_micros(iso_time(F.col("text"))).alias("us"))


@query("ts_epoch", "SELECT seq, CASE WHEN value_i % 2 = 0 THEN us ELSE us // 1000000 * 1000000 END AS us FROM P")
def _(t: Tables) -> DataFrame:
    from ..functions.time import epoch_time

    number = F.when(F.col("value_i") % 2 == 0, F.col("us").cast("string")).otherwise(F.concat(F.expr("us div 1000000").cast("string"), F.lit(".0")))
    return t.points.select("seq", F.unix_micros(epoch_time(number)).alias("us"))


@query("coerce_ids", "SELECT seq, CASE WHEN value_i % 4 <> 0 THEN value_i END AS rack_id, value_f / 4 AS voltage, 0::BIGINT AS project_id FROM P")
def _(t: Tables) -> DataFrame:
    raw = t.points.select("seq", F.when(F.col("value_i") % 4 == 0, "x").otherwise(F.col("value_i").cast("string")).alias("rack_id"), (F.col("value_f") / 4).cast("string").alias("voltage"))
    return X.coerce(raw, ["rack_id", "project_id"], ["voltage"]).select("seq", "rack_id", "voltage", "project_id")


_KIND = "CASE point_name WHEN 'error' THEN 'string' WHEN 'signup' THEN 'integer' ELSE 'float' END"


def _kinds(t: Tables) -> DataFrame:
    kind = F.when(F.col("point_name") == "error", "string").when(F.col("point_name") == "signup", "integer").otherwise("float")
    return t.points.select("seq", "point_name", kind.alias("dtype"), F.col("value_i").cast("string").alias("raw"))


@query("value_split", f"SELECT seq, CASE WHEN {_KIND} = 'integer' THEN value_i END AS value_i, CASE WHEN {_KIND} = 'float' THEN CAST(value_i AS DOUBLE) END AS value_f FROM P")
def _(t: Tables) -> DataFrame:
    v = X.split_value(F.col("raw"), F.col("dtype"))
    return _kinds(t).select("seq", v["value_i"].alias("value_i"), v["value_f"].alias("value_f"))


@query("value_coalesce", "SELECT seq, CASE WHEN value_i % 2 = 0 THEN value_f ELSE CAST(value_i AS DOUBLE) END AS value, CASE WHEN value_i % 2 = 0 THEN 'float' ELSE 'integer' END AS dtype FROM P")
def _(t: Tables) -> DataFrame:
    rows = t.points.withColumn("value_f", F.when(F.col("value_i") % 2 == 0, F.col("value_f")))
    return rows.select("seq", *[c.alias(n) for n, c in X.value_of().items()])


@query("value_str_rename", f"SELECT seq, CASE WHEN {_KIND} = 'string' THEN CAST(value_i AS VARCHAR) END AS value_str FROM P")
def _(t: Tables) -> DataFrame:
    return _kinds(t).select("seq", X.split_value(F.col("raw"), F.col("dtype"))["value_str"].alias("value_str"))


@query("field_rename", "SELECT seq, CASE WHEN point_name = 'view' THEN value_f END AS view, CASE WHEN point_name = 'click' THEN value_f END AS click FROM P WHERE point_name IN ('view', 'click')")
def _(t: Tables) -> DataFrame:
    return S.to_wide(t.points.where("point_name in ('view', 'click')"), ["seq"], "point_name", "value_f", ["view", "click"])


@query("compound_point", "SELECT seq, split_part(topic, '/', 6) || '/' || split_part(topic, '/', 7) || '/' || point_name AS point_name FROM M")
def _(t: Tables) -> DataFrame:
    seg = X.topic_positional(F.col("topic"), ["_", "_", "_", "_", "_", "device", "instance"])
    return X.compound(t.messages.withColumns(seg), ["device", "instance", "point_name"]).select("seq", "point_name")


@query("compound_field", "SELECT us // 86400000000 AS day, max(CASE WHEN point_name = 'view' THEN value_i END) AS \"bms/view\", max(CASE WHEN point_name = 'error' THEN value_i END) AS \"pcs/error\" FROM M GROUP BY 1")
def _(t: Tables) -> DataFrame:
    seg = X.topic_positional(F.col("topic"), ["_", "_", "_", "_", "_", "device"])
    rows = X.compound(t.messages.withColumns(seg), ["device", "point_name"]).withColumn("day", F.expr("us div 86400000000"))
    return S.to_wide(rows, ["day"], "point_name", "value_i", ["bms/view", "pcs/error"])


@query("drop_points", "SELECT seq FROM P WHERE point_name NOT IN ('error', 'signup')")
def _(t: Tables) -> DataFrame:
    return t.points.where(~F.col("point_name").isin("error", "signup")).select("seq")


@query("drop_cols", "SELECT seq, us, unit_id, point_name FROM P")
def _(t: Tables) -> DataFrame:
    return t.points.drop("value_f", "value_i")


@query("inject_site", "SELECT seq, CASE WHEN point_name = 'view' THEN 'S' || unit_id ELSE 'S0' END AS site_id FROM P")
def _(t: Tables) -> DataFrame:
    own = F.when(F.col("point_name") == "view", F.concat(F.lit("S"), "unit_id"))
    return t.points.select("seq", F.coalesce(own, F.lit("S0")).alias("site_id"))


@query("add_meta", "SELECT seq, topic AS mqtt_topic, 1::BIGINT AS sample_count, 0::BIGINT AS project_id FROM M")
def _(t: Tables) -> DataFrame:
    return t.messages.select("seq", F.col("topic").alias("mqtt_topic"), F.lit(1).cast("long").alias("sample_count"), F.lit(0).cast("long").alias("project_id"))


@query("derive_power", "SELECT us, tie, voltage * (soc - 25) AS power FROM C")
def _(t: Tables) -> DataFrame:
    return t.cells.select("us", "tie", (F.col("voltage") * (F.col("soc") - 25)).alias("power"))


@query("dq_payload_format", "SELECT CASE WHEN payload = 'not json' THEN 'unknown' WHEN payload LIKE '%unit%' THEN 'nested' ELSE 'flat' END AS layout, payload <> 'not json' AS identified, count(*) AS n FROM M GROUP BY ALL")
def _(t: Tables) -> DataFrame:
    rows = t.messages.select(*[c.alias(n) for n, c in X.classify_payload(F.col("payload"), ["us"]).items()])
    return rows.groupBy("layout", "identified").agg(F.count("*").alias("n"))


# ---- sinks: written, then read back
def _store(t: Tables, partitions=("site", "date"), codec: str = "zstd", template: str | None = None) -> str:
    from ..sources import partition_columns

    path = scratch(t.spark)
    rows = with_event_date(t.table("events").withColumn("site", F.col("user_id") % 3))
    write_store(rows, path, partition_columns(template) if template else partitions, codec)
    return path


_BY_DAY = "SELECT CAST(strftime(ts, '%Y-%m-%d') AS VARCHAR) AS date, user_id % 3 AS site, count(*) AS n, sum(event_id) AS ids FROM events GROUP BY ALL"


def _by_day(df: DataFrame) -> DataFrame:
    return df.groupBy(F.col("date").cast("string").alias("date"), F.col("site").cast("long").alias("site")).agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))


@query("sink_partitioned", _BY_DAY.replace("sum(event_id)", "CAST(sum(event_id) AS BIGINT)"))
def _(t: Tables) -> DataFrame:
    return _by_day(t.spark.read.parquet(_store(t)))


@query("sink_partition_template", _BY_DAY.replace("sum(event_id)", "CAST(sum(event_id) AS BIGINT)"))
def _(t: Tables) -> DataFrame:
    return _by_day(t.spark.read.parquet(_store(t, template="site={site}/{year}/{month}/{day}")))


@query("sink_codec", "SELECT 'zstd' AS layout, count(*) AS rows FROM events UNION ALL SELECT 'snappy', count(*) FROM events")
def _(t: Tables) -> DataFrame:
    return layout_sizes(t.spark, {c: _store(t, (), c) for c in ("zstd", "snappy")}).select("layout", "rows")


@query("agg_schema_compare")
def _(t: Tables) -> DataFrame:
    paths = {n: scratch(t.spark) for n in ("narrow", "compound", "wide")}
    write_store(t.points, paths["narrow"], ())
    write_store(X.compound(t.points, ["unit_id", "point_name"]), paths["compound"], ())
    write_store(S.to_wide(t.points, ["unit_id", "us"], "point_name", "value_f", order=["seq"]), paths["wide"], ())
    return layout_sizes(t.spark, paths)


@query("sink_hot", "SELECT seq, unit_id FROM P WHERE point_name = 'click'")
def _(t: Tables) -> DataFrame:
    path = scratch(t.spark)
    for name in ("view", "click"):
        publish_hot(t.points.where(F.col("point_name") == name), path)
    return read_hot(t.spark, path).select("seq", "unit_id")


_CURRENT = ", R AS (SELECT *, row_number() OVER (PARTITION BY unit_id, point_name ORDER BY us DESC, seq DESC) AS rn FROM P) SELECT unit_id, point_name, us, value_f FROM R WHERE rn = 1"


@query("sink_current_state", _CURRENT)
def _(t: Tables) -> DataFrame:
    table = KeyedTable(t.spark, scratch(t.spark), ["unit_id", "point_name"], "us", ["seq"], buckets=16)
    for k in range(3):  # batches out of order of time
        table.upsert(t.points.where(F.col("value_i") % 3 == k), k)
    return table.read().select("unit_id", "point_name", "us", "value_f")


def _small_files(t: Tables) -> str:
    path = scratch(t.spark)
    for k in range(3):
        rows = t.points.where(F.col("seq") % 3 == k).withColumn("maybe", F.when(F.col("value_i") % 2 == 0, 1))
        rows.coalesce(1).write.mode("append").parquet(path)
    return path


@query("compact_leaf", "SELECT CAST(count(*) AS BIGINT) AS rows, CAST(sum(seq) AS BIGINT) AS ids FROM P")
def _(t: Tables) -> DataFrame:
    path = _small_files(t)
    compact(t.spark, path)
    return t.spark.read.parquet(path).agg(F.count("*").alias("rows"), F.sum("seq").alias("ids"))


@query("compact_log", "SELECT 3::BIGINT AS files, count(*) AS rows, round(100.0 * count(*) FILTER (WHERE value_i % 2 <> 0) / (count(*) * 7), 6) AS null_pct, TRUE AS compacted FROM P")
def _(t: Tables) -> DataFrame:
    return compact(t.spark, _small_files(t)).select("files", "rows", F.round("null_pct", 6).alias("null_pct"), "compacted")


@query("compact_verify", "SELECT count(*) AS rows, 1::BIGINT AS files FROM P")
def _(t: Tables) -> DataFrame:
    path = _small_files(t)
    compact(t.spark, path, target_bytes=1 << 62)  # one file of any size
    return t.spark.read.parquet(path).agg(F.count("*").alias("rows"), F.countDistinct("_metadata.file_path").alias("files"))


@query("compact_cli", "SELECT 3::BIGINT AS files, count(*) AS rows, FALSE AS compacted FROM P")
def _(t: Tables) -> DataFrame:
    return compact(t.spark, _small_files(t), dry_run=True).select("files", "rows", "compacted")


@query("compact_inject_unit")
def _(t: Tables) -> DataFrame:
    path = scratch(t.spark)
    # files by unit, twenty units of all users; named for the unit in one folder, as Spark names no files
    units = t.table("events").withColumn("unit", F.concat(F.lit("u"), F.col("user_id") % 20))
    with open_folders(t.spark, 20):
        units.write.partitionBy("unit").parquet(f"{path}/by-unit")
    fs = t.spark._jvm.org.apache.hadoop.fs
    here = fs.Path(path).getFileSystem(t.spark._jsc.hadoopConfiguration())
    here.mkdirs(fs.Path(f"{path}/leaf"))
    for f in here.globStatus(fs.Path(f"{path}/by-unit/unit=*/part-*.parquet")):
        old = f.getPath()
        unit = old.getParent().getName().removeprefix("unit=")
        if not here.rename(old, fs.Path(f"{path}/leaf/{unit}_{old.getName()}")):
            raise RuntimeError(f"{old} was not moved")
    compact(t.spark, f"{path}/leaf", min_files=2, unit_from_name=True)
    return t.spark.read.parquet(f"{path}/leaf").select("event_id", "unit_id")


# ---- streams: the same tables by a file stream, read to their end
def _stream(t: Tables) -> DataFrame:
    schema = t.table("events").schema
    return t.spark.readStream.schema(schema).parquet(f"{t.sf_dir}/events.parque?")  # a glob may be one file or a folder


def _points(stream: DataFrame) -> DataFrame:
    return stream.select(
        F.col("event_id").alias("seq"), micros("ts").alias("us"), F.timestamp_micros(micros("ts")).alias("ts"), F.col("user_id").cast("string").alias("unit_id"),
        F.col("event_type").alias("point_name"), F.round(F.col("value") * 100).alias("value_f"),
    )


def _replay(t: Tables, parts: int = 4) -> DataFrame:
    """A stream of all points in several micro-batches, in order of time, and of one last row far in the future by which
    the windows of all others close; its own never does. It has a value, lest a filter takes it off, and no keys."""
    path, rows = scratch(t.spark), _points(t.table("events")).where("us is not null")
    cuts = rows.agg(F.percentile_approx("us", [k / parts for k in range(1, parts)]).alias("c"), F.max("us").alias("m")).first()
    edges = [None, *(cuts["c"] or []), None]
    for lo, hi in zip(edges, edges[1:]):
        part = rows if lo is None else rows.where(F.col("us") >= lo)
        (part if hi is None else part.where(F.col("us") < hi)).repartition(2).write.mode("append").parquet(path)
    end = F.timestamp_micros(F.lit((cuts["m"] or 0) + 1000 * DAY))
    clock = t.spark.range(1).select(*[(end if f.name == "ts" else F.lit(0 if f.name == "value_f" else None).cast(f.dataType)).alias(f.name) for f in rows.schema])
    clock.coalesce(1).write.mode("append").parquet(path)
    return t.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(path)


def _run(t: Tables, stream: DataFrame) -> DataFrame:
    """All rows that the stream appends."""
    path = scratch(t.spark)
    writer = stream.writeStream.option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True)
    writer.format("parquet").option("path", f"{path}/out").outputMode("append").start().awaitTermination()
    return t.spark.read.schema(stream.schema).parquet(f"{path}/out")


def _windows(df: DataFrame) -> DataFrame:
    return df.withColumn("us", F.unix_micros("window.start")).drop("window")


@query("st_tumbling", f"SELECT point_name, us // {DAY} * {DAY} AS us, count(*) AS n, avg(value_f) AS mean FROM P GROUP BY ALL")
def _(t: Tables) -> DataFrame:
    out = ST.tumbling(_replay(t), "ts", "1 day", ["point_name"], [F.count("*").alias("n"), F.avg("value_f").alias("mean")])
    return _windows(_run(t, out))


@query("st_rate", "SELECT us // 1000000 * 1000000 AS us, count(*) AS n FROM P GROUP BY 1")
def _(t: Tables) -> DataFrame:
    return _windows(_run(t, ST.message_rate(_replay(t), "ts")))


@query("st_rate_smooth", """, S AS (SELECT point_name, us // 1000000 * 1000000 AS us, count(*) AS n FROM P GROUP BY ALL), N AS (SELECT *, row_number() OVER (PARTITION BY point_name ORDER BY us) AS rn FROM S),
E AS (SELECT point_name, us, n, rn, 0.2::DOUBLE * n AS rate FROM N WHERE rn = 1 UNION ALL SELECT N.point_name, N.us, N.n, N.rn, 0.8::DOUBLE * E.rate + 0.2::DOUBLE * N.n FROM E JOIN N ON N.point_name = E.point_name AND N.rn = E.rn + 1)
SELECT point_name, us, n, round(CAST(rate AS DOUBLE), 6) AS rate FROM E""")
def _(t: Tables) -> DataFrame:
    return _run(t, ST.smoothed_rate(_replay(t), "ts", ["point_name"])).where("point_name is not null").withColumn("rate", F.round("rate", 6))


@query("st_coalesce", """, W AS (SELECT *, us // 600000000 AS slot FROM P), R AS (SELECT *, row_number() OVER (PARTITION BY unit_id, point_name, slot ORDER BY seq DESC) AS rn, min(us) OVER (PARTITION BY unit_id, point_name, slot) AS first_us FROM W)
SELECT unit_id, point_name, first_us AS us, value_f FROM R WHERE rn = 1""")
def _(t: Tables) -> DataFrame:
    out = ST.coalesce_stream(_replay(t), "ts", "10 minutes", ["unit_id", "point_name"], ["seq"], ["value_f"])
    return _run(t, out).select("unit_id", "point_name", F.unix_micros("ts").alias("us"), "value_f")


@query("st_cov", _walk(f"(N.us - Z.last_us >= {2 * DAY} OR abs(N.value_f - Z.last) >= CASE WHEN N.point_name = 'view' THEN 2000 WHEN N.point_name LIKE 'c%' THEN 500 ELSE 1000 END)"))
def _(t: Tables) -> DataFrame:
    out = ST.cov_stream(_points(_stream(t)).drop("ts"), ["unit_id", "point_name"], "us", "value_f", RULES, 1000.0, heartbeat_us=2 * DAY)
    return _run(t, out).select("seq")


@query("st_cov_counted", _walk("abs(N.value_f - Z.last) >= 3000").replace("SELECT seq FROM Z WHERE keep", """, G AS (SELECT Z.*, N.us, N.value_f, sum(CASE WHEN keep THEN 1 ELSE 0 END) OVER (PARTITION BY Z.unit_id, Z.point_name ORDER BY rn) AS run FROM Z JOIN N USING (unit_id, point_name, rn)),
K AS (SELECT unit_id, point_name, run, count(*) - 1 AS more, min(rn) AS a, max(rn) AS b FROM G GROUP BY ALL), L AS (SELECT *, lag(more, 1, 0) OVER w AS held, run = max(run) OVER (PARTITION BY unit_id, point_name) AS fin FROM K WINDOW w AS (PARTITION BY unit_id, point_name ORDER BY run))
SELECT L.unit_id, L.point_name, N.us, N.value_f AS value, L.held, FALSE AS timed FROM L JOIN N ON N.unit_id = L.unit_id AND N.point_name = L.point_name AND N.rn = L.a
UNION ALL SELECT L.unit_id, L.point_name, N.us, N.value_f, L.more, TRUE FROM L JOIN N ON N.unit_id = L.unit_id AND N.point_name = L.point_name AND N.rn = L.b WHERE L.fin AND L.more > 0"""))
def _(t: Tables) -> DataFrame:
    return _run(t, ST.counted_cov_stream(_replay(t), ["unit_id", "point_name"], "ts", "value_f", "500d", default=3000.0)).where("unit_id is not null")


@query("st_current_state", _CURRENT)
def _(t: Tables) -> DataFrame:
    path = scratch(t.spark)
    keys = ["unit_id", "point_name"]
    ST.current_state(_points(_stream(t)).drop("ts"), path, f"{path}/checkpoint", keys, "us", ["seq"], 16).awaitTermination()
    return KeyedTable(t.spark, path, keys, "us", ["seq"]).read().select("unit_id", "point_name", "us", "value_f")


@query("st_ingest", f"SELECT site, unit, device, point_name, value_i AS value, us FROM (SELECT *, split_part(topic, '/', 3) AS site, unit_id AS unit, split_part(topic, '/', 6) AS device FROM M) WHERE payload <> 'not json' AND point_name <> 'error'")
def _(t: Tables) -> DataFrame:
    path = scratch(t.spark)
    t.messages.select("topic", "payload").write.parquet(f"{path}/in")
    stream = t.spark.readStream.schema("topic string, payload string").parquet(f"{path}/in")
    names = {"match": "ems/site/+/unit/+/+/+/+/+", "segments": ["_", "_", "site", "_", "unit", "device", "_", "point_name"]}
    rows = stream.withColumn("payload", F.replace("payload", F.lit('"us"'), F.lit('"ts"')))
    ST.ingest(rows, f"{path}/out", f"{path}/checkpoint", [names], {"value": "long"}, "epoch", ("site", "date"), drop_points=["error"]).awaitTermination()
    return t.spark.read.parquet(f"{path}/out").select("site", "unit", "device", "point_name", "value", F.unix_micros("ts").alias("us"))


@query("sink_stream_flush", "SELECT count(*) AS n FROM M WHERE payload <> 'not json'")
def _(t: Tables) -> DataFrame:
    path = scratch(t.spark)
    tasks = max(1, t.spark.sparkContext.defaultParallelism)  # a file is few tasks' work: four batches, each of a file for each core
    t.messages.select("topic", "payload").repartition(4 * tasks).write.parquet(f"{path}/in")
    stream = t.spark.readStream.schema("topic string, payload string").option("maxFilesPerTrigger", tasks).parquet(f"{path}/in")
    ST.ingest(stream.withColumn("payload", F.replace("payload", F.lit('"us"'), F.lit('"ts"'))), f"{path}/out", f"{path}/checkpoint", [{"match": "#", "segments": ["a"]}], {"value": "long"}, "epoch", ("date",)).awaitTermination()
    return t.spark.read.parquet(f"{path}/out").agg(F.count("*").alias("n"))


@query("st_late", "SELECT CAST(strftime(ts, '%Y-%m-%d') AS VARCHAR) AS date, count(*) AS n FROM events GROUP BY 1")
def _(t: Tables) -> DataFrame:
    path = scratch(t.spark)
    rows = with_event_date(_stream(t))
    rows.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/c").partitionBy("date").trigger(availableNow=True).start().awaitTermination()
    return t.spark.read.parquet(f"{path}/out").groupBy(F.col("date").cast("string").alias("date")).agg(F.count("*").alias("n"))


@query("st_sync_check", f""", H AS (SELECT (us // {DAY} + 1) * {DAY} - 1 AS us, count(*) AS n FROM P GROUP BY 1), T AS (SELECT us, CAST(sum(n + 1) OVER (ORDER BY us) AS BIGINT) AS total, CAST(sum(n) OVER (ORDER BY us) AS BIGINT) AS got FROM H), B AS (SELECT *, row_number() OVER (ORDER BY us) AS rn, first_value(total) OVER (ORDER BY us) AS t0, first_value(got) OVER (ORDER BY us) AS g0 FROM T)
SELECT 's' AS session_id, us, total - t0 AS published, got - g0 AS received, total - t0 - got + g0 AS loss FROM B WHERE rn > 1""")
def _(t: Tables) -> DataFrame:
    from pyspark.sql.window import Window

    path = scratch(t.spark)
    rows = t.points.select(F.lit("s").alias("session_id"), F.lit("row").alias("kind"), "us", F.lit(0).cast("long").alias("published"))
    days = t.points.groupBy(F.expr(f"(us div {DAY} + 1) * {DAY} - 1").alias("us")).agg(F.count("*").alias("n"))
    total = F.sum(F.col("n") + 1).over(Window.orderBy("us"))
    beats = days.select(F.lit("s").alias("session_id"), F.lit("beat").alias("kind"), "us", total.alias("published"))
    rows.union(beats).write.parquet(f"{path}/in")
    stream = t.spark.readStream.schema("session_id string, kind string, us long, published long").parquet(f"{path}/in")
    return _run(t, ST.sync_stream(stream, DAY))


@query("src_live_topics", "SELECT seq, topic FROM M WHERE topic LIKE '%/bms/%'")
def _(t: Tables) -> DataFrame:
    path = scratch(t.spark)
    t.messages.select("seq", "topic").write.parquet(f"{path}/in")
    stream = t.spark.readStream.schema("seq long, topic string").parquet(f"{path}/in")
    return _run(t, X.select_topics(stream, "topic", GROUPS, ["battery"]))


@query("src_recording_csv", "SELECT seq, 'unit/' || unit_id || '/bms/bms_1/' || point_name || '/float' AS topic, unit_id, point_name FROM M WHERE topic LIKE 'ems/site/S1/%' AND topic LIKE '%/bms/%'")
def _(t: Tables) -> DataFrame:
    from ..sources import read_recording

    path = scratch(t.spark)
    t.messages.select("topic", F.col("seq").cast("string").alias("payload"), F.lit(0).alias("qos"), F.lit("0").alias("retained"), F.col("us").cast("string").alias("recv_ts"), F.lit(0.0).alias("latency")).write.option("compression", "gzip").csv(path)
    return read_recording(t.spark, path, "S1", ["bms"]).select(F.col("payload").cast("long").alias("seq"), "topic", "unit_id", "point_name")


def _annotated(t: Tables) -> str:
    """Events as annotated CSV, a table for each unit and 10,000 consecutive events, so of no more lines. Tables of
    the same events are packed by their lines; a file has at most 20 packs of less than 20,000 lines, as files of few lines cost more
    to open than to read."""
    from pyspark.sql.window import Window

    path = scratch(t.spark)
    head = "#group,false,false,false,false,true,true\n#datatype,string,long,dateTime:RFC3339,double,string,string\n#default,_result,,,,,\n,result,table,_time,_value,_field,point_name"
    line = F.concat_ws(",", F.lit(""), F.lit(""), F.lit("0"), F.concat(F.date_format(F.timestamp_micros("us"), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")), F.col("value_i").cast("string"), F.when(F.col("point_name") == "signup", "integer").otherwise("float"), "point_name")
    per = t.points.groupBy("unit_id", F.expr("seq div 10000").alias("slice")).agg(F.concat(F.lit(f"{head}\n"), F.array_join(F.collect_list(line), "\n")).alias("table"), F.count("*").alias("n"))
    lines = F.sum("n").over(Window.partitionBy("slice").orderBy("unit_id").rowsBetween(Window.unboundedPreceding, 0))
    packs = per.withColumn("pack", F.floor(lines / 10_000)).groupBy("slice", "pack").agg(F.array_join(F.collect_list("table"), "\n\n").alias("tables"))
    packs.select(F.concat("tables", F.lit("\n")).alias("value")).write.option("maxRecordsPerFile", 20).text(path)
    return path


@query("src_annotated_csv", "SELECT point_name AS point, count(*) AS n, sum(CASE WHEN point_name <> 'signup' THEN CAST(value_i AS DOUBLE) END) AS f, CAST(sum(CASE WHEN point_name = 'signup' THEN value_i END) AS BIGINT) AS i FROM P GROUP BY 1")
def _(t: Tables) -> DataFrame:
    from ..sources import read_annotated_csv

    rows = read_annotated_csv(t.spark, _annotated(t), "ems")
    return rows.groupBy(F.col("tags")["point_name"].alias("point")).agg(F.count("*").alias("n"), F.sum("value_f").alias("f"), F.sum("value_i").alias("i"))


@query("src_annotated_csv_auto", "SELECT count(*) AS n, count(*) FILTER (WHERE point_name = 'signup') AS whole FROM P")
def _(t: Tables) -> DataFrame:
    from ..sources import read_annotated_csv

    return read_annotated_csv(t.spark, _annotated(t)).agg(F.count("*").alias("n"), F.count("value_i").alias("whole"))
