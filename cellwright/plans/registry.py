"""Queries by name, with SQL that gives the same rows, over the given tables.

Three derived tables stand for telemetry. P (points, long): events, with value in hundredths and the
integer of props. C (cells, wide): lineitem, with whole-number measures, so that sums are exact in any
order. M (messages): topics and payloads made of events.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.time import micros

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

_SQL = """WITH RECURSIVE P AS (SELECT event_id AS seq, epoch_us(ts) AS us, CAST(user_id AS VARCHAR) AS unit_id, event_type AS point_name,
  round(value * 100) AS value_f, CAST(json_extract_string(props, '$.k') AS BIGINT) AS value_i FROM events),
C AS (SELECT epoch_us(l_shipdate) AS us, l_suppkey % 20 AS site_id, l_partkey % 8 AS rack_id, CAST(l_linenumber AS BIGINT) AS cell_id,
  l_orderkey * 8 + l_linenumber AS tie, l_partkey AS part, 3000 + l_quantity * 25 AS voltage, round(l_discount * 500) AS temperature,
  round(l_tax * 1000) AS soc, round(l_extendedprice * 100) AS power FROM lineitem),
M AS (SELECT seq, us, unit_id, point_name, 'ems/site/S' || CAST(CAST(unit_id AS BIGINT) % 5 AS VARCHAR) || '/unit/' || unit_id || '/' ||
  CASE WHEN point_name IN ('view', 'click') THEN 'bms/bms_1/' ELSE 'pcs/pcs_1/' END || point_name || '/' ||
  CASE point_name WHEN 'error' THEN 'string' WHEN 'signup' THEN 'integer' ELSE 'float' END AS topic,
  'src/site=' || CAST(CAST(unit_id AS BIGINT) % 5 AS VARCHAR) || '/unit=' || unit_id || '/x=abc/' || point_name AS kv,
  CASE WHEN value_i % 7 = 0 THEN 'not json' WHEN value_i % 3 = 0 THEN '{"us":' || CAST(us AS VARCHAR) || ',"value":{"value":' || CAST(value_i AS VARCHAR) || ',"unit":"V"}}'
  ELSE '{"us":' || CAST(us AS VARCHAR) || ',"value":' || CAST(value_i AS VARCHAR) || '}' END AS payload, value_i FROM P)"""


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def points(self) -> DataFrame:
        return self.table("events").select(
            F.col("event_id").alias("seq"), micros("ts").alias("us"), F.col("user_id").cast("string").alias("unit_id"), F.col("event_type").alias("point_name"),
            F.round(F.col("value") * 100).alias("value_f"), F.get_json_object("props", "$.k").cast("long").alias("value_i"),
        )

    @cached_property
    def cells(self) -> DataFrame:
        return self.table("lineitem").select(
            micros("l_shipdate").alias("us"), (F.col("l_suppkey") % 20).alias("site_id"), (F.col("l_partkey") % 8).alias("rack_id"), F.col("l_linenumber").cast("long").alias("cell_id"),
            (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("tie"), F.col("l_partkey").alias("part"), (3000 + F.col("l_quantity") * 25).alias("voltage"),
            F.round(F.col("l_discount") * 500).alias("temperature"), F.round(F.col("l_tax") * 1000).alias("soc"), F.round(F.col("l_extendedprice") * 100).alias("power"),
        )

    @cached_property
    def messages(self) -> DataFrame:
        p, unit = self.points, F.col("unit_id")
        device = F.when(F.col("point_name").isin("view", "click"), "bms/bms_1/").otherwise("pcs/pcs_1/")
        dtype = F.when(F.col("point_name") == "error", "string").when(F.col("point_name") == "signup", "integer").otherwise("float")
        site = (unit.cast("long") % 5).cast("string")
        us, k = F.col("us").cast("string"), F.col("value_i").cast("string")
        nested = F.concat(F.lit('{"us":'), us, F.lit(',"value":{"value":'), k, F.lit(',"unit":"V"}}'))
        flat = F.concat(F.lit('{"us":'), us, F.lit(',"value":'), k, F.lit("}"))
        return p.select(
            "seq", "us", "unit_id", "point_name", F.concat(F.lit("ems/site/S"), site, F.lit("/unit/"), unit, F.lit("/"), device, F.col("point_name"), F.lit("/"), dtype).alias("topic"),
            F.concat(F.lit("src/site="), site, F.lit("/unit="), unit, F.lit("/x=abc/"), F.col("point_name")).alias("kv"),
            F.when(F.col("value_i") % 7 == 0, "not json").when(F.col("value_i") % 3 == 0, nested).otherwise(flat).alias("payload"), "value_i",
        )


def scratch(spark: SparkSession) -> str:
    """A new folder below the one that the cluster shares."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir names the folder that executors share; it is not set")
    base = base or tempfile.mkdtemp(prefix="cellwright-")
    return f"{base.rstrip('/')}/q-{uuid.uuid4().hex}"


def query(name: str, sql: str | None = None) -> Callable:
    """Register a function of Tables. sql goes after the derived tables: a SELECT, or ", X AS (...) SELECT"."""

    def add(f: Callable[[Tables], DataFrame]) -> Callable:
        QUERIES[name] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql:
            ORACLES[name] = _SQL + "\n" + sql.strip()
        return f

    return add
