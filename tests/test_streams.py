"""Streams and files of very many rows of one session or unit."""

import pandas as pd
from pyspark.sql import functions as F

from cellwright import plans
from cellwright.plans import ingest_queries
from cellwright.plans.registry import Tables
from cellwright.streaming import jobs

from .conftest import DATA


def test_received_rows_are_counted_before_the_state_step():
    rows = lambda k: pd.DataFrame({"session_id": "s", "kind": ["row"] * 999 + ["beat"], "us": [*range(999), 99], "published": k})
    got = pd.concat(list(jobs.received_counts(iter([rows(7) for _ in range(50)]), 100)))
    beats, counts = got[got.kind == "beat"], got[got.kind == "row"]
    assert len(beats) == 50 and set(beats.published) == {7} and set(beats.us) == {99}
    assert sorted(zip(counts.us, counts.n, strict=True)) == [(100 * k + 99, 50 * (100 if k < 9 else 99)) for k in range(10)]
    assert sum(x.n.sum() for x in jobs.received_counts(iter([rows(7) for _ in range(50)]), 100, most=3)) == 50 * 999


def test_annotated_tables_of_one_unit_are_bounded(spark, tmp_path):
    at = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id"))
    events = spark.range(25_000).select(F.col("id").alias("event_id"), at.alias("ts"), F.lit(1).alias("user_id"), F.lit("view").alias("event_type"), F.lit(1.5).alias("value"), F.lit('{"k": 3}').alias("props"))
    events.write.parquet(f"{tmp_path}/events.parquet")
    t = Tables(spark, str(tmp_path))
    path = ingest_queries._annotated(t)
    files = [r.value for r in spark.read.text(path, wholetext=True).collect()]
    tables = [x for f in files for x in f.split("#group")[1:]]
    assert len(tables) == 3 and max(x.count("\n") for x in tables) <= 10_000 + 5
    from cellwright.sources import read_annotated_csv

    assert read_annotated_csv(spark, path).count() == 25_000


def test_flushed_batches_are_several_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ingest_queries, "scratch", lambda s: str(tmp_path))
    assert plans.QUERIES["sink_stream_flush"](spark, DATA).first().n > 0
    files = [p for p in (tmp_path / "in").iterdir() if p.name.endswith(".parquet") and not p.name.startswith(".")]
    batches = [p for p in (tmp_path / "checkpoint" / "commits").iterdir() if p.name.isdigit()]
    assert len(batches) == 4 and len(files) == 4 * spark.sparkContext.defaultParallelism


def test_small_annotated_tables_share_files(spark, tmp_path):
    at = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id"))
    events = spark.range(3_000).select(F.col("id").alias("event_id"), at.alias("ts"), F.col("id").alias("user_id"), F.lit("signup").alias("event_type"), F.lit(1.5).alias("value"), F.lit('{"k": 3}').alias("props"))
    events.write.parquet(f"{tmp_path}/events.parquet")
    path = ingest_queries._annotated(Tables(spark, str(tmp_path)))
    files = [r.value for r in spark.read.text(path, wholetext=True).collect() if r.value]
    assert sum(f.count("#group") for f in files) == 3_000 and len(files) <= 4
    from cellwright.sources import read_annotated_csv

    got = read_annotated_csv(spark, path).groupBy("value_i", "value_f").count().collect()
    assert [tuple(r) for r in got] == [(3, None, 3_000)]


def test_annotated_rows_of_any_length():
    from cellwright.sources.readers import _table_rows

    head = "#group,false,false\n#datatype,string,long,double,string,string\n#default,_result,,,none,\n,result,_time,_value,_field,a"
    rows = _table_rows(f"{head},a\n,,t1,1.5,,x,y\n,,t2\n,,t3,bad,float,,\n", "standard")
    assert rows == [("t1", None, "none", 1.5, None, None, [("a", "y")]), ("t2", None, None, None, None, None, []), ("t3", None, "float", None, None, None, [])]
    assert _table_rows(f"{head}\n,,t1,2,integer,x\n", "auto") == [("t1", None, "integer", None, 2, None, [("a", "x")])]
    assert _table_rows("#group\n#datatype,string", "auto") == []
