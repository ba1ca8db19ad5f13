import datetime as dt

from pyspark.sql import functions as F

from cellwright.functions import parse as X
from cellwright.functions.time import bucket_start, epoch_time, iso_time


def one(spark, expr, **row):
    return spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} string" for k in row)).select(expr.alias("x")).first()["x"]


def test_topic_kv(spark):
    k = X.topic_kv(F.col("t"))
    df = spark.createDataFrame([("src/a=1/b=2/c=x/a=3/field",), ("one",), ("",), (None,)], "t string")
    got = df.select(*[c.alias(n) for n, c in k.items()]).collect()
    assert got[0].source_type == "src" and got[0].ints == {"a": 3, "b": 2} and got[0].field_name == "field"
    assert got[1].source_type == "one" and got[1].ints == {} and got[1].field_name is None
    assert got[2].source_type is None and got[3].source_type is None


def test_topic_positional_short_and_skipped(spark):
    cols = X.topic_positional(F.col("t"), ["unit", "_", "point"])
    got = spark.createDataFrame([("u/x/p",), ("u",)], "t string").select(*[c.alias(n) for n, c in cols.items()]).collect()
    assert [tuple(r) for r in got] == [("u", "p"), ("u", None)]


def test_patterns_first_match_and_right_aligned(spark):
    pats = [{"match": "a/+/c", "segments": ["x", "y"], "reverse": True}, {"match": "a/#", "segments": ["_", "y"]}]
    df = X.topic_patterns(spark.createDataFrame([("a/b/c",), ("a/b",), ("a",), ("z",)], "t string"), "t", pats)
    assert [tuple(r) for r in df.select("x", "y", "pattern").collect()] == [("b", "c", "a/+/c"), (None, "b", "a/#"), (None, None, "a/#"), (None, None, None)]


def test_json_values(spark):
    v = X.json_value(F.col("p"), "v")
    assert one(spark, v, p='{"v":{"value":3.7,"unit":"V"}}') == "3.7"
    assert one(spark, v, p='{"v":2}') == "2"
    assert one(spark, v, p='{"v":{"unit":"V"}}') is None
    assert one(spark, v, p="garbage") is None


def test_bad_json_kept_or_dropped(spark):
    df = spark.createDataFrame([("t1", '{"ts":"2024-11-15T21:27:52.775Z","value":0.5}'), ("t2", "nope")], "topic string, p string")
    kept = X.parse_payload(df, "p", {"value": "double"})
    assert [(r.topic, r.value) for r in kept.collect()] == [("t1", 0.5), ("t2", None)]
    assert [r.topic for r in X.parse_payload(df, "p", {"value": "double"}, on_bad="drop").collect()] == ["t1"]


def test_times(spark):
    assert one(spark, iso_time(F.col("t")), t="2024-11-15T21:27:52.775Z") == dt.datetime(2024, 11, 15, 21, 27, 52, 775000)
    assert one(spark, iso_time(F.col("t")), t="2024-11-15T21:27:52Z") == dt.datetime(2024, 11, 15, 21, 27, 52)
    for bad in ("2024-11-15", "", "not a time at all here", "2024-13-45T00:00:00Z"):
        assert one(spark, iso_time(F.col("t")), t=bad) is None
    assert one(spark, F.unix_micros(epoch_time(F.col("t"))), t="1700000000000001") == 1700000000000001
    assert one(spark, F.unix_micros(epoch_time(F.col("t"))), t="1700000000.25") == 1700000000250000


def test_bucket_rounds_half_to_even(spark):
    df = spark.createDataFrame([(5,), (15,), (16,), (25,)], "us long")
    assert [r[0] for r in df.select(bucket_start(F.col("us"), 10, "nearest")).collect()] == [0, 20, 20, 20]
    assert [r[0] for r in df.select(bucket_start(F.col("us"), 10)).collect()] == [0, 10, 10, 20]


def test_coerce(spark):
    df = X.coerce(spark.createDataFrame([("1", "x"), ("y", "2.5")], "cell_id string, voltage string"), ["cell_id", "project_id"], ["voltage"])
    assert [(r.cell_id, r.voltage, r.project_id) for r in df.collect()] == [(1, None, 0), (None, 2.5, 0)]


def test_payload_layouts(spark):
    df = spark.createDataFrame([('{"a":{"value":1},"cell_id":2}',), ('{"a":1}',), ("x",), ("{}",)], "p string")
    got = df.select(*[c.alias(n) for n, c in X.classify_payload(F.col("p"), ["cell_id"]).items()]).collect()
    assert [tuple(r) for r in got] == [("nested", True), ("flat", False), ("unknown", False), ("unknown", False)]
