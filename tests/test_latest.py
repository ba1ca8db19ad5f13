"""Latest rows against a plain loop, and the plans that find them."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cellwright.operators import query as R

small = st.one_of(st.none(), st.integers(-2, 3))
rows = st.lists(st.tuples(st.sampled_from([None, "a", "b"]), small, small, small, small, st.sampled_from([None, "x", "y"])), max_size=20)
SCHEMA = "k string, ts long, o1 long, o2 int, v long, s string"


def plain(data, order, per_column, cols):
    place = {"ts": 1, "o1": 2, "o2": 3, "v": 4, "s": 5}
    at = lambda r: tuple((r[place[c]] is not None, r[place[c]] or 0) for c in ("ts", *order))
    out = {}
    for key in {r[0] for r in data}:
        mine = [r for r in data if r[0] == key]
        got = []
        for c in cols:
            of = [r for r in mine if r[place[c]] is not None or not per_column]
            best = max(map(at, of), default=None)
            got.append({r[place[c]] for r in of if at(r) == best} or {None})  # several where all of the order is equal
        out[key] = got
    return out


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows, st.sampled_from([(), ("o1",), ("o1", "o2")]), st.booleans(), st.sampled_from([("v",), ("v", "s")]))
def test_latest_is_the_plain_loop(spark, data, order, per_column, cols):
    df = spark.createDataFrame(data, SCHEMA)
    for words in (1, 1 << 10):  # a filter that all rows pass gives the same
        got = R.latest(df, ["k"], "ts", list(cols), per_column, order, words).collect()
        want = plain(data, order, per_column, cols)
        assert len(got) == len(want) and all(r[c] in w for r in got for c, w in zip(cols, want[r.k]))


@pytest.mark.parametrize("per_column", [False, True])
@pytest.mark.parametrize("cols", [("v",), ("v", "s")])
def test_no_raw_row_is_sorted_or_shuffled(spark, per_column, cols):
    df = spark.range(20_000).select((F.col("id") % 50).cast("string").alias("k"), (F.col("id") % 1999).alias("ts"), F.col("id").alias("o1"), F.col("id").alias("o2"), F.col("id").alias("v"), F.lit("x").alias("s"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = R.latest(df, ["k"], "ts", list(cols), per_column, ("o1", "o2"))
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in plan and "SortMergeJoin" not in plan
        sorted_rows = out.count()
        assert sorted_rows == 50
        exchanges = [x for x in plan.split("\n") if "Exchange hashpartitioning(k" in x]
        assert len(exchanges) == 2  # partial largest times, and what passed the filter
        hashed = R.latest(df, ["k"], "ts", ["v"], per_column, ("o1",))._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in hashed and hashed.count("Exchange") == 1 and "Sort" not in hashed
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_few_rows_pass_the_filter(spark):
    df = spark.range(100_000).select((F.col("id") % 100).alias("k"), F.col("id").alias("ts"), F.lit("x").alias("s"))
    tops = df.groupBy("k").agg(F.max("ts").alias("t")).select(F.xxhash64(F.lit(0), "t", "k").alias("h"))
    seen = R.bit_filter(tops, 1 << 10)
    passed = df.crossJoin(F.broadcast(seen)).where(R.in_filter(F.xxhash64(F.lit(0), "ts", "k"), F.col("bits"), 1 << 10)).count()
    assert 100 <= passed < 400
