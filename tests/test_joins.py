import random

import pytest
from pyspark.sql import functions as F

from cellwright.operators import joins as J
from cellwright.operators import quality as Q
from cellwright.operators import query as R


def test_asof_against_a_loop_with_ties_and_nulls(spark):
    rng = random.Random(4)
    key = lambda: rng.choice(["a", "b", None])
    left = [(i, key(), rng.choice([None, rng.randint(0, 40)])) for i in range(60)]
    right = [(key(), rng.choice([None, rng.randint(0, 40)]), i) for i in range(40)]
    l = spark.createDataFrame(left, "id long, k string, us long")  # noqa: E741
    r = spark.createDataFrame(right, "k string, us long, v long")
    want = {}
    for i, k, t in left:
        best = [(u, v) for q, u, v in right if k is not None and t is not None and u is not None and q == k and u <= t]
        want[i] = max(best)[1] if best else None
    for width in (None, 7):
        got = J.asof_join(l, r, ["k"], "us", ["v"], order=["v"], slice_us=width)
        assert {x.id: x.v for x in got.collect()} == want
        inner = J.asof_join(l, r, ["k"], "us", ["v"], how="inner", order=["v"], slice_us=width)
        assert {x.id for x in inner.collect()} == {i for i, v in want.items() if v is not None}


def test_band_join_meets_each_pair_once(spark):
    rng = random.Random(5)
    a, b = [rng.randint(-50, 50) for _ in range(40)], [rng.randint(-50, 50) for _ in range(40)]
    l = spark.createDataFrame(list(enumerate(a)), "i long, t long")  # noqa: E741
    r = spark.createDataFrame(list(enumerate(b)), "j long, u long")
    got = sorted((x.i, x.j) for x in J.band_join(l, r, "t", "u", 5).collect())
    assert got == sorted((i, j) for i, t in enumerate(a) for j, u in enumerate(b) if abs(t - u) < 5)
    plan = J.band_join(l, r, "t", "u", 5)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_hot_cold_has_no_duplicate_at_the_cutoff(spark):
    cold = spark.createDataFrame([(100, 1.0), (102, 1.2), (None, 9.0)], "us long, a double")
    hot = spark.createDataFrame([(101, 1.1), (102, 5.0), (103, 1.3)], "us long, b double")
    got = J.hot_cold(cold, hot, "us", 102, 0, 200)
    assert [(r.us, r.a) for r in got.collect()] == [(100, 1.0), (102, None), (103, None)]
    assert J.hot_cold(cold, hot, "us", 102, 0, 200, keep_hot_only=True).columns == ["us", "a", "b"]


def test_compare_looks_at_all_keys(spark):
    a = spark.createDataFrame([(1, 1.0), (2, 2.0), (None, None), (4, 1.0)], "k long, v double")
    b = spark.createDataFrame([(1, 1.0005), (2, 3.0), (None, None), (5, 1.0)], "k long, v double")
    got = {r.k: r.status for r in J.compare(a, b, ["k"], ["v"], 0.001).collect()}
    assert got == {1: "OK", 2: "DIFF", None: "OK", 4: "MISSING", 5: "MISSING"}


def test_sync_check_sessions_deficit_and_late_rows(spark):
    rows = spark.createDataFrame([(t,) for t in (5, 11, 12, 25, 26, 27, 45)], "us long")
    beats = [("s", 0, 10, 0, 100), ("s", 1, 20, 3, 103), ("s", 2, 30, 2, 105), ("t", 0, 40, 0, 7), ("t", 1, 50, 1, 8)]
    df = spark.createDataFrame(beats, "session_id string, seq long, us long, interval_published long, total_published long")
    got = {(r.session_id, r.seq): (r.published, r.found, r.dropped, r.cumulative_loss) for r in J.sync_check(rows, df, "us").collect()}
    assert got == {("s", 1): (3, 2, 1, 1), ("s", 2): (2, 3, 0, 0), ("t", 1): (1, 1, 0, 0)}


def test_sync_check_counts_rows_for_every_session_that_runs(spark):
    rows = spark.createDataFrame([(t,) for t in (20, 30, 40, 50, 60, None)], "us long")
    beats = [("x", 0, 0, 0, 0), ("x", 1, 100, 5, 5), ("y", 0, 10, 0, 0), ("y", 1, 90, 5, 5), ("y", 2, 100, 0, 5)]
    df = spark.createDataFrame(beats, "session_id string, seq long, us long, interval_published long, total_published long")
    got = {(r.session_id, r.seq): (r.found, r.dropped) for r in J.sync_check(rows, df, "us").collect()}
    assert got == {("x", 1): (5, 0), ("y", 1): (5, 0), ("y", 2): (0, 0)}


def test_latest_breaks_ties_and_keeps_keys_without_time(spark):
    df = spark.createDataFrame([(1, 5, 1, "a"), (1, 5, 2, "b"), (1, 4, 9, "c"), (None, 3, 1, "d"), (2, None, 1, "e"), (2, None, 3, "f")], "k long, us long, seq long, v string")
    assert {r.k: r.v for r in R.latest(df, ["k"], "us", ["v"], order=["seq"]).collect()} == {1: "b", None: "d", 2: "f"}


def test_percentiles_are_interpolated(spark):
    import numpy as np

    values = [1.0, 1.0, 2.0, 5.0, 9.0, 9.5, 30.0]
    df = spark.createDataFrame([("a", v) for v in values] + [(None, 4.0)], "k string, v double")
    got = {r.k: (r.n, r.p50, r.p95, r.p99, r.p100) for r in Q.value_percentiles(df, ["k"], "v").collect()}
    assert got["a"] == pytest.approx((7, *np.percentile(values, [50, 95, 99]), 30.0)) and got[None] == (1, 4.0, 4.0, 4.0, 4.0)


def test_latest_per_column_skips_nulls(spark):
    df = spark.createDataFrame([(1, 1, 5.0, None), (1, 2, None, 7.0)], "k long, us long, a double, b double")
    assert [tuple(r) for r in R.latest(df, ["k"], "us", ["a", "b"], per_column=True).collect()] == [(1, 5.0, 7.0)]
    assert [tuple(r) for r in R.latest(df, ["k"], "us", ["a", "b"]).collect()] == [(1, None, 7.0)]


def test_history_prefers_the_store(spark):
    old = spark.createDataFrame([(1, 10, "a"), (1, 20, "a")], "k long, us long, src string")
    new = spark.createDataFrame([(1, 20, "b"), (1, 30, "b")], "k long, us long, src string")
    got = R.history(old, "us", 0, 100, 10, recent=new, keys=["k"])
    assert [(r.us, r.src) for r in got.collect()] == [(30, "b"), (20, "a"), (10, "a")]


def test_tags_compare_as_text_and_nulls_do_not_match(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (None, 5)], "site_id long, v long")
    assert [r.site_id for r in R.with_tags(df, {"site_id": "2"}).collect()] == [2]
    assert R.with_tags(df, {"v": 5}).count() == 2
    assert R.last_period(df.withColumn("us", F.lit(5)), "us", "-1h").count() == 3
