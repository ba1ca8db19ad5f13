"""Stateful filters against a plain loop."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cellwright.operators import change as C
from cellwright.operators import slices

values = st.one_of(st.none(), st.sampled_from([0.0, 1.0, 1.4, 2.0, 100.0, float("nan")]), st.floats(-5, 5))
series = st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 3 * 86_400_000_000), values), max_size=25)


def plain(rows, limit, kind, heartbeat, same=None):
    last, out = {}, []
    for i, (key, us, v) in sorted(enumerate(rows), key=lambda r: (r[1][1], r[0])):
        if v is None:
            continue
        if key not in last:
            ok = True
        else:
            p, t = last[key]
            if heartbeat is not None and us - t >= heartbeat:
                ok = True
            elif same is not None:
                ok = not same(v, p)
            elif v != v or p != p:
                ok = (v != v) != (p != p)
            else:
                ok = abs(v - p) / max(abs(p), 1e-6) > limit if kind == "relative" else abs(v - p) >= limit
        if ok:
            last[key] = (v, us)
            out.append(i)
    return sorted(out)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(series, st.sampled_from([("absolute", 0.5, None), ("relative", 0.5, None), ("absolute", 0.5, 86_400_000_000)]))
def test_cov_is_the_plain_loop(spark, rows, how):
    kind, limit, heartbeat = how
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "seq long, key string, us long, v double")
    # a NaN stays one, a None is null
    got = C.cov(df, ["key"], "us", "v", default=limit, kind=kind, heartbeat_us=heartbeat, order=["seq"])
    assert sorted(r.seq for r in got.collect()) == plain(rows, limit, kind, heartbeat)


text = st.lists(st.tuples(st.sampled_from(["a", None]), st.integers(0, 50), st.sampled_from([None, "on", "off"])), max_size=40)
steps = st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 60), st.one_of(values, st.sampled_from([0.1, 0.3, 0.6, -0.2]))), min_size=15, max_size=60)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(steps, st.sampled_from([("absolute", 0.5, None), ("relative", 0.5, None), ("absolute", 0.5, 7), ("relative", 0.3, 20), ("exact", 0.0, None), ("exact", 0.0, 9)]), st.integers(1, 9))
def test_slices_are_the_plain_loop(spark, rows, how, slice_rows):
    kind, limit, heartbeat = how
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "seq long, key string, us long, v double")
    exact = F.lit(True) if kind == "exact" else None
    got = C.cov(df, ["key"], "us", "v", default=limit, kind="absolute" if exact is not None else kind, heartbeat_us=heartbeat, exact=exact, order=["seq"], slice_rows=slice_rows)
    same = lambda v, p, *_: v == p or (v != v and p != p)
    assert sorted(r.seq for r in got.collect()) == plain(rows, limit, kind, heartbeat, same if kind == "exact" else None)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(text, st.sampled_from([None, 6]), st.sampled_from([None, 3]))
def test_strings_in_slices(spark, rows, heartbeat, slice_rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "seq long, key string, us long, v string")
    got = C.cov(df, ["key"], "us", "v", heartbeat_us=heartbeat, order=["seq"], slice_rows=slice_rows)
    assert sorted(r.seq for r in got.collect()) == plain(rows, 0, "exact", heartbeat, lambda v, p, *_: v == p)


def test_courses_meet_and_cover_every_entry():
    """Without Spark: for random entries a slice's summary ends where a plain walk does."""
    rng = np.random.default_rng(5)
    for trial in range(400):
        n, kind, beat = int(rng.integers(1, 60)), ("absolute", "relative")[trial % 2], (None, 5, 40)[trial % 3]
        v = np.cumsum(rng.normal(0, (0.01, 0.3, 2)[trial % 3], n)).round(2)
        v[rng.random(n) < 0.05 * (trial % 4 == 0)] = np.nan
        us, limit = np.sort(rng.integers(0, 100, n)), np.full(n, 0.5)
        if trial % 7 == 0:
            limit = rng.choice([0.2, 0.9], n)
        exact = np.full(n, trial % 5 == 0) if trial % 11 else rng.random(n) < 0.5
        course = slices.Course(v, us, limit, exact, kind, beat)
        first = course.firsts()
        end = course.ends(first)
        for _ in range(10):
            last, last_us = float(rng.choice([*(v + rng.normal(0, 0.4, n)), np.nan, 0.0])), int(us[0] - rng.integers(0, 50))
            now, now_us = last, last_us
            for x, t, e, ex in zip(v, us, limit, exact):
                if C.passes(now, now_us, x, t, e, kind, ex, beat):
                    now, now_us = x, t
            hit = slices.passing(last, last_us, v[first], us[first], limit[first], exact[first], kind, beat)
            got = (v[end[hit.argmax()]], us[end[hit.argmax()]]) if hit.any() else (last, last_us)
            assert got[1] == now_us and (got[0] == now or (now != now and got[0] != got[0]))


def test_one_sensor_runs_in_many_tasks(spark):
    df = spark.range(60_000).select("id", F.lit("only").alias("key"), (F.col("id") * 1000).alias("us"), (F.sin(F.col("id") / 50) * 10).alias("v"))
    whole, cut = (C.cov(df, ["key"], "us", "v", default=1.5, order=["id"], slice_rows=n) for n in (None, 2_000))
    assert {r.id for r in whole.collect()} == {r.id for r in cut.collect()}
    held = C.slices.long_series(df.withColumn("_value", F.col("v")), ["key"], "us", 2_000).groupBy("_slice").count()
    assert held.count() == 30 and held.agg(F.max("count")).first()[0] <= 2_100


def test_slow_drift_fires_against_the_last_kept(spark):
    df = spark.createDataFrame([(i, i * 1_000_000, 0.2 * i) for i in range(10)], "seq long, us long, v double").withColumn("key", F.lit("k"))
    assert [r.seq for r in C.cov(df, ["key"], "us", "v", default=0.5).orderBy("seq").collect()] == [0, 3, 6, 9]


def test_day_cut_keeps_the_first_of_each_day(spark):
    day = 86_400_000_000
    df = spark.createDataFrame([(0, 5, 1.0), (1, 6, 1.0), (2, day + 1, 1.0)], "seq long, us long, v double").withColumn("key", F.lit("k"))
    assert {r.seq for r in C.cov(df, ["key"], "us", "v", day_cut=True).collect()} == {0, 2}


def test_rules_first_match_wins(spark):
    df = spark.createDataFrame([("HS-CONTROL-Q1",), ("kW",), ("other",)], "p string")
    got = df.select(C.threshold("p", [("HS-CONTROL-Q*", 2.0), ("k?", 5.0), ("*", 7.0)], 0.5)).collect()
    assert [r[0] for r in got] == [2.0, 5.0, 7.0]


def test_wide_rows_with_nulls_stay(spark):
    df = spark.createDataFrame([(0, 1, 1), (1, 1, None), (2, 1, None), (3, 1, 1), (4, 1, 1)], "seq long, a long, b long").withColumn("k", F.lit(1))
    assert [r.seq for r in C.cov_exact(df, ["k"], ["seq"], ["a", "b"]).orderBy("seq").collect()] == [0, 1, 2, 3]


@pytest.mark.parametrize("pct", [0.0, 0.5])
def test_null_fill_against_last_written(spark, pct):
    hour = 3_600_000_000
    rows = [(0, 0, 10.0), (1, 1, 10.0), (2, 2, 12.0), (3, 3, 16.0), (4, hour, 16.0), (5, hour + 1, None)]
    df = spark.createDataFrame(rows, "seq long, us long, v double").withColumn("k", F.lit(1))
    got = {r.seq: r.v for r in C.null_fill(df, ["k"], "us", ["v"], pct=pct).collect()}
    assert got == ({0: 10.0, 1: None, 2: 12.0, 3: 16.0, 4: 16.0, 5: None} if not pct else {0: 10.0, 1: None, 2: None, 3: 16.0, 4: 16.0, 5: None})


def test_empty_tables(spark):
    df = spark.createDataFrame([], "seq long, key string, us long, v double")
    assert C.cov(df, ["key"], "us", "v").count() == 0
    assert C.run_encode(df, ["key"], ["us"], "v").count() == 0
    assert C.coalesce_window(df, ["key", "seq"], "us", 100, ["us"], ["v"]).count() == 0


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(0, 40)), st.one_of(st.none(), st.floats(-5, 5))), max_size=50), st.sampled_from([3, 1000]))
def test_moving_average_is_the_recursion(spark, rows, slice_rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "seq long, key string, us long, v double")
    want, last = {}, {}
    for i, (key, us, v) in sorted(enumerate(rows), key=lambda r: (r[1][1] or 0, r[0])):
        if us is None or v is None:
            want[i] = None
            continue
        last[key] = 0.2 * v + 0.8 * last.get(key, v)
        want[i] = pytest.approx(last[key], abs=1e-9)
    got = {r.seq: r.ema for r in slices.moving_average(df, ["key"], "us", "v", order=["seq"], slice_rows=slice_rows).collect()}
    assert got == want
