"""Streams over several micro-batches: windows that close, late rows, timers, restarts, several sinks."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from cellwright import streaming as ST
from cellwright.sources.commits import Files

T0 = datetime.datetime(2024, 1, 1)
SCHEMA = "ts timestamp, key string, v double, seq long"


def feed(spark, path, rows):
    data = [(T0 + datetime.timedelta(seconds=s), k, float(v), n) for n, (s, k, v) in enumerate(rows)]
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(str(path / "in"))


def run(spark, path, make, name="memory"):
    """All that is there, one file for each micro-batch; new rows so far, and the progress of each batch."""
    stream = make(spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(path / "in")))
    writer = stream.writeStream.option("checkpointLocation", str(path / "c")).trigger(availableNow=True).format("parquet").option("path", str(path / "out"))
    query = writer.outputMode("append").start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(str(path / "out")), [json.loads(p.json) if not isinstance(p, dict) else p for p in query.recentProgress]


def test_windows_close_late_rows_go_and_state_shrinks(spark, tmp_path):
    feed(spark, tmp_path, [(s, f"k{s % 50}", 1) for s in range(0, 3000, 5)])
    feed(spark, tmp_path, [(9000, "k1", 1), (9001, "k1", 1)])
    feed(spark, tmp_path, [(10, "late", 1), (9002, "k1", 1)])  # the first is beyond the watermark
    feed(spark, tmp_path, [(20_000, "end", 1)])
    out, progress = run(spark, tmp_path, lambda s: ST.tumbling(s, "ts", "10 minutes", ["key"], [F.count("*").alias("n")]))
    rows = out.select("key", "n", F.unix_timestamp("window.start").alias("at")).collect()
    start = int(T0.replace(tzinfo=datetime.timezone.utc).timestamp())
    assert sum(r.n for r in rows if r.at < start + 3000) == 600 and not [r for r in rows if r.key in ("late", "end")]
    assert [r.n for r in rows if r.at == start + 9000] == [3]
    state = [p["stateOperators"][0] for p in progress if p["stateOperators"]]
    assert sum(x["numRowsDroppedByWatermark"] for x in state) == 1
    sizes = [x["numRowsTotal"] for x in state]
    assert max(sizes) > 40 and sizes[-1] == 1  # evicted, but for the window that is open


def test_coalesced_windows_are_appended(spark, tmp_path):
    feed(spark, tmp_path, [(1, "a", 1), (2, "a", 2), (3, "b", 3), (61, "a", 4)])
    feed(spark, tmp_path, [(4, "a", 9), (500, "a", 5)])  # within the delay, so the first window changes
    feed(spark, tmp_path, [(5000, "a", 6)])
    out, _ = run(spark, tmp_path, lambda s: ST.coalesce_stream(s, "ts", "1 minute", ["key"], ["ts"], ["v"]))
    assert sorted((r.key, (r.ts - T0).seconds, r.v) for r in out.collect()) == [("a", 1, 9.0), ("a", 61, 4.0), ("a", 500, 5.0), ("b", 3, 3.0)]


def test_smoothed_rate_keeps_its_state_over_a_restart(spark, tmp_path):
    make = lambda s: ST.smoothed_rate(s, "ts", ["key"])
    feed(spark, tmp_path, [(1, "a", 1), (1, "a", 1), (2, "a", 1), (7, "b", 1)])
    feed(spark, tmp_path, [(100, "a", 1)])
    run(spark, tmp_path, make)
    feed(spark, tmp_path, [(100, "a", 1), (101, "a", 1), (900, "a", 1)])
    out, _ = run(spark, tmp_path, make)
    want, rate = {("b", 7): (1, 0.2)}, 0.0
    for second, n in ((1, 2), (2, 1), (100, 2), (101, 1)):
        rate = 0.8 * rate + 0.2 * n
        want["a", second] = (n, rate)
    start = T0.replace(tzinfo=datetime.timezone.utc).timestamp()
    got = {(r.key, r.us // 1_000_000 - start): (r.n, r.rate) for r in out.collect()}
    assert set(got) == set(want) and all(got[k] == (want[k][0], pytest.approx(want[k][1])) for k in want)


def test_counts_timers_and_restart(spark, tmp_path):
    make = lambda s: ST.counted_cov_stream(s, ["key"], "ts", "v", "1h", "1 minute", default=1.0)
    feed(spark, tmp_path, [(0, "a", 5), (2, "a", 5.2), (1, "a", 5.1), (3, "a", 7), (4, "a", 7.5), (0, "b", 1)])
    run(spark, tmp_path, make)
    feed(spark, tmp_path, [(5, "a", 7.4), (3603, "b", 1)])  # b: an hour after the last
    feed(spark, tmp_path, [(20_000, "c", 1)])  # a is silent since 5
    feed(spark, tmp_path, [(20_001, "a", 7.4), (20_002, "c", 1)])
    feed(spark, tmp_path, [(90_000, "d", 1)])
    out, _ = run(spark, tmp_path, make)
    start = int(T0.replace(tzinfo=datetime.timezone.utc).timestamp())
    got = sorted((r.key, r.us // 1_000_000 - start, r.value, r.held, r.timed) for r in out.collect())
    assert got == [
        ("a", 0, 5.0, 0, False), ("a", 3, 7.0, 2, False), ("a", 5, 7.4, 2, True), ("a", 20_001, 7.4, 0, False),
        ("b", 0, 1.0, 0, False), ("b", 3603, 1.0, 0, False), ("c", 20_000, 1.0, 0, False), ("c", 20_002, 1.0, 1, True), ("d", 90_000, 1.0, 0, False),
    ]


def test_sensors_of_a_bucket_share_a_row_of_state(spark, tmp_path):
    """Many sensors, null ones too, in few buckets: the rows of a plain loop over each, and no call and row of state for each."""
    import random

    dice = random.Random(7)
    batches = [[(b * 10_000 + s, None if k == 7 else f"k{k}", dice.randrange(6)) for k in range(300) for s in dice.sample(range(9_000), 4) if k % 3 or b == 0] for b in range(3)]
    batches.append([(1_000_000, "end", 0)])
    for rows in batches:
        feed(spark, tmp_path, rows)
    start = int(T0.replace(tzinfo=datetime.timezone.utc).timestamp())
    want, kept = [], []
    for key in {k for rows in batches[:-1] for _, k, _ in rows}:
        last = since = None
        mine, held = sorted((s, v) for rows in batches for s, k, v in rows if k == key), 0
        for s, v in mine:
            if last is None or abs(v - last) >= 3 or s - since >= 50_000:
                want.append((key, s, float(v), held, False))
                kept.append((key, s))
                last, since, held = v, s, 0
            else:
                held += 1
        if held:
            want.append((key, *map(float, mine[-1]), held, True))
    out, progress = run(spark, tmp_path, lambda s: ST.counted_cov_stream(s, ["key"], "ts", "v", "50000s", "10000 seconds", default=3.0, buckets=8))
    got = [(r.key, r.us // 1_000_000 - start, r.value, r.held, r.timed) for r in out.collect() if r.key != "end"]
    assert sorted(got, key=str) == sorted(((k, int(s), v, n, t) for k, s, v, n, t in want), key=str)
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in progress) <= 8
    again = tmp_path / "again"
    again.mkdir()
    (tmp_path / "in").rename(again / "in")
    out, progress = run(spark, again, lambda s: ST.cov_stream(s.withColumn("us", F.unix_micros("ts")).drop("ts"), ["key"], "us", "v", default=3.0, heartbeat_us=50_000_000_000, buckets=8))
    assert sorted(((r.key, r.us // 1_000_000 - start) for r in out.collect() if r.key != "end"), key=str) == sorted(kept, key=str)
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in progress) <= 8


def test_several_sinks_get_each_row_once(spark, tmp_path, monkeypatch):
    for k in range(3):
        feed(spark, tmp_path, [(k * 10 + s, "ab"[s % 2], s) for s in range(10)])
    source = lambda: spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    sinks = {str(tmp_path / "all"): F.lit(True), str(tmp_path / "a"): F.col("key") == "a"}
    move, moved = Files.move, []

    def fail(self, source, target):
        if "/batch=" in target:
            moved.append(target)
            if len(moved) == 4:  # the second sink of the second batch
                raise OSError("not moved")
        return move(self, source, target)

    with monkeypatch.context() as m:
        m.setattr(Files, "move", fail)
        with pytest.raises(Exception):
            ST.route(source(), sinks, str(tmp_path / "c")).awaitTermination()
    ST.route(source(), sinks, str(tmp_path / "c")).awaitTermination()
    count = lambda name: spark.read.parquet(str(tmp_path / name)).groupBy("ts", "key", "v").count()
    assert count("all").count() == 30 and count("a").count() == 15
    assert {r["count"] for r in count("all").union(count("a")).collect()} == {1}
    assert spark.read.parquet(str(tmp_path / "all")).where("batch = 1").count() == 10
    with pytest.raises(Exception):
        ST.route(source(), sinks, str(tmp_path / "other")).awaitTermination()
