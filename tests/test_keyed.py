"""Tables by key: what a batch rewrites, what a kill leaves, what expires; and published batches."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from cellwright import sources as S
from cellwright.sources.keyed import KeyedTable
from cellwright.streaming import jobs

KEYS = ["site", "cell"]


def table(spark, path, buckets=8):
    return KeyedTable(spark, str(path), KEYS, "ts", ["seq"], buckets)


def rows(spark, n, ts=1, first=0):
    cell = F.when(F.col("id") % 10 == 3, None).otherwise(F.col("id"))
    return spark.range(first, first + n).select((F.col("id") % 3).alias("site"), cell.alias("cell"), F.lit(ts).cast("long").alias("ts"), F.col("id").alias("seq"), (F.col("id") * ts).cast("double").alias("v"))


def plain(*batches):
    best = {}
    for r in [r for b in batches for r in b.collect()]:
        key = (r.site, r.cell)
        if key not in best or (r.ts, r.seq) > best[key][0]:
            best[key] = ((r.ts, r.seq), r.v)
    return {(*k, v) for k, (_, v) in best.items()}


def got(t):
    return {(r.site, r.cell, r.v) for r in t.read().collect()}


def files(path):
    return {f: os.path.getsize(f) for f in glob.glob(f"{path}/data/*/bucket=*/*.parquet")}


def test_a_batch_rewrites_only_the_buckets_it_touches(spark, tmp_path):
    t, first = table(spark, tmp_path), rows(spark, 4000)
    assert t.upsert(first, 0) == 0
    before = files(tmp_path)
    assert len(before) == 8
    mine = first.withColumn("b", t.bucket()).where("b = 5 and cell is not null").drop("b").limit(5).withColumn("ts", F.lit(2).cast("long")).withColumn("v", F.lit(-1.0))
    mine = spark.createDataFrame(mine.collect(), first.schema)
    assert t.upsert(mine, 1) == 1
    new = {f: n for f, n in files(tmp_path).items() if f not in before}
    assert len(new) == 1 and "bucket=5" in next(iter(new)) and sum(new.values()) < sum(before.values()) / 6
    assert got(t) == plain(first, mine)
    wanted = spark.createDataFrame([(mine.first().site, mine.first().cell), (0, None), (9, 9)], "site long, cell long")
    assert {(r.site, r.cell) for r in t.lookup(wanted).collect()} == {(mine.first().site, mine.first().cell), (0, None)}


def test_late_ties_replays_and_new_columns(spark, tmp_path):
    t = table(spark, tmp_path)
    one, late, tie = rows(spark, 30, 5), rows(spark, 30, 4), rows(spark, 1, 5, 60)
    tie = tie.withColumn("site", F.lit(0).cast("long")).withColumn("cell", F.lit(0).cast("long"))
    for k, b in enumerate((one, late, tie)):
        t.upsert(b, k, "w")
    assert got(t) == plain(one, late, tie) and t.read().where("site = 0 and cell = 0").first().seq == 60
    assert t.upsert(rows(spark, 30, 9), 2, "w") == 2  # a replay
    assert got(t) == plain(one, late, tie)
    assert t.upsert(rows(spark, 30, 9), 2, "other") == 3
    assert t.upsert(rows(spark, 0), 3, "w") == 4
    t.upsert(rows(spark, 5, 10).withColumn("extra", F.lit("x")))
    assert t.read().where("extra = 'x'").count() == 5 and t.read().count() == t.read().select(*KEYS).distinct().count()
    with pytest.raises(ValueError):
        KeyedTable(spark, str(tmp_path), ["site"], "ts")
    with pytest.raises(ValueError):
        table(spark, tmp_path / "none").read()


def test_a_kill_at_any_step_leaves_the_last_version(spark, tmp_path, monkeypatch):
    t, first, second = table(spark, tmp_path), rows(spark, 50), rows(spark, 50, 2)
    t.upsert(first, 0)
    for step in ("write", "move", "expire"):
        def fail(*a, **k):
            raise RuntimeError("killed")

        with monkeypatch.context() as m:
            if step == "expire":
                m.setattr(KeyedTable, "expire", fail)
            else:
                m.setattr(S.Files, step, fail)
            with pytest.raises(RuntimeError):
                t.upsert(second, 1)
        assert got(table(spark, tmp_path)) == (plain(first, second) if step == "expire" else plain(first))
    again = table(spark, tmp_path)
    assert again.upsert(second, 1) == 1 and got(again) == plain(first, second)  # committed before it was killed
    again.upsert(rows(spark, 0), 2)
    assert len(glob.glob(f"{tmp_path}/data/*")) == 1  # folders of the killed ones are gone


def test_two_writers_of_one_version(spark, tmp_path):
    t = table(spark, tmp_path)
    t.upsert(rows(spark, 5))
    with pytest.raises(OSError):
        t.log.commit(0, {})
    assert got(t) == plain(rows(spark, 5))


def test_old_versions_go_after_the_next_but_one(spark, tmp_path):
    t = table(spark, tmp_path)
    t.upsert(rows(spark, 200), 0)
    held = t.read()
    t.upsert(rows(spark, 200, 2), 1)
    assert held.agg(F.sum("v")).first()[0] == plain_sum(1)  # opened before, still whole
    t.upsert(rows(spark, 200, 3), 2)
    assert len(glob.glob(f"{tmp_path}/data/*/bucket=*")) == 16 and len(glob.glob(f"{tmp_path}/commits/*.json")) == 2
    assert t.resize(3) == 3 and t.read().agg(F.sum("v")).first()[0] == plain_sum(3)
    assert table(spark, tmp_path).buckets == 3 and len(t._entry()[1]["folders"]) == 3


def plain_sum(ts):
    best = {}
    for i in range(200):
        best[i % 3, None if i % 10 == 3 else i] = i * ts
    return sum(best.values())


def test_published_batches_expire(spark, tmp_path):
    for k in range(4):
        assert S.publish_hot(spark.range(k), str(tmp_path)) == k
    assert S.read_hot(spark, str(tmp_path)).count() == 3 and len(glob.glob(f"{tmp_path}/data/*")) == 2


def test_stream_in_several_batches(spark, tmp_path):
    for k in range(4):
        rows(spark, 100, (3, 1, 4, 2)[k]).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(rows(spark, 1).schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    jobs.current_state(stream, f"{tmp_path}/t", f"{tmp_path}/c", KEYS, "ts", ["seq"], 4).awaitTermination()
    t = table(spark, tmp_path / "t")
    assert got(t) == plain(rows(spark, 100, 4)) and list(t._entry()[1]["batches"].values()) == [3]
