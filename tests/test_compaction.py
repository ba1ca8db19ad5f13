"""Compaction: failures at every step, late files, groups, one plan for many folders; footers against scans."""

import glob
import os
import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from cellwright import plans
from cellwright import sources as S
from cellwright.plans import ingest_queries
from cellwright.sources import compaction
from cellwright.sources.commits import Files
from cellwright.sources.footers import footers

from .conftest import DATA


def fill(spark, path, folders=2, files=4, rows=10, first=0):
    for k in range(files):
        df = spark.range(first + k * rows, first + (k + 1) * rows).withColumn("v", F.when(F.col("id") % 2 == 0, 1))
        for d in range(folders):
            df.withColumn("d", F.lit(d)).coalesce(1).write.mode("append").parquet(f"{path}/site=a b/date=2024-01-{d + 1:02d}")


def rows(spark, path):
    return sorted((r.d, r.id) for r in spark.read.parquet(path).select("d", "id").collect())


def names(path):
    return sorted(glob.glob(f"{path}/*/*/*.parquet"))


STEPS = ["plan", "merge", "count", "journal", "ready", "first move", "rename fails", "second move", "first delete", "second delete", "done", "clean"]


@pytest.mark.parametrize("step", STEPS)
def test_a_crash_at_any_step_loses_and_doubles_nothing(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "s")
    fill(spark, path, 2, 3)
    want, old = rows(spark, path), names(path)
    seen = {"move": 0, "delete": 0}
    move, delete, write = Files.move, Files.delete, Files.write

    def killed(*a, **k):
        raise RuntimeError("killed")

    def counted(kind, plain):
        def run(self, source, *target):
            mine = source.endswith(".parquet")
            seen[kind] += mine
            if mine and step == f"{('first', 'second')[seen[kind] - 1] if seen[kind] <= 2 else ''} {kind}":
                raise RuntimeError("killed")
            if step == "done" and source.endswith("/READY") or step == "clean" and kind == "delete" and "/_compact/" in source:
                raise RuntimeError("killed")
            if step == "rename fails" and kind == "move" and mine:
                raise OSError("not moved")
            return plain(self, source, *target)

        return run

    with monkeypatch.context() as m:
        m.setattr(Files, "move", counted("move", move))
        m.setattr(Files, "delete", counted("delete", delete))
        if step in ("plan", "merge"):
            m.setattr(compaction, {"plan": "_described", "merge": "_merge"}[step], killed)
        if step == "count":
            m.setattr(compaction, "footers", lambda f, plain=footers: plain(f).where("rows < 0") if "group" in f.columns and "leaf" in f.columns and "modified" in f.columns else plain(f))
        if step == "journal":
            m.setattr(compaction.F, "concat_ws", killed)
        if step == "ready":
            m.setattr(Files, "write", killed)
        with pytest.raises((RuntimeError, OSError)):
            S.compact(spark, path)
    before_ready = STEPS.index(step) <= STEPS.index("ready")
    if before_ready:
        assert names(path) == old
    assert set(rows(spark, path)) == set(want)  # never less
    S.recover(spark, path)
    assert rows(spark, path) == want and Files(spark, path).names(f"{path}/_compact") == []
    assert len(names(path)) == (6 if before_ready else 2)
    S.compact(spark, path)
    assert rows(spark, path) == want and len(names(path)) == 2
    assert write is Files.write


def test_a_rename_that_reports_failure(spark, tmp_path):
    (tmp_path / "x").mkdir()
    (tmp_path / "taken").mkdir()
    files = Files(spark, str(tmp_path))
    with pytest.raises(OSError):
        files.move(str(tmp_path / "x"), str(tmp_path / "taken"))
    with pytest.raises(OSError):
        files.move(str(tmp_path / "gone"), str(tmp_path / "z"))
    files.delete(str(tmp_path / "gone"))  # gone already


def test_late_files_are_merged_and_full_ones_left(spark, tmp_path):
    path = str(tmp_path / "s")
    fill(spark, path, 1, 3)
    S.compact(spark, path)
    fill(spark, path, 1, 5, first=1000)
    want = rows(spark, path)
    done = S.compact(spark, path).collect()
    assert [(r.files, r.rows) for r in done] == [(6, 80)] and rows(spark, path) == want and len(names(path)) == 1
    fill(spark, path, 1, 3, first=5000)
    size = max(map(os.path.getsize, names(path)))
    assert [r.files for r in S.compact(spark, path, target_bytes=size).collect()] == [3]  # the compacted one is full


def test_groups_hold_about_the_target(spark, tmp_path):
    path = str(tmp_path / "s")
    fill(spark, path, 1, 12)
    size = os.path.getsize(names(path)[0])
    plan = S.planned(spark, path, target_bytes=3 * size)
    groups = [r.n for r in plan.groupBy("group").agg(F.count("*").alias("n")).collect()]
    assert sum(groups) == 12 and max(groups) <= 4 and len(groups) <= 5
    want = rows(spark, path)
    S.compact(spark, path, target_bytes=3 * size)
    assert len(names(path)) == len(groups) and rows(spark, path) == want


def test_folders_of_other_columns_keep_theirs(spark, tmp_path):
    for k in range(3):
        spark.range(5).coalesce(1).write.mode("append").parquet(f"{tmp_path}/s/x=1")
        spark.range(5).withColumn("only here", F.when(F.col("id") > 3, "y")).coalesce(1).write.mode("append").parquet(f"{tmp_path}/s/x=2")
    spark.createDataFrame([], "id long").coalesce(1).write.parquet(f"{tmp_path}/s/x=3")
    shares = {r.leaf[-3:]: r.null_pct for r in S.compact(spark, f"{tmp_path}/s", min_files=1).collect()}
    assert shares == {"x=1": 0.0, "x=2": pytest.approx(40.0)}
    columns = {d: pq.ParquetFile(glob.glob(f"{tmp_path}/s/{d}/*.parquet")[0]).schema_arrow.names for d in ("x=1", "x=2", "x=3")}
    assert columns == {"x=1": ["id"], "x=2": ["id", "only here"], "x=3": ["id"]}


def jobs(spark, path, run):
    group = f"jobs of {path}"
    spark.sparkContext.setJobGroup(group, group)
    run()
    found = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return found


def test_jobs_do_not_grow_with_folders(spark, tmp_path):
    counts = []
    for n in (40, 160):
        path = f"{tmp_path}/s{n}"
        spark.range(n * 30).withColumn("d", F.col("id") % n).repartition(3).write.partitionBy("d").parquet(path)
        want = spark.read.parquet(path).agg(F.count("*"), F.sum("id"), F.sum("d")).first()
        counts.append(jobs(spark, path, lambda path=path: S.compact(spark, path)))
        assert len(glob.glob(f"{path}/d=*/*.parquet")) == n
        assert spark.read.parquet(path).agg(F.count("*"), F.sum("id"), F.sum("d")).first() == want
    assert counts[1] <= counts[0] + 3


def writes_to(spark, path):
    """Plans of the writes to folders below path."""
    done = spark._jsparkSession.sharedState().statusStore().executionsList()
    plans = [done.apply(k).physicalPlanDescription() for k in range(done.size())]
    return [p for p in plans if "InsertIntoHadoopFsRelationCommand" in p and path in p]


def test_rows_of_a_group_are_not_sorted_to_be_written(spark, tmp_path):
    path = str(tmp_path / "s")
    fill(spark, path, 2, 3)
    want = rows(spark, path)
    S.compact(spark, path)
    found = [p for p in writes_to(spark, path) if "/data-0" in p]
    assert len(found) == 1 and not re.search(r"\[_group#\d+ ASC", found[0])
    assert rows(spark, path) == want and spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_a_task_of_more_groups_than_it_keeps_open(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "s")
    fill(spark, path, 5, 3)
    want = rows(spark, path)
    monkeypatch.setattr(compaction, "_OPEN", 1)
    S.compact(spark, path)
    assert rows(spark, path) == want and len(names(path)) == 5


def test_events_by_unit_are_not_sorted_to_be_written(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ingest_queries, "scratch", lambda s: str(tmp_path / "q"))
    plans.QUERIES["compact_inject_unit"](spark, DATA)
    found = writes_to(spark, f"{tmp_path}/q/by-unit")
    assert len(found) == 1 and not re.search(r"\[unit#\d+ ASC", found[0])


def test_verified_store_is_one_file_of_any_size(spark, monkeypatch):
    monkeypatch.setattr(ingest_queries, "compact", lambda *a, **k: S.compact(*a, **({"target_bytes": 1000} | k)))
    assert plans.QUERIES["compact_verify"](spark, DATA).first().files == 1


def test_footers_are_the_scan(spark, tmp_path):
    df = spark.range(300_000).select(
        "id", F.when(F.col("id") % 3 == 0, F.col("id") / 7).alias("v"), F.concat(F.lit("name "), F.col("id")).alias("s"), F.expr("date_add(date'2024-01-01', cast(id % 40 as int))").alias("day"),
        F.lit(None).cast("double").alias("none"), F.struct((F.col("id") * 2).alias("inner")).alias("nest"),
    )
    df.repartition(3).write.parquet(str(tmp_path / "s"))
    chunks = S.column_footers(spark, str(tmp_path / "s"))
    of = {r.column: r for r in chunks.groupBy("column").agg(F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"), F.min("least_n").alias("lo"), F.max("most_n").alias("hi"), F.min("least").alias("lt")).collect()}
    assert {c: (r.rows, r.nulls) for c, r in of.items()} == {"id": (300_000, 0), "v": (300_000, 200_000), "s": (300_000, 0), "day": (300_000, 0), "none": (300_000, 300_000), "nest.inner": (300_000, 0)}
    assert (of["id"].lo, of["id"].hi) == (0, 299_999) and of["none"].lo is None and of["nest.inner"].hi == 599_998 and of["s"].lt == "name 0"
    assert (of["v"].lo, of["v"].hi) == (0.0, 299_997 / 7) and of["day"].hi - of["day"].lo == 39 * 86_400e6
    read = chunks.select("file", "footer_bytes", "file_bytes").distinct().agg(F.sum("footer_bytes"), F.sum("file_bytes")).first()
    assert read[0] < 0.01 * read[1]  # what is read of the files
    stats = S.storage_stats(spark, str(tmp_path / "s"), "day").first()
    assert (stats.files, stats.rows) == (3, 300_000) and stats.bytes == sum(map(os.path.getsize, glob.glob(f"{tmp_path}/s/*.parquet")))
    assert {r.nulls for r in S.file_stats(spark, str(tmp_path / "s"), "none").collect()} == {100_000}


def test_trim_at_any_depth(spark, tmp_path):
    df = spark.range(20).select("id", F.lit("p").alias("project"), (F.col("id") % 2).alias("site"), F.expr("date_add(date'2024-01-01', cast(id div 2 as int))").alias("date"))
    S.write_store(df, str(tmp_path / "s"))
    gone = S.trim_store(spark, str(tmp_path / "s"), 3, "2024-01-10")
    assert gone == [f"2024-01-{d:02d}" for d in range(1, 8)]
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "s")).collect()) == list(range(14, 20))
