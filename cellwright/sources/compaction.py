"""Compaction of a store: one plan for all folders, one job, and a journal that is replayed.

    _compact/<id>/plan/      the files to merge and their groups
    _compact/<id>/data-*/    the merged rows, a folder for each group
    _compact/<id>/journal/   every move and deletion to do
    _compact/<id>/READY      from here on the compaction happens, whatever fails; DONE once it has

Until READY is there nothing but that hidden folder is touched. Then new files are moved in, each result is looked at, and
only when all are in place the old ones are deleted. A run that was cut off is finished, or thrown away if it was not
ready, by the next one or by recover; until then a reader may see a folder's rows twice, never less than once.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators.joins import ffill
from .commits import Files
from .footers import footers, list_files
from .sinks import open_folders

_COMPACTED = "compact-"
_SCHEMA = "leaf string, files long, bytes long, rows long, null_pct double, compacted boolean"
#: A compacted file of that share of the target's bytes is left alone.
FULL = 0.75
#: Up to so many files their plan is sent to all tasks.
_FEW = 100_000
#: A task that writes groups keeps so many of them open before it sorts; by chance one gets more in a million.
_OPEN = 8


def planned(spark: SparkSession, path: str, min_files: int = 3, min_age_s: float = 0, target_bytes: int = 128 << 20) -> DataFrame:
    """(leaf, file, bytes, group) of the files to merge: those of folders that have at least min_files of them, none younger
    than min_age_s, and one at least that was not compacted before; compacted files of full size stay out. A folder's
    files are packed, in order of their names, into groups of about target_bytes."""
    files = list_files(spark, path).withColumn("old", F.col("file").contains(f"/{_COMPACTED}"))
    files = files.where(~(F.col("old") & (F.col("bytes") >= FULL * target_bytes)))
    leaf = Window.partitionBy("leaf")
    fresh = ~F.col("old")
    age = F.lit(time.time()) - F.max(F.when(fresh, F.col("modified").cast("double"))).over(leaf)
    files = files.withColumns({"n": F.count("*").over(leaf), "age": age, "fresh": F.count_if(fresh).over(leaf)})
    files = files.where((F.col("n") >= max(min_files, 1)) & (F.col("fresh") > 0) & (F.lit(min_age_s <= 0) | (F.col("age") >= min_age_s)))
    before = F.sum("bytes").over(leaf.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))
    group = F.md5(F.concat_ws("|", "leaf", F.floor(F.coalesce(before, F.lit(0)) / target_bytes).cast("string")))
    return files.select("leaf", "file", "bytes", group.alias("group"))


def _described(plan: DataFrame, unit_from_name: bool) -> DataFrame:
    """plan with rows and nulls of each file, and columns: the names, sorted, that any file of the folder has. From footers alone."""
    chunks = footers(plan).withColumn("name", F.regexp_extract("column", r"^[^.]*", 0))
    per = chunks.groupBy("file").agg(
        F.sum("nulls").alias("nulls"), F.count_if(F.col("nulls").isNull()).alias("unknown"), F.collect_set("name").alias("names"), F.collect_set(F.struct("row_group", "rows")).alias("groups"),
    )
    rows = F.aggregate("groups", F.lit(0).cast("long"), lambda a, g: a + g["rows"])
    per = per.select("file", "nulls", "unknown", "names", rows.alias("rows"))
    leaf = Window.partitionBy("leaf")
    out = plan.join(per, "file").withColumn("columns", F.array_sort(F.array_distinct(F.flatten(F.collect_set("names").over(leaf)))))
    missing = F.size("columns") - F.size("names")
    out = out.withColumn("nulls", F.when(F.col("unknown") == 0, F.col("nulls") + F.col("rows") * missing))
    if unit_from_name:  # a column that is going to be filled
        out = out.withColumn("columns", F.array_sort(F.array_union("columns", F.array(F.lit("unit_id")))))
    return out.select("leaf", "file", "bytes", "group", "rows", "nulls", "columns")


def _report(plan: DataFrame, compacted: bool) -> DataFrame:
    rows = plan.groupBy("leaf").agg(
        F.count("*").alias("files"), F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"),
        F.count_if(F.col("nulls").isNull()).alias("unknown"), F.first("columns").alias("columns"),
    )
    share = 100.0 * F.col("nulls") / F.greatest(F.col("rows") * F.size("columns"), F.lit(1))
    return rows.select("leaf", "files", "bytes", "rows", F.when(F.col("unknown") == 0, share).alias("null_pct"), F.lit(compacted).alias("compacted"))


def _merge(spark: SparkSession, plan: DataFrame, columns: Sequence[str], to: str, codec: str, by: Sequence[str], order: Sequence[str], unit_from_name: bool) -> None:
    """Write the files of plan, whose folders have these columns, as one folder _group=<group> for each group: one job."""
    mine = plan.where(F.col("columns") == F.array(*map(F.lit, columns)))
    named = [r["file"] for r in mine.select("file").collect()]  # a list of files, as any reader's listing is
    df = spark.read.option("mergeSchema", True).parquet(*named)
    plain = lambda c: F.regexp_replace(c, "^file:/+", "file:/")
    decoded = lambda c: F.url_decode(F.replace(F.col(f"_metadata.{c}"), F.lit("+"), F.lit("%2B")))
    kept = list(df.columns)
    df = df.select("*", plain(decoded("file_path")).alias("_file"), decoded("file_name").alias("_name"))
    if unit_from_name and "unit_id" not in kept:
        df, kept = df.withColumn("unit_id", F.regexp_extract("_name", r"^([^_]+)_", 1)), [*kept, "unit_id"]
    where = mine.select(plain(F.col("file")).alias("_file"), F.col("leaf").alias("_leaf"), F.col("group").alias("_group"))
    df = df.join(F.broadcast(where) if len(named) <= _FEW else where, "_file")
    if by:
        df = ffill(df, ["_leaf", *by], order, [c for c in kept if c not in {*by, *order}])
    groups = mine.select("group").distinct().count()
    out = df.select(*[F.col(f"`{c}`") for c in kept], "_group").repartition(groups, "_group")
    with open_folders(spark, _OPEN):  # a group is written as it comes: its rows are not held
        out.write.partitionBy("_group").option("compression", codec).parquet(to)


def compact(spark: SparkSession, path: str, min_files: int = 3, min_age_s: float = 0, codec: str = "zstd", ffill_by: Sequence[str] = (), ffill_order: Sequence[str] = (), dry_run: bool = False, target_bytes: int = 128 << 20, unit_from_name: bool = False) -> DataFrame:
    """Merge the small files of all folders under path; (leaf, files, bytes, rows, null_pct, compacted) of those that have any.

    See planned for which they are: files that came after a folder was compacted are merged too, with
    compacted ones that are not yet full. All folders of equal columns are one job. Rows are counted, group by group,
    in the footers of the new files before anything is moved. ffill_by and ffill_order fill nulls forward within
    a folder on the way. unit_from_name takes unit_id from the part of the file's name before "_" in folders without
    the column. null_pct is null where files have no counts of nulls. dry_run only reports. One compaction of a
    store runs at a time."""
    if not dry_run:
        recover(spark, path)
    at = f"{path.rstrip('/')}/_compact/{uuid.uuid4().hex}"
    plan = _described(planned(spark, path, min_files, min_age_s, target_bytes), unit_from_name)
    if dry_run:
        return spark.createDataFrame(_report(plan, False).collect(), _SCHEMA)  # a row for each folder
    plan.write.parquet(f"{at}/plan")
    plan = spark.read.parquet(f"{at}/plan")
    full = plan.withColumn("all", F.sum("rows").over(Window.partitionBy("leaf"))).where("all > 0").drop("all")
    report = _report(full, True).collect()
    files = Files(spark, path)
    if not report:
        files.delete(at)
        return spark.createDataFrame([], _SCHEMA)
    for k, r in enumerate(full.select("columns").distinct().collect()):
        _merge(spark, full, r["columns"], f"{at}/data-{k}", codec, ffill_by, ffill_order, unit_from_name)
    new = list_files(spark, at).where(F.col("file").contains("/data-"))
    new = new.withColumn("group", F.regexp_extract("file", r"/_group=([0-9a-f]{32})/", 1))
    counted = footers(new).select("file", "row_group", "rows").distinct().groupBy("file").agg(F.sum("rows").alias("got"))
    counted = new.join(counted, "file").groupBy("group").agg(F.sum("got").alias("got"))
    wrong = full.groupBy("group").agg(F.sum("rows").alias("rows")).join(counted, "group", "full").where("coalesce(rows, 0) <> coalesce(got, 0)")
    if wrong.limit(1).count():
        raise RuntimeError(f"{at} has not the rows of its files; nothing was moved")
    name = F.concat_ws("/", "leaf", F.concat(F.lit(f"{_COMPACTED}{at[-32:-24]}-"), F.substring("group", 1, 12), F.lit("-"), F.regexp_extract("file", r"([^/]*)$", 1)))
    moves = new.drop("leaf").join(full.select("leaf", "group").distinct(), "group").select(F.lit("move").alias("step"), F.col("file").alias("source"), name.alias("target"))
    deletions = full.select(F.lit("delete").alias("step"), F.col("file").alias("source"), F.lit(None).cast("string").alias("target"))
    moves.union(deletions).write.parquet(f"{at}/journal")
    files.write(f"{at}/READY", "")
    _apply(spark, files, at)
    return spark.createDataFrame(report, _SCHEMA)


def _apply(spark: SparkSession, files: Files, at: str) -> None:
    """Do what a journal still has to do: all moves, then all deletions."""
    steps = spark.read.parquet(f"{at}/journal").collect()  # a row for each file
    for r in steps:
        if r["step"] == "move" and (files.exists(r["source"]) or not files.exists(r["target"])):
            files.move(r["source"], r["target"])
    for r in steps:
        if r["step"] == "delete":
            files.delete(r["source"])
    files.move(f"{at}/READY", f"{at}/DONE")
    files.delete(at)


def recover(spark: SparkSession, path: str) -> list[str]:
    """Finish the compactions of a store that were cut off after they were ready, and throw away the others; their names."""
    base = f"{path.rstrip('/')}/_compact"
    files = Files(spark, path)
    found = files.names(base)
    for name in found:
        if files.exists(f"{base}/{name}/READY"):
            _apply(spark, files, f"{base}/{name}")
        else:
            files.delete(f"{base}/{name}")
    return found
