"""What several operators of this subpackage share: written tables, components, checked broadcasts."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A table of at most this many short rows may be broadcast; beyond it a shuffle join is used.
BROADCAST_ROWS = 500_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster shares for checkpoints; a temporary one only where none is set and Spark
    runs in this process alone. On a cluster without the setting that is an error."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir names the folder that executors share; it is not set")
        path = tempfile.mkdtemp(prefix="cellwright-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: lineage ends there, and a lost
    executor costs no more than the task it ran."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def released(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of steps whose results are written: its cleaner removes those that the
    driver's collector finds unused, which may else not run for a long time."""
    gc.collect()
    for _ in range(2):  # what a first collection lets go of may be all that holds the rest
        spark.sparkContext._jvm.System.gc()
        time.sleep(1)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each made one that no column of df has, upper and lower case alike."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def shuffled(df: DataFrame) -> DataFrame:
    """df with a hint that it is joined by shuffle and sort. Spark takes a table's size from its compressed files and does not
    see how many rows explode makes of one, so what it would broadcast may be a hundred times as large as it allows."""
    return df.hint("merge")


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if it has at most that many rows, else shuffled. df should be cheap to count."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else shuffled(df)


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased and nothing else changed. Texts of ASCII alone take the faster function."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER)
    )


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of an undirected graph: (node, component), component being the smallest
    node of it, for every node that has an edge. Alternating large-star and small-star; each round
    is a grouping and a join, written to the shared folder, and no node's edges meet in one task.
    Edges with a null end and loops are ignored; an empty table gives an empty table."""
    both = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    now = written(both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    mark, n = None, now.count()
    while True:
        # ids compress so well that the files of millions of edges look small; an edge has two nodes at most
        held = shuffled if 2 * n > BROADCAST_ROWS else lambda df: df
        # large star: every neighbour above u goes to u's smallest neighbour
        near = now.select("u", "v").union(now.select(F.col("v"), F.col("u")).toDF("u", "v"))
        least = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = near.where("v > u").join(held(least), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: u and its smaller neighbours go to the smallest of them
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        step = large.join(held(lower), "u")
        step = step.select(F.col("v").alias("u"), F.col("m").alias("v")).union(step.select("u", F.col("m").alias("v")))
        now = written(step.where("u <> v").distinct(), "star")
        seen = now.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if (seen.n, seen.x) == mark:
            break
        mark, n = (seen.n, seen.x), seen.n
    child = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    root = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return child.union(root)
