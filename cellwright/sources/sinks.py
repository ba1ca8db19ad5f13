"""Partitioned sinks, the table of the last batch, the table of current values."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.query import latest
from .commits import CommitLog


def with_event_date(df: DataFrame, ts: str = "ts") -> DataFrame:
    """df with date, the event's (not the write's): late rows go to their own day."""
    return df.withColumn("date", F.to_date(ts))


def partition_columns(template: str) -> list[str]:
    """Columns of a path template like site={site_id}/{year}/{month}/{day}; year, month and day are the
    one column date."""
    names = [("date" if n in ("year", "month", "day") else n) for n in re.findall(r"\{(\w+)\}", template)]
    return list(dict.fromkeys(names))


def write_store(df: DataFrame, path: str, partitions: Sequence[str] = ("project", "site", "date"), codec: str = "zstd", mode: str = "append") -> None:
    """Write by partition; rows of a partition are brought together first, in tasks of even size, so
    each folder gets few files and a large one several."""
    cols = [c for c in partitions if c in df.columns]
    df = df.hint("rebalance", *cols) if cols else df
    writer = df.write.mode(mode).option("compression", codec)
    (writer.partitionBy(*cols) if cols else writer).parquet(path)


@contextmanager
def open_folders(spark: SparkSession, most: int) -> Iterator[None]:
    """Writes by partition in here keep a file open for each folder of a task, up to most of them, where Spark would sort all rows
    of the task by folder first. Beyond that the rest is sorted, as ever. It is a setting of the session."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name, None)
    spark.conf.set(name, most)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def publish_hot(df: DataFrame, path: str) -> int:
    """Replace the last batch: a new folder is written whole, then a numbered entry names it. Readers of the
    old one keep theirs until the next but one, when its folder goes. Returns the number."""
    name = f"v-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/data/{name}")
    log = CommitLog(df.sparkSession, f"{path}/pointer")
    last = log.last()
    version = last[0] + 1 if last else 0
    log.commit(version, {"version": name})
    versions = log.versions()
    kept = {log.read(v)["version"] for v in versions[-2:]}
    for old in log.files.names(f"{path}/data"):
        if old not in kept:
            log.files.delete(f"{path}/data/{old}")
    for v in versions[:-2]:
        log.forget(v)
    return version


def read_hot(spark: SparkSession, path: str) -> DataFrame:
    """The batch that was published last."""
    last = CommitLog(spark, f"{path}/pointer").last()
    if last is None:
        raise ValueError(f"nothing was published to {path}")
    return spark.read.parquet(f"{path}/data/{last[1]['version']}")


def merge_current(old: DataFrame | None, new: DataFrame, keys: Sequence[str], ts: str, order: Sequence[str] = ()) -> DataFrame:
    """The latest row of each key of both tables. keys are identity columns, never the time."""
    both = new if old is None else old.unionByName(new, allowMissingColumns=True)
    return latest(both, keys, ts, order=order)
