"""Retention and storage figures."""

from __future__ import annotations

import datetime
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .commits import Files
from .footers import column_footers


def file_stats(spark: SparkSession, path: str, column: str) -> DataFrame:
    """(file, rows, nulls, least, most) of a column for each file under path, from footers alone. Bounds are numbers, times
    in microseconds, and null for other types; nulls and bounds are null where a file does not tell them."""
    chunks = column_footers(spark, path, [column])
    return chunks.groupBy("file").agg(
        F.sum("rows").alias("rows"), F.when(F.count_if(F.col("nulls").isNull()) == 0, F.sum("nulls")).alias("nulls"), F.min("least_n").alias("least"), F.max("most_n").alias("most"),
    )


def storage_stats(spark: SparkSession, path: str, ts: str = "ts") -> DataFrame:
    """(files, bytes, rows, first_ts, last_ts) of the Parquet under path, from footers alone; a file without bounds of
    ts counts, its times do not."""
    chunks = column_footers(spark, path, [ts])
    per = chunks.groupBy("file").agg(F.max("file_bytes").alias("b"), F.sum("rows").alias("n"), F.min("least_n").alias("lo"), F.max("most_n").alias("hi"))
    at = lambda c: F.timestamp_micros(c.cast("long"))
    return per.agg(F.count("*").alias("files"), F.sum("b").alias("bytes"), F.sum("n").alias("rows"), at(F.min("lo")).alias("first_ts"), at(F.max("hi")).alias("last_ts"))


def file_intervals(spark: SparkSession, path: str, ts: str = "ts", levels: Sequence[str] = ()) -> DataFrame:
    """By the partition folders named in levels (like site for site=3), or over all: files, mean_s and most_s (the seconds
    that a file spans), mean_rows and rows. From footers alone."""
    per = file_stats(spark, path, ts).select("*", (F.col("most") - F.col("least")).alias("span"))
    by = [F.regexp_extract("file", f"/{re.escape(c)}=([^/]*)/", 1).alias(c) for c in levels]
    return per.groupBy(*by).agg(
        F.count("*").alias("files"), (F.avg("span") / 1e6).alias("mean_s"), (F.max("span") / 1e6).alias("most_s"), F.avg("rows").alias("mean_rows"), F.sum("rows").alias("rows"),
    )


def wire_ratio(spark: SparkSession, path: str, topic: str, payload: str) -> DataFrame:
    """(rows, raw_bytes, file_bytes, bytes_per_row, ratio): what the messages took on the wire, 4 bytes
    and topic and payload each, against their files."""
    df = spark.read.parquet(path)
    raw = F.octet_length(topic) + F.octet_length(payload) + 4
    per = df.groupBy(F.col("_metadata.file_path").alias("f")).agg(F.first("_metadata.file_size").alias("b"), F.count("*").alias("n"), F.sum(raw).alias("raw"))
    one = per.agg(F.sum("n").alias("rows"), F.sum("raw").alias("raw_bytes"), F.sum("b").alias("file_bytes"))
    return one.select("*", (F.col("file_bytes") / F.col("rows")).alias("bytes_per_row"), (F.col("raw_bytes") / F.col("file_bytes")).alias("ratio"))


def layout_sizes(spark: SparkSession, layouts: dict[str, str]) -> DataFrame:
    """(layout, bytes, rows, columns, bytes_per_row) of stores written in different layouts."""
    out = None
    for name, path in layouts.items():
        df = spark.read.parquet(path)
        per = df.groupBy(F.col("_metadata.file_path").alias("f")).agg(F.first("_metadata.file_size").alias("b"), F.count("*").alias("n"))
        one = per.agg(F.sum("b").alias("bytes"), F.sum("n").alias("rows")).select(F.lit(name).alias("layout"), "bytes", "rows", F.lit(len(df.columns)).alias("columns"), (F.col("bytes") / F.col("rows")).alias("bytes_per_row"))
        out = one if out is None else out.union(one)
    return out


def retention(df: DataFrame, days: int, as_of: str) -> DataFrame:
    """Rows of the last days partition dates up to as_of."""
    return df.where(F.col("date") > F.date_sub(F.lit(as_of).cast("date"), days))


def trim_store(spark: SparkSession, path: str, days: int, as_of: str, depth: int = 6) -> list[str]:
    """Delete the folders date=... of a store, below up to depth levels of other partitions, that are older than the last
    days up to as_of, and name their days. Nothing is read but lists of folders."""
    first = datetime.date.fromisoformat(as_of) - datetime.timedelta(days=days)
    files, gone = Files(spark, path), set()
    for level in range(depth + 1):
        for f in files.glob(f"{path.rstrip('/')}/{'*=*/' * level}date=*"):
            day = f.getPath().getName().removeprefix("date=")
            if re.fullmatch(r"\d{4}-\d\d-\d\d", day) and datetime.date.fromisoformat(day) <= first:
                files.delete(f.getPath().toString())
                gone.add(day)
    return sorted(gone)
