"""Footers of Parquet files as a table: rows, nulls and bounds of each column chunk, without reading rows.

The list of files comes from Spark; each task opens its files at their ends and reads the footers, a few kilobytes each, so
a store of any size costs a read for each file.
"""

from __future__ import annotations

import datetime
import re
from collections.abc import Iterator, Sequence
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SCHEMA = "file string, file_bytes long, footer_bytes long, row_group int, rows long, column string, bytes long, nulls long, kind string, least string, most string, least_n double, most_n double"
_EPOCH = datetime.datetime(1970, 1, 1)


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(leaf, file, bytes, modified) of each Parquet file under path, without opening it."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
    return listed.select(F.regexp_replace("path", r"/[^/]*$", "").alias("leaf"), F.col("path").alias("file"), F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))


def open_file(path: str) -> pa.NativeFile:
    """A file that a path of Spark names, for reads at any place."""
    scheme, _, rest = re.sub(r"^file:/+", "file:///", re.sub(r"^s3a:", "s3:", path)).rpartition("://")
    fs, inner = pa.fs.FileSystem.from_uri(f"{scheme or 'file'}://{quote(rest)}")
    return fs.open_input_file(inner)


def _number(value: object) -> float | None:
    """Bounds as numbers: whole and broken ones, and times as microseconds."""
    if isinstance(value, datetime.datetime):
        value = value.replace(tzinfo=None) if value.tzinfo is None else value.astimezone(datetime.timezone.utc).replace(tzinfo=None)
        return float((value - _EPOCH) // datetime.timedelta(microseconds=1))
    if isinstance(value, datetime.date):
        return float((value - _EPOCH.date()).days * 86_400_000_000)
    if isinstance(value, bool) or not isinstance(value, (int, float)):
        return None
    return float(value)


def _text(value: object) -> str | None:
    if isinstance(value, bytes):
        return value.decode(errors="replace")
    return None if value is None else str(value)


def footers(files: DataFrame) -> DataFrame:
    """A row for each column chunk of the files (file, bytes): the row group and its rows, the column (dotted if nested), its bytes
    on disk, nulls and bounds, as text and, of numbers and times, as numbers; null where the writer left none. A file
    without row groups gives a row for each column, of row group -1 and no rows. A file that is no Parquet fails."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for f in batch.to_pylist():
                with open_file(f["file"]) as source:
                    meta = pq.read_metadata(source)
                out = []
                for g in range(meta.num_row_groups):
                    group = meta.row_group(g)
                    for c in range(group.num_columns):
                        chunk = group.column(c)
                        stats = chunk.statistics if chunk.is_stats_set else None
                        least, most = (stats.min, stats.max) if stats is not None and stats.has_min_max else (None, None)
                        nulls = stats.null_count if stats is not None and stats.has_null_count else None
                        out.append((
                            f["file"], f["bytes"], meta.serialized_size, g, group.num_rows, chunk.path_in_schema, chunk.total_compressed_size, nulls,
                            chunk.physical_type, _text(least), _text(most), _number(least), _number(most),
                        ))
                if not out:
                    out = [(f["file"], f["bytes"], meta.serialized_size, -1, 0, meta.schema.column(c).path, 0, 0, meta.schema.column(c).physical_type, None, None, None, None) for c in range(meta.num_columns)]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), _TYPES)], names=_NAMES)

    return files.select("file", "bytes").repartition("file").mapInArrow(read, _SCHEMA)


_NAMES = [x.split()[0] for x in _SCHEMA.split(", ")]
_TYPES = [{"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "double": pa.float64()}[x.split()[1]] for x in _SCHEMA.split(", ")]


def column_footers(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """footers of all files under path, of some columns or all."""
    out = footers(list_files(spark, path))
    return out if columns is None else out.where(F.col("column").isin(*columns))


def file_rows(footer: DataFrame) -> DataFrame:
    """(file, rows) of a table of footers."""
    groups = footer.groupBy("file", "row_group").agg(F.max("rows").alias("rows"))
    return groups.groupBy("file").agg(F.sum("rows").alias("rows"))
