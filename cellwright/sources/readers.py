"""Readers of stores, recordings and annotated CSV."""

from __future__ import annotations

import csv
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import RECORDING


def read_store(spark: SparkSession, *paths: str, merge: bool = True, schema=None) -> DataFrame:
    """Parquet of one or more paths, columns united by name. With a schema, paths that are not there are left out,
    and if none is the table is empty; without one a missing path is an error."""
    reader = spark.read.option("mergeSchema", merge)
    if schema is None:
        return reader.parquet(*paths)
    there = [p for p in paths if path_exists(spark, p)]
    if not there:
        return spark.createDataFrame([], schema)
    return reader.schema(schema).option("ignoreMissingFiles", True).parquet(*there)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path, or a pattern of paths, names something that Spark's file systems have."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(at))


def scoped(df: DataFrame, t0: str, t1: str, project=None, site=None) -> DataFrame:
    """Rows whose partition date is in [t0, t1] (yyyy-mm-dd): of a store written by date only those
    folders are read. A range without data gives an empty table."""
    out = df.where(F.col("date").between(F.lit(t0).cast("date"), F.lit(t1).cast("date")))
    for name, value in (("project", project), ("site", site)):
        out = out if value is None else out.where(F.col(name) == value)
    return out


def with_source_file(df: DataFrame, name: str = "source_file") -> DataFrame:
    return df.withColumn(name, F.col("_metadata.file_path"))


def read_recording(spark: SparkSession, path: str, site: str | None = None, devices: Sequence[str] | None = None, units: Sequence[str] | None = None) -> DataFrame:
    """Messages of a recording (CSV, also compressed) under ems/site/{site}/unit/, topic without that
    prefix up to unit, and site_id, unit_id, device, instance, point_name, dtype. Other topics, those
    of fewer segments and those of the root device are left out."""
    rows = spark.read.schema(RECORDING).csv(path)
    seg = F.split("topic", "/")
    names = {"site_id": 2, "unit_id": 4, "device": 5, "instance": 6, "point_name": 7, "dtype": 8}
    out = rows.where(F.col("topic").startswith("ems/site/") & (F.size(seg) >= 9) & (F.get(seg, F.lit(3)) == "unit"))
    out = out.withColumns({n: F.get(seg, F.lit(k)) for n, k in names.items()}).where("device <> 'root'")
    for name, chosen in (("site_id", [site] if site is not None else None), ("device", devices), ("unit_id", units)):
        out = out if chosen is None else out.where(F.col(name).isin(*chosen))
    return out.withColumn("topic", F.array_join(F.slice(F.split("topic", "/"), 4, 6), "/"))


#: Fixed names: bookkeeping columns, and the field names that stand for types.
_DROPPED = {"", "result", "table", "_start", "_stop"}
DTYPES = ("float", "integer", "boolean_integer", "string", "boolean")


_ANNOTATED = {
    "time": pa.string(), "measurement": pa.string(), "field": pa.string(), "value_f": pa.float64(), "value_i": pa.int64(), "value_str": pa.string(),
    "tags": pa.map_(pa.string(), pa.string()),
}
#: Rows of tables are given out once they are so many.
_ROWS = 20_000


def _table_rows(block: str, schema: str) -> list[tuple]:
    """Rows of one table of annotated CSV, columns as in _ANNOTATED. Places of columns are looked up once for the table."""
    lines = list(csv.reader(block.strip("\r\n").splitlines()))
    kinds = next((r for r in lines if r and r[0] == "#datatype"), None)
    default = next((r for r in lines if r and r[0] == "#default"), [])
    body = [r for r in lines if r and not r[0].startswith("#")]
    if not kinds or not body:
        return []
    head, rows = body[0], body[1:]
    kind = dict(zip(head, kinds, strict=False)).get("_value", "double")
    given = {k: d for k, d in enumerate(default) if d}
    for r in rows:
        for k, d in given.items():
            if k < len(r) and not r[k]:
                r[k] = d
    place = {n: k for k, n in enumerate(head)}
    if len(place) < len(head) or any(len(r) < len(head) for r in rows):  # names twice, or short rows: what a row has of each name
        rows = [[named.get(n) for n in place] for named in (dict(zip(head, r, strict=False)) for r in rows)]
        place = {n: k for k, n in enumerate(place)}
    column = lambda name: [r[place[name]] for r in rows] if name in place else [None] * len(rows)
    fields = column("_field")
    ems = schema == "ems" or (schema == "auto" and set(fields) <= set(DTYPES))
    labels = [(n, k) for n, k in place.items() if n not in _DROPPED and not n.startswith("_")]
    out = []
    for r, time, measurement, field, value in zip(rows, column("_time"), column("_measurement"), fields, column("_value"), strict=True):
        value = "" if value is None else value
        whole = field in ("integer", "boolean_integer") if ems else kind in ("long", "unsignedLong")
        try:
            number = float(value) if kind != "string" else None
        except ValueError:
            number = None
        tags = [(n, r[k]) for n, k in labels if r[k]]
        out.append((time, measurement, field, None if whole else number, int(number) if whole and number is not None else None, value if kind == "string" else None, tags))
    return out


def read_annotated_csv(spark: SparkSession, path: str, schema: str = "auto") -> DataFrame:
    """Rows of annotated CSV files: several tables in a file, each with #group, #datatype and #default
    lines and a header, blank lines between.

    Result: ts, measurement, field, value_f, value_i, value_str, tags (the other columns). schema "ems":
    field is a type, and integer kinds go to value_i; "standard": field is a signal's name; "auto":
    "ems" for a table whose fields are all type names. A file is read by one task, block by block."""
    files = spark.read.text(path, wholetext=True).select(F.col("value").alias("text"))
    blocks = files.select(F.explode(F.split("text", r"\r?\n[ \t]*\r?\n")).alias("block")).where(F.trim("block") != "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for batch in batches:
            for block in batch.column(0).to_pylist():
                out += _table_rows(block, schema)
                if len(out) >= _ROWS:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), _ANNOTATED.values())], names=list(_ANNOTATED))
                    out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), _ANNOTATED.values())], names=list(_ANNOTATED))

    rows = blocks.mapInArrow(run, "time string, measurement string, field string, value_f double, value_i long, value_str string, tags map<string,string>")
    return rows.select(F.try_to_timestamp("time").alias("ts"), "measurement", "field", "value_f", "value_i", "value_str", "tags")
