"""A table of one row for each key, kept up to date by batches: hash buckets, copied when a batch touches them.

    data/<name>/bucket=<k>/   the rows of bucket k as some batch left them
    commits/<version>.json    for each bucket the folder that holds it, schema, keys, and the last batch of each writer

A batch reads the touched buckets only, writes them anew in one job beside the old ones, and then commits a manifest.
Before that commit nothing of it is seen, after it all. A batch that was committed already is skipped, so
streams may replay. Folders that neither of the last two versions names are deleted: a reader keeps what it has opened until
the next commit but one. Of two writers at one time the second fails, at its commit or as its folder is gone.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.query import latest
from .commits import CommitLog

#: Versions that stay readable.
KEPT = 2


@dataclass
class KeyedTable:
    """keys: identity columns, never the time. Of rows of a key the one with the largest ts holds, of equal ones that of the largest order columns."""

    spark: SparkSession
    path: str
    keys: Sequence[str]
    ts: str
    order: Sequence[str] = ()
    buckets: int = 64

    def __post_init__(self) -> None:
        self.log = CommitLog(self.spark, f"{self.path}/commits")
        last = self.log.last()
        if last is not None:  # the number of buckets is the table's, not the caller's
            entry = last[1]
            if entry["keys"] != list(self.keys) or entry["ts"] != self.ts:
                raise ValueError(f"{self.path} is a table by {entry['keys']} and {entry['ts']}")
            self.buckets = entry["buckets"]

    def bucket(self) -> Column:
        """The bucket of a row. Null keys are values like others."""
        parts = [x for k in self.keys for x in (F.col(k).isNull(), F.col(k).cast("string"))]
        return F.pmod(F.xxhash64(*parts), F.lit(self.buckets)).cast("int")

    def _entry(self) -> tuple[int, dict]:
        empty = {"folders": {}, "schema": None, "batches": {}, "keys": list(self.keys), "ts": self.ts, "buckets": self.buckets}
        return self.log.last() or (-1, empty)

    def _rows(self, entry: dict, buckets: Sequence[str] | None = None) -> DataFrame | None:
        folders = [f"{self.path}/data/{name}/bucket={b}" for b, name in entry["folders"].items() if buckets is None or b in buckets]
        if not entry["schema"]:
            return None
        schema = StructType.fromJson(json.loads(entry["schema"]))
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def read(self) -> DataFrame:
        """All rows of the last version."""
        rows = self._rows(self._entry()[1])
        if rows is None:
            raise ValueError(f"nothing was written to {self.path}")
        return rows

    def lookup(self, keys: DataFrame) -> DataFrame:
        """The rows of the keys in a table of key columns. Only their buckets are read; there are no more of them than the table has."""
        entry = self._entry()[1]
        touched = [str(r["b"]) for r in keys.select(self.bucket().alias("b")).distinct().collect()]
        rows = self._rows(entry, touched)
        if rows is None:
            raise ValueError(f"nothing was written to {self.path}")
        wanted = keys.select(*[F.col(k).alias(f"_{k}") for k in self.keys]).distinct()
        same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in self.keys]
        return rows.join(wanted, same, "left_semi")

    def upsert(self, batch: DataFrame, batch_id: int | None = None, writer: str = "") -> int:
        """Merge a batch and return the version that has it. With a batch_id, a batch whose number is not above the writer's
        last one changes nothing. Columns that the table or the batch lacks are null; an empty batch
        commits its number alone."""
        version, entry = self._entry()
        if batch_id is not None and entry["batches"].get(writer, -1) >= batch_id:
            return version
        new = latest(batch, self.keys, self.ts, order=self.order).withColumn("bucket", self.bucket())
        name = uuid.uuid4().hex
        touched = [str(r["bucket"]) for r in batch.select(self.bucket().alias("bucket")).distinct().collect()]  # at most as many as there are buckets
        folders, schema = dict(entry["folders"]), entry["schema"]
        if touched:
            old = self._rows(entry, touched)
            rows = new
            if old is not None:
                rows = old.withColumn("bucket", self.bucket()).unionByName(new, allowMissingColumns=True)
                rows = latest(rows, [*self.keys, "bucket"], self.ts, order=self.order)
            rows.repartition("bucket").write.partitionBy("bucket").option("compression", "zstd").parquet(f"{self.path}/data/{name}")
            folders |= {b: name for b in touched}
            schema = json.dumps(rows.drop("bucket").schema.jsonValue())
        batches = entry["batches"] | ({writer: batch_id} if batch_id is not None else {})
        self.log.commit(version + 1, entry | {"folders": folders, "schema": schema, "batches": batches})
        self.expire()
        return version + 1

    def expire(self) -> list[str]:
        """Delete what no version of the last KEPT names, folders of batches that never were committed included, and name it. A
        folder of a bucket goes when its own bucket was copied, even if others of that batch still serve."""
        versions = self.log.versions()
        entries = [self.log.read(v) for v in versions[-KEPT:]]
        used = {(name, b) for e in entries for b, name in e["folders"].items()}
        files, gone = self.log.files, []
        for name in files.names(f"{self.path}/data"):
            kept = {b for n, b in used if n == name}
            if not kept:
                gone.append(name)
            else:
                gone += [f"{name}/{f}" for f in files.names(f"{self.path}/data/{name}") if f.startswith("bucket=") and f.removeprefix("bucket=") not in kept]
        for name in gone:
            files.delete(f"{self.path}/data/{name}")
        for v in versions[:-KEPT]:
            self.log.forget(v)
        return gone

    def resize(self, buckets: int) -> int:
        """Deal all rows into another number of buckets: one rewrite, committed like a batch."""
        version, entry = self._entry()
        rows = self._rows(entry)
        self.buckets, name = buckets, uuid.uuid4().hex
        folders = {}
        if rows is not None:
            rows = rows.withColumn("bucket", self.bucket())
            rows.repartition(buckets, "bucket").write.partitionBy("bucket").option("compression", "zstd").parquet(f"{self.path}/data/{name}")
            folders = {f.removeprefix("bucket="): name for f in self.log.files.names(f"{self.path}/data/{name}") if f.startswith("bucket=")}
        self.log.commit(version + 1, entry | {"folders": folders, "buckets": buckets})
        self.expire()
        return version + 1
