"""Files through Hadoop's file systems with every result looked at, and a log of versions that are committed by one rename."""

from __future__ import annotations

import json
import uuid

from py4j.java_gateway import JavaObject
from pyspark.sql import SparkSession


class Files:
    """The file system of a path. No step's failure passes unseen."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark._jvm
        self.of = self.jvm.org.apache.hadoop.fs.Path
        self.fs = self.of(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self.fs.exists(self.of(path))

    def names(self, path: str) -> list[str]:
        """Names in a folder, sorted; none if it is not there."""
        return sorted(f.getPath().getName() for f in self.fs.listStatus(self.of(path))) if self.exists(path) else []

    def glob(self, pattern: str) -> list[JavaObject]:
        return list(self.fs.globStatus(self.of(pattern)) or [])

    def move(self, source: str, target: str) -> None:
        """Rename a file or folder to a name that is free."""
        if not self.exists(source) or self.exists(target) or not self.fs.rename(self.of(source), self.of(target)) or not self.exists(target):
            raise OSError(f"{source} was not moved to {target}")

    def delete(self, path: str) -> None:
        """Delete a file or folder; one that is gone already is no failure."""
        if not self.fs.delete(self.of(path), True) and self.exists(path):
            raise OSError(f"{path} was not deleted")

    def folder(self, path: str) -> None:
        if not self.fs.mkdirs(self.of(path)):
            raise OSError(f"{path} was not made")

    def read(self, path: str) -> str:
        stream = self.fs.open(self.of(path))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        """Write a small file under a hidden name and rename it, so that it is there whole or not at all."""
        folder, _, name = path.rpartition("/")
        hidden = f"{folder}/.{name}-{uuid.uuid4().hex}"
        self.folder(folder)
        stream = self.fs.create(self.of(hidden), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        try:
            self.move(hidden, path)
        except OSError:
            self.delete(hidden)
            raise


class CommitLog:
    """Numbered entries in a folder. An entry is there once its file is renamed into place; of two writers of
    one number the second fails and has changed nothing."""

    def __init__(self, spark: SparkSession, path: str):
        self.files, self.path = Files(spark, path), path

    def _name(self, version: int) -> str:
        return f"{self.path}/{version:020d}.json"

    def versions(self) -> list[int]:
        return [int(n.removesuffix(".json")) for n in self.files.names(self.path) if n.endswith(".json") and n[0] != "."]

    def read(self, version: int) -> dict:
        return json.loads(self.files.read(self._name(version)))

    def last(self) -> tuple[int, dict] | None:
        versions = self.versions()
        return (versions[-1], self.read(versions[-1])) if versions else None

    def commit(self, version: int, entry: dict) -> None:
        self.files.write(self._name(version), json.dumps(entry))

    def forget(self, version: int) -> None:
        self.files.delete(self._name(version))
