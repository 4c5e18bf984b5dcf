"""Tables that are replaced as a whole: a reader sees the last complete version or the one before, never none or half of one.

A table is a folder. Each version is a Parquet folder of its own in it, and the file ``_current`` names the version
that counts. A version is written first; then the name is written beside ``_current`` and moved over it in one step. A writer that
dies before that step leaves a folder that nobody reads; the next one that publishes removes it. The version that was
replaced stays until the next one, for readers that are still at it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

POINTER = "_current"


class _Folder:
    """File operations of a table's folder through Spark's own file systems."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark._jvm
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.path = path.rstrip("/")
        self.system = self.place("").getFileSystem(self.conf)

    def place(self, name: str) -> Any:
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def read(self, name: str) -> str | None:
        if not self.system.exists(self.place(name)):
            return None
        file = self.system.open(self.place(name))
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(file)).decode()
        finally:
            file.close()

    def replace(self, name: str, text: str) -> None:
        """Write beside the file and move over it in one step."""
        fresh = f"{name}-{uuid.uuid4().hex}"
        out = self.system.create(self.place(fresh), False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.place("").toUri(), self.conf)
        overwrite = self.jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        options = self.jvm.java.lang.reflect.Array.newInstance(overwrite.getClass(), 1)
        options[0] = overwrite
        context.rename(self.system.makeQualified(self.place(fresh)), self.system.makeQualified(self.place(name)), options)

    def versions(self) -> list[str]:
        if not self.system.exists(self.place("")):
            return []
        names = (status.getPath().getName() for status in self.system.listStatus(self.place("")))
        return [name for name in names if name.startswith("version-")]

    def drop(self, name: str) -> None:
        self.system.delete(self.place(name), True)


def write_version(tables: DataFrame | Mapping[str, DataFrame], path: str, number: int = 0) -> str:
    """The first step: write a version that nobody reads yet; returns its name. Several tables are one version together."""
    name = f"version-{number:012d}-{uuid.uuid4().hex}"
    for part, df in _parts(tables).items():
        df.write.parquet(_place(path, name, part))
    return name


def _parts(tables: DataFrame | Mapping[str, DataFrame]) -> Mapping[str, DataFrame]:
    return {"": tables} if isinstance(tables, DataFrame) else tables


def _place(path: str, name: str, part: str) -> str:
    return f"{path.rstrip('/')}/{name}/{part}".rstrip("/")


def point_to(spark: SparkSession, path: str, name: str, schemas: Mapping[str, T.StructType], number: int = 0) -> None:
    """The second step: make a written version the one that counts, and remove those that nobody needs any more."""
    folder = _Folder(spark, path)
    before = current(spark, path)
    held = {part: schema.jsonValue() for part, schema in schemas.items()}
    folder.replace(POINTER, json.dumps({"version": name, "number": number, "schemas": held}))
    kept = {name, before["version"] if before else name}
    for other in folder.versions():
        if other not in kept:
            folder.drop(other)


def publish(tables: DataFrame | Mapping[str, DataFrame], path: str, number: int = 0) -> None:
    """Replace what is at ``path`` by a table, or by several that belong together; they may read what is replaced."""
    parts = _parts(tables)
    spark = next(iter(parts.values())).sparkSession
    point_to(spark, path, write_version(tables, path, number), {part: df.schema for part, df in parts.items()}, number)


def current(spark: SparkSession, path: str) -> dict[str, Any] | None:
    """Name, number and schemas of the version that counts, None before the first."""
    text = _Folder(spark, path).read(POINTER)
    return None if text is None else json.loads(text)


def read_published(spark: SparkSession, path: str) -> DataFrame | None:
    """The table that counts now, None before the first."""
    found = read_published_parts(spark, path)
    return None if found is None else found[""]


def read_published_parts(spark: SparkSession, path: str) -> dict[str, DataFrame] | None:
    """The tables of the version that counts now, by name."""
    found = current(spark, path)
    if found is None:
        return None
    return {
        part: spark.read.schema(T.StructType.fromJson(schema)).parquet(_place(path, found["version"], part))
        for part, schema in found["schemas"].items()
    }
