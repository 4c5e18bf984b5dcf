"""Cut lineage by writing a table to the cluster's shared folder.

The written table survives executor loss, is column-pruned by its readers and gives the
optimizer real file sizes. Its row count and byte size are observed while it is written, so
broadcast decisions need no extra job.
"""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_local_folders: dict[str, str] = {}
_passing: ContextVar[list[tuple[str, str]] | None] = ContextVar("_passing", default=None)


class Stored(NamedTuple):
    table: DataFrame
    rows: int
    bytes: int
    seen: dict[str, Any]
    path: str


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one in local mode only."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if context.master != "local" and not context.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="threadloom-")
    return _local_folders[context.applicationId]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    if (noted := _passing.get()) is not None:
        noted.append((label, path))
    return path


def row_bytes(schema: T.StructType) -> Column:
    """Estimated bytes of a row: a fixed part per column and the length of every string and array."""
    width = F.lit(16 * len(schema.fields)).cast("bigint")
    for item in schema.fields:
        column = F.col(f"`{item.name}`")
        if isinstance(item.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(column), F.lit(0))
        elif isinstance(item.dataType, T.ArrayType):
            width = width + F.lit(8) * F.coalesce(F.size(column), F.lit(0))
    return width


def store(df: DataFrame, label: str, *metrics: Column, compression: str | None = None) -> Stored:
    """Write ``df`` once; return a reader over the written table, its rows and its bytes.

    Further aggregate ``metrics`` are observed in the same pass and returned in ``seen``.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    seen = Observation()
    rows = F.count(F.lit(1)).alias("rows")
    size = F.coalesce(F.sum(row_bytes(df.schema)), F.lit(0)).alias("bytes")
    df.observe(seen, rows, size, *metrics).write.parquet(path, compression=compression)
    found = seen.get
    return Stored(spark.read.schema(df.schema).parquet(path), found["rows"], found["bytes"], found, path)


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete stored tables or scratch folders that no DataFrame reads any more."""
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def passing(spark: SparkSession, *kept: str) -> Iterator[None]:
    """Delete, at the end, what is stored inside, but for the tables with a label in ``kept``.

    Only stored tables may leave the block: a DataFrame that reads a deleted one can no longer be run.
    """
    noted: list[tuple[str, str]] = []
    outer = _passing.set(noted)
    try:
        yield
    finally:
        _passing.reset(outer)
        if (around := _passing.get()) is not None:
            around.extend((label, path) for label, path in noted if label in kept)
        discard(spark, *(path for label, path in noted if label not in kept))


def most_tasks(spark: SparkSession, rows: int, rows_per_task: int, per_core: int = 32) -> int:
    """Tasks for ``rows`` rows of work, at most ``per_core`` for each core of the cluster.

    Beyond that a task gets more rows; the job stays whole. No scheduler survives millions of tasks.
    """
    return max(1, min(math.ceil(rows / rows_per_task), per_core * spark.sparkContext.defaultParallelism))
