"""File systems behind local paths and URIs, for the Python data sources."""

from __future__ import annotations

import sys

from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import SparkSession

# Executors need no installed copy of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme and authority that Spark itself would use for it.

    A path without a scheme belongs to the cluster's default file system, which need not be the local disk.
    """
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.makeQualified(place).toString()


def open_path(path: str) -> tuple[fs.FileSystem, str]:
    """The file system and the inner path of a qualified path, or of a plain local one."""
    if path.startswith("file:"):
        path = "/" + path[len("file:") :].lstrip("/")
    if "://" in path:
        scheme, rest = path.split("://", 1)
        try:
            return fs.FileSystem.from_uri(f"{'s3' if scheme in ('s3a', 's3n') else scheme}://{rest}")
        except OSError as error:  # it may tell of a library that is not there, but not for what
            raise OSError(f"paths with the scheme {scheme} can't be opened: {error}") from error
    return fs.LocalFileSystem(), path
