"""Word and fold helpers that every corpus operator shares.

Words are maximal runs of anything but the ASCII blanks 0x20 and 0x09-0x0D. ``bytes.split`` cuts
exactly there, and ``bytes.lower`` lowers exactly A-Z.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.operators.lookup import fits_broadcast, lookup_join
from threadloom.plans.materialize import store

WORD = r"[^\x20\x09-\x0D]+"


def raw_texts(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a text column; null is empty."""
    return [text or b"" for text in column.cast(pa.binary()).to_pylist()]


def fold(doc_id: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), F.lit(folds))


def only(df: DataFrame, *columns: str) -> DataFrame:
    """The named columns alone, so that further columns can't clash with an operator's own."""
    return df.select(*(F.col(f"`{name}`") for name in columns))


def smallest_by_hash(df: DataFrame, group: str, n: int, doc_id: str = "doc_id") -> DataFrame:
    """The ``n`` ids with the smallest hash in each non-null group: ``doc_id``, ``group``.

    A threshold that leaves about 4n rows of a group, found from its size, goes before the ranking, so
    neither a large group nor many tasks send more than that to one task. (That fewer than n are
    left of a larger group has no chance worth naming: 4n are expected.)
    """
    rows = df.select(doc_id, group).where(F.col(group).isNotNull())
    rows = rows.withColumn("_hash", F.shiftrightunsigned(F.xxhash64(doc_id), 1))
    sizes = store(rows.groupBy(group).agg(F.count(F.lit(1)).alias("_all")), "group-sizes").table
    sized = lookup_join(rows, sizes, [group], fits_broadcast(sizes))
    thin = sized.where((F.col("_all") <= 4 * n) | (F.col("_hash") / float(1 << 63) < 4.0 * n / F.col("_all")))
    first = Window.partitionBy(group).orderBy("_hash", doc_id)
    return thin.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= n).select(doc_id, group)
