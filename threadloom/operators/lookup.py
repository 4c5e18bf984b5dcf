"""Joins against a lookup table whose size is measured, not assumed."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.plans.materialize import row_bytes, store

BROADCAST_BYTES = 64 * 1024 * 1024
#: Facts of one key that a task takes; a key with more is dealt over several tasks.
HOT_ROWS = 1_000_000
#: Tasks that facts without a key, which match nothing, are dealt over.
WITHOUT_KEY = 1024
#: A lookup of up to so many times the limit is broadcast piece by piece.
MOST_PIECES = 16


def fits_broadcast(lookup: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """True when the rows of ``lookup``, measured on the cluster, stay below ``limit`` bytes."""
    size = lookup.agg(F.sum(row_bytes(lookup.schema)).alias("n")).first()["n"]
    return (size or 0) <= limit


def pieces_of(size: int, limit: int = BROADCAST_BYTES) -> int:
    """In how many pieces a lookup of ``size`` bytes is broadcast: 1 as a whole, 0 not at all."""
    pieces = max(1, math.ceil(size / limit)) if limit > 0 else int(size <= limit)
    return pieces if pieces <= MOST_PIECES else 0


def lookup_in_pieces(
    facts: DataFrame, lookup: DataFrame, key: str, pieces: int, label: str, compression: str | None = None
) -> DataFrame:
    """The inner join of stored ``facts`` to stored ``lookup``, one piece of the keys after the other; the result is stored.

    The facts are read once for each piece, keep their order and are not shuffled, so a hot key costs no more than another.
    """
    spark = facts.sparkSession
    part = f"pmod(xxhash64({key}), {pieces})"
    held = [
        store(
            facts.where(f"{part} = {n}").join(F.broadcast(lookup.where(f"{part} = {n}")), [key]), label, compression=compression
        )
        for n in range(pieces)
    ]
    return spark.read.schema(held[0].table.schema).parquet(*[piece.path for piece in held])


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    small: bool,
    how: str = "inner",
    hot_rows: int | None = HOT_ROWS,
    most: int | None = None,
) -> DataFrame:
    """Join ``facts`` to ``lookup``; ``small`` says that its measured size allows a broadcast.

    A small lookup is broadcast and the facts stay where they are. For a larger one the facts of each key are counted
    (partial sums, so a hot key costs no more than another). A key with more than ``hot_rows`` of them is dealt by position
    over as many tasks as that takes, equal rows too, and only its rows of the lookup are copied for them; every other row of
    both sides is joined once. There are at most facts / ``hot_rows`` such keys, so their list is small; it is
    broadcast only if its measured size allows it. ``hot_rows=None`` leaves skew to the optimizer, for facts whose keys are
    known to be even. ``most`` has the facts of the most frequent key, or a bound of them, where it is known: up to ``hot_rows`` nothing is
    counted. ``how`` must keep the facts on the left: inner, left, left_semi or left_anti.
    """
    keys = list(on)
    if small:
        return facts.join(F.broadcast(lookup), keys, how)
    if hot_rows is None:
        return facts.join(lookup, keys, how)
    if most is not None and most <= hot_rows and how in ("inner", "left_semi"):
        return facts.join(lookup.hint("merge"), keys, how)
    counted = facts.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows).dropna(subset=keys)
    cuts = F.ceil(F.col("_n") / F.lit(hot_rows)).cast("int").alias("_cuts")
    hot = store(counted.select(*keys, cuts), "hot-keys")
    place = F.monotonically_increasing_id()
    unmatched = F.lit(False)
    for key in keys:
        unmatched = unmatched | F.col(key).isNull()
    without = F.when(unmatched, F.pmod(place, F.lit(WITHOUT_KEY)).cast("int"))
    if not hot.rows:
        if how == "inner" or how == "left_semi":  # rows without a key are dropped before they are dealt
            return facts.join(lookup.hint("merge"), keys, how)
        salted = facts.withColumn("_salt", F.coalesce(without, F.lit(0)))
        return salted.join(lookup.withColumn("_salt", F.lit(0)).hint("merge"), [*keys, "_salt"], how).drop("_salt")
    listed = F.broadcast(hot.table) if hot.bytes <= BROADCAST_BYTES else hot.table
    salt = F.coalesce(without, F.pmod(place, F.col("_cuts")).cast("int"), F.lit(0))
    salted = facts.join(listed, keys, "left").withColumn("_salt", salt).drop("_cuts")
    several = F.sequence(F.lit(0), F.coalesce("_cuts", F.lit(1)) - 1)
    copies = lookup.join(listed, keys, "left").withColumn("_salt", F.explode(several)).drop("_cuts")
    return salted.join(copies.hint("merge"), [*keys, "_salt"], how).drop("_salt")
