"""Equal-width histograms of numeric columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row ``(column, v)`` per number; NULL and NaN are left out."""
    entries = ", ".join(f"struct('{c}' as column, cast(`{c}` as double) as v)" for c in columns)
    return df.selectExpr(f"inline(array({entries}))").where("v is not null and not isnan(v)")


def histograms(df: DataFrame, columns: Sequence[str], bins: int = 100) -> DataFrame:
    """Counts per (column, bin) of several columns: one pass for the bounds, one for the counts.

    Bins are numbered from 1, closed on the left, the last one on both sides. A constant column
    gets a range of one around its value. Empty bins are kept.
    """
    values = _values(df, columns)
    # One row per column, so these two tables are as small as the call itself.
    ranges = (
        values.groupBy("column")
        .agg(F.expr("min(v) as least_v"), F.expr("max(v) as most_v"))
        .selectExpr(
            "column",
            "if(least_v = most_v, least_v - 0.5D, least_v) as lo",
            "if(least_v = most_v, most_v + 0.5D, most_v) as hi",
        )
        .selectExpr("column", "lo", "hi", f"(hi - lo) / {float(bins)}D as step")
    )
    # Rounding can put a value that lies on an edge one bin off; the edges decide.
    guessed = values.join(F.broadcast(ranges), "column").selectExpr(
        "column", "v", "lo", "step", f"least(floor((v - lo) * {bins} / (hi - lo)), {bins - 1}) as k"
    )
    counted = (
        guessed.selectExpr(
            "column",
            f"cast(k - if(v < lo + k * step, 1, 0) + if(k < {bins - 1} and v >= lo + (k + 1) * step, 1, 0) + 1 as int)"
            " as bin",
        )
        .groupBy("column", "bin")
        .agg(F.count("*").alias("count"))
    )
    edges = ranges.selectExpr("*", f"explode(sequence(1, {bins})) as bin")
    return edges.join(counted, ["column", "bin"], "left").selectExpr(
        "column",
        "bin",
        "lo + (bin - 1) * step as lower",
        f"if(bin = {bins}, hi, lo + bin * step) as upper",
        "coalesce(count, 0L) as count",
    )


def histogram(df: DataFrame, column: str, bins: int = 100) -> DataFrame:
    return histograms(df, [column], bins)
