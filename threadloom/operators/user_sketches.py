"""User counts that can be added up over runs.

A count of distinct users can't be added to another one: who is in both would count twice. What can be merged is stored
instead, for each subreddit and part (a file, a month, a run):

* the distinct memberships themselves, exact, as large as they are many;
* a HyperLogLog sketch of bounded size, whose merged estimate has a standard error of ``1.04 / sqrt(2 ** lg_k)``.

Both are idempotent: a part that was added twice, or two parts that overlap, give the same result as one.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.operators.filters import drop_deleted_authors, drop_empty_subreddit, with_subreddit_label

LG_K = 12
RUN = "run"


def relative_error(lg_k: int = LG_K) -> float:
    """The standard error of an estimate, as a share of it."""
    return 1.04 / math.sqrt(1 << lg_k)


def _named(df: DataFrame) -> DataFrame:
    return drop_empty_subreddit(with_subreddit_label(drop_deleted_authors(df)))


def user_sketches(df: DataFrame, keys: Sequence[str] = (), lg_k: int = LG_K) -> DataFrame:
    """``keys``, ``subreddit``, ``sketch``: the users of each subreddit in each part that ``keys`` name."""
    return _named(df).groupBy(*keys, "subreddit").agg(F.hll_sketch_agg("author", F.lit(lg_k)).alias("sketch"))


def merge_sketches(*sketches: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One sketch for each subreddit, or for each of ``keys`` and subreddit, over all tables and parts."""
    columns = [*keys, "subreddit", "sketch"]
    merged = sketches[0].select(*columns)
    for more in sketches[1:]:
        merged = merged.unionByName(more.select(*columns))
    return merged.groupBy(*keys, "subreddit").agg(F.hll_union_agg("sketch", F.lit(True)).alias("sketch"))


def sketched_users(sketches: DataFrame) -> DataFrame:
    """The estimates: every column but ``sketch``, and ``count``."""
    kept = [name for name in sketches.columns if name != "sketch"]
    return sketches.select(*kept, F.hll_sketch_estimate("sketch").alias("count"))


def members(df: DataFrame) -> DataFrame:
    """The distinct memberships that count as users."""
    return _named(df).select("subreddit", "author").distinct()


def store_run(part: DataFrame, path: str, run: str) -> None:
    """Add the sketches or memberships of one run to a store, in place of what this run stored before."""
    named = part.withColumn(RUN, F.lit(run))
    named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(RUN).parquet(path)


def read_runs(spark: SparkSession, path: str, runs: Sequence[str] | None = None) -> DataFrame:
    """The parts of all stored runs, or of the named ones only; the others are not read."""
    found = spark.read.option("basePath", path).parquet(path)
    return found if runs is None else found.where(F.col(RUN).cast("string").isin(*runs))


def users_of_runs(stored: DataFrame) -> DataFrame:
    """Exact users per subreddit over the stored memberships of any number of runs."""
    return stored.select("subreddit", "author").distinct().groupBy("subreddit").agg(F.count("*").alias("count"))
