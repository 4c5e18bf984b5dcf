"""Archive to counts per subreddit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.functions.columns import file_period
from threadloom.operators import counts as c
from threadloom.plans.materialize import store
from threadloom.schemas import EXPERIMENTS
from threadloom.sinks import files
from threadloom.sources.archive import read_contributions


def count_experiment(contributions: DataFrame, experiment: str, scope: str = "global") -> DataFrame:
    """The counts of one named experiment."""
    if experiment == EXPERIMENTS[0]:
        return c.contributions_per_subreddit(contributions)
    if experiment == EXPERIMENTS[1]:
        return c.users_per_subreddit(contributions, scope)
    raise ValueError(f"unknown experiment {experiment}")


def run_statistics(
    spark: SparkSession,
    dataset_dir: str,
    experiment: str,
    out_dir: str,
    *,
    suffix: str = "",
    scope: str = "global",
    single_file: bool = False,
    **names,
) -> str:
    """Count one experiment over a dataset directory and write ``<experiment>[_<suffix>].csv``.

    That is a folder, or one file if ``single_file`` is set.
    """
    contributions = read_contributions(spark, dataset_dir, **names)
    counts = count_experiment(contributions, experiment, scope)
    return files.write_statistics(counts, out_dir, experiment, suffix, single_file)


def run_statistics_per_period(spark: SparkSession, dataset_dir: str, experiment: str, out_dir: str, **names) -> str:
    """Months, years and total of one experiment from a single read of the archives."""
    contributions = read_contributions(spark, dataset_dir, **names)
    return files.write_statistics_per_period(count_per_period(contributions, experiment), out_dir, experiment)


def count_per_period(contributions: DataFrame, experiment: str) -> DataFrame:
    """level, period, subreddit, count of one named experiment; the period comes from the file name."""
    dated = contributions.withColumn("period", file_period())
    if experiment == EXPERIMENTS[0]:
        return c.contributions_per_period(dated)
    if experiment == EXPERIMENTS[1]:
        return c.users_per_period(dated)
    raise ValueError(f"unknown experiment {experiment}")


def export_top_lists(counts: DataFrame, sizes: tuple[int, ...], out_dir: str, name: str) -> list[str]:
    """Filter lists of the n largest subreddits for several n, ``<name>~top-<n>.txt``.

    The counts are evaluated once, for the longest list; the others are taken from it.
    """
    longest = store(c.top_n(counts.select("subreddit", "count"), max(sizes)), "top-list").table
    paths = []
    for n in sizes:
        path = f"{out_dir.rstrip('/')}/{name}~top-{n}.txt"
        files.export_filter_list(c.top_n(longest, n), path)
        paths.append(path)
    return paths


def export_top_lists_per_period(counts: DataFrame, sizes: tuple[int, ...], out_dir: str, name: str) -> str:
    """Filter lists of every size for every month, year and the whole range, from one evaluation.

    ``counts`` has level, period, subreddit, count. The list of a period is in
    ``<name>/size=<n>/level=<level>/period=<period>``.
    """
    ranked = store(c.top_n_per_period(counts, max(sizes), ["level", "period"]), "top-lists").table
    lengths = F.filter(F.array(*map(F.lit, sizes)), lambda n: F.col("rank") <= n)
    listed = ranked.withColumn("size", F.explode(lengths))
    path = f"{out_dir.rstrip('/')}/{name}"
    files.export_filter_lists(listed.select("size", "level", "period", "subreddit"), ["size", "level", "period"], path)
    return path
