"""Archive to filtered rows or lines."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from threadloom.operators.filters import (
    drop_deleted_authors,
    filter_raw_json,
    filter_subreddits,
    only_user_in_subreddit,
    project_entity,
)
from threadloom.operators.parse import parse_entities
from threadloom.sinks import files
from threadloom.sources.archive import archive_lines


def pass_through(
    spark: SparkSession,
    dataset_dir: str,
    kind: str,
    *,
    subreddits: DataFrame | None = None,
    original_json: bool = False,
    only_users: bool = False,
    **archive,
) -> DataFrame:
    """The rows of one archive kind with deleted authors and unlisted subreddits removed.

    ``original_json`` gives the untouched lines as ``value``. ``only_users`` gives
    ``(subreddit, author)``; accounts have no subreddit and keep their own columns. Further options are those
    of ``archive_lines``.
    """
    if original_json and only_users:
        raise ValueError("choose either original_json or only_users")
    lines = archive_lines(spark, dataset_dir, kind, **archive)
    if original_json:
        return filter_raw_json(lines, subreddits).select("value")
    if only_users and kind != "authors":
        rows = filter_subreddits(drop_deleted_authors(parse_entities(lines, "user_in_subreddit")), subreddits)
        return only_user_in_subreddit(rows)
    rows = project_entity(parse_entities(lines, kind), kind)
    return filter_subreddits(drop_deleted_authors(rows), subreddits)


def observed(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df`` with its row count observed by whichever job runs it."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def run_pass_through(
    spark: SparkSession,
    dataset_dir: str,
    outputs: Mapping[str, str],
    *,
    compress: bool = False,
    prefixes: Mapping[str, str] | None = None,
    **options,
) -> dict[str, int]:
    """Write every requested kind to its path and return the rows written.

    ``outputs`` maps kinds (submissions, comments, authors) to paths, ``prefixes`` kinds to the file
    prefix that replaces the usual one.
    """
    if not outputs:
        raise ValueError("name at least one of submissions, comments, authors")
    if "prefix" in options:
        raise ValueError("name the prefix of each kind in prefixes")
    written: dict[str, int] = {}
    for kind, path in outputs.items():
        prefix = (prefixes or {}).get(kind)
        rows, seen = observed(pass_through(spark, dataset_dir, kind, prefix=prefix, **options))
        raw = options.get("original_json", False)
        if compress:
            files.write_zstd_lines(rows if raw else files.to_csv_rows(rows), path)
        elif raw:
            files.write_raw_json(rows, path)
        else:
            files.write_csv(rows, path)
        written[kind] = seen.get["rows"]
    return written
