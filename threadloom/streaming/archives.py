"""The archive jobs over a directory that is still being filled.

Files are picked up as they appear. With ``trigger(availableNow=True)`` a query drains what is
there and stops; started again with the same checkpoint it goes on with new files only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from threadloom.functions.columns import CSV_DIALECT, file_period, name_matches
from threadloom.operators.counts import approx_users_per_subreddit, contributions_per_subreddit, levels
from threadloom.operators.filters import (
    drop_deleted_authors,
    drop_empty_subreddit,
    filter_raw_json,
    filter_subreddits,
    only_user_in_subreddit,
    project_entity,
    split_lines,
    with_subreddit_label,
)
from threadloom.operators.parse import parse_entities
from threadloom.schemas import DIRECTORIES, PREFIXES
from threadloom.sinks.published import publish
from threadloom.sources import packed_lines
from threadloom.sources.archive import name_glob

PATHS = "path string, modificationTime timestamp, length bigint, content binary"


def stream_archive(
    spark: SparkSession,
    directory: str,
    prefix: str = "",
    contains: str = "",
    excludes: str = "",
    files_per_trigger: int | None = None,
    bytes_per_trigger: int | None = None,
    split: int = packed_lines.SPLIT_BYTES,
) -> DataFrame:
    """Lines ``(value, file)`` of the archives of a directory, as a stream.

    One stream of paths for all codecs; their contents are read by ranges where the paths arrive, so a large ``.zst``
    or ``.xz`` file is many tasks here too. A micro-batch takes up to ``files_per_trigger`` files, or files of up to
    ``bytes_per_trigger`` bytes (at least one).
    """
    if files_per_trigger and bytes_per_trigger:
        raise ValueError("bound a micro-batch by files or by bytes")
    options = {"pathGlobFilter": name_glob(prefix)}
    if files_per_trigger:
        options["maxFilesPerTrigger"] = files_per_trigger
    if bytes_per_trigger:
        options["maxBytesPerTrigger"] = bytes_per_trigger
    paths = spark.readStream.options(**options).format("binaryFile").schema(PATHS).load(directory)
    file = F.element_at(F.split("path", "/"), -1)
    wanted = paths.where(name_matches(file, prefix, contains, excludes))
    return split_lines(packed_lines.lines_of_files(wanted, split))


def stream_lines(spark: SparkSession, dataset_dir: str, kind: str, prefix: str | None = None, **options) -> DataFrame:
    """The stream of one archive kind of a dataset directory."""
    directory = f"{dataset_dir.rstrip('/')}/{DIRECTORIES[kind]}"
    return stream_archive(spark, directory, PREFIXES[kind] if prefix is None else prefix, **options)


def stream_contribution_rows(spark: SparkSession, dataset_dir: str, **options) -> DataFrame:
    """Comments and submissions as ``(subreddit, author, file)``."""
    comments = stream_lines(spark, dataset_dir, "comments", **options)
    submissions = stream_lines(spark, dataset_dir, "submissions", **options)
    return parse_entities(comments.unionByName(submissions), "user_in_subreddit")


def stream_pass_through(
    spark: SparkSession,
    dataset_dir: str,
    kind: str,
    subreddits: DataFrame | None = None,
    original_json: bool = False,
    only_users: bool = False,
    **options,
) -> DataFrame:
    """Stateless filter of one kind; write it in append mode. The options are those of the batch job."""
    if original_json and only_users:
        raise ValueError("choose either original_json or only_users")
    lines = stream_lines(spark, dataset_dir, kind, **options)
    if original_json:
        return filter_raw_json(lines, subreddits).select("value")
    if only_users and kind != "authors":
        users = filter_subreddits(drop_deleted_authors(parse_entities(lines, "user_in_subreddit")), subreddits)
        return only_user_in_subreddit(users)
    rows = project_entity(parse_entities(lines, kind), kind)
    return filter_subreddits(drop_deleted_authors(rows), subreddits)


def stream_contributions(rows: DataFrame) -> DataFrame:
    """Running contributions per subreddit (complete or update mode)."""
    return contributions_per_subreddit(rows)


def _named(rows: DataFrame) -> DataFrame:
    return drop_empty_subreddit(with_subreddit_label(drop_deleted_authors(rows)))


def stream_users(rows: DataFrame) -> DataFrame:
    """Running distinct users per subreddit. The state holds every pair seen, one small key each."""
    pairs = _named(rows).select("subreddit", "author").dropDuplicates(["subreddit", "author"])
    return pairs.groupBy("subreddit").agg(F.count("*").alias("count"))


def stream_users_approx(rows: DataFrame, rsd: float = 0.02) -> DataFrame:
    """Running distinct users with bounded state per subreddit."""
    return approx_users_per_subreddit(rows, rsd)


def stream_counts_per_period(rows: DataFrame) -> DataFrame:
    """Running contributions per month, year and in total, and subreddit; the period comes from the file name."""
    named = drop_empty_subreddit(with_subreddit_label(rows.where("author IS NOT NULL")))
    levelled = levels(named.withColumn("_month", F.substring(file_period(), 1, 7)), "subreddit")
    return levelled.groupBy("level", "period", "subreddit").agg(F.count("*").alias("count"))


def stream_users_per_period(rows: DataFrame) -> DataFrame:
    """Running distinct users per month, year and in total. The state holds every user of each of them."""
    named = _named(rows).withColumn("_month", F.substring(file_period(), 1, 7))
    members = levels(named, "subreddit", "author").dropDuplicates(["level", "period", "subreddit", "author"])
    return members.groupBy("level", "period", "subreddit").agg(F.count("*").alias("count"))


def drain_to_table(counts: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Run a running count over the files present and keep its latest complete result at ``path``.

    Each micro-batch publishes its result as a version (see ``sinks.published``, and read it with ``read_published``): a
    reader sees a whole result at any time, also when the query stops at any point, and the last one wins after a restart.
    """
    query = (
        counts.writeStream.outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(lambda batch, number: publish(batch, path, number))
        .start()
    )
    query.awaitTermination()
    return query


def drain_to_csv(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append the rows of a pass-through stream to headerless CSV files."""
    query = (
        rows.writeStream.outputMode("append")
        .format("csv")
        .options(**CSV_DIALECT)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
