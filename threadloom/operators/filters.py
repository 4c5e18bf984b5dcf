"""Row filters and projections on decoded entities."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.functions import strict_json as sj
from threadloom.functions.columns import named_author, subreddit_label
from threadloom.operators.lookup import BROADCAST_BYTES, lookup_join
from threadloom.plans.materialize import store
from threadloom.schemas import CSV_COLUMNS, TEXT_FIELDS


def project_entity(df: DataFrame, kind: str) -> DataFrame:
    """Only the columns the entity exports, in export order."""
    return df.select(*CSV_COLUMNS[kind])


def drop_deleted_authors(df: DataFrame) -> DataFrame:
    return df.where(named_author())


def filter_subreddits(df: DataFrame, subreddits: DataFrame | None, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Keep rows whose subreddit is listed, case-sensitive. No list, or an empty one, keeps all."""
    if subreddits is None:
        return df
    # A missing subreddit is looked up as the empty name. The list is evaluated once.
    listed = store(subreddits.select(F.coalesce("subreddit", F.lit("")).alias("_key")).distinct(), "filter-list")
    if not listed.rows:
        return df
    if "subreddit" not in df.columns:
        warnings.warn("these rows carry no subreddit; a subreddit list removes all of them", stacklevel=2)
        return df.where(F.lit(False))
    keyed = df.withColumn("_key", F.coalesce("subreddit", F.lit("")))
    return lookup_join(keyed, listed.table, ["_key"], listed.bytes <= limit, "left_semi").select(*df.columns)


def filter_raw_json(lines: DataFrame, subreddits: DataFrame | None = None) -> DataFrame:
    """Apply the author and subreddit filters to raw lines and keep the lines verbatim."""
    text = TEXT_FIELDS["user_in_subreddit"]
    decoded = sj.decode(lines, text).where(sj.is_valid(text))
    side = decoded.select(*lines.columns, *[sj.text_value(name) for name in text])
    return filter_subreddits(drop_deleted_authors(side), subreddits).select(*lines.columns)


def only_user_in_subreddit(df: DataFrame) -> DataFrame:
    return df.select("subreddit", "author")


def with_subreddit_label(df: DataFrame) -> DataFrame:
    return df.withColumn("subreddit", subreddit_label())


def drop_empty_subreddit(df: DataFrame) -> DataFrame:
    return df.where(F.col("subreddit") != "")


def drop_column(df: DataFrame, name: str = "count") -> DataFrame:
    return df.drop(name)


def filter_edges(edges: DataFrame, min_weight: float = 30) -> DataFrame:
    """Strong edges, heaviest first."""
    return edges.where(F.col("w_ij") >= F.lit(min_weight)).orderBy(F.desc("w_ij"), "i", "j")


def split_lines(lines: DataFrame) -> DataFrame:
    """Drop blank lines and lines that start with a NUL byte."""
    return lines.where((F.length("value") > 0) & (F.ascii("value") != 0))
