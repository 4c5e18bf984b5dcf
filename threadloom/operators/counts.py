"""Counts per subreddit, overall, per file and per period.

Input rows are ``(subreddit, author)`` plus ``file`` or ``period`` where a count needs it. Every
count groups through partial aggregates, so a subreddit or author that holds a large share of the
rows costs each task one row per distinct key, not its raw rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadloom.functions.columns import epoch_year
from threadloom.operators.filters import drop_deleted_authors, drop_empty_subreddit, with_subreddit_label

ALL_PERIODS = "all"


def _labelled(df: DataFrame) -> DataFrame:
    return drop_empty_subreddit(with_subreddit_label(df))


def contributions_per_subreddit(df: DataFrame) -> DataFrame:
    """Rows with an author per subreddit. Deleted accounts count here."""
    return _labelled(df.where("author IS NOT NULL")).groupBy("subreddit").agg(F.count("*").alias("count"))


def distinct_memberships(df: DataFrame) -> DataFrame:
    """Each (subreddit, author) pair once, over all inputs."""
    return df.select("subreddit", "author").distinct()


def users_per_subreddit(df: DataFrame, scope: str = "global") -> DataFrame:
    """Users with at least one contribution, deleted accounts excluded.

    ``scope='global'`` counts a user once per subreddit. ``scope='file'`` counts a user once per
    subreddit and file and adds the files up; that equals counting distinct triples, so it needs
    no second distinct.
    """
    if scope not in ("global", "file"):
        raise ValueError("scope must be 'global' or 'file'")
    keys = ["subreddit", "author"] + (["file"] if scope == "file" else [])
    members = _labelled(drop_deleted_authors(df)).select(*keys).distinct()
    return members.groupBy("subreddit").agg(F.count("*").alias("count"))


def approx_users_per_subreddit(df: DataFrame, rsd: float = 0.02) -> DataFrame:
    """Global users with bounded memory per subreddit."""
    named = _labelled(drop_deleted_authors(df))
    return named.groupBy("subreddit").agg(F.approx_count_distinct("author", rsd).alias("count"))


def contributions_per_user_in_subreddit(df: DataFrame) -> DataFrame:
    """Contributions of each user in each subreddit."""
    named = _labelled(drop_deleted_authors(df))
    return named.groupBy("subreddit", "author").agg(F.count("*").alias("count"))


def merge_counts(*counts: DataFrame) -> DataFrame:
    """Add up count tables of several runs."""
    merged = counts[0]
    for more in counts[1:]:
        merged = merged.unionByName(more)
    return drop_empty_subreddit(merged).groupBy("subreddit").agg(F.sum("count").alias("count"))


def levels(months: DataFrame, *columns: str) -> DataFrame:
    """Every row three times: for its month, its year and all periods. Undated rows count for all periods only."""
    levels = f"""inline(filter(array(
        struct('month' as level, _month as period),
        struct('year' as level, substring(_month, 1, 4) as period),
        struct('{ALL_PERIODS}' as level, '{ALL_PERIODS}' as period)), x -> x.period <> ''))"""
    return months.selectExpr(*columns, levels)


def contributions_per_period(df: DataFrame, period: str = "period") -> DataFrame:
    """Contributions per month, per year and in total, from one pass.

    ``period`` starts with ``yyyy-MM``. Years and the total are added up from the month counts.
    """
    months = (
        _labelled(df.where("author IS NOT NULL"))
        .groupBy(F.substring(F.col(period), 1, 7).alias("_month"), "subreddit")
        .agg(F.count("*").alias("count"))
    )
    levelled = levels(months, "subreddit", "count").groupBy("level", "period", "subreddit")
    return levelled.agg(F.sum("count").alias("count"))


def users_per_period(df: DataFrame, period: str = "period") -> DataFrame:
    """Distinct users per month, per year and in total, from one pass over the rows and one wide shuffle.

    Distinct counts do not add up over periods, but the months in which a user is seen in a subreddit are a
    short set, and it tells the years and the total too. So rows are grouped once, by user and subreddit, and each group is
    counted in every period that its set names.
    """
    named = _labelled(drop_deleted_authors(df))
    months = named.groupBy("subreddit", "author").agg(F.collect_set(F.substring(F.col(period), 1, 7)).alias("months"))
    seen = f"""concat(
        transform(filter(months, x -> x <> ''), x -> struct('month' as level, x as period)),
        transform(array_distinct(transform(filter(months, x -> x <> ''), x -> substring(x, 1, 4))),
                  x -> struct('year' as level, x as period)),
        array(struct('{ALL_PERIODS}' as level, '{ALL_PERIODS}' as period)))"""
    counted = months.selectExpr("subreddit", f"inline({seen})").groupBy("level", "period", "subreddit")
    return counted.agg(F.count("*").alias("count"))


def near(approximate: DataFrame, exact: DataFrame, share: float) -> DataFrame:
    """Per subreddit the exact count, and whether the other is within ``share`` of it, or one off."""
    both = exact.join(approximate.withColumnRenamed("count", "_near"), "subreddit", "full")
    close = F.abs(F.col("_near") - F.col("count")) <= F.greatest(share * F.col("count"), F.lit(1.0))
    return both.select("subreddit", "count", F.coalesce(close, F.lit(False)).alias("within"))


def accounts_per_year(authors: DataFrame) -> DataFrame:
    """Accounts created per calendar year (UTC)."""
    return authors.groupBy(epoch_year().alias("year")).agg(F.count("*").alias("count"))


def top_n(df: DataFrame, n: int, by: str = "count", name: str = "subreddit") -> DataFrame:
    """The n largest rows; ties are broken by name."""
    return df.orderBy(F.desc(by), name).limit(n)


def sort_desc(df: DataFrame, by: str = "count", names: Sequence[str] = ("subreddit",)) -> DataFrame:
    return df.orderBy(F.desc(by), *names)


def top_n_per_period(df: DataFrame, n: int, keys: Sequence[str] = ("period",)) -> DataFrame:
    """The n largest subreddits of every period, with their rank.

    The rank filter is applied before the shuffle as well, so a period sends at most n rows per
    task.
    """
    order = Window.partitionBy(*keys).orderBy(F.desc("count"), "subreddit")
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
