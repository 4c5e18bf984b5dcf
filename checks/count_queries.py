"""Counts, filters, top lists and histograms."""

from __future__ import annotations

from checks import inputs as i
from checks.registry import query
from pyspark.sql import functions as F
from threadloom.operators import counts as c
from threadloom.operators import filters as f
from threadloom.operators import user_sketches as us
from threadloom.operators.histogram import histograms
from threadloom.operators.parse import parse_authors
from threadloom.plans.materialize import scratch_path, store
from threadloom.plans.statistics import count_experiment

C, L = i.CONTRIBUTIONS, i.LABELLED
PER_SUBREDDIT = "SELECT subreddit, count(*) AS count FROM l WHERE author IS NOT NULL GROUP BY subreddit"


@query(f"WITH {C}, {L} {PER_SUBREDDIT}")
def contributions_per_subreddit(spark, sf):
    return c.contributions_per_subreddit(i.contributions(spark, sf))


@query(
    f"""WITH {C}, {L} SELECT subreddit, count(DISTINCT author) AS count FROM l
    WHERE author <> '[deleted]' GROUP BY subreddit"""
)
def users_per_subreddit_global(spark, sf):
    return c.users_per_subreddit(i.contributions(spark, sf))


@query(
    f"""WITH {C}, {L}, p AS (SELECT subreddit, file, count(DISTINCT author) AS n FROM l
    WHERE author <> '[deleted]' GROUP BY subreddit, file)
    SELECT subreddit, CAST(sum(n) AS BIGINT) AS count FROM p GROUP BY subreddit"""
)
def users_per_subreddit_by_file(spark, sf):
    return c.users_per_subreddit(i.contributions(spark, sf), scope="file")


@query(f"WITH {C}, {L} {PER_SUBREDDIT}")
def merge_counts(spark, sf):
    rows = i.contributions(spark, sf).where("author IS NOT NULL")
    per_file = f.with_subreddit_label(rows).groupBy("file", "subreddit").agg(F.count("*").alias("count"))
    return c.merge_counts(per_file.select("subreddit", "count"))


@query(
    f"""WITH {C}, {L} SELECT subreddit, author, count(*) AS count FROM l
    WHERE author <> '[deleted]' GROUP BY subreddit, author"""
)
def contributions_per_user_in_subreddit(spark, sf):
    return c.contributions_per_user_in_subreddit(i.contributions(spark, sf))


USERS = "SELECT subreddit, count(DISTINCT author) AS count{more} FROM l WHERE author <> '[deleted]' GROUP BY subreddit"
NEAR_USERS = USERS.format(more=", true AS within")


@query(f"WITH {C}, {L} {NEAR_USERS}")
def approx_users_per_subreddit(spark, sf):
    """The exact count per subreddit, and whether the approximate one is as near as stated."""
    rows = i.contributions(spark, sf)
    return c.near(c.approx_users_per_subreddit(rows), c.users_per_subreddit(rows), 5 * 0.02)


def _by_run(spark, sf):
    """Contributions in three runs that overlap: every row is in one, every third in two."""
    rows = i.contributions(spark, sf)
    runs = "array(pmod(xxhash64(author, file), 3), pmod(xxhash64(file, author), 3))"
    return rows.selectExpr("*", f"explode(array_distinct({runs})) as part")


def _stored_runs(spark, sf, label, make):
    path = scratch_path(spark, label)
    rows = _by_run(spark, sf)
    for run in (0, 1, 2, 1):  # one of them again
        us.store_run(make(rows.where(F.col("part") == run)), path, f"run-{run}")
    return us.read_runs(spark, path)


@query(f"WITH {C}, {L} {USERS.format(more='')}")
def users_of_runs(spark, sf):
    """Exact users over stored runs that overlap, one of them stored twice."""
    return us.users_of_runs(_stored_runs(spark, sf, "memberships", us.members))


@query(f"WITH {C}, {L} {NEAR_USERS}")
def users_of_sketches(spark, sf):
    """Merged sketches of the same runs beside the exact count of all rows."""
    stored = _stored_runs(spark, sf, "sketches", us.user_sketches)
    merged = us.sketched_users(us.merge_sketches(stored))
    return c.near(merged, c.users_per_subreddit(i.contributions(spark, sf)), 5 * us.relative_error())


@query(
    f"""WITH {i.ORDER_CONTRIBUTIONS} SELECT substr(period, 1, 4) AS year, subreddit, count(DISTINCT author) AS count, true AS within
    FROM c GROUP BY 1, 2"""
)
def users_of_month_sketches(spark, sf):
    """Years from the stored sketches of their months, without the rows."""
    rows = i.order_contributions(spark, sf)
    months = store(us.user_sketches(rows, ["period"]), "month-sketches").table
    years = months.withColumn("year", F.substring("period", 1, 4))
    found = us.sketched_users(us.merge_sketches(years, keys=["year"])).withColumnRenamed("count", "near")
    exact = rows.groupBy(F.substring("period", 1, 4).alias("year"), "subreddit").agg(F.countDistinct("author").alias("count"))
    close = F.abs(F.col("near") - F.col("count")) <= F.greatest(F.col("count") * 5 * us.relative_error(), F.lit(1.0))
    return exact.join(found, ["year", "subreddit"], "full").select("year", "subreddit", "count", close.alias("within"))


@query(f"WITH {C} SELECT DISTINCT subreddit, author FROM c")
def distinct_memberships(spark, sf):
    return c.distinct_memberships(i.contributions(spark, sf))


PERIODS = """lv AS (SELECT 'month' AS level, period, subreddit, author FROM c
  UNION ALL SELECT 'year', substr(period, 1, 4), subreddit, author FROM c
  UNION ALL SELECT 'all', 'all', subreddit, author FROM c)"""


@query(
    f"""WITH {i.ORDER_CONTRIBUTIONS}, {PERIODS}
    SELECT level, period, subreddit, count(*) AS count FROM lv GROUP BY level, period, subreddit"""
)
def contributions_per_period(spark, sf):
    return c.contributions_per_period(i.order_contributions(spark, sf))


@query(
    f"""WITH {i.ORDER_CONTRIBUTIONS}, {PERIODS}
    SELECT level, period, subreddit, count(DISTINCT author) AS count FROM lv GROUP BY level, period, subreddit"""
)
def users_per_period(spark, sf):
    return c.users_per_period(i.order_contributions(spark, sf))


@query(
    f"""WITH {i.ORDER_CONTRIBUTIONS}, {PERIODS},
    n AS (SELECT level, period, subreddit, count(*) AS count FROM lv GROUP BY level, period, subreddit),
    r AS (SELECT *, CAST(row_number() OVER (PARTITION BY level, period ORDER BY count DESC, subreddit) AS INTEGER)
          AS rank FROM n)
    SELECT level, period, subreddit, count, rank FROM r WHERE rank <= 3"""
)
def top_n_per_period(spark, sf):
    """Of months, years and the whole range."""
    return c.top_n_per_period(c.contributions_per_period(i.order_contributions(spark, sf)), 3, ["level", "period"])


@query(f"WITH {C}, {L} {PER_SUBREDDIT} ORDER BY count DESC, subreddit LIMIT 3")
def top_n(spark, sf):
    return c.top_n(c.contributions_per_subreddit(i.contributions(spark, sf)), 3)


@query(f"WITH {C}, {L} {PER_SUBREDDIT} ORDER BY count DESC, subreddit")
def sort_desc(spark, sf):
    return c.sort_desc(count_experiment(i.contributions(spark, sf), "UserContributionsInSubreddits"))


@query(f"WITH {C}, {L}, n AS ({PER_SUBREDDIT}) SELECT subreddit FROM n ORDER BY count DESC, subreddit LIMIT 3")
def drop_column(spark, sf):
    return f.drop_column(c.top_n(c.contributions_per_subreddit(i.contributions(spark, sf)), 3))


@query(
    f"""WITH {i.ACCOUNTS} SELECT CAST(year(to_timestamp(created_utc)) AS INTEGER) AS year, count(*) AS count
    FROM a GROUP BY 1"""
)
def accounts_per_year(spark, sf):
    return c.accounts_per_year(parse_authors(i.author_lines(spark, sf)))


@query(f"WITH {C} SELECT subreddit, author, file FROM c WHERE author IS NOT NULL AND author <> '[deleted]'")
def drop_deleted_authors(spark, sf):
    return f.drop_deleted_authors(i.contributions(spark, sf))


LISTED = "(SELECT event_type FROM events WHERE event_type < 'purchase')"


@query(f"WITH {C} SELECT subreddit, author, file FROM c WHERE subreddit IN {LISTED}")
def filter_subreddits(spark, sf):
    return f.filter_subreddits(i.contributions(spark, sf), i.filter_list(spark, sf))


@query(f"WITH {C} SELECT subreddit, author, file FROM c WHERE subreddit IN {LISTED}")
def filter_subreddits_by_large_list(spark, sf):
    """The same filter on the path of a list too large to broadcast."""
    return f.filter_subreddits(i.contributions(spark, sf), i.filter_list(spark, sf), limit=0)


@query(f"WITH {C} SELECT subreddit, author FROM c")
def only_user_in_subreddit(spark, sf):
    return f.only_user_in_subreddit(i.contributions(spark, sf))


@query(f"WITH {C}, {L} SELECT subreddit, author, file FROM l")
def labelled_subreddits(spark, sf):
    return f.drop_empty_subreddit(f.with_subreddit_label(i.contributions(spark, sf)))


def histogram_sql(relation: str, columns: list[str], bins: int, with_part: str = "") -> str:
    """Equal-width bins with the same edge arithmetic, empty bins kept."""
    parts = []
    for column in columns:
        parts.append(
            f"""SELECT '{column.strip('"')}' AS "column", CAST({column} AS DOUBLE) AS v FROM {relation}
            WHERE {column} IS NOT NULL AND NOT isnan(CAST({column} AS DOUBLE))"""
        )
    values = " UNION ALL ".join(parts)
    return f"""WITH {with_part + ',' if with_part else ''} v AS ({values}),
    r AS (SELECT "column", CASE WHEN min(v) = max(v) THEN min(v) - 0.5 ELSE min(v) END AS lo,
                 CASE WHEN min(v) = max(v) THEN max(v) + 0.5 ELSE max(v) END AS hi FROM v GROUP BY "column"),
    g AS (SELECT v."column", v, lo, (hi - lo) / CAST({bins} AS DOUBLE) AS step,
                 least(floor((v - lo) * {bins} / (hi - lo)), {bins - 1}) AS k FROM v JOIN r ON v."column" = r."column"),
    n AS (SELECT "column", CAST(k - (CASE WHEN v < lo + k * step THEN 1 ELSE 0 END)
             + (CASE WHEN k < {bins - 1} AND v >= lo + (k + 1) * step THEN 1 ELSE 0 END) + 1 AS INTEGER) AS bin FROM g),
    q AS (SELECT "column", bin, count(*) AS count FROM n GROUP BY "column", bin),
    f AS (SELECT r."column", CAST(s.bin AS INTEGER) AS bin, lo, hi, (hi - lo) / CAST({bins} AS DOUBLE) AS step
          FROM r, range(1, {bins + 1}) s(bin))
    SELECT f."column", f.bin, lo + (f.bin - 1) * step AS lower,
           CASE WHEN f.bin = {bins} THEN hi ELSE lo + f.bin * step END AS upper, coalesce(q.count, 0) AS count
    FROM f LEFT JOIN q ON q."column" = f."column" AND q.bin = f.bin"""


@query(histogram_sql("lineitem", ["l_quantity", "l_extendedprice"], 100))
def histogram_of_columns(spark, sf):
    return histograms(i.table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice"])


@query(
    histogram_sql(
        "pu",
        ['"count"'],
        100,
        "pu AS (SELECT l_suppkey, count(DISTINCT l_orderkey) AS count FROM lineitem GROUP BY l_suppkey)",
    )
)
def histogram_of_user_counts(spark, sf):
    rows = i.table(spark, sf, "lineitem").selectExpr("cast(l_suppkey as string) as subreddit", "concat('o', l_orderkey) as author")
    return histograms(c.users_per_subreddit(rows), ["count"])


@query(
    histogram_sql("pc", ['"count"'], 100, "pc AS (SELECT l_partkey, count(*) AS count FROM lineitem GROUP BY l_partkey)")
)
def histogram_of_counts(spark, sf):
    rows = i.table(spark, sf, "lineitem").selectExpr("cast(l_partkey as string) as subreddit", "l_orderkey as author")
    return histograms(c.contributions_per_subreddit(rows), ["count"])
