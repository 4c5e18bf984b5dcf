"""Archive reading, decoding, pass-through and streams."""

from __future__ import annotations

from checks import inputs as i
from checks.registry import query
from pyspark.sql import functions as F
from threadloom.operators import counts as c
from threadloom.operators import filters as f
from threadloom.operators import parse as p
from threadloom.plans import pass_through as pt
from threadloom.plans import statistics as st
from threadloom.plans.materialize import scratch_path
from threadloom.sinks import files
from threadloom.sinks.published import read_published
from threadloom.sources import archive as a
from threadloom.sources import tables as t
from threadloom.streaming import archives as sa
from threadloom.streaming import bucket_users as bu

K, S, A = i.COMMENTS, i.SUBMISSIONS, i.ACCOUNTS
LISTED = "(SELECT event_type FROM events WHERE event_type < 'purchase')"
NAMED = "author IS NOT NULL AND author <> '[deleted]'"
# Comments and submissions together, as the counts see them.
BOTH = f"""{K}, {S}, w AS (SELECT subreddit, author, file FROM c UNION ALL SELECT subreddit, author, file FROM s),
l AS (SELECT coalesce(subreddit, 'No-Subreddit-defined') AS subreddit, author, file FROM w
      WHERE subreddit IS NULL OR subreddit <> '')"""


def _same_lines(made, lines, ending=".zst"):
    """Per file the number of lines and whether they are those that were written, by a sum of their hashes."""

    def sums(rows, suffix):
        name = F.regexp_replace("file", r"\.\w+$", "").alias("file")
        part = F.pmod(F.xxhash64("value"), F.lit(1 << 40))
        return rows.groupBy(name).agg(F.count("*").alias(f"n{suffix}"), F.sum(part).alias(f"h{suffix}"))

    both = sums(made, "1").join(sums(lines, "2"), "file", "full")
    same = F.col("n1").eqNullSafe(F.col("n2")) & F.col("h1").eqNullSafe(F.col("h2"))
    return both.select(F.concat("file", F.lit(ending)).alias("file"), F.col("n2").alias("count"), same.alias("same"))


@query(f"WITH {S} SELECT subreddit, id, author, title FROM s")
def parse_submissions(spark, sf):
    return p.parse_submissions(i.submission_lines(spark, sf)).drop("file")


@query(f"WITH {K} SELECT subreddit, id, author, body, file FROM c")
def parse_comments(spark, sf):
    return p.parse_comments(i.comment_lines(spark, sf))


@query(f"WITH {A} SELECT author, created_utc FROM a")
def parse_authors(spark, sf):
    return p.parse_authors(i.author_lines(spark, sf)).drop("file")


@query(f"WITH {K} SELECT subreddit, author FROM c")
def parse_user_in_subreddit(spark, sf):
    return p.parse_user_in_subreddit(i.comment_lines(spark, sf)).drop("file")


@query(f"WITH {K} SELECT subreddit, id, author, body, file FROM c")
def drop_malformed(spark, sf):
    """The kept lines, decoded."""
    return p.parse_comments(p.drop_malformed(i.comment_lines(spark, sf), "comments"))


@query(
    """SELECT CASE WHEN value < 1 THEN 'wrong_type:author' WHEN value < 2 THEN 'malformed' WHEN value < 3 THEN 'not_object'
         WHEN value < 4 THEN 'blank' WHEN value < 5 THEN 'nul' ELSE 'malformed' END AS reason,
       'RC_' || strftime(ts, '%Y-%m-%d') || '.zst' AS file, count(*) AS count
    FROM events WHERE value < 7 GROUP BY 1, 2"""
)
def quarantine_malformed(spark, sf):
    bad = p.quarantine_malformed(i.comment_lines(spark, sf), "comments")
    return bad.groupBy("reason", "file").agg(F.count("*").alias("count"))


@query(
    """SELECT 'RC_' || strftime(ts, '%Y-%m-%d') || '.zst' AS file, count(*) AS count, true AS same
    FROM events WHERE value < 3 OR value >= 5 GROUP BY 1"""
)
def split_lines(spark, sf):
    lines = i.comment_lines(spark, sf)
    return _same_lines(lines.where("value <> '' and substring(value, 1, 1) <> char(0)"), f.split_lines(lines))


@query("SELECT 'RC_' || strftime(ts, '%Y-%m-%d') || '.zst' AS file, count(*) AS count, true AS same FROM events GROUP BY 1")
def read_archive(spark, sf):
    root = i.archive(spark, sf, "comments")
    lines = a.read_archive(spark, f"{root}/comments", "RC_")
    return _same_lines(i.made_lines(spark, sf, "comments"), lines)


@query("SELECT 'RC_' || strftime(ts, '%Y-%m-%d') || '.xz' AS file, count(*) AS count, true AS same FROM events GROUP BY 1")
def read_xz_archive(spark, sf):
    lines = a.read_xz_archive(spark, f"{i.xz_archive(spark, sf)}/comments", "RC_")
    return _same_lines(i.made_lines(spark, sf, "comments"), lines, ".xz")


@query(f"WITH {S} SELECT file, count(*) AS count, true AS same FROM s GROUP BY 1")
def read_zst_by_ranges(spark, sf):
    """Every file cut into several ranges of its frames."""
    lines = a.read_archive(spark, i.framed_archive(spark, sf), "RS_", split=1 << 12)
    return _same_lines(i.made_lines(spark, sf, "submissions"), lines)


@query("SELECT 'RC_' || strftime(ts, '%Y-%m-%d') || '.xz' AS file, count(*) AS count, true AS same FROM events GROUP BY 1")
def read_xz_by_ranges(spark, sf):
    """Every file cut into several ranges of its streams."""
    lines = a.read_xz_archive(spark, f"{i.xz_archive(spark, sf)}/comments", "RC_", split=1 << 12)
    return _same_lines(i.made_lines(spark, sf, "comments"), lines, ".xz")


@query(f"WITH {K} SELECT subreddit, id, author, body, replace(file, '.zst', '.xz') AS file FROM c")
def read_comments_from_xz(spark, sf):
    return a.read_comments(spark, i.xz_archive(spark, sf))


@query(
    """SELECT DISTINCT 'RC_' || strftime(ts, '%Y-%m-%d') || '.zst' AS file FROM events
    WHERE strftime(ts, '%Y-%m-%d') LIKE '%01-1%' AND strftime(ts, '%Y-%m-%d') NOT LIKE '%-15%'"""
)
def list_files(spark, sf):
    root = i.archive(spark, sf, "comments")
    return a.list_files(spark, f"{root}/comments", "RC_", "01-1", "-15").select("file")


@query(
    f"""WITH {K} SELECT subreddit, id, author, body, file FROM c
    WHERE file LIKE '%01-1%' AND file NOT LIKE '%-15%'"""
)
def read_comments_of_named_files(spark, sf):
    return a.read_comments(spark, i.archive(spark, sf, "comments"), contains="01-1", excludes="-15")


@query(f"WITH {S} SELECT subreddit, id, author, title, file FROM s")
def read_submissions(spark, sf):
    return a.read_submissions(spark, i.archive(spark, sf, "submissions"))


@query(f"WITH {K} SELECT subreddit, id, author, body, file FROM c")
def read_comments(spark, sf):
    return a.read_comments(spark, i.archive(spark, sf, "comments"), spread=16, spread_above=1000)


@query(f"WITH {A} SELECT author, created_utc FROM a")
def read_authors(spark, sf):
    return a.read_authors(spark, i.archive(spark, sf, "authors")).drop("file")


@query(f"WITH {K}, {S} SELECT subreddit, author, file FROM c UNION ALL SELECT subreddit, author, file FROM s")
def read_contributions(spark, sf):
    return a.read_contributions(spark, i.archive(spark, sf, "comments", "submissions"))


@query(f"WITH {K} SELECT subreddit, id, author, body FROM c")
def project_entity(spark, sf):
    return f.project_entity(p.parse_comments(i.comment_lines(spark, sf)), "comments")


@query(f"WITH {K} SELECT subreddit, id, author, body FROM c WHERE {NAMED} AND subreddit IN {LISTED}")
def pass_through_comments(spark, sf):
    return pt.pass_through(spark, i.archive(spark, sf, "comments"), "comments", subreddits=i.filter_list(spark, sf))


@query(f"WITH {S} SELECT subreddit, author FROM s WHERE {NAMED}")
def pass_through_only_users(spark, sf):
    return pt.pass_through(spark, i.archive(spark, sf, "submissions"), "submissions", only_users=True)


@query(f"WITH {A} SELECT author, created_utc FROM a")
def pass_through_authors(spark, sf):
    return pt.pass_through(spark, i.archive(spark, sf, "authors"), "authors", only_users=True)


@query(
    f"""WITH {K} SELECT subreddit, id, author, body, file, true AS verbatim FROM c
    WHERE {NAMED} AND subreddit IN {LISTED}"""
)
def filter_raw_json(spark, sf):
    """The kept lines, decoded, and whether each is one of the lines given, to the byte."""
    given = i.comment_lines(spark, sf)
    lines = f.filter_raw_json(given, i.filter_list(spark, sf))
    known = given.select("value", F.lit(True).alias("known")).distinct()
    marked = lines.join(known, "value", "left").withColumn("verbatim", F.coalesce("known", F.lit(False))).drop("known")
    return p.parse_comments(marked)


@query(f"WITH {K} SELECT subreddit, id, author, body FROM c WHERE {NAMED} AND subreddit IN {LISTED}")
def write_raw_json(spark, sf):
    """Original lines written, read and decoded again."""
    path = scratch_path(spark, "raw")
    listed = i.filter_list(spark, sf)
    pt.run_pass_through(spark, i.archive(spark, sf, "comments"), {"comments": path}, subreddits=listed, original_json=True)
    return p.parse_comments(a.read_archive(spark, path)).drop("file")


@query(f"WITH {S} SELECT subreddit, id, author, title FROM s WHERE {NAMED}")
def write_csv(spark, sf):
    """Whole texts written as CSV and read again."""
    path = scratch_path(spark, "csv")
    pt.run_pass_through(spark, i.archive(spark, sf, "submissions"), {"submissions": path})
    return t.read_entity_csv(spark, path, "submissions")


@query(f"WITH {S} SELECT subreddit, id, author, title FROM s WHERE {NAMED}")
def write_compressed(spark, sf):
    """Whole texts written as Zstandard CSV and read again."""
    path = scratch_path(spark, "csv-zst")
    pt.run_pass_through(spark, i.archive(spark, sf, "submissions"), {"submissions": path}, compress=True)
    return t.read_entity_csv(spark, path, "submissions")


@query(
    f"""WITH {K}, {S}, {A} SELECT 'comments' AS kind, count(*) AS count FROM c WHERE {NAMED}
    UNION ALL SELECT 'submissions', count(*) FROM s WHERE {NAMED} UNION ALL SELECT 'authors', count(*) FROM a"""
)
def record_count(spark, sf):
    paths = {kind: scratch_path(spark, kind) for kind in ("comments", "submissions", "authors")}
    written = pt.run_pass_through(spark, i.archive(spark, sf), paths)
    return spark.createDataFrame(list(written.items()), "kind string, count bigint")


@query(
    f"""WITH {K}, {S} SELECT coalesce(subreddit, '') AS subreddit, author FROM c WHERE {NAMED}
    UNION ALL SELECT subreddit, author FROM s"""
)
def read_user_subreddit_csv(spark, sf):
    """Memberships of two passes, read back as one table; empty names stay empty names."""
    paths = {kind: scratch_path(spark, kind) for kind in ("comments", "submissions")}
    pt.run_pass_through(spark, i.archive(spark, sf, "comments", "submissions"), paths, only_users=True)
    return t.read_user_subreddit_csv(spark, list(paths.values()))


@query(f"WITH {BOTH} SELECT subreddit, count(*) AS count FROM l WHERE author IS NOT NULL GROUP BY subreddit")
def write_statistics(spark, sf):
    """Counts written under the experiment's name and read again."""
    out = scratch_path(spark, "statistics")
    path = st.run_statistics(spark, i.archive(spark, sf, "comments", "submissions"), "UserContributionsInSubreddits", out, suffix="2024")
    return t.read_counts_csv(spark, path)


@query(f"WITH {BOTH} SELECT subreddit, count(*) AS count FROM l WHERE author IS NOT NULL GROUP BY subreddit")
def write_statistics_file(spark, sf):
    """The counts as one file of the experiment's name, read again."""
    out, name = scratch_path(spark, "statistics"), "UserContributionsInSubreddits"
    path = st.run_statistics(spark, i.archive(spark, sf, "comments", "submissions"), name, out, single_file=True)
    return t.read_counts_csv(spark, path)


# Both kinds by month, year and in total; files without a date count in the total only.
DATED = f"""{BOTH}, d AS (SELECT subreddit, author, regexp_extract(file, '(\\d{{4}}-\\d{{2}})', 1) AS month FROM l),
lv AS (SELECT 'month' AS level, month AS period, subreddit, author FROM d WHERE month <> ''
  UNION ALL SELECT 'year', substr(month, 1, 4), subreddit, author FROM d WHERE month <> ''
  UNION ALL SELECT 'all', 'all', subreddit, author FROM d)"""
PERIOD_COUNTS = """SELECT level, period, subreddit, count(*) AS count FROM lv WHERE author IS NOT NULL
GROUP BY level, period, subreddit"""
PERIOD_USERS = f"""SELECT level, period, subreddit, count(DISTINCT author) AS count FROM lv WHERE {NAMED}
GROUP BY level, period, subreddit"""


def _written_periods(spark, sf, experiment):
    out = scratch_path(spark, "periods")
    path = st.run_statistics_per_period(spark, i.archive(spark, sf, "comments", "submissions"), experiment, out)
    back = spark.read.schema("subreddit string, count bigint, level string, period string").csv(path)
    return back.select("level", "period", "subreddit", "count")


@query(f"WITH {DATED} {PERIOD_COUNTS}")
def run_statistics_per_period(spark, sf):
    """Contributions of all periods written in one run, one folder each, and read again."""
    return _written_periods(spark, sf, "UserContributionsInSubreddits")


@query(f"WITH {DATED} {PERIOD_USERS}")
def write_statistics_per_period(spark, sf):
    """Users of all periods, likewise."""
    return _written_periods(spark, sf, "UsersInSubreddits")


@query(
    f"""WITH {DATED}, n AS ({PERIOD_COUNTS}), r AS (SELECT *, row_number() OVER
      (PARTITION BY level, period ORDER BY count DESC, subreddit) AS rank FROM n),
    z AS (SELECT unnest([2, 3, 5, 8, 13]) AS size)
    SELECT size, level, period, subreddit FROM r JOIN z ON rank <= size"""
)
def export_top_lists_per_period(spark, sf):
    """Five filter lists for every month, year and the whole range, read again without their headers."""
    contributions = a.read_contributions(spark, i.archive(spark, sf, "comments", "submissions"))
    counts = st.count_per_period(contributions, "UserContributionsInSubreddits")
    path = st.export_top_lists_per_period(counts, (2, 3, 5, 8, 13), scratch_path(spark, "lists"), "top")
    lists = spark.read.schema("value string, size int, level string, period string").text(path)
    return lists.where("value <> 'subreddit'").select("size", "level", "period", F.col("value").alias("subreddit"))


@query(
    f"""WITH {BOTH}, n AS (SELECT DISTINCT subreddit, author, file FROM l WHERE {NAMED})
    SELECT subreddit, count(*) AS count FROM n GROUP BY subreddit"""
)
def archive_users_by_file(spark, sf):
    return st.count_experiment(a.read_contributions(spark, i.archive(spark, sf, "comments", "submissions")), "UsersInSubreddits", "file")


@query(f"WITH {DATED} {PERIOD_USERS}")
def archive_users_per_period(spark, sf):
    return st.count_per_period(a.read_contributions(spark, i.archive(spark, sf, "comments", "submissions")), "UsersInSubreddits")


@query(
    f"""WITH {BOTH}, n AS (SELECT subreddit, count(*) AS count FROM l WHERE author IS NOT NULL GROUP BY subreddit)
    SELECT subreddit FROM n ORDER BY count DESC, subreddit LIMIT 5"""
)
def export_filter_list(spark, sf):
    """A top list written as a filter list and read as one."""
    counts = c.contributions_per_subreddit(a.read_contributions(spark, i.archive(spark, sf, "comments", "submissions")))
    path = st.export_top_lists(counts, (5,), scratch_path(spark, "lists"), "UserContributionsInSubreddits")[0]
    return t.read_filter_list(spark, path)


def _rows(spark, sf):
    return sa.stream_contribution_rows(spark, i.archive(spark, sf, "comments", "submissions"), files_per_trigger=16)


def _drained(spark, counts):
    path = scratch_path(spark, "stream-result")
    sa.drain_to_table(counts, path, scratch_path(spark, "stream-checkpoint"))
    return read_published(spark, path)


@query(f"WITH {BOTH} SELECT subreddit, count(*) AS count FROM l WHERE author IS NOT NULL GROUP BY subreddit")
def stream_contributions(spark, sf):
    return _drained(spark, sa.stream_contributions(_rows(spark, sf)))


@query(f"WITH {BOTH} SELECT subreddit, count(DISTINCT author) AS count FROM l WHERE {NAMED} GROUP BY subreddit")
def stream_users(spark, sf):
    return _drained(spark, sa.stream_users(_rows(spark, sf)))


@query(f"WITH {BOTH} SELECT subreddit, count(DISTINCT author) AS count FROM l WHERE {NAMED} GROUP BY subreddit")
def stream_users_in_buckets(spark, sf):
    """The same, with authors numbered in buckets and a set of numbers for each subreddit."""
    path = scratch_path(spark, "stream-result")
    bu.drain_increments(bu.stream_new_users(_rows(spark, sf), buckets=16), path, scratch_path(spark, "stream-checkpoint"))
    return bu.read_counts(spark, path)


@query(f"WITH {BOTH} SELECT subreddit, count(*) AS count FROM l WHERE author IS NOT NULL GROUP BY subreddit")
def stream_contributions_with_xz(spark, sf):
    """Comments as ``.xz`` files, submissions as ``.zst`` files."""
    rows = sa.stream_contribution_rows(spark, i.xz_archive(spark, sf, submissions=True), files_per_trigger=16)
    return _drained(spark, sa.stream_contributions(rows))


@query(f"WITH {BOTH} SELECT subreddit, count(DISTINCT author) AS count, true AS within FROM l WHERE {NAMED} GROUP BY subreddit")
def stream_users_approx(spark, sf):
    """The exact count per subreddit, and whether the running approximate one is as near as stated."""
    exact = c.users_per_subreddit(a.read_contributions(spark, i.archive(spark, sf, "comments", "submissions")))
    return c.near(_drained(spark, sa.stream_users_approx(_rows(spark, sf))), exact, 0.1)


@query(f"WITH {DATED} {PERIOD_COUNTS}")
def stream_counts_per_period(spark, sf):
    return _drained(spark, sa.stream_counts_per_period(_rows(spark, sf)))


@query(f"WITH {DATED} {PERIOD_USERS}")
def stream_users_per_period(spark, sf):
    return _drained(spark, sa.stream_users_per_period(_rows(spark, sf)))


@query(f"WITH {K} SELECT nullif(subreddit, '') AS subreddit, author FROM c WHERE {NAMED}")
def stream_only_users(spark, sf):
    """Missing and empty names look the same in CSV."""
    rows = sa.stream_pass_through(spark, i.archive(spark, sf, "comments"), "comments", only_users=True, files_per_trigger=16)
    path = scratch_path(spark, "stream-csv")
    sa.drain_to_csv(rows, path, scratch_path(spark, "stream-checkpoint"))
    read = t.read_entity_csv(spark, path, "user_in_subreddit")
    return read.select(F.col("subreddit"), F.col("author"))


@query(f"WITH {S} SELECT subreddit, id, author, title FROM s WHERE {NAMED}")
def stream_pass_through_texts(spark, sf):
    """Whole texts, outer blanks and other line ends included."""
    rows = sa.stream_pass_through(spark, i.archive(spark, sf, "submissions"), "submissions", files_per_trigger=16)
    path = scratch_path(spark, "stream-csv")
    sa.drain_to_csv(rows, path, scratch_path(spark, "stream-checkpoint"))
    return t.read_entity_csv(spark, path, "submissions")


@query(f"WITH {K} SELECT subreddit, id, author, body FROM c WHERE {NAMED} AND subreddit IN {LISTED}")
def stream_pass_through(spark, sf):
    rows = sa.stream_pass_through(
        spark, i.archive(spark, sf, "comments"), "comments", subreddits=i.filter_list(spark, sf), files_per_trigger=16
    )
    path = scratch_path(spark, "stream-csv")
    sa.drain_to_csv(rows, path, scratch_path(spark, "stream-checkpoint"))
    return t.read_entity_csv(spark, path, "comments")


@query(f"WITH {S} SELECT file, count(*) AS count FROM s GROUP BY 1")
def stream_archive(spark, sf):
    lines = sa.stream_lines(spark, i.archive(spark, sf, "submissions"), "submissions", files_per_trigger=16)
    return _drained(spark, lines.groupBy("file").agg(F.count("*").alias("count")))


@query(
    f"""WITH {S} SELECT subreddit || ',' || id || ',' || author || ',' ||
      CASE WHEN regexp_matches(title, '[",\\n\\r]') THEN '"' || replace(title, '"', '""') || '"' ELSE title END
      AS value FROM s"""
)
def to_csv_rows(spark, sf):
    """Whole texts as a field, quoted where they hold quotes, commas or line ends."""
    return files.to_csv_rows(p.parse_submissions(i.submission_lines(spark, sf)).drop("file"))
