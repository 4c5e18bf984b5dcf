"""The sample tables seen as a forum archive.

Events are comments, documents are submissions, orders are accounts; line items give the
memberships of the graph (part = subreddit, order = author). Every row of a table is used. Bands of
a measured column turn part of the rows into missing, deleted or malformed ones.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.operators import graph
from threadloom.plans.materialize import scratch_path, store
from threadloom.sinks.files import write_zstd_lines
from threadloom.sources.paths import open_path, qualified

_kept: dict[tuple, Any] = {}


def keep(spark: SparkSession, sf_dir: str, label: str, make: Callable[[], Any]) -> Any:
    """Build a derived input once per application and table folder."""
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _kept:
        _kept[key] = make()
    return _kept[key]


def forget() -> None:
    """Build derived inputs anew, for timing."""
    _kept.clear()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def contributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as ``(subreddit, author, file)``."""
    return table(spark, sf_dir, "events").selectExpr(
        "case when value > 200 then null when value > 150 then '' else event_type end as subreddit",
        "case when value < 5 then null when value < 12 then '[deleted]' else concat('u', user_id) end as author",
        "date_format(ts, 'yyyy-MM-dd') as file",
    )


# The same rows for the comparison SQL.
CONTRIBUTIONS = """c AS (
  SELECT CASE WHEN value > 200 THEN NULL WHEN value > 150 THEN '' ELSE event_type END AS subreddit,
         CASE WHEN value < 5 THEN NULL WHEN value < 12 THEN '[deleted]' ELSE 'u' || user_id END AS author,
         strftime(ts, '%Y-%m-%d') AS file
  FROM events)"""
LABELLED = """l AS (
  SELECT coalesce(subreddit, 'No-Subreddit-defined') AS subreddit, author, file
  FROM c WHERE subreddit IS NULL OR subreddit <> '')"""


def order_contributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as contributions with a month, over several years."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderpriority as subreddit", "concat('c', o_custkey) as author", "date_format(o_orderdate, 'yyyy-MM') as period"
    )


ORDER_CONTRIBUTIONS = """c AS (
  SELECT o_orderpriority AS subreddit, 'c' || o_custkey AS author, strftime(o_orderdate, '%Y-%m') AS period
  FROM orders)"""


def _make_comment_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as archive lines ``(value, file)``; the low value bands are broken in different ways."""
    named = table(spark, sf_dir, "events").selectExpr(
        "value as band",
        "concat('RC_', date_format(ts, 'yyyy-MM-dd'), '.zst') as file",
        "case when value >= 9 and value < 10 then null when value >= 10 and value < 11 then '' else event_type end"
        " as subreddit",
        "concat('e', event_id) as id",
        "case when value >= 7 and value < 8 then null when value >= 8 and value < 9 then '[deleted]'"
        " else concat('u', user_id) end as author",
        "props as body",
        "user_id",
    )
    lines = named.selectExpr(
        "band",
        "file",
        "to_json(struct(subreddit, id, author, body), map('ignoreNullFields', 'false')) as good",
        "to_json(struct(subreddit, id, user_id as author, body)) as numeric_author",
    )
    return lines.selectExpr(
        "case when band < 1 then numeric_author"
        " when band < 2 then substring(good, 1, length(good) - 1)"
        " when band < 3 then concat('[', good, ']')"
        " when band < 4 then ''"
        " when band < 5 then concat(char(0), good)"
        " when band < 6 then concat(good, ' tail')"
        " when band < 7 then concat(good, good)"
        " else good end as value",
        "file",
    )


COMMENTS = """c AS (
  SELECT CASE WHEN value >= 9 AND value < 10 THEN NULL WHEN value >= 10 AND value < 11 THEN '' ELSE event_type END
           AS subreddit,
         'e' || event_id AS id,
         CASE WHEN value >= 7 AND value < 8 THEN NULL WHEN value >= 8 AND value < 9 THEN '[deleted]'
              ELSE 'u' || user_id END AS author,
         props AS body, 'RC_' || strftime(ts, '%Y-%m-%d') || '.zst' AS file
  FROM events WHERE value >= 7)"""


def _make_submission_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as archive lines, whole texts as titles, some with outer blanks and other line ends.

    The files are months of fifteen years; those of the last one carry no date.
    """
    title = """case doc_id % 8 when 0 then concat(' ', text) when 1 then concat(text, '  ')
      when 2 then concat(char(9), text) when 3 then concat('a', char(13), char(10), text, char(13))
      when 4 then concat(text, char(10)) when 5 then concat('"', text, char(10), char(10)) else text end as title"""
    return table(spark, sf_dir, "documents").selectExpr("*", title).selectExpr(
        "to_json(struct(source as subreddit, concat('d', doc_id) as id, concat('w', n_chars) as author,"
        " title, lang as flair, n_chars as score)) as value",
        "if(doc_id % 15 = 14, 'RS_undated.zst',"
        " concat('RS_', 2005 + doc_id % 15, '-', lpad(1 + doc_id % 12, 2, '0'), '.zst')) as file",
    )


SUBMISSIONS = """s AS (
  SELECT source AS subreddit, 'd' || doc_id AS id, 'w' || n_chars AS author,
         CASE doc_id % 8 WHEN 0 THEN ' ' || text WHEN 1 THEN text || '  ' WHEN 2 THEN chr(9) || text
           WHEN 3 THEN 'a' || chr(13) || chr(10) || text || chr(13) WHEN 4 THEN text || chr(10)
           WHEN 5 THEN '"' || text || chr(10) || chr(10) ELSE text END AS title,
         CASE WHEN doc_id % 15 = 14 THEN 'RS_undated.zst'
           ELSE 'RS_' || (2005 + doc_id % 15) || '-' || lpad(CAST(1 + doc_id % 12 AS VARCHAR), 2, '0') || '.zst' END AS file
  FROM documents)"""


def _make_author_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as account lines; price bands give the creation time as text, with a fraction, or not at all."""
    seconds = "unix_timestamp(o_orderdate)"
    account = table(spark, sf_dir, "orders").selectExpr(
        "o_totalprice as band",
        "concat('RA_', year(o_orderdate), '.zst') as file",
        "concat('c', o_custkey) as author",
        f"{seconds} as created_utc",
    )
    return account.selectExpr(
        "case when band < 20000 then to_json(struct(author, cast(created_utc as string) as created_utc))"
        " when band < 40000 then to_json(struct(author, created_utc + 0.5 as created_utc))"
        " when band < 60000 then to_json(struct(author))"
        " else to_json(struct(author, created_utc)) end as value",
        "file",
    )


ACCOUNTS = """a AS (
  SELECT 'c' || o_custkey AS author, CAST(epoch(o_orderdate) AS BIGINT) AS created_utc
  FROM orders WHERE o_totalprice >= 60000 OR (o_totalprice >= 20000 AND o_totalprice < 40000))"""


def _stored(spark: SparkSession, sf_dir: str, label: str, make: Callable[..., DataFrame]) -> DataFrame:
    """Derived lines, written once over several files."""
    return keep(spark, sf_dir, label, lambda: store(make(spark, sf_dir).repartition(32), label).table)


def comment_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, "comments", _make_comment_lines)


def submission_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, "submissions", _make_submission_lines)


def author_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, "authors", _make_author_lines)


LINES = {"comments": _make_comment_lines, "submissions": _make_submission_lines, "authors": _make_author_lines}


def made_lines(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """The lines of a kind as they are made from the table, for what reads them once."""
    return LINES[kind](spark, sf_dir)


def archive(spark: SparkSession, sf_dir: str, *kinds: str) -> str:
    """A dataset directory of Zstandard archives written from the tables, with the named kinds at least, all if none is named."""
    root = keep(spark, sf_dir, "archive", lambda: scratch_path(spark, "dataset"))
    for kind in kinds or LINES:
        keep(spark, sf_dir, f"archive {kind}", lambda: write_zstd_lines(made_lines(spark, sf_dir, kind), f"{root}/{kind}"))
    return root


def framed_archive(spark: SparkSession, sf_dir: str) -> str:
    """The submissions as ``.zst`` files of many small frames."""

    def make() -> str:
        root = scratch_path(spark, "framed")
        write_zstd_lines(made_lines(spark, sf_dir, "submissions"), root, frame_bytes=1 << 14)
        return root

    return keep(spark, sf_dir, "framed", make)


def xz_archive(spark: SparkSession, sf_dir: str, submissions: bool = False) -> str:
    """The comment lines as ``.xz`` files, each of several concatenated streams; ``submissions`` beside them as ``.zst`` files."""

    def make() -> str:
        root = qualified(spark, f"{scratch_path(spark, 'xz-dataset')}/comments")
        system, inner = open_path(root)
        system.create_dir(inner, recursive=True)

        def write(batches):
            import lzma

            import pyarrow.compute as pc

            target = open_path(root)[0]
            for batch in batches:
                names, values = batch.column("file"), batch.column("value")
                for name in names.drop_null().unique().to_pylist():
                    rows = values.filter(pc.equal(names, name)).to_pylist()
                    # A small window: the usual one takes some 100 MB of each task.
                    packed = lzma.compress(("\n".join(rows) + "\n").encode(), preset=1)
                    with target.open_append_stream(f"{inner}/{name.replace('.zst', '.xz')}") as out:
                        out.write(packed)
                yield batch.slice(0, 0)

        by_file = made_lines(spark, sf_dir, "comments").repartition("file").sortWithinPartitions("file")
        by_file.mapInArrow(write, "value string, file string").count()
        return root.rsplit("/", 1)[0]

    root = keep(spark, sf_dir, "xz", make)
    if submissions:
        lines = made_lines(spark, sf_dir, "submissions")
        keep(spark, sf_dir, "xz submissions", lambda: write_zstd_lines(lines, f"{root}/submissions"))
    return root


def filter_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event types that sort before 'purchase'."""
    types = table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n"))
    return types.where("event_type < 'purchase'").selectExpr("event_type as subreddit")


def memberships(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts and the orders they appear in."""
    return table(spark, sf_dir, "lineitem").selectExpr("l_partkey as subreddit", "l_orderkey as author").distinct()


def supplier_memberships(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers and their customers: few vertices, many per author."""
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    joined = items.join(orders, items.l_orderkey == orders.o_orderkey)
    return joined.selectExpr("l_suppkey as subreddit", "o_custkey as author").distinct()


def scored_graph(spark: SparkSession, sf_dir: str) -> graph.Graph:
    return keep(spark, sf_dir, "graph", lambda: graph.build_graph(memberships(spark, sf_dir)))


# The scored graph as SQL: es holds the edges, vx the vertices.
GRAPH = """m AS (SELECT DISTINCT l_partkey AS s, l_orderkey AS a FROM lineitem),
e AS (SELECT x.s AS i, y.s AS j, count(*) AS u FROM m x JOIN m y ON x.a = y.a AND x.s < y.s GROUP BY x.s, y.s),
b AS (SELECT i AS v, j AS w, u FROM e UNION ALL SELECT j, i, u FROM e),
d AS (SELECT v, count(*) AS k, CAST(sum(u) AS BIGINT) AS ui FROM b GROUP BY v),
es AS (SELECT e.i, e.j, e.u AS u_ij, di.k AS degree_i, dj.k AS degree_j,
              CAST(di.ui AS DOUBLE) AS weighted_degree_i, CAST(dj.ui AS DOUBLE) AS weighted_degree_j,
              CAST(di.ui AS DOUBLE) / di.k AS avg_weighted_edge_weight_i,
              CAST(dj.ui AS DOUBLE) / dj.k AS avg_weighted_edge_weight_j,
              e.u / ((CAST(di.ui AS DOUBLE) / di.k + CAST(dj.ui AS DOUBLE) / dj.k) / 2) AS w_ij
       FROM e JOIN d di ON e.i = di.v JOIN d dj ON e.j = dj.v),
sw AS (SELECT v, sum(w_ij) AS sw FROM (SELECT i AS v, w_ij FROM es UNION ALL SELECT j, w_ij FROM es) q GROUP BY v),
dd AS (SELECT b.v, CAST(sum(d.k) AS BIGINT) AS dd, sum(sw.sw) AS wdd
       FROM b JOIN d ON b.w = d.v JOIN sw ON sw.v = b.w GROUP BY b.v),
t3 AS (SELECT x.i AS a, x.j AS b, y.j AS c FROM e x JOIN e y ON x.j = y.i JOIN e z ON z.i = x.i AND z.j = y.j),
tr AS (SELECT v, count(*) AS t FROM (SELECT a AS v FROM t3 UNION ALL SELECT b FROM t3 UNION ALL SELECT c FROM t3) q
       GROUP BY v),
vx AS (SELECT s.s AS i, coalesce(d.ui, 0) AS ui, coalesce(d.k, 0) AS degree,
              CAST(d.ui AS DOUBLE) / d.k AS weighted_degree, coalesce(dd.dd, 0) AS degree_degree,
              round(coalesce(dd.wdd, 0), 6) AS weighted_degree_degree,
              CASE WHEN coalesce(d.k, 0) <= 1 THEN CAST(0 AS DOUBLE)
                   ELSE CAST(2 * coalesce(tr.t, 0) AS DOUBLE) / (CAST(d.k AS DOUBLE) * (d.k - 1)) END
                AS local_clustering_coefficient
       FROM (SELECT DISTINCT s FROM m) s LEFT JOIN d ON d.v = s.s LEFT JOIN dd ON dd.v = s.s
            LEFT JOIN tr ON tr.v = s.s)"""
