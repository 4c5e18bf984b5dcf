"""The archives that the registered queries read."""

from __future__ import annotations

import os

from checks import graph_queries as q
from checks import inputs as i
from pyspark.sql import functions as F


def test_only_the_named_kinds_of_an_archive_are_written(spark, tmp_path):
    d = str(tmp_path)
    events = spark.range(40).selectExpr("id as event_id", "timestamp_seconds(1.7e9 + id * 40000) as ts", "id % 5 as user_id", "'view' as event_type", "id + 0.5D as value", "'{}' as props")
    orders = spark.range(9).selectExpr("id as o_orderkey", "id % 4 as o_custkey", "10000D * id as o_totalprice", "timestamp_seconds(1.7e9) as o_orderdate")
    documents = spark.range(30).selectExpr("id as doc_id", "concat('text ', id) as text", "'en' as lang", "'web' as source", "7L as n_chars")
    for name, table in (("events", events), ("orders", orders), ("documents", documents)):
        table.write.parquet(f"{d}/{name}.parquet")
    root = i.archive(spark, d, "comments")
    assert os.listdir(root.removeprefix("file://")) == ["comments"]
    assert i.archive(spark, d) == root
    assert sorted(os.listdir(root.removeprefix("file://"))) == ["authors", "comments", "submissions"]
    for kind, stored in (("comments", i.comment_lines), ("submissions", i.submission_lines), ("authors", i.author_lines)):
        both = i.made_lines(spark, d, kind).withColumn("n", F.lit(1)).unionByName(stored(spark, d).withColumn("n", F.lit(-1)))
        assert both.groupBy("value", "file").agg(F.sum("n").alias("n")).where("n <> 0").count() == 0


def test_only_the_named_exports_are_written(spark, tmp_path, monkeypatch):
    made = []
    monkeypatch.setattr(i, "scored_graph", lambda spark, sf: "graph")
    monkeypatch.setattr(q.pg, "export_graph", lambda graph, **paths: made.append(sorted(paths)))
    paths = q._exported(spark, str(tmp_path), "vertex_path")
    assert q._exported(spark, str(tmp_path), "vertex_path", "edge_path")["vertex_path"] == paths["vertex_path"]
    assert made == [["vertex_path"], ["edge_path"]]
