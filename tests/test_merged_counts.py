"""Counts that are merged over runs, published tables, and running users in a small state."""

from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest
import zstandard
from conftest import rows
from pyspark.sql import functions as F

from threadloom.operators import counts as c
from threadloom.operators import user_sketches as us
from threadloom.plans.materialize import scratch_path
from threadloom.sinks import published
from threadloom.sources import archive as a
from threadloom.streaming import archives as sa
from threadloom.streaming import bucket_users as bu


def contributions(spark, n, seed, authors=400):
    draw = random.Random(seed)
    named = lambda: draw.choice([None, "[deleted]", *(f"u{draw.randrange(authors)}" for _ in range(8))])
    made = [(draw.choice([None, "", "A", "B", "C"]), named(), f"2018-{draw.randrange(1, 13):02d}") for _ in range(n)]
    return spark.createDataFrame(made, "subreddit string, author string, period string")


def test_users_per_period_by_sets_of_months(spark):
    draw = random.Random(2)
    made = [
        (draw.choice([None, "", "A", "B"]), draw.choice([None, "[deleted]", "x", "y", "z"]), draw.choice(["", None, "2017-12-31", "2018-01", "2018-02-03", "0000-99"]))
        for _ in range(300)
    ]
    expected = defaultdict(set)
    for subreddit, author, period in made:
        if author in (None, "[deleted]") or subreddit == "":
            continue
        name = "No-Subreddit-defined" if subreddit is None else subreddit
        month = (period or "")[:7]
        for level, when in (("month", month), ("year", month[:4]), ("all", "all")):
            if when:
                expected[level, when, name].add(author)
    found = c.users_per_period(spark.createDataFrame(made, "subreddit string, author string, period string"))
    assert {tuple(r)[:3]: r["count"] for r in found.select("level", "period", "subreddit", "count").collect()} == {
        key: len(users) for key, users in expected.items()
    }
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2  # the pairs, and the sums


def test_runs_add_up_without_counting_twice(spark):
    one, two, three = (contributions(spark, 900, seed) for seed in (1, 2, 3))
    every = c.users_per_subreddit(one.union(two).union(three))
    for make, users in ((us.members, us.users_of_runs), (us.user_sketches, lambda s: us.sketched_users(us.merge_sketches(s)))):
        path = scratch_path(spark, "runs")
        for part, run in ((one, "a"), (two, "b"), (three, "b"), (two, "c"), (three, "b"), (one, "c/2018 x")):
            us.store_run(make(part), path, run)
        stored = us.read_runs(spark, path)
        assert {r["run"] for r in stored.select("run").distinct().collect()} == {"a", "b", "c", "c/2018 x"}
        found, wanted = dict(rows(users(stored))), dict(rows(every))
        assert found.keys() == wanted.keys()
        assert all(abs(found[name] - n) <= max(1, 5 * us.relative_error() * n) for name, n in wanted.items())
        only = dict(rows(users(us.read_runs(spark, path, ["a"]))))
        assert all(abs(only[name] - n) <= max(1, 5 * us.relative_error() * n) for name, n in rows(c.users_per_subreddit(one)))
    assert dict(rows(us.users_of_runs(us.members(one)))) == dict(rows(c.users_per_subreddit(one)))


def test_sketches_merge_to_the_same_sketch(spark):
    one, two = (contributions(spark, 700, seed, authors=5000) for seed in (4, 5))
    apart = us.merge_sketches(us.user_sketches(one), us.user_sketches(two), us.user_sketches(two))
    assert rows(us.sketched_users(apart)) == rows(us.sketched_users(us.user_sketches(one.union(two))))
    coarse = us.merge_sketches(us.user_sketches(one, lg_k=8), us.user_sketches(two))  # unlike sizes
    assert {name for name, _ in rows(us.sketched_users(coarse))} == {"A", "B", "C", "No-Subreddit-defined"}
    by_year = us.merge_sketches(us.user_sketches(one, ["period"]).withColumn("year", F.substring("period", 1, 4)), keys=["year"])
    assert set(by_year.columns) == {"year", "subreddit", "sketch"}
    assert us.sketched_users(us.user_sketches(one.limit(0))).count() == 0


def test_a_published_table_is_always_whole(spark):
    path = scratch_path(spark, "published")
    assert published.read_published(spark, path) is None and published.current(spark, path) is None
    published.publish(spark.range(5), path, 1)
    first = published.read_published(spark, path)
    assert first.count() == 5
    # A writer that stops between both steps: the version is there and nobody sees it.
    left = published.write_version(spark.range(50), path, 2)
    assert published.read_published(spark, path).count() == 5
    # One that stops before the version is whole.
    broken = spark.range(50).select(F.when(F.col("id") < 49, F.col("id")).otherwise(F.raise_error(F.lit("stop"))).alias("id"))
    with pytest.raises(Exception, match="stop"):
        published.publish(broken, path, 3)
    assert published.read_published(spark, path).count() == 5
    published.publish(published.read_published(spark, path).union(spark.range(2)), path, 4)  # from itself
    assert published.read_published(spark, path).count() == 7 and first.count() == 5  # a reader of the one before goes on
    names = published._Folder(spark, path).versions()
    assert len(names) == 2 and left not in names
    published.publish(spark.range(0), path, 5)
    assert published.read_published(spark, path).columns == ["id"] and published.read_published(spark, path).count() == 0


def test_a_stream_that_stops_keeps_the_last_result(spark, monkeypatch, tmp_path):
    folder, path, state = tmp_path / "in", scratch_path(spark, "result"), scratch_path(spark, "state")
    (folder / "comments").mkdir(parents=True)
    (folder / "submissions").mkdir()

    def put(name, *pairs):
        lines = "".join(f'{{"subreddit":"{s}","author":"{u}"}}\n' for s, u in pairs)
        (folder / "comments" / name).write_bytes(zstandard.compress(lines.encode()))

    def run():
        counts = sa.stream_contributions(sa.stream_contribution_rows(spark, str(folder)))
        sa.drain_to_table(counts, path, state)
        return rows(published.read_published(spark, path))

    put("RC_2018-01.zst", ("A", "u"), ("A", "v"), ("B", "u"))
    assert run() == [("A", 2), ("B", 1)]
    put("RC_2018-02.zst", ("A", "w"))
    step = published.point_to
    monkeypatch.setattr(published, "point_to", lambda *_: (_ for _ in ()).throw(RuntimeError("stopped between both steps")))
    with pytest.raises(Exception, match="stopped between"):
        run()
    assert rows(published.read_published(spark, path)) == [("A", 2), ("B", 1)]
    monkeypatch.setattr(published, "point_to", step)
    assert run() == [("A", 3), ("B", 1)]


def test_sets_of_numbers():
    draw = np.random.default_rng(1)
    held, seen = b"", set()
    for size in (1, 100, 3000, 2000, 60_000, 5):
        numbers = draw.integers(0, bu.BLOCK, size).tolist()
        held, new = bu.add(held, numbers)
        assert new == len(set(numbers) - seen)
        seen |= set(numbers)
        assert bu.unpack(held).tolist() == sorted(seen)
        assert len(held) <= min(2 * len(seen), bu.BLOCK // 8)


def test_running_users_in_buckets_equal_the_batch(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(bu, "PAGE", 7)
    folder, path, state = tmp_path / "in", scratch_path(spark, "result"), scratch_path(spark, "state")
    (folder / "comments").mkdir(parents=True)
    (folder / "submissions").mkdir()
    draw = random.Random(6)

    def put(name, n):
        pairs = [(draw.choice(["null", '""', '"A"', '"A"', '"B"', '"C"']), draw.choice(['"[deleted]"', "null", *(f'"u{draw.randrange(300)}"' for _ in range(6))])) for _ in range(n)]
        lines = "".join(f'{{"subreddit":{s},"author":{u}}}\n' for s, u in pairs)
        (folder / "comments" / name).write_bytes(zstandard.compress(lines.encode()))

    def run():
        rows_of = sa.stream_contribution_rows(spark, str(folder), files_per_trigger=1)
        query = bu.drain_increments(bu.stream_new_users(rows_of, buckets=3), path, state)
        return query, rows(bu.read_counts(spark, path))

    def batch():
        return rows(c.users_per_subreddit(a.read_contributions(spark, str(folder))))

    put("RC_2018-01.zst", 400)
    put("RC_2018-02.zst", 300)
    query, found = run()
    assert found == batch()
    size = bu.state_size(query)
    assert 0 < size["rows"] < 300 and size["memory"] > 0  # not a row for each of some 1,000 pairs
    put("RC_2018-03.zst", 500)
    # A failure after the state is there and before the version counts: the micro-batch is run again.
    step = published.point_to
    monkeypatch.setattr(published, "point_to", lambda *_: (_ for _ in ()).throw(RuntimeError("stopped")))
    with pytest.raises(Exception, match="stopped"):
        run()
    monkeypatch.setattr(published, "point_to", step)
    assert run()[1] == batch()
    # And one after the version counts, before the stream knows.
    put("RC_2018-04.zst", 200)
    monkeypatch.setattr(published, "point_to", lambda *args: (step(*args), (_ for _ in ()).throw(RuntimeError("stopped late")))[0])
    with pytest.raises(Exception, match="stopped late"):
        run()
    monkeypatch.setattr(published, "point_to", step)
    assert run()[1] == batch()
    assert run()[1] == batch()  # nothing new


def test_running_users_in_buckets_in_a_session_with_the_usual_state_store(spark, tmp_path):
    """The store that Spark takes by itself can't hold a state of several tables."""
    name = "spark.sql.streaming.stateStore.providerClass"
    usual = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    for kind, ending in (("comments", "RC"), ("submissions", "RS")):
        (tmp_path / kind).mkdir()
        lines = "".join(f'{{"subreddit":"S{n % 3}","author":"u{n % 7}"}}\n' for n in range(50))
        (tmp_path / kind / f"{ending}_2018-01.zst").write_bytes(zstandard.compress(lines.encode()))
    path, state = scratch_path(spark, "result"), scratch_path(spark, "state")
    before = spark.conf.get(name)
    spark.conf.set(name, usual)
    try:
        rows_of = sa.stream_contribution_rows(spark, str(tmp_path), files_per_trigger=1)
        bu.drain_increments(bu.stream_new_users(rows_of, buckets=3), path, state)
        assert spark.conf.get(name) == usual
    finally:
        spark.conf.set(name, before)
    assert rows(bu.read_counts(spark, path)) == [("S0", 7), ("S1", 7), ("S2", 7)]
