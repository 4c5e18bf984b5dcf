"""Counts per subreddit, period and year, top lists and histograms."""

from __future__ import annotations

import random

import numpy as np
import pytest
from conftest import rows

from threadloom.operators import counts as c
from threadloom.operators.histogram import histogram, histograms

# Two files: the first seven rows and the other five.
REPEATED = [
    ("Huts", "Ada"),
    ("Huts", "Ada"),
    ("Peaks", "Ben"),
    ("Lakes", "Ada"),
    ("Peaks", "Ada"),
    ("Huts", "Cleo"),
    ("Peaks", "Ben"),
    ("Lakes", "Dov"),
    ("Huts", "Ada"),
    ("Peaks", "Ben"),
    ("Huts", "Dov"),
    ("Lakes", "Ada"),
]


@pytest.fixture
def repeated(spark):
    data = [(s, a, "one" if k < 7 else "two") for k, (s, a) in enumerate(REPEATED)]
    return spark.createDataFrame(data, "subreddit string, author string, file string")


def frame(spark, *data):
    return spark.createDataFrame(list(data), "subreddit string, author string")


def test_single_user(spark):
    assert rows(c.users_per_subreddit(frame(spark, ("Huts", "Ada")))) == [("Huts", 1)]


def test_repeated_users(repeated):
    assert rows(c.users_per_subreddit(repeated)) == [("Huts", 3), ("Lakes", 2), ("Peaks", 2)]
    assert rows(c.contributions_per_subreddit(repeated)) == [("Huts", 5), ("Lakes", 3), ("Peaks", 4)]


def test_users_per_file_are_added_up(repeated):
    assert rows(c.users_per_subreddit(repeated, "file")) == [("Huts", 4), ("Lakes", 3), ("Peaks", 3)]
    with pytest.raises(ValueError):
        c.users_per_subreddit(repeated, "day")


def test_deleted_authors_contribute_but_are_no_users(spark):
    data = frame(spark, ("S", "[deleted]"), ("S", "u"), ("D", "[deleted]"))
    assert rows(c.contributions_per_subreddit(data)) == [("D", 1), ("S", 2)]
    assert rows(c.users_per_subreddit(data)) == [("S", 1)]
    assert rows(c.approx_users_per_subreddit(data)) == [("S", 1)]


def test_rows_without_any_field_do_not_count_twice(spark):
    assert rows(c.contributions_per_subreddit(frame(spark, ("S", "u"), (None, None), ("S", "u")))) == [("S", 2)]


def test_missing_subreddit_is_labelled_and_empty_one_dropped(spark):
    data = frame(spark, (None, "u"), ("", "u"))
    assert rows(c.contributions_per_subreddit(data)) == [("No-Subreddit-defined", 1)]
    assert rows(c.users_per_subreddit(data)) == [("No-Subreddit-defined", 1)]


def test_merge_and_per_user_counts(repeated):
    first, second = (c.contributions_per_subreddit(repeated.where(f"file = '{n}'")) for n in ("one", "two"))
    assert rows(c.merge_counts(first, second)) == rows(c.contributions_per_subreddit(repeated))
    assert ("Huts", "Ada", 3) in rows(c.contributions_per_user_in_subreddit(repeated))


def test_users_never_exceed_contributions(repeated):
    users, per_file = dict(rows(c.users_per_subreddit(repeated))), dict(rows(c.users_per_subreddit(repeated, "file")))
    for subreddit, count in rows(c.contributions_per_subreddit(repeated)):
        assert users[subreddit] <= per_file[subreddit] <= count


def test_periods(spark):
    data = spark.createDataFrame(
        [("S", "u", "2018-01"), ("S", "u", "2018-02"), ("S", "v", "2018-02-03"), ("S", "u", "2019-01")],
        "subreddit string, author string, period string",
    )
    assert rows(c.users_per_period(data)) == [
        ("all", "all", "S", 2),
        ("month", "2018-01", "S", 1),
        ("month", "2018-02", "S", 2),
        ("month", "2019-01", "S", 1),
        ("year", "2018", "S", 2),
        ("year", "2019", "S", 1),
    ]
    contributions = {row[:3]: row[3] for row in rows(c.contributions_per_period(data))}
    assert contributions[("year", "2018", "S")] == 3
    assert contributions[("all", "all", "S")] == 4


def test_top_lists_break_ties_by_name(spark):
    data = spark.createDataFrame([("b", 2), ("a", 2), ("c", 1), ("d", 5)], "subreddit string, count bigint")
    assert [tuple(r) for r in c.top_n(data, 2).collect()] == [("d", 5), ("a", 2)]
    assert [r["subreddit"] for r in c.sort_desc(data).collect()] == ["d", "a", "b", "c"]
    ranked = c.top_n_per_period(data.selectExpr("'p' as period", "*"), 3)
    assert rows(ranked, "subreddit", "rank") == [("a", 2), ("b", 3), ("d", 1)]


def test_top_n_needs_no_full_sort(spark):
    data = spark.range(100).selectExpr("cast(id as string) as subreddit", "id % 7 as count", "id % 3 as period")
    plan = c.top_n(data.drop("period"), 5)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
    ranked = c.top_n_per_period(data, 3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in ranked


def test_accounts_per_year_ignores_the_session_time_zone(spark):
    data = spark.createDataFrame([(1397113483,), (1577836799,), (1577836800,)], "created_utc bigint")
    spark.conf.set("spark.sql.session.timeZone", "Pacific/Auckland")
    try:
        assert rows(c.accounts_per_year(data)) == [(2014, 1), (2019, 1), (2020, 1)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize(
    "values",
    [
        [random.Random(7).gauss(0, 3) for _ in range(2000)],
        [k / 10 for k in range(101)],
        list(range(0, 1000, 7)),
        [4.0, 4.0],
        [0.1 * k for k in range(37)] * 3,
    ],
)
@pytest.mark.parametrize("bins", [10, 100])
def test_histogram_equals_numpy(spark, values, bins):
    data = spark.createDataFrame([(float(v),) for v in values] + [(None,), (float("nan"),)], "v double")
    found = histogram(data, "v", bins).orderBy("bin").collect()
    expected, edges = np.histogram(values, bins)
    assert [r["count"] for r in found] == expected.tolist()
    assert np.allclose([r["lower"] for r in found], edges[:-1])
    assert np.allclose([r["upper"] for r in found], edges[1:])


def test_histograms_without_numbers(spark):
    data = spark.createDataFrame([(None, 1.0)], "a double, b double")
    assert histograms(data, ["a"]).count() == 0
    assert histograms(data, ["a", "b"], 2).where("column = 'b'").agg({"count": "sum"}).first()[0] == 1
