"""Strict decoding of lines, and the lines that are dropped."""

from __future__ import annotations

import json

import pytest
from conftest import rows

from threadloom.operators import parse as p
from threadloom.operators.filters import filter_raw_json, filter_subreddits, split_lines

FULL_LINE = json.dumps(
    {
        "tags": ["soup", "bread"],
        "num_replies": 17,
        "title": "Which hut serves the best soup?",
        "media": {"kind": "none", "size": None},
        "subreddit": "alpine_huts",
        "over_18": False,
        "author": "marmot42",
        "edited": None,
        "id": "zz91k",
        "created_utc": 1388534400,
    }
)
EXPECTED = ("alpine_huts", "zz91k", "marmot42", "Which hut serves the best soup?")


def test_minimal_submission(lines):
    parsed = p.parse_submissions(lines('{"title":"t 1","author":"w","id":"7","subreddit":"Huts"}'))
    assert parsed.columns == ["subreddit", "id", "author", "title", "file"]
    assert rows(parsed.drop("file")) == [("Huts", "7", "w", "t 1")]


def test_line_with_many_other_fields(lines):
    assert rows(p.parse_submissions(lines(FULL_LINE)).drop("file")) == [EXPECTED]


def test_nul_lines_are_ignored(lines):
    parsed = p.parse_submissions(lines(FULL_LINE, "\0" * 29, FULL_LINE))
    assert rows(parsed.drop("file")) == [EXPECTED, EXPECTED]


def test_missing_and_null_fields_are_null(lines):
    parsed = p.parse_comments(lines('{"author":null,"body":"x"}', "{}"))
    assert rows(parsed.drop("file")) == [(None, None, None, "x"), (None, None, None, None)]


@pytest.mark.parametrize(
    ("line", "reason"),
    [
        ("", "blank"),
        ("   ", "blank"),
        ("\0\0", "nul"),
        ("{broken", "malformed"),
        ('{"author":"x"} xyz', "malformed"),
        ('{"author":"x"}{"author":"y"}', "malformed"),
        ('{"author":"x"},{"author":"y"}', "malformed"),
        ('{"author":"x"}]', "malformed"),
        ('{"author":"x"}}', "malformed"),
        ("{'author':'x'}", "malformed"),
        ('{"author":"x","n":NaN}', "malformed"),
        ('{"author":"x","n":01}', "malformed"),
        ('{"author":"x",}', "malformed"),
        ("[1]", "not_object"),
        ('[{"author":"x"}]', "not_object"),
        ('"text"', "not_object"),
        ("5", "not_object"),
        ("null", "not_object"),
        ('{"author":5}', "wrong_type:author"),
        ('{"author":true}', "wrong_type:author"),
        ('{"author":{"a":1}}', "wrong_type:author"),
        ('{"author":["x"]}', "wrong_type:author"),
        ('{"author":"x","subreddit":1}', "wrong_type:subreddit"),
    ],
)
def test_rejected_lines(lines, line, reason):
    assert p.parse_user_in_subreddit(lines(line)).count() == 0
    assert p.drop_malformed(lines(line), "user_in_subreddit").count() == 0
    assert rows(p.quarantine_malformed(lines(line), "user_in_subreddit"), "reason") == [(reason,)]


@pytest.mark.parametrize(
    ("line", "author"),
    [
        ('  {"author":"x"}  ', "x"),
        ('{"author":"x","author":"y"}', "y"),
        ('{"author":"\\u00e9\\ud83d\\ude00"}', "é😀"),
        ('{"author":"a\\"b\\\\c"}', 'a"b\\c'),
        ('{"author":"]},{"}', "]},{"),
        ('{"author":"x"}\r', "x"),
        ('{"author":""}', ""),
    ],
)
def test_accepted_lines(lines, line, author):
    assert rows(p.parse_user_in_subreddit(lines(line)), "author") == [(author,)]
    assert p.quarantine_malformed(lines(line), "user_in_subreddit").count() == 0


def test_account_creation_time_must_be_a_number(lines):
    kept = lines(
        '{"author":"a","created_utc":1397113483}',
        '{"author":"b","created_utc":1397113483.7}',
        '{"author":"c","created_utc":1e9}',
        '{"created_utc":5}',
    )
    assert rows(p.parse_authors(kept), "author", "created_utc") == [
        ("a", 1397113483),
        ("b", 1397113483),
        ("c", 1000000000),
        (None, 5),
    ]
    dropped = lines('{"author":"a"}', '{"author":"a","created_utc":null}', '{"author":"a","created_utc":"1230768002"}')
    assert p.parse_authors(dropped).count() == 0
    assert rows(p.quarantine_malformed(dropped, "authors"), "reason") == [("not_number:created_utc",)] * 3


def test_whole_long_texts_are_decoded(lines):
    body = "word " * 200_000
    assert rows(p.parse_comments(lines(json.dumps({"body": body}))), "body") == [(body,)]


def test_line_is_parsed_once(lines):
    plan = p.parse_comments(lines("{}"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1


def test_raw_lines_stay_verbatim(spark, lines):
    good = ' {"author": "u",  "subreddit":"A", "other": [1, 2]}'
    data = lines(good, "", "{broken", '{"author":"[deleted]","subreddit":"A"}', '{"subreddit":"A"}', '{"author":5}')
    assert rows(filter_raw_json(data), "value") == [(good,)]
    other = spark.createDataFrame([("B",)], "subreddit string")
    assert filter_raw_json(data, other).count() == 0


def test_blank_lines_are_dropped(lines):
    assert rows(split_lines(lines("a", "", "\0b", "c")), "value") == [("a",), ("c",)]


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_subreddit_list(spark, limit):
    data = spark.createDataFrame(
        [("A", "u"), ("a", "u"), ("B", "v"), ("A", "u"), (None, "w")], "subreddit string, author string"
    )
    listed = spark.createDataFrame([("A",), ("A",)], "subreddit string")
    assert rows(filter_subreddits(data, listed, limit)) == [("A", "u"), ("A", "u")]
    assert filter_subreddits(data, None, limit).count() == 5
    assert filter_subreddits(data, listed.limit(0), limit).count() == 5


def test_accounts_under_a_subreddit_list(spark):
    accounts = spark.createDataFrame([("u", 5)], "author string, created_utc bigint")
    listed = spark.createDataFrame([("A",)], "subreddit string")
    with pytest.warns(UserWarning, match="no subreddit"):
        assert filter_subreddits(accounts, listed).count() == 0
