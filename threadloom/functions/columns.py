"""Small column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from threadloom.schemas import DELETED_AUTHOR, MISSING_SUBREDDIT

# Fixed value: the CSV dialect of every text export. Blanks belong to the values.
CSV_DIALECT = {
    "quote": '"',
    "escape": '"',
    "nullValue": "",
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def named_author(author: str = "author") -> Column:
    """The author is present and the account is not deleted."""
    return F.col(author).isNotNull() & (F.col(author) != DELETED_AUTHOR)


def subreddit_label(subreddit: str = "subreddit") -> Column:
    """A missing subreddit gets a fixed label."""
    return F.coalesce(F.col(subreddit), F.lit(MISSING_SUBREDDIT))


def name_matches(name: Column, prefix: str = "", contains: str = "", excludes: str = "") -> Column:
    """File name test: prefix, and substring, and not another substring. Blank tests are off."""
    test = F.lit(True)
    if prefix:
        test = test & name.startswith(prefix)
    if contains:
        test = test & name.contains(contains)
    if excludes.strip():
        test = test & ~name.contains(excludes)
    return test


def file_period(file: str = "file") -> Column:
    """The ``yyyy-MM`` (or ``yyyy-MM-dd``) part of an archive file name."""
    return F.regexp_extract(F.col(file), r"(\d{4}-\d{2}(?:-\d{2})?)", 1)


def epoch_year(seconds: str = "created_utc") -> Column:
    """Calendar year of epoch seconds in UTC, whatever the session time zone; NULL beyond 32 bits."""
    known = F.when(F.col(seconds).between(-(1 << 31), (1 << 31) - 1), F.col(seconds))
    days = F.floor(known / F.lit(86400)).cast("int")
    return F.year(F.date_add(F.lit("1970-01-01").cast("date"), days))


def csv_line(columns: list[str]) -> Column:
    """The columns as one CSV line, quoted only where needed, NULL as an empty field."""
    return F.to_csv(F.struct(*columns), CSV_DIALECT)


def dot_id(name: str) -> Column:
    """A quoted DOT identifier; dots are not kept."""
    return F.concat(F.lit('"'), F.replace(F.col(name).cast("string"), F.lit("."), F.lit("_")), F.lit('"'))
