"""Lines to entities, and the lines that are not entities."""

from __future__ import annotations

from pyspark.sql import DataFrame

from threadloom.functions import strict_json as sj
from threadloom.operators.filters import split_lines
from threadloom.schemas import NUMBER_FIELDS, TEXT_FIELDS


def parse_entities(lines: DataFrame, kind: str) -> DataFrame:
    """Decode lines of one kind; lines that break the contract are dropped.

    Columns of ``lines`` other than ``value`` are kept after the entity's own.
    """
    text, numbers = TEXT_FIELDS[kind], NUMBER_FIELDS.get(kind, ())
    decoded = sj.decode(split_lines(lines), text, numbers).where(sj.is_valid(text, numbers))
    shown = [name for name in text if not (kind == "authors" and name == "subreddit")]
    return decoded.select(
        *[sj.text_value(name) for name in shown],
        *[sj.number_value(name) for name in numbers],
        *[name for name in lines.columns if name != "value"],
    )


def parse_submissions(lines: DataFrame) -> DataFrame:
    return parse_entities(lines, "submissions")


def parse_comments(lines: DataFrame) -> DataFrame:
    return parse_entities(lines, "comments")


def parse_authors(lines: DataFrame) -> DataFrame:
    return parse_entities(lines, "authors")


def parse_user_in_subreddit(lines: DataFrame) -> DataFrame:
    return parse_entities(lines, "user_in_subreddit")


def drop_malformed(lines: DataFrame, kind: str) -> DataFrame:
    """The lines, verbatim, that decode as the given kind."""
    text, numbers = TEXT_FIELDS[kind], NUMBER_FIELDS.get(kind, ())
    return sj.decode(split_lines(lines), text, numbers).where(sj.is_valid(text, numbers)).select(*lines.columns)


def quarantine_malformed(lines: DataFrame, kind: str) -> DataFrame:
    """The other lines, with the reason they were dropped."""
    text, numbers = TEXT_FIELDS[kind], NUMBER_FIELDS.get(kind, ())
    decoded = sj.decode(lines, text, numbers)
    return decoded.select(*lines.columns, sj.reject_reason(text, numbers).alias("reason")).where("reason IS NOT NULL")
