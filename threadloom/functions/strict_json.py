"""Strict decoding of one JSON object per line.

``from_json`` with string fields would turn ``5`` into ``"5"`` and a broken line into a row of
NULLs. Here the wanted fields are decoded as VARIANT, so their JSON type is still visible, and
the other fields are only tokenized, never built.

Each line is decoded inside a two-element array whose second element repeats a hash of the
line. Text after the object, or a second object on the line, breaks the array or moves that
element, so such lines are recognised without a second pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_OPTIONS = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def _wrapped(value: Column) -> tuple[Column, Column]:
    mark = F.xxhash64(value).cast("string")
    return F.concat(F.lit("["), value, F.lit(',{"_mark":"'), mark, F.lit('"}]')), mark


def decode(lines: DataFrame, text: Sequence[str], numbers: Sequence[str] = ()) -> DataFrame:
    """Add a ``_doc`` column: the decoded array and the expected hash.

    The generator keeps the parse in one place; a plain projection would be copied into every
    predicate pushed below it and parse the line several times.
    """
    fields = ", ".join(f"`{name}` variant" for name in (*text, *numbers))
    wrapped, mark = _wrapped(F.col("value"))
    parsed = F.from_json(wrapped, f"array<struct<{fields}, _mark string>>", _OPTIONS)
    return lines.select("*", F.explode(F.array(F.struct(parsed.alias("items"), mark.alias("mark")))).alias("_doc"))


def field(name: str) -> Column:
    """A decoded field as VARIANT."""
    return F.col("_doc.items")[0][name]


def is_text(name: str) -> Column:
    """True when the field is absent, JSON null or a JSON string."""
    return F.coalesce(F.schema_of_variant(field(name)).isin("STRING", "VOID"), F.lit(True))


def is_number(name: str) -> Column:
    """True when the field is present and a JSON number."""
    kind = F.schema_of_variant(field(name))
    return F.coalesce(kind.isin("BIGINT", "DOUBLE") | kind.startswith("DECIMAL"), F.lit(False))


def in_range(name: str) -> Column:
    """True when the whole part of a number fits 32 bits."""
    return F.coalesce(_whole(name).between(-(1 << 31), (1 << 31) - 1), F.lit(False))


def _whole(name: str) -> Column:
    return F.try_variant_get(field(name), "$", "bigint")


def is_single_document() -> Column:
    """True when the line is exactly one well-formed JSON value."""
    items = F.col("_doc.items")
    return F.coalesce((F.size(items) == 2) & (items[1]["_mark"] == F.col("_doc.mark")), F.lit(False))


def is_object() -> Column:
    return F.col("_doc.items")[0].isNotNull()


def is_valid(text: Sequence[str], numbers: Sequence[str] = ()) -> Column:
    """The whole contract of a decodable line."""
    valid = is_single_document() & is_object()
    for name in text:
        valid = valid & is_text(name)
    for name in numbers:
        valid = valid & is_number(name) & in_range(name)
    return valid


def reject_reason(text: Sequence[str], numbers: Sequence[str] = ()) -> Column:
    """Why a line breaks the contract; NULL for a valid line."""
    value = F.col("value")
    # Only for lines the strict decoder refused: is it well-formed JSON of another kind?
    other = F.schema_of_variant(F.try_parse_json(value))
    reason = (
        F.when(F.trim(value) == "", "blank")
        .when(F.ascii(value) == 0, "nul")
        .when(~is_single_document() & other.isNotNull() & ~other.startswith("OBJECT"), "not_object")
        .when(~is_single_document(), "malformed")
        .when(~is_object(), "not_object")
    )
    for name in text:
        reason = reason.when(~is_text(name), f"wrong_type:{name}")
    for name in numbers:
        reason = reason.when(~is_number(name), f"not_number:{name}").when(~in_range(name), f"out_of_range:{name}")
    return reason


def text_value(name: str) -> Column:
    return field(name).cast("string").alias(name)


def number_value(name: str) -> Column:
    """A JSON number as BIGINT, fractions truncated."""
    return _whole(name).alias(name)
