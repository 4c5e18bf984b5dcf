"""Document fingerprints by one-permutation MinHash, kept as packed low-order bits.

The distinct five-word shingles of a text (A-Z lowered; fewer words: the whole sequence) are hashed
once. The top bits of a hash choose one of ``BINS`` bins, and a bin keeps its smallest hash.
Empty bins are filled by optimal densification: each borrows from a bin drawn among all filled
ones, and the draw depends on the two bin numbers only, so equal sets fill alike and near sets mostly do.
Eight low-order bits of every bin are packed into a string of hexadecimal digits.

The likeness of two fingerprints is the share of equal bins, freed from the matches by chance that
eight bits allow: (share - 1/256) / (1 - 1/256), at least 0.

The work is DataFrame expressions over arrays of one row, whose size is that of its text. A
null or empty text, or one without words, has the fingerprint "" and the likeness 1 to another such
and 0 to the rest. Very long texts have longer arrays and nothing else. Repeated rows get equal fingerprints; where ids are equal
the texts say what comes next. Columns other than the id and the text are left out first. An empty table gives an empty result.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.llm.words import WORD

BINS = 128
BIN_BITS = 7
WIDTH = 5
CHANCE = 1 / 256
ROWS_PER_RANGE = 2048


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is worked out once, however often a lambda inside ``then`` uses it."""
    return F.transform(F.array(value), then)[0]


def word_hashes(text: Column) -> Column:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    words = F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), upper, lower), F.lit(WORD), F.lit(0))
    return F.transform(words, lambda word: F.xxhash64(word))


def shingle_hashes(words: Column) -> Column:
    """Hashes of five neighbours each; fewer words make one shingle, none make none."""
    last = F.size(words) - (WIDTH - 1)
    whole = F.array(F.aggregate(words, F.lit(7).cast("long"), lambda held, word: F.xxhash64(held, word)))
    fives = F.transform(F.sequence(F.lit(0), last - 1), lambda k: F.xxhash64(*(words[k + j] for j in range(WIDTH))))
    return F.when(last >= 1, fives).when(F.size(words) > 0, whole).otherwise(F.array().cast("array<bigint>"))


def _bin(value: Column) -> Column:
    return F.shiftrightunsigned(value, 64 - BIN_BITS).cast("int")


def filled_bins(ordered: Column) -> Column:
    """The smallest hash of every bin that has one, from sorted hashes.

    Sorted as signed numbers, hashes of one bin are neighbours, so a hash is the smallest of its bin
    where the one before it lies in another.
    """
    return F.filter(ordered, lambda v, k: (k == 0) | (_bin(v) != _bin(ordered[F.greatest(k - 1, F.lit(0))])))


def densified(smallest: Column) -> Column:
    """Eight bits for each bin; an empty bin takes those of the filled bin that its own draw puts first."""

    def bins(held: Column) -> Column:
        def value(number: Column) -> Column:
            draws = F.transform(
                smallest, lambda v: F.struct(F.xxhash64(number, _bin(v)).alias("draw"), v.alias("v"))
            )
            return F.coalesce(F.try_element_at(held, number), F.array_min(draws)["v"]).bitwiseAND(F.lit(255))

        return F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), value)

    made = _let(F.map_from_arrays(F.transform(smallest, _bin), smallest), bins)
    return F.when(F.size(smallest) > 0, made).otherwise(F.array().cast("array<bigint>"))


def fingerprint(text: Column) -> Column:
    """The bins of a text, eight bits each; none for a text without words."""
    ordered = _let(word_hashes(text), lambda words: F.sort_array(shingle_hashes(words)))
    return _let(_let(ordered, filled_bins), densified)


def packed(bins: Column) -> Column:
    """Sixteen hexadecimal digits for every eight bins."""

    def digits(held: Column) -> Column:
        def eight(k: Column) -> Column:
            word = held[k * 8]
            for j in range(1, 8):
                word = word.bitwiseOR(F.shiftleft(held[k * 8 + j], 8 * j))
            return F.lpad(F.hex(word), 16, "0")

        return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(BINS // 8 - 1)), eight), "")

    return F.when(F.size(bins) > 0, _let(bins, digits)).otherwise(F.lit(""))


def likeness(a: Column, b: Column) -> Column:
    """From 0 to 1, of two arrays of bins."""
    equal = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, same: n + same)
    share = equal / F.lit(float(BINS))
    both = F.greatest((share - CHANCE) / (1 - CHANCE), F.lit(0.0))
    empty = F.size(a) + F.size(b) == 0
    return F.when(empty, F.lit(1.0)).when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(both)


def range_ends(docs: DataFrame, rows: int = ROWS_PER_RANGE) -> list:
    """The largest ids of consecutive ranges of about ``rows`` ids; a number for each range comes to the driver."""
    ids = docs.select("doc_id").where("doc_id is not null")
    parts = ids.repartitionByRange(ids.count() // rows + 1, "doc_id").groupBy(F.spark_partition_id().alias("part"))
    return sorted(row["most"] for row in parts.agg(F.max("doc_id").alias("most")).collect())


def _text_hash(text: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.coalesce(text, F.lit(""))), 1)


def hash_starts(docs: DataFrame, rows: int = ROWS_PER_RANGE) -> list[int]:
    """The smallest text hashes of consecutive ranges of rows without an id."""
    hashes = docs.where("doc_id is null").select(_text_hash(F.col("text")).alias("hash"))
    parts = F.lit(hashes.count() // rows + 1)
    found = hashes.groupBy(F.floor(F.col("hash") / float(1 << 63) * parts).alias("part")).agg(F.min("hash").alias("least"))
    return sorted(row["least"] for row in found.collect())


def listed(values: list, kind: str) -> Column:
    """Many values as one array; the optimizer reads the text once."""
    return F.from_json(F.lit(json.dumps(values)), kind)


def range_of(value: Column, ends: list, kind: str = "bigint") -> Column:
    """The number of ends below a value, found in two steps."""
    step = max(1, int(len(ends) ** 0.5))
    groups = [ends[k : k + step] for k in range(0, len(ends), step)]
    if not groups:
        return F.lit(0)
    lasts, nested = listed([group[-1] for group in groups], f"array<{kind}>"), listed(groups, f"array<array<{kind}>>")
    return _let(
        F.size(F.filter(lasts, lambda end: end < value)),
        lambda group: group * step + F.size(F.filter(F.coalesce(F.get(nested, group), F.array()), lambda end: end < value)),
    )


def with_next(docs: DataFrame, rows: int = ROWS_PER_RANGE) -> DataFrame:
    """``doc_id``, ``text`` and ``bins`` with those of the next lower id, and after the lowest the highest.

    The ids are cut into ranges 0, 1, ...; rows without an id come after the others, by the hash of their text and then by the text, in
    ranges -1, -2, ... of hashes. So neither many ids nor many rows without one make a range larger. The first row of a range, in
    descending order, also goes to the range before it as its last row, and the first of all to the last range. So one
    shuffle by range puts every text next to the one it needs. Equal ids follow each other by their text.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    ends, starts = range_ends(docs, rows), hash_starts(docs, rows)
    unnamed = F.col("doc_id").isNull()
    made = docs.withColumn("bins", fingerprint(F.col("text"))).withColumn("_hash", F.when(unnamed, _text_hash(F.col("text"))))
    by_hash = -1 - range_of(F.col("_hash"), [start - 1 for start in starts[1:]])
    ranged = made.withColumn("_range", F.when(unnamed, by_hash).otherwise(range_of(F.col("doc_id"), ends, kind)))
    first = F.lit(False)
    if ends:
        first = ~unnamed & (F.col("doc_id") == F.get(listed(ends, f"array<{kind}>"), F.greatest(F.col("_range"), F.lit(0))))
        top = F.col("doc_id") == listed([ends[-1]], f"array<{kind}>")[0]
    if starts:
        first = first | (unnamed & (F.col("_hash") == F.get(listed(starts, "array<bigint>"), F.greatest(-1 - F.col("_range"), F.lit(0)))))
        top = top if ends else F.col("_hash") == starts[0]
    places = F.array(F.struct(F.col("_range").alias("r"), F.lit(0).alias("guest")))
    if ends or starts:
        after_all = F.struct(F.lit(-len(starts)).alias("r"), F.lit(2).alias("guest"))
        before = F.struct((F.col("_range") + 1).alias("r"), F.lit(1).alias("guest"))
        is_top = F.coalesce(top, F.lit(False))
        places = F.when(is_top, F.concat(places, F.array(after_all))).when(first, F.concat(places, F.array(before))).otherwise(places)
    dealt = ranged.withColumn("_place", F.explode(places)).select("doc_id", "text", "bins", "_hash", "_place.r", "_place.guest")
    order = Window.partitionBy("r").orderBy(F.col("guest") == 2, F.col("doc_id").desc_nulls_last(), "_hash", "text")
    return (
        dealt.withColumn("next_text", F.lead("text").over(order))
        .withColumn("next_bins", F.lead("bins").over(order))
        .where("guest = 0")
        .drop("r", "guest", "_hash")
    )


def edited_fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each text and its edited text: its last third gives way to the start of the next document."""
    named = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    both = with_next(named).withColumn("text", F.coalesce("text", F.lit("")))
    both = both.withColumn("n_chars", F.char_length("text").cast("long"))
    third = F.floor(F.col("n_chars") / 3).cast("int")
    start = F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - third)
    edited = F.concat(start, F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), third))
    both = both.withColumn("edited", edited).withColumn("edited_bins", fingerprint(F.col("edited")))
    none = F.array().cast("array<bigint>")
    return both.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited"), 256).alias("edited_sha256"),
        packed(F.col("bins")).alias("fingerprint"),
        packed(F.col("edited_bins")).alias("edited_fingerprint"),
        likeness(F.col("bins"), F.col("edited_bins")).alias("near_edited"),
        likeness(F.col("bins"), F.coalesce("next_bins", none)).alias("near_next"),
    )
