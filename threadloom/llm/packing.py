"""Pack tokenised documents into as few sequences of bounded length as can be found.

1. Every document becomes token ids and an end id. Only a document longer than a sequence is cut; its
   first piece takes the remainder, so all further ones fill a sequence each.
2. Only lengths matter for packing, so the instance is the number of pieces of each length:
   at most ``capacity`` numbers, however many documents there are.
3. Dominance reduction after Martello and Toth: from the longest length down, a set of pieces is
   fixed for good where no other set with that piece can be better: a piece that nothing fits beside;
   a pair that fills the sequence, or whose second is the longest that fits where no two fit;
   a triple made in the same way where no three fit. A set is fixed as often as its pieces allow, so
   there are at most a few rounds for each length.
4. What is left is packed best fit, longest first. All pieces of one length are placed in one go, on
   groups of equally filled sequences; the outcome is that of placing them one by one.
5. The result is a list of patterns with how often each is used. Pieces of a length are numbered
   side by side (in shards, so that a length shared by a third of all pieces is no single task) and
   the number tells pattern, sequence and offset.

Null and empty texts are the end id alone. Very long texts are encoded whole and cut as above. Repeated rows are pieces of their own,
equal lengths are dealt by number. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadloom.llm.tokens import VOCABULARY, encoder
from threadloom.plans.materialize import store

CAPACITY = 2048
END = 0
PIECES_PER_SHARD = 50_000


def cut(count: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of a document's pieces; the first may be shorter."""
    first = count % capacity or capacity
    ends = range(first, count + 1, capacity)
    return [(max(0, end - capacity), end - max(0, end - capacity)) for end in ends]


def pieces(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """``doc_id``, piece, start, length, ids_crc32 of every piece of ``doc_id``, ``text``."""
    vocabulary = path or public_tokenizers.path(VOCABULARY)
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["piece", "start", "length", "ids_crc32"]

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, end = encoder(vocabulary), np.array([END], "<u4").tobytes()
        for batch in batches:
            row, made = [], []
            for k, encoded in enumerate(coder.encode_column(batch.column(1), end)):
                ids = np.frombuffer(encoded, "<u4")
                for number, (start, length) in enumerate(cut(len(ids), capacity)):
                    row.append(k)
                    made.append((number, start, length, zlib.crc32(ids[start : start + length].tobytes())))
            columns = np.array(made, np.int64).reshape(-1, 4)
            arrays = [pa.array(columns[:, 0], pa.int32()), *(pa.array(columns[:, k]) for k in (1, 2, 3))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())), *arrays], ["doc_id", *names]
            )

    return docs.select("doc_id", "text").mapInArrow(
        tokenise, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
    )


Pattern = tuple[tuple[int, ...], int]  # lengths in a sequence, number of such sequences


def reduce(lengths: Counter[int], capacity: int) -> tuple[list[Pattern], Counter[int]]:
    """Sets fixed for good by dominance, and the pieces that are left."""
    left = Counter({size: n for size, n in lengths.items() if n > 0})
    fixed: list[Pattern] = []

    def largest(most: int, without: Counter[int]) -> int:
        return max((size for size, n in left.items() if size <= most and n > without[size]), default=0)

    def smallest_sum(count: int, without: Counter[int]) -> int:
        total = 0
        for size in sorted(left):
            took = min(count, left[size] - without[size])
            total, count = total + took * size, count - took
            if not count:
                return total
        return capacity + 1

    def fix(*pattern: int) -> None:
        """As often as the pieces allow: taking pieces away can't undo what makes the set dominate."""
        times = min(left[size] // n for size, n in Counter(pattern).items())
        fixed.append((pattern, times))
        for size, n in Counter(pattern).items():
            left[size] -= n * times
            if not left[size]:
                del left[size]

    for size in sorted(left, reverse=True):
        while left.get(size, 0):
            own, room = Counter([size]), capacity - size
            second = largest(room, own)
            if not second:
                fix(size)
            elif second == room or smallest_sum(2, own) > room:
                fix(size, second)
            else:
                third = largest(room - second, own + Counter([second]))
                if not third or smallest_sum(3, own) <= room or third < largest(room // 2, own):
                    break  # nothing dominates: this length is left to best fit
                fix(size, second, third)
    return fixed, left


def best_fit(lengths: Counter[int], capacity: int) -> list[Pattern]:
    """Best fit, longest first, on groups of equally filled sequences."""
    open_: dict[int, list[Pattern]] = {}
    for size in sorted(lengths, reverse=True):
        n = lengths[size]
        while n > 0:
            room = min((r for r in open_ if r >= size), default=capacity)
            pattern, times = open_[room].pop() if room in open_ else ((), n)
            if room in open_ and not open_[room]:
                del open_[room]
            each = min(room // size, n)
            used = min(times, n // each)
            open_.setdefault(room - each * size, []).append((pattern + (size,) * each, used))
            if pattern and times > used:
                open_.setdefault(room, []).append((pattern, times - used))
            n -= each * used
    return [group for groups in open_.values() for group in groups]


class Slots(NamedTuple):
    """Where the numbered pieces of each length go, in order of length and first number."""

    key: np.ndarray  # length and first number in one
    first: np.ndarray
    each: np.ndarray
    offset: np.ndarray
    sequence: np.ndarray


def slots(patterns: list[Pattern]) -> Slots:
    sequence, given, rows = 0, Counter(), []
    for pattern, times in patterns:
        offset = 0
        for size, each in sorted(Counter(pattern).items(), reverse=True):
            rows.append((size, given[size], each, offset, sequence))
            given[size] += each * times
            offset += size * each
        sequence += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return Slots((table[:, 0] << 48) + table[:, 1], *(table[:, k] for k in range(1, 5)))


def plan(lengths: Counter[int], capacity: int = CAPACITY) -> list[Pattern]:
    fixed, left = reduce(lengths, capacity)
    return fixed + best_fit(left, capacity)


def pack(cut_pieces: DataFrame, capacity: int = CAPACITY, per_shard: int = PIECES_PER_SHARD) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to stored pieces with ``doc_id``, ``piece``, ``length``, ``ids_crc32``."""
    # At most `capacity` rows: the number of pieces of each length.
    counted = cut_pieces.groupBy("length").count().collect()
    lengths = Counter({row["length"]: row["count"] for row in counted})
    found = slots(plan(lengths, capacity))
    shards = sum(lengths.values()) // per_shard + 1
    dealt = cut_pieces.withColumn("_shard", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(shards)))
    before = dealt.groupBy("length", "_shard").count()
    by_shard = Window.partitionBy("length").orderBy("_shard")
    before = before.withColumn("_before", F.sum("count").over(by_shard) - F.col("count")).drop("count")
    inside = Window.partitionBy("length", "_shard").orderBy("doc_id", "piece")
    numbered = dealt.withColumn("_inside", F.row_number().over(inside) - 1).join(before, ["length", "_shard"])
    numbered = numbered.withColumn("_number", F.col("_before") + F.col("_inside")).drop("_shard", "_before", "_inside")
    names = [name for name in numbered.columns if name != "_number"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, number = (batch.column(name).to_numpy() for name in ("length", "_number"))
            at = np.searchsorted(found.key, (length << 48) + number, side="right") - 1
            nth = number - found.first[at]
            sequence = found.sequence[at] + nth // found.each[at]
            offset = found.offset[at] + nth % found.each[at] * length
            kept = [batch.column(name) for name in names]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

    kinds = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in numbered.schema if field.name in names)
    return numbered.mapInArrow(place, f"{kinds}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """Tokenise, cut and pack ``doc_id``, ``text``; the pieces are stored between the two passes over them."""
    made = store(pieces(docs, capacity, path), "pieces").table
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return pack(made, capacity).select(*columns)
