"""Language-model scores from a hierarchical Pitman-Yor model of word pairs.

Every word that occurs as a context is a restaurant; all of them share one parent, the restaurant of
single words, whose own parent is uniform over the known words and one unknown. A word's customers at a context
are its training counts there; each table they take sends one customer to the parent. The
seating is sampled by Gibbs: all customers of a word leave a restaurant together and are seated again given all other tables, which
needs the number of their tables only; ``seating`` draws it from its exact law, however many customers there are. The parent
is sampled in every sweep too, before the contexts. After ``BURN`` sweeps, ``SAMPLES`` sweeps are averaged:

    P(w | u) = mean(c_uw - d t_uw) / (s + c_u) + mean(s + d t_u) / (s + c_u) * P(w)
    P(w)     = mean(n_w - d0 t_w) / (s0 + n) + mean(s0 + d0 t) / (s0 + n) / (V + 1)

Discounts and strengths are given (``Shape``). Within a sweep the restaurants of all words see the tables that the last one left.

How it is spread out:

1. Documents are read once and become chunks of about ``CHUNK_TOKENS`` tokens, stored: word hashes and the
   text as numbers. A word is its 64-bit hash from here on.
2. Words that make up more than a small share of some chunk are counted: the heavy contexts.
3. A chunk sends its distinct pairs with their training counts to buckets of contexts. A heavy
   context is spread over all buckets by the second word, so that no context is one task. A
   bucket adds the counts up and notes which of its pairs each chunk asked for.
4. Before each sweep, buckets of words add up the tables of every word, seat the parent and tell both to the buckets that
   hold the word; the tables of heavy contexts are added up likewise. A bucket then sweeps its restaurants with the
   parent of all tables, so the seating doesn't depend on the number of buckets (the distributed sampler of
   Newman and others for topic models, which synchronises after every sweep).
5. After the last sweep a bucket answers each chunk pair by pair and passes on counts and tables of its words.
6. Buckets of words add these up and seat the parent; chunks ask them for their words.
7. Every chunk puts the answers together and sums the logarithms by document.

What is sent is linear in the distinct pairs of chunks, and in each sweep in the words of buckets, and so grows with the
corpus. All tasks hold one chunk or bucket: their numbers set the numbers of partitions, whatever the session says. What a sweep
leaves is deleted after the next. Nothing but totals and one row for each heavy context (at most 1 / ``HEAVY`` words) comes to the driver.

Null and empty texts are the end token alone. Very long texts make a larger chunk. Repeated rows count each time and
score alike. Without training rows every probability is that of the uniform parent. An empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.llm.seating import draw_tables
from threadloom.llm.words import raw_texts
from threadloom.plans.materialize import discard, scratch_path, store

CHUNK_TOKENS = 1_250_000
BUCKET_TOKENS = 1_500_000
HEAVY = 1e-5
BURN, SAMPLES = 2, 3
SEED = 5
END, START = np.uint64(xxhash.xxh3_64_intdigest(b"")), np.uint64(xxhash.xxh3_64_intdigest(b" "))
STEP, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Shape(NamedTuple):
    """Discount and strength of the contexts and of their parent."""

    discount: float = 0.8
    strength: float = 2.0
    parent_discount: float = 0.7
    parent_strength: float = 10.0


# --- arrays as bytes


def squeeze(values: np.ndarray) -> bytes:
    """Compressed, byte by byte: the upper bytes of small numbers vanish."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T)
    return zstandard.compress(planes.tobytes(), 1)


def expand(data: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


def squeeze_sorted(values: np.ndarray) -> bytes:
    return squeeze(np.diff(values, prepend=np.uint64(0)))


def expand_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(expand(data, np.uint64), dtype=np.uint64)


def mixed(value: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        value = (value ^ (value >> np.uint64(32))) * MIX
        return value ^ (value >> np.uint64(29))


# --- seating


class Known(NamedTuple):
    """Totals of the parent: its words, customers and tables."""

    v: int
    customers: int
    tables: float


def seat_parent(customers: np.ndarray, known: Known, shape: Shape, seed: list[int]) -> np.ndarray:
    """Tables of words in the parent, given those that all words had there before."""
    others = np.full(len(customers), max(known.tables - 1.0, 0.0))
    chance = np.full(len(customers), 1 / (known.v + 1))
    draw = np.random.default_rng(seed)
    return draw_tables(customers, others, chance, shape.parent_discount, shape.parent_strength, draw)


# --- chunks


def _heavy_words(rows: DataFrame) -> DataFrame:
    """``word``, ``n`` of words that are frequent in some chunk; word null: all tokens."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, line in zip(*(column.to_pylist() for column in batch.columns)):
                words, line = expand_sorted(words), expand(line, np.int32)
                found = np.bincount(line, minlength=len(words))
                often = np.flatnonzero((found >= max(2, HEAVY * len(line))) & (words != END))
                names, sums = [None, *words[often].view(np.int64).tolist()], [len(line), *found[often].tolist()]
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(sums, pa.int64())], ["word", "n"])

    return rows.select("words", "line").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def chunks(docs: DataFrame) -> DataFrame:
    """Chunks of ``doc_id``, ``text``, ``train``: word hashes in order, and every text as places in that list."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["chunk", "doc_id", "tokens", "train", "words", "line"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        seen: dict[bytes, int] = {}
        line, ids, sizes, train = [], [], [], []

        def chunk() -> pa.RecordBatch:
            hashes = np.array([END, *(xxhash.xxh3_64_intdigest(word) for word in seen)], np.uint64)
            words, place = np.unique(hashes, return_inverse=True)
            values = [
                pa.array([number]),
                pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), pa.concat_arrays(ids_of)),
                pa.array([squeeze(np.array(sizes, np.int64))]),
                pa.array([squeeze(np.array(train, np.int8))]),
                pa.array([squeeze_sorted(words)]),
                pa.array([squeeze(place[np.array(line, np.int64)].astype(np.int32))]),
            ]
            return pa.RecordBatch.from_arrays(values, names)

        for batch in batches:
            ids_of = []
            texts, flags = raw_texts(batch.column(1)), batch.column(2).to_pylist()
            first = 0
            for k, (text, flag) in enumerate(zip(texts, flags, strict=True)):
                words = text.lower().split()
                line += [seen.setdefault(word, len(seen) + 1) for word in words]
                line.append(0)
                ids.append(k)
                sizes.append(len(words) + 1)
                train.append(bool(flag))
                if len(line) >= CHUNK_TOKENS or k == len(texts) - 1:
                    ids_of = [batch.column(0).slice(first, k + 1 - first)]
                    yield chunk()
                    number, first = number + 1, k + 1
                    seen, line, ids, sizes, train = {}, [], [], [], []

    return docs.select("doc_id", "text", "train").mapInArrow(
        cut, f"chunk long, doc_id array<{kind}>, tokens binary, train binary, words binary, line binary"
    )


class Pairs(NamedTuple):
    """The distinct pairs of a chunk in order of bucket, and which one each token is."""

    context: np.ndarray  # place in the word list; its length stands for the start
    word: np.ndarray
    trained: np.ndarray
    ends: np.ndarray  # of each bucket
    of_token: np.ndarray


def chunk_pairs(words: np.ndarray, line: np.ndarray, tokens: np.ndarray, train: np.ndarray, buckets: int, heavy: np.ndarray) -> Pairs:
    word = line.astype(np.int64)
    context = np.empty_like(word)
    context[1:] = word[:-1]
    context[np.cumsum(tokens) - tokens] = len(words)
    distinct, of_token = np.unique(context * (len(words) + 1) + word, return_inverse=True)
    trained = np.bincount(of_token, np.repeat(train, tokens), len(distinct)).astype(np.int64)
    context, word = distinct // (len(words) + 1), distinct % (len(words) + 1)
    hashes = np.append(words, START)
    with np.errstate(over="ignore"):
        key = np.where(np.isin(hashes, heavy)[context], hashes[context] ^ (hashes[word] * STEP), hashes[context])
    bucket = (mixed(key) % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    back = np.empty_like(order)
    back[order] = np.arange(len(order))
    ends = np.searchsorted(bucket[order], np.arange(buckets), side="right")
    return Pairs(context[order], word[order], trained[order], ends, back[of_token])


def _read_chunk(row: dict, buckets: int, heavy: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, Pairs]:
    words, line = expand_sorted(row["words"]), expand(row["line"], np.int32)
    tokens, train = expand(row["tokens"], np.int64), expand(row["train"], np.int8)
    return words, tokens, train, chunk_pairs(words, line, tokens, train, buckets, heavy)


ASK = "bucket int, chunk long, contexts binary, runs binary, words binary, word binary, trained binary"


def ask_pairs(rows: DataFrame, buckets: int, heavy: np.ndarray) -> DataFrame:
    """For each chunk and bucket: contexts with the number of their pairs, the words, and training counts."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                words, _, _, pairs = _read_chunk(row, buckets, heavy)
                hashes, start, out = np.append(words, START), 0, []
                for bucket, end in enumerate(pairs.ends):
                    if end > start:
                        first = np.flatnonzero(np.diff(pairs.context[start:end], prepend=-1))
                        own, word = np.unique(pairs.word[start:end], return_inverse=True)
                        out.append(
                            {
                                "bucket": bucket,
                                "chunk": row["chunk"],
                                "contexts": squeeze(hashes[pairs.context[start:end][first]]),
                                "runs": squeeze(np.diff(first, append=end - start).astype(np.int32)),
                                "words": squeeze_sorted(words[own]),
                                "word": squeeze(word.astype(np.int32)),
                                "trained": squeeze(pairs.trained[start:end].astype(np.int32)),
                            }
                        )
                    start = end
                yield pa.RecordBatch.from_pylist(out, ASK_SCHEMA)

    return rows.mapInArrow(ask, ASK)


ASK_SCHEMA = pa.schema(
    [("bucket", pa.int32()), ("chunk", pa.int64()), *((name, pa.binary()) for name in ("contexts", "runs", "words", "word", "trained"))]
)
#: kind 0: answers to a chunk; kind 1: a bucket's words for a bucket of words; kind 2: customers and tables of the heavy context ``to``.
ANSWER_SCHEMA = pa.schema(
    [("kind", pa.int32()), ("to", pa.int64()), ("part", pa.int32()), *((name, pa.binary()) for name in "abcd")]
    + [("held", pa.int64()), ("taken", pa.int64())]
)
ANSWER = "kind int, to long, part int, a binary, b binary, c binary, d binary, held long, taken long"


def _row(kind: int, to: int, part: int, *data: bytes) -> dict:
    return {"kind": kind, "to": to, "part": part, **dict(zip("abcd", [*data, b"", b"", b"", b""], strict=False))}


#: kind 0: the pairs of a bucket as the last sweep left them; kind 1: its words for a bucket of words, with their
#: tables; kind 2: tables (``n``) of the heavy context ``to``; kind 3: which pairs (``word``) and contexts of the bucket the pairs of
#: chunk ``part`` are, 0 for those without training. Totals are over the sweeps that count.
CELLS_SCHEMA = pa.schema(
    [("kind", pa.int32()), ("to", pa.int64()), ("part", pa.int64()), ("n", pa.int64())]
    + [(name, pa.binary()) for name in ("contexts", "context", "words", "word", "customers", "tables", "total")]
)
CELLS = "kind int, to long, part long, n long, contexts binary, context binary, words binary, word binary, "
CELLS += "customers binary, tables binary, total binary"


def _parts(words: np.ndarray, word_bits: int) -> Iterator[tuple[int, int, int]]:
    """Buckets of words with the ranges of the sorted ``words`` in them."""
    part = (words >> np.uint64(64 - word_bits)).astype(np.int64) if word_bits else np.zeros(len(words), np.int64)
    ends = np.searchsorted(part, np.arange(1 << word_bits), side="right")
    return ((to, a, b) for to, (a, b) in enumerate(zip([0, *ends[:-1]], ends, strict=True)) if b > a)


class Cells(NamedTuple):
    """The distinct pairs of a bucket, added up over its chunks."""

    cell: np.ndarray  # of every pair of every chunk
    contexts: np.ndarray
    context: np.ndarray
    words: np.ndarray
    word: np.ndarray
    customers: np.ndarray


def _cells(rows: list[dict]) -> Cells:
    context = [np.repeat(expand(row["contexts"], np.uint64), expand(row["runs"], np.int32)) for row in rows]
    context = np.concatenate(context)
    word = np.concatenate([expand_sorted(row["words"])[expand(row["word"], np.int32)] for row in rows])
    trained = np.concatenate([expand(row["trained"], np.int32) for row in rows])
    with np.errstate(over="ignore"):
        _, first, cell = np.unique(mixed(context) * STEP + word, return_index=True, return_inverse=True)
    customers = np.bincount(cell, trained, len(first)).astype(np.int64)
    contexts, context_of = np.unique(context[first], return_inverse=True)
    words, word_of = np.unique(word[first], return_inverse=True)
    return Cells(cell, contexts, context_of, words, word_of, customers)


def _passed_on(row: dict, words: np.ndarray, word: np.ndarray, context: np.ndarray, tables: np.ndarray, word_bits: int) -> pa.Table:
    """A bucket's pairs, the tables of its words and those of its heavy contexts."""
    given = np.bincount(word, tables, len(words)).astype(np.int64)
    out = [row]
    for to, a, b in _parts(words, word_bits):
        out.append({"kind": 1, "to": to, "part": row["to"], "words": squeeze_sorted(words[a:b]), "tables": squeeze(given[a:b])})
    names = expand(row["contexts"], np.uint64)
    taken = np.bincount(context, tables, len(names)).astype(np.int64)
    for at in np.flatnonzero(names):
        out.append({"kind": 2, "to": int(names[at : at + 1].view(np.int64)[0]), "part": row["to"], "n": int(taken[at])})
    return pa.Table.from_pylist(out, CELLS_SCHEMA)


def first_cells(word_bits: int, heavy: np.ndarray) -> Callable[[pa.Table], pa.Table]:
    """The trained pairs of a bucket with a table each."""

    def add_up(group: pa.Table) -> pa.Table:
        rows = group.sort_by("chunk").to_pylist()
        found = _cells(rows)
        used = np.flatnonzero(found.customers)
        local, word = np.unique(found.word[used], return_inverse=True)
        own, context = np.unique(found.context[used], return_inverse=True)
        customers, words, contexts = found.customers[used], found.words[local], found.contexts[own]
        at_pair, at_context = np.zeros(len(found.customers), np.int32), np.zeros(len(found.contexts), np.int32)
        at_pair[used], at_context[own] = np.arange(1, len(used) + 1), np.arange(1, len(own) + 1)
        of_chunks, start = [], 0
        for asked in rows:
            runs = expand(asked["runs"], np.int32)
            part = found.cell[start : start + int(runs.sum())]
            start += len(part)
            firsts = found.context[part[np.cumsum(runs) - runs]]
            places = {"context": squeeze(at_context[firsts]), "word": squeeze(at_pair[part])}
            of_chunks.append({"kind": 3, "to": asked["bucket"], "part": asked["chunk"], **places})
        tables = np.ones(len(used), np.int64)
        row = {
            "kind": 0,
            "to": rows[0]["bucket"],
            "contexts": squeeze(np.where(np.isin(contexts, heavy), contexts, np.uint64(0))),
            "context": squeeze(context.astype(np.int32)),
            "words": squeeze_sorted(words),
            "word": squeeze(word.astype(np.int32)),
            "customers": squeeze(customers.astype(np.int32)),
            "tables": squeeze(tables.astype(np.int32)),
            "total": squeeze(np.zeros(len(used), np.int32)),
        }
        passed = _passed_on(row, words, word, context, tables, word_bits)
        return pa.concat_tables([passed, pa.Table.from_pylist(of_chunks, CELLS_SCHEMA)])

    return add_up


TOLD = "to long, part long, below binary, seated binary, v long, customers long, tables double"
TOLD_SCHEMA = pa.schema(
    [("to", pa.int64()), ("part", pa.int64()), ("below", pa.binary()), ("seated", pa.binary())]
    + [("v", pa.int64()), ("customers", pa.int64()), ("tables", pa.float64())]
)


def tell_tables(sweep: int, word_bits: int, known: Known | None, shape: Shape) -> Callable[[pa.Table], pa.Table]:
    """Of one bucket of words: to every bucket the customers and tables that its words have in the parent; ``to`` null: totals.

    ``known`` is the parent as the last sweep left it; before the first one every word is taken to have one table.
    """

    def tell(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        words, place = np.unique(np.concatenate([expand_sorted(row["words"]) for row in rows]), return_inverse=True)
        below = np.bincount(place, np.concatenate([expand(row["tables"], np.int64) for row in rows])).astype(np.int64)
        guess = len(words) << word_bits
        seated = seat_parent(below, known or Known(guess, 0, guess), shape, [SEED, 2, rows[0]["to"], sweep])
        out: list[dict] = [{"v": len(words), "customers": int(below.sum()), "tables": float(seated.sum())}]
        start = 0
        for row in rows:
            size = len(expand_sorted(row["words"]))
            own = place[start : start + size]
            out.append({"to": row["part"], "part": row["to"], "below": squeeze(below[own]), "seated": squeeze(seated[own])})
            start += size
        return pa.Table.from_pylist(out, TOLD_SCHEMA)

    return tell


def sweep_cells(
    sweep: int, word_bits: int, heavy: np.ndarray, taken: np.ndarray, known: Known, shape: Shape
) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """One sweep of a bucket with the parent of all buckets; ``taken``: tables of the heavy contexts in all buckets."""

    def seat(group: pa.Table, told: pa.Table) -> pa.Table:
        row = group.to_pylist()[0]
        parts = sorted(told.to_pylist(), key=lambda r: r["part"])
        below, seated = (
            np.concatenate([np.zeros(0, np.int64), *(expand(r[name], np.int64) for r in parts)]) for name in ("below", "seated")
        )
        names, context = expand(row["contexts"], np.uint64), expand(row["context"], np.int32)
        words, word = expand_sorted(row["words"]), expand(row["word"], np.int32)
        customers, tables = (expand(row[name], np.int32).astype(np.int64) for name in ("customers", "tables"))

        rest = shape.parent_strength + shape.parent_discount * known.tables
        chance = below - shape.parent_discount * seated + rest / (known.v + 1)
        chance /= shape.parent_strength + known.customers
        here = np.bincount(context, tables, len(names))
        shared = np.flatnonzero(names)
        here[shared] = taken[np.searchsorted(heavy, names[shared])]
        draw = np.random.default_rng([SEED, row["to"], sweep])
        others = here[context] - tables
        tables = draw_tables(customers, others, chance[word], shape.discount, shape.strength, draw, tables)

        total = expand(row["total"], np.int32)
        if sweep >= BURN:
            total = total + tables.astype(np.int32)
        row |= {"tables": squeeze(tables.astype(np.int32)), "total": squeeze(total)}
        return _passed_on(row, words, word, context, tables, word_bits)

    return seat


class Kinds(NamedTuple):
    """Rows of ``CELLS_SCHEMA`` stored by kind, so that each can be read and deleted alone."""

    spark: SparkSession
    path: str

    def rows(self, kind: int) -> DataFrame:
        found = self.spark.read.schema(f"kind int, {CELLS.partition(', ')[2]}").parquet(self.path)
        return found.where(F.col("kind") == kind)

    def drop(self, *kinds: int) -> None:
        discard(self.spark, *(f"{self.path}/kind={kind}" for kind in kinds))


def _by_kind(cells: DataFrame) -> Kinds:
    path = scratch_path(cells.sparkSession, "cells")
    cells.write.partitionBy("kind").parquet(path)
    return Kinds(cells.sparkSession, path)


def seat_contexts(asked: DataFrame, buckets: int, word_bits: int, heavy: np.ndarray, shape: Shape) -> tuple[Kinds, Kinds, Known]:
    """The pairs of every bucket before (kind 3 only) and after all sweeps (kind 0 only), and the parent's totals."""
    spark = asked.sparkSession
    first = cells = _by_kind(asked.groupBy("bucket").applyInArrow(first_cells(word_bits, heavy), CELLS))
    known = None
    for sweep in range(BURN + SAMPLES):
        told = cells.rows(1).repartition(1 << word_bits, "to").groupBy("to")
        told = store(told.applyInArrow(tell_tables(sweep, word_bits, known, shape), TOLD), "told-tables")
        sums = told.table.where("to is null").agg(*(F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in Known._fields))
        known = Known(*sums.first())
        # One row for each heavy context.
        found = dict(cells.rows(2).groupBy("to").agg(F.sum("n")).collect())
        taken = np.array([found.get(int(name), 0) for name in heavy.view(np.int64)], np.int64)
        cells.drop(1, 2)
        seat = sweep_cells(sweep, word_bits, heavy, taken, known, shape)
        own, ours = cells.rows(0), told.table.where("to is not null")
        own, ours = (side.repartition(buckets, "to").groupBy("to") for side in (own, ours))
        made = _by_kind(own.cogroup(ours).applyInArrow(seat, CELLS))
        discard(spark, told.path)
        cells.drop(0)
        cells = made
    cells.drop(1, 2)
    return first, cells, known


def answer_pairs(word_bits: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Of one bucket: answer every chunk and pass on the words; ``seated`` has the pairs after all sweeps."""

    def answer(group: pa.Table, seated: pa.Table) -> pa.Table:
        row = seated.to_pylist()[0]
        bucket, names, words = row["to"], expand(row["contexts"], np.uint64), expand_sorted(row["words"])
        context, word = (expand(row[name], np.int32) for name in ("context", "word"))
        customers, tables = (expand(row[name], np.int32).astype(np.int64) for name in ("customers", "total"))
        held = np.bincount(context, customers, len(names)).astype(np.int64)
        taken = np.bincount(context, tables, len(names)).astype(np.int64)

        # The first place is for what has no training.
        of_pair, of_context = ([np.append(0, values) for values in both] for both in ((customers, tables), (held, taken)))
        out = []
        for asked in group.to_pylist():
            pairs, contexts = expand(asked["word"], np.int32), expand(asked["context"], np.int32)
            data = [*(values[pairs] for values in of_pair), *(values[contexts] for values in of_context)]
            out.append(_row(0, asked["part"], bucket, *map(squeeze, data)))
        count = np.bincount(word, customers, len(words)).astype(np.int64)
        given = np.bincount(word, tables, len(words)).astype(np.int64)
        for to, a, b in _parts(words, word_bits):
            out.append(_row(1, to, bucket, squeeze_sorted(words[a:b]), squeeze(count[a:b]), squeeze(given[a:b])))
        for at in np.flatnonzero(names):
            name = int(names[at : at + 1].view(np.int64)[0])
            out.append(_row(2, name, bucket) | {"held": int(held[at]), "taken": int(taken[at])})
        return pa.Table.from_pylist(out, ANSWER_SCHEMA)

    return answer


STATE_SCHEMA = pa.schema(
    [("to", pa.int64()), ("words", pa.binary()), ("count", pa.binary()), ("mass", pa.binary())]
    + [(name, pa.int64()) for name in ("n", "v", "customers")]
    + [("tables", pa.float64())]
)
STATE = "to long, words binary, count binary, mass binary, n long, v long, customers long, tables double"


def word_state(known: Known, shape: Shape) -> Callable[[pa.Table], pa.Table]:
    """Of one bucket of words: training counts, the parent's customers less discounts, and their totals."""

    def add_up(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        words, place = np.unique(np.concatenate([expand_sorted(row["a"]) for row in rows]), return_inverse=True)
        count = np.bincount(place, np.concatenate([expand(row["b"], np.int64) for row in rows])).astype(np.int64)
        given = np.bincount(place, np.concatenate([expand(row["c"], np.int64) for row in rows]))
        customers = np.maximum(1, np.rint(given / SAMPLES)).astype(np.int64)
        seeds = ([SEED, 1, rows[0]["to"], sample] for sample in range(SAMPLES))
        tables = np.mean([seat_parent(customers, known, shape, seed) for seed in seeds], axis=0)
        mass = (customers - shape.parent_discount * tables).astype(np.float32)
        made = {
            "to": rows[0]["to"],
            "words": squeeze_sorted(words),
            "count": squeeze(count),
            "mass": squeeze(mass),
            "n": int(count.sum()),
            "v": len(words),
            "customers": int(customers.sum()),
            "tables": float(tables.sum()),
        }
        return pa.Table.from_pylist([made], STATE_SCHEMA)

    return add_up


def ask_words(rows: DataFrame, word_bits: int) -> DataFrame:
    """The words of each chunk by bucket of words: to, chunk, words."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("to", pa.int64()), ("chunk", pa.int64()), ("words", pa.binary())])
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                words = expand_sorted(row["words"])
                part = (words >> np.uint64(64 - word_bits)).astype(np.int64) if word_bits else np.zeros(len(words), np.int64)
                ends = np.searchsorted(part, np.arange(1 << word_bits), side="right")
                for to, (a, b) in enumerate(zip([0, *ends[:-1]], ends, strict=True)):
                    if b > a:
                        out.append({"to": to, "chunk": row["chunk"], "words": squeeze_sorted(words[a:b])})
            yield pa.RecordBatch.from_pylist(out, schema)

    return rows.select("chunk", "words").mapInArrow(ask, "to long, chunk long, words binary")


def answer_words(asked: pa.Table, state: pa.Table) -> pa.Table:
    """To every chunk the counts and masses of its words in this bucket; 0 for words not seen in training."""
    out, own = [], state.to_pylist()
    known = expand_sorted(own[0]["words"]) if own else np.zeros(0, np.uint64)
    count = np.append(expand(own[0]["count"], np.int64) if own else [], 0).astype(np.int64)
    mass = np.append(expand(own[0]["mass"], np.float32) if own else [], 0).astype(np.float32)
    for row in asked.to_pylist():
        words = expand_sorted(row["words"])
        at = np.searchsorted(known, words)
        if len(known):
            at = np.where(known[np.minimum(at, len(known) - 1)] == words, at, len(known))
        out.append(_row(3, row["chunk"], row["to"], squeeze(count[at]), squeeze(mass[at])))
    return pa.Table.from_pylist(out, ANSWER_SCHEMA)


class Totals(NamedTuple):
    n: int
    v: int
    customers: int
    tables: float


def score_chunk(
    buckets: int, heavy: np.ndarray, held: np.ndarray, taken: np.ndarray, totals: Totals, shape: Shape, schema: pa.Schema
) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Of one chunk: put the answers together and sum by document. ``held``, ``taken``: of the heavy contexts."""

    def score(group: pa.Table, answers: pa.Table) -> pa.Table:
        row = group.to_pylist()[0]
        words, tokens, train, pairs = _read_chunk(row, buckets, heavy)
        found = sorted(answers.to_pylist(), key=lambda r: (r["kind"], r["part"]))
        for_words = [r for r in found if r["kind"] == 3]
        count = np.concatenate([expand(r["a"], np.int64) for r in for_words])
        mass = np.concatenate([expand(r["b"], np.float32) for r in for_words]).astype(float)
        rest = (shape.parent_strength + shape.parent_discount * totals.tables) / (totals.v + 1)
        parent = (mass + rest) / (shape.parent_strength + totals.customers)

        ours = [r for r in found if r["kind"] == 0]
        customers, tables, of_context, of_tables = (
            np.concatenate([expand(r[name], np.int64) for r in ours]) for name in "abcd"
        )
        tables = tables / SAMPLES
        start = np.diff(pairs.context, prepend=-1) != 0  # a context begins, also where a bucket does
        start[pairs.ends[:-1][pairs.ends[:-1] < len(start)]] = True
        nth = np.cumsum(start) - 1
        total, all_tables = of_context[nth].astype(float), of_tables[nth] / SAMPLES
        hashes = np.append(words, START)
        if len(heavy):
            at = np.minimum(np.searchsorted(heavy, hashes), len(heavy) - 1)
            is_heavy = heavy[at] == hashes
            wide = is_heavy[pairs.context]
            total[wide] = held[at[pairs.context[wide]]]
            all_tables[wide] = taken[at[pairs.context[wide]]] / SAMPLES
        below = shape.strength + shape.discount * all_tables
        chance = (customers - shape.discount * tables + below * parent[pairs.word]) / (shape.strength + total)

        word = pairs.word[pairs.of_token]
        starts = np.cumsum(tokens) - tokens
        base = np.log10(count + 1.0) - np.log10(totals.n + totals.v + 1.0)
        made = {
            "doc_id": group.column("doc_id").combine_chunks().flatten(),
            "held_out": train == 0,
            "n_tokens": tokens,
            "n_known": np.add.reduceat((count > 0)[word].astype(np.int64), starts),
            "train_tokens": np.full(len(tokens), totals.n, np.int64),
            "base_score": np.add.reduceat(base[word], starts),
            "score": np.add.reduceat(np.log10(chance)[pairs.of_token], starts),
        }
        return pa.Table.from_pydict(made, schema)

    return score


def score_documents(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", train: str = "train", shape: Shape | None = None
) -> DataFrame:
    """Learn from rows with ``train``, score all: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    shape = shape or Shape()
    spark = docs.sparkSession
    before = spark.conf.get(CLEANUP)
    # Each step ends in a stored table; its shuffle files aren't needed any more.
    spark.conf.set(CLEANUP, "true")
    try:
        return _score(docs.select(*(F.col(f"`{c}`").alias(n) for c, n in ((doc_id, "doc_id"), (text, "text"), (train, "train")))), shape)
    finally:
        spark.conf.set(CLEANUP, before)


def _score(docs: DataFrame, shape: Shape) -> DataFrame:
    made = store(chunks(docs), "chunks")
    rows, count = made.table, max(1, made.rows)
    counted = store(_heavy_words(rows), "heavy-words").table
    tokens = counted.where("word is null").agg(F.sum("n")).first()[0] or 0
    buckets = max(1, -(-tokens // BUCKET_TOKENS))
    word_bits = max(0, (buckets - 1).bit_length() - 1)
    share = max(HEAVY, 1 / (8 * buckets)) * tokens
    often = counted.where(F.col("word").isNotNull() & (F.col("n") > share) & F.lit(buckets > 1)).select("word")
    heavy = [row["word"] for row in often.collect()]  # at most 1 / HEAVY words
    heavy = np.unique(np.append(np.array(heavy, np.int64).view(np.uint64), START)) if buckets > 1 else np.zeros(0, np.uint64)

    asked = ask_pairs(rows, buckets, heavy).repartition(buckets, "bucket")
    first, last, known = seat_contexts(asked, buckets, word_bits, heavy, shape)
    told, seated = (side.repartition(buckets, "to").groupBy("to") for side in (first.rows(3), last.rows(0)))
    answers = store(told.cogroup(seated).applyInArrow(answer_pairs(word_bits), ANSWER), "answers").table
    first.drop(3)
    last.drop(0)
    # One row for each heavy context.
    sums = answers.where("kind = 2").groupBy("to").agg(F.sum("held").alias("held"), F.sum("taken").alias("taken")).collect()
    found = {row["to"]: (row["held"], row["taken"]) for row in sums}
    held, taken = (np.array([found.get(int(name), (0, 0))[k] for name in heavy.view(np.int64)], np.int64) for k in (0, 1))

    state = answers.where("kind = 1").repartition(1 << word_bits, "to").groupBy("to").applyInArrow(word_state(known, shape), STATE)
    state = store(state, "word-state").table
    sums = state.agg(*(F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in Totals._fields)).first()
    totals = Totals(*(sums[name] for name in Totals._fields))
    asked = ask_words(rows, word_bits).repartition(1 << word_bits, "to")
    ours = state.repartition(1 << word_bits, "to").groupBy("to")
    told = store(asked.groupBy("to").cogroup(ours).applyInArrow(answer_words, ANSWER), "word-answers").table

    kind = docs.schema["doc_id"].dataType.simpleString()
    out = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    arrow = pa.schema(
        [("doc_id", _arrow_type(rows)), ("held_out", pa.bool_())]
        + [(name, pa.int64()) for name in ("n_tokens", "n_known", "train_tokens")]
        + [("base_score", pa.float64()), ("score", pa.float64())]
    )
    everything = answers.where("kind = 0").union(told)
    scorer = score_chunk(buckets, heavy, held, taken, totals, shape, arrow)
    own, ours = rows, everything.withColumnRenamed("to", "chunk")
    own, ours = (side.repartition(count, "chunk").groupBy("chunk") for side in (own, ours))
    scored = own.cogroup(ours).applyInArrow(scorer, out)
    return store(scored, "scores").table


def _arrow_type(rows: DataFrame) -> pa.DataType:
    return rows.select("doc_id").limit(0).toArrow().schema.field("doc_id").type.value_type
