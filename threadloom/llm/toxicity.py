"""Toxicity scores from a small convolutional text classifier, trained here in numpy.

Words (A-Z lowered, outer ASCII punctuation off) and their first ``STEM`` bytes are hashed to ``BUCKETS``
numbers; those that at least ``LEAST_TEXTS`` training texts hold have an embedding, all others the
zero vector, so a word seen once can't be learnt by heart. A word's vector is the sum of the two. Filters of widths 1, 2 and 3 slide over the whole text, each keeps its largest
response, and a logistic unit weighs them. Only the places of those largest responses get a gradient,
so a step touches few rows of the table.

Training reads every labelled row, in shards of about ``SHARD_ROWS`` rows. In each round every shard is learnt by itself from
the parameters of the round before, in minibatches, and each parameter then moves by the mean of its changes over the shards that
changed it, weighted by their rows; one shard alone comes first, so that all others start from filters that mean something. Means
are taken over whole numbers, so their order doesn't matter and reruns agree. Words are counted over all labelled rows; only those that
training has moved keep an embedding. Texts are hashed once, and what is learnt is read as bucket numbers. For each
language a threshold is set where F1 over all its labelled rows is best (scores to four decimals); a language with few
toxic rows keeps the common one. The thresholds only mark documents: neither language, source, id nor label enter a score.

Scoring looks each word's filter responses up in one table (words x filters), whatever the length of the
text. Null and empty texts have no responses and score by the offset alone, as do texts without words. Repeated
rows score alike. Without labelled rows of both classes every score is the share of toxic rows
(0 where there are none). An empty table gives an empty result.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom.llm.words import raw_texts
from threadloom.plans.materialize import discard, store

BUCKETS = 1 << 18
LEAST_TEXTS = 3
STEM = 6
SIZE = 16
WIDTHS = (1, 2, 3)
FILTERS = 8
EDGE = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
KEPT_WORDS = 300_000
TOKENS_AT_ONCE = 200_000
#: Rows of a shard, and words of its texts that are held at once.
SHARD_ROWS = 16_000
WORDS_AT_ONCE = 3_000_000
#: A row of a shard counts that many times where parameters are averaged in whole numbers; more would only make them longer.
UNIT = 1 << 12


class Network(NamedTuple):
    buckets: np.ndarray  # ascending; the word hashes that have an embedding
    embedding: np.ndarray  # buckets x size, and a row of zeros for other words and beyond the end of a text
    filters: list[np.ndarray]  # for each width: width x size x filters
    offsets: np.ndarray  # a number for each filter
    weights: np.ndarray
    offset: float


class Classifier(NamedTuple):
    network: Network | None
    share: float
    threshold: float
    by_language: dict[str, float]


def buckets_of(word: bytes) -> tuple[int, int]:
    """Of the word and of its stem."""
    bare = word.strip(EDGE) or word
    return zlib.crc32(bare) % BUCKETS, zlib.crc32(b"stem " + bare[:STEM]) % BUCKETS


class WordBuckets(dict):
    """The two buckets of a word as one number; words are remembered up to a bounded number."""

    def __missing__(self, word: bytes) -> int:
        whole, stem = buckets_of(word)
        self[word] = found = whole << 32 | stem
        return found

    def of(self, text: bytes) -> np.ndarray:
        """Words x 2."""
        if len(self) > KEPT_WORDS:
            self.clear()
        words = text.lower().split()
        return np.fromiter(map(self.__getitem__, words), "<i8", len(words)).view("<i4").reshape(-1, 2)


class WordRows:
    """A number for each pair of rows of the embedding that a word has; 0 for a word that has none.

    Words are remembered up to a bounded number; ``pairs`` holds at most as many as there are
    pairs of rows among the words seen.
    """

    def __init__(self, net: Network) -> None:
        self.rows, nothing = {int(b): k for k, b in enumerate(net.buckets)}, len(net.buckets)
        self.nothing, self.numbers, self.seen = nothing, {(nothing, nothing): 0}, {}

    def __call__(self, text: bytes) -> np.ndarray:
        seen = self.seen
        words = text.lower().split()
        found = [seen.get(word) for word in words]
        for k, number in enumerate(found):
            if number is None:
                pair = tuple(self.rows.get(b, self.nothing) for b in buckets_of(words[k]))
                found[k] = seen[words[k]] = self.numbers.setdefault(pair, len(self.numbers))
        return np.array(found, np.int64)

    def pairs(self) -> np.ndarray:
        return np.array([*self.numbers], np.int64)


def fresh(buckets: np.ndarray, seed: int) -> Network:
    """Random weights, and embeddings for ``buckets``."""
    draw = np.random.default_rng(seed)
    embedding = draw.normal(0, 0.03, (len(buckets) + 1, SIZE)).astype(np.float32)
    embedding[-1] = 0
    filters = [draw.normal(0, (w * SIZE) ** -0.5, (w, SIZE, FILTERS)).astype(np.float32) for w in WIDTHS]
    count = len(WIDTHS) * FILTERS
    weights = draw.normal(0, 0.3, count).astype(np.float32)
    return Network(buckets, embedding, filters, np.zeros(count, np.float32), weights, 0.0)


def texts_holding(docs: list[np.ndarray]) -> np.ndarray:
    """For each bucket, the number of texts that hold it; texts as words x 2 buckets."""
    times = np.zeros(BUCKETS, np.int64)
    for doc in docs:
        times[np.unique(doc)] += 1
    return times


def start(texts: list[bytes], seed: int) -> Network:
    """Random weights, and embeddings for the words of at least ``LEAST_TEXTS`` texts."""
    words = WordBuckets()
    return fresh(np.flatnonzero(texts_holding([words.of(text) for text in texts]) >= LEAST_TEXTS), seed)


def _padded(docs: list[np.ndarray], gap: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all texts in a row, each followed by empty places; where each text begins.

    A filter may start at the first of these empty places but not at a later one: from there it would reach the next text.
    """
    gap = np.zeros(max(WIDTHS), np.int64) if gap is None else gap
    starts = np.cumsum([0, *(len(doc) + len(gap) for doc in docs[:-1])])
    return np.concatenate([part for doc in docs for part in (doc, gap)]), starts


def responses(tables: list[np.ndarray], line: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Texts x filters: the largest response of each filter. ``tables``: for each width and place, number x filter."""
    out, k = [], 0
    ends = np.append(starts[1:], len(line))
    beyond = np.concatenate([ends - back for back in range(1, max(WIDTHS))])
    for width in WIDTHS:
        total = tables[k][line]
        for step in range(1, width):
            total[:-step] += tables[k + step][line[step:]]
        k += width
        total[beyond] = -np.inf
        out.append(np.maximum.reduceat(total, starts, axis=0))
    return np.concatenate(out, axis=1)


def lookup_tables(net: Network, pairs: np.ndarray) -> list[np.ndarray]:
    vectors = net.embedding[pairs].sum(1)
    return [vectors @ kernel[step] for kernel in net.filters for step in range(len(kernel))]


def pooled_scores(net: Network, tables: list[np.ndarray], docs: list[np.ndarray]) -> np.ndarray:
    return _scores(net, responses(tables, *_padded(docs)), docs) if docs else np.zeros(0)


def _scores(net: Network, found: np.ndarray, docs: list[np.ndarray]) -> np.ndarray:
    pooled = np.maximum(found + net.offsets, 0)
    pooled[np.array([len(doc) == 0 for doc in docs])] = 0
    return 1 / (1 + np.exp(-np.clip(pooled.astype(np.float64) @ net.weights + net.offset, -30, 30)))


class Learner:
    """A network in training. Adagrad on minibatches; a text passes its gradient to the places of its largest responses.

    ``params`` are all numbers that are learnt, ``seen`` the squared gradients that each has met, ``touched`` the embeddings that
    have moved. Texts are words x 2 buckets.
    """

    def __init__(self, net: Network):
        self.net = net
        self.params = [net.embedding.copy(), *[k.copy() for k in net.filters], net.offsets.copy(), net.weights.copy()]
        self.params.append(np.array([net.offset], np.float32))
        self.seen = [np.full_like(p, 1e-3) for p in self.params]
        self.touched = np.zeros(len(net.embedding), bool)
        self.rows = 0
        self.row_of = np.full(BUCKETS, len(net.buckets), np.int32)
        self.row_of[net.buckets] = np.arange(len(net.buckets), dtype=np.int32)

    def state(self) -> tuple:
        """What has been learnt, as ``put`` takes it."""
        ids = np.flatnonzero(self.touched)
        return ids, [(held[0][ids], held[1:]) for held in (self.params, self.seen)]

    def put(self, state: tuple) -> Learner:
        ids, parts = state
        for held, (embedding, others) in zip((self.params, self.seen), parts, strict=True):
            held[0][ids] = embedding
            held[1:] = [part.copy() for part in others]
        return self

    def network(self) -> Network:
        """The network; words that have not moved stand for nothing."""
        embedding, *filters, offsets, weights, offset = self.params
        kept = np.flatnonzero(self.touched)
        return Network(self.net.buckets[kept], embedding[[*kept, -1]], filters, offsets, weights, float(offset[0]))

    def _rows_of(self, docs: list[np.ndarray]) -> list[np.ndarray]:
        return [self.row_of[doc] for doc in docs]

    def _line(self, docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        return _padded(docs, np.full((max(WIDTHS), 2), len(self.net.buckets), np.int32))

    def learn(self, docs: list[np.ndarray], toxic: np.ndarray, draw: np.random.Generator, epochs: int = 1, rate: float = 0.05) -> None:
        docs = self._rows_of(docs)
        self.rows += len(docs)
        for _ in range(epochs):
            order = draw.permutation(len(docs))
            for batch in np.array_split(order, max(1, len(order) // 32)):
                self._step([docs[k] for k in batch], toxic[batch], rate)

    def scores(self, docs: list[np.ndarray]) -> np.ndarray:
        """The scores by the network as it was given."""
        net = self.net
        line, starts = self._line(self._rows_of(docs))
        vectors = net.embedding[line].sum(1)
        tables = [vectors @ kernel[step] for kernel in net.filters for step in range(len(kernel))]
        return _scores(net, responses(tables, np.arange(len(line)), starts), docs)

    def _step(self, docs: list[np.ndarray], toxic: np.ndarray, rate: float) -> None:
        embedding, *filters, offsets, weights, offset = self.params
        nothing = len(embedding) - 1
        line, starts = self._line(docs)
        ends = np.append(starts[1:], len(line)) - (max(WIDTHS) - 1)
        vectors = embedding[line[:, 0]] + embedding[line[:, 1]]
        pooled, places = [], []
        for width, kernel in zip(WIDTHS, filters, strict=True):
            total = vectors @ kernel[0]
            for step in range(1, width):
                total[:-step] += vectors[step:] @ kernel[step]
            best = np.array([a + total[a:b].argmax(0) for a, b in zip(starts, ends, strict=True)])
            places.append(best)
            pooled.append(np.take_along_axis(total, best, 0))
        raw = np.concatenate(pooled, axis=1) + offsets
        hidden = np.maximum(raw, 0)
        score = 1 / (1 + np.exp(-np.clip(hidden @ weights + offset, -30, 30)))
        error = ((score - toxic) / len(docs)).astype(np.float32)
        back = np.outer(error, weights) * (raw > 0)
        grads = [np.zeros(0)] * len(self.params)
        rows, changes = [], []
        for k, (width, kernel) in enumerate(zip(WIDTHS, filters, strict=True)):
            part = back[:, k * FILTERS : (k + 1) * FILTERS]
            grads[1 + k] = np.zeros_like(kernel)
            for step in range(width):
                at = np.minimum(places[k] + step, len(line) - 1)  # texts x filters
                grads[1 + k][step] = np.einsum("tfs,tf->sf", vectors[at], part)
                change = (part[:, :, None] * kernel[step].T[None]).reshape(-1, SIZE)
                for column in (0, 1):
                    rows.append(line[at, column].ravel())
                    changes.append(change)
        grads[-3], grads[-2], grads[-1] = back.sum(0), hidden.T @ error, error.sum(keepdims=True)
        touched, inverse = np.unique(np.concatenate(rows), return_inverse=True)
        change = np.zeros((len(touched), SIZE), np.float32)
        np.add.at(change, inverse, np.concatenate(changes))
        change[touched == nothing] = 0
        self.touched[touched[touched != nothing]] = True
        self.seen[0][touched] += change**2
        embedding[touched] -= rate * change / np.sqrt(self.seen[0][touched])
        for k in range(1, len(self.params)):
            self.seen[k] += grads[k] ** 2
            self.params[k] -= rate * grads[k] / np.sqrt(self.seen[k])

    def lines(self, ids: np.ndarray) -> np.ndarray:
        """Parameters and squared gradients by lines of ``SIZE``: an embedding by its row, all others below zero."""
        return np.concatenate([np.concatenate([held[0][ids], _lines(held[1:])]) for held in (self.params, self.seen)], axis=1)

    def changes(self, before: Learner) -> pa.RecordBatch:
        """What this shard has changed, weighted by its rows: ``(id, n, c0...)``."""
        ids = np.flatnonzero(self.touched)
        moved = np.rint((self.lines(ids).astype(np.float64) - before.lines(ids)) * (self.rows * UNIT)).astype(np.int64)
        all_ids = np.concatenate([ids, -1 - np.arange(len(moved) - len(ids))])
        columns = [all_ids, np.full(len(moved), self.rows), *moved.T]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], CHANGED)

    def move(self, means: pa.Table) -> None:
        """Add the mean changes of the shards."""
        ids = means.column("id").to_numpy()
        total = np.stack([means.column(name).to_numpy() for name in CHANGED[2:]], axis=1)
        mean = total / (means.column("n").to_numpy()[:, None] * float(UNIT))
        for held, change in ((self.params, mean[:, :SIZE]), (self.seen, mean[:, SIZE:])):
            words = ids >= 0
            self.touched[ids[words]] = True
            held[0][ids[words]] += change[words].astype(np.float32)
            dense = _lines(held[1:])
            dense[-1 - ids[~words]] += change[~words].astype(np.float32)
            flat, at = dense.ravel(), 0
            for part in held[1:]:
                part[...] = flat[at : at + part.size].reshape(part.shape)
                at += part.size


def _lines(parts: list[np.ndarray]) -> np.ndarray:
    flat = np.concatenate([part.ravel() for part in parts])
    return np.append(flat, np.zeros(-len(flat) % SIZE, np.float32)).reshape(-1, SIZE)


#: The columns of a shard's changes: an id, its rows, and the changes of a line's parameters and squared gradients.
CHANGED = ["id", "n", *[f"c{k}" for k in range(2 * SIZE)]]


def train(texts: list[bytes], toxic: np.ndarray, seed: int = 3, epochs: int = 6, rate: float = 0.05) -> Network:
    """The network of texts that one process holds."""
    words = WordBuckets()
    learner = Learner(start(texts, seed))
    learner.learn([words.of(text) for text in texts], toxic, np.random.default_rng(seed + 1), epochs, rate)
    return learner.network()


def _docs(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(held, "<i4").reshape(-1, 2) for held in column.to_pylist()]


def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The text, which is the last column, as the buckets of its words."""
    known = WordBuckets()
    for batch in batches:
        words = pa.array((known.of(text).tobytes() for text in raw_texts(batch.column(batch.num_columns - 1))), pa.binary())
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], words], [*batch.schema.names[:-1], "words"])


def texts_with_bucket(rows: DataFrame) -> DataFrame:
    """``(bucket, n)``: in how many of the texts ``(words)`` a bucket occurs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        times = sum((texts_holding(_docs(batch.column(0))) for batch in batches), np.zeros(BUCKETS, np.int64))
        found = np.flatnonzero(times)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(times[found])], ["bucket", "n"])

    counted = rows.select("words").mapInArrow(count, "bucket bigint, n bigint")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def round_of(rows: DataFrame, learner: Learner, seed: int, epochs: int = 1) -> None:
    """One round over the shards of ``rows(shard, toxic, words)``; a shard's rows lie next to each other."""
    sent = rows.sparkSession.sparkContext.broadcast((learner.net, learner.state()))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, state = sent.value
        before = Learner(net).put(state)
        own, shard, draw, held, size = None, None, None, [], 0

        def learn_held() -> None:
            nonlocal held, size
            if held:
                docs, toxic = zip(*held, strict=True)
                own.learn([*docs], np.array(toxic, np.float32), draw, epochs)
            held, size = [], 0

        for batch in batches:
            for number, toxic, doc in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), _docs(batch.column(2)), strict=True):
                if number != shard or size > WORDS_AT_ONCE:
                    learn_held()
                if number != shard:
                    if own:
                        yield own.changes(before)
                    own, shard, draw = Learner(net).put(state), number, np.random.default_rng([seed, number])
                held.append((doc, toxic))
                size += len(doc)
        learn_held()
        if own:
            yield own.changes(before)

    schema = ", ".join(f"{name} bigint" for name in CHANGED)
    changed = rows.select("shard", "toxic", "words").mapInArrow(learn, schema)
    # At most a line for each bucket.
    learner.move(changed.groupBy("id").agg(*[F.sum(name).alias(name) for name in CHANGED[1:]]).toArrow())
    sent.destroy()


def scored_words(rows: DataFrame, net: Network) -> DataFrame:
    """``(lang, toxic, score)`` of ``rows(lang, toxic, words)``, the score to four decimals."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Learner(net)
        for batch in batches:
            docs = _docs(batch.column(2))
            found = [np.round(own.scores(docs[at : at + 100]), 4) for at in range(0, len(docs), 100)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(np.concatenate(found or [np.zeros(0)]))], ["lang", "toxic", "score"])

    return rows.select("lang", "toxic", "words").mapInArrow(score, "lang string, toxic int, score double")


def best_threshold(score: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> float:
    """Where F1 is best, in the middle of the gap to the next lower score."""
    order = np.argsort(-score, kind="stable")
    right, all_ = np.cumsum((toxic * weight)[order]), np.cumsum(weight[order])
    f1 = 2 * right / (all_ + (toxic * weight).sum())
    last = np.append(score[order][1:] != score[order][:-1], True)  # ties stand or fall together
    k = int(np.argmax(np.where(last, f1, -1)))
    return float((score[order][k] + (score[order][k + 1] if k + 1 < len(score) else 0.0)) / 2)


def fit(labelled: DataFrame, seed: int = 3, first: int = 2, rounds: int = 4, least: int = 20, shard_rows: int = SHARD_ROWS) -> Classifier:
    """Fit on all rows of ``doc_id``, ``text``, ``lang``, ``toxic`` (0 or 1; others are left out).

    One shard is learnt ``first`` times before the ``rounds`` over all shards.
    """
    named = labelled.where("toxic in (0, 1)").select("doc_id", "lang", F.col("toxic").cast("int").alias("toxic"), "text")
    shares = {row["toxic"]: row["count"] for row in named.groupBy("toxic").count().collect()}
    share = shares.get(1, 0) / max(1, sum(shares.values()))
    if len(shares) < 2:
        return Classifier(None, share, 0.5, {})
    key = F.xxhash64("doc_id", "text").alias("key")
    dealt = named.select(key, "toxic", "lang", "text").repartition(math.ceil(sum(shares.values()) / shard_rows), "key")
    dealt = dealt.sortWithinPartitions("key", "toxic", "lang").select(F.spark_partition_id().alias("shard"), "toxic", "lang", "text")
    kept = dealt.mapInArrow(hashed, "shard int, toxic int, lang string, words binary")
    stored = store(kept, "toxicity-rows", F.min("shard").alias("first"), compression="zstd")
    rows = stored.table
    buckets = texts_with_bucket(rows).where(F.col("n") >= LEAST_TEXTS).select("bucket").toArrow()
    learner = Learner(fresh(np.sort(buckets.column(0).to_numpy()), seed))
    round_of(rows.where(F.col("shard") == stored.seen["first"]), learner, seed, first)
    for number in range(rounds):
        round_of(rows, learner, seed + 1 + number)
    net = learner.network()
    counted = scored_words(rows, net).groupBy("lang", "toxic", "score").agg(F.count(F.lit(1)).alias("n"))
    counted = store(counted, "toxicity-scores").table

    def best(of: DataFrame) -> float:
        # At most 10,001 scores of each class.
        found = of.groupBy("toxic", "score").agg(F.sum("n").alias("n")).orderBy("score", "toxic").toArrow()
        return best_threshold(*(found.column(name).to_numpy() for name in ("score", "toxic", "n")))

    known = counted.where("lang is not null").groupBy("lang").agg(F.sum(F.expr("if(toxic = 1, n, 0)")).alias("bad"), F.sum("n").alias("all"))
    langs = [row["lang"] for row in known.where((F.col("bad") >= least) & (F.col("all") - F.col("bad") >= least)).collect()]
    by_language = {lang: best(counted.where(F.col("lang") == lang)) for lang in sorted(langs)}
    discard(labelled.sparkSession, stored.path)
    return Classifier(net, share, best(counted), by_language)


def scorer(model: Classifier) -> Callable[[Column], Column]:
    """A column function from text to the score."""

    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        net = model.network
        words = WordRows(net) if net else None
        tables: list[np.ndarray] = []
        for batch in batches:
            texts, out, at = raw_texts(batch), [np.zeros(0)], 0
            if not net:
                yield pa.array(np.full(len(texts), model.share))
                continue
            while at < len(texts):
                if len(words.seen) > KEPT_WORDS:
                    words, tables = WordRows(net), []
                docs, held = [], 0
                while at < len(texts) and held < TOKENS_AT_ONCE:
                    docs.append(words(texts[at]))
                    held += len(docs[-1])
                    at += 1
                known = len(tables[0]) if tables else 0
                new = lookup_tables(net, words.pairs()[known:]) if known < len(words.numbers) else []
                tables = [np.concatenate(both) for both in zip(tables, new, strict=True)] if known and new else new or tables
                out.append(pooled_scores(net, tables, docs))
            yield pa.array(np.concatenate(out))

    return F.arrow_udf(score, T.DoubleType())


def threshold(model: Classifier, lang: Column) -> Column:
    """The threshold of a row's language."""
    found = F.lit(model.threshold)
    for name, value in model.by_language.items():
        found = F.when(lang == name, F.lit(value)).otherwise(found)
    return found
