"""Quality scores from weak labels: heuristic labellers, their estimated accuracies, a hashed linear scorer.

1. Each of ``LABELLERS`` looks at one property of a text and votes good (1), bad (2) or nothing (0).
2. All documents are counted by their pattern of votes: at most 3 to the number of labellers
   patterns come to the driver, whatever the corpus. Expectation-maximisation over them, started
   from the majority, estimates for both classes how often each labeller votes how, and the share of
   good texts. A pattern's posterior is the weak label of its texts.
3. A logistic regression on hashed features learns the posteriors from the bounded sample of the
   ``sample`` documents with the smallest hash of their id: the shapes of the words, the words that
   recur and those that repeat their neighbour, lines that recur. It also scores texts on which the labellers keep silent.

Null and empty texts and those without words get no votes, the prior as weak label, and the
scorer's offset. Very long texts are read whole. Repeated rows score alike. An empty table gives an empty result.
"""

from __future__ import annotations

import operator
import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom.llm.words import raw_texts, smallest_by_hash
from threadloom.plans.materialize import store

GOOD, BAD = 1, 2
BUCKETS = 1 << 16
KEPT_WORDS = 500_000
SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)
SHAPE = bytes(
    ord("A") if 65 <= b <= 90 else ord("a") if 97 <= b <= 122 or b >= 128 else ord("9") if 48 <= b <= 57 else b
    for b in range(256)
)


class Facts(NamedTuple):
    """Shares of a text, by word or letter or line. ``letters`` counts digits too, so that a number is no fault."""

    symbols: float
    marks: float
    upper: float
    letters: float
    distinct: float
    neighbours: float
    lines: float
    words: int


def facts(text: bytes, words: list[bytes]) -> Facts:
    count = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    upper, high = int(count[65:91].sum()), int(count[192:].sum())
    letters = upper + int(count[97:123].sum()) + high
    chars = max(1, len(text) - int(count[128:192].sum()))
    lines = [line for line in text.split(b"\n") if line.strip()]
    n = max(1, len(words))
    return Facts(
        int(count[SYMBOLS].sum()) / n,
        int(count[33] + count[63]) / n,
        upper / max(1, letters),
        (letters + int(count[48:58].sum())) / chars,
        len(set(words)) / n,
        sum(map(operator.eq, words, words[1:])) / n,
        1 - len(set(lines)) / max(1, len(lines)),
        len(words),
    )


def _vote(value: float, good: bool, bad: bool) -> int:
    return BAD if bad else GOOD if good else 0


#: Name and vote of each labeller.
LABELLERS: dict[str, Callable[[Facts], int]] = {
    "symbols": lambda f: _vote(f.symbols, f.symbols < 0.01, f.symbols > 0.1),
    "marks": lambda f: _vote(f.marks, f.marks < 0.05, f.marks > 0.4),
    "upper": lambda f: _vote(f.upper, 0.002 < f.upper < 0.08, f.upper > 0.4),
    "letters": lambda f: _vote(f.letters, f.letters > 0.75, f.letters < 0.65),
    "distinct": lambda f: _vote(f.distinct, f.distinct > 0.55, f.distinct < 0.25 and f.words >= 20),
    "neighbours": lambda f: _vote(f.neighbours, f.neighbours < 0.03, f.neighbours > 0.2),
    "lines": lambda f: _vote(f.lines, False, f.lines > 0.3),
}


def votes_of(text: bytes, words: list[bytes]) -> int:
    """The votes as digits of base 3; none for a text without words."""
    if not words:
        return 0
    found, pattern = facts(text, words), 0
    for labeller in LABELLERS.values():
        pattern = 3 * pattern + labeller(found)
    return pattern


def digits(patterns: np.ndarray) -> np.ndarray:
    """Patterns x labellers."""
    powers = 3 ** np.arange(len(LABELLERS) - 1, -1, -1)
    return patterns[:, None] // powers % 3


class Labels(NamedTuple):
    prior: float
    odds: np.ndarray  # class (good, bad) x labeller x vote
    posterior: dict[int, float]  # of being good, for each pattern


def estimate(counts: dict[int, int], rounds: int = 60, smooth: float = 1.0) -> Labels:
    """Expectation-maximisation over the counts of the patterns."""
    patterns = np.array(sorted(counts), np.int64)
    times, votes = np.array([counts[int(p)] for p in patterns], float), digits(patterns)
    good, bad = (votes == GOOD).sum(1), (votes == BAD).sum(1)
    # Two labellers that find fault outweigh any number that don't look for it.
    share = np.where(bad >= 1, np.where(bad >= 2, 0.1, 0.35), np.where(good > 0, 0.9, 0.5))
    prior, odds = 0.5, np.zeros((2, len(LABELLERS), 3))
    for _ in range(rounds):
        for k, weight in enumerate((share * times, (1 - share) * times)):
            for vote in range(3):
                odds[k, :, vote] = smooth + weight @ (votes == vote)
        odds /= odds.sum(2, keepdims=True)
        prior = float((share @ times + 1) / (times.sum() + 2))
        logs = [
            np.log(p) + np.log(odds[k][np.arange(len(LABELLERS)), votes]).sum(1) for k, p in enumerate((prior, 1 - prior))
        ]
        share = 1 / (1 + np.exp(np.clip(logs[1] - logs[0], -500, 500)))
    posterior = dict(zip(patterns.tolist(), share.tolist(), strict=True))
    posterior[0] = prior
    return Labels(prior, odds, posterior)


class Features:
    """Buckets and weights of a text's features; remembers a bounded number of words."""

    def __init__(self) -> None:
        self.seen: dict[bytes, int] = {}

    def shape(self, word: bytes) -> int:
        kinds = word.translate(SHAPE)
        # A run of one kind counts once, so that a shape doesn't tell a word's length.
        short = bytes(kind for k, kind in enumerate(kinds) if not k or kind != kinds[k - 1])
        return zlib.crc32(short) % (BUCKETS - 4)

    def __call__(self, text: bytes, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        if not words:
            return np.zeros(0, np.int64), np.zeros(0)
        seen = self.seen
        if len(seen) > KEPT_WORDS:
            seen.clear()
        found = [seen.get(word) for word in words]
        for k, bucket in enumerate(found):
            if bucket is None:
                found[k] = seen[words[k]] = self.shape(words[k])
        buckets, times = np.unique(np.array(found, np.int64), return_counts=True)
        share = facts(text, words)
        more = [1 - share.distinct, share.neighbours, share.lines]
        return (
            np.append(buckets, BUCKETS - 1 - np.arange(3)),
            np.append(np.sqrt(times / len(words)), np.sqrt(np.maximum(more, 0))),
        )


class Scorer(NamedTuple):
    weights: np.ndarray
    offset: float


def train(rows: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray, rounds: int = 300, rate: float = 0.5) -> Scorer:
    """Logistic regression on soft labels by Adagrad over the whole sample."""
    weights, seen, offset, offset_seen = np.zeros(BUCKETS), np.full(BUCKETS, 1e-6), 0.0, 1e-6
    if not rows:
        return Scorer(weights, 0.0)
    row = np.repeat(np.arange(len(rows)), [len(buckets) for buckets, _ in rows])
    bucket, value = (np.concatenate([pair[k] for pair in rows]) for k in (0, 1))
    for _ in range(rounds):
        raw = np.bincount(row, weights[bucket] * value, len(rows)) + offset
        error = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - target) / len(rows)
        change = np.bincount(bucket, error[row] * value, BUCKETS) + 1e-5 * weights
        seen += change**2
        weights -= rate * change / np.sqrt(seen)
        offset_seen += error.sum() ** 2
        offset -= rate * error.sum() / offset_seen**0.5
    return Scorer(weights, offset)


def pattern_of() -> Callable[[Column], Column]:
    def vote(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([votes_of(text, text.split()) for text in raw_texts(batch)], pa.int64())

    return F.arrow_udf(vote, T.LongType())


class Quality(NamedTuple):
    labels: Labels
    scorer: Scorer


def fit(docs: DataFrame, sample: int = 6000) -> Quality:
    """Fit on ``doc_id``, ``text``: patterns of all documents, the scorer on a bounded sample of them."""
    counted = docs.select(pattern_of()(F.col("text")).alias("pattern")).groupBy("pattern").count().collect()
    labels = estimate({row["pattern"]: row["count"] for row in counted} or {0: 0})
    # At most `sample` ids: the bound of the broadcast and of what the driver trains on.
    chosen = smallest_by_hash(docs.select("doc_id", F.lit(0).alias("_all_docs")), "_all_docs", sample)
    chosen = chosen.select("doc_id").distinct()
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id", "left_semi")
    texts = texts.groupBy("doc_id").agg(F.min("text").alias("text"))  # of several texts with one id always the same
    features, rows, target = Features(), [], []
    for row in store(texts, "quality-sample").table.orderBy("doc_id").toLocalIterator():
        text = (row["text"] or "").encode(errors="replace")
        words = text.split()
        rows.append(features(text, words))
        target.append(labels.posterior[votes_of(text, words)])
    return Quality(labels, train(rows, np.array(target)))


def judge(model: Quality) -> Callable[[Column], Column]:
    """A column function from text to votes, weak label and score, both of being good."""

    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        features = Features()
        for batch in batches:
            votes, raw = [], []
            for text in raw_texts(batch):
                words = text.split()
                votes.append(votes_of(text, words))
                buckets, values = features(text, words)
                raw.append(float(model.scorer.weights[buckets] @ values) + model.scorer.offset)
            weak = [model.labels.posterior.get(vote, model.labels.prior) for vote in votes]
            scores = 1 / (1 + np.exp(-np.clip(np.array(raw, float), -30, 30)))
            yield pa.StructArray.from_arrays(
                [pa.array(votes, pa.int64()), pa.array(weak, pa.float64()), pa.array(scores)], ["votes", "weak", "score"]
            )

    return F.arrow_udf(
        score,
        T.StructType([T.StructField("votes", T.LongType()), *(T.StructField(n, T.DoubleType()) for n in ("weak", "score"))]),
    )
