"""Language identification by unigram models of pieces, summed over all segmentations.

The pieces are a fixed public vocabulary, every single byte among them, so that any text can be
cut. For each language the pieces have probabilities; a word (with a blank before it, lowered) has the
sum of the probabilities of all its segmentations, found by a forward pass over its bytes. A text scores the
sum of its words' log probabilities, and the languages' shares of that are its posterior.

The probabilities are fitted by expectation-maximisation: a forward and a backward pass give the
expected uses of every piece over all segmentations of the training words. Training reads a bounded,
documented sample: per language the ``per_language`` documents with the smallest hash of their id.
The model holds pieces x languages numbers, whatever the corpus.

Words of one length are handled together in numpy; words of more than ``SHORT`` bytes one by one, rescaled at each byte.
A word of more than ``BLOCKED`` bytes (a text without blanks may be one) is read block by block, in bounded memory: only the
sums of the last few bytes go on, scaled. In training, and only there, words are cut at ``TRAINED`` bytes. Null texts and texts without a letter are ``und`` with score and gain 0. Very long texts
are scored whole. Repeated rows score alike; an even score goes to the first language by name.
Without a labelled row every text is ``und``. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
from collections import Counter
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom.llm.words import smallest_by_hash
from threadloom.plans.materialize import store

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
SHORT = 32
#: Longer words are read in blocks of ``BLOCK`` bytes; sums are scaled after each ``SCALED`` bytes.
BLOCKED, BLOCK, SCALED = 512, 1 << 14, 12
#: Bytes at which training words are cut.
TRAINED = 1024
BASE = np.uint64(0x9E3779B97F4A7C15)
LETTER = regex.compile(r"\p{L}")
#: Words whose log probabilities a task keeps at once; beyond that it starts afresh.
KEPT_WORDS = 200_000
TOKENS_AT_ONCE = 200_000


class Pieces(NamedTuple):
    """Hashes of the pieces in ascending order, a table of which top bits occur, and the bytes of the longest piece."""

    keys: np.ndarray
    present: np.ndarray
    longest: int


class Model(NamedTuple):
    pieces: Pieces
    languages: list[str]
    probability: np.ndarray  # pieces x languages


def _extend(held: np.ndarray, byte: np.ndarray) -> np.ndarray:
    return (held + byte + np.uint64(1)) * BASE


def load_pieces(path: str | None = None) -> Pieces:
    """All pieces of the vocabulary."""
    with open(path or public_tokenizers.path(VOCABULARY), "rb") as lines:
        found = [base64.b64decode(line.split()[0]) for line in lines]
    longest = max(map(len, found))
    with np.errstate(over="ignore"):
        held = np.zeros(len(found), np.uint64)
        for k in range(longest):
            more = np.array([len(p) > k for p in found])
            byte = np.array([p[k] if len(p) > k else 0 for p in found], np.uint64)
            held = np.where(more, _extend(held, byte), held)
    keys = np.unique(held)
    present = np.zeros(1 << 20, bool)
    present[keys >> np.uint64(44)] = True
    return Pieces(keys, present, longest)


def _matches(pieces: Pieces, held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the hashes are pieces, and which piece each is."""
    at = np.flatnonzero(pieces.present[held >> np.uint64(44)])
    place = np.minimum(np.searchsorted(pieces.keys, held[at]), len(pieces.keys) - 1)
    same = pieces.keys[place] == held[at]
    return at[same], place[same]


def _steps(pieces: Pieces, letters: np.ndarray) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
    """(start, end, rows, piece numbers) of every piece inside words of one length, by start."""
    found, length = [], letters.shape[1]
    with np.errstate(over="ignore"):
        for start in range(length):
            held = np.zeros(len(letters), np.uint64)
            for end in range(start + 1, min(length, start + pieces.longest) + 1):
                held = _extend(held, letters[:, end - 1])
                rows, numbers = _matches(pieces, held)
                if len(rows):
                    found.append((start, end, rows, numbers))
    return found


def _numbers(pieces: Pieces, word: bytes) -> np.ndarray:
    """The piece that ends at each byte with each length, -1 if there is none: by end - 1 and length - 1."""
    letters = np.frombuffer(word, np.uint8).astype(np.uint64)
    numbers = np.full((len(letters), pieces.longest), -1, np.int32)
    with np.errstate(over="ignore"):
        held = np.zeros(len(letters), np.uint64)
        for size in range(1, min(pieces.longest, len(letters)) + 1):
            held = _extend(held[: len(letters) - size + 1], letters[size - 1 :])
            at, place = _matches(pieces, held)
            numbers[at + size - 1, size - 1] = place
    return numbers


def _blocked_word(model: Model, word: bytes) -> np.ndarray:
    """Log probabilities of one very long word, see the module's text. Plain numbers are faster here than short arrays."""
    longest, width = model.pieces.longest, len(model.languages)
    recent, log = [[0.0] * width] * (longest - 1) + [[1.0] * width], np.zeros(width)  # the last sums, over exp(log)
    for first in range(0, len(word), BLOCK):
        before = min(first, longest - 1)
        numbers = _numbers(model.pieces, word[first - before : first + BLOCK])[before:]
        ends, sizes = np.nonzero(numbers >= 0)
        chances = model.probability[numbers[ends, sizes]].tolist()
        starts = np.searchsorted(ends, np.arange(len(numbers) + 1)).tolist()
        back = (-1 - sizes).tolist()
        for at in range(len(numbers)):
            total = [0.0] * width
            for k in range(starts[at], starts[at + 1]):
                total = [t + f * p for t, f, p in zip(total, recent[back[k]], chances[k])]
            recent.append(total)
            if at % SCALED == SCALED - 1 or at == len(numbers) - 1:
                most = [max(column) for column in zip(*recent[-longest:])]
                recent = [[f / m for f, m in zip(row, most)] for row in recent[-longest:]]
                log += np.log(most)
    return log + np.log(recent[-1])


def _long_word(model: Model, word: bytes, uses: np.ndarray | None = None, times: np.ndarray | None = None) -> np.ndarray:
    """Log probabilities of one long word; adds its expected uses of pieces times ``times``."""
    length, longest = len(word), model.pieces.longest
    numbers = _numbers(model.pieces, word)
    width = len(model.languages)
    forward, logs = np.ones((length + 1, width)), np.zeros((length + 1, width))
    for end in range(1, length + 1):
        sizes = np.flatnonzero(numbers[end - 1] >= 0) + 1
        part = forward[end - sizes] * np.exp(logs[end - sizes] - logs[end - 1]) * model.probability[numbers[end - 1, sizes - 1]]
        total = part.sum(0)
        logs[end], forward[end] = logs[end - 1] + np.log(total), 1.0
    if uses is not None:
        after = np.zeros((length + 1, width))  # log of the backward sums
        for start in range(length - 1, -1, -1):
            sizes = [s for s in range(1, min(longest, length - start) + 1) if numbers[start + s - 1, s - 1] >= 0]
            part = np.array([np.log(model.probability[numbers[start + s - 1, s - 1]]) + after[start + s] for s in sizes])
            after[start] = np.logaddexp.reduce(part, axis=0)
            for s, value in zip(sizes, part, strict=True):
                uses[numbers[start + s - 1, s - 1]] += times * np.exp(logs[start] + value - logs[length])
    return logs[length]


def word_logs(model: Model, words: list[bytes], times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray | None]:
    """Words x languages log probabilities; with ``times``, also the expected uses, pieces x languages."""
    width = len(model.languages)
    logs = np.zeros((len(words), width))
    uses = None if times is None else np.zeros(model.probability.shape)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        if size > SHORT:
            for k in at:
                if uses is None and size > BLOCKED:
                    logs[k] = _blocked_word(model, words[k])
                else:
                    logs[k] = _long_word(model, words[k], uses, None if times is None else times[k])
            continue
        letters = np.frombuffer(b"".join(words[k] for k in at), np.uint8).reshape(len(at), size).astype(np.uint64)
        steps = _steps(model.pieces, letters)
        forward = np.zeros((size + 1, len(at), width))
        forward[0] = 1.0
        for start, end, rows, numbers in steps:
            forward[end, rows] += forward[start, rows] * model.probability[numbers]
        logs[at] = np.log(forward[size])
        if uses is None:
            continue
        backward = np.zeros_like(forward)
        backward[size] = times[at] / forward[size]
        for start, end, rows, numbers in reversed(steps):
            backward[start, rows] += backward[end, rows] * model.probability[numbers]
        numbers = np.concatenate([step[3] for step in steps])
        expected = np.concatenate(
            [forward[s, rows] * model.probability[place] * backward[e, rows] for s, e, rows, place in steps]
        )
        for k in range(width):
            uses[:, k] += np.bincount(numbers, expected[:, k], len(uses))
    return logs, uses


def words_of(text: str) -> list[bytes]:
    return [b" " + word for word in text.lower().encode(errors="replace").split()]


def training_words(labelled: DataFrame, per_language: int) -> DataFrame:
    """``lang``, ``word``, ``n`` of the sample: per language the documents of smallest hash."""
    # At most per_language rows for each language: the bound of the broadcast.
    chosen = smallest_by_hash(labelled, "lang", per_language).select("doc_id").distinct()
    sample = labelled.join(F.broadcast(chosen), "doc_id", "left_semi").select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for word in words_of(text or ""):
                    own = counts.setdefault(lang, Counter())
                    own.update(word[at : at + TRAINED] for at in range(0, len(word), TRAINED))
        for lang, words in counts.items():
            yield pa.RecordBatch.from_pydict(
                {"lang": [lang] * len(words), "word": list(words), "n": list(words.values())},
                pa.schema([("lang", pa.string()), ("word", pa.binary()), ("n", pa.int64())]),
            )

    return sample.mapInArrow(count, "lang string, word binary, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def fit(
    labelled: DataFrame, per_language: int = 1000, rounds: int = 3, smooth: float = 0.05, path: str | None = None
) -> Model:
    """Fit on ``doc_id``, ``text`` and non-null ``lang``."""
    words = store(training_words(labelled.where("lang is not null"), per_language), "language-words").table
    languages = sorted(row["lang"] for row in words.select("lang").distinct().collect())
    pieces = load_pieces(path)
    model = Model(pieces, languages, np.full((len(pieces.keys), len(languages)), 1.0 / len(pieces.keys)))
    for _ in range(rounds if languages else 0):
        found = words.mapInArrow(_expect(model), "lang int, piece int, uses double")
        sums = found.groupBy("lang", "piece").agg(F.sum("uses").alias("uses")).toPandas()
        uses = np.full(model.probability.shape, smooth)
        uses[sums["piece"], sums["lang"]] += sums["uses"]
        model = model._replace(probability=uses / uses.sum(0))
    return model


def _expect(model: Model) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Expected uses of the pieces in the words of a partition."""

    def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {name: k for k, name in enumerate(model.languages)}
        uses = np.zeros(model.probability.shape)
        for batch in batches:
            words = batch.column("word").to_pylist()
            times = np.zeros((len(words), len(place)))
            own = [place[name] for name in batch.column("lang").to_pylist()]
            times[np.arange(len(words)), own] = batch.column("n").to_numpy()
            uses += word_logs(model, words, times)[1]
        piece, lang = np.nonzero(uses)
        yield pa.RecordBatch.from_pydict(
            {"lang": pa.array(lang, pa.int32()), "piece": pa.array(piece, pa.int32()), "uses": uses[piece, lang]}
        )

    return expect


RESULT = T.StructType(
    [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("gain", T.DoubleType())]
)


def text_logs(model: Model, batches: Iterator[list[str | None]]) -> Iterator[np.ndarray]:
    """Log probabilities of texts, texts x languages, for each batch of them."""
    known: dict[bytes, int] = {}
    logs = np.zeros((0, len(model.languages)))
    for texts in batches:
        out, start = np.zeros((len(texts), len(model.languages))), 0
        while start < len(texts):
            if len(known) > KEPT_WORDS:
                known, logs = {}, logs[:0]
            ids, ends, end = [], [], start
            while end < len(texts) and len(ids) < TOKENS_AT_ONCE:
                ids += [known.setdefault(word, len(known)) for word in words_of(texts[end] or "")]
                ends.append(len(ids))
                end += 1
            new = list(known)[len(logs) :]
            logs = np.concatenate([logs, word_logs(model, new)[0]]) if new else logs
            sums = np.zeros((len(ids) + 1, len(model.languages)))
            np.cumsum(logs[ids], axis=0, out=sums[1:])
            out[start:end] = np.diff(sums[np.array([0, *ends])], axis=0)
            start = end
        yield out


def identify(model: Model) -> Callable[[Column], Column]:
    """A column function from text to ``lang_pred``, ``score`` and ``gain``.

    ``score`` is the posterior of the language among the learned ones. It says nothing about texts in none of them;
    ``gain`` does: the logarithm, for each byte, of the language's odds against a background in which all pieces of the
    vocabulary are equally likely. Texts of other languages and letter junk are below 0, as their pieces are rarer in the language
    than that.
    """
    flat = np.full((len(model.pieces.keys), 1), 1.0 / len(model.pieces.keys))
    # The background is one more language, the last one.
    both = model._replace(languages=[*model.languages, ""], probability=np.hstack([model.probability, flat]))

    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        def read() -> Iterator[list[str | None]]:
            for batch in batches:
                held.append(batch.to_pylist())
                yield held[-1]

        held: list[list[str | None]] = []
        for logs in text_logs(both, read()):
            texts = held.pop()
            logs, background = logs[:, :-1], logs[:, -1]
            has = np.array([bool(model.languages) and text is not None and bool(LETTER.search(text)) for text in texts], bool)
            most = logs.max(1) if model.languages else background
            share = np.exp(logs - most[:, None]) if model.languages else np.zeros((len(texts), 1))
            best = share.argmax(1)
            top = np.where(has, 1.0 / np.maximum(share.sum(1), 1.0), 0.0)
            sizes = np.array([max(1, len((text or "").encode(errors="replace"))) for text in texts])
            gain = np.where(has, (most - background) / sizes, 0.0)
            names = [model.languages[k] if letter else "und" for k, letter in zip(best, has, strict=True)]
            values = [pa.array(names, pa.string()), pa.array(top), pa.array(gain)]
            yield pa.StructArray.from_arrays(values, RESULT.fieldNames())

    return F.arrow_udf(score, RESULT)


def accepted(found: Column, least: float = 0.5, gain: float = 0.0) -> Column:
    """True for a text in a learned language: at least ``least`` of the posterior, and likelier than the background."""
    return (found["lang_pred"] != "und") & (found["score"] >= least) & (found["gain"] > gain)
