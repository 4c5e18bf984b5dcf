"""Quality rules per document, and verdicts on whole hosts from shrunken failure rates.

Every document is held against a few rules. The failures are summed per host and rule (partial
sums before the shuffle, so a host with a third of all rows costs no more than another). Over the
hosts, a beta prior is fitted to each rule's failure rates by the method of moments; a host's rate
is the mean of its posterior, so a host of three documents is drawn towards the usual rate and a
host of a million speaks for itself. A host is refused where the lower bound of a posterior
(mean less two standard deviations) is above ``LIMIT``; the refused hosts are joined back to
the documents.

The counts are made twice, for the sums and for the verdicts: that is cheaper than
keeping a copy of the texts. Null texts have no words. A null host is a host of its own. Repeated rows
count once each. Very long texts are counted whole; ties don't arise. An empty table gives an empty result. Columns of the input
that are named like one of the result (``_counts``, ``base_failed``, ``host_refused``, ``kept``) give way to it; all others come
back as they were, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom.llm.words import raw_texts
from threadloom.operators.lookup import fits_broadcast, lookup_join
from threadloom.plans.materialize import store

WINDOW = 5
LIMIT = 0.5
#: Bounds of the prior's weight in documents: it never vanishes and never silences a host for good.
WEIGHT = (2.0, 10_000.0)
COUNTS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]
SYMBOLS = b"#*$%&|<>"


def repeated_words(words: list[bytes], width: int = WINDOW) -> int:
    """Words inside windows of five words that occur at least twice, the first one included."""
    windows = len(words) - width + 1
    if windows < 2:
        return 0
    seen: dict[bytes, int] = {}
    code = ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    for step in range(1, width):  # renumbered after each word, so a code never overflows
        code = code[:-1] * len(seen) + ids[step:]
        if step < width - 1:
            code = np.unique(code, return_inverse=True)[1]
    _, which, times = np.unique(code, return_inverse=True, return_counts=True)
    twice = times[which] >= 2
    if not twice.any():
        return 0
    inside = np.zeros(len(words), bool)
    for step in range(width):
        inside[step : step + windows] |= twice
    return int(inside.sum())


def count_text(text: bytes) -> tuple[int, ...]:
    """The counts of one text, in the order of ``COUNTS``."""
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip()]
    return (
        len(words),
        len(b"".join(words).decode(errors="replace")),
        len(text) - len(text.translate(None, SYMBOLS)),
        len(lines),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


@F.arrow_udf(T.StructType([T.StructField(name, T.LongType()) for name in COUNTS]))
def text_counts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        found = np.array([count_text(text) for text in raw_texts(batch)], np.int64).reshape(-1, len(COUNTS))
        yield pa.StructArray.from_arrays([pa.array(found[:, k]) for k in range(len(COUNTS))], COUNTS)


def rules(count: dict[str, Column]) -> dict[str, Column]:
    """Rule name to whether a document fails it. ``base`` alone refuses a document by itself."""
    words = count["n_words"]
    return {
        "base": (words < 10) | (100 * count["n_repeat_words"] > 20 * words),
        "symbols": 100 * count["n_symbols"] > 10 * words,
        "lines": 100 * count["n_dup_lines"] > 30 * count["n_lines"],
        "length": (count["word_chars"] < 2 * words) | (count["word_chars"] > 20 * words),
    }


RESULT = ["_counts", "base_failed", "host_refused", "kept"]


def _with_rules(docs: DataFrame, text: str, host: str) -> DataFrame:
    """``_counts``, ``_host``, ``_failed`` and the columns of ``docs`` as ``_given``."""
    given = F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("_given")
    named = F.coalesce(F.concat(F.lit("="), F.col(f"`{host}`").cast("string")), F.lit("")).alias("_host")
    made = docs.select(text_counts(F.col(f"`{text}`")).alias("_counts"), named, given)
    failed = rules({name: F.col(f"_counts.{name}") for name in COUNTS})
    return made.withColumn("_failed", F.struct(*(value.alias(name) for name, value in failed.items())))


def host_rates(docs: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """Host (``_host``), rule, documents ``n``, failures ``failed``."""
    needed = dict.fromkeys([text, host])  # the same column may be both
    marked = _with_rules(docs.select(*(F.col(f"`{name}`") for name in needed)), text, host).drop("_given")
    names = list(rules({name: F.lit(0) for name in COUNTS}))
    sums = marked.groupBy("_host").agg(
        F.count(F.lit(1)).alias("n"), *(F.sum(F.col(f"_failed.{name}").cast("long")).alias(name) for name in names)
    )
    return sums.unpivot(["_host", "n"], names, "rule", "failed")


def beta_priors(rates: DataFrame) -> DataFrame:
    """Per rule the prior's ``mean`` and ``weight`` in documents, by the method of moments."""
    rate = F.col("failed") / F.col("n")
    moments = rates.groupBy("rule").agg(
        F.avg(rate).alias("mean"), F.var_pop(rate).alias("spread"), F.avg(1 / F.col("n")).alias("per_doc")
    )
    noise = F.col("mean") * (1 - F.col("mean"))
    between = F.col("spread") - noise * F.col("per_doc")
    weight = F.when(between > 0, noise / between - 1).otherwise(F.lit(WEIGHT[1]))
    return moments.select("rule", "mean", F.least(F.greatest(weight, F.lit(WEIGHT[0])), F.lit(WEIGHT[1])).alias("weight"))


def judged_hosts(rates: DataFrame) -> DataFrame:
    """Host and rule with the shrunken rate, its lower bound, and whether the rule refuses the host."""
    # One row for each rule, so the broadcast is bounded by the number of rules.
    both = rates.join(F.broadcast(beta_priors(rates)), "rule")
    size = F.col("n") + F.col("weight")
    shrunk = (F.col("failed") + F.col("weight") * F.col("mean")) / size
    lower = shrunk - 2 * F.sqrt(shrunk * (1 - shrunk) / (size + 1))
    return both.select("_host", "rule", "n", "failed", shrunk.alias("rate"), lower.alias("lower"), (lower > LIMIT).alias("refused"))


def apply_host_rules(docs: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """``docs`` with a struct ``_counts``, ``base_failed``, ``host_refused`` and ``kept``."""
    rates = host_rates(docs, text, host)
    # One row for each host and rule is left of the corpus here.
    judged = judged_hosts(store(rates, "host-rates").table)
    refused = store(judged.where("refused").select("_host").distinct(), "hosts").table.withColumn("_refused", F.lit(True))
    small = fits_broadcast(refused)
    out = lookup_join(_with_rules(docs, text, host), refused, ["_host"], small, "left")
    base, host_refused = F.col("_failed.base"), F.coalesce(F.col("_refused"), F.lit(False))
    kept = [F.col(f"_given.`{name}`").alias(name) for name in docs.columns if name not in RESULT]
    return out.select(
        *kept, "_counts", base.alias("base_failed"), host_refused.alias("host_refused"), (~base & ~host_refused).alias("kept")
    )
