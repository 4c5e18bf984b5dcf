"""The weak-label model and the toxicity network against plain loops over words and weights."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from threadloom.llm import toxicity as tox
from threadloom.llm import weak_labels as wl


def texts(n, seed, bad_share=0.3):
    """Prose, and texts with insults or junk; label 1 for the latter."""
    draw = random.Random(seed)
    common = [f"word{k}" for k in range(80)]
    rude = ["idiot", "fool", "worthless", "stupid"]
    rows = []
    for k in range(n):
        words = [draw.choice(common) for _ in range(draw.randint(1, 60))]
        bad = draw.random() < bad_share
        if bad:
            for _ in range(draw.randint(1, 4)):
                words.insert(draw.randrange(len(words) + 1), draw.choice(rude) + draw.choice(["", "!", "s"]))
            if draw.random() < 0.5:
                words += ["###", "***"] * 8
        rows.append((k, " ".join(words).capitalize() + ("." if not bad else ""), int(bad)))
    return rows


def plain_em(patterns, rounds=60):
    """Expectation-maximisation document by document: accuracies of labellers that abstain or vote."""
    names = len(wl.LABELLERS)

    def digits(p):
        out = []
        for _ in range(names):
            out.append(p % 3)
            p //= 3
        return out[::-1]

    votes = [digits(p) for p in patterns]
    share = []
    for own in votes:
        good, bad = own.count(wl.GOOD), own.count(wl.BAD)
        share.append(0.1 if bad >= 2 else 0.35 if bad else 0.9 if good else 0.5)
    for _ in range(rounds):
        odds = {}
        for cls in (0, 1):
            for name in range(names):
                counts = [1.0, 1.0, 1.0]
                for own, s in zip(votes, share):
                    counts[own[name]] += s if cls == 0 else 1 - s
                odds[cls, name] = [c / sum(counts) for c in counts]
        prior = (sum(share) + 1) / (len(share) + 2)
        new = []
        for own in votes:
            logs = [math.log(p) + sum(math.log(odds[cls, k][v]) for k, v in enumerate(own)) for cls, p in enumerate((prior, 1 - prior))]
            new.append(1 / (1 + math.exp(logs[1] - logs[0])))
        share = new
    return dict(zip(patterns, share)), prior


def test_weak_labels_equal_plain_loops(spark):
    rows = texts(150, 1)
    docs = spark.createDataFrame([(k, t) for k, t, _ in rows], "doc_id long, text string")
    model = wl.fit(docs)
    patterns = [wl.votes_of(t.encode(), t.encode().split()) for _, t, _ in rows]
    posterior, prior = plain_em(patterns)
    assert math.isclose(model.labels.prior, prior, rel_tol=1e-9)
    for pattern, share in posterior.items():
        if pattern:
            assert math.isclose(model.labels.posterior[pattern], share, rel_tol=1e-6, abs_tol=1e-12)
    # The scorer, refitted by plain Adagrad over features held in dictionaries.
    features = []
    for _, t, _ in rows:
        text = t.encode()
        words, counts = text.split(), Counter()
        for word in words:
            kinds = word.translate(wl.SHAPE)
            counts[zlib.crc32(bytes(k for i, k in enumerate(kinds) if not i or k != kinds[i - 1])) % (wl.BUCKETS - 4)] += 1
        own = {bucket: math.sqrt(n / len(words)) for bucket, n in counts.items()}
        share = wl.facts(text, words)
        for k, value in enumerate((1 - share.distinct, share.neighbours, share.lines)):
            own[wl.BUCKETS - 1 - k] = math.sqrt(max(value, 0))
        features.append(own)
    target = [model.labels.posterior[p] for p in patterns]
    used = sorted({bucket for own in features for bucket in own})
    weights, seen, offset, offset_seen = dict.fromkeys(used, 0.0), dict.fromkeys(used, 1e-6), 0.0, 1e-6
    for _ in range(300):
        change, total = {bucket: 1e-5 * weights[bucket] for bucket in used}, 0.0
        for own, wanted in zip(features, target):
            raw = sum(weights[bucket] * value for bucket, value in own.items()) + offset
            error = (1 / (1 + math.exp(-raw)) - wanted) / len(rows)
            total += error
            for bucket, value in own.items():
                change[bucket] += error * value
        for bucket in used:
            seen[bucket] += change[bucket] ** 2
            weights[bucket] -= 0.5 * change[bucket] / math.sqrt(seen[bucket])
        offset_seen += total**2
        offset -= 0.5 * total / math.sqrt(offset_seen)
    judged = docs.withColumn("j", wl.judge(model)(F.col("text"))).collect()
    for row, own in zip(sorted(judged, key=lambda r: r["doc_id"]), features):
        raw = sum(weights[bucket] * value for bucket, value in own.items()) + offset
        assert math.isclose(row["j"]["score"], 1 / (1 + math.exp(-raw)), rel_tol=1e-4, abs_tol=1e-6)


def plain_score(net, text):
    """Filters slid over the words of one text, place by place."""
    place = {int(bucket): k for k, bucket in enumerate(net.buckets)}
    words = text.lower().split()
    vectors = []
    for word in words:
        rows = [place[b] for b in tox.buckets_of(word) if b in place]
        vectors.append(sum((net.embedding[k].astype(float) for k in rows), np.zeros(tox.SIZE)))
    zero, raw = np.zeros(tox.SIZE), net.offset
    for w, (width, kernel) in enumerate(zip(tox.WIDTHS, net.filters)):
        for f in range(tox.FILTERS):
            best = -math.inf
            for at in range(len(words) + 1):  # also where it only touches the end
                total = 0.0
                for step in range(width):
                    vector = vectors[at + step] if at + step < len(words) else zero
                    total += float(vector @ kernel[step][:, f])
                best = max(best, total)
            k = w * tox.FILTERS + f
            if words:
                raw += max(best + float(net.offsets[k]), 0.0) * float(net.weights[k])
    return 1 / (1 + math.exp(-min(max(raw, -30), 30)))


@pytest.fixture(scope="module")
def toxic(spark):
    rows = texts(400, 2)
    labelled = spark.createDataFrame([(k, t, "en", y) for k, t, y in rows], "doc_id long, text string, lang string, toxic int")
    return rows, tox.fit(labelled)


def test_network_scores_equal_plain_loops(spark, toxic):
    rows, model = toxic
    some = [t for _, t, _ in rows[:60]] + ["", "   ", "never seen words only", "idiot", "word1 idiot!"]
    df = spark.createDataFrame(list(enumerate(some)), "doc_id long, text string")
    found = {r["doc_id"]: r["s"] for r in df.select("doc_id", tox.scorer(model)(F.col("text")).alias("s")).collect()}
    for k, text in enumerate(some):
        assert math.isclose(found[k], plain_score(model.network, text.encode()), rel_tol=1e-3, abs_tol=1e-4), text


def test_gradients_equal_differences():
    """One small step of training moves the loss as the slope of every part of the network says."""
    rows = texts(64, 5, 0.5)
    data, labels = [t.encode() for _, t, _ in rows], np.array([y for *_, y in rows], np.float32)

    def loss(net):
        scores = [plain_score(net, text) for text in data]
        return -sum(math.log(s if y else 1 - s) for s, y in zip(scores, labels)) / len(data)

    before = tox.start(data, 3)
    after = tox.train(data, labels, 3, epochs=4)
    assert loss(after) < 0.6 * loss(before)


def test_held_out_toxic_texts(spark, toxic):
    _, model = toxic
    rows = texts(300, 9)
    df = spark.createDataFrame([(k, t) for k, t, _ in rows], "doc_id long, text string")
    found = {r["doc_id"]: r["s"] for r in df.select("doc_id", tox.scorer(model)(F.col("text")).alias("s")).collect()}
    hits = sum((found[k] >= 0.5) == bool(y) for k, _, y in rows)
    assert hits > 0.9 * len(rows)


def test_repeated_ids_are_sampled_alike(spark):
    """Several texts with one id: reruns and other partitions give the same model."""
    rows = [(k % 40, t, "en", y) for k, t, y in texts(120, 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int")
    one, two = tox.fit(df), tox.fit(df.repartition(7, "text"))
    assert np.array_equal(one.network.weights, two.network.weights) and one.threshold == two.threshold
    first, second = (wl.fit(d.select("doc_id", "text")) for d in (df, df.repartition(5, "toxic")))
    assert np.array_equal(first.scorer.weights, second.scorer.weights)
    scored = df.select("doc_id", "text", tox.scorer(one)(F.col("text")).alias("s")).collect()
    by_text = {}
    for row in scored:
        assert by_text.setdefault(row["text"], row["s"]) == row["s"]  # repeated rows score alike


def test_all_labelled_rows_are_learnt(spark):
    """A word that only rows of the last shards hold is learnt, and every row has its place in the thresholds."""
    rows = [(k, t, "en", y) for k, t, y in texts(1200, 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int")
    shard = F.pmod(F.xxhash64("doc_id", "text"), F.lit(2)) == 0
    df = df.withColumn("text", F.when(shard & (F.col("toxic") == 1), F.regexp_replace("text", "idiot|fool|worthless|stupid", "zounds")).otherwise(F.col("text")))
    one, dealt = tox.fit(df), tox.fit(df, shard_rows=300)
    again = tox.fit(df.repartition(5, "lang", "text"), shard_rows=300)
    assert np.array_equal(dealt.network.embedding, again.network.embedding) and dealt.threshold == again.threshold
    for model in (one, dealt):
        assert {tox.buckets_of(word)[0] for word in (b"zounds", b"idiot")} <= set(model.network.buckets.tolist())
        scored = df.select("toxic", tox.scorer(model)(F.col("text")).alias("s")).collect()
        assert sum((r["s"] >= 0.5) == r["toxic"] for r in scored) > 0.97 * len(rows)


def test_words_are_counted_over_all_texts(spark):
    df = spark.createDataFrame([(t,) for _, t, _ in texts(200, 6)] + [(None,), ("",)], "text string").repartition(3)
    counted = {r["bucket"]: r["n"] for r in tox.texts_with_bucket(df.mapInArrow(tox.hashed, "words binary")).collect()}
    wanted = Counter()
    for row in df.collect():
        wanted.update({b for word in (row["text"] or "").encode().lower().split() for b in tox.buckets_of(word)})
    assert counted == wanted


def test_a_rounds_changes_are_means_by_rows(spark):
    """Two shards: a parameter moves by the mean of the changes of the shards that touched it, weighted by their rows."""
    rows = texts(90, 8)
    shards, words = [rows[:60], rows[60:]], tox.WordBuckets()
    df = spark.createDataFrame([(s, y, t) for s, part in enumerate(shards) for _, t, y in part], "shard int, toxic int, text string")
    df = df.coalesce(1).mapInArrow(tox.hashed, "shard int, toxic int, words binary")
    net = tox.start([t.encode() for _, t, _ in rows], 3)
    learner, alone = tox.Learner(net), []
    for number, part in enumerate(shards):
        alone.append(tox.Learner(net))
        labels = np.array([y for *_, y in part], np.float32)
        alone[-1].learn([words.of(t.encode()) for _, t, _ in part], labels, np.random.default_rng([5, number]))
    tox.round_of(df, learner, 5)
    for k, was in enumerate(tox.Learner(net).params):
        touched = np.stack([a.touched if not k else np.ones(1) for a in alone]) * np.array([[60], [30]])
        share = (touched / np.maximum(touched.sum(0), 1)).reshape(2, *([1] * was.ndim if k else [-1, 1]))
        wanted = was + sum(s * (a.params[k] - was) for s, a in zip(share, alone))
        assert np.allclose(learner.params[k], wanted, atol=1e-5), k
    assert np.array_equal(learner.touched, alone[0].touched | alone[1].touched)
