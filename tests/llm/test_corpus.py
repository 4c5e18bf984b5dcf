"""The corpus operators on small tables: odd rows, brute force, round trips, held-out accuracy."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from threadloom.llm import (
    fingerprints,
    host_rules,
    language_id,
    mixing,
    near_dedup,
    packing,
    pitman_yor,
    queries,
    toxicity,
    url_filter,
    weak_labels,
)
from threadloom.llm.words import fold, smallest_by_hash

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, _host string"


def table(spark, rows):
    """Documents with further columns whose names operators use themselves."""
    return spark.createDataFrame(
        [(i, t, lang, s, None if t is None else len(t), "x", "y") for i, t, lang, s in rows], SCHEMA
    )


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and blank texts, a long text, repeated rows, equal sizes."""
    long = " ".join(f"w{k % 977}x{k % 31}" for k in range(30_000))
    plain = "the cat sat on the mat and then it went home to sleep for a while"
    rows = [
        (1, plain, "en", "a"),
        (2, plain, "en", "a"),
        (2, plain, "en", "a"),
        (3, None, "en", "b"),
        (4, "", None, None),
        (5, " \t\n\x0b ", "de", "b"),
        (None, "eins zwei drei vier fuenf sechs sieben acht neun zehn elf", "de", None),
        (None, None, None, None),
        (7, long, "de", "c"),
        (8, "123 456 !!", "en", "c"),
        (9, "one two", "en", "é"),
        (10, "One TWO", "en", "é"),
    ]
    return table(spark, rows)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def local(documents):
    return documents.toPandas()


def test_host_rules_counts():
    text = b"a b c d e f\na b c d e f\n#$ x"
    assert host_rules.count_text(text) == (14, 15, 2, 3, 1, 12)
    assert host_rules.count_text(b"") == (0,) * 6
    words = [random.Random(5).choice([b"a", b"b"]) for _ in range(60)]
    windows = [tuple(words[k : k + 5]) for k in range(56)]
    times = Counter(windows)
    inside = {k + j for k, window in enumerate(windows) if times[window] > 1 for j in range(5)}
    assert host_rules.repeated_words(words) == len(inside)


def test_host_rules_on_odd_rows(odd):
    out = host_rules.apply_host_rules(odd).select("doc_id", "_counts.n_words", "base_failed", "kept").collect()
    assert len(out) == 12
    assert all(row["base_failed"] for row in out if row["n_words"] < 10)
    assert host_rules.apply_host_rules(odd.limit(0)).count() == 0


def test_host_is_refused(spark):
    good = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(k, "bad" if k % 10 else good, "en", "spam") for k in range(300)]
    rows += [(1000 + k, good, "en", f"host{k % 7}") for k in range(300)] + [(5000, "short", "en", "tiny")]
    out = host_rules.apply_host_rules(table(spark, rows)).select("doc_id", "kept", "host_refused").collect()
    kept = {row["doc_id"] for row in out if row["kept"]}
    assert kept == {1000 + k for k in range(300)}  # the good rows of the refused host go with it
    assert {row["doc_id"] for row in out if row["host_refused"]} == set(range(300))


def test_mixing(odd, documents, local):
    out = mixing.mix(documents).toPandas()
    assert len(out) == len(local)
    again = {row["doc_id"]: row for row in mixing.mix(documents).collect()}
    assert all(again[row["doc_id"]] == row for row in mixing.mix(documents).collect())
    assert {i: row["taken"] for i, row in again.items()} == dict(zip(out["doc_id"], out["taken"], strict=True))
    by = out.groupby("source")
    assert (by["size"].sum() == by["source_size"].first()).all()
    assert ((by["taken"].sum() - by["target"].first()).abs() <= 130).all()
    assert (out["taken"] <= 2 * out["size"]).all()
    assert abs(by["target"].first().sum() - min(1.5, 2) * out["size"].sum()) < 1e-6
    for row in out.itertuples():
        assert row.taken == row.passes * row.size + sum(s["length"] for s in row.spans)
        assert all(0 <= s["start"] and s["start"] + s["length"] <= row.size for s in row.spans)
    found = mixing.mix(odd).collect()
    assert len(found) == 12 and all(row["taken"] == 0 for row in found if row["size"] == 0)
    assert mixing.mix(odd.limit(0)).count() == 0


def test_targets_are_shared_again(spark):
    sizes = [("b", 10), (None, 1000), ("a", 100), ("c", 500)]
    sources = spark.createDataFrame(sizes, "source string, source_size long")
    out = {row["source"]: row["target"] for row in mixing.targets(sources).collect()}
    # weights a 3, b 1, c 2, null 3; 2415 words; a stops at 200, b at 20, c and null share 2195 as 2 to 3
    assert out["a"] == 200 and out["b"] == 20
    assert math.isclose(out["c"], 2195 * 2 / 5) and math.isclose(out[None], 2195 * 3 / 5)


@pytest.mark.parametrize("seed", range(4))
def test_highest_quotients(spark, seed):
    draw = random.Random(seed)
    votes = [(0, k, float(draw.choice([0, 1, 5, 5, draw.randint(1, 10_000)]))) for k in range(23)]
    seats = draw.choice([0, 1, 7, 100, 5000])
    parties = spark.createDataFrame(votes, "g int, place int, votes double").withColumn("seats", F.lit(seats).cast("long"))
    out = {row["place"]: row["quota"] for row in mixing.apportion(parties, "g", "votes", "place", "seats").collect()}
    won = Counter()
    for _ in range(seats):
        best = max(votes, key=lambda v: (v[2] / (2 * won[v[1]] + 1), -v[1]))
        won[best[1]] += 1
    assert out == {k: won[k] for _, k, _ in votes}


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def brute_components(rows):
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(i):
        return i if parent[i] == i else find(parent[i])

    where = defaultdict(list)
    for i, own in sets.items():
        shared = Counter(j for one in own for j in where[one])
        for one in own:
            where[one].append(i)
        for j, n in shared.items():
            if 100 * n >= 85 * (len(own) + len(sets[j]) - n):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_near_dedup_matches_brute_force(spark):
    draw = random.Random(2)
    base = [f"w{k}" for k in range(80)]
    rows, number = [], 0
    for group in range(4):
        for _ in range(40):
            words = [f"{group}{w}" for w in base]
            for _ in range(draw.randint(0, 3)):
                words[draw.randrange(80)] = f"new{draw.randrange(10**6)}"
            rows.append((number, " ".join(words).title() if number % 3 else " ".join(words)))
            number += 1
    out = near_dedup.group_near_copies(table(spark, [(i, t, "en", "a") for i, t in rows])).collect()
    want = brute_components(rows)
    assert {row["doc_id"]: (row["n_shingles"], row["component_id"]) for row in out} == want
    assert all(row["kept"] == (row["doc_id"] == row["component_id"]) for row in out)


def test_near_dedup_on_tables(documents, local, odd):
    out = near_dedup.group_near_copies(documents).collect()
    want = brute_components(zip(local.doc_id, local.text, strict=True))
    assert {row["doc_id"]: (row["n_shingles"], row["component_id"]) for row in out} == want
    found = near_dedup.group_near_copies(odd).collect()
    assert len(found) == 12
    assert {(r["doc_id"], r["component_id"]) for r in found if r["doc_id"] in (1, 2, 3, 4, 5, 9, 10)} == {
        (1, 1), (2, 1), (3, 3), (4, 4), (5, 5), (9, 9), (10, 9)
    }
    assert near_dedup.group_near_copies(odd.limit(0)).count() == 0


def near_texts(name):
    """Three texts of 100 words: the first is like the second and the second like the third only."""
    words = [f"{name}{k}" for k in range(100)]
    return [" ".join(own) for own in ([*words[:93], *(f"{name}y{k}" for k in range(7))], words, [f"{name}z{k}" for k in range(7)] + words[7:])]


def test_text_without_id_links_documents(spark):
    one, bridge, two = near_texts("w")
    rows = [(1, one), (None, bridge), (2, two), (3, "another text"), (None, near_texts("v")[0]), (None, near_texts("v")[1])]
    assert brute_components([(1, one), (2, two)])[2][1] == 2  # not alike by themselves
    out = near_dedup.group_near_copies(table(spark, [(i, t, "en", "a") for i, t in rows])).collect()
    found = sorted(((r["doc_id"], r["component_id"]) for r in out), key=str)
    assert found == sorted([(1, 1), (None, 1), (2, 1), (3, 3), (None, None), (None, None)], key=str)


def test_components(spark):
    draw = random.Random(8)
    links = [(draw.randrange(400), draw.randrange(400)) for _ in range(230)] + [(k, k + 1) for k in range(1000, 1100)]
    links = [(min(link) - 50, max(link)) for link in links]
    parent = {}

    def find(k):
        while parent.get(k, k) != k:
            k = parent[k]
        return k

    for a, b in links:
        low, high = sorted((find(a), find(b)))
        if low != high:
            parent[high] = low
    want = {k: find(k) for link in links for k in link}
    frame = spark.createDataFrame(links, "a long, b long")
    found = near_dedup.components(frame).collect()
    assert len(found) == len(want) and {row["node"]: row["root"] for row in found} == want
    assert near_dedup.components(frame.limit(0)).count() == 0


def boilerplate(n, seed):
    """Texts that share most of their words by passages, and near copies of some of them."""
    draw = random.Random(seed)
    common = [" ".join(f"c{p}x{k}" for k in range(60)) for p in range(4)]
    rows = []
    for i in range(n):
        own = " ".join(f"o{i}x{k}" for k in range(40))
        rows.append((i, " ".join([*draw.sample(common, 2), own])))
    for i in range(n, n + n // 10):
        words = rows[draw.randrange(n)][1].split()
        words[draw.randrange(len(words))] = "changed"
        rows.append((i, " ".join(words)))
    return rows


def test_shared_passages_make_no_pairs(spark):
    """Half of each text is common to hundreds of others; only true candidates meet."""
    rows = boilerplate(600, 4)
    out = near_dedup.group_near_copies(table(spark, [(i, t, "en", "a") for i, t in rows])).collect()
    assert {row["doc_id"]: (row["n_shingles"], row["component_id"]) for row in out} == brute_components(rows)
    for n in (300, 1200):
        some = boilerplate(n, 5)
        sets = spark.createDataFrame(
            [(i, sorted(map(hash, shingles(t)))) for i, t in some], "class long, shingles array<bigint>"
        )
        classes = sets.selectExpr("class", "class as own")
        pairs = near_dedup.candidates(classes, sets, 85)
        asked = {(row["a"], row["b"]) for row in pairs.collect()}
        own = {i: shingles(t) for i, t in some}
        held = defaultdict(set)
        for i, words in own.items():
            for one in words:
                held[one].add(i)
        linked = {
            (a, b)
            for i, words in own.items()
            for a, b in {(min(i, j), max(i, j)) for one in words if len(held[one]) < 50 for j in held[one] if j != i}
            if 100 * len(own[a] & own[b]) >= 85 * len(own[a] | own[b])
        }
        assert linked <= asked and len(asked) < n  # in proportion to the texts


def test_packing_plan():
    def best_fit(sizes, capacity):
        rooms = []
        for size in sorted(sizes, reverse=True):
            fit = [k for k, room in enumerate(rooms) if room >= size]
            k = min(fit, key=lambda k: rooms[k]) if fit else len(rooms)
            rooms[k : k + 1] = [(rooms[k] if fit else capacity) - size]
        return len(rooms)

    draw = random.Random(1)
    for _ in range(200):
        capacity = draw.choice([20, 50, 100])
        sizes = [draw.randint(1, capacity) for _ in range(draw.randint(0, 60))]
        assert sum(n for _, n in packing.best_fit(Counter(sizes), capacity)) == best_fit(sizes, capacity)
        fixed, left = packing.reduce(Counter(sizes), capacity)
        plan = fixed + packing.best_fit(left, capacity)
        assert Counter(s for p, n in plan for _ in range(n) for s in p) == Counter(sizes)
        assert all(sum(p) <= capacity for p, _ in plan)


def exact_bins(sizes, capacity):
    sizes = sorted(sizes, reverse=True)
    best = [len(sizes)]

    def place(k, rooms):
        if len(rooms) >= best[0]:
            return
        if k == len(sizes):
            best[0] = len(rooms)
            return
        for room in set(rooms):
            if room >= sizes[k]:
                rest = list(rooms)
                rest.remove(room)
                place(k + 1, rest + [room - sizes[k]])
        place(k + 1, rooms + [capacity - sizes[k]])

    place(0, [])
    return best[0]


def test_fixed_sets_keep_the_optimum():
    draw = random.Random(4)
    for _ in range(120):
        sizes = [draw.randint(3, 20) for _ in range(draw.randint(1, 9))]
        fixed, left = packing.reduce(Counter(sizes), 20)
        assert sum(n for _, n in fixed) + exact_bins(list(left.elements()), 20) == exact_bins(sizes, 20)


def test_equal_sets_are_fixed_in_bulk():
    lengths = Counter({1001: 8000, 1000: 3001, **{size: 40 for size in range(525, 1000, 5)}})
    fixed, left = packing.reduce(lengths, 2048)
    assert len(fixed) <= 3 * len(lengths)
    plan = packing.plan(lengths, 2048)
    packed = Counter()
    for pattern, times in plan:
        assert sum(pattern) <= 2048
        for size in pattern:
            packed[size] += times
    assert packed == lengths
    assert len(packing.plan(Counter({600: 3_000_000, 700: 1_000_000}), 2048)) < 10


def test_blank_runs_and_special_strings(spark):
    texts = [" " * 2_000_000, "\n" * 2_000_000, "<|endoftext|>", "a <|endoftext|>b"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = defaultdict(list)
    for row in packing.pack_documents(df).collect():
        found[row["doc_id"]].append(row)
    assert found[2][0]["length"] == 2
    assert found[2][0]["ids_crc32"] == zlib.crc32(np.array([50256, 0], "<u4").tobytes())
    assert found[3][0]["length"] == 5
    assert all(sum(row["length"] for row in found[k]) > 1000 for k in (0, 1))


def test_packing_round_trip(odd, documents, local):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    encoder = Tokenizer.from_file(path("byte_bpe_50k.json"))
    out = packing.pack_documents(documents).toPandas()
    by = {i: g.sort_values("piece") for i, g in out.groupby("doc_id")}
    for i, text in zip(local.doc_id, local.text, strict=True):
        ids, own = np.array([*encoder.encode(text or "", add_special_tokens=False).ids, 0], "<u4"), by[i]
        assert own.length.sum() == len(ids) and (own.length.iloc[1:] == 2048).all()
        for row in own.itertuples():
            assert zlib.crc32(ids[row.start : row.start + row.length].tobytes()) == row.ids_crc32
    for frame in (out, packing.pack_documents(odd, capacity=16).toPandas()):
        for _, own in frame.groupby("sequence_id"):
            own = own.sort_values("offset")
            assert (own.offset.to_numpy() == own.length.cumsum().to_numpy() - own.length.to_numpy()).all()
    assert frame.groupby("sequence_id").length.sum().max() <= 16
    assert packing.pack_documents(odd.limit(0)).count() == 0


def test_fingerprints(spark, odd, documents, local):
    ends = fingerprints.range_ends(documents.select("doc_id"), 30)
    assert len(ends) > 3
    for rows in (30, 100_000):
        both = fingerprints.with_next(documents.select("doc_id", "text"), rows)
        following = {r["doc_id"]: r["next_text"] for r in both.select("doc_id", "next_text").collect()}
        ordered = local.sort_values("doc_id", ascending=False)
        assert following == dict(zip(ordered.doc_id, np.roll(ordered.text, -1), strict=True))
    out = fingerprints.edited_fingerprints(documents).toPandas().set_index("doc_id")
    off = []
    for k, (i, text) in enumerate(zip(ordered.doc_id, ordered.text, strict=True)):
        after = ordered.text.iloc[(k + 1) % len(ordered)]
        edited = text[: len(text) - len(text) // 3] + after[: len(text) // 3]
        assert out.edited_sha256[i] == hashlib.sha256(edited.encode()).hexdigest()
        a, b = shingles(text), shingles(edited)
        off.append(out.near_edited[i] - len(a & b) / len(a | b))
    assert abs(np.mean(off)) < 0.02 and np.mean(np.square(off)) ** 0.5 < 0.06
    prints = defaultdict(set)
    for i, text in zip(local.doc_id, local.text, strict=True):
        prints[text].add(out.fingerprint[i])
    assert all(len(found) == 1 for found in prints.values())
    found = fingerprints.edited_fingerprints(odd).toPandas()
    assert len(found) == 12 and found.near_edited.between(0, 1).all() and (found.fingerprint == "").sum() == 4
    assert fingerprints.edited_fingerprints(odd.limit(0)).count() == 0


def test_fingerprint_bins_by_hand(spark):
    """Bins against plain Python over the same hashes, empty bins included."""
    rows = spark.createDataFrame([(" ".join(f"t{k}" for k in range(n)),) for n in (1, 4, 5, 9, 40, 400)], "text string")
    made = rows.select(
        fingerprints.shingle_hashes(fingerprints.word_hashes(F.col("text"))).alias("h"),
        fingerprints.fingerprint(F.col("text")).alias("bins"),
    ).collect()
    draws = spark.range(fingerprints.BINS).withColumnRenamed("id", "a").crossJoin(spark.range(fingerprints.BINS))
    draws = draws.select(F.col("a").cast("int").alias("a"), F.col("id").cast("int").alias("b"))
    draws = {(r["a"], r["b"]): r["d"] for r in draws.select("a", "b", F.xxhash64("a", "b").alias("d")).collect()}
    for row in made:
        held = {}
        for value in sorted(row["h"]):
            held.setdefault((value % 2**64) >> (64 - fingerprints.BIN_BITS), value)
        for number, value in enumerate(row["bins"]):
            donor = number if number in held else min(held, key=lambda b: draws[number, b])  # noqa: B023
            assert value == held[donor] & 255


def test_url_filter(spark):
    urls = [
        ("https://A.Example.NET/en/x", "a.example.net", "/en/x", "example.net/en/", "allow"),
        ("http://example.net/de/x?q", "example.net", "/de/x", "net/", "block"),
        ("http://notexample.com/de/", "notexample.com", "/de/", None, None),
        ("http://a.example.com/de/", "a.example.com", "/de/", "example.com/de/", "block"),
        ("x://org/fr/#y", "org", "/fr/", "org/fr/", "allow"),
        ("x://www.org?fr", "www.org", "", None, None),
        ("http://net", "net", "", None, None),
        ("no scheme", "", "", None, None),
        (None, "", "", None, None),
        ("", "", "", None, None),
        ("http://best-casino-pills.test/" + "a" * 100_000, "best-casino-pills.test", "/" + "a" * 100_000, None, "block"),
        ("http://library.example.org/a\nb", "library.example.org", "/a\nb", None, "allow"),
    ]
    pages = spark.createDataFrame([(k, u[0], "x", "y") for k, u in enumerate(urls)], "page_id long, url string, host string, label string")
    out = url_filter.judge_urls(pages).orderBy("page_id").collect()
    for row, (_, host, path, rule, verdict) in zip(out, urls, strict=True):
        assert (row["host"], row["path"], row["rule"]) == (host, path, rule)
        assert row["verdict"] in ("allow", "block") and verdict in (None, row["verdict"])
    assert url_filter.judge_urls(pages.limit(0)).count() == 0


def test_url_scorer_on_hosts_left_out(spark):
    rows = url_filter.labelled_urls(spark).toPandas()
    host = rows.url.str.extract(r"://(?:www\.|blog\.|m\.)?([^.]+)")[0]
    held = host.map(lambda h: zlib.crc32(h.encode()) % 4 == 0)
    out = url_filter.judge_urls(
        spark.createDataFrame(rows[held]), rules=(), labelled=spark.createDataFrame(rows[~held])
    ).toPandas()
    # Hosts made of words that no other host has can't be told, so only a part of the unwanted is found.
    assert ((out.verdict == "block") == (out.label == 1)).mean() > 0.65
    assert (out.verdict[out.label == 0] == "allow").mean() > 0.8


def test_url_scorer_on_pages(spark):
    """Hosts of the sample that the labelled table doesn't know."""
    out = url_filter.judge_urls(spark.read.parquet(f"{SF}/pages.parquet"), rules=()).toPandas()
    unwanted = out.host.str.contains("casino|pills|ads-|adult|spam|bets")
    assert (out.verdict[~unwanted] == "allow").mean() > 0.97
    assert (out.verdict[unwanted] == "block").mean() > 0.5


def test_language_id(documents, odd):
    held = documents.withColumn("held", fold("doc_id", 3) == 1)
    model = language_id.fit(held.where("not held"), per_language=40, rounds=2)
    out = held.where("held").withColumn("r", language_id.identify(model)(F.col("text"))).toPandas()
    assert (out.r.map(lambda r: r["lang_pred"]) == out.lang).mean() > 0.95
    found = odd.withColumn("r", language_id.identify(model)(F.col("text"))).collect()
    for row in found:
        letters = any(c.isalpha() for c in row["text"] or "")
        assert (row["r"]["lang_pred"] != "und") == letters and 0 <= row["r"]["score"] <= 1
    none = language_id.fit(odd.where("lang = 'none'"))
    assert {r[0][0] for r in odd.select(language_id.identify(none)(F.col("text"))).collect()} == {"und"}
    assert odd.limit(0).select(language_id.identify(model)(F.col("text"))).count() == 0


def test_all_segmentations_count():
    """The forward sums against every segmentation of a short word, short and long way."""
    pieces = language_id.load_pieces()
    probability = np.random.default_rng(0).random((len(pieces.keys), 2)) / 100
    model = language_id.Model(pieces, ["a", "b"], probability)
    word = b" there"
    known = {(s, e): n[0] for s, e, _, n in language_id._steps(pieces, np.frombuffer(word, np.uint8)[None].astype(np.uint64))}

    def ways(at):
        if at == len(word):
            return np.ones(2)
        return sum((probability[n] * ways(e) for (s, e), n in known.items() if s == at), np.zeros(2))

    logs, uses = language_id.word_logs(model, [word], np.ones((1, 2)))
    assert np.allclose(np.exp(logs[0]), ways(0))
    long_uses = np.zeros_like(uses)
    assert np.allclose(language_id._long_word(model, word, long_uses, np.ones(2)), logs[0])
    assert np.allclose(uses, long_uses)
    lengths = sum(uses[n] * size for n, size in {n: e - s for (s, e), n in known.items()}.items())
    assert np.allclose(lengths, len(word))  # the expected uses cover every byte once
    assert np.isfinite(language_id.word_logs(model, [b"x" * 5000])[0]).all()


def test_toxicity(spark, odd):
    draw = random.Random(3)
    bad = {"en": ["idiot", "moron"], "fr": ["cretin", "nul"]}
    rows = []
    for k in range(900):
        lang, toxic = draw.choice(["en", "fr"]), int(draw.random() < 0.2)
        words = [f"w{draw.randrange(3000)}" for _ in range(60)]
        for _ in range(3 * toxic):
            words[draw.randrange(60)] = draw.choice(bad[lang])
        rows.append((k, " ".join(words), lang, toxic))
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int")
    model = toxicity.fit(frame.where("doc_id < 700"))
    out = frame.where("doc_id >= 700").withColumn("score", toxicity.scorer(model)(F.col("text"))).toPandas()
    assert ((out.score >= 0.3) == (out.toxic == 1)).mean() > 0.95
    scores = [row[0] for row in odd.select(toxicity.scorer(model)(F.col("text"))).collect()]
    assert len(scores) == 12 and all(0 <= s <= 1 for s in scores)
    none = toxicity.fit(frame.where("toxic = 7"))
    assert {row[0] for row in odd.select(toxicity.scorer(none)(F.col("text"))).collect()} == {0.0}
    assert odd.limit(0).select(toxicity.scorer(model)(F.col("text"))).count() == 0


def test_weak_labels(spark, documents, odd):
    model = weak_labels.fit(documents)
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality")
    out = documents.join(labels, "doc_id").withColumn("r", weak_labels.judge(model)(F.col("text"))).toPandas()
    assert ((out.r.map(lambda r: r["score"]) >= 0.5) == (out.quality == 1)).mean() > 0.95
    found = odd.withColumn("r", weak_labels.judge(model)(F.col("text"))).collect()
    assert len(found) == 12 and all(0 <= r["r"]["score"] <= 1 and 0 <= r["r"]["weak"] <= 1 for r in found)
    assert {r["r"]["votes"] for r in found if not (r["text"] or "").split()} == {0}
    none = weak_labels.fit(odd.limit(0))
    assert odd.limit(0).select(weak_labels.judge(none)(F.col("text"))).count() == 0


def test_labellers_accuracies():
    """Votes drawn from known accuracies give these back."""
    draw = np.random.default_rng(0)
    count, names = 40_000, len(weak_labels.LABELLERS)
    good = draw.random(count) < 0.7
    accuracy = np.linspace(0.7, 0.95, names)
    right, silent = draw.random((count, names)) < accuracy, draw.random((count, names)) < 0.2
    votes = np.where(silent, 0, np.where(right == good[:, None], weak_labels.GOOD, weak_labels.BAD))
    patterns = votes @ (3 ** np.arange(names - 1, -1, -1))
    labels = weak_labels.estimate(dict(zip(*np.unique(patterns, return_counts=True), strict=True)))
    assert abs(labels.prior - 0.7) < 0.02
    assert np.allclose(labels.odds[0, :, weak_labels.GOOD], 0.8 * accuracy, atol=0.02)
    assert np.allclose(labels.odds[1, :, weak_labels.BAD], 0.8 * accuracy, atol=0.02)


@pytest.fixture
def small_buckets(monkeypatch):
    """Many chunks and buckets, so that every way through the model is taken (workers get functions, not globals)."""
    monkeypatch.setattr(pitman_yor, "BUCKET_TOKENS", 10_000)


def brute_base(rows):
    words = {i: [*(t or "").encode().lower().split(), b"\n"] for i, t, _ in rows}
    counts = Counter(w for i, _, train in rows if train for w in words[i])
    n, v = sum(counts.values()), len(counts)
    return {i: (len(w), sum(counts[x] > 0 for x in w), n, sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w)) for i, w in words.items()}


def test_pitman_yor(documents, odd, small_buckets):
    docs = documents.withColumn("train", fold("doc_id", 7) != 2)
    out = pitman_yor.score_documents(docs).toPandas().set_index("doc_id")
    want = brute_base([(r["doc_id"], r["text"], r["train"]) for r in docs.collect()])
    assert set(out.index) == set(want)
    for i, (n, known, tokens, base) in want.items():
        row = out.loc[i]
        assert (row.n_tokens, row.n_known, row.train_tokens) == (n, known, tokens)
        assert math.isclose(row.base_score, base, rel_tol=1e-9)
    held = out[out.held_out]
    assert len(held) and held.score.sum() > held.base_score.sum()
    again = pitman_yor.score_documents(docs.select("doc_id", "text", "train")).toPandas().set_index("doc_id")
    assert np.allclose(again.score.sort_index(), out.score.sort_index(), rtol=0.02)
    found = pitman_yor.score_documents(odd.withColumn("train", F.lit(True))).toPandas()
    assert len(found) == 12 and (found.n_tokens[found.doc_id == 3] == 1).all() and (found.score < 0).all()
    alike = found[found.doc_id == 2].score
    assert alike.nunique() == 1
    nothing = pitman_yor.score_documents(odd.withColumn("train", F.lit(False))).toPandas()
    assert (nothing.train_tokens == 0).all() and (nothing.n_known == 0).all()
    assert pitman_yor.score_documents(odd.limit(0).withColumn("train", F.lit(True))).count() == 0


def test_scores_do_not_depend_on_the_number_of_buckets(documents, monkeypatch):
    docs = documents.withColumn("train", fold("doc_id", 7) != 2)
    found = []
    for size in (10**9, 1_000):  # one bucket, 80 of them
        monkeypatch.setattr(pitman_yor, "BUCKET_TOKENS", size)
        out = pitman_yor.score_documents(docs).toPandas().set_index("doc_id").sort_index()
        found.append(out.score / out.n_tokens)
    off = found[1] - found[0]
    assert off.abs().mean() < 0.006 and abs(off.mean()) < 0.003


def test_probabilities_sum_to_one(spark):
    """Over all known words and one unknown, after the same context."""
    rows = [(k, "a b a c a b d", True) for k in range(20)]
    words = ["a", "b", "c", "d", "zzz"]
    rows += [(100 + k, f"a {w}", False) for k, w in enumerate(words)] + [(200, "a", False)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, train boolean")
    out = {r["doc_id"]: r["score"] for r in pitman_yor.score_documents(frame).collect()}
    single = spark.createDataFrame([*rows, *((300 + k, w, False) for k, w in enumerate(words))], frame.schema)
    alone = {r["doc_id"]: r["score"] for r in pitman_yor.score_documents(single).collect()}
    assert math.isclose(out[200], alone[200], abs_tol=1e-9)
    assert out[101] > out[102] > out[104]  # b after a is more usual than c, and unknown words come last


def test_squeezed_arrays():
    draw = np.random.default_rng(1)
    for kind in (np.int8, np.int32, np.int64, np.uint64, np.float32):
        values = (draw.random(100) * 100).astype(kind)
        assert (pitman_yor.expand(pitman_yor.squeeze(values), kind) == values).all()
    values = np.unique(draw.integers(0, 1 << 63, 100, np.uint64) * np.uint64(2))
    assert (pitman_yor.expand_sorted(pitman_yor.squeeze_sorted(values)) == values).all()


def test_pipeline_stages(spark, documents, odd):
    docs = documents
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != "packing":
            assert out.columns == documents.columns
            rows = out.collect()
            assert rows
            docs = spark.createDataFrame(rows, documents.schema)
    whole = odd.select(*documents.columns)
    kept = corpus_pipeline.dedup_stage(spark, whole, SF).collect()
    assert sorted(r["doc_id"] for r in kept if r["doc_id"]) == [1, 3, 4, 5, 7, 8, 9] and len(kept) == 9
    mixed = corpus_pipeline.mixing_stage(spark, whole, SF).withColumn("n", mixing.word_count(F.col("text")))
    direct = mixing.mix(whole).agg(F.sum("taken")).first()[0]
    assert mixed.agg(F.sum("n")).first()[0] == direct
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, whole, SF).collect() is not None
        assert stage(spark, whole.limit(0), SF).count() == 0


def test_dedup_stage_keeps_one_row_of_each_group(spark, documents):
    """Ids that collide and null ids, against sets of texts that may stay."""
    (a, b, c), (p, q, _), (x, y, _) = near_texts("a"), near_texts("p"), near_texts("x")
    rows = [(1, a), (5, b), (5, "a clean text"), (6, "first of two"), (6, "second of two"), (None, c), (None, a)]
    rows += [(None, p), (None, q), (None, q), (7, x), (7, y), (7, x), (None, None), (8, ""), (None, "alone")]
    want = [(1, {a}), (5, {"a clean text"}), (6, {"first of two"}), (6, {"second of two"}), (None, {p, q})]
    want += [(7, {x, y}), (None, {None}), (8, {""}), (None, {"alone"})]
    whole = table(spark, [(i, t, "en", "s") for i, t in rows]).select(*documents.columns)
    out = [(r["doc_id"], r["text"]) for r in corpus_pipeline.dedup_stage(spark, whole, SF).collect()]
    again = [(r["doc_id"], r["text"]) for r in corpus_pipeline.dedup_stage(spark, whole.repartition(3), SF).collect()]
    assert sorted(out, key=str) == sorted(again, key=str)
    assert len(out) == len(want)
    for number, texts in want:
        assert sum(i == number and t in texts for i, t in out) == 1


def test_smallest_by_hash(spark):
    rows = spark.range(5000).selectExpr("id as doc_id", "if(id % 10 = 0, 'rare', 'often') as lang")
    found = smallest_by_hash(rows, "lang", 100).collect()
    assert Counter(row["lang"] for row in found) == {"rare": 100, "often": 100}
    assert {row["doc_id"] for row in smallest_by_hash(rows, "lang", 10_000).collect()} == set(range(5000))


def test_every_query_is_registered():
    assert [int(name[2:].split("_")[0]) for name in queries.QUERIES] == list(range(1, 14))
    assert len(corpus_pipeline.STAGES) == 5

def test_next_texts_with_and_without_ids(spark):
    """Every mix of ids, null ids and repeated rows, in ranges of two rows, against a sorted list."""
    draw = random.Random(3)
    for kind in ("long", "string"):
        for named, nameless in ((0, 0), (1, 0), (0, 1), (12, 0), (0, 15), (13, 14), (9, 1), (30, 3)):
            rows = [(draw.randrange(20), f"text {draw.randrange(40)}") for _ in range(named)]
            rows += [(None, draw.choice(["", f"none {draw.randrange(9)}"])) for _ in range(nameless)]
            rows = [(None if i is None else i if kind == "long" else f"id{i:02d}", t) for i, t in rows]
            df = spark.createDataFrame(rows, f"doc_id {kind}, text string")
            hashed = df.select("doc_id", "text", F.shiftrightunsigned(F.xxhash64("text"), 1).alias("h")).collect()
            with_id = sorted((r for r in hashed if r["doc_id"] is not None), key=lambda r: r["text"])
            with_id = sorted(with_id, key=lambda r: r["doc_id"], reverse=True)
            order = [(r["doc_id"], r["text"]) for r in with_id]
            order += [(None, r["text"]) for r in sorted((r for r in hashed if r["doc_id"] is None), key=lambda r: (r["h"], r["text"]))]
            want = Counter((i, t, order[(k + 1) % len(order)][1]) for k, (i, t) in enumerate(order))
            found = fingerprints.with_next(df, 2).select("doc_id", "text", "next_text").collect()
            assert Counter(map(tuple, found)) == want, (kind, named, nameless)
    many = spark.range(300).selectExpr("cast(null as bigint) as doc_id", "concat('t', id) as text")
    assert len(fingerprints.hash_starts(many, 10)) > 20  # not one range
