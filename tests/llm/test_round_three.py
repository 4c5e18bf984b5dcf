"""Centroid clustering, conversation repair and token files on small tables and against brute force."""

from __future__ import annotations

import hashlib
import json
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from threadloom.llm import centroid_clusters as cc
from threadloom.llm import conversation_repair as cr
from threadloom.llm import queries, token_files
from threadloom.llm.tokens import VOCABULARY, Encoder

SF = "/root/testdata/sf0.001"


# Centroid clustering ------------------------------------------------------------------------------


def test_popcounts_are_dot_products():
    rng = np.random.default_rng(3)
    for size in (1, 2, 300, (1 << 25) - 1):
        ours, theirs = rng.integers(-size, size + 1, (50, 64)), rng.integers(-size, size + 1, (7, 64))
        planes = cc.pack(ours, cc.needed(ours))
        assert (cc.unpack(planes) == ours).all()
        assert (cc.dots(planes, cc.pack(theirs, cc.needed(theirs))) == ours @ theirs.T).all()
        cluster, distance = cc.nearest(planes, (ours * ours).sum(axis=1), theirs)
        far = ((ours[:, None] - theirs[None]) ** 2).sum(axis=2)
        assert (cluster == far.argmin(axis=1)).all() and (distance == far.min(axis=1)).all()


def test_planes_hold_the_extremes():
    for low, high, planes in ((0, 0, 1), (-1, 0, 1), (0, 1, 2), (-2, 1, 2), (-3, 0, 3), (0, 255, 9), (-256, 255, 9)):
        whole = np.full((2, 64), low)
        whole[1] = high
        assert cc.needed(whole) == planes
        assert (cc.unpack(cc.pack(whole, planes)) == whole).all()


def lloyd(rows, clusters, rounds):
    """The plain loop: (id, components) in, id to (cluster, distance) and the centroids out."""
    order = sorted(rows, key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centres = [list(r[1]) for r in order[:clusters]]

    def place(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), k) for k, c in enumerate(centres))

    for _ in range(rounds):
        groups = defaultdict(list)
        for _, x in rows:
            groups[place(x)[1]].append(x)
        for k, held in groups.items():
            centres[k] = [sum(column) // len(held) for column in zip(*held)]
    return [(i, *place(x)[::-1]) for i, x in rows], centres


def test_clusters_against_a_plain_loop(spark):
    rng = random.Random(1)
    rows = [(k, [rng.gauss(k % 5, 0.4) for _ in range(64)]) for k in range(120)]
    rows += [(7, rows[7][1]), (7, rows[8][1]), (None, rows[9][1]), (200, [1e30] * 64), (201, [-0.0] * 64)]
    bad = [(300, [1.0] * 63), (301, [1.0] * 65), (302, None), (303, [None] + [1.0] * 63), (304, [float("nan")] + [1.0] * 63), (305, [float("inf")] * 64), (306, [])]
    df = spark.createDataFrame([(i, x, "a", 1) for i, x in rows + bad], "vec_id long, embedding array<double>, cluster string, distance int")
    most = (1 << 25) - 1
    whole = [(i, [int(max(-most, min(most, 256 * v)) // 1) for v in x]) for i, x in rows]
    expected, centres = lloyd(whole, 6, 3)
    found = cc.cluster_vectors(df.repartition(5), clusters=6, rounds=3).collect()
    assert sorted(((r["vec_id"], r["cluster"], r["distance"]) for r in found), key=repr) == sorted(expected, key=repr)
    for r in found:
        inside = [d for _, c, d in expected if c == r["cluster"]]
        assert r["cluster_inertia"] == sum(inside) and r["inertia"] == sum(d for _, _, d in expected)
        assert r["centroid"] == centres[r["cluster"]]


def test_few_and_no_vectors(spark):
    df = spark.createDataFrame([(1, [0.5] * 64), (1, [0.5] * 64), (2, [0.25] * 64)], "vec_id long, embedding array<float>")
    found = cc.cluster_vectors(df).collect()
    assert {(r["vec_id"], r["distance"]) for r in found} == {(1, 0), (2, 0)} and len(found) == 3
    assert cc.cluster_vectors(df.limit(0)).collect() == []
    assert cc.cluster_vectors(df.where("vec_id > 5")).columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"]


# Conversation repair ------------------------------------------------------------------------------


def all_repairs(kinds, most_inserts=2):
    """Every derivation up to two insertions in a row, by plain recursion."""
    out = []

    def go(i, state, run, cost, audit):
        if i == len(kinds) and state in cr.WELL_FORMED:
            out.append((cost, audit))
        if run < most_inserts:
            go(i, cr.STEP[cr.next_role(state)[0]][state], run + 1, cost + 5, audit + "I")
        if i < len(kinds):
            for more, letter, initial in cr.edits(kinds[i]):
                then = state if initial is None else cr.STEP[initial][state]
                if then is not None:
                    go(i + 1, then, 0, cost + more, audit + letter)

    go(0, cr.EMPTY, 0, 0, "")
    return min(out)


def test_lightest_is_least_of_all():
    rng = random.Random(4)
    for _ in range(250):
        kinds = "".join(rng.choice("suaxSUAXd") for _ in range(rng.randint(0, 5)))
        assert cr.lightest(kinds)[None] == all_repairs(kinds), kinds


def test_blocks_join_to_the_whole():
    rng = random.Random(5)
    for _ in range(200):
        kinds = "".join(rng.choice("uauasuaxSUAXd") for _ in range(rng.randint(0, 40)))
        chain, cuts = cr.Chain(), sorted(rng.choices(range(len(kinds) + 1), k=3))
        pieces = [kinds[a:b] for a, b in zip([0, *cuts], [*cuts, len(kinds)])]
        for n, piece in enumerate(pieces):
            costs, places = [], []
            for start in range(4):
                ends = cr.derive(piece, start, True)
                order = sorted(audit for _, audit in ends.values())
                costs += [ends[q][0] if q in ends else -1 for q in range(4)]
                places += [order.index(ends[q][1]) if q in ends else -1 for q in range(4)]
            empty = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0) | {"first": None, "low": None}
            chain.add({"part": 0, "block": n, "costs": costs, "places": places, **empty})
        picked = list(chain.picked())
        audit = "".join(cr.derive(p, r["enter"], True)[r["leave"]][1] for p, r in zip(pieces, picked))
        audit += cr.ending(picked[-1]["leave"])[1]
        assert (picked[-1]["sums"]["cost"], audit) == cr.lightest(kinds)[None]


def plain_digest(rows):
    """(turn, role, text) in order to the contract's columns, with one derivation for the whole conversation."""
    roles, texts, turns = ([r[k] for r in rows] for k in (1, 2, 0))
    j = cr.judge(roles, texts, turns)
    cost, audit = cr.lightest(j.kinds)[None]
    left = "\n".join(f"{role}:{text}" for role, text in cr.replay(audit, roles, texts))
    known = {t for t in turns if t is not None}
    holes = max(known) - min(known) + 1 - len(known) if known else 0
    return (holes, j.blank, j.duplicate, j.truncated, j.illegal, cost, audit, hashlib.sha256(left.encode()).hexdigest())


def digest_rows(df):
    return {r["conv_id"]: tuple(r[name] for name in [*cr.COUNTS, "audit", "repaired_sha256"]) for r in cr.digests(df).collect()}


@pytest.mark.parametrize(("block_rows", "part_bytes"), [(256, 1 << 24), (4, 1 << 24), (3, 700), (1, 200)])
def test_conversations_at_every_block_size(spark, block_rows, part_bytes):
    rng = random.Random(8)
    words = ["Yes.", "No", "Why?", " ", "", "So it is.", "Once. ", "und?", "x" * 300 + "."]
    rows = []
    for conv in [None, *range(12)]:
        for turn in range(rng.choice([1, 2, 7, 40])):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            rows.append((conv, rng.choice([turn, turn, turn, turn + 90]), role, rng.choice([f"Say {turn}.", *words, None]), "z"))
    rows += [(3, None, "user", "Null turn."), (3, None, "user", "Null turn."), (99, None, None, None), (98, 2, "user", "Gone.")]
    rows = [(*row[:4], "z", not (row[0] == 98)) for row in rows]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, part string, present boolean")
    hashed = df.select("*", F.xxhash64(F.coalesce("text", F.lit(" "))).alias("h")).collect()
    by = defaultdict(list)
    for r in hashed:
        role, text = (" " if v is None else v for v in (r["role"], r["text"]))
        by[r["conv_id"]].append(((r["turn"] is not None, r["turn"] or 0, role, r["h"], text), (r["turn"], role, text)))
    expected = {conv: plain_digest([row for _, row in sorted(held)]) for conv, held in by.items()}
    expected[98] = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    repair = cr.repair_conversations(df, present=F.col("present"), block_rows=block_rows, part_bytes=part_bytes)
    assert digest_rows(repair) == expected
    left = defaultdict(list)
    for r in cr.repaired_rows(repair).collect():
        left[r["conv_id"]].append(((r["part"], r["block"], r["position"]), f"{r['role']}:{r['text']}"))
    for conv, found in expected.items():
        text = "\n".join(line for _, line in sorted(left[conv]))
        assert hashlib.sha256(text.encode()).hexdigest() == found[-1]


def test_no_conversations(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert cr.digests(cr.repair_conversations(df)).collect() == []
    assert cr.digests(cr.repair_conversations(cr.damage(df), present=F.col("present"))).collect() == []


# Token files --------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path(VOCABULARY))


def test_encoder_equals_the_library(library):
    encoder = Encoder(public_tokenizers.path(VOCABULARY))
    rng = random.Random(2)
    pool = "ab1 .'st\n\t\x1c\x85\xa0éß½²٣Ωя中文“”…​ 𝒜😀\x00"
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    texts += ["<|endoftext|>", "a <|endoftext|> b", "<|endoftext", " " * 100_000, "\n" * 100_000, "x" * 20_000, "don't I'll 'tis"]
    texts += [f"a{chr(c)}1{chr(c)} {chr(c)}." for c in range(0x3100) if not 0xD800 <= c < 0xE000]
    for text in texts + texts[:50]:
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text[:80]


@pytest.mark.parametrize("part_bytes", [1 << 24, 3000])
def test_token_files_round_trip(spark, library, tmp_path, part_bytes):
    rows = [(k * 7 % 100, f"text number {k} " * (k % 9)) for k in range(100)]
    rows += [(5, "again"), (5, "again"), (None, "no key"), (None, None), (1000, None), (1001, ""), (1002, "long text here " * 20_000)]
    rows += [(50, "copies")] * 300
    df = spark.createDataFrame([(i, t, "x", 0) for i, t in rows], "doc_id long, text string, start string, n_tokens int")
    path = token_files.write_token_files(df.repartition(4), str(tmp_path / "ids"), part_bytes=part_bytes)
    found = [r for r in token_files.read_token_files(spark, path).collect()]
    assert len(found) == len(rows)
    found.sort(key=lambda r: r["start"])
    place = 0
    for r in found:
        assert r["start"] == place and len(r["ids"]) == 4 * r["n_tokens"]
        place += r["n_tokens"]
    keys = [r["doc_id"] for r in found]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0))
    expected = sorted(((i, (*library.encode(t or "", add_special_tokens=False).ids, 0)) for i, t in rows), key=repr)
    assert sorted(((r["doc_id"], tuple(np.frombuffer(r["ids"], "<u4").tolist())) for r in found), key=repr) == expected
    # The files themselves, without the reader.
    folder = tmp_path / "ids"
    manifest = json.loads((folder / "manifest.json").read_text())
    assert manifest["width"] == 2 and manifest["tokens"] == place
    assert len({p.name for p in folder.iterdir() if not p.name.startswith(".")}) == 3 * len(manifest["parts"]) + 1
    if part_bytes == 3000:
        assert len(manifest["parts"]) > 5
        assert max(part["documents"] for part in manifest["parts"]) < 120  # equal keys are dealt over parts
    flat = b""
    for part in manifest["parts"]:
        ids = np.memmap(folder / f"{part['name']}.ids", "<u2")
        offsets = np.memmap(folder / f"{part['name']}.offsets", "<u8")
        assert part["base"] * 2 == len(flat) and offsets[0] == 0 and offsets[-1] == len(ids) == part["tokens"]
        assert len(offsets) == part["documents"] + 1
        flat += ids.tobytes()
    assert flat == b"".join(np.frombuffer(r["ids"], "<u4").astype("<u2").tobytes() for r in found)


def test_token_files_of_nothing(spark, tmp_path):
    df = spark.createDataFrame([], "doc_id string, text string")
    path = token_files.write_token_files(df, str(tmp_path / "none"))
    found = token_files.read_token_files(spark, path)
    assert found.collect() == [] and found.schema["doc_id"].dataType.simpleString() == "string"


def test_wide_ids(spark, tmp_path):
    df = spark.createDataFrame([(1, "a b"), (2, "")], "doc_id long, text string")
    path = token_files.write_token_files(df, str(tmp_path / "wide"), end=70_000)
    found = {r["doc_id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in token_files.read_token_files(spark, path).collect()}
    assert found == {1: [64, 275, 70_000], 2: [70_000]}
    assert json.loads((tmp_path / "wide" / "manifest.json").read_text())["width"] == 4


def test_op13_against_the_library(spark, library):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = {r["doc_id"]: r for r in queries.op13_token_files(spark, SF).collect()}
    place = 0
    for i in sorted(docs):
        ids = np.array([*library.encode(docs[i] or "", add_special_tokens=False).ids, 0], "<u4")
        r = found[i]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (place, len(ids), zlib.crc32(ids.tobytes()))
        place += len(ids)
    assert len(found) == len(docs)


# Language identification: very long words ----------------------------------------------------------


def test_blocks_of_a_long_word_sum_all_segmentations(monkeypatch):
    from threadloom.llm import language_id as li

    pieces = li.load_pieces()
    assert pieces.longest == 33
    probability = np.random.default_rng(0).random((len(pieces.keys), 3)) ** 4 / 1000 + 1e-12
    model = li.Model(pieces, ["a", "b", "c"], probability)
    rng = random.Random(1)
    for length in (1, 5, 47, 48, 49, 96, 500, 3000):
        word = "".join(rng.choice("the  ing日本語のテキスト----========") for _ in range(length)).encode()[:length]
        for block in (1 << 14, 100, 7):
            monkeypatch.setattr(li, "BLOCK", block)
            assert np.allclose(li._blocked_word(model, word), li._long_word(model, word), rtol=1e-10), (length, block)


def test_a_megabyte_without_blanks(spark):
    import time

    from threadloom.llm import language_id as li

    rows = [(k, text, lang) for k, (text, lang) in enumerate([("the cat sat on the mat", "en"), ("das ist ein haus", "de")] * 20)]
    model = li.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    began = time.time()
    logs = next(iter(li.text_logs(model, iter([["thecatsatonthemat" * 60_000, "日本語" * 30_000]]))))
    assert np.isfinite(logs).all() and time.time() - began < 60


def test_words_encoded_in_one_go_have_the_ids_of_each():
    encoder = Encoder(public_tokenizers.path(VOCABULARY))
    special = encoder.special[0]
    words = ["the", " the", "  ", "\n\n", " 12", "é", " naïve", "'ll", "<|", "|>", " <", "a" * 300, "\x00", "日本", "  "]
    assert encoder._each([]) == []
    for some in (words, words[:1], [*words, f"x{special}"], [special, "a"]):
        assert encoder._each(some) == [encoder.whole(word) for word in some]


def test_a_column_is_encoded_in_pieces_without_a_seam():
    import pyarrow as pa

    encoder = Encoder(public_tokenizers.path(VOCABULARY))
    texts = [None if k % 97 == 0 else f"text {k} of many, {'more ' * (k % 5)}" for k in range(1000)]
    assert [*encoder.encode_column(pa.array(texts), b"end")] == [encoder.whole(text or "") + b"end" for text in texts]
