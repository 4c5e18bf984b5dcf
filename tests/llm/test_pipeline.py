"""Every stage of the pipeline, and all of it, against plain Python; clashing columns; long texts."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from test_corpus import brute_components
from tokenizers import Tokenizer

import corpus_pipeline as cp
from threadloom.llm import (
    centroid_clusters,
    conversation_repair,
    fingerprints,
    host_rules,
    language_id,
    mixing,
    near_dedup,
    packing,
    pitman_yor,
    queries,
    token_files,
    toxicity,
    url_filter,
    weak_labels,
)
from threadloom.llm.tokens import VOCABULARY

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ENGLISH = "the a of and house river morning water walks stone child bread letter window under over with from small old".split()
GERMAN = "der die das und haus fluss morgen wasser geht stein kind brot brief fenster unter auf mit von klein alt".split()
FOREIGN = "Tämä on suomenkielinen teksti jossa kerrotaan säästä ja ruoasta sekä monista muista asioista vielä kerran"


def fixture_rows():
    draw = random.Random(11)
    rows = []

    def add(text, lang="en", source=None):
        rows.append((len(rows), text, lang, source or draw.choice(["a", "b", "c", None]), None if text is None else len(text)))

    def prose(words, n):
        return " ".join(draw.choice(words) + (f"{draw.randrange(900)}" if draw.random() < 0.1 else "") for _ in range(n))

    for _ in range(40):
        add(prose(ENGLISH, draw.randint(15, 80)))
        add(prose(GERMAN, draw.randint(15, 80)), "de")
    for k in (0, 1, 8, 9):
        words = rows[k][1].split()
        add(" ".join(words), rows[k][2])
        words[len(words) // 2] = "changed"
        add(" ".join([*words, *words[:0]]), rows[k][2])
    for _ in range(25):
        add("too short", source="bad")
    add(prose(ENGLISH, 60), source="bad")
    add(FOREIGN, None)
    add(None)
    add("", None)
    add("123 456 ! 789", "en")
    add(" ".join(["the same five words again"] * 12))
    add(prose(ENGLISH, 6000), source="long")
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(fixture_rows(), SCHEMA)


def plain_gain(model, pieces):
    """The language and gain of a text by a dictionary of pieces and a plain forward loop."""
    flat = 1 / len(model.pieces.keys)

    def text_logs(text):
        total = [0.0] * (len(model.languages) + 1)
        for word in text.lower().encode().split():
            word = b" " + word
            sums = [[1.0] * len(total)]
            for end in range(1, len(word) + 1):
                now = [0.0] * len(total)
                for start in range(max(0, end - 33), end):
                    place = pieces.get(word[start:end])
                    if place is not None:
                        chances = [*model.probability[place], flat]
                        now = [n + s * c for n, s, c in zip(now, sums[start], chances)]
                sums.append(now)
            total = [t + math.log(s) for t, s in zip(total, sums[-1])]
        return total

    return text_logs


def piece_places(model):
    import base64

    found = {}
    with np.errstate(over="ignore"), open(public_tokenizers.path(language_id.VOCABULARY), "rb") as lines:
        for line in lines:
            piece, held = base64.b64decode(line.split()[0]), np.uint64(0)
            for byte in piece:
                held = language_id._extend(held, np.uint64(byte))
            found[piece] = int(np.searchsorted(model.pieces.keys, held))
    return found


def plain_language(spark, docs):
    model = language_id.fit(docs)
    text_logs = plain_gain(model, piece_places(model))
    kept = set()
    for row in docs.collect():
        if row["text"] and any(c.isalpha() for c in row["text"]):
            *logs, background = text_logs(row["text"])
            share = 1 / sum(math.exp(log - max(logs)) for log in logs)
            if share >= 0.5 and max(logs) > background:
                kept.add(row["doc_id"])
    return kept


def plain_rules(rows):
    connection = duckdb.connect()
    connection.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    connection.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", [tuple(row) for row in rows])
    found = connection.sql(queries.HOST_RULES_SQL)
    at = {name: k for k, name in enumerate(found.columns)}
    return {row[at["doc_id"]] for row in found.fetchall() if row[at["kept"]]}


def plain_mix(spark, docs):
    """Texts that the mix takes: whole copies and the words of the spans, by slicing."""
    out = Counter()
    keyed = docs.select("doc_id", "text", "source", cp._row_key(F.col("text")).alias("key"))
    taken = {row["doc_id"]: row for row in mixing.mix(keyed, doc_id="key").collect()}
    for row in keyed.collect():
        mixed, text = taken[row["key"]], row["text"]
        out[row["doc_id"], text] += mixed["passes"]
        if mixed["spans"]:
            held, place = [], 0
            words = text.split(" ")
            for k, word in enumerate(words):
                held.append(word + (" " if k < len(words) - 1 else ""))
            part = "".join("".join(held[s["start"] : s["start"] + s["length"]]) for s in mixed["spans"])
            out[row["doc_id"], part] += 1
    return +out


def plain_pieces(texts):
    """(doc_id, piece, start, length, crc) of every document."""
    library = Tokenizer.from_file(public_tokenizers.path(VOCABULARY))
    out = Counter()
    for (doc_id, text), times in texts.items():
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        first = len(ids) % 2048 or 2048
        ends = [first + 2048 * k for k in range((len(ids) - first) // 2048 + 1)]
        for piece, end in enumerate(ends):
            start = max(0, end - 2048) if piece else 0
            out[doc_id, piece, start, end - start, zlib.crc32(ids[start:end].tobytes())] += times
    return out


def packed_rows(df):
    rows = df.collect()
    held = defaultdict(list)
    for row in rows:
        held[row["sequence_id"]].append((row["offset"], row["length"]))
    for parts in held.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 2048
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    return Counter(tuple(row[name] for name in names) for row in rows), len(held)


def test_stages_and_run_equal_plain_python(spark, docs, tmp_path):
    ids = lambda df: {row["doc_id"] for row in df.collect()}
    kept = plain_language(spark, docs)
    one = cp.language_stage(spark, docs, "")
    assert ids(one) == kept and 80 < len(kept) < docs.count()
    foreign = {row["doc_id"] for row in docs.collect() if row["text"] == FOREIGN}
    assert not foreign & kept
    one = docs.where(F.col("doc_id").isin(*kept))
    kept = plain_rules(one.collect())
    two = cp.rule_stage(spark, one, "")
    assert ids(two) == kept
    assert not kept & {row["doc_id"] for row in docs.where("source = 'bad'").collect()}  # its good row goes with it
    two = docs.where(F.col("doc_id").isin(*kept))
    components = brute_components([(row["doc_id"], row["text"]) for row in two.collect()])
    kept = {i for i, (_, root) in components.items() if i == root}
    assert ids(cp.dedup_stage(spark, two, "")) == kept and len(kept) < two.count()
    three = docs.where(F.col("doc_id").isin(*kept))
    four = cp.mixing_stage(spark, three, "")
    wanted = plain_mix(spark, three)
    assert Counter((row["doc_id"], row["text"]) for row in four.collect()) == wanted
    assert all(row["n_chars"] == len(row["text"]) for row in four.collect())
    pieces = plain_pieces(wanted)
    found, sequences = packed_rows(cp.packing_stage(spark, four, ""))
    assert found == pieces
    total = sum(key[3] * times for key, times in pieces.items())
    assert -(-total // 2048) <= sequences <= -(-total // 2048) + 1
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    whole, _ = packed_rows(cp.run(spark, str(tmp_path)))
    assert whole == pieces


def clashing(docs):
    """Columns named like those that operators make themselves, with a map among them."""
    names = ["kept", "_counts", "base_failed", "host_refused", "_host", "_failed", "_key", "_found", "found", "row_key", "root", "_row"]
    names += ["_document", "passes", "spans", "taken", "size", "place", "_shard", "score", "class", "keys", "_range", "a.b", "count"]
    made = docs
    for k, name in enumerate(names):
        made = made.withColumn(name, F.concat(F.lit(f"{k}-"), F.col("doc_id").cast("string")))
    return made.withColumn("notes", F.create_map(F.lit("k"), F.col("lang"))), names


def test_columns_come_back_as_they_were(spark, docs):
    whole, names = clashing(docs)
    given = {row["doc_id"]: tuple(row[name] for name in names) for row in whole.collect()}
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, whole, "")
        assert out.columns == whole.columns and out.schema["notes"].dataType == whole.schema["notes"].dataType, name
        rows = out.collect()
        assert rows and all(tuple(row[n] for n in names) == given[row["doc_id"]] for row in rows), name
    assert cp.packing_stage(spark, whole, "").count() >= docs.count()


def test_operators_on_clashing_columns(spark, docs):
    whole, _ = clashing(docs)
    n = docs.count()
    assert near_dedup.group_near_copies(whole).count() == n
    assert mixing.mix(whole).count() == n
    assert fingerprints.edited_fingerprints(whole).count() == n
    assert pitman_yor.score_documents(whole.withColumn("train", F.lit(True))).count() == n
    ruled = host_rules.apply_host_rules(whole)
    plain = {row["doc_id"]: row["kept"] for row in host_rules.apply_host_rules(docs).collect()}
    for row in ruled.collect():
        assert row["kept"] == plain[row["doc_id"]] and row["_host"] == f"4-{row['doc_id']}"
    pages = whole.select(F.col("text").alias("url"), F.col("kept").alias("host"), F.col("size").alias("_grams"), F.col("score").alias("_probability"), "doc_id")
    judged = url_filter.judge_urls(pages)
    assert judged.columns == ["url", "_grams", "_probability", "doc_id", "host", "path", "rule", "score", "verdict"]
    assert {row["_grams"] for row in judged.collect()} == {row["size"] for row in whole.collect()}
    held = spark.createDataFrame([(k, [float(k)] * 64, "x", "y") for k in range(5)], "vec_id long, embedding array<double>, planes string, cluster string")
    assert centroid_clusters.cluster_vectors(held).count() == 5
    talk = spark.createDataFrame([(1, 1, "user", "Hi.", "p", "b")], "conv_id long, turn long, role string, text string, part string, present string")
    assert conversation_repair.digests(conversation_repair.repair_conversations(talk)).count() == 1


def test_a_very_long_text(spark):
    """Half a million words, next to short ones, through every operator of documents."""
    draw = random.Random(1)
    long = " ".join(f"w{draw.randrange(50_000)}" for _ in range(500_000))
    rows = [(1, long, "en", "a", len(long)), (2, long + " end", "en", "a", len(long) + 4), (3, "a b c d e f g h i j k l", "en", "b", 23)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = {r["doc_id"]: r for r in near_dedup.group_near_copies(df).collect()}
    assert found[2]["component_id"] == 1 and found[1]["n_shingles"] > 499_000
    assert {r["doc_id"]: r["size"] for r in mixing.mix(df).collect()} == {1: 500_000, 2: 500_001, 3: 12}
    assert {r["doc_id"]: r["_counts"]["n_words"] for r in host_rules.apply_host_rules(df).collect()} == {1: 500_000, 2: 500_001, 3: 12}
    prints = {r["doc_id"]: r for r in fingerprints.edited_fingerprints(df).collect()}
    assert prints[2]["near_next"] > 0.95 and prints[1]["n_chars"] == len(long)
    scored = {r["doc_id"]: r["n_tokens"] for r in pitman_yor.score_documents(df.withColumn("train", F.lit(True))).collect()}
    assert scored == {1: 500_001, 2: 500_002, 3: 13}
    assert sum(r["length"] for r in packing.pack_documents(df).where("doc_id = 1").collect()) > 500_000
    path = token_files.write_token_files(df, f"{cp.scratch_path(spark, 'long')}")
    assert token_files.read_token_files(spark, path).count() == 3
    model = language_id.fit(df)
    assert df.select(language_id.identify(model)(F.col("text")).alias("r")).where("r.lang_pred = 'en'").count() == 3
    judged = df.withColumn("judged", weak_labels.judge(weak_labels.fit(df))(F.col("text")))
    assert judged.where("judged.score between 0 and 1").count() == 3
    labelled = df.withColumn("toxic", (F.col("doc_id") == 3).cast("int"))
    scores = df.select(toxicity.scorer(toxicity.fit(labelled))(F.col("text")).alias("s")).collect()
    assert all(0 <= r["s"] <= 1 for r in scores)
