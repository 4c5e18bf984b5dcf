"""Near-duplicate groups by min-max hashing and checks on whole shingle sets.

1. A document's set holds the hashes of its distinct five-word shingles (A-Z lowered; fewer words: the
   whole sequence). Documents with equal sets are one class, named by a hash of the set.
2. Signatures: under each permutation both the smallest and the largest hash of the set are kept, two
   values for one evaluation. ``BANDS`` bands of ``ROWS`` permutations, so six values, make the keys. Two
   sets that are 0.85 alike share none of them with a probability of 3e-7; sets at 0.5 share one with 0.4, at 0.3 with 0.02.
3. Links: classes under one key are held against a hub of that key and not against each other. Linked
   classes grow together to components, and the next round asks, per pair of components that
   still share a key, for a few further pairs with other hubs. When rounds stop finding many links, what is left is searched
   exactly: of each class that still shares a key with another component, the rarest shingles are listed, as many as it can't
   do without in a link (a prefix filter); classes of different components that share one of them and are of like size are
   the candidates if their bitmaps allow a link too: two sets differ in at least as many shingles as their bitmaps in bits.
   So no link that the keys show is lost, and texts that share common passages only, however many, don't meet. Every link is confirmed on the two whole sets.
4. Components of the links by alternating large and small stars, then the smallest document id of each.

Exact copies meet once, in the partial sums of step 1, so a group of copies with a third of all rows is one
class. Null and empty texts, and those without words, have an empty set and are linked with nothing; each is kept.
Very long texts have large sets and nothing else. Repeated rows are copies. Rows without an id take the smallest id
they reach, null if none. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom.llm.words import raw_texts
from threadloom.operators.lookup import BROADCAST_BYTES, fits_broadcast, lookup_join
from threadloom.plans.materialize import discard, store

WIDTH = 5
BANDS, ROWS = 32, 3
PERMUTATIONS = ROWS * BANDS
PERCENT = 85
SEED = 11
KEPT_WORDS = 250_000
SHINGLES_AT_ONCE = 100_000
#: Pairs of classes that one round checks for one pair of components.
TRIES = 4
#: Bits of a set's bitmap.
BITS = 4096
#: Hub rounds, two at least, go on while this share of the checked pairs turn out to be links.
WORTH = 0.02

STEP, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _mixed(value: np.ndarray) -> np.ndarray:
    value = (value ^ (value >> np.uint64(32))) * MIX
    return value ^ (value >> np.uint64(29))


class Shingles:
    """Sorted distinct shingle hashes of texts; remembers a bounded number of word hashes."""

    def __init__(self) -> None:
        self.seen: dict[bytes, int] = {}

    def __call__(self, text: bytes) -> np.ndarray:
        seen, words = self.seen, text.lower().split()
        if len(seen) > KEPT_WORDS:
            seen.clear()
        found = [seen.get(word) for word in words]
        for k, value in enumerate(found):
            if value is None:
                found[k] = seen[words[k]] = xxhash.xxh3_64_intdigest(words[k])
        hashes = np.array(found, np.uint64)
        width = min(WIDTH, len(words))
        if not width:
            return hashes
        with np.errstate(over="ignore"):
            total = np.full(len(words) - width + 1, width, np.uint64)
            for step in range(width):
                total = total * STEP + hashes[step : step + len(total)]
            return np.unique(_mixed(total))


def band_keys(sets: list[np.ndarray]) -> np.ndarray:
    """Sets x bands: keys made from the smallest and the largest hash under ``ROWS`` permutations each."""
    draw = np.random.default_rng(SEED)
    factor = draw.integers(0, 1 << 63, PERMUTATIONS, np.uint64) * np.uint64(2) + np.uint64(1)
    line, starts = np.concatenate(sets), np.cumsum([0, *map(len, sets[:-1])])
    keys = np.zeros((len(sets), BANDS), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(PERMUTATIONS):
            turned = line * factor[k]
            turned ^= turned >> np.uint64(31)
            turned *= factor[k - 1]
            for value in (np.minimum.reduceat(turned, starts), np.maximum.reduceat(turned, starts)):
                keys[:, k // ROWS] = _mixed(keys[:, k // ROWS] * STEP + value)
        return _mixed(keys * STEP + np.arange(BANDS, dtype=np.uint64))


def row_key(rows: DataFrame) -> Column:
    """A hash of all columns, nulls told apart: the same for rows that are equal in them.

    Maps, which have no hash, count by their JSON text, so equal ones in another order are told apart.
    """

    def hashed(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        unordered = '"map"' in field.dataType.json() or "variant" in field.dataType.simpleString()
        return F.to_json(F.struct(column)) if unordered else column

    return F.xxhash64(*map(hashed, rows.schema), *(F.col(f"`{name}`").isNull() for name in rows.columns))


def signatures(docs: DataFrame) -> DataFrame:
    """``doc_id``, row_key, n_shingles, class (null for an empty set) and keys."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles()
        for batch in batches:
            texts, ids, rows, at = raw_texts(batch.column(1)), batch.column(0), batch.column(2), 0
            while at < len(texts):
                sets, held, first = [], 0, at
                while at < len(texts) and held < SHINGLES_AT_ONCE:
                    sets.append(shingles(texts[at]))
                    held += len(sets[-1])
                    at += 1
                filled = [k for k, own in enumerate(sets) if len(own)]
                keys: list = [None] * len(sets)
                names: list = [None] * len(sets)
                if filled:
                    for k, row in zip(filled, band_keys([sets[k] for k in filled]).view(np.int64), strict=True):
                        keys[k] = row
                        names[k] = int.from_bytes(blake2b(sets[k].tobytes(), digest_size=8).digest(), "big", signed=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(first, at - first),
                        rows.slice(first, at - first),
                        pa.array([len(own) for own in sets], pa.int64()),
                        pa.array(names, pa.int64()),
                        pa.array(keys, pa.list_(pa.int64())),
                    ],
                    ["doc_id", "row_key", "n_shingles", "class", "keys"],
                )

    return docs.select("doc_id", "text", "row_key").mapInArrow(
        sign, f"doc_id {kind}, row_key long, n_shingles long, class long, keys array<bigint>"
    )


def shingle_sets(docs: DataFrame) -> DataFrame:
    """``class`` and its set, for ``class``, ``text``; a text that isn't of its class is left out.

    A task makes the set of repeated rows once, as long as it remembers the class.
    """

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles()
        done: set[int] = set()
        for batch in batches:
            names, texts = batch.column(0).to_pylist(), raw_texts(batch.column(1))
            for at in range(0, len(names), 200):
                kept = []
                if len(done) > KEPT_WORDS:
                    done.clear()
                for name, text in zip(names[at : at + 200], texts[at : at + 200], strict=True):
                    if name in done:
                        continue
                    own = shingles(text)
                    if int.from_bytes(blake2b(own.tobytes(), digest_size=8).digest(), "big", signed=True) == name:
                        kept.append((name, own.view(np.int64)))
                        done.add(name)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([name for name, _ in kept], pa.int64()),
                        pa.array([own for _, own in kept], pa.list_(pa.int64())),
                    ],
                    ["class", "shingles"],
                )

    return docs.select("class", "text").mapInArrow(make, "class long, shingles array<bigint>")


def components(links: DataFrame) -> DataFrame:
    """``node``, ``root``: the smallest node that links ``a``-``b`` reach, for every node of a link. By alternating stars."""
    spark = links.sparkSession
    made = store(links.select("a", "b"), "links")
    pairs = made.table
    print_ = F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 30))).alias("print")
    last = None
    while True:
        both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("root"))
        # Large star: every larger neighbour hangs on the smallest.
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("root").alias("b"))
        stars = store(large.where("a <> b").distinct(), "large-star")
        large = stars.table
        # Small star: a node and its smaller neighbours hang on the smallest of them.
        low = large.groupBy("a").agg(F.min("b").alias("root"))
        small = large.join(low, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("root").alias("b"))
        before, made = made, store(small.where("a <> b").distinct(), "small-star", print_)
        discard(spark, before.path, stars.path)
        pairs = made.table
        if (made.rows, made.seen["print"]) == last:
            roots = pairs.select(F.col("a").alias("node"), F.col("b").alias("root"))
            return roots.union(roots.select(F.col("root"), F.col("root"))).distinct()
        last = (made.rows, made.seen["print"])


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs ``a``, ``b`` whose sets are alike enough."""
    one = sets.select(F.col("class").alias("a"), F.col("shingles").alias("_a"))
    two = sets.select(F.col("class").alias("b"), F.col("shingles").alias("_b"))
    both = pairs.join(one, "a").join(two, "b")
    small, large = F.least(F.size("_a"), F.size("_b")), F.greatest(F.size("_a"), F.size("_b"))
    both = both.where(100 * small >= percent * large)
    shared = F.size(F.array_intersect("_a", "_b"))
    return both.where((100 + percent) * shared >= percent * (small + large)).select(*pairs.columns)


def _between(rows: DataFrame) -> DataFrame:
    """Pairs of a class and a hub from different components, at most ``TRIES`` for two components."""
    pairs = rows.where("own <> other").select(
        F.least("class", "hub").alias("a"),
        F.greatest("class", "hub").alias("b"),
        F.least("own", "other").alias("low"),
        F.greatest("own", "other").alias("high"),
    )
    # The smallest hash in each of a few parts, by partial sums: no ranking of a group in one task.
    part = F.pmod(F.xxhash64("b", "a"), F.lit(TRIES))
    picked = pairs.groupBy("low", "high", part.alias("part")).agg(F.min(F.struct(F.xxhash64("a", "b"), "a", "b")).alias("one"))
    return picked.select("one.a", "one.b").distinct()


def link_classes(keyed: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame | None:
    """``class``, ``root`` for every class linked with another; ``keyed`` has ``key``, ``class`` and the classes ``n`` of the key."""
    roots, turn, active = None, 0, keyed
    while True:
        if roots is None:
            rows = active.withColumn("own", F.col("class"))
        else:
            found = roots.withColumnRenamed("root", "own")
            rows = lookup_join(active, found, ["class"], fits_broadcast(found), "left")
            rows = rows.withColumn("own", F.coalesce("own", "class"))
        rows = store(rows, "labelled").table
        spread = rows.groupBy("key").agg(F.min("own").alias("_low"), F.max("own").alias("_high"))
        spread = spread.where("_low <> _high").select("key")
        spread = store(spread, "spread")
        held = store(lookup_join(rows, spread.table, ["key"], spread.bytes <= BROADCAST_BYTES, "left_semi"), "active")
        if not held.rows:
            return roots
        rows = held.table
        # The first hub is the smallest class, the same one under many keys; later ones differ by key and round.
        salt = F.lit(0) if turn == 0 else F.xxhash64("key", F.lit(turn))
        hubs = rows.groupBy("key").agg(F.min(F.col("class").bitwiseXOR(salt)).alias("_hub"))
        hubs = hubs.select("key", F.col("_hub").bitwiseXOR(salt).alias("hub"))
        hubs = hubs.join(rows.select("key", F.col("class").alias("hub"), F.col("own").alias("other")), ["key", "hub"])
        hubs = store(hubs, "hubs")
        asked = store(_between(lookup_join(rows, hubs.table, ["key"], hubs.bytes <= BROADCAST_BYTES)), "pairs")
        links = store(confirmed(asked.table, sets, percent), "confirmed")
        if links.rows:
            fresh = components(links.table if roots is None else _contracted(links.table, rows))
            roots = _relabelled(roots, fresh)
        # Two classes under a key were asked about; three or more may hold further links.
        active = rows.where("n > 2").select("key", "class", "n")
        if turn and links.rows <= WORTH * asked.rows:
            break
        turn += 1
    left = store(rest_links(active, roots, sets, percent), "rest-links")
    if not left.rows:
        return roots
    own = left.table.select(F.col("own_a").alias("a"), F.col("own_b").alias("b"))
    return _relabelled(roots, components(own))


def rest_links(active: DataFrame, roots: DataFrame | None, sets: DataFrame, percent: int) -> DataFrame:
    """Links ``a``, ``b``, ``own_a``, ``own_b`` between components that still share a key."""
    if roots is None:
        rows = active.withColumn("own", F.col("class"))
    else:
        found = roots.withColumnRenamed("root", "own")
        rows = lookup_join(active, found, ["class"], fits_broadcast(found), "left")
        rows = rows.withColumn("own", F.coalesce("own", "class"))
    apart = rows.groupBy("key").agg(F.min("own").alias("_low"), F.max("own").alias("_high")).where("_low <> _high")
    apart = store(apart.select("key"), "apart")
    met = lookup_join(rows, apart.table, ["key"], apart.bytes <= BROADCAST_BYTES, "left_semi")
    classes = store(met.select("class", "own").distinct(), "met").table
    asked = store(candidates(classes, sets, percent), "candidates").table
    return confirmed(asked, sets, percent)


def candidates(classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``a`` < ``b``, ``own_a``, ``own_b``: classes of different components that can be linked, by a prefix filter.

    Two sets that share ``percent`` of their union share at least ``ceil(percent * size / 100)`` shingles of each. So if the
    shingles of all sets are put in one order, they share one among the first ``size - ceil(percent * size / 100) + 1`` of each.
    In order of how many classes have them, these are the rarest ones; those that no other class has are only counted.
    What two sets of ``n`` shingles in all may differ in is ``(100 - percent) * n / (100 + percent)`` of them, and each bit
    in which their bitmaps differ is one. What is sent is one row for each shingle of a class, then the prefixes with the
    bitmaps, then one row for each pair that passes both tests.
    """
    held = store(classes.join(sets, "class"), "met-sets").table
    tokens = held.select("class", F.size("shingles").alias("size"), F.explode("shingles").alias("token"))
    often = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = tokens.join(often, "token")
    first = Window.partitionBy("class").orderBy("n", "token")
    known = F.count(F.lit(1)).over(Window.partitionBy("class"))
    placed = shared.withColumn("place", F.row_number().over(first)).withColumn("known", known)
    needed = F.expr(f"size - cast(ceil(size * {percent} / 100) as int) + 1 - (size - known)")
    prefix = placed.where(F.col("place") <= needed).select("token", "class", "size").join(_bitmaps(held), "class")
    # A token that is in one prefix only makes no pair.
    twice = prefix.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("token")
    prefix = store(prefix.join(twice, "token"), "prefixes").table

    def side(mark: str) -> DataFrame:
        return prefix.select("token", *(F.col(name).alias(f"{name}_{mark}") for name in ("class", "own", "size", "bits")))

    small, large = F.least("size_a", "size_b"), F.greatest("size_a", "size_b")
    differing = F.zip_with("bits_a", "bits_b", lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    apart = F.aggregate(differing, F.lit(0), lambda n, more: n + more)
    alike = (100 * small >= percent * large) & ((100 + percent) * apart <= (100 - percent) * (small + large))
    one, two = side("a"), side("b").withColumnRenamed("token", "token_b")
    meet = (F.col("token") == F.col("token_b")) & F.expr("class_a < class_b and own_a <> own_b") & alike
    both = one.join(two, meet)
    return both.select(F.col("class_a").alias("a"), F.col("class_b").alias("b"), "own_a", "own_b").distinct()


def _bitmaps(sets: DataFrame) -> DataFrame:
    """``class``, ``own`` and 64-bit words in which every shingle of the set has set one of ``BITS`` bits."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(at, 1000) for whole in batches for at in range(0, len(whole), 1000)):
            lists = batch.column(2)
            row = np.repeat(np.arange(len(batch)), lists.value_lengths().to_numpy())
            bits = np.zeros((len(batch), BITS), np.uint8)
            bits[row, lists.flatten().to_numpy().view(np.uint64) % np.uint64(BITS)] = 1
            words = np.packbits(bits, axis=1, bitorder="little").view("<i8")
            ends = pa.array(np.arange(len(batch) + 1) * words.shape[1], pa.int32())
            made = pa.ListArray.from_arrays(ends, pa.array(words.reshape(-1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), made], ["class", "own", "bits"])

    return sets.select("class", "own", "shingles").mapInArrow(make, "class long, own long, bits array<bigint>")


def _contracted(links: DataFrame, rows: DataFrame) -> DataFrame:
    """Links between classes as links between their components."""
    own = rows.select("class", "own").distinct()
    low = own.select(F.col("class").alias("a"), F.col("own").alias("_a"))
    high = own.select(F.col("class").alias("b"), F.col("own").alias("_b"))
    both = links.join(low, "a").join(high, "b")
    return both.select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).where("a <> b").distinct()


def _relabelled(roots: DataFrame | None, fresh: DataFrame) -> DataFrame:
    """Roots after the components of the last round have grown together."""
    moved = fresh.select(F.col("node").alias("class"), F.col("root"))
    if roots is None:
        return store(moved, "roots").table
    new = fresh.select(F.col("node").alias("root"), F.col("root").alias("_new"))
    old = roots.join(new, "root", "left").select("class", F.coalesce("_new", "root").alias("root"))
    return store(old.union(moved.join(roots, "class", "left_anti")), "roots").table


def group_near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept."""
    named = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    out = grouped_rows(named.withColumn("row_key", row_key(named)), percent)
    kept = F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    return out.select("doc_id", "n_shingles", "component_id", kept)


def grouped_rows(named: DataFrame, percent: int = PERCENT) -> DataFrame:
    """For ``doc_id``, ``text``, ``row_key``: doc_id, row_key, n_shingles, component_id and root.

    ``root`` is the component itself, whatever ids its rows have; null for a row that is linked with no other.
    """
    signed = store(signatures(named), "signatures").table
    filled = signed.where("class is not null")
    # The row that gives the text of a class: one with an id where there is one, as null ids may repeat.
    row = F.min(F.struct(F.col("doc_id").isNull(), "row_key"))["row_key"].alias("row_key")
    classes = filled.groupBy("class").agg(F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("n"), row)
    classes = store(classes, "classes").table
    # Copies have the same keys, so each key counts a class once.
    keyed = filled.select("class", F.explode("keys").alias("key")).distinct()
    several = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    keyed = store(keyed.join(several, "key"), "keyed").table

    wanted = store(keyed.select("class").distinct().join(classes, "class").select("class", "row_key"), "wanted").table
    own = lookup_join(named.select("row_key", "text"), wanted, ["row_key"], fits_broadcast(wanted))
    sets = store(shingle_sets(own).groupBy("class").agg(F.first("shingles").alias("shingles")), "sets").table
    roots = link_classes(keyed, sets, percent)

    root: Column = F.col("class")
    if roots is not None:
        classes = classes.join(roots, "class", "left")
        root = F.coalesce("root", "class")
    grouped = classes.select("class", "n", "low", root.alias("root"))
    lowest = grouped.groupBy("root").agg(F.min("low").alias("component_id"), F.sum("n").alias("_size"))
    lowest = lowest.where("_size > 1")
    named_groups = store(grouped.join(lowest, "root").select("class", "component_id", "root"), "groups").table
    rows = signed.select("doc_id", "row_key", "n_shingles", "class")
    out = lookup_join(rows, named_groups, ["class"], fits_broadcast(named_groups), "left")
    component = F.coalesce("component_id", "doc_id").alias("component_id")
    return out.select("doc_id", "row_key", "n_shingles", component, "root")
