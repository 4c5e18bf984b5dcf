"""Triangles by triples of colours: every task holds a bounded part of the edges, whatever their degrees.

Each vertex gets one of ``C`` colours by a hash. The corners of a triangle ``x < y < z`` (in the order that directs the edges
from ``lo`` to ``hi``) have three colours, and exactly the task of that triple finds it. An edge can be the side ``xy``, ``xz`` or ``yz`` of
one; in each role two colours are given and the third is free, so it is looked at by ``3 C`` of the ``C ** 3`` triples. A triple has
about ``3 / C ** 2`` of all edges, and of a hub's edges ``1 / C`` in each role. ``colours_for`` takes as few
colours as keep the largest triple below a bound, which it knows exactly from the number of edges between each two colours.

The copies are not shuffled. The edges are written once, sorted, a folder for every two colours. A task takes all triples whose last two
colours are a given two, in either order: it makes the edges between these two ready to be looked up once, whatever their direction, then
reads the sides from one first colour after the other, each as it stands. So two neighbours of ``x`` are looked up once, not in both orders.
What is shuffled and written grows with the edges alone.

A triple counts for each of its vertices the triangles that it is a corner of. Pairs of higher neighbours are looked up among the edges,
or, if asked for, 256-bit blocks of neighbours are intersected for every edge. Where vertices are few and edges many, a part is two bit
matrices, one row of bits for each vertex, and an edge is a popcount of two ANDed rows. The counts of a task are shuffled as lists.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.plans.materialize import scratch_path
from threadloom.sources.paths import open_path, qualified

# Executors need no installed copy of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

Ends = tuple[np.ndarray, np.ndarray]
#: Sorted edges, the lower end in the upper half of a number: the old ones, the fresh ones.
Parts = tuple[np.ndarray, np.ndarray]

#: Edges of the largest triple.
PART_EDGES = 12_000_000
#: A graph with more edges than that is spread over all cores, however few colours would do.
EDGES_OF_ONE_TASK = 1_000_000
MOST_COLOURS = 96
#: Colours among which edges are counted; smaller numbers of colours are divisors of it.
FINE = 96
#: 64-bit words of the two bit matrices of a triple.
MATRIX_WORDS = 16 << 20
#: Places of the largest table that tells most keys that are not there.
SIEVE_BITS = 26
#: 64-bit words of a block of bits, and the bits of a number that say where in its block it is.
LANES = 4
BLOCK_BITS = 8
#: Found corners that a task holds before it adds up those of the same vertex.
CORNERS_AT_ONCE = 1 << 22
#: Words that a task looks at together.
TOGETHER = 1 << 20
#: Pairs that a task looks up together, few enough to stay in a core's cache.
LOOKED_UP = 1 << 16
#: Words that cost as much as a pair that is looked up.
PAIR_WORDS = 8
#: Parts that the vertices' counts are dealt into, and the most vertices of a list of counts.
SLOTS = 256
LISTED = 1000
#: The higher end of an edge that is one number.
ENDS = np.int64((1 << 32) - 1)
XY, XZ, YZ = 0, 1, 2


def _colour(vertex: str, colours: int) -> str:
    """Colours of a divisor of ``FINE`` are unions of those of ``FINE``."""
    return f"cast(pmod(pmod(xxhash64({vertex}), {FINE}), {colours}) as int)"


def _tasks(colours: int) -> list[tuple[int, int]]:
    """Every two colours, the equal ones last, as they have less to do."""
    return sorted(((p, q) for p in range(colours) for q in range(p, colours)), key=lambda pair: pair[0] == pair[1])


def colours_for(edges: DataFrame, part_edges: int = PART_EDGES) -> tuple[int, int]:
    """The fewest colours (a divisor of ``FINE``) whose largest triple has at most ``part_edges`` edges, and that number.

    A large graph gets as many as give every core four tasks. One pass counts the edges between each two of ``FINE`` colours: at most ``FINE ** 2`` numbers. If no number of
    colours is enough, the largest one is taken.
    """
    between = edges.selectExpr(f"{_colour('lo', FINE)} as l", f"{_colour('hi', FINE)} as h").groupBy("l", "h").count()
    fine = np.zeros((FINE, FINE), np.int64)
    for row in between.collect():
        fine[row["l"], row["h"]] = row["count"]
    spread = 4 * edges.sparkSession.sparkContext.defaultParallelism if fine.sum() > EDGES_OF_ONE_TASK else 1
    for colours in (c for c in range(1, MOST_COLOURS + 1) if FINE % c == 0):
        if len(_tasks(colours)) < spread and colours < MOST_COLOURS:
            continue
        pairs = fine.reshape(FINE // colours, colours, FINE // colours, colours).sum(axis=(0, 2))
        # xy lies between the first two colours of a triple, xz between the outer ones, yz between the last two.
        largest = int((pairs[:, :, None] + pairs[:, None, :] + pairs[None, :, :]).max())
        if largest <= part_edges or colours == MOST_COLOURS:
            return colours, largest
    raise AssertionError("MOST_COLOURS is no divisor of FINE")


def coloured(edges: DataFrame, colours: int) -> DataFrame:
    """``part``, ``role``, ``lo``, ``hi``: every edge in each triple and role in which it can be a side, to look at their sizes."""
    known = edges.selectExpr("lo", "hi", f"{_colour('lo', colours)} as l", f"{_colour('hi', colours)} as h")
    free = known.selectExpr("*", f"explode(sequence(0, {colours - 1})) as f")

    def part(x: str, y: str, z: str) -> str:
        return f"({x} * {colours} + {y}) * {colours} + {z}"

    roles = [(XY, part("l", "h", "f")), (XZ, part("l", "f", "h")), (YZ, part("f", "l", "h"))]
    made = ", ".join(f"struct({place} as part, cast({role} as tinyint) as role)" for role, place in roles)
    return free.selectExpr("lo", "hi", f"inline(array({made}))").select("part", "role", "lo", "hi")


def _by_bits(sides: list[Ends], sizes: tuple[int, int, int]) -> list[np.ndarray]:
    """Triangles at each x, y and z. A row of bits for each x and y over z, then for each x and z over y."""

    def rows(owner: np.ndarray, member: np.ndarray, owners: int, members: int) -> np.ndarray:
        words = -(-members // 64)
        held = np.zeros(owners * words, np.uint64)
        np.bitwise_or.at(held, owner * words + member // 64, np.uint64(1) << (member % 64).astype(np.uint64))
        return held.reshape(owners, words)

    def common(ours: np.ndarray, theirs: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        found = np.zeros(len(a), np.int64)
        step = max(1, TOGETHER // ours.shape[1])
        for start in range(0, len(a), step):
            some = slice(start, start + step)
            found[some] = np.bitwise_count(ours[a[some]] & theirs[b[some]]).sum(axis=1, dtype=np.int64)
        return found

    (ax, ay), (bx, bz), (cy, cz) = sides
    nx, ny, nz = sizes
    over_xy = common(rows(bx, bz, nx, nz), rows(cy, cz, ny, nz), ax, ay)
    over_xz = common(rows(ax, ay, nx, ny), rows(cz, cy, nz, ny), bx, bz)
    return [
        np.bincount(ax, over_xy, nx).astype(np.int64),
        np.bincount(ay, over_xy, ny).astype(np.int64),
        np.bincount(bz, over_xz, nz).astype(np.int64),
    ]


class Keys:
    """Sorted keys that are looked up, most of them in vain: two bits of a table tell that of nearly all without a search."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.shift = np.uint64(64 - max(10, min(SIEVE_BITS, (16 * len(keys)).bit_length())))
        there = np.zeros(1 << (64 - int(self.shift)), bool)
        there[self._places(keys, 0x9E3779B97F4A7C15)] = True
        there[self._places(keys, 0xC2B2AE3D27D4EB4F)] = True
        self.bits = np.packbits(there, bitorder="little")

    def _places(self, keys: np.ndarray, factor: int) -> np.ndarray:
        return (keys.view(np.uint64) * np.uint64(factor) >> self.shift).view(np.int64)

    def _marked(self, places: np.ndarray) -> np.ndarray:
        return np.flatnonzero(self.bits[places >> 3] >> (places & 7).astype(np.uint8) & 1)

    def find(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of ``wanted`` are keys, and where these are."""
        which = self._marked(self._places(wanted, 0x9E3779B97F4A7C15))
        which = which[self._marked(self._places(wanted[which], 0xC2B2AE3D27D4EB4F))]
        if not len(self.keys):
            return which[:0], which[:0]
        place = np.searchsorted(self.keys, wanted[which])
        place[place == len(self.keys)] = 0
        hit = self.keys[place] == wanted[which]
        return which[hit], place[hit]


def _runs(values: np.ndarray) -> Ends:
    """The different ones of sorted values, and where each begins, with the end of all."""
    if not len(values):
        return values, np.zeros(1, np.int64)
    first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    return values[first], np.append(first, len(values))


def _met(xy: np.ndarray, entries: np.ndarray, bits: int, closing: Keys) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Edges ``xy``, the entries of their ``x`` and the places of those of their ``y`` that agree, some at a time.

    An entry has its owner above ``bits`` bits, and below what must be the same.
    """
    (ours, at_xy), (owners, at_entry) = _runs(xy >> 32), _runs(entries >> bits)
    if not (len(ours) and len(owners)):
        return
    place = np.minimum(np.searchsorted(owners, ours), len(owners) - 1)
    known = owners[place] == ours
    each = np.repeat(np.where(known, np.diff(at_entry)[place], 0), np.diff(at_xy))
    first = np.repeat(at_entry[place], np.diff(at_xy))
    low = (xy & ENDS) << bits
    same = entries & np.int64((1 << bits) - 1)
    ends = np.cumsum(each)
    start = 0
    while start < len(xy):
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + LOOKED_UP, "right")))
        n = each[start:stop]
        entry = np.arange(ends[stop - 1] - done) + np.repeat(first[start:stop] - (ends[start:stop] - n - done), n)
        hit, there = closing.find(np.repeat(low[start:stop], n) | same[entry])
        if len(hit):
            yield np.searchsorted(ends, hit + done, "right"), entry[hit], there
        start = stop


def _blocked(edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted edges as blocks of bits: ``lo`` above the number of the block, and the words of the blocks that have a bit."""
    words, first = _runs(edges >> 6)
    bits = np.uint64(1) << (edges & 63).astype(np.uint64)
    keys, rows = _runs(words >> (BLOCK_BITS - 6))
    held = np.zeros((len(keys), LANES), np.uint64)
    if len(edges):
        held[np.repeat(np.arange(len(keys)), np.diff(rows)), words & (LANES - 1)] = np.bitwise_or.reduceat(bits, first[:-1])
    return keys, held


def _set_bits(words: np.ndarray, first: np.ndarray) -> Iterator[Ends]:
    """The numbers of the set bits of blocks that begin at ``first``, and how often each is meant."""
    if int(np.bitwise_count(words).sum()) > LANES * len(words):
        for start in range(0, len(words), 1 << 12):
            blocks, at = _runs(np.sort(first[start : start + (1 << 12)]))
            order = np.argsort(first[start : start + (1 << 12)], kind="stable")
            flat = np.unpackbits(words[start : start + (1 << 12)][order].astype("<u8").view(np.uint8), axis=1, bitorder="little")
            counts = np.add.reduceat(flat, at[:-1], axis=0, dtype=np.int64)
            row, bit = np.nonzero(counts)
            yield blocks[row] + bit, counts[row, bit]
        return
    left, base = words.ravel(), np.repeat(first, LANES) + 64 * np.tile(np.arange(LANES), len(first))
    while len(left):
        some = np.flatnonzero(left)
        left, base = left[some], base[some]
        lowest = left & (~left + np.uint64(1))
        yield base + np.bitwise_count(lowest - np.uint64(1)), np.ones(len(left), np.int64)
        left = left ^ lowest


class Closing:
    """The sides ``yz`` of a task, sorted, and the triangles found at them."""

    def __init__(self, edges: np.ndarray, blocks: bool):
        self.edges, self.blocks = edges, blocks
        self.words = None
        keys = edges
        if blocks:
            keys, self.words = _blocked(edges)
        self.sieve = Keys(keys)
        self.at = np.zeros(len(keys), np.int64)
        self.bits = 32 - BLOCK_BITS if blocks else 32
        self.ys, self.first = _runs(keys >> self.bits)
        self.zs = len(np.unique(edges & ENDS))

    def at_y(self) -> Ends:
        return self.ys, np.add.reduceat(self.at, self.first[:-1]) if len(self.at) else self.at

    def at_z(self) -> Ends:
        """Of blocks, what is found at ``z`` is told while it is found."""
        found = np.flatnonzero(self.at) if self.words is None else np.zeros(0, np.int64)
        return self.edges[found] & ENDS, self.at[found]


def corners(xy: np.ndarray, xz: np.ndarray, yz: Closing, matrix_words: int = MATRIX_WORDS) -> tuple[Ends, list[Ends]]:
    """The triangles at each ``x`` of a triple, and what else is found at once; ``yz`` keeps what is found at it."""
    empty = np.zeros(0, np.int64)
    if not (len(xy) and len(xz) and len(yz.edges)):
        return (empty, empty), []
    xs, at_xy = _runs(xy >> 32)
    if not yz.blocks:
        # Bounds of what the bit matrices take; only where vertices are few they are made.
        to_y, to_z = math.ceil(len(yz.ys) / 64), math.ceil(yz.zs / 64)
        if max((len(xs) + len(yz.ys)) * to_z, (len(xs) + yz.zs) * to_y) <= matrix_words:
            owners, at_xz = _runs(xz >> 32)
            place = np.minimum(np.searchsorted(owners, xs), len(owners) - 1)
            pairs = int((np.diff(at_xy) * np.where(owners[place] == xs, np.diff(at_xz)[place], 0)).sum())
            if len(xy) * to_z + len(xz) * to_y <= PAIR_WORDS * pairs + TOGETHER:
                found = _matrix_corners(xy, xz, yz.edges)
                return (empty, empty), [found]
    at_edge, others = np.zeros(len(xy), np.int64), []
    entries, words = _blocked(xz) if yz.blocks else (xz, empty)
    for edge, entry, place in _met(xy, entries, yz.bits, yz.sieve):
        if yz.blocks:
            both = words[entry] & yz.words[place]
            times = np.bitwise_count(both).sum(axis=1, dtype=np.int64)
            some = np.flatnonzero(times)
            edge, place, both, times = edge[some], place[some], both[some], times[some]
            others.extend(_set_bits(both, (yz.sieve.keys[place] & np.int64((1 << yz.bits) - 1)) << BLOCK_BITS))
            if sum(len(vertices) for vertices, _ in others) > CORNERS_AT_ONCE:
                others = [_added(*(list(part) for part in zip(*others)))]
        else:
            times = 1
        np.add.at(at_edge, edge, times)
        np.add.at(yz.at, place, times)
    return (xs, np.add.reduceat(at_edge, at_xy[:-1])), others


def _matrix_corners(xy: np.ndarray, xz: np.ndarray, yz: np.ndarray) -> Ends:
    """Vertices of a triple and the triangles of the triple at each, by bit matrices; a vertex may come twice."""
    empty = np.zeros(0, np.int64)
    ends = [(side >> 32, side & ENDS) for side in (xy, xz, yz)]
    # Only vertices that both of their sides know can be corners.
    xs = np.intersect1d(ends[XY][0], ends[XZ][0])
    ys = np.intersect1d(ends[XY][1], ends[YZ][0])
    zs = np.intersect1d(ends[XZ][1], ends[YZ][1])
    if not (len(xs) and len(ys) and len(zs)):
        return empty, empty

    def numbered(side: Ends, low: np.ndarray, high: np.ndarray) -> Ends:
        a, b = (np.minimum(np.searchsorted(known, end), len(known) - 1) for known, end in zip((low, high), side))
        there = (low[a] == side[0]) & (high[b] == side[1])
        return a[there], b[there]

    sides = [numbered(ends[XY], xs, ys), numbered(ends[XZ], xs, zs), numbered(ends[YZ], ys, zs)]
    if not all(len(side[0]) for side in sides):
        return empty, empty
    return np.concatenate([xs, ys, zs]), np.concatenate(_by_bits(sides, (len(xs), len(ys), len(zs))))


def _added(vertices: list[np.ndarray], triangles: list[np.ndarray]) -> Ends:
    """Every vertex once, with all of its triangles."""
    held = pa.table({"v": np.concatenate(vertices), "t": np.concatenate(triangles)})
    sums = held.group_by("v", use_threads=False).aggregate([("t", "sum")])
    return sums["v"].to_numpy(), sums["t_sum"].to_numpy()


def _folder_reader(path: str) -> Callable[[int, int], Parts]:
    """Reads the edges from one colour to another, the old and the fresh ones; none if there is no such folder."""
    system, root = open_path(path)

    def read(low: int, high: int) -> Parts:
        infos = system.get_file_info(fs.FileSelector(f"{root}/l={low}/h={high}", allow_not_found=True))
        tables = []
        for info in infos:
            if info.is_file and info.base_name.endswith(".parquet"):
                with system.open_input_file(info.path) as file:
                    tables.append(pq.ParquetFile(file).read(use_threads=False))
        if not tables:
            return (np.zeros(0, np.int64),) * 2
        held = pa.concat_tables(tables)
        edges = held["pair"].to_numpy()
        if len(tables) > 1:
            order = np.argsort(edges, kind="stable")
            edges = edges[order]
        if "fresh" not in held.column_names:
            return edges[:0], edges
        new = held["fresh"].to_numpy()
        if len(tables) > 1:
            new = new[order]
        return edges[~new], edges[new]

    return read


def _turned(edges: np.ndarray) -> np.ndarray:
    """Edges from their other end."""
    return (edges & ENDS) << 32 | edges >> 32


def _both(part: Parts) -> np.ndarray:
    old, new = part
    return np.sort(np.concatenate(part), kind="stable") if len(old) and len(new) else old if len(old) else new


def _lists(vertices: np.ndarray, triangles: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Counts of vertices as lists, those of the same vertex in the same slot."""
    some = np.flatnonzero(triangles)
    vertices, triangles = vertices[some], triangles[some]
    slot = (vertices.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(56)).astype(np.uint8)
    order = np.argsort(slot, kind="stable")
    vertices, triangles = vertices[order], triangles[order]
    bounds = np.append(np.searchsorted(slot[order], np.arange(SLOTS, dtype=np.uint8)), len(vertices))
    starts = [np.arange(low, high, LISTED) for low, high in zip(bounds[:-1], bounds[1:])]
    slots = np.repeat(np.arange(SLOTS), [len(part) for part in starts])
    offsets = pa.array(np.append(np.concatenate(starts), len(vertices)).astype(np.int32))
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(slots.astype(np.int32)),
            pa.ListArray.from_arrays(offsets, pa.array(vertices.astype(np.int32))),
            pa.ListArray.from_arrays(offsets, pa.array(triangles)),
        ],
        ["slot", "v", "t"],
    )


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(v, links)`` from lists of counts."""
    vertices, triangles, held, most = [], [], 0, CORNERS_AT_ONCE
    for batch in batches:
        vertices.append(batch.column("v").flatten().to_numpy())
        triangles.append(batch.column("t").flatten().to_numpy())
        held += len(vertices[-1])
        if held > most:
            vertices, triangles = ([part] for part in _added(vertices, triangles))
            held = len(vertices[0])
            most = max(CORNERS_AT_ONCE, 2 * held)
    if held:
        known, total = _added(vertices, triangles)
        sums = pa.table({"v": known, "links": 2 * total})
        yield from sums.to_batches(max_chunksize=TOGETHER)


def linked_by_colours(edges: DataFrame, colours: int, matrix_words: int = MATRIX_WORDS, blocks: bool = False) -> DataFrame:
    """``(v, links)``: ordered pairs of neighbours of v that are joined by an edge, from ``(lo, hi)``.

    Where the edges have a column ``fresh``, only triangles with at least one such edge count. ``blocks`` intersects blocks of bits
    whatever the size of the parts.
    """
    spark = edges.sparkSession
    path = qualified(spark, scratch_path(spark, "coloured-edges"))
    tasks = min(colours**2, 32 * spark.sparkContext.defaultParallelism)
    marked = "fresh" in edges.columns
    # Both ends travel as one number, and the colours are made again behind the shuffle.
    packed = edges.selectExpr("shiftleft(cast(lo as bigint), 32) | cast(hi as bigint) as pair", *["fresh"] * marked)
    low, high = (_colour(end, colours) for end in ("cast(shiftright(pair, 32) as int)", "cast(pair & 2147483647 as int)"))
    dealt = packed.repartition(tasks, F.expr(low), F.expr(high)).selectExpr("*", f"{low} as l", f"{high} as h")
    plain = {"compression": "zstd", "parquet.enable.dictionary": "false"}
    dealt.sortWithinPartitions("l", "h", "pair").write.partitionBy("l", "h").options(**plain).parquet(path)

    pairs = _tasks(colours)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = _folder_reader(path)
        for y, z in (pairs[n] for batch in batches for n in batch.column("id").to_pylist()):
            closing = read(y, z)
            if y != z:  # those from z to y as well, from the end of colour y
                closing = tuple(np.concatenate([there, _turned(back)]) for there, back in zip(closing, read(z, y)))
            closing = tuple(np.sort(part, kind="stable") for part in closing)
            whole, fresh = Closing(_both(closing), blocks), Closing(closing[1], blocks)
            if not len(closing[0]):  # one table is both
                fresh = whole
            at_z: list[Ends] = []
            for x in range(colours if len(whole.edges) else 0):
                xy = read(x, y)
                xz = xy if y == z else read(x, z)
                # Of the triangles with a fresh side each is found by the first of its sides that is.
                trials = [(xy[1], _both(xz), whole), (xy[0], xz[1], whole), (xy[0], xz[0], fresh)]
                counted = [corners(*trial, matrix_words) for trial in trials]
                for vertices, triangles in (found for found, _ in counted):
                    yield from _lists(vertices, triangles)
                at_z.extend(found for _, others in counted for found in others)
                if sum(len(vertices) for vertices, _ in at_z) > CORNERS_AT_ONCE:
                    at_z = [_added(*(list(part) for part in zip(*at_z)))]
            for table in (whole,) if fresh is whole else (whole, fresh):
                yield from _lists(*table.at_y())
                at_z.append(table.at_z())
            yield from _lists(*_added(*(list(part) for part in zip(*at_z))))

    tasks = min(len(pairs), 32 * spark.sparkContext.defaultParallelism)
    listed = spark.range(0, len(pairs), 1, tasks).mapInArrow(count, "slot int, v array<int>, t array<bigint>")
    dealt = listed.repartition(min(SLOTS, 4 * spark.sparkContext.defaultParallelism), "slot")
    return dealt.mapInArrow(_sums, "v int, links bigint")
