"""How many neighbours of a vertex are neighbours of each other.

Input edges are ``(a, b, lo, hi)``, numbers below ``2**31``: ``a < b``, ``lo`` and ``hi`` the same ends by
(degree, number). Ordered this way a vertex has at most ``sqrt(2 * edges)`` higher neighbours,
also when it is a hub. Three exact ways exist, and the measured work decides:

* small sparse graphs: the pairs of higher neighbours of every ``lo`` are looked up among the edges, which are broadcast;
* small dense graphs: neighbours are packed into bit blocks, and every edge intersects the blocks of
  its ends, one row per 256 neighbours instead of one per neighbour;
* graphs whose edges or blocks are too large to broadcast: vertices are coloured, and every triple of colours is a part of
  bounded size whose triangles are found by themselves (``coloured_triangles``). A join would shuffle every pair of neighbours, many
  times the edges, and bring all edges of a hub to one task; by colours the edges are written once and a hub never lies in one.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.operators.coloured_triangles import colours_for, linked_by_colours
from threadloom.operators.lookup import BROADCAST_BYTES, lookup_join
from threadloom.plans.materialize import Stored, most_tasks, store

LANES = 4
BLOCK_SHIFT = 8
ROWS_PER_TASK = 1_000_000


def pair_key(a: str, b: str) -> str:
    """Two numbers below ``2**31`` as one 64-bit key."""
    return f"(shiftleft(cast({a} as bigint), 32) | cast({b} as bigint))"


def linked_neighbours(edges: DataFrame, limit: int = BROADCAST_BYTES, method: str = "auto") -> DataFrame:
    """``(v, links)``: ordered pairs of neighbours of v that are joined by an edge."""
    ends = edges.select("a", "b", "lo", "hi")
    size = ends.selectExpr("count(*) as edges", "coalesce(max(b), 0) as top").first()
    small = size["edges"] * 64 <= limit
    # A vertex has at most one row per block and one per neighbour; a row of blocks counts as 16 bytes a column.
    per_vertex = math.ceil((size["top"] + 1) / (64 * LANES))
    packs = 16 * (2 + LANES) * min(2 * size["edges"], (size["top"] + 1) * per_vertex) <= limit
    if method == "auto":
        method = _cheapest(ends) if small else "blocks" if packs else "colours"
    if method == "pairs" and small:
        return _by_pairs(ends)
    if method == "blocks" and packs:
        return _by_blocks(ends, _packed(ends))
    arcs = ends.select("lo", "hi")
    return linked_by_colours(arcs, colours_for(arcs)[0], blocks=method == "blocks")


def _cheapest(ends: DataFrame) -> str:
    """Whether there are fewer pairs of higher neighbours to look up than blocks to intersect."""
    higher = ends.groupBy("lo").agg(F.expr("count(*) as o"))
    work = higher.selectExpr(
        "coalesce(sum(o * (o - 1) / 2), 0) as pairs", "coalesce(sum(o), 0) as edges", "count(*) as vertices"
    ).first()
    # An edge meets at most one row per block. Popular vertices have low numbers, so the vertices with
    # higher neighbours roughly tell how many blocks there are; the estimate only chooses between two exact ways.
    blocks = math.ceil(work["vertices"] / 64 / LANES) + 1
    return "pairs" if work["pairs"] <= 2 * work["edges"] * blocks else "blocks"


def _by_pairs(edges: DataFrame) -> DataFrame:
    # The tasks are sized by the pairs they will make, not by the bytes of the edges; the pairs stay where they are made.
    work = edges.groupBy("lo").agg(F.expr("count(*) as o")).selectExpr("coalesce(sum(o * (o - 1) / 2), 0) as pairs").first()
    tasks = most_tasks(edges.sparkSession, work["pairs"], ROWS_PER_TASK)
    spread = edges.repartition(tasks, "lo") if tasks > 1 else edges
    pairs = spread.selectExpr("lo", "hi as x").join(spread.selectExpr("lo", "hi as y"), "lo").where("x < y")
    pairs = pairs.selectExpr("lo", "x", "y", f"{pair_key('x', 'y')} as pair")
    closing = edges.selectExpr(f"{pair_key('a', 'b')} as pair")
    closed = lookup_join(pairs, closing, ["pair"], True, "left_semi")
    return closed.selectExpr("explode(array(lo, x, y)) as v").groupBy("v").agg(F.expr("2 * count(*) as links"))


def _packed(edges: DataFrame) -> Stored:
    """``(v, block, l0..)``: the neighbours of every vertex as bits."""
    bits = [
        f"coalesce(bit_or(if(shiftright(w, 6) & {LANES - 1} = {n}, shiftleft(1L, cast(w & 63 as int)), 0L)), 0L) as l{n}"
        for n in range(LANES)
    ]
    neighbours = edges.selectExpr("inline(array(struct(a as v, b as w), struct(b as v, a as w)))")
    blocks = neighbours.selectExpr("v", "w", f"shiftright(w, {BLOCK_SHIFT}) as block").groupBy("v", "block")
    return store(blocks.agg(*[F.expr(lane) for lane in bits]), "blocks", F.expr("approx_count_distinct(v) as vertices"))


def _by_blocks(edges: DataFrame, packed: Stored) -> DataFrame:
    # An edge meets as many rows as its lower end has blocks; on average those that were packed.
    each = packed.rows / max(1, packed.seen["vertices"])
    tasks = most_tasks(edges.sparkSession, math.ceil(edges.count() * each), ROWS_PER_TASK)

    def of(end: str, mark: str) -> DataFrame:
        return packed.table.selectExpr(f"v as {end}", "block", *[f"l{n} as {mark}{n}" for n in range(LANES)])

    probes = edges.select("lo", "hi")
    if tasks > 1:
        probes = probes.repartition(tasks, "lo", "hi")
    probes = lookup_join(probes, of("lo", "x"), ["lo"], True)
    met = lookup_join(probes, of("hi", "y"), ["hi", "block"], True)
    common = " + ".join(f"bit_count(x{n} & y{n})" for n in range(LANES))
    met = met.selectExpr("lo", "hi", f"cast({common} as bigint) as c").where("c > 0")
    ends = met.selectExpr("inline(array(struct(lo as v, c), struct(hi as v, c)))")
    return ends.groupBy("v").agg(F.expr("sum(c) as links"))
