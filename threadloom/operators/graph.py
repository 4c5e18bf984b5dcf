"""The co-participation graph and its scores.

Vertices are subreddits; an edge joins two subreddits that share an author and is weighted by the
number of shared authors. Inside this module subreddits are numbers below ``2**31``, so a pair of
them is one 64-bit key; a graph of more than ``2**30`` subreddits is refused, not cut.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import cached_property

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.operators.author_blocks import count_in_blocks, groups_for
from threadloom.operators.lookup import BROADCAST_BYTES, lookup_in_pieces, lookup_join, pieces_of
from threadloom.operators.triangles import linked_neighbours, pair_key
from threadloom.plans.materialize import Stored, most_tasks, passing, store

VERTICES_PER_BUCKET = 1 << 16
MOST_VERTICES = 1 << 30
TILE = 256
ROWS_PER_TASK = 1_000_000
#: Tasks that pairs are made in, for each core: a task sums its pairs in memory, so more pairs need more tasks.
PAIR_TASKS = 256
#: Pairs that a task sums together.
PAIRS_AT_ONCE = 1 << 20
#: Names join stored edges where the authors make so many pairs for each two subreddits that there are; else they travel in the lists.
PAIRS_PER_EDGE = 4
#: Memberships are met in blocks, not shuffled as lists, where there are so many pairs for each of them, and so many pairs in all.
BLOCKED_PAIRS = 8
MOST_LISTED_PAIRS = 20_000_000
#: Of the tables that have a row for every membership or edge.
PACKED = "zstd"


class Graph:
    """``vertices`` and ``edges``; the vertices may be given as a function, which makes them when they are first asked for."""

    def __init__(self, vertices: DataFrame | Callable[[], DataFrame], edges: DataFrame):
        self._vertices = vertices
        self.edges = edges

    @cached_property
    def vertices(self) -> DataFrame:
        return self._vertices if isinstance(self._vertices, DataFrame) else self._vertices()


def vertex_index(memberships: DataFrame, expected: int) -> DataFrame:
    """A number for every subreddit: ``(subreddit, vid)``; ``expected`` is their rough count.

    Subreddits are dealt into hash buckets and ranked by size inside each; the number is the rank
    first, the bucket second. The number of buckets follows the number of subreddits, so no step
    sees more than a fixed share of them, and popular subreddits get neighbouring numbers, which
    the triangle count packs into the same words.
    """
    if expected > MOST_VERTICES:
        raise ValueError(f"about {expected} subreddits do not fit 31-bit numbers")
    buckets = math.ceil(max(expected, 1) / VERTICES_PER_BUCKET)
    sizes = memberships.groupBy("subreddit").agg(F.expr("count(*) as _n"))
    bucketed = sizes.selectExpr("subreddit", "_n", f"pmod(xxhash64(subreddit), {buckets}) as _bucket")
    rank = "row_number() over (partition by _bucket order by _n desc, subreddit) - 1"
    return bucketed.selectExpr("subreddit", f"cast(({rank}) * {buckets} + _bucket as int) as vid")


def _owned_in(tiles: DataFrame) -> DataFrame:
    """The pairs of every sorted tile by the larger number: ``(n, b, others)``, ``n`` the tile's weight."""
    owners = tiles.selectExpr("n", "tile", "posexplode(tile) as (at, b)").where("at > 0")
    return owners.selectExpr("n", "b", "slice(tile, 1, at) as others")


def owned_across(met: DataFrame) -> DataFrame:
    """The pairs between ``x`` and ``y``, two lists without a common number, by the larger number of each."""
    sides = met.selectExpr("inline(array(struct(x as own, y as other), struct(y as own, x as other)))")
    owners = sides.selectExpr("explode(own) as b", "other").selectExpr("1L as n", "b", "filter(other, a -> a < b) as others")
    return owners.where("size(others) > 0")


def count_owned(owned: DataFrame, tasks: int) -> DataFrame:
    """``(a, b, u)`` from rows ``(n, b, others)``.

    All pairs of a larger number meet in one task before they are made, so they are summed there and are never shuffled. Popular
    subreddits have the lower numbers, so what a number owns is bounded by its authors and by the subreddits more popular than it.
    """
    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow as pa
        import pyarrow.compute as pc

        held, pairs, most = [], 0, PAIRS_AT_ONCE

        def total() -> pa.Table:
            sums = pa.concat_tables(held).group_by(["a", "b"]).aggregate([("n", "sum")])
            return sums.select(["a", "b", "n_sum"]).rename_columns(["a", "b", "n"])

        def out(sums: pa.Table) -> Iterator[pa.RecordBatch]:
            return iter(sums.rename_columns(["a", "b", "u"]).to_batches(max_chunksize=PAIRS_AT_ONCE))

        for batch in batches:
            others, b = batch.column("others"), batch.column("b")
            row = pc.list_parent_indices(others)
            held.append(pa.table({"a": pc.list_flatten(others), "b": b.take(row), "n": batch.column("n").take(row)}))
            pairs += len(row)
            if pairs >= most:
                # The rows are sorted by the larger number: all but the last one have all of their pairs.
                sums = total()
                last = pc.equal(sums["b"], b[-1])
                yield from out(sums.filter(pc.invert(last)))
                held = [sums.filter(last)]
                pairs = len(held[0])
                most = max(PAIRS_AT_ONCE, 2 * pairs)
        if held:
            yield from out(total())

    number = owned.schema["b"].dataType.simpleString()
    dealt = owned.select("n", "b", "others").repartition(tasks, "b").sortWithinPartitions("b")
    return dealt.mapInArrow(summed, f"a {number}, b {number}, u bigint")


def named_across(met: DataFrame) -> DataFrame:
    """As ``owned_across``, by the names ``x_names`` and ``y_names`` of the sorted numbers ``x`` and ``y``."""
    sides = met.selectExpr(
        "inline(array(struct(x as own, x_names as named, y as other, y_names as names),"
        " struct(y as own, y_names as named, x as other, x_names as names)))"
    )
    owners = sides.selectExpr("posexplode(own) as (at, v)", "named", "other", "names")
    lower = "slice(names, 1, size(filter(other, a -> a < v))) as others"
    return owners.selectExpr("1L as n", "named[at] as b", lower).where("size(others) > 0")


def _met_tiles(tiles: DataFrame) -> DataFrame:
    """Every two different tiles ``(x, y)`` of an author, and their names where the tiles have them.

    Every combination of two tiles meets under its own key ``(author, _p, _q)``, so an author
    with very many subreddits is spread over all tasks.
    """
    def side(mark: str) -> list[str]:
        return [f"tile as {mark}", *[f"names as {mark}_names"] * ("names" in tiles.columns)]

    left = tiles.selectExpr(
        "author", *side("x"), "_part as _p", "explode(slice(sequence(0, _cuts), _part + 2, _cuts - _part - 1)) as _q"
    )
    right = tiles.selectExpr("author", *side("y"), "_part as _q", "explode(slice(sequence(0, _cuts), 1, _part)) as _p")
    return left.join(right, ["author", "_p", "_q"]).drop("author", "_p", "_q")


def _blocked(members: DataFrame, per_author: DataFrame, limit: int) -> DataFrame | None:
    """The pairs by blocks, if lists would be many times the memberships."""
    pairs = F.expr("coalesce(sum(cast(_n as double) * _n / 2), 0D) as pairs")
    rows, most = F.expr("coalesce(sum(_n), 0) as members"), F.expr("coalesce(max(_n), 0) as most")
    numbered = per_author.where("_n > 1").withColumn("id", F.monotonically_increasing_id())
    sizes = store(numbered, "author-numbers", pairs, rows, most)
    if sizes.seen["pairs"] <= BLOCKED_PAIRS * sizes.seen["members"]:
        return None
    held = lookup_join(members, sizes.table.drop("_n"), ["author"], sizes.bytes <= limit, most=sizes.seen["most"])
    groups = groups_for(sizes.seen["pairs"], members.sparkSession.sparkContext.defaultParallelism)
    return count_in_blocks(held.drop("author"), groups)


def shared_authors(members: DataFrame, tile: int = TILE, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``(a, b, u)`` of ``paired``."""
    return paired(members, tile, limit)[0]


def paired(members: DataFrame, tile: int = TILE, limit: int = BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """Shared authors ``(a, b, u)``, ``a < b``, of distinct ``(vid, author)`` rows, and whether they were met in blocks.

    Of rows with a ``subreddit`` too, ``a`` and ``b`` are the names of those numbers.

    Authors are cut into tiles of about ``tile`` subreddits. An ordinary author is one tile, and
    authors with the same tile collapse into one weighted row before any pair is made. An author
    with more subreddits is cut by a hash of the subreddit. Lists of subreddits are shuffled, not pairs;
    pairs are made in the tasks that sum them. Where the lists would be many times the memberships, all authors are cut by groups of
    subreddits instead (``count_in_blocks``), and what is found is made anew whenever it is read.
    """
    spark = members.sparkSession
    named = "subreddit" in members.columns
    if named:
        listed = ["sort_array(collect_list(struct(vid, subreddit))) as _both"]
    else:
        listed = ["sort_array(collect_list(vid)) as tile"]

    def split(tiles: DataFrame) -> DataFrame:
        return tiles.selectExpr("*", "_both.vid as tile", "_both.subreddit as names").drop("_both") if named else tiles

    per_author = members.groupBy("author").agg(F.count("*").alias("_n"))
    across = F.expr("coalesce(sum(cast(_n as double) * _n / 2), 0D) as pairs")
    heavy = store(per_author.where(f"_n > {tile}"), "heavy-authors", across)

    if heavy.rows and heavy.seen["pairs"] > MOST_LISTED_PAIRS:
        blocked = _blocked(members, per_author, limit)
        if blocked is not None:
            return blocked, True

    if heavy.rows:
        cuts = heavy.table.selectExpr("author", f"cast(ceil(_n / {tile}) as int) as _cuts")
        cut = lookup_join(members, cuts, ["author"], heavy.bytes <= limit, "left")
        parted = cut.withColumn("_part", F.expr("cast(coalesce(pmod(xxhash64(vid), _cuts), 0) as int)"))
        tiles = parted.groupBy("author", "_part").agg(F.expr(listed[0]), F.expr("max(_cuts) as _cuts"))
        tiles = store(split(tiles), "author-tiles").table
    else:
        tiles = split(members.groupBy("author").agg(F.expr(listed[0])))

    # The tasks are sized by the pairs that they will make, not by the bytes of the lists.
    made = F.expr("coalesce(sum(size(tile) * (size(tile) - 1) / 2), 0) as pairs")
    alike = tiles.where("size(tile) > 1").groupBy("tile").agg(F.expr("count(*) as n"), *[F.first("names").alias("names")] * named)
    profiles = store(alike, "profiles", made)
    owned = _owned_in(profiles.table.selectExpr("n", "names as tile") if named else profiles.table)
    if heavy.rows:
        met = _met_tiles(tiles.where("_cuts IS NOT NULL"))
        owned = owned.unionByName(named_across(met) if named else owned_across(met))
    pairs = profiles.seen["pairs"] + heavy.seen["pairs"]
    return count_owned(owned, most_tasks(spark, pairs, ROWS_PER_TASK, PAIR_TASKS)), False


def _numbered(memberships: DataFrame, limit: int, *names: str) -> tuple[Stored, DataFrame]:
    """The vertex index and the memberships by number, each pair once; ``names`` are further columns that are kept.

    A membership without a subreddit or without an author links nothing and is left out.
    """
    known = memberships.select("subreddit", "author").where("subreddit is not null and author is not null").distinct()
    members = store(known, "memberships", F.expr("approx_count_distinct(subreddit) as subreddits"), compression=PACKED)
    index = store(vertex_index(members.table, members.seen["subreddits"]), "vertex-index")
    numbered = lookup_join(members.table, index.table, ["subreddit"], index.bytes <= limit).select("vid", *names, "author")
    return index, store(numbered, "numbered", compression=PACKED).table


def co_membership(memberships: DataFrame, tile: int = TILE, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Number of shared authors for every pair of subreddits that shares any: ``(i, j, u_ij)``.

    ``memberships`` are (subreddit, author) rows, repeated ones count once; ``i < j`` by name.
    """
    with passing(memberships.sparkSession, "vertex-index", "edges", "author-blocks"):
        index, numbered = _numbered(memberships, limit, "subreddit")
        sizes = numbered.groupBy("author").agg(F.expr("cast(count(*) as double) as n"))
        pairs = sizes.selectExpr("coalesce(sum(n * (n - 1) / 2), 0D) as pairs").first()["pairs"]
        dense = pairs > PAIRS_PER_EDGE * index.rows * (index.rows - 1) / 2
        if dense:
            with passing(memberships.sparkSession, "edges"):
                edges = store_edges(shared_authors(numbered.drop("subreddit"), tile, limit)).table
        else:
            edges, blocked = paired(numbered, tile, limit)
            # Stored, as they may be read more than once; those met in blocks would be many times what they are made from.
            edges = edges if blocked else store_edges(edges).table
    if not dense:
        return edges.selectExpr("least(a, b) as i", "greatest(a, b) as j", "u as u_ij")
    for end, name in (("a", "_x"), ("b", "_y")):
        names = index.table.selectExpr(f"vid as {end}", f"subreddit as {name}")
        # A subreddit has fewer edges than there are subreddits.
        edges = lookup_join(edges, names, [end], index.bytes <= limit, most=index.rows)
    return edges.selectExpr("least(_x, _y) as i", "greatest(_x, _y) as j", "u as u_ij")


def both_ways(edges: DataFrame, *values: str) -> DataFrame:
    """Every edge from both of its ends: ``(v, w, values...)``."""
    carried = "".join(f", {name}" for name in values)
    return edges.selectExpr(f"inline(array(struct(a as v, b as w{carried}), struct(b as v, a as w{carried})))")


def vertex_degrees(edges: DataFrame) -> DataFrame:
    """``(v, k, ui, avg)``: incident edges, the sum of their shared authors, and the mean."""
    sums = both_ways(edges, "u").groupBy("v").agg(F.expr("count(*) as k"), F.expr("sum(u) as ui"))
    return sums.selectExpr("v", "k", "ui", "ui / cast(k as double) as avg")


def _most_edges(base: DataFrame) -> int:
    """The edges of the vertex that has most of them."""
    return base.agg(F.max("k")).first()[0] or 0


def edge_ends(edges: DataFrame, base: Stored, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Stored edges with the names, degrees and sums of both ends, all that their scores are made from; stored as ``edge-ends``."""
    pieces = pieces_of(base.bytes, limit)
    most = None if pieces else _most_edges(base.table)
    for end, mark, label in (("a", "x", "half-ends"), ("b", "y", "edge-ends")):
        side = base.table.selectExpr(f"v as {end}", f"subreddit as name_{mark}", f"k as k_{mark}", f"ui as ui_{mark}")
        if pieces > 1:
            edges = lookup_in_pieces(edges, side, end, pieces, label, PACKED)
        else:
            edges = lookup_join(edges, side, [end], pieces == 1, most=most)
    return edges if pieces > 1 else store(edges, "edge-ends", compression=PACKED).table


def edge_scores(ends: DataFrame) -> DataFrame:
    """Edges with the names, degrees and sums of both ends and the normalised weight, from ``edge_ends``.

    ``lo`` and ``hi`` are the ends by (degree, number).
    """
    ends = ends.selectExpr("*", "ui_x / cast(k_x as double) as avg_x", "ui_y / cast(k_y as double) as avg_y")

    def at_i(column: str) -> str:
        return f"if(name_x < name_y, {column}_x, {column}_y)"

    def at_j(column: str) -> str:
        return f"if(name_x < name_y, {column}_y, {column}_x)"

    return ends.selectExpr(
        "a",
        "b",
        "if(struct(k_x, a) < struct(k_y, b), a, b) as lo",
        "if(struct(k_x, a) < struct(k_y, b), b, a) as hi",
        f"{at_i('name')} as i",
        f"{at_j('name')} as j",
        "u as u_ij",
        f"{at_i('k')} as degree_i",
        f"{at_j('k')} as degree_j",
        f"cast({at_i('ui')} as double) as weighted_degree_i",
        f"cast({at_j('ui')} as double) as weighted_degree_j",
        f"{at_i('avg')} as avg_weighted_edge_weight_i",
        f"{at_j('avg')} as avg_weighted_edge_weight_j",
        "u / ((avg_x + avg_y) / 2) as w_ij",
    )


def neighbour_sums(scored: DataFrame, base: DataFrame, small: bool | None, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``(v, dd, wdd)``: degrees and summed edge weights, added over the neighbours of v.

    ``small`` says whether the sums of the neighbours can be broadcast; None measures them.
    """
    weights = both_ways(scored, "w_ij").groupBy("v").agg(F.expr("sum(w_ij) as nsw"))
    around = base.select("v", "k").join(weights, "v").selectExpr("v as w", "k as nk", "nsw")
    if small is None:
        held = store(around, "around")
        around, small = held.table, held.bytes <= limit
    met = lookup_join(both_ways(scored), around, ["w"], small, most=None if small else _most_edges(base))
    return met.groupBy("v").agg(F.expr("sum(nk) as dd"), F.expr("sum(nsw) as wdd"))


def build_graph(memberships: DataFrame, tile: int = TILE, limit: int = BROADCAST_BYTES) -> Graph:
    """All edge and vertex scores from (subreddit, author) rows.

    Deleted accounts are not removed here; filter them first.
    """
    spark = memberships.sparkSession
    with passing(spark, "vertex-base", "edge-ends"):
        with passing(spark, "vertex-index", "edges"):
            index, numbered = _numbered(memberships, limit)
            edges = store_edges(shared_authors(numbered, tile, limit))
        return score_graph(index, edges, limit)


def store_edges(edges: DataFrame, *metrics: Column) -> Stored:
    """Stored edges ``(a, b, u)``; sorted, their files are small."""
    return store(edges.sortWithinPartitions("b", "a"), "edges", *metrics, compression=PACKED)


def score_graph(index: Stored, edges: Stored, limit: int = BROADCAST_BYTES, links: DataFrame | None = None) -> Graph:
    """Scores of a numbered graph: ``index(subreddit, vid)`` and ``edges(a, b, u)``.

    ``links`` has the linked neighbours ``(v, links)`` where they are known already. What the vertices need beyond the edges, among
    it the triangles, is computed when they are asked for.
    """
    spark = edges.table.sparkSession
    named = index.table.withColumnRenamed("vid", "v")
    with passing(spark, "vertex-base", "edge-ends"):
        base = store(named.join(vertex_degrees(edges.table).drop("avg"), "v", "left"), "vertex-base")
        scored = edge_scores(edge_ends(edges.table, base, limit))

    def vertices() -> DataFrame:
        with passing(spark, "vertices"):
            sums = neighbour_sums(scored, base.table, None, limit)
            linked = linked_neighbours(scored, limit) if links is None else links
            found = (
                base.table.join(sums, "v", "left")
                .join(linked, "v", "left")
                .selectExpr(
                    "subreddit as i",
                    "coalesce(ui, 0L) as ui",
                    "coalesce(k, 0L) as degree",
                    "ui / cast(k as double) as weighted_degree",
                    "coalesce(dd, 0L) as degree_degree",
                    "coalesce(wdd, 0D) as weighted_degree_degree",
                    "if(k > 1, cast(coalesce(links, 0L) as double) / (cast(k as double) * (k - 1)), 0D)"
                    " as local_clustering_coefficient",
                )
            )
            return store(found, "vertices").table

    return Graph(vertices, scored.drop("a", "b", "lo", "hi"))


def graph_summary(graph: Graph) -> DataFrame:
    """Vertex and edge counts, both read from stored tables in one job."""
    vertices = graph.vertices.select(F.lit("vertices").alias("part"))
    parts = vertices.unionAll(graph.edges.select(F.lit("edges").alias("part")))
    return parts.groupBy("part").agg(F.count("*").alias("count"))
