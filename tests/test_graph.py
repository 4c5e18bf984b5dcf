"""The graph: worked examples, properties, brute force, exports."""

from __future__ import annotations

import itertools
import math
import os
import random
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from threadloom.operators import author_blocks as ab
from threadloom.operators import coloured_triangles as ct
from threadloom.operators import graph as g
from threadloom.operators import growing_graph as gg
from threadloom.operators import reload as r
from threadloom.operators import triangles as tr
from threadloom.operators.filters import filter_edges
from threadloom.operators.lookup import fits_broadcast, lookup_join
from threadloom.plans import materialize
from threadloom.plans import participation_graph as pg
from threadloom.plans.materialize import most_tasks, scratch_path
from threadloom.sinks import files


def members(spark, pairs):
    return spark.createDataFrame(pairs, "subreddit string, author string")


def vertex(graph):
    return {row["i"]: row for row in graph.vertices.collect()}


def edge(graph):
    return {(row["i"], row["j"]): row for row in graph.edges.collect()}


def brute_force(pairs):
    """The definitions, evaluated with sets and loops."""
    of_author = defaultdict(set)
    for subreddit, author in pairs:
        of_author[author].add(subreddit)
    u = defaultdict(int)
    for subreddits in of_author.values():
        for x, y in itertools.combinations(sorted(subreddits), 2):
            u[x, y] += 1
    near = defaultdict(dict)
    for (x, y), n in u.items():
        near[x][y] = near[y][x] = n
    names = {subreddit for subreddit, _ in pairs}
    ui = {v: sum(near[v].values()) for v in names}
    avg = {v: ui[v] / len(near[v]) for v in names if near[v]}
    w = {e: n / ((avg[e[0]] + avg[e[1]]) / 2) for e, n in u.items()}
    sw = defaultdict(float)
    for (x, y), weight in w.items():
        sw[x] += weight
        sw[y] += weight
    out = {}
    for v in names:
        k = len(near[v])
        linked = sum(1 for p in near[v] for q in near[v] if q in near[p])
        out[v] = (
            ui[v],
            k,
            sum(len(near[n]) for n in near[v]),
            round(sum(sw[n] for n in near[v]), 6),
            linked / (k * (k - 1)) if k > 1 else 0.0,
        )
    return u, w, out


def scores(graph):
    return {
        row["i"]: (
            row["ui"],
            row["degree"],
            row["degree_degree"],
            round(row["weighted_degree_degree"], 6),
            row["local_clustering_coefficient"],
        )
        for row in graph.vertices.collect()
    }


def test_triangle(spark):
    graph = g.build_graph(members(spark, [(s, "u") for s in "ABC"]))
    assert {e: (row["u_ij"], row["w_ij"]) for e, row in edge(graph).items()} == {
        ("A", "B"): (1, 1.0),
        ("A", "C"): (1, 1.0),
        ("B", "C"): (1, 1.0),
    }
    assert scores(graph) == {s: (2, 2, 4, 4.0, 1.0) for s in "ABC"}


def test_path(spark):
    graph = g.build_graph(members(spark, [("A", "u"), ("B", "u"), ("B", "v"), ("C", "v")]))
    assert scores(graph) == {"A": (1, 1, 2, 2.0, 0.0), "B": (2, 2, 2, 2.0, 0.0), "C": (1, 1, 2, 2.0, 0.0)}
    assert {row["weighted_degree"] for row in graph.vertices.collect()} == {1.0}


def test_weight_two_and_isolated_vertex(spark):
    graph = g.build_graph(members(spark, [("A", "u"), ("B", "u"), ("A", "v"), ("B", "v"), ("A", "v"), ("C", "w")]))
    row = edge(graph)["A", "B"]
    assert (row["u_ij"], row["weighted_degree_i"], row["avg_weighted_edge_weight_i"], row["w_ij"]) == (2, 2.0, 2.0, 1.0)
    alone = vertex(graph)["C"]
    assert (alone["ui"], alone["degree"], alone["weighted_degree"]) == (0, 0, None)
    assert alone["local_clustering_coefficient"] == 0.0
    assert math.isnan([row for row in files.vertex_list(graph.vertices).collect() if row["i"] == "C"][0][3])


def test_no_shared_author(spark):
    graph = g.build_graph(members(spark, [("A", "u"), ("B", "v")]))
    assert graph.edges.count() == 0
    assert rows(g.graph_summary(graph)) == [("vertices", 2)]


def random_members(seed, subreddits, authors, hubs):
    """Skewed memberships: some authors are nearly everywhere, many share the same set."""
    rng = random.Random(seed)
    pairs = {(f"s{rng.randrange(subreddits)}", f"a{rng.randrange(authors)}") for _ in range(authors * 3)}
    for hub in range(hubs):
        pairs |= {(f"s{n}", f"hub{hub}") for n in range(subreddits) if rng.random() < 0.7}
    pairs |= {(f"s{n}", f"copy{k}") for k in range(authors) for n in (1, 2, 3)}
    return sorted(pairs)


@pytest.mark.parametrize(("tile", "limit"), [(2, 1 << 26), (5, 0), (256, 1 << 26)])
def test_random_graph_equals_brute_force(spark, tile, limit):
    pairs = random_members(3, 40, 60, 1)
    u, w, expected = brute_force(pairs)
    graph = g.build_graph(members(spark, pairs), tile=tile, limit=limit)
    found = edge(graph)
    assert {e: row["u_ij"] for e, row in found.items()} == u
    assert all(math.isclose(found[e]["w_ij"], w[e]) for e in w)
    assert scores(graph) == expected


def test_properties(spark):
    graph = g.build_graph(members(spark, random_members(11, 50, 40, 2)), tile=7)
    total = graph.edges.agg({"u_ij": "sum"}).first()[0]
    found = graph.vertices.collect()
    assert sum(row["ui"] for row in found) == 2 * total
    assert sum(row["degree"] for row in found) == 2 * graph.edges.count()
    assert all(0 <= row["local_clustering_coefficient"] <= 1 for row in found)
    assert graph.edges.where("i >= j").count() == 0


def test_both_triangle_methods_agree(spark):
    pairs = random_members(5, 700, 500, 1)
    graph = g.build_graph(members(spark, pairs))
    numbers = {row["i"]: n for n, row in enumerate(graph.vertices.collect())}
    number = spark.createDataFrame(list(numbers.items()), "name string, n bigint")
    number = number.selectExpr("name", "cast(n as int) as n")
    ends = graph.edges.select("i", "j", "degree_i", "degree_j")
    for end in "ij":
        ends = ends.join(number.selectExpr(f"name as {end}", f"n as n{end}"), end)
    ends = ends.selectExpr(
        "least(ni, nj) as a",
        "greatest(ni, nj) as b",
        "if(struct(degree_i, ni) < struct(degree_j, nj), ni, nj) as lo",
        "if(struct(degree_i, ni) < struct(degree_j, nj), nj, ni) as hi",
    ).cache()
    by_pairs = rows(g.linked_neighbours(ends, method="pairs"))
    assert by_pairs == rows(g.linked_neighbours(ends, method="blocks"))
    assert by_pairs == rows(g.linked_neighbours(ends, limit=0, method="pairs"))
    assert by_pairs == rows(g.linked_neighbours(ends, limit=0, method="blocks"))
    assert by_pairs == rows(g.linked_neighbours(ends, method="colours"))
    for colours in (1, 2, 5):
        for words in (0, 1 << 20):
            found = ct.linked_by_colours(ends.select("lo", "hi"), colours, words)
            assert by_pairs == rows(found), (colours, words)
    assert by_pairs
    assert ct.linked_by_colours(ends.select("lo", "hi").limit(0), 3).count() == 0


def test_no_colour_triple_is_large_because_of_a_hub(spark):
    """A hub that is linked with all, and a chain among its neighbours."""
    n = 3000
    edges = spark.range(1, n).selectExpr("cast(id as int) as lo", "0 as hi").unionByName(
        spark.range(1, n - 1).selectExpr("cast(id as int) as lo", "cast(id + 1 as int) as hi")
    )
    colours, largest = ct.colours_for(edges, 400)
    parts = ct.coloured(edges, colours).groupBy("part").count()
    sizes = [row["count"] for row in parts.collect()]
    assert colours > 1 and max(sizes) == largest <= 400 or colours == ct.MOST_COLOURS
    assert max(sizes) < 2 * n // 5  # the hub's 2,999 edges don't meet in one task
    found = dict(rows(ct.linked_by_colours(edges, colours)))
    assert found[0] == 2 * (n - 2) and found[1] == 2 and found[5] == 4


def test_vertex_numbers_are_unique_over_buckets(spark, monkeypatch):
    monkeypatch.setattr(g, "VERTICES_PER_BUCKET", 10)
    pairs = random_members(5, 60, 80, 1)
    index = g.vertex_index(members(spark, pairs), 60)
    assert index.select("vid").distinct().count() == index.count() == len({s for s, _ in pairs})
    assert index.agg({"vid": "max"}).first()[0] >= 60
    assert scores(g.build_graph(members(spark, pairs))) == brute_force(pairs)[2]


def test_filter_edges(spark):
    edges = spark.createDataFrame([("a", "b", 30.0), ("a", "c", 29.9), ("b", "c", 31.0)], "i string, j string, w_ij double")
    assert [row["w_ij"] for row in filter_edges(edges).collect()] == [31.0, 30.0]


def test_export_and_reload(spark):
    pairs = random_members(9, 30, 40, 1) + [("alone, \"quoted\"", "z")]
    graph = g.build_graph(members(spark, pairs))
    paths = {name: scratch_path(spark, name) for name in ("edge_path", "vertex_path", "dot_path")}
    pg.export_graph(graph, **paths)
    again = pg.graph_from_lists(spark, paths["vertex_path"], paths["edge_path"])
    assert rows(again.vertices) == rows(graph.vertices)
    assert rows(again.edges) == rows(graph.edges)
    header = spark.read.text(paths["edge_path"]).first()["value"]
    assert header == (
        "i,j,U_ij,degree_i,degree_j,weighted-degree_i,weighted-degree_j,"
        "avg-weighted-edge-weight_i,avg-weighted-edge-weight_j,W_ij"
    )


def test_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "v.csv").write_text(
        "Ui,extra,i,degree,weighted-degree,degree-degree,weighted-degree-degree,local-clustering-coefficient\n"
        "4,x,A,9,9.0,7,1.5,0.25\n"
    )
    row = pg.read_vertex_list(spark, str(tmp_path / "v.csv")).first()
    assert (row["i"], row["ui"], row["degree_degree"], row["local_clustering_coefficient"]) == ("A", 4, 7, 0.25)


def test_reload_checks_endpoints_and_repeated_pairs(spark):
    graph = g.build_graph(members(spark, [(s, "u") for s in "ABC"]))
    swapped = graph.edges.selectExpr("j as i", "i as j", *graph.edges.columns[2:])
    both = r.load_graph(graph.vertices, graph.edges.unionByName(swapped))
    assert rows(both.vertices) == rows(graph.vertices)
    assert both.edges.count() == 3
    fewer = graph.vertices.where("i <> 'C'")
    assert rows(r.unknown_endpoints(graph.edges, fewer)) == [("A", "C", "C"), ("B", "C", "C")]
    assert rows(r.unknown_endpoints(graph.edges, fewer, limit=0)) == [("A", "C", "C"), ("B", "C", "C")]
    with pytest.raises(ValueError, match="unknown vertex C"):
        r.load_graph(fewer, graph.edges)
    assert rows(r.load_graph(fewer, graph.edges, strict=False).edges, "i", "j") == [("A", "B")]


def test_repeated_rows_and_gaps(spark):
    data = spark.createDataFrame(
        [("A", "u"), ("A", "u"), ("B", "u"), ("C", None), ("D", None), (None, "u")], "subreddit string, author string"
    )
    assert rows(g.co_membership(data)) == [("A", "B", 1)]
    graph = g.build_graph(data)
    assert rows(graph.vertices, "i") == [("A",), ("B",)] and graph.edges.count() == 1


def test_repeated_vertices_count_once(spark):
    graph = g.build_graph(members(spark, [(s, "u") for s in "ABC"]))
    again = r.load_graph(graph.vertices.unionByName(graph.vertices), graph.edges)
    assert rows(again.vertices) == rows(graph.vertices) and rows(again.edges) == rows(graph.edges)
    fewer = r.load_graph(graph.vertices.where("i <> 'C'"), graph.edges, strict=False)
    assert {row["ui"] for row in fewer.vertices.collect()} == {1}


def test_tasks_stay_within_the_cluster(spark):
    cores = spark.sparkContext.defaultParallelism
    assert most_tasks(spark, 10**9, 1_000_000) <= 32 * cores
    assert most_tasks(spark, 10**14, 1_000_000) == 32 * cores
    assert most_tasks(spark, 3_500_000, 1_000_000) == 4 and most_tasks(spark, 0, 1_000_000) == 1


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString() + df._jdf.queryExecution().executedPlan().toString()


def test_only_hot_keys_are_copied(spark):
    facts = spark.range(1000).selectExpr("if(id < 700, 'bot', concat('k', id % 90)) as key", "id")
    facts = facts.unionByName(spark.range(50).selectExpr("cast(null as string) as key", "-id as id"))
    lookup = spark.createDataFrame([("bot", 2), *((f"k{k}", k) for k in range(90)), (None, 5)], "key string, two int")
    joined = lookup_join(facts, lookup, ["key"], False, hot_rows=100)
    assert joined.count() == 1000 and "SortMergeJoin" in plan_of(joined)
    right = joined._jdf.queryExecution().optimizedPlan().toString().split("Generate explode")[1]
    copied = lookup.join(spark.createDataFrame([("bot", 7)], "key string, _cuts int"), "key", "left")
    assert copied.selectExpr("sum(coalesce(_cuts, 1))").first()[0] == len(rows(lookup)) + 6 and "sequence(0" in right
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert joined.where("key = 'bot'").select(F.spark_partition_id()).distinct().count() > 1  # one key, several tasks
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    # Without a hot key nothing is copied, and nothing is broadcast.
    even = lookup_join(facts, lookup, ["key"], False)
    assert "Generate" not in plan_of(even) and "BroadcastHashJoin" not in plan_of(even)


def test_dot(spark):
    graph = g.build_graph(members(spark, [("a.b", "u"), ("a_b", "u")]))
    path = scratch_path(spark, "dot")
    files.write_dot(graph, path)
    text = [row["value"] for row in spark.read.text(path).collect()]
    assert sorted(text) == sorted(
        [
            "strict graph G {",
            '  "a_b" [ degree="1" weightedDegree="1" degreeDegree="1" weightedDegreeDegree="1.0"'
            ' localClusteringCoefficient="0.0" ];',
            '  "a_b" [ degree="1" weightedDegree="1" degreeDegree="1" weightedDegreeDegree="1.0"'
            ' localClusteringCoefficient="0.0" ];',
            '  "a_b" -- "a_b" [ weight="1.0" ];',
            "}",
        ]
    )
    assert rows(files.dot_id_collisions(graph.vertices)) == [('"a_b"', 2, "a.b")]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_lookup_join_paths_agree(spark, how):
    facts = spark.range(500).selectExpr("if(id % 3 = 0, 7, if(id % 11 = 0, null, id % 50)) as key", "id % 2 as other", "id")
    lookup = spark.range(30).selectExpr("if(id = 29, null, id) as key", "id % 2 as other", "id * 2 as twice")
    assert fits_broadcast(lookup) and not fits_broadcast(lookup, 10)
    for keys in (["key"], ["key", "other"]):
        side = lookup if len(keys) == 2 else lookup.drop("other")
        small = rows(lookup_join(facts, side, keys, True, how))
        for hot_rows in (1_000_000, 100, 3, None):
            assert small == rows(lookup_join(facts, side, keys, False, how, hot_rows=hot_rows)), (keys, hot_rows)


@pytest.mark.parametrize(("tile", "limit"), [(256, 1 << 26), (3, 0)])
def test_a_grown_graph_equals_one_built_at_once(spark, tile, limit):
    pairs = random_members(21, 45, 50, 2)
    rng = random.Random(5)
    cuts = [[pair for pair in pairs if rng.random() < share] for share in (0.6, 0.3)]
    cuts.append([*pairs, ("only here", "new author"), ("only here", "a1"), (None, "a1"), ("s1", None), pairs[0]])
    state = gg.start_graph(members(spark, cuts[0]), tile, limit)
    assert scores(gg.scores(state, limit)) == brute_force(set(cuts[0]))[2]
    path = scratch_path(spark, "grown")
    seen = set(cuts[0])
    for number, more in enumerate(cuts[1:]):
        gg.save_graph(state, path, number)
        state = gg.extend_graph(gg.open_graph(spark, path), members(spark, more), tile, limit)
        seen |= {(s, a) for s, a in more if s is not None and a is not None}
        u, w, expected = brute_force(seen)
        graph = gg.scores(state, limit)
        assert {e: row["u_ij"] for e, row in edge(graph).items()} == u
        assert scores(graph) == expected
    again = gg.extend_graph(state, members(spark, pairs), tile, limit)
    assert rows(again.edges.table) == rows(state.edges.table) and rows(again.links.table) == rows(state.links.table)


def test_growing_from_nothing(spark):
    empty = gg.start_graph(members(spark, []))
    assert gg.scores(empty).vertices.count() == 0
    grown = gg.extend_graph(empty, members(spark, [(s, "u") for s in "ABC"]))
    assert scores(gg.scores(grown)) == {s: (2, 2, 4, 4.0, 1.0) for s in "ABC"}
    with pytest.raises(ValueError, match="no graph is kept"):
        gg.open_graph(spark, scratch_path(spark, "nothing"))


def test_fresh_triangles_by_colours(spark):
    """Triangles with a fresh side, against all of them less those of the old edges."""
    draw = random.Random(11)
    edges = {tuple(sorted(draw.sample(range(60), 2))) for _ in range(500)}
    listed = [(lo, hi, draw.random() < 0.3) for lo, hi in sorted(edges)]
    ends = spark.createDataFrame(listed, "lo int, hi int, fresh boolean").cache()

    def links(kept):
        near = {v: {a + b - v for a, b in kept if v in (a, b)} for v in range(60)}
        found = {v: sum((min(p, q), max(p, q)) in kept for p in near[v] for q in near[v] if p != q) for v in near}
        return found

    whole, old = links(edges), links({(lo, hi) for lo, hi, fresh in listed if not fresh})
    expected = {v: whole[v] - old[v] for v in whole if whole[v] > old[v]}
    for colours, blocks in ((1, False), (3, False), (2, True)):
        assert dict(rows(ct.linked_by_colours(ends, colours, blocks=blocks))) == expected
    assert dict(rows(ct.linked_by_colours(ends.drop("fresh"), 3, 0, blocks=True))) == {v: n for v, n in whole.items() if n}


def test_triangles_shuffle_no_pairs_of_neighbours(spark, monkeypatch):
    """A graph that can't be broadcast makes no pairs by a join, whatever the method."""

    def joined(*args, **kwargs):
        raise AssertionError("pairs of neighbours are joined")

    monkeypatch.setattr(tr, "lookup_join", joined)
    n = 40
    ends = spark.createDataFrame([(a, b, a, b) for a in range(n) for b in range(a + 1, n)], "a int, b int, lo int, hi int")
    for method in ("auto", "pairs", "blocks", "colours"):
        found = dict(rows(g.linked_neighbours(ends, limit=0, method=method)))
        assert found == {v: (n - 1) * (n - 2) for v in range(n)}


def test_new_links_beyond_twice_the_edges(spark):
    """Fresh edges around which there is more to look at than there are edges."""
    n = 24
    edges = spark.createDataFrame([(a, b) for a in range(n) for b in range(a + 1, n)], "a int, b int")
    found = dict(rows(gg.new_links(edges, edges.where("(a + b) % 2 = 0"))))
    # All triangles have a side with both ends odd or both even.
    assert found == {v: (n - 1) * (n - 2) for v in range(n)}


@pytest.fixture
def stored_labels(monkeypatch, tmp_path):
    """The labels of what is stored, in a folder of the test's own."""
    monkeypatch.setattr(materialize, "shared_folder", lambda spark: str(tmp_path))
    return lambda: sorted(name.rpartition("-")[0] for name in os.listdir(tmp_path))


@pytest.mark.parametrize("limit", [0, 1 << 26])
def test_a_graph_keeps_only_the_tables_that_it_reads(spark, stored_labels, limit):
    pairs = random_members(5, 40, 30, 2)
    graph = g.build_graph(members(spark, pairs), tile=7, limit=limit)
    edges = edge(graph)
    assert stored_labels() == ["edge-ends", "vertex-base"]  # no triangle has been looked for, nothing else is left
    assert len(vertex(graph)) == len({subreddit for subreddit, _ in pairs})
    assert stored_labels() == ["edge-ends", "vertex-base", "vertices"]
    assert edge(graph) == edges and graph.vertices is graph.vertices


def test_pairs_of_a_larger_number_are_summed_where_they_are_made(spark):
    held = spark.createDataFrame([(2, [1, 3, 8]), (1, [3, 8]), (5, [4])], "n long, tile array<int>")
    counted = g.count_owned(g._owned_in(held), 3)
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1  # the lists are shuffled, the pairs are not
    assert rows(counted) == [(1, 3, 2), (1, 8, 2), (3, 8, 3)]
    met = spark.createDataFrame([([1, 9], [4, 5]), ([2], [3])], "x array<int>, y array<int>")
    assert rows(g.count_owned(g.owned_across(met), 3)) == [(1, 4, 1), (1, 5, 1), (2, 3, 1), (4, 9, 1), (5, 9, 1)]


def test_what_a_growing_graph_was_made_from_is_deleted(spark, stored_labels):
    pairs = random_members(6, 40, 30, 2)
    state = gg.extend_graph(gg.start_graph(members(spark, pairs[::2]), tile=7), members(spark, pairs), tile=7)
    assert stored_labels() == sorted(2 * gg.STATE)
    grown, whole = gg.scores(state), g.build_graph(members(spark, pairs))
    assert edge(grown) == edge(whole) and vertex(grown).keys() == vertex(whole).keys()


@pytest.mark.parametrize("limit", [0, 1 << 26])
def test_shared_authors_are_counted_once_whatever_the_joins_look_at(spark, stored_labels, limit):
    pairs = random_members(8, 40, 30, 2)
    found = g.co_membership(members(spark, pairs), tile=4, limit=limit)
    assert {*stored_labels()} - {"hot-keys"} == {"edges", "vertex-index"}  # the joins for names read stored edges
    assert rows(found) == sorted(((x, y, n) for (x, y), n in brute_force(pairs)[0].items()), key=repr)


def only_measured(monkeypatch, module):
    """Joins of edges at their ends, seen by ``lookup_join``; those without a broadcast are refused."""
    seen, joined = [], module.lookup_join

    def watched(facts, lookup, on, small, *args, **kwargs):
        if list(on) in (["a"], ["b"]):
            assert small, "the edges are shuffled"
            seen.append(on[0])
        return joined(facts, lookup, on, small, *args, **kwargs)

    monkeypatch.setattr(module, "lookup_join", watched)
    return seen


def test_ends_are_looked_up_in_pieces(spark, monkeypatch, stored_labels):
    """A lookup some times the limit joins the edges piece by piece, and the edges are not shuffled."""
    only_measured(monkeypatch, g)
    pairs = random_members(12, 40, 30, 2)
    graph = g.build_graph(members(spark, pairs), limit=700)
    u, w, expected = brute_force(set(pairs))
    assert {e: (row["u_ij"], row["w_ij"]) for e, row in edge(graph).items()} == {e: (u[e], w[e]) for e in u}
    labels = stored_labels()
    assert set(labels) == {"edge-ends", "vertex-base"} and 2 <= labels.count("edge-ends") <= 16
    assert scores(graph) == expected


def test_edges_of_a_growing_graph_are_directed_by_measured_lookups(spark, monkeypatch):
    pairs = random_members(13, 40, 30, 2)
    for limit, directed in ((1 << 26, ["a", "b"] * 2), (300, [])):
        seen = only_measured(monkeypatch, gg)
        state = gg.start_graph(members(spark, pairs[::2]), limit=limit)
        state = gg.extend_graph(state, members(spark, pairs), limit=limit)
        assert seen == directed  # in pieces beyond the limit
        monkeypatch.undo()
        assert scores(gg.scores(state)) == brute_force(set(pairs))[2]


def test_names_travel_with_the_lists(spark, monkeypatch):
    """Names join the edges only where many pairs become one edge."""
    seen = only_measured(monkeypatch, g)
    sparse = [(f"s{draw}", f"a{n}") for n in range(12) for draw in random.Random(n).sample(range(60), 9)]
    found = g.co_membership(members(spark, sparse), tile=4, limit=0)
    assert rows(found) == sorted(((x, y, n) for (x, y), n in brute_force(sparse)[0].items()), key=repr) and not seen
    dense = [(s, f"a{n}") for n in range(40) for s in "ZYXWV"]
    assert rows(g.co_membership(members(spark, dense), tile=2)) == [
        (x, y, 40) for x, y in itertools.combinations("VWXYZ", 2)
    ]
    assert seen == ["a", "b"]


def test_pairs_are_summed_in_portions(spark, monkeypatch):
    """A larger number whose pairs come in several portions is counted once."""
    monkeypatch.setattr(g, "PAIRS_AT_ONCE", 3)
    draw = random.Random(4)
    tiles = [(draw.randint(1, 3), sorted(draw.sample(range(12), draw.randint(2, 6)))) for _ in range(60)]
    expected = defaultdict(int)
    for n, tile in tiles:
        for pair in itertools.combinations(tile, 2):
            expected[pair] += n
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 2)
    try:
        held = spark.createDataFrame(tiles, "n long, tile array<int>")
        assert rows(g.count_owned(g._owned_in(held), 2)) == sorted(((*pair, n) for pair, n in expected.items()), key=repr)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_counts_of_triangles_are_shuffled_as_lists(spark):
    """All ways through a triple agree on sparse and dense graphs, with fresh edges too, and no vertex is shuffled by itself."""
    draw = np.random.default_rng(3)
    for n, share in ((150, 0.05), (300, 0.7)):
        upper = np.triu(draw.random((n, n)) < share, 1)
        new = upper & (draw.random((n, n)) < 0.4)

        def links(held):
            near = (held | held.T).astype(np.int64)
            return ((near @ near) * near).sum(axis=1)

        lo, hi = np.nonzero(upper)
        held = pd.DataFrame({"lo": lo.astype(np.int32) * 7, "hi": hi.astype(np.int32) * 7, "fresh": new[lo, hi]})
        ends = spark.createDataFrame(held).cache()
        whole, fresh = links(upper), links(upper) - links(upper & ~new)
        for words, blocks in ((0, False), (1 << 20, False), (0, True)):
            for given, expected in ((ends.drop("fresh"), whole), (ends, fresh)):
                found = ct.linked_by_colours(given, 2, words, blocks)
                assert "HashAggregate" not in found._jdf.queryExecution().executedPlan().toString()
                assert dict(rows(found)) == {7 * v: k for v, k in enumerate(expected.tolist()) if k}, (n, words, blocks)


def test_pairs_of_authors_with_many_subreddits_are_not_shuffled(spark, monkeypatch, stored_labels):
    """Subreddits meet in blocks where the lists would be many times the memberships, and only the memberships are stored."""
    monkeypatch.setattr(g, "MOST_LISTED_PAIRS", 0)
    monkeypatch.setattr(ab, "PAIRS_OF_TASK", 200)
    monkeypatch.setattr(ab, "PAIRS_AT_ONCE", 50)
    draw = random.Random(7)
    busy = [(f"s{n}", f"a{m}") for m in range(9) for n in draw.sample(range(60), draw.randint(20, 40))] + [("s1", "alone"), ("t", "b")]
    found = g.co_membership(members(spark, busy), tile=4, limit=0)
    assert rows(found) == sorted(((x, y, n) for (x, y), n in brute_force(busy)[0].items()), key=repr)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    assert {*stored_labels()} - {"hot-keys"} == {"author-blocks", "vertex-index"}
    assert scores(g.build_graph(members(spark, busy), tile=4)) == brute_force(busy)[2]


def test_loaded_edges_are_grouped_and_joined_only_where_needed(spark, monkeypatch):
    """Edges without repeats and unknown ends are stored as they are read; of the others only repeated ones are grouped."""
    graph = g.build_graph(members(spark, random_members(5, 40, 30, 2)))
    grouped, unique = [], r.unique_edges
    monkeypatch.setattr(r, "unique_edges", lambda edges: grouped.append(edges.count()) or unique(edges))
    monkeypatch.setattr(r, "lookup_join", lambda *args: pytest.fail("edges are joined to names"))
    again = r.load_graph(graph.vertices, graph.edges)
    assert edge(again) == edge(graph) and vertex(again).keys() == vertex(graph).keys() and not grouped
    assert {v: row["degree"] for v, row in vertex(again).items()} == {v: row["degree"] for v, row in vertex(graph).items()}
    swapped = graph.edges.orderBy("i", "j").limit(3).selectExpr("j as i", "i as j", *graph.edges.columns[2:])
    for limit in (1 << 26, 0):
        again = r.load_graph(graph.vertices, graph.edges.unionByName(swapped), limit=limit)
        assert edge(again) == edge(graph) and sum(row["degree"] for row in vertex(again).values()) == 2 * len(edge(graph))
    assert grouped == [6, 3 + len(edge(graph))]
    monkeypatch.undo()
    named = [row["i"] for row in graph.vertices.collect()][:20]
    nameless = graph.edges.limit(2).withColumn("i", F.lit(None).cast("string"))
    fewer = graph.vertices.where(F.col("i").isin(named))
    for limit in (1 << 26, 0):
        again = r.load_graph(fewer, graph.edges.unionByName(nameless), strict=False, limit=limit)
        assert set(edge(again)) == {(x, y) for x, y in edge(graph) if x in named and y in named}
        with pytest.raises(ValueError, match="unknown vertex"):
            r.load_graph(graph.vertices, graph.edges.unionByName(nameless), limit=limit)
