"""The co-participation graph, its scores and exports."""

from __future__ import annotations

from checks import inputs as i
from checks.count_queries import histogram_sql
from checks.registry import query
from pyspark.sql import functions as F
from threadloom.operators import filters as f
from threadloom.operators import graph as g
from threadloom.operators import growing_graph as gg
from threadloom.operators import reload as r
from threadloom.operators.histogram import histograms
from threadloom.plans import participation_graph as pg
from threadloom.plans.materialize import scratch_path
from threadloom.sinks import files

G = i.GRAPH
SCORES = """degree_i, degree_j, weighted_degree_i, weighted_degree_j, avg_weighted_edge_weight_i,
avg_weighted_edge_weight_j, w_ij"""


@query(f"WITH {G} SELECT i, j, u AS u_ij FROM e")
def co_membership(spark, sf):
    return g.co_membership(i.memberships(spark, sf))


@query(f"WITH {G} SELECT i, j, u AS u_ij FROM e")
def co_membership_of_repeated_rows(spark, sf):
    """Rows as they come, with repeated pairs and some without an author or a subreddit."""
    rows = i.table(spark, sf, "lineitem").selectExpr("l_partkey as subreddit", "l_orderkey as author")
    gaps = rows.selectExpr("subreddit", "cast(null as bigint) as author").unionAll(
        rows.selectExpr("cast(null as bigint) as subreddit", "author")
    )
    return g.co_membership(rows.unionAll(rows).unionAll(gaps))


SUPPLIERS = """m AS (SELECT DISTINCT l_suppkey AS s, o_custkey AS a FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT x.s AS i, y.s AS j, count(*) AS u_ij FROM m x JOIN m y ON x.a = y.a AND x.s < y.s GROUP BY x.s, y.s"""


@query(f"WITH {SUPPLIERS}")
def co_membership_of_busy_authors(spark, sf):
    """Authors far beyond one tile, and lookups too large to broadcast."""
    return g.co_membership(i.supplier_memberships(spark, sf), tile=8, limit=0)


@query(f"WITH {G} SELECT i, j, u_ij, {SCORES} FROM es")
def edge_scores(spark, sf):
    return i.scored_graph(spark, sf).edges


def _rounded(vertices):
    return vertices.withColumn("weighted_degree_degree", F.round("weighted_degree_degree", 6))


@query(f"WITH {G} SELECT * FROM vx")
def vertex_scores(spark, sf):
    return _rounded(i.scored_graph(spark, sf).vertices)


@query(f"WITH {G} SELECT * FROM vx")
def vertex_scores_with_large_lookups(spark, sf):
    """The same scores when no table may be broadcast."""
    return _rounded(g.build_graph(i.memberships(spark, sf), limit=0).vertices)


WITH_CUSTOMERS = G.replace(
    "m AS (SELECT DISTINCT l_partkey AS s, l_orderkey AS a FROM lineitem)",
    """m AS (SELECT DISTINCT l_partkey AS s, l_orderkey AS a FROM lineitem
       UNION ALL SELECT -o_custkey - 1, -o_orderkey - 1 FROM orders)""",
)


@query(f"WITH {WITH_CUSTOMERS} SELECT * FROM vx")
def vertex_scores_with_isolated_vertices(spark, sf):
    """The parts graph next to customers, none of which share an order."""
    customers = i.table(spark, sf, "orders").selectExpr("-o_custkey - 1 as subreddit", "-o_orderkey - 1 as author")
    return _rounded(g.build_graph(i.memberships(spark, sf).unionByName(customers)).vertices)


def _grown(spark, sf):
    """The graph of two thirds of the orders, extended by the last third and by rows that it knows already."""

    def make():
        rows = i.memberships(spark, sf)
        state = gg.start_graph(rows.where("author % 3 <> 0 or subreddit % 2 = 0"))
        return gg.scores(gg.extend_graph(state, rows.where("author % 3 = 0 or subreddit % 5 = 1")))

    return i.keep(spark, sf, "grown", make)


@query(f"WITH {G} SELECT i, j, u_ij, {SCORES} FROM es")
def extend_graph_edges(spark, sf):
    return _grown(spark, sf).edges


@query(f"WITH {G} SELECT * FROM vx")
def extend_graph_vertices(spark, sf):
    return _rounded(_grown(spark, sf).vertices)


@query(f"WITH {G} SELECT v, dd, round(wdd, 6) AS wdd FROM dd")
def neighbour_sums(spark, sf):
    graph = i.scored_graph(spark, sf)
    base = graph.vertices.selectExpr("i as v", "degree as k")
    sums = g.neighbour_sums(graph.edges.selectExpr("i as a", "j as b", "w_ij"), base, small=False)
    return sums.selectExpr("v", "dd", "round(wdd, 6) as wdd")


@query(f"WITH {G} SELECT count(*) + (SELECT count(*) FROM es) + 2 AS lines FROM vx")
def write_dot(spark, sf):
    """The DOT document written and read again."""
    document = spark.read.text(_exported(spark, sf, "dot_path")["dot_path"])
    return document.agg(F.count("*").alias("lines"))


def _clustering(spark, sf, method):
    edges = i.scored_graph(spark, sf).edges
    low = F.struct("degree_i", "i") < F.struct("degree_j", "j")
    ends = edges.select(
        F.col("i").cast("int").alias("a"),
        F.col("j").cast("int").alias("b"),
        F.when(low, F.col("i")).otherwise(F.col("j")).cast("int").alias("lo"),
        F.when(low, F.col("j")).otherwise(F.col("i")).cast("int").alias("hi"),
    )
    links = g.linked_neighbours(ends, method=method).withColumnRenamed("v", "i")
    k = F.col("degree")
    ratio = F.coalesce("links", F.lit(0)).cast("double") / (k.cast("double") * (k - 1))
    joined = i.scored_graph(spark, sf).vertices.select("i", "degree").join(links, "i", "left")
    return joined.select("i", F.when(k > 1, ratio).otherwise(0.0).alias("local_clustering_coefficient"))


@query(f"WITH {G} SELECT i, local_clustering_coefficient FROM vx")
def clustering_by_bit_blocks(spark, sf):
    """Clustering by the method for dense graphs."""
    return _clustering(spark, sf, "blocks")


@query(f"WITH {G} SELECT i, local_clustering_coefficient FROM vx")
def clustering_by_colours(spark, sf):
    """Clustering by triples of colours, for dense graphs with hubs."""
    return _clustering(spark, sf, "colours")


@query(f"WITH {G} SELECT 'vertices' AS part, count(*) AS count FROM vx UNION ALL SELECT 'edges', count(*) FROM es")
def graph_summary(spark, sf):
    return g.graph_summary(i.scored_graph(spark, sf))


@query(f"WITH {G} SELECT i, j, u_ij, {SCORES} FROM es WHERE w_ij >= 1.5 ORDER BY w_ij DESC, i, j")
def filter_edges(spark, sf):
    return f.filter_edges(i.scored_graph(spark, sf).edges, 1.5)


EDGE_COLUMNS = [
    "u_ij",
    "degree_i",
    "degree_j",
    "weighted_degree_i",
    "weighted_degree_j",
    "avg_weighted_edge_weight_i",
    "avg_weighted_edge_weight_j",
    "w_ij",
]
# Sums of doubles differ in their last digits between engines, so a column of them is compared in whole numbers.
WHOLE = G + ", vw AS (SELECT * REPLACE (round(weighted_degree_degree) AS weighted_degree_degree) FROM vx)"
VERTEX_COLUMNS = [
    "ui",
    "degree",
    "weighted_degree",
    "degree_degree",
    "weighted_degree_degree",
    "local_clustering_coefficient",
]


@query(histogram_sql("es", EDGE_COLUMNS, 100, G))
def histogram_of_edges(spark, sf):
    return histograms(i.scored_graph(spark, sf).edges, EDGE_COLUMNS)


@query(histogram_sql("vw", VERTEX_COLUMNS, 100, WHOLE))
def histogram_of_vertices(spark, sf):
    vertices = i.scored_graph(spark, sf).vertices
    return histograms(vertices.withColumn("weighted_degree_degree", F.round("weighted_degree_degree")), VERTEX_COLUMNS)


def _exported(spark, sf, *names):
    """Paths of the named exports, each written once."""

    def make(name):
        path = scratch_path(spark, name)
        pg.export_graph(i.scored_graph(spark, sf), **{name: path})
        return path

    return {name: i.keep(spark, sf, f"export {name}", lambda: make(name)) for name in names}


@query(f"WITH {G} SELECT CAST(i AS VARCHAR) AS i, CAST(j AS VARCHAR) AS j, u_ij, {SCORES} FROM es")
def edge_list_round_trip(spark, sf):
    return pg.read_edge_list(spark, _exported(spark, sf, "edge_path")["edge_path"])


@query(f"WITH {G} SELECT * REPLACE (CAST(i AS VARCHAR) AS i) FROM vx")
def vertex_list_round_trip(spark, sf):
    return _rounded(pg.read_vertex_list(spark, _exported(spark, sf, "vertex_path")["vertex_path"]))


@query(f"WITH {G} SELECT * REPLACE (CAST(i AS VARCHAR) AS i) FROM vx")
def load_graph_vertices(spark, sf):
    paths = _exported(spark, sf, "vertex_path", "edge_path")
    return _rounded(pg.graph_from_lists(spark, paths["vertex_path"], paths["edge_path"]).vertices)


@query(f"WITH {G} SELECT CAST(i AS VARCHAR) AS i, CAST(j AS VARCHAR) AS j, u_ij, {SCORES} FROM es")
def load_graph_edges(spark, sf):
    paths = _exported(spark, sf, "vertex_path", "edge_path")
    return pg.graph_from_lists(spark, paths["vertex_path"], paths["edge_path"]).edges


@query(
    f"""WITH {G}, ends AS (SELECT i, j, unnest([i, j]) AS missing FROM e)
    SELECT i, j, missing FROM ends WHERE missing NOT IN (SELECT p_partkey FROM part WHERE p_size < 25)"""
)
def unknown_endpoints(spark, sf):
    """Edges against a vertex list that only names the smaller parts."""
    known = i.table(spark, sf, "part").where("p_size < 25").selectExpr("p_partkey as i")
    return r.unknown_endpoints(i.scored_graph(spark, sf).edges, known)


@query(
    f"""WITH {G} SELECT 0 AS section, 'strict graph G {{' AS line UNION ALL SELECT 3, '}}'
    UNION ALL SELECT 1, '  "' || i || '" [ degree="' || degree || '" weightedDegree="' || ui || '" degreeDegree="'
      || degree_degree || '" ];' FROM vx
    UNION ALL SELECT 2, '  "' || i || '" -- "' || j || '" ];' FROM es"""
)
def graph_to_dot_lines(spark, sf):
    """DOT statements; the decimals are cut out here, their text form differs between engines."""
    lines = files.graph_to_dot_lines(i.scored_graph(spark, sf))
    cut = F.regexp_replace("line", r' (\[ weight|weightedDegreeDegree|localClusteringCoefficient)="[^"]*"', "")
    return lines.select("section", cut.alias("line"))


@query(
    """WITH u AS (SELECT DISTINCT l_partkey || '.x' AS n FROM lineitem
                  UNION ALL SELECT DISTINCT o_custkey || '_x' FROM orders)
    SELECT '"' || replace(n, '.', '_') || '"' AS dot_id, count(*) AS vertices, min(n) AS first_i
    FROM u GROUP BY 1 HAVING count(*) > 1"""
)
def dot_id_collisions(spark, sf):
    """Part and customer names that differ by a dot only."""
    parts = i.table(spark, sf, "lineitem").selectExpr("concat(l_partkey, '.x') as i").distinct()
    customers = i.table(spark, sf, "orders").selectExpr("concat(o_custkey, '_x') as i").distinct()
    return files.dot_id_collisions(parts.unionAll(customers))


@query(f"WITH {G} SELECT d.v, k, ui, CAST(ui AS DOUBLE) / k AS avg FROM d")
def vertex_degrees(spark, sf):
    graph = i.scored_graph(spark, sf)
    return g.vertex_degrees(graph.edges.selectExpr("i as a", "j as b", "u_ij as u"))
