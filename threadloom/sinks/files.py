"""Writers for entities, lines, counts and graph tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.functions.columns import CSV_DIALECT, csv_line, dot_id
from threadloom.operators.graph import Graph
from threadloom.schemas import EDGE_CSV, VERTEX_CSV
from threadloom.sinks import zstd_lines
from threadloom.sources.paths import qualified


def to_csv_rows(df: DataFrame) -> DataFrame:
    """Every row as one CSV text, columns in order."""
    return df.select(csv_line(df.columns).alias("value"))


def write_csv(df: DataFrame, path: str, header: bool = False, mode: str = "errorifexists") -> None:
    df.write.mode(mode).options(**CSV_DIALECT).option("header", header).csv(path)


def write_csv_file(df: DataFrame, path: str, header: bool = False) -> None:
    """One file of that name, for readers that can't take a folder. One task writes it, row by row.

    The file is written beside ``path`` and moved there when it is whole. ``path`` must not exist.
    """
    spark = df.sparkSession
    place = spark._jvm.org.apache.hadoop.fs.Path
    system = place(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if system.exists(place(path)):
        raise ValueError(f"{path} exists already")
    folder = f"{path}-{uuid.uuid4().hex}"
    write_csv(df.repartition(1), folder, header)
    written = [status.getPath() for status in system.globStatus(place(f"{folder}/part-*"))]
    moved = system.rename(written[0], place(path)) if written else system.createNewFile(place(path))
    system.delete(place(folder), True)
    if not moved:
        raise OSError(f"{path} can't be put in place")


def write_zstd_lines(
    lines: DataFrame, path: str, mode: str = "append", frame_bytes: int = zstd_lines.FRAME_BYTES
) -> None:
    """Lines as Zstandard files of many frames; a ``file`` column names the files, one task writes each.

    The lines of a file are packed where they are; the task that writes the file gets its frames only.
    """
    spark = lines.sparkSession
    zstd_lines.register(spark)
    if "file" in lines.columns:
        by_file = lines.select("value", "file").sortWithinPartitions("file")
        packed = by_file.mapInArrow(zstd_lines.frames(frame_bytes), "frame binary, file string")
        lines = packed.repartition("file").sortWithinPartitions("file")
    lines.write.format("zstd_lines").mode(mode).option("frame_bytes", frame_bytes).save(qualified(spark, path))


def write_compressed(df: DataFrame, path: str, mode: str = "append") -> None:
    """Headerless CSV, Zstandard-compressed."""
    write_zstd_lines(to_csv_rows(df), path, mode)


def write_raw_json(lines: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The original lines, newline-terminated."""
    lines.select("value").write.mode(mode).text(path)


def statistics_path(out_dir: str, experiment: str, suffix: str = "") -> str:
    ending = f"_{suffix}" if suffix.strip() else ""
    return f"{out_dir.rstrip('/')}/{experiment}{ending}.csv"


def write_statistics(
    counts: DataFrame, out_dir: str, experiment: str, suffix: str = "", single_file: bool = False
) -> str:
    """Counts as headerless CSV under the experiment's name, a folder of files or ``single_file``."""
    path = statistics_path(out_dir, experiment, suffix)
    (write_csv_file if single_file else write_csv)(counts.select("subreddit", "count"), path)
    return path


def write_statistics_per_period(counts: DataFrame, out_dir: str, experiment: str) -> str:
    """Counts of all periods in one run, one folder per level and period."""
    path = f"{out_dir.rstrip('/')}/{experiment}"
    ordered = counts.select("subreddit", "count", "level", "period").repartition("level", "period")
    ordered.write.partitionBy("level", "period").options(**CSV_DIALECT).csv(path)
    return path


def edge_list(edges: DataFrame) -> DataFrame:
    """The edge table under its export names."""
    return edges.selectExpr(*[f"{name} as `{out}`" for name, out in EDGE_CSV.items()])


def vertex_list(vertices: DataFrame) -> DataFrame:
    """The vertex table under its export names; the mean of an isolated vertex is NaN."""
    filled = vertices.withColumn("weighted_degree", F.coalesce("weighted_degree", F.lit(float("nan"))))
    return filled.selectExpr(*[f"{name} as `{out}`" for name, out in VERTEX_CSV.items()])


def write_edge_list(edges: DataFrame, path: str, single_file: bool = False) -> None:
    (write_csv_file if single_file else write_csv)(edge_list(edges), path, header=True)


def write_vertex_list(vertices: DataFrame, path: str, single_file: bool = False) -> None:
    (write_csv_file if single_file else write_csv)(vertex_list(vertices), path, header=True)


def export_filter_list(top: DataFrame, path: str) -> None:
    """The chosen names as they stand below a header, as one file. ``top`` is a top-n result, so n rows."""
    with_header(top.select("subreddit")).coalesce(1).sortWithinPartitions("_row").select("value").write.text(path)


def with_header(names: DataFrame, *keys: str) -> DataFrame:
    """``keys``, ``_row``, ``value``: a header in front of the names of each combination of keys."""
    rows = names.select(*keys, F.lit(1).alias("_row"), F.coalesce("subreddit", F.lit("")).alias("value"))
    heads = names.select(*keys).distinct() if keys else names.sparkSession.range(1)
    return heads.select(*keys, F.lit(0).alias("_row"), F.lit("subreddit").alias("value")).unionByName(rows)


def export_filter_lists(top: DataFrame, keys: list[str], path: str) -> None:
    """A filter list for every combination of ``keys``, each in a folder ``key=value/...``, in one job."""
    listed = with_header(top, *keys).repartition(*keys).sortWithinPartitions(*keys, "_row")
    listed.select(*keys, "value").write.partitionBy(*keys).text(path)


def graph_to_dot_lines(graph: Graph) -> DataFrame:
    """The graph as DOT statements ``(section, line)``: opening, vertices, edges, closing."""

    def attributes(pairs: dict[str, str]) -> str:
        return " || ' ' || ".join(f"'{name}=\"' || cast({column} as string) || '\"'" for name, column in pairs.items())

    # The exported attribute names.
    vertex = attributes(
        {
            "degree": "degree",
            "weightedDegree": "ui",
            "degreeDegree": "degree_degree",
            "weightedDegreeDegree": "weighted_degree_degree",
            "localClusteringCoefficient": "local_clustering_coefficient",
        }
    )
    weight = attributes({"weight": "w_ij"})
    vertices = graph.vertices.withColumn("_i", dot_id("i"))
    edges = graph.edges.withColumn("_i", dot_id("i")).withColumn("_j", dot_id("j"))
    vertex_lines = vertices.selectExpr("1 as section", f"'  ' || _i || ' [ ' || {vertex} || ' ];' as line")
    edge_lines = edges.selectExpr("2 as section", f"'  ' || _i || ' -- ' || _j || ' [ ' || {weight} || ' ];' as line")
    frame = graph.vertices.sparkSession.createDataFrame(
        [(0, "strict graph G {"), (3, "}")], "section int, line string"
    )
    return vertex_lines.unionByName(edge_lines).unionByName(frame)


def write_dot(graph: Graph, path: str) -> None:
    """DOT text; the part files in name order are one document."""
    lines = graph_to_dot_lines(graph).withColumn("_place", F.xxhash64("line"))
    # Sections in order over the files; the lines of a section are spread, their order means nothing.
    ranged = lines.repartitionByRange("section", "_place").sortWithinPartitions("section")
    ranged.select("line").write.text(path)


def dot_id_collisions(vertices: DataFrame) -> DataFrame:
    """DOT ids that stand for more than one vertex."""
    ids = vertices.select(dot_id("i").alias("dot_id"), "i").groupBy("dot_id")
    return ids.agg(F.count("*").alias("vertices"), F.min("i").alias("first_i")).where("vertices > 1")
