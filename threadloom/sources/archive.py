"""Compressed line archives as DataFrames of ``(value, file)``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.functions.columns import file_period, name_matches
from threadloom.operators.filters import split_lines
from threadloom.operators.parse import parse_entities
from threadloom.schemas import DIRECTORIES, PREFIXES
from threadloom.sources import packed_lines
from threadloom.sources.paths import qualified


def name_glob(prefix: str, suffix: str = "") -> str:
    """A file name pattern for a literal prefix."""
    literal = "".join(f"\\{c}" if c in "\\*?[]{}" else c for c in prefix)
    return f"{literal}*{suffix}"


def list_files(
    spark: SparkSession, directory: str, prefix: str = "", contains: str = "", excludes: str = ""
) -> DataFrame:
    """The archive files ``(file, bytes)`` that pass the name tests. Contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", name_glob(prefix)).load(directory)
    named = files.select(F.element_at(F.split("path", "/"), -1).alias("file"), F.col("length").alias("bytes"))
    return named.where(name_matches(F.col("file"), prefix, contains, excludes))


def read_packed_lines(spark: SparkSession, path: str, **options) -> DataFrame:
    """Lines ``(value, file, bytes, period)`` of the ``.zst`` and ``.xz`` archives of a directory, or of one file.

    Files are read by ranges, see ``packed_lines``. Options, all applied to the listing: ``endings`` ("zst,xz"), ``prefix``,
    ``contains``, ``excludes``, ``since`` and ``until`` (periods, both included), ``above`` and ``upto`` (bytes), ``zst_above``
    (bytes, for ``.zst`` alone); ``split`` has the packed bytes of a range.
    """
    packed_lines.register(spark)
    given = {name: value for name, value in options.items() if value is not None}
    return spark.read.format("packed_lines").options(**given).load(qualified(spark, path))


def read_xz_archive(
    spark: SparkSession,
    path: str,
    prefix: str = "",
    contains: str = "",
    excludes: str = "",
    **options,
) -> DataFrame:
    """Lines ``(value, file, bytes)`` of the ``.xz`` archives of a directory, or of one file."""
    names = {"prefix": prefix, "contains": contains, "excludes": excludes}
    return read_packed_lines(spark, path, endings="xz", **names, **options).drop("period")


def _packed(spark: SparkSession, path: str, prefix: str, split: int) -> bool:
    """Whether there are files that Spark's text reader can't read, or not by ranges. One listing, no job."""
    place = spark._jvm.org.apache.hadoop.fs.Path
    system = place(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    inside = place(f"{path.rstrip('/')}/{name_glob(prefix, '.{xz,zst}')}")
    found = [*(system.globStatus(inside) or []), *(system.globStatus(place(path)) or [])]
    sizes = [(status.getPath().getName(), status.getLen()) for status in found if status.isFile()]
    return any(name.endswith(".xz") or (name.endswith(".zst") and size > split) for name, size in sizes)


def read_archive(
    spark: SparkSession,
    directory: str,
    prefix: str = "",
    contains: str = "",
    excludes: str = "",
    spread: int | None = None,
    spread_above: int = 0,
    split: int = packed_lines.SPLIT_BYTES,
    since: str | None = None,
    until: str | None = None,
) -> DataFrame:
    """Lines of all archives of a directory whose names pass the tests, with their file name.

    ``.gz``, ``.bz2`` and plain files go through the text reader, and so do ``.zst`` files of up to ``split`` bytes. ``.xz``
    files and larger ``.zst`` files are read by ranges of ``split`` bytes (see ``packed_lines``), as many tasks as
    their frames and blocks allow. Files that fail a name test are never opened. ``since`` and ``until`` bound the period
    in the name, both included (``until="2018-03"`` keeps all of its days); files without one then fail.

    A file of one frame or block is read by one task; ``spread`` deals the lines of files larger than ``spread_above``
    bytes out to that many tasks before they are decoded. The lines of the other files stay where they are read.
    """
    text = (
        spark.read.option("pathGlobFilter", name_glob(prefix))
        .option("lineSep", "\n")
        .text(directory)
        .select("value", F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_size").alias("bytes"))
        .where(name_matches(F.col("file"), prefix, contains, excludes) & ~F.col("file").endswith(".xz"))
        .where(~F.col("file").endswith(".zst") | (F.col("bytes") <= split))
    )

    period = file_period()
    if since is not None:
        text = text.where(period >= since)
    if until is not None:
        text = text.where((period != "") & (F.substring(period, 1, len(until)) <= until))
    packed = _packed(spark, directory, prefix, split)
    names = {"prefix": prefix, "contains": contains, "excludes": excludes, "since": since, "until": until}

    def lines(above: int | None = None, upto: int | None = None) -> DataFrame:
        """Of the files within the bounds; each file is listed on one side only and read once."""
        found = text
        if above is not None:
            found = found.where(F.col("bytes") > above)
        if upto is not None:
            found = found.where(F.col("bytes") <= upto)
        if packed:
            ranges = read_packed_lines(spark, directory, split=split, zst_above=split, above=above, upto=upto, **names)
            found = found.unionByName(ranges.drop("period"))
        return found.drop("bytes")

    if not spread:
        return lines()
    if not spread_above:
        return lines().repartition(spread)
    return lines(upto=spread_above).unionByName(lines(above=spread_above).repartition(spread))


def archive_lines(spark: SparkSession, dataset_dir: str, kind: str, prefix: str | None = None, **options) -> DataFrame:
    """Usable lines of one archive kind of a dataset directory; the options are those of ``read_archive``."""
    prefix = PREFIXES[kind] if prefix is None else prefix
    directory = f"{dataset_dir.rstrip('/')}/{DIRECTORIES[kind]}"
    return split_lines(read_archive(spark, directory, prefix, **options))


def read_submissions(spark: SparkSession, dataset_dir: str, **names) -> DataFrame:
    return parse_entities(archive_lines(spark, dataset_dir, "submissions", **names), "submissions")


def read_comments(spark: SparkSession, dataset_dir: str, **names) -> DataFrame:
    return parse_entities(archive_lines(spark, dataset_dir, "comments", **names), "comments")


def read_authors(spark: SparkSession, dataset_dir: str, **names) -> DataFrame:
    return parse_entities(archive_lines(spark, dataset_dir, "authors", **names), "authors")


def read_contributions(spark: SparkSession, dataset_dir: str, **names) -> DataFrame:
    """Comments and submissions together as ``(subreddit, author, file)``."""
    comments = archive_lines(spark, dataset_dir, "comments", **names)
    submissions = archive_lines(spark, dataset_dir, "submissions", **names)
    return parse_entities(comments.unionByName(submissions), "user_in_subreddit")
