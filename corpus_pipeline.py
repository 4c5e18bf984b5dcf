"""A corpus pipeline: each stage works on all that the one before has kept.

``STAGES`` are functions of (spark, docs, sf_dir). All but the last return the columns of the
documents; each is written as Parquet and read again as the next one's documents.

A stage carries the caller's columns in one struct (``CARRIED``) beside the few that its operator reads, so their names and values
can't clash with an operator's own. Null and empty texts leave with the first stage. Very long texts are worked on whole.
Repeated rows count as copies of each other. Ties go to the smallest id, then to the smallest key of the row. An empty table
gives an empty result of every stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.llm import host_rules, language_id, mixing, near_dedup, packing
from threadloom.operators.lookup import fits_broadcast, lookup_join
from threadloom.plans.materialize import discard, scratch_path, store

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
CARRIED = "_document"


def carry(docs: DataFrame, *read: str, **made: Column) -> DataFrame:
    """The columns that an operator reads, ``made`` ones, and all of ``docs`` as one struct."""
    whole = F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias(CARRIED)
    return docs.select(*(F.col(f"`{name}`") for name in read), *(value.alias(name) for name, value in made.items()), whole)


def carried(df: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` again."""
    return df.select(*(F.col(f"{CARRIED}.`{name}`").alias(name) for name in docs.columns))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a letter go, and texts that aren't in a learned language.

    That is: without half of the posterior of the learned languages, or less likely in all of them than by a background of equally
    likely pieces. The languages are learnt from the labels in ``docs``; without a label, only letters are asked for.
    """
    model = language_id.fit(docs.select("doc_id", "text", "lang"))
    if not model.languages:
        return docs.where(F.regexp_like("text", F.lit(r"\p{L}")))
    found = carry(docs, found=language_id.identify(model)(F.col("text")))
    return carried(found.where(language_id.accepted(F.col("found"))), docs)


def rule_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a rule, or whose host is refused, go."""
    return carried(host_rules.apply_host_rules(carry(docs, "text", "source")).where("kept"), docs)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near copies one row with the smallest id stays, one without an id if none has any.

    Rows are told apart by all of their columns and not by their ids, which may be null or belong to unlike texts.
    """
    keyed = carry(docs, "doc_id", "text", row_key=near_dedup.row_key(docs))
    groups = near_dedup.grouped_rows(keyed.select("doc_id", "text", "row_key"))
    # Rows that are linked with no other stay, so only groups are looked at.
    linked = store(groups.where("root is not null").select("root", "doc_id", "row_key"), "near-copies").table
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_key"))["row_key"].alias("first")
    counted = linked.groupBy("root", "row_key").count().join(linked.groupBy("root").agg(first), "root")
    counted = store(counted.select("row_key", "count", (F.col("row_key") == F.col("first")).alias("kept")), "linked-rows").table
    gone = counted.where("not kept").select("row_key")
    rows = keyed.select("row_key", CARRIED)
    left = lookup_join(rows, gone, ["row_key"], fits_broadcast(gone), "left_anti")
    # Of equal rows, one; rows that occur once needn't be compared.
    several = counted.where("kept and count > 1").select("row_key")
    small = fits_broadcast(several)
    single = lookup_join(left, several, ["row_key"], small, "left_anti")
    once = lookup_join(left, several, ["row_key"], small, "left_semi").dropDuplicates(["row_key"])
    return carried(single.unionByName(once), docs)


def _row_key(text: Column) -> Column:
    """The same for rows of equal id and text only."""
    return F.concat_ws("/", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.hex(F.xxhash64(text)))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for every whole copy that the mix takes, and one of the further words it takes of a document."""
    keyed = carry(docs, "text", "source", row_key=_row_key(F.col("text")))
    mixed = mixing.mix(keyed, doc_id="row_key").where("taken > 0")
    taken = mixed.groupBy(F.col("doc_id").alias("row_key")).agg(
        F.sum("passes").cast("int").alias("passes"), F.flatten(F.collect_list("spans")).alias("spans")
    )
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*"), F.lit(0))

    def chosen(held: Column) -> Column:
        parts = F.transform("spans", lambda s: F.slice(held, (s["start"] + 1).cast("int"), s["length"].cast("int")))
        return F.array_join(F.flatten(parts), "")

    # Only a text that words are taken from is cut into words.
    part = F.when(F.size("spans") > 0, F.transform(F.array(words), chosen)).otherwise(F.array())
    texts = F.concat(F.array_repeat("text", F.col("passes")), part)
    made = keyed.select("row_key", "text", CARRIED).dropDuplicates(["row_key"]).join(taken, "row_key")
    made = made.select(F.explode(texts).alias("text"), CARRIED)

    def column(name: str) -> Column:
        if name == "text":
            return F.col("text")
        if name == "n_chars":
            return F.char_length("text").cast(docs.schema["n_chars"].dataType).alias(name)
        return F.col(f"{CARRIED}.`{name}`").alias(name)

    return made.select(*(column(name) for name in docs.columns))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token sequences."""
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_stage),
    ("host_rules", rule_stage),
    ("near_dedup", dedup_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]
#: No SQL can express the first stage; the pipeline is tested stage by stage instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over ``documents``; what a stage wrote is deleted when the next one has."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            discard(spark, before)
        before = path
    return docs
