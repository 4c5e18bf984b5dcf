"""Mix sources to target weights by Sainte-Lague apportionment of equal blocks of words.

1. Sizes: words per document, summed per source. The sources in code point order (null last) get
   the given weights in turn. Together they share ``share`` times all words by weight;
   a target stops at ``most`` times its source's size and the excess is shared again by weight.
2. Quotas: the mix has round(sum of targets / block) blocks. They go to the sources by the highest
   quotients target / (2k + 1), and each source's blocks to its shards by the highest quotients of
   their words. A shard is a seeded part of a source's documents of about ``shard_words`` words, so a
   source with a third of all rows has more shards and not larger ones.
3. Blocks: a shard's documents, in seeded order, form one run of words that is cut into blocks. As
   many whole passes over the run as fit the quota are taken, and the rest as whole blocks in a second seeded
   order. Every document then knows which of its words the mix takes, and how often.

Highest quotients without handing out seat by seat: the divisor total / seats is so near the last
one that only a few quotients around each party's share (a multiple of the number of parties in all) can decide;
the seats below them are certain and only the open quotients are ranked.

Everything is DataFrame expressions. Seeded orders come from ``xxhash64`` of seed and id, so
reruns agree. Null and empty texts have no words and nothing is taken from them. Repeated rows are
documents of their own. Very long texts are counted whole and lie in more blocks. Ties go to the first source in order, to the lower shard and the lower block.
An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.llm.words import WORD
from threadloom.operators.lookup import fits_broadcast, lookup_join
from threadloom.plans.materialize import store

WEIGHTS = (3, 1, 2)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ranked(df: DataFrame, name: str, *order: Column) -> DataFrame:
    """Add the 0-based position of each row in ``order``, which must tell rows apart.

    Ranges of rows are numbered side by side and shifted by the rows of the ranges before.
    """
    ranged = df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    ranged = store(ranged, "ranked").table
    # One row for each range, that is for each partition of the exchange above.
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.withColumn("_before", F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")).drop("_n")
    inside = Window.partitionBy("_range").orderBy(*order)
    numbered = ranged.withColumn("_inside", F.row_number().over(inside) - 1).join(F.broadcast(before), "_range")
    return numbered.withColumn(name, F.col("_before") + F.col("_inside")).drop("_range", "_inside", "_before")


def in_order(df: DataFrame, column: str, name: str) -> DataFrame:
    """Add the 0-based position of each distinct value in code point order, null last."""
    return ranked(df, name, F.col(column).isNull(), F.col(column))


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``source``, ``source_size`` to ``target`` and ``place``: shares by weight, none above ``most`` times its size.

    Each round fixes the sources that their share would lift above the bound; the rest share what
    is left. Only the two sums of a round come to the driver.
    """
    ordered = in_order(sources, "source", "place")
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("place") % len(weights) + 1).cast("int"))
    ordered = store(ordered.withColumn("weight", weight), "sources").table
    bound = most * F.col("source_size")
    left = share * (ordered.agg(F.sum("source_size")).first()[0] or 0)
    level = None  # target of an unbounded source for each unit of weight
    while True:
        free = F.lit(True) if level is None else bound > F.col("weight") * level
        row = ordered.agg(
            F.sum(F.when(free, F.col("weight"))).alias("weight"), F.sum(F.when(~free, bound)).alias("fixed")
        ).first()
        if not row["weight"]:
            break
        found = (left - (row["fixed"] or 0.0)) / row["weight"]
        if level is not None and found <= level:
            break
        level = found
    target = F.least(bound, F.col("weight") * F.lit(level or 0.0)).cast("double")
    return ordered.select("source", "source_size", "place", target.alias("target"))


def _quotients(parties: DataFrame, votes: str, seats: str) -> tuple[DataFrame, Column]:
    """For ``parties`` with ``_votes`` and ``_parties`` of their group: the certain seats ``_sure``, and the open quotients."""
    ideal = F.col(seats) * F.col(votes) / F.col("_votes")
    margin = F.ceil(ideal * F.col("_parties") / F.greatest(F.col(seats), F.lit(1))) + 2
    open_ = (
        parties.withColumn("_ideal", F.when(F.col("_votes") > 0, ideal).otherwise(F.lit(0.0)))
        .withColumn("_margin", F.when(F.col("_votes") > 0, margin).otherwise(F.lit(0)).cast("long"))
        .withColumn("_sure", F.greatest(F.floor("_ideal") - F.col("_margin"), F.lit(0)))
    )
    return open_, F.sequence(F.lit(0).cast("long"), F.col("_sure") * 0 + 2 * F.col("_margin") + 1)


def _quotient(votes: str) -> Column:
    return F.col(votes) / (2 * (F.col("_sure") + F.col("_k")) + 1)


def apportion(parties: DataFrame, group: str, votes: str, tie: str, seats: str) -> DataFrame:
    """Add ``quota``: each group's seats dealt to its parties by the highest quotients votes / (2k + 1)."""
    whole = Window.partitionBy(group)
    counted = parties.withColumn("_votes", F.sum(votes).over(whole)).withColumn("_parties", F.count(F.lit(1)).over(whole))
    open_, asked = _quotients(counted, votes, seats)
    open_ = open_.withColumn("_rest", F.col(seats) - F.sum("_sure").over(whole))
    quotients = open_.withColumn("_k", F.explode(asked)).withColumn("_quotient", _quotient(votes))
    first = Window.partitionBy(group).orderBy(F.col("_quotient").desc(), F.col(tie), F.col("_k"))
    won = (F.row_number().over(first) <= F.col("_rest")) & (F.col(votes) > 0)
    won_each = quotients.withColumn("_won", won.cast("long"))
    return won_each.groupBy(*parties.columns).agg((F.first("_sure") + F.sum("_won")).alias("quota"))


def apportion_all(parties: DataFrame, votes: str, tie: str, seats: int) -> DataFrame:
    """Add ``quota`` as ``apportion`` does, for one group of any number of parties.

    Their quotients are ranked by ranges, so no task sees more than a range of them. ``tie`` tells the parties apart.
    """
    total = parties.agg(F.coalesce(F.sum(votes), F.lit(0)).alias("votes"), F.count(F.lit(1)).alias("n")).first()
    held = parties.withColumn("_votes", F.lit(total["votes"])).withColumn("_parties", F.lit(total["n"])).withColumn("_seats", F.lit(seats))
    open_, asked = _quotients(held, votes, "_seats")
    open_ = store(open_, "parties").table
    rest = seats - (open_.agg(F.sum("_sure")).first()[0] or 0)
    quotients = open_.where(F.col(votes) > 0).withColumn("_k", F.explode(asked)).withColumn("_quotient", _quotient(votes))
    placed = ranked(quotients.select(tie, "_k", "_quotient"), "_rank", -F.col("_quotient"), F.col(tie), F.col("_k"))
    won = placed.where(F.col("_rank") < rest).groupBy(tie).agg(F.count(F.lit(1)).alias("_won"))
    quota = (F.col("_sure") + F.coalesce("_won", F.lit(0))).alias("quota")
    return open_.join(won, tie, "left").select(*parties.columns, quota)


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = WEIGHTS,
    share: float = 1.5,
    most: int = 2,
    block: int = 64,
    shard_words: int = 1 << 19,
    seed: int = 17,
) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target, taken, passes, spans.

    ``passes`` whole copies are taken, and the words of ``spans`` (0-based start, length) once more.
    """
    sized = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{source}`").alias("source"), word_count(F.col(f"`{text}`")).alias("size")
    )
    sized = store(sized.withColumn("_order", F.xxhash64(F.lit(seed), "doc_id", "size")), "sizes").table
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    aims = store(targets(sources, weights, share, most), "targets").table
    blocks = aims.agg(F.round(F.coalesce(F.sum("target"), F.lit(0.0)) / block)).first()[0]
    shards = F.greatest(F.ceil(F.col("source_size") / shard_words), F.lit(1))
    aims = apportion_all(aims, "target", "place", int(blocks)).select(
        "source", "source_size", "place", "target", F.col("quota").alias("source_quota"), shards.alias("_shards")
    )
    aims = store(aims, "quotas").table.withColumn("_key", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))
    keyed = sized.withColumn("_key", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))
    placed = lookup_join(keyed, aims.drop("source"), ["_key"], fits_broadcast(aims)).drop("_key")
    placed = placed.withColumn("_shard", F.pmod(F.xxhash64(F.lit(seed + 1), "_order"), F.col("_shards")))

    # Rows without words are in no run: however many a source has, no task has to order them.
    wordless = placed.where("size = 0")
    placed = placed.where("size > 0")
    run = Window.partitionBy("place", "_shard").orderBy("_order", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    placed = placed.withColumn("_end", F.sum("size").over(run)).withColumn("_start", F.col("_end") - F.col("size"))
    runs = placed.groupBy("place", "_shard").agg(F.sum("size").alias("_words"), F.first("source_quota").alias("_seats"))
    runs = store(apportion(runs, "place", "_words", "_shard", "_seats"), "shards").table
    wanted = F.least(F.col("quota") * block, F.col("_words") * most)
    runs = runs.where("_words > 0").select(
        "place",
        "_shard",
        F.floor(wanted / F.col("_words")).cast("long").alias("passes"),
        F.round((wanted % F.col("_words")) / block).cast("long").alias("_more"),
        F.ceil(F.col("_words") / block).cast("long").alias("_blocks"),
    )
    # The blocks of a run in their second seeded order; the first `_more` of them are taken once more.
    numbered = runs.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)))
    draw = Window.partitionBy("place", "_shard").orderBy(F.xxhash64(F.lit(seed + 2), "place", "_shard", "_block"), "_block")
    drawn = numbered.withColumn("_rank", F.row_number().over(draw)).where(F.col("_rank") <= F.col("_more"))
    drawn = drawn.select("place", "_shard", "_block")

    # A document meets the blocks that it lies in: its own words / block of them, and at most two more.
    inside = placed.select("place", "_shard", "_order", "doc_id", "_start", "_end", "size")
    inside = inside.withColumn(
        "_block", F.explode(F.sequence(F.floor(F.col("_start") / block), F.floor((F.col("_end") - 1) / block)))
    )
    # The blocks grow with the corpus, and their number can't be told from the shards': never broadcast.
    hits = inside.join(drawn.hint("merge"), ["place", "_shard", "_block"])
    begin = F.greatest(F.col("_block") * block, F.col("_start"))
    end = F.least((F.col("_block") + 1) * block, F.col("_end"))
    spans = hits.groupBy("place", "_shard", "_start", "_end").agg(
        F.sum(end - begin).alias("_once"),
        F.sort_array(F.collect_list(F.struct((begin - F.col("_start")).alias("start"), (end - begin).alias("length")))).alias("spans"),
    )
    # Runs of words are unlike where a document has words, so place, shard, start and end name one document.
    keys = ["place", "_shard", "_start", "_end"]
    out = placed.join(spans, keys, "left").join(runs.select("place", "_shard", "passes"), ["place", "_shard"], "left")
    out = out.select("doc_id", "source", "size", "source_size", "target", "passes", "_once", "spans")
    nothing = (F.lit(None).cast("long").alias(name) for name in ("passes", "_once"))
    none = F.array().cast("array<struct<start:bigint,length:bigint>>")
    wordless = wordless.select("doc_id", "source", "size", "source_size", "target", *nothing, none.alias("spans"))
    out = out.unionByName(wordless)
    passes = F.coalesce("passes", F.lit(0)).cast("long")
    return out.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        (passes * F.col("size") + F.coalesce("_once", F.lit(0))).cast("long").alias("taken"),
        passes.alias("passes"),
        F.coalesce("spans", none).alias("spans"),
    )
