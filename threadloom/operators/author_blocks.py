"""Shared authors of subreddits whose authors have many: blocks of subreddits meet, and nothing is shuffled for it.

Where an author has ``n`` subreddits, lists by the larger number of each pair hold ``n * n / 2`` entries, so what is shuffled grows with
the pairs. Here the subreddits are dealt into ``G`` groups by a hash, the memberships are written once, a folder for each group, and a task
makes and sums the pairs between two groups from their two folders. An author with very many subreddits is spread over all tasks.
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
from pyspark.sql import types as T

from threadloom.plans.materialize import scratch_path
from threadloom.sources.paths import open_path, qualified

# Executors need no installed copy of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Pairs that a task makes, and how many of them it sums together.
PAIRS_OF_TASK = 8_000_000
PAIRS_AT_ONCE = 1 << 21
MOST_GROUPS = 256


def groups_for(pairs: float, parallelism: int) -> int:
    """Groups of which each two have about ``PAIRS_OF_TASK`` pairs, and enough of them for all cores."""
    tasks = max(pairs / PAIRS_OF_TASK, 4 * parallelism if pairs > PAIRS_OF_TASK else 1)
    return min(MOST_GROUPS, max(1, math.ceil((math.sqrt(8 * tasks + 1) - 1) / 2)))


def _folder_reader(path: str) -> Callable[[int], pa.Table | None]:
    system, root = open_path(path)

    def read(group: int) -> pa.Table | None:
        infos = system.get_file_info(fs.FileSelector(f"{root}/part={group}", allow_not_found=True))
        tables = []
        for info in infos:
            if info.is_file and info.base_name.endswith(".parquet"):
                with system.open_input_file(info.path) as file:
                    tables.append(pq.ParquetFile(file).read(use_threads=False))
        return pa.concat_tables(tables) if tables else None

    return read


class Group:
    """The memberships of a group, its subreddits numbered by their places in ``vids``."""

    def __init__(self, held: pa.Table, named: bool):
        known = held["vid"].combine_chunks().dictionary_encode()
        self.vids, at = known.dictionary.to_numpy(), known.indices.to_numpy()
        if named:
            first = np.empty(len(self.vids), np.int64)
            first[at[::-1]] = np.arange(len(at))[::-1]
            self.names = held["subreddit"].take(pa.array(first)).combine_chunks()
        author = held["id"].to_numpy()
        order = np.argsort(author, kind="stable")
        self.author, self.at = author[order], at[order]
        begins = np.flatnonzero(np.concatenate([[True], self.author[1:] != self.author[:-1]]))
        self.authors, self.first = self.author[begins], np.append(begins, len(author))


def pair_sums(ours: Group, theirs: Group) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(x, y, u)``: numbers of ``ours`` and of ``theirs`` and their shared authors; within one group ``x < y``."""
    place = np.minimum(np.searchsorted(ours.authors, theirs.authors), len(ours.authors) - 1)
    known = ours.authors[place] == theirs.authors
    times = np.diff(theirs.first)
    met = np.flatnonzero(np.repeat(known, times))
    place = np.repeat(place, times)[met]
    first, each = ours.first[place], np.diff(ours.first)[place]
    # By the numbers of ``theirs``: a portion ends where one of them does, so it has all of its pairs.
    y = theirs.at[met]
    order = np.argsort(y.astype(np.uint16) if len(theirs.vids) <= 1 << 16 else y, kind="stable")
    y, first, each = y[order].astype(np.int64), first[order], each[order]
    ends = np.cumsum(each)
    start, wide = 0, len(ours.vids)
    while start < len(y):
        done = ends[start - 1] if start else 0
        stop = int(np.searchsorted(ends, done + PAIRS_AT_ONCE, "right"))
        stop = int(np.searchsorted(y, y[stop], "left")) if stop < len(y) else stop
        stop = stop if stop > start else int(np.searchsorted(y, y[start], "right"))
        n = each[start:stop]
        entry = np.arange(ends[stop - 1] - done) + np.repeat(first[start:stop] - (ends[start:stop] - n - done), n)
        x, other = ours.at[entry], np.repeat(y[start:stop], n)
        if ours is theirs:
            some = np.flatnonzero(x < other)
            x, other = x[some], other[some]
        low, tall = int(y[start]), int(y[stop - 1]) - int(y[start]) + 1
        if tall * wide <= 4 * len(x):  # most of the places have a pair
            found = np.bincount((other - low) * wide + x, minlength=tall * wide)
            keys = np.flatnonzero(found)
            found = found[keys]
        else:
            keys, found = np.unique((other - low) * wide + x, return_counts=True)
        yield keys % wide, keys // wide + low, found
        start = stop


def count_in_blocks(members: DataFrame, groups: int) -> DataFrame:
    """``(a, b, u)`` of distinct ``(vid, id)`` rows, ``id`` a 64-bit number of the author; ``a`` and ``b`` in the order of their numbers.

    Of rows with a ``subreddit`` too, ``a`` and ``b`` are the names of those numbers. The pairs are made when they are read, from
    the stored table ``author-blocks``.
    """
    spark = members.sparkSession
    path = qualified(spark, scratch_path(spark, "author-blocks"))
    named = "subreddit" in members.columns
    cores = spark.sparkContext.defaultParallelism
    part = f"cast(pmod(xxhash64(vid), {groups}) as int)"
    dealt = members.select("id", "vid", *["subreddit"] * named).repartition(groups, F.expr(part)).withColumn("part", F.expr(part))
    dealt.sortWithinPartitions("part", "id").write.partitionBy("part").parquet(path, compression="zstd")
    pairs = sorted(((p, q) for p in range(groups) for q in range(p, groups)), key=lambda pair: pair[0] == pair[1])
    kind: T.DataType = members.schema["subreddit" if named else "vid"].dataType
    schema = T.StructType([T.StructField("a", kind), T.StructField("b", kind), T.StructField("u", T.LongType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = _folder_reader(path)
        for p, q in (pairs[n] for batch in batches for n in batch.column("id").to_pylist()):
            held = [read(group) for group in {p: 0, q: 0}]
            if any(table is None for table in held):
                continue
            ours, theirs = (Group(held[0], named), Group(held[-1], named))
            theirs = ours if p == q else theirs
            del held
            for x, y, u in pair_sums(ours, theirs):
                if named:
                    ends = [ours.names.take(pa.array(x)), theirs.names.take(pa.array(y))]
                else:
                    low, high = ours.vids[x], theirs.vids[y]
                    ends = [pa.array(np.minimum(low, high)), pa.array(np.maximum(low, high))]
                table = pa.table([*ends, pa.array(u.astype(np.int64))], ["a", "b", "u"])
                yield from table.to_batches(max_chunksize=1 << 18)

    tasks = min(len(pairs), 256 * cores)
    return spark.range(0, len(pairs), 1, tasks).mapInArrow(count, schema)
