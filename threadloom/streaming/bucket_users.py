"""Exact running users per subreddit, in a state of about two bytes a membership.

Authors are dealt to buckets by a hash, so a bucket holds all of an author and counts of buckets add up; a subreddit with a
third of all rows is spread over all of them. Within its bucket an author gets the next free number. A bucket's state is

* the names of its authors in order of their numbers, once each, in pages of ``PAGE``, and
* for each subreddit (and 65,536 numbers) the set of numbers seen there: sorted 16-bit numbers up to 4,096 of them and
  65,536 bits beyond, whichever is shorter.

The stream gives the *new* users per subreddit of each micro-batch; ``drain_increments`` adds them up.
"""

from __future__ import annotations

import sys
from collections import defaultdict
from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from threadloom.operators.filters import drop_deleted_authors, drop_empty_subreddit, with_subreddit_label
from threadloom.session import SETTINGS
from threadloom.sinks.published import current, publish, read_published

# Executors need no installed copy of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BUCKETS = 1024
#: Names in a page of a bucket's authors.
PAGE = 1024
BLOCK = 1 << 16
#: A set of more numbers is shorter as bits.
FEW = BLOCK // 16
SCHEMA = "subreddit string, added bigint"
STORE = "spark.sql.streaming.stateStore.providerClass"


def unpack(held: bytes) -> np.ndarray:
    """The sorted numbers of a set."""
    if len(held) == BLOCK // 8:
        return np.flatnonzero(np.unpackbits(np.frombuffer(held, np.uint8), bitorder="little")).astype(np.uint16)
    return np.frombuffer(held, "<u2")


def pack(numbers: np.ndarray) -> bytes:
    if len(numbers) < FEW:
        return numbers.astype("<u2").tobytes()
    bits = np.zeros(BLOCK, np.uint8)
    bits[numbers] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def add(held: bytes, numbers: list[int]) -> tuple[bytes, int]:
    """A set with further numbers, and how many of them are new."""
    before = unpack(held)
    after = np.union1d(before, np.array(numbers, np.uint16))
    return pack(after), len(after) - len(before)


class BucketUsers(StatefulProcessor):
    """Numbers the authors of a bucket and keeps the set of numbers of each subreddit."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.size = handle.getValueState("size", "size int")
        self.names = handle.getMapState("names", "page int", "names array<string>")
        self.members = handle.getMapState("members", "subreddit string, block int", "numbers binary")

    def _numbers(self, authors: set[str]) -> dict[str, int]:
        """Numbers of the authors, new ones for those without; pages are read one at a time."""
        size = self.size.get()[0] if self.size.exists() else 0
        found: dict[str, int] = {}
        last: list[str] = []
        for page in range(-(-size // PAGE)):
            last = list(self.names.getValue((page,))[0])
            found.update((name, page * PAGE + k) for k, name in enumerate(last) if name in authors)
        new = sorted(authors.difference(found))
        if not new:
            return found
        at = size
        for name in new:
            if at % PAGE == 0:
                last = []
            last.append(name)
            found[name] = at
            at += 1
            if at % PAGE == 0 or name == new[-1]:
                self.names.updateValue(((at - 1) // PAGE,), (last,))
        self.size.update((at,))
        return found

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        seen: dict[str, set[str]] = defaultdict(set)
        for frame in rows:
            for subreddit, author in frame[["subreddit", "author"]].drop_duplicates().itertuples(index=False):
                seen[subreddit].add(author)
        numbers = self._numbers(set().union(*seen.values()))
        added: dict[str, int] = {}
        for subreddit, authors in seen.items():
            blocks: dict[int, list[int]] = defaultdict(list)
            for author in authors:
                blocks[numbers[author] // BLOCK].append(numbers[author] % BLOCK)
            for block, inside in blocks.items():
                place = (subreddit, block)
                held = self.members.getValue(place)[0] if self.members.containsKey(place) else b""
                after, new = add(bytes(held), inside)
                if new:
                    self.members.updateValue(place, (after,))
                    added[subreddit] = added.get(subreddit, 0) + new
        yield pd.DataFrame({"subreddit": list(added), "added": list(added.values())}, columns=["subreddit", "added"])

    def close(self) -> None:
        pass


def stream_new_users(rows: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``subreddit``, ``added``: users seen there for the first time, summed per bucket of authors in each micro-batch."""
    named = drop_empty_subreddit(with_subreddit_label(drop_deleted_authors(rows))).select("subreddit", "author")
    keyed = named.withColumn("bucket", F.pmod(F.xxhash64("author"), F.lit(buckets)).cast("int"))
    return keyed.groupBy("bucket").transformWithStateInPandas(BucketUsers(), SCHEMA, outputMode="Update", timeMode="None")


def drain_increments(added: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Run ``stream_new_users`` over the files present and keep the running counts as the published table at ``path``.

    A version carries the number of its micro-batch, so one that is run again after a failure is not added twice.
    ``path`` and ``checkpoint`` belong together. The state has several tables, which only the RocksDB store can hold, so the query starts
    with that one whatever the session names.
    """

    def fold(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        held = current(spark, path)
        if held and held["number"] >= number:  # it counts already, but the state has yet to be committed
            batch.write.format("noop").mode("overwrite").save()
            return
        counts = batch.select("subreddit", F.col("added").alias("count"))
        if held:
            counts = counts.unionByName(read_published(spark, path))
        publish(counts.groupBy("subreddit").agg(F.sum("count").alias("count")), path, number)

    writer = (
        added.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(fold)
    )
    conf = added.sparkSession.conf
    before = conf.get(STORE, None)
    conf.set(STORE, SETTINGS[STORE])
    try:
        query = writer.start()  # takes the settings of now along
    finally:
        if before is None:
            conf.unset(STORE)
        else:
            conf.set(STORE, before)
    query.awaitTermination()
    return query


def state_size(query: StreamingQuery) -> dict[str, int]:
    """Rows and bytes of memory and disk that the state of a query's last micro-batch takes."""
    last = query.lastProgress
    operators = last.stateOperators if last else []
    on_disk = ("rocksdbSstFileSize", "rocksdbTotalBytesWritten")
    return {
        "rows": sum(operator.numRowsTotal for operator in operators),
        "memory": sum(operator.memoryUsedBytes for operator in operators),
        **{name: sum(int(operator.customMetrics.get(name, 0)) for operator in operators) for name in on_disk},
    }


def read_counts(spark: SparkSession, path: str) -> DataFrame | None:
    """The running counts ``(subreddit, count)``."""
    return read_published(spark, path)
