"""Centroid clustering of 64-component integer vectors by bit planes.

Bit ``i`` of all 64 components of a vector is one unsigned 64-bit integer, its plane ``i``. A component is the sum
of its bits times ``2**i``, the top plane counting negative (two's complement). So the dot product of a
vector and a centroid is

    sum over i, j of weight_i * weight_j * popcount(plane_i AND plane_j)

and with the squared norms it gives the exact squared distance. Vectors are stored as planes once; every
round reads the stored table, holds each vector against all centroids and sends one row of sums for each task and cluster.
Centroids are the only thing that goes through the driver: ``clusters`` rows of 64 integers.

The integers are ``floor(scale * x)``. ``x`` beyond what ``PLANES`` planes hold is taken as the largest integer that they hold
(2**25 - 1 in size), so distances stay far inside 64 bits; totals beyond 64 bits are the largest 64-bit integer.
Null vectors, vectors of another length, and vectors with a null, infinite or NaN component are left out. A null id counts as
empty text in the choice of the first centroids, where equal ids are told apart by their components. Repeated rows are vectors of
their own, centroids may be equal, and the smaller number wins a tie. With fewer vectors than ``clusters`` there are as many
clusters as vectors; an empty table gives an empty result. Columns other than the id and the vector are left out first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.plans.materialize import store

WIDTH = 64
CLUSTERS = 40
ROUNDS = 5
SCALE = 256
#: Most bit planes of a component, the sign included.
PLANES = 26
#: Vectors held against all centroids at once.
BLOCK = 2048
LARGEST = (1 << 63) - 1


def kept_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``vec_id`` and the integer ``components`` of the vectors that can be used."""
    x = F.col("x").cast("array<double>")
    rows = vectors.select(F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{embedding}`").alias("x"))
    good = (F.size("x") == WIDTH) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    most = float((1 << (PLANES - 1)) - 1)
    whole = F.transform(x, lambda v: F.floor(F.greatest(F.lit(-most), F.least(F.lit(most), v * float(scale)))).cast("int"))
    return rows.where(F.coalesce(good, F.lit(False))).select("vec_id", whole.alias("components"))


def pack(components: np.ndarray, planes: int) -> np.ndarray:
    """The planes (rows, ``planes``) of integers (rows, 64); component k is bit k."""
    bits = (components[:, None, :] >> np.arange(planes)[:, None]) & 1
    return np.packbits(bits.astype(np.uint8), axis=2, bitorder="little").view("<u8")[:, :, 0]


def unpack(planes: np.ndarray) -> np.ndarray:
    """The integers behind planes."""
    held = np.ascontiguousarray(planes, "<u8")[:, :, None].view(np.uint8)
    return np.einsum("p,rpc->rc", weights(planes.shape[1]), np.unpackbits(held, axis=2, bitorder="little").astype(np.int64))


def weights(planes: int) -> np.ndarray:
    """What a bit of each plane counts."""
    found = 1 << np.arange(planes, dtype=np.int64)
    found[-1] = -found[-1]
    return found


def needed(components: np.ndarray) -> int:
    """Planes that hold all the integers."""
    low, high = int(components.min(initial=0)), int(components.max(initial=0))
    return max((-low - 1).bit_length() if low < 0 else 0, high.bit_length()) + 1


def dots(planes: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Dot products (rows, clusters) by weighted popcounts of ANDed planes."""
    out = np.zeros((len(planes), len(centroids)), np.int64)
    ours, theirs = weights(planes.shape[1]), weights(centroids.shape[1])
    for i, ours_weight in enumerate(ours):
        for j, their_weight in enumerate(theirs):
            common = np.bitwise_count(planes[:, i, None] & centroids[None, :, j])
            out += common * (ours_weight * their_weight)
    return out


def nearest(planes: np.ndarray, norms: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid (ties: the smaller) and the squared distance to it.

    ``centroids`` are integers. Rows are taken block by block; a block uses as many planes as its own
    numbers need, so one large component does not slow all others down.
    """
    theirs = pack(centroids, needed(centroids))
    squares = (centroids * centroids).sum(axis=1)
    cluster, distance = np.zeros(len(planes), np.int64), np.zeros(len(planes), np.int64)
    for start in range(0, len(planes), BLOCK):
        rows = slice(start, start + BLOCK)
        block = planes[rows]
        used = block.shape[1]
        while used > 1 and (block[:, used - 1] == block[:, used - 2]).all():
            used -= 1  # the plane only repeats the sign
        far = norms[rows, None] + squares - 2 * dots(block[:, :used], theirs)
        cluster[rows] = far.argmin(axis=1)
        distance[rows] = far.min(axis=1)
    return cluster, distance


def _planes(batch: pa.RecordBatch) -> np.ndarray:
    held = batch.column(1)
    flat = held.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    return flat.reshape(len(batch), -1)


def packed_vectors(kept: DataFrame) -> DataFrame:
    """``vec_id``, ``planes`` (signed 64-bit integers) and the squared ``norm`` of kept vectors."""
    kind = kept.schema["vec_id"].dataType.simpleString()

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, WIDTH)
            count = needed(whole)
            flat = pack(whole, count).reshape(-1).view(np.int64)
            ends = pa.array(np.arange(len(whole) + 1) * count, pa.int32())
            planes = pa.ListArray.from_arrays(ends, pa.array(flat))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), planes, pa.array((whole * whole).sum(axis=1))], ["vec_id", "planes", "norm"]
            )

    return kept.select("vec_id", "components").mapInArrow(make, f"vec_id {kind}, planes array<bigint>, norm bigint")


def _alike(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Stretches of rows with equally many planes: each batch was packed by itself."""
    ends = np.asarray(batch.column(1).offsets)
    cuts = np.flatnonzero(np.diff(np.diff(ends))) + 1
    for start, end in zip([0, *cuts], [*cuts, len(batch)]):
        if end > start:
            yield batch.slice(int(start), int(end - start))


def assign(packed: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``vec_id``, ``cluster`` and squared ``distance`` of every packed vector."""
    kind = packed.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in _alike(whole)):
            cluster, distance = nearest(_planes(batch), batch.column(2).to_numpy(), centroids)
            columns = [batch.column(0), pa.array(cluster.astype(np.int32)), pa.array(distance)]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cluster", "distance"])

    return packed.select("vec_id", "planes", "norm").mapInArrow(run, f"vec_id {kind}, cluster int, distance bigint")


def cluster_sums(packed: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``cluster``, ``count`` and component ``sums``, summed in each task and then over the tasks."""
    count = len(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, sizes = np.zeros((count, WIDTH), np.int64), np.zeros(count, np.int64)
        for batch in (part for whole in batches for part in _alike(whole)):
            planes = _planes(batch)
            cluster, _ = nearest(planes, batch.column(2).to_numpy(), centroids)
            for start in range(0, len(planes), BLOCK):
                rows = slice(start, start + BLOCK)
                np.add.at(sums, cluster[rows], unpack(planes[rows]))
            sizes += np.bincount(cluster, minlength=count)
        ends = pa.array(np.arange(count + 1) * WIDTH, pa.int32())
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(count), pa.int32()), pa.array(sizes), pa.ListArray.from_arrays(ends, pa.array(sums.reshape(-1)))],
            ["cluster", "count", "sums"],
        )

    parts = packed.select("vec_id", "planes", "norm").mapInArrow(run, "cluster int, count bigint, sums array<bigint>")
    total = [F.sum(F.col("sums")[k].cast("decimal(38,0)")).alias(f"s{k}") for k in range(WIDTH)]
    return parts.where("count > 0").groupBy("cluster").agg(F.sum("count").alias("count"), *total)


def first_centroids(kept: DataFrame, clusters: int, seed: str) -> np.ndarray:
    """The integers of the vectors whose ids have the smallest hashes, in order of the hash."""
    name = F.concat(F.lit(seed), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    # At most `clusters` rows of 64 integers.
    chosen = kept.select(F.sha2(name, 256).alias("hash"), "components").orderBy("hash", "components").limit(clusters)
    return np.array([row["components"] for row in chosen.collect()], np.int64).reshape(-1, WIDTH)


def fit(kept: DataFrame, packed: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: str = "2:") -> np.ndarray:
    """The centroids after ``rounds`` rounds. A centroid that no vector is nearest to stays."""
    centroids = first_centroids(kept, clusters, seed)
    for _ in range(rounds if len(centroids) else 0):
        moved = centroids.copy()
        for row in cluster_sums(packed, centroids).collect():  # a row for each centroid
            moved[row["cluster"]] = [int(row[f"s{k}"]) // row["count"] for k in range(WIDTH)]
        centroids = moved
    return centroids


def cluster_vectors(
    vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", clusters: int = CLUSTERS, rounds: int = ROUNDS
) -> DataFrame:
    """``vec_id``, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia`` and the cluster's ``centroid``."""
    spark = vectors.sparkSession
    kept = kept_vectors(vectors, vec_id, embedding)
    packed = store(packed_vectors(kept), "packed-vectors").table
    centroids = fit(kept, packed, clusters, rounds)
    placed = store(assign(packed, centroids), "assigned-vectors").table if len(centroids) else assign(packed, np.zeros((1, WIDTH), np.int64))
    # A row for each cluster.
    sums = {
        row["cluster"]: int(row["n"])
        for row in placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("n")).collect()
    }
    total = min(sum(sums.values()), LARGEST)
    rows = [(number, min(n, LARGEST), total, centroids[number].tolist()) for number, n in sums.items()]
    facts = spark.createDataFrame(rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid array<bigint>")
    return placed.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"
    )
