"""Centroid clustering whose assignment is a tournament of bisectors, in whole numbers throughout.

Two centroids are parted by the plane half-way between them. For every pair its integer normal and
threshold are worked out once a round; a vector then meets the centroids in their order, and the sign of
one linear form decides which of two goes on, so ``k - 1`` tests find the nearest. A zero keeps the
smaller number. No distance is needed until the last assignment, where that to the winner is exact.

A round is one pass over the vectors: tasks sum their vectors per cluster, Spark adds the sums up, and
only ``k`` times ``width`` of them, whatever the input, come to the driver.

Defined cases: only vectors of exactly ``width`` components, none of them null or non-finite, take part,
so a null vector does not. Repeated rows count as often as they occur, each with its own result. With
fewer vectors than ``k`` there is a centroid for each; an empty table gives an empty result. A null
``vec_id`` is hashed as an empty text and stays null. Only ``vec_id`` and ``embedding`` are read, so other
columns may have any name. A component of 2**27 or more after scaling is an error, as distances would no
longer fit a long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retailtide.llm.components import written

SCALE = 256
WIDTH = 64
CLUSTERS = 40
ROUNDS = 5

#: Vectors that are compared at once, so that they stay in the processor's cache.
BLOCK = 1024

#: Below this every form and distance is exact in a double, up to the next bound in a long.
_EXACT_DOUBLE = 2**20
_EXACT_LONG = 2**27


def _to_integers(batches: Iterator[pa.RecordBatch], width: int, scale: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("embedding")
        fits = pc.fill_null(pc.equal(pc.list_value_length(lists), width), False)
        ids, lists = batch.column("vec_id").filter(fits), lists.filter(fits)
        flat = lists.flatten()
        has = np.asarray(pc.is_valid(flat)).reshape(-1, width).all(1)
        parts = np.asarray(pc.fill_null(flat, 0).cast(pa.float64())).reshape(-1, width)
        good = has & np.isfinite(parts).all(1)
        whole = np.floor(scale * parts[good])
        if whole.size and np.abs(whole).max() >= _EXACT_LONG:
            raise ValueError(f"a component times {scale} is {_EXACT_LONG} or more")
        flat = pa.array(whole.astype(np.int32).ravel())
        offsets = pa.array(np.arange(len(whole) + 1, dtype=np.int32) * width)
        yield pa.record_batch([ids.filter(pa.array(good)), pa.ListArray.from_arrays(offsets, flat)], ["vec_id", "v"])


def integer_vectors(embeddings: DataFrame, width: int = WIDTH, scale: int = SCALE) -> DataFrame:
    """``vec_id, v``: the usable vectors as whole numbers, each component rounded down after scaling."""
    schema = T.StructType(
        [T.StructField("vec_id", embeddings.schema["vec_id"].dataType), T.StructField("v", T.ArrayType(T.IntegerType()))]
    )
    read = embeddings.select("vec_id", "embedding")
    return read.mapInArrow(partial(_to_integers, width=width, scale=scale), schema)


class Bisectors:
    """The planes between all pairs of ``k`` centroids, and the tournament over them."""

    def __init__(self, centroids: list[list[int]]):
        self.centroids = np.array(centroids, np.int64)
        squares = (self.centroids**2).sum(1)
        k = len(self.centroids)
        #: Of each centroid against all before it: a vector is nearer to it where x . normal > threshold.
        self.normals = [2 * (self.centroids[j] - self.centroids[:j]) for j in range(k)]
        self.thresholds = [squares[j] - squares[:j] for j in range(k)]
        self.small = not k or np.abs(self.centroids).max() < _EXACT_DOUBLE
        if self.small:
            self.doubles = [n.astype(np.float64) for n in self.normals]

    def winners(self, x: np.ndarray) -> np.ndarray:
        """The number of the nearest centroid of each row of whole numbers; the smallest of several."""
        small = self.small and (not x.size or np.abs(x).max() < _EXACT_DOUBLE)
        x, normals = (x.astype(np.float64), self.doubles) if small else (x.astype(np.int64), self.normals)
        won = np.zeros(len(x), np.int64)
        for j in range(1, len(self.centroids)):
            form = np.einsum("nd,nd->n", x, normals[j][won])
            won[form > self.thresholds[j][won]] = j
        return won

    def distances(self, x: np.ndarray, won: np.ndarray) -> np.ndarray:
        return ((x.astype(np.int64) - self.centroids[won]) ** 2).sum(1)


def _blocks(batch: pa.RecordBatch, width: int) -> Iterator[tuple[int, np.ndarray]]:
    vectors = np.asarray(batch.column("v").flatten()).reshape(-1, width)
    for start in range(0, len(vectors), BLOCK):
        yield start, vectors[start : start + BLOCK]


def _sums(batches: Iterator[pa.RecordBatch], centroids: list[list[int]]) -> Iterator[pa.RecordBatch]:
    planes = Bisectors(centroids)
    k, width = planes.centroids.shape
    total, count = np.zeros((k, width), np.int64), np.zeros(k, np.int64)
    for batch in batches:
        for _, x in _blocks(batch, width):
            won = planes.winners(x)
            order = np.argsort(won, kind="stable")
            present, first = np.unique(won[order], return_index=True)
            total[present] += np.add.reduceat(x[order].astype(np.int64), first, axis=0)
            count += np.bincount(won, minlength=k)
    has = np.flatnonzero(count)
    columns = [
        np.repeat(has, width),
        np.tile(np.arange(width), len(has)),
        total[has].ravel(),
        np.repeat(count[has], width),
    ]
    yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], ["cluster", "part", "total", "n"])


def _assigned(batches: Iterator[pa.RecordBatch], centroids: list[list[int]]) -> Iterator[pa.RecordBatch]:
    planes = Bisectors(centroids)
    for batch in batches:
        won = np.zeros(batch.num_rows, np.int32)
        far = np.zeros(batch.num_rows, np.int64)
        for start, x in _blocks(batch, planes.centroids.shape[1]):
            near = planes.winners(x)
            won[start : start + len(x)] = near
            far[start : start + len(x)] = planes.distances(x, near)
        yield pa.record_batch([batch.column("vec_id"), pa.array(won), pa.array(far)], ["vec_id", "cluster", "distance"])


def first_centroids(vectors: DataFrame, k: int = CLUSTERS) -> list[list[int]]:
    """The ``k`` vectors with the smallest hashes of their ids, in the order of the hashes."""
    rank = F.sha2(F.concat(F.lit("2:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    return [list(r["v"]) for r in vectors.select(rank.alias("rank"), "v").orderBy("rank", "v").limit(k).collect()]


def moved(vectors: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """The centroids after a round; one that no vector is nearest to stays."""
    tasks = vectors.mapInArrow(partial(_sums, centroids=centroids), "cluster long, part long, total long, n long")
    sums = tasks.groupBy("cluster", "part").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    after = [list(c) for c in centroids]
    for row in sums.collect():  # at most k times the width
        after[row["cluster"]][row["part"]] = row["total"] // row["n"]
    return after


def cluster(
    spark: SparkSession, embeddings: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, width: int = WIDTH, scale: int = SCALE
) -> DataFrame:
    """Every usable vector with its cluster, squared distance, the sums of these, and the centroid's hash.

    ``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256, centroid``.
    """
    vectors = written(integer_vectors(embeddings, width, scale), "vectors")
    centroids = first_centroids(vectors, k)
    schema = T.StructType(
        [
            vectors.schema["vec_id"],
            T.StructField("cluster", T.IntegerType()),
            T.StructField("distance", T.LongType()),
        ]
    )
    if centroids:
        for _ in range(rounds):
            centroids = moved(vectors, centroids)
        near = vectors.mapInArrow(partial(_assigned, centroids=centroids), schema)
        assigned = written(near, "clusters")
    else:
        assigned = spark.createDataFrame([], schema)
    inertia = {r["cluster"]: r["sum"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("sum")).collect()}
    rows = [
        (c, inertia[c], sum(inertia.values()), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest(), centroids[c])
        for c in sorted(inertia)
    ]
    known = spark.createDataFrame(
        rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string, centroid array<int>"
    )
    return assigned.join(F.broadcast(known), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "centroid"
    )
