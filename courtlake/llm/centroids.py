"""Clustering of vectors around moving centroids, in integers, by a tournament over bisectors.

For centroids a and b the sign of ``2 x . (b - a) - (|b|^2 - |a|^2)`` says on which side of their bisector x lies.  The normals
``2 (b - a)`` and the thresholds ``|b|^2 - |a|^2`` of all pairs are computed once a round.  A vector starts with centroid 0 and
meets 1, 2, ... in turn: k - 1 sign tests leave its nearest centroid.  A sign of zero is a tie, which the smaller number wins.  Only
the distance to the winner is computed, and exactly: everything here is a 64-bit integer.

A round is one pass over the vectors.  Each task sums its vectors by cluster, so that k rows a task are shuffled however many
vectors a cluster has, and k rows reach the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Largest size of an integer component: 64 components of it leave squared distances and sign tests within 64 bits.
LARGEST = 1 << 26
#: Vectors of one numpy pass.
ROWS = 4096


@dataclass(frozen=True)
class Bisectors:
    """Normals (k, k, dims) and thresholds (k, k) of all pairs of centroids."""

    centroids: np.ndarray
    normals: np.ndarray
    thresholds: np.ndarray

    @staticmethod
    def of(centroids: list[list[int]]) -> Bisectors:
        c = np.array(centroids, np.int64)
        squares = (c * c).sum(axis=1)
        return Bisectors(c, 2 * (c[None, :, :] - c[:, None, :]), squares[None, :] - squares[:, None])

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid of each row, the smaller one if equal, and the squared distance to it."""
        best = np.zeros(len(x), np.int64)
        for rival in range(1, len(self.centroids)):
            side = np.einsum("ij,ij->i", self.normals[best, rival], x) - self.thresholds[best, rival]
            best[side > 0] = rival
        away = x - self.centroids[best]
        return best, (away * away).sum(axis=1)


def integer_vectors(vectors: DataFrame, dims: int, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, x) of vectors with exactly `dims` components, none null or non-finite; x is floor(scale * component).

    A component whose integer is beyond LARGEST ends the job with an error, since its distances would not fit 64 bits.
    """
    number = F.col(vector_col).cast("array<double>")
    finite = F.forall(number, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    kept = vectors.filter(F.col(vector_col).isNotNull() & (F.size(vector_col) == dims)).filter(finite)
    large = F.exists(number, lambda v: F.abs(v * scale) > LARGEST)
    safe = F.when(large, F.raise_error(F.lit(f"a component times {scale} is beyond {LARGEST}"))).otherwise(F.transform(number, lambda v: F.floor(v * scale)))
    return kept.select(F.col(id_col).cast("long").alias("vec_id"), safe.alias("x"))


def first_centroids(integers: DataFrame, k: int, salt: str) -> list[list[int]]:
    """The k vectors of smallest hexadecimal sha256 of the salt and their id (nothing for null), in that order.

    Rows that repeat an id tie; of them the smaller vector comes first.
    """
    key = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    return [r.x for r in integers.select("x", key.alias("key")).orderBy("key", "x").limit(k).collect()]


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _sums(batches: Iterator[pa.RecordBatch], bisectors: Bisectors) -> Iterator[pa.RecordBatch]:
    """Of all rows of a task: cluster, its number of vectors and their sums."""
    k, dims = bisectors.centroids.shape
    count, total = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
    for batch in batches:
        x = _matrix(batch.column(0), dims)
        for i in range(0, len(x), ROWS):
            part = x[i:i + ROWS]
            best, _ = bisectors.nearest(part)
            count += np.bincount(best, minlength=k)
            np.add.at(total, best, part)
    used = np.flatnonzero(count)
    yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(count[used]), pa.array(total[used].tolist(), pa.list_(pa.int64()))], ["cluster", "n", "total"])


def move_centroids(integers: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """One round: every vector to its nearest centroid, then each centroid to the floored mean of its vectors; empty ones stay."""
    bisectors = Bisectors.of(centroids)
    sums = integers.select("x").mapInArrow(lambda it: _sums(it, bisectors), "cluster int, n long, total array<long>")
    each = [F.sum(F.col("total")[i].cast("decimal(38,0)")).alias(f"t{i}") for i in range(len(centroids[0]))]
    moved = list(centroids)
    for r in sums.groupBy("cluster").agg(F.sum("n").alias("n"), *each).collect():
        moved[r.cluster] = [int(t) // r.n for t in r[2:]]
    return moved


def _assigned(batches: Iterator[pa.RecordBatch], bisectors: Bisectors) -> Iterator[pa.RecordBatch]:
    dims = bisectors.centroids.shape[1]
    for batch in batches:
        x = _matrix(batch.column(1), dims)
        for i in range(0, len(x), ROWS):
            best, distance = bisectors.nearest(x[i:i + ROWS])
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, ROWS), pa.array(best.astype(np.int32)), pa.array(distance)], ["vec_id", "cluster", "distance"])


def assign(integers: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """vec_id, cluster and squared distance of every vector."""
    bisectors = Bisectors.of(centroids)
    return integers.mapInArrow(lambda it: _assigned(it, bisectors), "vec_id long, cluster int, distance long")


def fit(integers: DataFrame, k: int, rounds: int, salt: str) -> list[list[int]]:
    """Centroids after `rounds` rounds; at most k, and fewer if there are fewer vectors."""
    centroids = first_centroids(integers, k, salt)
    for _ in range(rounds if centroids else 0):
        centroids = move_centroids(integers, centroids)
    return centroids


def cluster(vectors: DataFrame, k: int = 40, rounds: int = 5, dims: int = 64, scale: int = 256, salt: str = "2:", id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every kept vector.

    Vectors that are null, of another length or with a null or non-finite component are not kept.  A null id is kept and hashed as
    an empty one; rows that repeat an id are clustered one by one; equal vectors share a cluster.  No kept vector gives no rows.
    Other columns are ignored.
    """
    if k < 1 or rounds < 0:
        raise ValueError("k must be at least 1 and rounds at least 0")
    integers = integer_vectors(vectors, dims, scale, id_col, vector_col)
    centroids = fit(integers, k, rounds, salt)
    if not centroids:
        return integers.sparkSession.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    found = assign(integers, centroids)
    # k rows: the sums of distances by cluster
    spread = {r.cluster: int(r.s) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    rows = [(c, s, sum(spread.values()), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for c, s in spread.items()]
    facts = integers.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
