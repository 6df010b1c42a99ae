"""Centroid clustering of integer vectors, nearest centroids found by Orchard search.

Every centroid has a list of the others, nearest first. A search stands at a centroid and
walks its list; a centroid that is closer to the vector (or as close with a smaller number)
becomes the new place, and its own list is walked from the beginning. Centroids that were
compared are marked and not compared again. The walk ends where the next entry of the list is
strictly farther from the place than twice the vector is: by the triangle inequality
neither it nor any later entry can be closer, nor as close. So the result is
that of comparing all centroids, ties included.

All numbers are integers: components are ``floor(scale * x)``, distances are squared and
exact, and a centroid is the floor of an exact mean, so no result depends on an order of
addition. A round is one scan: each task searches its vectors a batch at a time and gives one row
per centroid with the exact sums of its vectors; what reaches the driver are ``k``
centroids, whatever the number of vectors. Vectors are never shuffled.

Vectors that are null, of another length or hold a null, NaN or infinite component take no
part. A row without an id takes part, but is the last to become a centroid. Repeated rows are
vectors of their own; of rows with one id the least components come first. With fewer
than ``k`` vectors each is a centroid. An empty table gives no rows. Only ``vec_id`` and
``embedding`` are read. A component beyond 2**26 after scaling ends the job with
an error, as its distances would not fit a long.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.base import written

#: Components stay below this, so that four times a squared distance fits a long.
LARGEST = 1 << 26
#: Vectors that are searched at a time.
STEP = 1 << 14


def whole_vectors(embeddings: DataFrame, size: int = 64, scale: int = 256) -> DataFrame:
    """``vec_id, v`` with ``v`` the integer components of all vectors that take part."""
    x = F.col("embedding").cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    kept = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x")).where((F.size(x) == size) & finite)
    scaled = F.transform("x", lambda c: F.floor(c * F.lit(float(scale))))
    small = F.forall(scaled, lambda c: F.abs(c) <= LARGEST)
    return kept.select("vec_id", F.when(small, scaled).otherwise(F.raise_error(F.lit("component too large"))).alias("v"))


def first_centroids(vectors: DataFrame, k: int, order: Column) -> np.ndarray:
    """The first ``k`` vectors by ``order``; a null comes last, ties go by components."""
    rows = vectors.orderBy(order.asc_nulls_last(), "vec_id", "v").limit(k).collect()
    return np.array([r["v"] for r in rows], np.int64)


@dataclass
class Neighbours:
    """Centroids and, for each, all of them by distance: the first of a list is itself."""

    centroids: np.ndarray
    lists: np.ndarray
    apart: np.ndarray

    @classmethod
    def of(cls, centroids: np.ndarray) -> "Neighbours":
        k = len(centroids)
        apart = np.stack([((centroids - c) ** 2).sum(axis=1) for c in centroids]) if k else np.zeros((0, 0), np.int64)
        lists = np.argsort(apart, axis=1, kind="stable")
        return cls(centroids, lists, np.take_along_axis(apart, lists, axis=1))

    def search(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest centroid and squared distance of each vector, ties to the smaller number."""
        n, k = len(vectors), len(self.centroids)
        here = np.zeros(n, np.int64)  # the centroid a search stands at
        best = ((vectors - self.centroids[0]) ** 2).sum(axis=1)
        marked = np.zeros((n, k), bool)
        marked[:, 0] = True
        at = np.zeros(n, np.int64)  # the place in its list
        going = np.arange(n)
        while len(going):
            place, next_ = here[going], at[going]
            ends = next_ >= k
            next_ = np.minimum(next_, k - 1)
            ends |= self.apart[place, next_] > 4 * best[going]
            going, place, next_ = going[~ends], place[~ends], next_[~ends]
            other = self.lists[place, next_]
            at[going] += 1
            new = ~marked[going, other]
            row, other = going[new], other[new]
            marked[row, other] = True
            far = ((vectors[row] - self.centroids[other]) ** 2).sum(axis=1)
            closer = (far < best[row]) | ((far == best[row]) & (other < here[row]))
            row, other = row[closer], other[closer]
            best[row], here[row], at[row] = far[closer], other, 0
        return here, best


def _matrix(column: pa.ListArray, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def assigned(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``vec_id, cluster, distance`` of every vector."""
    near = Neighbours.of(centroids)

    def run(batches):
        for batch in batches:
            v = _matrix(batch.column(1), near.centroids.shape[1])
            for a in range(0, len(v), STEP):
                cluster, distance = near.search(v[a : a + STEP])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, STEP), pa.array(cluster.astype(np.int32)), pa.array(distance)],
                    ["vec_id", "cluster", "distance"],
                )

    return vectors.mapInArrow(run, "vec_id long, cluster int, distance long")


def moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: floors of exact means; one without vectors stays."""
    near = Neighbours.of(centroids)
    k, size = centroids.shape

    def run(batches):
        counts, sums = np.zeros(k, np.int64), np.zeros((k, size), np.int64)
        for batch in batches:
            v = _matrix(batch.column(1), size)
            for a in range(0, len(v), STEP):
                cluster, _ = near.search(v[a : a + STEP])
                counts += np.bincount(cluster, minlength=k)
                np.add.at(sums, cluster, v[a : a + STEP])
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some), pa.array(counts[some]), pa.array(sums[some].tolist(), pa.list_(pa.int64()))], ["cluster", "n", "sums"]
        )

    parts = vectors.mapInArrow(run, "cluster long, n long, sums array<long>")
    exact = parts.select("cluster", "n", F.posexplode("sums").alias("at", "s")).groupBy("cluster", "at")
    totals = exact.agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    found = centroids.copy()
    for r in totals.collect():  # k times the length of a vector
        found[r["cluster"], r["at"]] = int(r["s"]) // int(r["n"])
    return found


def clustered(
    embeddings: DataFrame, k: int = 40, rounds: int = 5, seed: int = 2, size: int = 64, scale: int = 256
) -> tuple[DataFrame, np.ndarray]:
    """``vec_id, cluster, distance`` of every vector after ``rounds``, and the centroids.

    The first centroids are the vectors with the smallest SHA-256 of ``seed:vec_id``.
    """
    vectors = whole_vectors(embeddings, size, scale)
    centroids = first_centroids(vectors, k, F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256))
    if not len(centroids):
        return vectors.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")).where(F.lit(False)), centroids
    for _ in range(rounds):
        centroids = moved(vectors, centroids)
    return assigned(vectors, centroids), centroids


def with_inertia(found: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Adds the sums of distances of the cluster and of all, and the digest of the centroid."""
    found = written(found, "clusters")
    sums = {r[0]: int(r[1]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)"))).collect()}  # k rows
    about = [
        (i, sums.get(i, 0), sum(sums.values()), hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest())
        for i, c in enumerate(centroids)
    ]
    schema = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    named = found.sparkSession.createDataFrame(about, schema)  # k rows
    return found.join(F.broadcast(named), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
