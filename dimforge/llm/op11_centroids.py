"""Centroid clustering with Ptolemaic pivot bounds.

Vectors become whole numbers (``floor(256 x)``), so distances, sums and means are
exact.  The centroids of a round in PIVOT_ROUNDS are the *pivots* until the next such
round; every vector's distances to them are computed once and written beside it.

For a vector q, a centroid c and pivots s, t, Ptolemy's inequality gives

    d(q, c) >= |d(q, s) d(c, t) - d(q, t) d(c, s)| / d(s, t).

A centroid has PARTNERS fixed pairs: s is the pivot nearest to it, t the pivots farthest
from s.  The largest bound of the pairs counts, lowered by more than the error of the
rounded distances.  The centroid of the smallest bound is measured exactly;
only centroids whose bound does not exceed the best exact distance are measured
after it, and a tie goes to the smaller number.  So no bound ever changes a result.

A round is one pass over the written vectors: each task sums its vectors per
centroid, the sums are added by Spark, and the driver sees one row per centroid and
component whatever the number of vectors.

Defined results: a vector counts if it has exactly DIMENSIONS components, none NULL
or non-finite; others are left out.  A NULL vec_id never starts a centroid, its vector is
assigned like any other.  Repeated rows are separate vectors.  With fewer than k vectors
that have an id, each starts a centroid; with none the result is empty.  Rows of equal hash are taken in
the order of their components.  ``distance`` is a 64-bit number, so a component beyond
LIMIT after scaling raises an error.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimforge.llm.common import bounded_batches, materialise

DIMENSIONS = 64
SCALE = 256
CENTROIDS = 40
ROUNDS = 5
PIVOT_ROUNDS = (0, 2)
PARTNERS = 2
LIMIT = 1 << 27
ROUNDING = 1e-6  # several times the relative error of a product of two rounded distances


def whole_vectors(table: DataFrame) -> DataFrame:
    """(vec_id, v array<int>) of the vectors that count, in whole numbers."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    scaled = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE))
    kept = table.select("vec_id", "embedding").filter((F.size("embedding") == DIMENSIONS) & finite).select("vec_id", scaled.alias("v"))
    fits = F.forall("v", lambda x: (x >= -LIMIT) & (x <= LIMIT))
    checked = F.when(fits, F.col("v")).otherwise(F.raise_error(F.lit("a component is too large for 64-bit distances")))
    return kept.select("vec_id", checked.cast("array<int>").alias("v"))


def first_centroids(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The ``k`` vectors of smallest ``sha256('seed:vec_id')``, in that order."""
    draw = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = vectors.filter("vec_id is not null").select(draw.alias("draw"), "v").orderBy("draw", "v").limit(k).collect()
    return np.array([row.v for row in first], np.int64).reshape(-1, DIMENSIONS)


def _squared(vectors: np.ndarray, point: np.ndarray) -> np.ndarray:
    gap = vectors - point
    return np.einsum("ij,ij->i", gap, gap)


def _to_points(vectors: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Distances of every vector to every point, rounded to 32-bit floats."""
    return np.sqrt(np.stack([_squared(vectors, p) for p in points], axis=1).astype(np.float64)).astype(np.float32)


class Pairs:
    """The fixed pivot pairs of a round's centroids."""

    def __init__(self, centroids: np.ndarray, pivots: np.ndarray, partners: int = PARTNERS):
        self.to_pivots = _to_points(centroids, pivots).astype(np.float64)
        self.between = _to_points(pivots, pivots).astype(np.float64)
        self.of = []
        for c in range(len(centroids)):
            s = int(self.to_pivots[c].argmin())
            far = np.argsort(-self.between[s], kind="stable")[:partners]
            self.of.append([(s, int(t)) for t in far if self.between[s, t] > 0])

    def bounds(self, far: np.ndarray) -> np.ndarray:
        """(vectors, centroids) from the vectors' cached distances: never above the true distance."""
        far = far.astype(np.float64)
        best = np.zeros((len(far), len(self.of)))
        for c, pairs in enumerate(self.of):
            for s, t in pairs:
                x, y = far[:, s] * self.to_pivots[c, t], far[:, t] * self.to_pivots[c, s]
                low = (np.abs(x - y) - ROUNDING * (x + y)) / (self.between[s, t] * (1 + ROUNDING))
                np.maximum(best[:, c], low, out=best[:, c])
        return best


def nearest(vectors: np.ndarray, far: np.ndarray, centroids: np.ndarray, pairs: Pairs) -> tuple[np.ndarray, np.ndarray, int]:
    """Number and exact squared distance of the nearest centroid, and how many distances were measured."""
    bound = pairs.bounds(far)
    label = bound.argmin(axis=1)
    gap = vectors - centroids[label]
    best = np.einsum("ij,ij->i", gap, gap)
    bound *= bound * (1 - ROUNDING)  # squared
    measured = len(vectors)
    first = label.copy()
    for c in range(len(centroids)):
        rows = np.flatnonzero((bound[:, c] <= best) & (first != c))
        if not len(rows):
            continue
        measured += len(rows)
        d = _squared(vectors[rows], centroids[c])
        closer = (d < best[rows]) | ((d == best[rows]) & (c < label[rows]))
        at = rows[closer]
        best[at], label[at] = d[closer], c
    return label, best, measured


def _matrix(column: pa.Array, kind) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), -1)


def _with_pivots(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """The vectors with their cached distances to the pivots."""
    def run(batches):
        for batch in batches:
            far = _to_points(_matrix(batch.column(1), np.int64), pivots)
            ends = np.arange(0, far.size + 1, far.shape[1], dtype=np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(pa.array(ends), pa.array(far.ravel()))],
                                              names=["vec_id", "v", "far"])

    return vectors.mapInArrow(run, "vec_id long, v array<int>, far array<float>")


def _next_centroids(cached: DataFrame, centroids: np.ndarray, pairs: Pairs) -> np.ndarray:
    """Componentwise floor of the mean of every centroid's vectors; a centroid without vectors stays."""
    k = len(centroids)

    def run(batches):
        total, n = np.zeros((k, DIMENSIONS), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            v = _matrix(batch.column(0), np.int64)
            label = nearest(v, _matrix(batch.column(1), np.float32), centroids, pairs)[0]
            np.add.at(total, label, v)
            n += np.bincount(label, minlength=k)
        used = np.flatnonzero(n)
        if len(used):
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat(used, DIMENSIONS).astype(np.int32)), pa.array(np.tile(np.arange(DIMENSIONS, dtype=np.int32), len(used))),
                pa.array(total[used].ravel()), pa.array(np.repeat(n[used], DIMENSIONS))], names=["cluster", "part", "total", "n"])

    sums = cached.select("v", "far").mapInArrow(run, "cluster int, part int, total long, n long")
    wide = sums.groupBy("cluster", "part").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"),
                                               F.sum(F.col("n").cast("decimal(38,0)")).alias("n"))
    moved = centroids.copy()
    for row in wide.collect():  # centroids x components
        moved[row.cluster, row.part] = int(row.total) // int(row.n)
    return moved


def cluster(table: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, seed: int = 2) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) per vector of ``table(vec_id, embedding)``."""
    if rounds < 1:
        raise ValueError("at least one round")
    spark = table.sparkSession
    bounded_batches(spark)
    vectors = whole_vectors(table.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding"))
    centroids = first_centroids(vectors, k, seed)
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not len(centroids):
        return spark.createDataFrame([], schema)
    cached = pivots = None
    for r in range(rounds):
        if r in PIVOT_ROUNDS:
            pivots = centroids
            cached = materialise(_with_pivots(vectors if cached is None else cached.select("vec_id", "v"), pivots), "centroid-vectors")
        moved = _next_centroids(cached, centroids, Pairs(centroids, pivots))
        if (moved == centroids).all():
            break  # later rounds would repeat this one
        centroids = moved
    pairs = Pairs(centroids, pivots)

    def run(batches):
        for batch in batches:
            label, best, _ = nearest(_matrix(batch.column(1), np.int64), _matrix(batch.column(2), np.float32), centroids, pairs)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(label.astype(np.int32)), pa.array(best)],
                                              names=["vec_id", "cluster", "distance"])

    assigned = materialise(cached.mapInArrow(run, "vec_id long, cluster int, distance long"), "centroid-assigned")
    per = assigned.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()  # one row per centroid
    inertia = sum(row.d for row in per)
    known = [(row.cluster, row.d, inertia, hashlib.sha256(",".join(map(str, centroids[row.cluster])).encode()).hexdigest()) for row in per]
    found = spark.createDataFrame(known, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # at most k rows
    return assigned.join(F.broadcast(found), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
