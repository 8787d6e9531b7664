"""Centroid clustering with equal-average equal-variance nearest-centroid search.

Vectors become whole numbers, so every distance and every sum is exact and the
result does not depend on how rows are dealt. For d components with sum S and
deviation V (the length of the vector less its mean), two vectors are never
nearer than

    (S_x - S_c)^2 / d + (V_x - V_c)^2.

Centroids are sorted by their mean. The search of a vector starts at the
centroid whose mean is next to its own and steps outward, always to the nearer
side; the first term alone ends it once it is larger than the best distance, as
all that follow are still farther in their means; both terms reject single
centroids; only what is left is compared component by component, in integers.
A bound rejects when it is strictly larger, with a margin for rounding, so ties
are all compared and the smaller centroid number wins.

The centroids (k x d whole numbers, whatever the table's size) go out with each
round's task; a task sends back one row of sums per centroid and batch, summed
by Spark per component. The driver sees k x d sums a round. The whole-number vectors are
written once to the shared checkpoint folder, so a lost executor repeats its
tasks from there.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docweave.session import scratch_path

#: whole numbers up to this size have squared distances of 64 components that fit a long
LARGEST = 1 << 27
#: relative part by which a bound is reduced for rounding
MARGIN = 1e-9


def whole_numbers(embeddings: DataFrame, dim: int, scale: int, vector: str = "embedding") -> DataFrame:
    """``(vec_id, x)`` of the rows that take part: exactly ``dim`` components, none
    null or non-finite; ``x`` holds floor(scale * component)."""
    v = F.col(vector).cast("array<double>")
    scaled = F.transform(v, lambda c: F.floor(c * F.lit(float(scale))))
    inside = F.forall(v, lambda c: c.isNotNull() & (F.abs(c) < F.lit(float(LARGEST) / scale)))
    kept = F.coalesce((F.size(v) == dim) & inside, F.lit(False))
    return embeddings.where(kept).select(F.col("vec_id").cast("long").alias("vec_id"), scaled.cast("array<int>").alias("x"))


def seeds(vectors: DataFrame, k: int, salt: str) -> np.ndarray:
    """The ``k`` vectors of smallest SHA-256 of ``salt`` and vec_id, in this order (a
    null vec_id last; rows of one vec_id by their components)."""
    key = F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256)
    rows = vectors.select(key.alias("h"), "x").orderBy(F.col("h").asc_nulls_last(), "x").limit(k).collect()
    return np.array([r["x"] for r in rows], dtype=np.int64)


class Search:
    """Nearest centroid of whole batches of vectors."""

    def __init__(self, centroids: np.ndarray):
        self.dim = centroids.shape[1]
        self.number = np.lexsort((np.arange(len(centroids)), centroids.sum(axis=1)))
        self.c = centroids[self.number]
        self.sums = self.c.sum(axis=1).astype(np.float64)
        self.dev = self._deviation(self.c)

    @staticmethod
    def _deviation(x: np.ndarray) -> np.ndarray:
        centred = x - x.mean(axis=1, keepdims=True)
        return np.sqrt(np.einsum("ij,ij->i", centred, centred))

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """``(centroid number, squared distance, compared pairs)`` of each row of ``x``."""
        n, k = len(x), len(self.c)
        sums, dev = x.sum(axis=1).astype(np.float64), self._deviation(x)
        best = np.full(n, np.iinfo(np.int64).max)
        which = np.full(n, k)
        up = np.searchsorted(self.sums, sums)  # next centroid of a larger mean
        down = up - 1
        active, compared = np.arange(n), 0
        while len(active):
            a = active
            gap_up = np.where(up[a] < k, np.abs(self.sums[np.minimum(up[a], k - 1)] - sums[a]), np.inf)
            gap_down = np.where(down[a] >= 0, np.abs(self.sums[np.maximum(down[a], 0)] - sums[a]), np.inf)
            upward = gap_up <= gap_down
            gap = np.where(upward, gap_up, gap_down)
            by_mean = gap * gap / self.dim * (1 - MARGIN)
            # everything further out has a mean farther away
            go = np.isfinite(gap) & (by_mean <= best[a])
            a, upward, by_mean = a[go], upward[go], by_mean[go]
            at = np.where(upward, up[a], down[a])
            up[a[upward]] += 1
            down[a[~upward]] -= 1
            spread = np.maximum(np.abs(dev[a] - self.dev[at]) - MARGIN * (dev[a] + self.dev[at]), 0.0)
            near = by_mean + spread * spread * (1 - MARGIN) <= best[a]
            rows, at = a[near], at[near]
            compared += len(rows)
            diff = x[rows] - self.c[at]
            d = np.einsum("ij,ij->i", diff, diff)
            number = self.number[at]
            better = (d < best[rows]) | ((d == best[rows]) & (number < which[rows]))
            best[rows[better]], which[rows[better]] = d[better], number[better]
            active = a
        return which, best, compared


def _batches(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).astype(np.int64)


def _total(x: np.ndarray) -> Decimal:
    """Exact sum of non-negative longs that may not fit a long."""
    return Decimal((int((x >> 32).sum()) << 32) + int((x & 0xFFFFFFFF).sum()))


def sums_by_centroid(vectors: DataFrame, centroids: np.ndarray) -> dict[int, tuple[int, int, list[int]]]:
    """``{centroid: (vectors, inertia, sum of each component)}`` of the non-empty ones."""
    k, dim = centroids.shape

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(centroids)
        for b in batches:
            x = _batches(b, dim)
            which, distance, _ = search.nearest(x)
            found = np.unique(which)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(found.astype(np.int32)),
                    pa.array([int((which == c).sum()) for c in found], pa.int64()),
                    pa.array([_total(distance[which == c]) for c in found], pa.decimal128(38, 0)),
                    pa.array([x[which == c].sum(axis=0).tolist() for c in found], pa.list_(pa.int64())),
                ],
                ["cluster", "n", "inertia", "total"],
            )

    parts = vectors.select("x").mapInArrow(kernel, "cluster int, n long, inertia decimal(38,0), total array<long>")
    each = parts.select("cluster", "n", "inertia", F.posexplode("total").alias("i", "v"))
    rows = each.groupBy("cluster", "i").agg(F.sum("n").alias("n"), F.sum("inertia").alias("inertia"), F.sum("v").alias("v")).collect()
    out: dict[int, tuple[int, int, list[int]]] = {}
    for r in rows:  # k x dim rows
        out.setdefault(r["cluster"], (r["n"], int(r["inertia"]), [0] * dim))[2][r["i"]] = r["v"]
    return out


def fit(vectors: DataFrame, first: np.ndarray, rounds: int) -> np.ndarray:
    """Centroids after ``rounds`` rounds: every non-empty one becomes the floor of its vectors' mean."""
    centroids = first.copy()
    for _ in range(rounds):
        for c, (n, _, total) in sums_by_centroid(vectors, centroids).items():
            centroids[c] = [v // n for v in total]
    return centroids


def assign(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``(vec_id, cluster, distance)`` of every vector."""
    dim = centroids.shape[1]

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(centroids)
        for b in batches:
            which, distance, _ = search.nearest(_batches(b, dim))
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(which.astype(np.int32)), pa.array(distance)], ["vec_id", "cluster", "distance"])

    return vectors.select("vec_id", "x").mapInArrow(kernel, "vec_id long, cluster int, distance long")


def _per_cluster(values: dict[int, str | int], kind: str) -> Column:
    pairs = [F.lit(y) for c, v in sorted(values.items()) for y in (c, v)]
    return F.element_at(F.create_map(*pairs), F.col("cluster")).cast(kind)


def cluster(embeddings: DataFrame, k: int = 8, dim: int = 64, scale: int = 1024, rounds: int = 10, salt: str = "3:", vector: str = "embedding") -> DataFrame:
    """``(vec_id, cluster, distance, cluster_inertia, inertia, centroid)`` of every
    row of ``embeddings(vec_id, embedding)`` whose vector takes part; ``centroid``
    is the final one's components.

    Vectors that are null, of another length, or hold a null or non-finite
    component take no part, nor do those with a component whose whole number
    reaches 2 ** 27 (their distances would not fit a long). Repeated rows and rows of
    a null vec_id are vectors of their own; equal vectors get equal answers. With fewer than
    ``k`` vectors there are as many centroids; an empty table gives an empty
    result. Extra columns are ignored.
    """
    spark = embeddings.sparkSession
    path = scratch_path(spark, "centroids-vectors")
    whole_numbers(embeddings, dim, scale, vector).write.parquet(path)
    vectors = spark.read.schema("vec_id long, x array<int>").parquet(path)
    first = seeds(vectors, k, salt)
    kinds = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid array<long>"
    if not len(first):
        return spark.createDataFrame([], kinds)
    centroids = fit(vectors, first, rounds)
    inertia = {c: s[1] for c, s in sums_by_centroid(vectors, centroids).items()}
    named = {c: ",".join(map(str, centroids[c].tolist())) for c in inertia}
    return assign(vectors, centroids).select(
        "vec_id", "cluster", "distance",
        _per_cluster(inertia, "long").alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("long").alias("inertia"),
        F.split(_per_cluster(named, "string"), ",").cast("array<long>").alias("centroid"),
    )
