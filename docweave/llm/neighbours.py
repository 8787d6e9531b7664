"""Approximate nearest neighbours with a hash-prefix forest.

Each tree gives a vector a hash string of 64 characters, the sides of 64 random
planes it lies on; two vectors share a character with a chance of 1 minus their
angle over pi. A tree is the sorted array of these strings. A query descends each
tree to its longest matching prefix, then all trees ascend together, one
character at a time, and score what comes below the shorter prefixes by exact
cosine. At prefix length d, the chance that a neighbour of a given cosine has
been met in one of the trees is known; a query stops as soon as this chance, for
the k-th best cosine it has found, is ``hit_rate`` or more (a better one that is
not found yet has a larger chance). Queries with near neighbours stop high up and
score few rows; one without any goes on, in the worst case to prefix length 0,
where every vector has been scored.

The index is dealt into blocks of bounded size by hash (a block is a random
sample, so no block is hot); queries, a stated set, come in blocks too, and a
task holds one block of each. Equal vectors are indexed once, with their k + 1
smallest ids, which is all that an answer can use.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

TREES = 128
LENGTH = 64  # characters of a hash string, one bit each
HIT_RATE = 0.93
SEED = 20177
#: queries that ascend together
TILE = 256


def hash_strings(unit: np.ndarray, tree: int) -> np.ndarray:
    """Hash strings of vectors in one tree, first character in the highest bit."""
    rng = np.random.default_rng([SEED, unit.shape[1], tree])
    planes = rng.standard_normal((unit.shape[1], LENGTH)).astype(np.float32)
    return np.packbits(unit.astype(np.float32) @ planes > 0, axis=1).view(">u8")[:, 0].astype(np.uint64)


def common_prefix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of two arrays of hash strings."""
    x = a ^ b
    for k in (1, 2, 4, 8, 16, 32):
        x |= x >> np.uint64(k)
    return LENGTH - np.bitwise_count(x).astype(np.int64)


class Forest:
    """Sorted hash strings of the vectors of one block."""

    def __init__(self, unit: np.ndarray, trees: int):
        self.unit, self.n, self.trees = unit, len(unit), trees
        strings = np.stack([hash_strings(unit, t) for t in range(trees)])
        order = np.argsort(strings, axis=1, kind="stable")
        self.keys = np.take_along_axis(strings, order, 1)
        self.rows = order.astype(np.int32).ravel()

    def _longest(self, strings: np.ndarray) -> np.ndarray:
        """Longest prefix that each query shares with any string of any tree."""
        best = np.zeros(strings.shape[1], np.int64)
        for keys, s in zip(self.keys, strings):
            at = np.searchsorted(keys, s)
            for near in (np.maximum(at - 1, 0), np.minimum(at, self.n - 1)):
                best = np.maximum(best, common_prefix(keys[near], s))
        return best

    def _below(self, strings: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Per tree and query, where the strings with its prefix of ``depth`` start and end."""
        rest = np.uint64((1 << (LENGTH - depth)) - 1)
        ends = [(np.searchsorted(k, s & ~rest), np.searchsorted(k, s | rest, side="right")) for k, s in zip(self.keys, strings)]
        return np.stack([a for a, _ in ends]), np.stack([b for _, b in ends])

    def search(self, queries: np.ndarray, k: int, hit_rate: float):
        """For each unit query ``(rows, scores, depth)``: what it scored, in single
        cosines, until its k-th best was met with a chance of ``hit_rate``."""
        for a in range(0, len(queries), TILE):
            q = queries[a : a + TILE]
            strings = np.stack([hash_strings(q, t) for t in range(self.trees)])
            start = self._longest(strings)
            score = np.full((len(q), self.n), -np.inf)
            stop = np.full(len(q), -1)
            for depth in range(int(start.max()), -1, -1):
                active = np.flatnonzero((stop < 0) & (start >= depth))
                lo, hi = self._below(strings[:, active], depth)
                offset = np.arange(self.trees) * self.n
                for j, i in enumerate(active):
                    size = hi[:, j] - lo[:, j]
                    ends = np.cumsum(size)
                    rows = self.rows[np.repeat(lo[:, j] + offset - (ends - size), size) + np.arange(ends[-1])]
                    rows = np.unique(rows[np.isneginf(score[i, rows])])
                    score[i, rows] = self.unit[rows] @ q[i]
                    have = score[i][score[i] > -np.inf]
                    if not depth or (len(have) >= k and self._met(np.partition(have, -k)[-k], depth) >= hit_rate):
                        stop[i] = depth
            for i in range(len(q)):
                rows = np.flatnonzero(score[i] > -np.inf)
                yield rows, score[i, rows], int(stop[i])

    def _met(self, cosine: float, depth: int) -> float:
        """Chance that a vector of this cosine shares a prefix of ``depth`` in one of the trees."""
        same = 1 - np.arccos(np.clip(cosine, -1, 1)) / np.pi
        return 1 - (1 - same**depth) ** self.trees


def _vectors(col: pd.Series) -> np.ndarray:
    return np.stack(col.to_list()).astype(np.float64)


def _search(k: int, trees: int, hit_rate: float):
    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
        if left.empty or right.empty:
            return empty
        x, q = _vectors(left["vector"]), _vectors(right["vector"])
        unit_x = x / np.abs(x).max(axis=1, keepdims=True)
        unit_x /= np.sqrt((unit_x**2).sum(axis=1, keepdims=True))
        unit_q = q / np.abs(q).max(axis=1, keepdims=True)
        unit_q /= np.sqrt((unit_q**2).sum(axis=1, keepdims=True))
        norm_x, norm_q = np.sqrt((x**2).sum(axis=1)), np.sqrt((q**2).sum(axis=1))
        ids = left["ids"].to_list()
        first = np.array([i[0] for i in ids])
        out = []
        # the query's own vector is in the index: one more than k
        for j, (rows, about, _) in enumerate(Forest(unit_x, trees).search(unit_q, k + 1, hit_rate)):
            if len(rows) > k + 1:
                rows = rows[about >= np.partition(about, -(k + 1))[-(k + 1)] - 1e-9]
            score = (x[rows] @ q[j]) / norm_x[rows] / norm_q[j]
            own = int(right["query_id"].iat[j])
            found = [(-s, int(i)) for r, s in sorted(zip(rows, score), key=lambda p: (-p[1], first[p[0]]))[: k + 1] for i in ids[r] if i != own]
            out += [(own, i, -s) for s, i in sorted(found)[:k]]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]) if out else empty

    return search


def usable(vectors: DataFrame) -> DataFrame:
    """``(vec_id, vector)`` of the rows that can take part: an id, and a vector
    with finite components that are not all zero."""
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    nonzero = F.exists("vector", lambda x: x != 0)
    v = v.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull())
    # -0.0 and 0.0 are one value
    return v.where(finite & nonzero).withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0)))


def nearest(
    vectors: DataFrame,
    is_query,
    k: int = 5,
    trees: int = TREES,
    block_rows: int = 16_384,
    query_rows: int = 16_384,
    hit_rate: float = HIT_RATE,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` best found for each row of
    ``vectors(vec_id, embedding)`` that meets ``is_query``, among all other rows.

    In each block the trees ascend until the k-th best found has been met with a
    chance of ``hit_rate``; 1 scores every vector. Vectors that are null, zero
    or hold null or non-finite components, and rows without an id, take no
    part. Vectors only meet vectors of their own dimension. Equal scores rank by
    vec_id; a repeated vec_id counts once per different vector. Fewer than k
    candidates give fewer rows, an empty table none. Extra columns are ignored.
    """
    rows = usable(vectors).distinct()
    smallest = Window.partitionBy("vector").orderBy("vec_id")
    index = (
        rows.withColumn("n", F.row_number().over(smallest))
        .where(F.col("n") <= k + 1)  # limited before the shuffle, too
        .groupBy("vector")
        .agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
        .checkpoint()
    )
    queries = rows.where(is_query).select(F.col("vec_id").alias("query_id"), "vector")
    n, q = index.count(), queries.count()
    blocks, parts = max(1, -(-n // block_rows)), max(1, -(-q // query_rows))
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    left = index.withColumn("block", F.pmod(F.xxhash64("vector"), F.lit(blocks)).cast("int")).withColumn("part", every(parts))
    right = queries.withColumn("part", F.pmod(F.xxhash64("query_id"), F.lit(parts)).cast("int")).withColumn("block", every(blocks))
    key = lambda f: f.withColumn("dim", F.size("vector")).groupBy("dim", "block", "part")
    found = key(left).cogroup(key(right)).applyInPandas(_search(k, trees, hit_rate), "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
