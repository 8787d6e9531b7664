"""Nearest-neighbour search: exact kNN (J7, L1, L2), IVF lists (L4) and
random-hyperplane LSH (L5).

No cross join and no pair rows: distances are computed inside tasks by a
numpy kernel that emits each question's k best of the rows it sees, and no
more; a window keeps the global k best. Ranking key: distance rounded to 1e-9,
then the chunk key, so near-equal distances rank by key in every engine.

Exact plan: questions and chunks are cut into hash blocks of bounded bytes;
each (question block, chunk block) cell is one ``cogroup`` group and one task. Nothing is
collected or broadcast, and there is one plan for every size. The kernel works
in tiles, so its memory is a constant beside the two blocks.

IVF / LSH: a group is (list or bucket, chunk salt, question salt); a hot list
is split on both sides, so no group grows with the data. On larger tables LSH cells are
blocks of questions and chunks, as in the exact plan. It probes as many
near buckets as a close neighbour needs; questions whose k nearest are not all
that close are answered by the exact plan.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from docweave.functions.vectors import distance, normalise_metric
from docweave.options import JobOptions

RANK_DIGITS = 9
#: distances held at a time by the kernel
TILE = 1_000_000
CHUNK_TILE = 2_048
#: rows that are made into several at a time
STEP = 1_024
#: hits one cell returns, about
CELL_HITS = 1_000_000
#: pairs of one cell of the exact search, about
CELL_PAIRS = 1 << 32


# ------------------------------------------------------------------ kernel

def _exact(qv: np.ndarray, cv: np.ndarray, metric: str) -> np.ndarray:
    """Exact distances of paired rows (same shapes), summed per pair in order."""
    if metric == "IP":
        return -np.einsum("ij,ij->i", qv, cv)
    if metric == "COSINE":
        dot = np.einsum("ij,ij->i", qv, cv)
        with np.errstate(divide="ignore", invalid="ignore"):
            return 1.0 - dot / (np.sqrt(np.einsum("ij,ij->i", qv, qv)) * np.sqrt(np.einsum("ij,ij->i", cv, cv)))
    d = qv - cv
    return np.sqrt(np.einsum("ij,ij->i", d, d))


def _doubles(V: np.ndarray) -> np.ndarray:
    return V.astype(np.float64, copy=False)


class _Scan:
    """Rows of one side made ready for products: a distance is first told from
    ``A = [-2q, 1] . [c, c.c]`` (L2) or ``-q.c`` (IP, and COSINE on unit vectors), in
    floats where the numbers allow it. ``slack`` is what round-off (relative to the norms) can hide."""

    def __init__(self, V: np.ndarray, metric: str, kind, chunks: bool):
        dim = V.shape[1]
        self.squares = np.empty(len(V))
        self.rows = np.ones((len(V), dim + (metric == "L2")), kind)
        for at in range(0, len(V), CHUNK_TILE):  # no second copy of a block in doubles
            part = slice(at, at + CHUNK_TILE)
            v = _doubles(V[part])
            squares = self.squares[part] = np.einsum("ij,ij->i", v, v)
            if metric == "COSINE":
                with np.errstate(divide="ignore", invalid="ignore"):
                    v = v / np.sqrt(squares)[:, None]
            self.rows[part, :dim] = v if chunks else -2.0 * v if metric == "L2" else -v
            if chunks and metric == "L2":
                self.rows[part, dim] = squares


def _kind(*sides: np.ndarray):
    """Floats where no square comes near their ends, else doubles."""
    for V in sides:
        top = max(abs(float(V.max(initial=0.0))), abs(float(V.min(initial=0.0))))
        if not top == top or not (top == 0.0 or 1e-12 < top < 1e12):
            return np.float64
    return np.float32


def _bound(reach: np.ndarray, q2: np.ndarray, c2: float, dim: int, kind, metric: str) -> np.ndarray:
    """Largest ``A`` of a pair whose rounded distance can be at most that of ``reach``."""
    eps = 2 * np.finfo(kind).eps * (dim + 8)
    step = 2 * 10.0**-RANK_DIGITS
    if metric == "L2":
        at = (reach + step) ** 2 - q2 + eps * (q2 + c2)
    elif metric == "IP":
        at = reach + step + eps * np.sqrt(q2 * c2)
    else:
        at = reach - 1.0 + step + eps
    return np.nextafter(at.astype(kind), kind(np.inf))


def topk_block(Q: np.ndarray, C: np.ndarray, k, metric: str):
    """The k nearest rows of C for each row of Q as (q_index, c_index, distance)
    arrays; ties in the rounded distance go to the lower index. ``k``: one
    number, or one per row of Q. Exactly min(k, len(C)) rows per question."""
    ks = np.broadcast_to(np.asarray(k, dtype=np.int64), (len(Q),))
    none = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    if not len(Q) or not len(C) or ks.max() <= 0:
        return none
    scan = _Scan(C, metric, _kind(Q, C), chunks=True)
    out, a = [], 0
    by_k = np.argsort(ks, kind="stable")  # a tile holds questions of similar k
    while a < len(Q):
        # the tile's height follows from its largest k, which sits at its end
        top = max(1, int(ks[by_k[a]]))
        width = min(len(C), max(CHUNK_TILE, top))
        height = max(1, TILE // width)
        tile = by_k[a : a + height]
        tile = tile[ks[tile] <= max(4 * top, 64)]
        a += len(tile)
        found = _tile_topk(Q[tile], C, scan, ks[tile], width, metric)
        out.append((tile[found[0]], found[1], found[2]))
    return tuple(np.concatenate(x) for x in zip(*out))


def _places(mask: np.ndarray) -> np.ndarray:
    """``flatnonzero`` of marks that are rare: eight of them are looked at as one number."""
    if mask.shape[1] % 8 or not mask.flags.c_contiguous:
        return np.flatnonzero(mask)
    words = np.flatnonzero(mask.reshape(-1).view(np.uint64) != 0)
    some = np.flatnonzero(mask.reshape(-1, 8)[words])
    return words[some >> 3] * 8 + (some & 7)


def _tile_topk(q: np.ndarray, C: np.ndarray, scan: _Scan, ks: np.ndarray, width: int, metric: str):
    """The rows of C pass by in tiles. The k-th smallest product so far bounds what a later
    tile keeps; only what is left at the end is scored exactly (numbers that are not
    finite: at once)."""
    top, dim, kind = int(ks.max()), q.shape[1], scan.rows.dtype.type
    if top <= 0:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    own = _Scan(q, metric, kind, chunks=False)
    q2, c2 = own.squares, float(scan.squares.max())
    odd = not (np.isfinite(own.rows).all() and np.isfinite(scan.rows).all())
    limit = max(1, TILE // dim // 4)  # pairs whose vectors are held at a time
    eps = 2 * np.finfo(kind).eps * (dim + 8)
    best = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    bound, fresh, waiting = None, [], 0
    products, within = np.empty((len(q), min(width, len(C))), kind), np.empty((len(q), min(width, len(C))), bool)

    def exact(qi, ci):
        parts = [_exact(_doubles(q[qi[x : x + limit]]), _doubles(C[ci[x : x + limit]]), metric) for x in range(0, len(qi), limit)]
        return np.concatenate(parts) if parts else np.empty(0)

    def bound_of(kth):
        """Largest product of a pair that can rank with one of product ``kth``."""
        reach = {"L2": lambda: np.sqrt(np.maximum(kth + q2 + eps * (q2 + c2), 0.0)), "IP": lambda: kth + eps * np.sqrt(q2 * c2), "COSINE": lambda: kth + 1.0 + eps}[metric]()
        return _bound(reach, q2, c2, dim, kind, metric)

    def nearest(qi, ci, d):
        order = np.lexsort((ci, np.round(d, RANK_DIGITS), qi))
        qi, ci, d = qi[order], ci[order], d[order]
        keep = np.arange(len(qi)) - np.searchsorted(qi, qi) < ks[qi]
        return qi[keep], ci[keep], d[keep]

    for b in range(0, len(C), width):
        c = scan.rows[b : b + width]
        A = np.matmul(own.rows, c.T, out=products[:, : len(c)])
        if odd:
            A[np.isnan(A)] = np.inf
        if bound is None:
            k = min(top, len(c))
            bound = bound_of(np.partition(A, k - 1, axis=1)[:, k - 1].astype(np.float64) if k < len(c) else np.full(len(q), np.inf))
            if odd:
                bound[np.isnan(bound)] = np.inf
        mask = np.less_equal(A, bound[:, None], out=within[:, : len(c)])
        at = _places(mask)
        if not len(at):
            continue
        qi, ci = np.divmod(at, len(c))
        crowded = np.bincount(qi, minlength=len(q)) > 4 * top + 64
        plain = ~crowded[qi]
        qi, ci = qi[plain], ci[plain]
        fresh.append((qi, ci + b, exact(qi, ci + b) if odd else A[qi, ci].astype(np.float64)))
        waiting += len(qi)
        for r in np.flatnonzero(crowded):  # many ties: one question at a time, cut to k at once
            i = np.flatnonzero(mask[r])
            d = exact(np.full(len(i), r), i + b)
            near = np.lexsort((i, np.round(d, RANK_DIGITS)))[:top]
            fresh.append((np.full(len(near), r), i[near] + b, d[near] if odd else A[r, i[near]].astype(np.float64)))
            waiting += len(near)
        if b == 0 or waiting > len(q) * top or b + width >= len(C):
            qi, ci, d = (np.concatenate(x) for x in zip(best, *fresh))
            fresh, waiting = [], 0
            if odd:
                qi, ci, d = best = nearest(qi, ci, d)
            else:
                order = np.lexsort((d, qi))
                qi, ci, d = qi[order], ci[order], d[order]
            first, n = np.searchsorted(qi, np.arange(len(q))), np.bincount(qi, minlength=len(q))
            full = (n >= ks) & (ks > 0)
            last = d[np.where(full, first + ks - 1, 0)] if len(d) else np.empty(0)
            now = np.full(len(q), np.nan)
            if len(d):
                now = _bound(np.where(full, last, np.nan), q2, c2, dim, kind, metric) if odd else bound_of(np.where(full, last, np.nan))
            bound = np.where(np.isnan(now), bound, np.minimum(bound, now))
            if not odd:
                keep = d <= bound[qi]
                best = qi[keep], ci[keep], d[keep]
    if not odd:
        qi, ci, _ = (np.concatenate(x) for x in zip(best, *fresh))
        return nearest(qi, ci, exact(qi, ci))
    return nearest(*(np.concatenate(x) for x in zip(best, *fresh))) if fresh else best


def _matrix(col: pd.Series) -> np.ndarray:
    if len(col) == 0:
        return np.zeros((0, 0))
    return np.stack([np.asarray(v, dtype=np.float64) for v in col.to_numpy()])


def _arrow_matrix(col: pa.ChunkedArray) -> np.ndarray:
    """The vectors of a list column as one matrix of its own number type."""
    if not len(col):
        return np.zeros((0, 0))
    lists = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    size = pc.min_max(pc.list_value_length(lists))
    if lists.null_count or size["min"].as_py() != size["max"].as_py():
        raise ValueError("vectors must be there and of one length")
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def _cell_kernel(k, m, qkey, ckey):
    """Kernel of one cell, on Arrow tables (no object a row); ``k``: a number or the name of a question column."""

    def kernel(qs: pa.Table, cs: pa.Table) -> pa.Table:
        # index order = key order
        order = pc.sort_indices(cs.select(ckey), sort_keys=[(c, "ascending") for c in ckey], null_placement="at_start")
        ks = qs[k].to_numpy() if isinstance(k, str) else k
        cv = _arrow_matrix(cs["_cv"])
        qi, ci, d = topk_block(_arrow_matrix(qs["_qv"]), cv[order.to_numpy()] if len(cv) else cv, ks, m)
        at = order.take(pa.array(ci, pa.int64()))
        out = {c: qs[c].take(pa.array(qi, pa.int64())) for c in qkey}
        out.update({c: cs[c].take(at) for c in ckey})
        if isinstance(k, str):
            out[k] = pa.array(ks[qi], pa.int64())
        out["distance"] = pa.array(d, pa.float64())
        return pa.table(out)

    return kernel


def _one_cell(k, m, qkey, ckey):
    kernel = _cell_kernel(k, m, qkey, ckey)
    return lambda qs, cs: kernel(qs, cs)  # a third argument would stand for the group's key


# ------------------------------------------------------------------ exact kNN

def _out_schema(qkey, ckey, qdf: DataFrame, cdf: DataFrame, k=None) -> T.StructType:
    fields = [qdf.schema[c] for c in qkey] + [cdf.schema[c] for c in ckey]
    if isinstance(k, str):
        fields.append(T.StructField(k, T.LongType()))
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in fields] + [T.StructField("distance", T.DoubleType(), True)])


def _final_topk(partial: DataFrame, qkey, ckey, k) -> DataFrame:
    w = Window.partitionBy(*qkey).orderBy(F.round("distance", RANK_DIGITS), *ckey)
    ranked = partial.withColumn("rank", F.row_number().over(w).cast("bigint"))
    if isinstance(k, str):
        return ranked.where(F.col("rank") <= F.col(k)).drop(k)
    return ranked.where(F.col("rank") <= k)


def _blocks(rows: int, dim: int, limit: int, at_least: int) -> int:
    """Number of blocks that keep ``rows`` vectors of ``dim`` doubles under
    ``limit`` bytes each; more for small inputs, so that all cores have work."""
    return max(1, math.ceil(rows * dim * 8 / limit), min(at_least, rows // 1000))


def knn_exact(
    questions: DataFrame,
    chunks: DataFrame,
    k: int | str,
    opts: JobOptions,
    qkey=("request_id", "q_no"),
    ckey=("filename", "chunk_no"),
    qvec: str = "qvec",
    cvec: str = "vector",
    metric: str | None = None,
) -> DataFrame:
    """The k nearest chunks of every question -> qkey + ckey + distance + rank.
    ``k``: one number, or the name of a question column with a number per question."""
    qkey, ckey = list(qkey), list(ckey)
    m = normalise_metric(metric or opts.metric)
    extra = [F.col(k).cast("bigint").alias(k)] if isinstance(k, str) else []
    q = questions.select(*qkey, *extra, F.col(qvec).alias("_qv"))
    c = chunks.select(*ckey, F.col(cvec).alias("_cv"))
    cores = chunks.sparkSession.sparkContext.defaultParallelism
    n = chunks.count()
    asked = questions.agg(F.count(F.lit(1)).alias("n"), F.sum(F.least((F.col(k) if extra else F.lit(k)).cast("bigint"), F.lit(n).cast("bigint")).cast("double")).alias("hits")).first()
    cb = _blocks(n, opts.embed_dim, opts.knn_block_bytes, cores)
    # a cell gives at most k hits a question, and no more than it has chunks
    most = asked["hits"] or 0.0
    if asked["n"] and most / asked["n"] * cb > n:
        cb = max(cb, math.ceil(most / CELL_HITS))
        most = asked["n"] * n / cb
    qb = max(_blocks(asked["n"], opts.embed_dim, opts.knn_block_bytes, 1), math.ceil(most / CELL_HITS), math.ceil(asked["n"] * n / cb / CELL_PAIRS))
    # a task is one cell, however many there are: a cell's time is bounded, that of some cells that share a partition is not
    cell = (F.col("_qb") * cb + F.col("_cb")).cast("int")
    qs = q.withColumn("_qb", F.pmod(F.xxhash64(*qkey), F.lit(qb))).withColumn("_cb", F.explode(F.sequence(F.lit(0), F.lit(cb - 1))))
    cs = c.withColumn("_cb", F.pmod(F.xxhash64(*ckey), F.lit(cb)).cast("int")).withColumn("_qb", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(qb - 1).cast("bigint"))))
    qs, cs = (side.withColumn("_cell", cell).drop("_qb", "_cb").repartitionById(qb * cb, F.col("_cell")) for side in (qs, cs))
    schema = _out_schema(qkey, ckey, q, c, k)
    partial = qs.groupBy("_cell").cogroup(cs.groupBy("_cell")).applyInArrow(_one_cell(k, m, qkey, ckey), schema)
    # hits are questions x k rows and usually feed several branches (scores,
    # blocks, has-hits); a reliable checkpoint runs the kernel once
    return _final_topk(partial, qkey, ckey, k).checkpoint(eager=True)


# ------------------------------------------------------------------ single vector

def topk_search(chunks: DataFrame, query_vector, k: int = 0, opts: JobOptions | None = None, ckey=("filename", "chunk_no"), cvec: str = "vector", metric: str = "L2") -> DataFrame:
    """L1 / L2: the k nearest rows of one vector (k = 0 -> 20), with distance,
    as ``orderBy(...).limit(k)`` (a TakeOrderedAndProject: each task keeps k)."""
    from docweave.options import K_NEIGHBOURS

    kk = k if k else K_NEIGHBOURS
    qv = F.array(*[F.lit(float(x)).cast("float") for x in query_vector])
    d = distance(F.col(cvec), qv, metric)
    return (
        chunks.select(*ckey, d.alias("distance"))
        .orderBy(F.round("distance", RANK_DIGITS), *ckey)
        .limit(kk)
    )


# ------------------------------------------------------------------ IVF (L4)

def _row_hash_order(df: DataFrame, key) -> Column:
    return F.md5(F.concat_ws("#", *[F.col(c).cast("string") for c in key]))


def sample_centroids(chunks: DataFrame, lists: int, ckey=("filename", "chunk_no"), cvec: str = "vector") -> list[list[float]]:
    """Fixed centroids: the ``lists`` rows first in MD5-of-key order (a
    deterministic sample; bounded by ``lists`` rows)."""
    rows = chunks.select(_row_hash_order(chunks, ckey).alias("_h"), cvec).orderBy("_h").limit(lists).collect()
    return [list(map(float, r[cvec])) for r in rows]


def kmeans_centroids(chunks: DataFrame, lists: int, cvec: str = "vector", seed: int = 7) -> list[list[float]]:
    """Trained centroids with pyspark.ml KMeans (distributed Lloyd iterations)."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    v = chunks.select(array_to_vector(cvec).alias("features"))
    model = KMeans(k=lists, seed=seed, maxIter=20).fit(v)
    return [list(map(float, c)) for c in model.clusterCenters()]


def _nearest_lists(df: DataFrame, centroids, vec: str, n: int, metric: str) -> DataFrame:
    """Per row, the ``n`` nearest centroids (ties to the lower id) as ``list_id``
    rows, by a numpy kernel over Arrow batches; the centroid matrix (``lists``
    x dim, a parameter-sized array) is broadcast."""
    spark = df.sparkSession
    bc = spark.sparkContext.broadcast(np.asarray(centroids, dtype=np.float64))
    out_schema = T.StructType(list(df.schema.fields) + [T.StructField("list_id", T.IntegerType(), True)])
    cols = df.columns

    def kernel(batches):
        K = bc.value
        for b in batches:
            if len(b) == 0:
                continue
            V = _matrix(b[vec])
            qi, ci, _ = topk_block(V, K, n, metric)
            o = b.iloc[qi].reset_index(drop=True)
            o["list_id"] = ci.astype("int32")
            yield o[cols + ["list_id"]]

    return df.mapInPandas(kernel, out_schema)


def assign_lists(df: DataFrame, centroids, vec: str, metric: str = "L2", out: str = "list_id") -> DataFrame:
    """List id = nearest centroid (0-based, ties to the lower id)."""
    r = _nearest_lists(df, centroids, vec, 1, metric)
    return r if out == "list_id" else r.withColumnRenamed("list_id", out)


def probe_lists(df: DataFrame, centroids, vec: str, nprobe: int, metric: str = "L2") -> DataFrame:
    """The ``nprobe`` nearest lists of each question (ties to the lower id)."""
    return _nearest_lists(df, centroids, vec, nprobe, metric)


def _salted_sides(q: DataFrame, c: DataFrame, gcol: str, opts: JobOptions, qkey, ckey):
    """Split both sides of each group (list / bucket) into salts of at most
    ``knn_block_bytes``; each side is replicated to the salts of the other."""
    rows = max(1, opts.knn_block_bytes // (8 * opts.embed_dim))
    salts = lambda side, name: side.groupBy(gcol).agg(F.ceil(F.count(F.lit(1)) / rows).cast("int").alias(name))
    both = salts(c, "_nc").join(salts(q, "_nq"), gcol)
    own = lambda key, n: F.pmod(F.xxhash64(*key), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    cs = c.join(both, gcol).withColumn("_cs", own(ckey, "_nc")).withColumn("_qs", every("_nq")).drop("_nc", "_nq")
    qs = q.join(both, gcol).withColumn("_qs", own(qkey, "_nq")).withColumn("_cs", every("_nc")).drop("_nc", "_nq")
    return qs, cs


def _salted_groups(q: DataFrame, c: DataFrame, gcol: str, opts: JobOptions, qkey, ckey):
    qs, cs = _salted_sides(q, c, gcol, opts, qkey, ckey)
    group = [gcol, "_cs", "_qs"]
    return qs.groupBy(*group).cogroup(cs.groupBy(*group))


def _with_found(hits: DataFrame, qkey) -> DataFrame:
    """``n_found``: the number of hits of the question; less than k is a shortfall
    of the approximate search (or of the corpus)."""
    return hits.withColumn("n_found", F.count(F.lit(1)).over(Window.partitionBy(*qkey)))


def build_ivf_index(chunks: DataFrame, centroids, opts: JobOptions, ckey=("filename", "chunk_no"), cvec: str = "vector") -> DataFrame:
    """The list index: chunk key, vector (``_cv``) and nearest-centroid ``list_id``;
    write it once next to the chunk table and pass (index, centroids) to knn_ivf."""
    m = normalise_metric(opts.metric)
    return assign_lists(chunks.select(*ckey, F.col(cvec).alias("_cv")), centroids, "_cv", m)


def knn_ivf(
    questions: DataFrame,
    chunks: DataFrame,
    k: int,
    opts: JobOptions,
    centroids=None,
    qkey=("request_id", "q_no"),
    ckey=("filename", "chunk_no"),
    qvec: str = "qvec",
    cvec: str = "vector",
    index=None,
) -> DataFrame:
    """L4: probe the ``nprobe`` nearest lists, re-score exactly, keep k.

    ``index``: a stored ``build_ivf_index`` result (with its centroids); without
    it the assignment is built here and materialised once (it feeds both the
    list sizes and the candidate groups). Without ``centroids`` the lists are
    trained by KMeans over all vectors."""
    qkey, ckey = list(qkey), list(ckey)
    m = normalise_metric(opts.metric)
    if index is not None:
        c, cents = index
    else:
        cents = centroids if centroids is not None else kmeans_centroids(chunks, opts.ivf_lists, cvec)
        c = build_ivf_index(chunks, cents, opts, ckey, cvec).checkpoint(eager=True)
    q = probe_lists(questions.select(*qkey, F.col(qvec).alias("_qv")), cents, "_qv", opts.ivf_nprobe, m)
    schema = _out_schema(qkey, ckey, q, c)
    partial = _salted_groups(q, c, "list_id", opts, qkey, ckey).applyInArrow(_one_cell(k, m, qkey, ckey), schema)
    return _with_found(_final_topk(partial, qkey, ckey, k), qkey)


# ------------------------------------------------------------------ LSH

#: bits of a band's signature at most; a bucket is band * 2^MAX_BITS + signature
MAX_BITS = 24


def hyperplanes(bands: int, bits: int, dim: int, seed: str = "lsh") -> list[list[list[float]]]:
    """Deterministic random hyperplanes: coordinate (b, j, d) from the MD5 of
    its position (a rule, not a stored table)."""
    def u(b, j, d):
        h = hashlib.md5(f"{seed}:{b}:{j}:{d}".encode()).hexdigest()
        return int(h[:8], 16) / 2**32 - 0.5

    return [[[u(b, j, d) for d in range(dim)] for j in range(bits)] for b in range(bands)]


def lsh_bits(rows: int, opts: JobOptions) -> int:
    """Bits per band, growing with the logarithm of the table, so that an average
    bucket keeps ``lsh_bucket_rows`` rows at every size."""
    return max(opts.lsh_bits, min(MAX_BITS, math.ceil(math.log2(max(1.0, rows / opts.lsh_bucket_rows)))))


def mean_vector(chunks: DataFrame, cvec: str = "vector") -> list[float]:
    """Mean of all vectors, rounded to 1e-6 (``dim`` numbers). A task sends one row a coordinate."""

    def sums(batches):
        total, n = np.zeros(0), np.zeros(0)
        for b in batches:
            lists = b.column(0).drop_null()
            x, start = lists.flatten(), lists.value_lengths().to_numpy()
            i = np.arange(len(x)) - np.repeat(np.cumsum(start) - start, start)
            there = x.is_valid().to_numpy(zero_copy_only=False)
            i, x = i[there], x.drop_null().to_numpy().astype(np.float64)
            size = max(len(n), int(i.max(initial=-1)) + 1)
            total, n = (np.pad(old, (0, size - len(old))) + np.bincount(i, w, size) for old, w in ((total, x), (n, None)))
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at]), pa.array(n[at].astype(np.int64))], names=["i", "x", "n"])

    parts = chunks.select(cvec).mapInArrow(sums, "i long, x double, n long").groupBy("i").agg(F.round(F.sum("x") / F.sum("n"), 6).alias("m"))
    return [r["m"] for r in parts.orderBy("i").collect()]


def _signatures(V: np.ndarray, P: np.ndarray, shift: np.ndarray, bands: int) -> np.ndarray:
    """The bucket of every band of every vector, (rows, bands)."""
    bits = len(P) // bands
    S = (_doubles(V) @ P.T >= shift[None, :]).reshape(len(V), bands, bits).astype(np.int64)
    return (S * (1 << np.arange(bits)).astype(np.int64)).sum(axis=2) + (np.arange(bands, dtype=np.int64) << MAX_BITS)[None, :]


def _planes(planes, centre) -> tuple[np.ndarray, np.ndarray]:
    """The hyperplanes as rows, and the centre's products with them."""
    H = np.asarray(planes, dtype=np.float64)
    H = H.reshape(H.shape[0] * H.shape[1], -1)
    return H, H @ np.asarray(centre, dtype=np.float64) if centre else np.zeros(len(H))


def band_keys(df: DataFrame, vec: str, planes, centre=None, out: str = "bucket") -> DataFrame:
    """One row per band: bucket = band * 2^MAX_BITS + signature bits of the band
    (signs of the dot products of the centred vector with the hyperplanes), by a
    numpy kernel; the hyperplanes (bands x bits x dim, parameter-sized) and the
    centre are broadcast."""
    bands = len(planes)
    bc = df.sparkSession.sparkContext.broadcast(_planes(planes, centre))
    out_schema = T.StructType(list(df.schema.fields) + [T.StructField(out, T.LongType(), True)])

    def kernel(batches):
        P, shift = bc.value
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):  # a row becomes one a band: few rows at a time
                b = batch.slice(at, STEP)
                keys = _signatures(_arrow_matrix(b.column(vec)), P, shift, bands)
                rows = pa.array(np.repeat(np.arange(len(keys)), bands))
                yield pa.RecordBatch.from_arrays([*(c.take(rows) for c in b.columns), pa.array(keys.reshape(-1))], names=out_schema.names)

    return df.mapInArrow(kernel, out_schema)


def _flip_chances(z: np.ndarray) -> np.ndarray:
    """Upper tail of the normal distribution at z >= 0 (half of erfc)."""
    return np.clip(0.5 * np.vectorize(math.erfc, otypes=[float])(z / math.sqrt(2)), 1e-12, 0.5)


def _likely_masks(p: np.ndarray, width: int):
    """The ``width`` most likely sets of flipped bits of each band as masks, with
    their chances, most likely first. ``p``: (rows, bands, bits) chances of each
    bit; dropping a set's prefixes that are not among the best loses none of them."""
    w = np.log((1 - p) / p)
    cost, mask = np.zeros((*p.shape[:2], 1)), np.zeros((*p.shape[:2], 1), dtype=np.int64)
    for j in range(p.shape[2]):
        cost = np.concatenate([cost, cost + w[:, :, j : j + 1]], axis=2)
        mask = np.concatenate([mask, mask | (1 << j)], axis=2)
        if cost.shape[2] > width:
            best = np.argpartition(cost, width - 1, axis=2)[:, :, :width]
            cost, mask = np.take_along_axis(cost, best, 2), np.take_along_axis(mask, best, 2)
    order = np.argsort(cost, axis=2, kind="stable")
    base = np.log1p(-p).sum(axis=2)[:, :, None]
    return np.take_along_axis(mask, order, 2), np.exp(base - np.take_along_axis(cost, order, 2))


def probe_keys(df: DataFrame, vec: str, planes, centre, opts: JobOptions, out: str = "bucket", first: int | None = None) -> DataFrame:
    """The buckets of each question, as one list, that a neighbour of centred cosine
    ``lsh_cosine`` shares with a chance of ``lsh_hit_rate``, most likely first:
    its own ones, and those across the hyperplanes that are nearest to it
    (multi-probe). Questions that need more than ``lsh_probes`` in a band get
    none. ``_far``: distance up to which all neighbours have that cosine.
    ``first``: that many of the likeliest buckets of each band instead, for every question."""
    spark = df.sparkSession
    H = np.asarray(planes, dtype=np.float64)
    bands, bits, dim = H.shape
    H = H.reshape(bands * bits, dim)
    H = H / np.sqrt((H * H).sum(axis=1, keepdims=True))
    bc = spark.sparkContext.broadcast((H, np.asarray(centre, dtype=np.float64)))
    out_schema = T.StructType(list(df.schema.fields) + [T.StructField(out, T.ArrayType(T.LongType()), True), T.StructField("_far", T.DoubleType(), True)])
    cols = df.columns
    weights = (1 << np.arange(bits)).astype(np.int64)
    cosine, goal, width = opts.lsh_cosine, math.log(1 - opts.lsh_hit_rate), min(first or opts.lsh_probes, 1 << bits)
    sine = math.sqrt(1 - cosine * cosine)

    def kernel(batches):
        P, mid = bc.value
        for batch in batches:
            for at in range(0, len(batch), 32):  # rows of a question are many: few questions at a time
                b = batch.iloc[at : at + 32]
                V = _matrix(b[vec]) - mid[None, :]
                norms = np.sqrt((V * V).sum(axis=1))
                S = V @ P.T
                # a neighbour's projection: cosine x the question's, and noise of sine / sqrt(dim)
                z = np.abs(S) / np.maximum(norms, 1e-300)[:, None] * (cosine / sine * math.sqrt(dim))
                masks, chance = _likely_masks(_flip_chances(z).reshape(len(b), bands, bits), width)
                own = ((S >= 0).reshape(len(b), bands, bits) * weights).sum(axis=2)
                keys = (own[:, :, None] ^ masks) + (np.arange(bands, dtype=np.int64) << MAX_BITS)[None, :, None]
                missed = np.log1p(-np.minimum(np.cumsum(chance, axis=2), 1 - 1e-12))
                gain = np.diff(missed, axis=2, prepend=0.0).reshape(len(b), -1)
                order = np.argsort(-chance.reshape(len(b), -1), axis=1, kind="stable")
                left = np.cumsum(np.take_along_axis(gain, order, 1), axis=1)
                n = np.full(len(b), order.shape[1]) if first else np.where(left[:, -1] <= goal, (left > goal).sum(axis=1) + 1, 0)
                some = np.flatnonzero(n)
                o = b.iloc[some].reset_index(drop=True)
                ranked = np.take_along_axis(keys.reshape(len(b), -1), order, 1)
                o[out] = pd.Series([ranked[i, : n[i]] for i in some], dtype=object)
                o["_far"] = (norms * sine)[some]
                yield o[cols + [out, "_far"]]

    return df.mapInPandas(kernel, out_schema)


def _probed(qs: pa.Table, cs: pa.Table, k: int, qkey, ckey, P: np.ndarray, shift: np.ndarray, bands: int) -> pa.Table:
    """Kernel of one cell: every question meets the chunks that share one of its
    buckets, once each; the k nearest (L2) within its ``_far``."""
    order = pc.sort_indices(cs.select(ckey), sort_keys=[(c, "ascending") for c in ckey], null_placement="at_start")
    cs = cs.take(order)
    V, Q = _arrow_matrix(cs["_cv"]), _doubles(_arrow_matrix(qs["_qv"]))
    qi, ci, far = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0)]
    if len(V) and len(Q):
        keys = np.concatenate([_signatures(V[x : x + STEP], P, shift, bands) for x in range(0, len(V), STEP)]).ravel()
        place = np.argsort(keys, kind="stable")
        keys, member = keys[place], place // bands
        lists, reach = qs["bucket"].combine_chunks(), qs["_far"].to_numpy()
        ends, probes = np.cumsum(lists.value_lengths().to_numpy()), lists.flatten().to_numpy()
        c2, q2 = np.einsum("ij,ij->i", V, V, dtype=np.float64), np.einsum("ij,ij->i", Q, Q)
        step = 2 * 10.0**-RANK_DIGITS
        for i, (x, y) in enumerate(zip(np.r_[0, ends[:-1]], ends)):
            lo, hi = np.searchsorted(keys, probes[x:y], "left"), np.searchsorted(keys, probes[x:y], "right")
            met = np.flatnonzero(hi > lo)
            if not len(met):
                continue
            c = np.sort(np.concatenate([member[lo[j] : hi[j]] for j in met]))
            c = c[np.r_[True, c[1:] != c[:-1]]]
            a = np.concatenate([_doubles(V[c[z : z + CHUNK_TILE]]) @ Q[i] for z in range(0, len(c), CHUNK_TILE)])
            a = c2[c] + q2[i] - 2.0 * a
            eps = 1e-12 * (q2[i] + c2.max())  # more than round-off
            c, a = (v[a <= (reach[i] + step) ** 2 + eps] for v in (c, a))
            if len(c) > k:
                c = c[a <= (np.sqrt(max(np.partition(a, k - 1)[k - 1] + eps, 0.0)) + step) ** 2 + eps]
            d = np.concatenate([_exact(np.broadcast_to(Q[i], (len(r), Q.shape[1])), _doubles(V[r]), "L2") for z in range(0, max(1, len(c)), CHUNK_TILE) for r in (c[z : z + CHUNK_TILE],)])
            c, d = c[d <= reach[i]], d[d <= reach[i]]
            near = np.lexsort((c, np.round(d, RANK_DIGITS)))[:k]
            qi.append(np.full(len(near), i))
            ci.append(c[near])
            far.append(d[near])
    qi, ci = pa.array(np.concatenate(qi)), pa.array(np.concatenate(ci))
    return pa.table({c: qs[c].take(qi) for c in qkey} | {c: cs[c].take(ci) for c in ckey} | {"distance": pa.array(np.concatenate(far))})


def _probe_hits(q: DataFrame, c: DataFrame, k: int, opts: JobOptions, qkey, ckey, planes, centre) -> DataFrame:
    """The k nearest chunks within ``_far`` among those that share a bucket, once each.
    Blocks of questions meet blocks of chunks; a chunk's buckets are told from its vector
    there, so that a vector is sent once to each block of questions and not once a band."""
    q = q.checkpoint(eager=True)
    single = {dict(q.dtypes)["_qv"], dict(c.dtypes)["_cv"]} == {"array<float>"}
    rows, asked = max(1, opts.knn_block_bytes // ((4 if single else 8) * opts.embed_dim)), q.count()
    cb = max(1, -(-c.count() // rows))
    qb = max(1, -(-asked // rows), min(-(-q.sparkSession.sparkContext.defaultParallelism // cb), asked // 256))
    cell = (F.col("_qb") * cb + F.col("_cb")).cast("int")
    own, every = lambda key, n: F.pmod(F.xxhash64(*key), F.lit(n)), lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    qs = q.withColumn("_qb", own(qkey, qb)).withColumn("_cb", every(cb))
    cs = c.withColumn("_cb", own(ckey, cb)).withColumn("_qb", every(qb))
    qs, cs = (side.withColumn("_cell", cell).drop("_qb", "_cb").repartitionById(qb * cb, F.col("_cell")) for side in (qs, cs))
    bands, bc = len(planes), q.sparkSession.sparkContext.broadcast(_planes(planes, centre))
    partial = qs.groupBy("_cell").cogroup(cs.groupBy("_cell")).applyInArrow(lambda a, b: _probed(a, b, k, qkey, ckey, *bc.value, bands), _out_schema(qkey, ckey, q, c))
    return partial.groupBy(*qkey, *ckey).agg(F.min("distance").alias("distance"))


def knn_lsh(
    questions: DataFrame,
    chunks: DataFrame,
    k: int,
    opts: JobOptions,
    qkey=("request_id", "q_no"),
    ckey=("filename", "chunk_no"),
    qvec: str = "qvec",
    cvec: str = "vector",
    bits: int | None = None,
) -> DataFrame:
    """Candidates share at least one band bucket; exact re-score, keep k.

    Counted vectors are all non-negative and point one way, so they are centred
    on their mean first; the number of bits follows the table's size (``bits``
    sets it). Each bit above the least number would lower the hit rate: from
    there on a question probes near buckets too (``probe_keys``), and if its k
    nearest candidates are not all so close that the hit rate holds for them,
    it is answered by ``knn_exact``. The bound on distances is one of L2; with
    other metrics all questions take the exact way."""
    qkey, ckey = list(qkey), list(ckey)
    m = normalise_metric(opts.metric)
    bits = lsh_bits(chunks.count(), opts) if bits is None else bits
    wide = bits > opts.lsh_bits
    if wide and m != "L2":
        return _with_found(knn_exact(questions, chunks, k, opts, qkey, ckey, qvec, cvec), qkey)
    planes = hyperplanes(opts.lsh_bands, bits, opts.embed_dim)
    centre = mean_vector(chunks, cvec)
    q = questions.select(*qkey, F.col(qvec).alias("_qv"))
    c = chunks.select(*ckey, F.col(cvec).alias("_cv"))
    if wide:
        # only hits within ``_far`` can settle a question; one that meets none in its
        # likeliest buckets takes the exact way without the other probes
        # the probes of a question cost far more time than bytes: dealt by number, not size
        parts = max(questions.sparkSession.sparkContext.defaultParallelism, -(-questions.count() // 2048))
        q = q.repartition(parts, *qkey)
        seen = _probe_hits(probe_keys(q, "_qv", planes, centre, opts, first=2), c, 1, opts, qkey, ckey, planes, centre)
        q = q.join(seen.select(*qkey).distinct().checkpoint(eager=True), qkey, "left_semi").repartition(parts, *qkey)
        hits = _final_topk(_probe_hits(probe_keys(q, "_qv", planes, centre, opts), c, k, opts, qkey, ckey, planes, centre), qkey, ckey, k).checkpoint(eager=True)
        near = hits.groupBy(*qkey).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= k).select(*qkey)
        rest = knn_exact(questions.join(near, qkey, "left_anti"), chunks, k, opts, qkey, ckey, qvec, cvec)
        return _with_found(hits.join(near, qkey, "left_semi").unionByName(rest.select(hits.columns)), qkey)
    c = band_keys(c, "_cv", planes, centre).checkpoint(eager=True)
    q = band_keys(q, "_qv", planes, centre)
    schema = _out_schema(qkey, ckey, q, c)
    partial = _salted_groups(q, c, "bucket", opts, qkey, ckey).applyInArrow(_one_cell(k, m, qkey, ckey), schema)
    dedup = partial.groupBy(*qkey, *ckey).agg(F.min("distance").alias("distance"))
    return _with_found(_final_topk(dedup, qkey, ckey, k), qkey)
