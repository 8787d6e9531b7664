"""Neighbour-graph index and beam search (L5 as a graph).

Build: distinct vectors are the nodes, so copies cannot fill a node's list with each
other. Random-hyperplane buckets, each cut into blocks of bounded size, give
first neighbours by exact search inside a block. Then rounds of local joins
refine them: the neighbours of a node, both ways, are compared with each other, as a neighbour's
neighbour is likely a neighbour; a pair is kept when it beats what either has. It ends when
a round improves few lists.

Search: all questions walk the graph together. A question's state is one
row, a beam of its nearest nodes so far; each round opens the best nodes not yet
opened, fetches their neighbours with two joins on the node number, and merges
them into the beam. The walk of a question ends when the whole beam is opened.
There is one plan for every size and no exact way behind it.

Work: a node moves (degree + reverse degree) vectors a round of the build, a question opens about
``beam`` nodes whatever the table's size; groups are hash buckets of some
hundred nodes or questions. Reverse lists keep the nearest, so a hub's
list is bounded; they only add ways to a node, every node keeps its own list.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docweave.functions.vectors import normalise_metric
from docweave.operators.knn import RANK_DIGITS, _arrow_matrix, _exact, _final_topk, _matrix, _with_found, band_keys, hyperplanes, lsh_bits, mean_vector
from docweave.options import JobOptions
from docweave.session import scratch_path, staged, unstage

#: nodes or questions handled by one kernel call, on average
GROUP = 256
#: pairs of questions and nodes in a cell of a round, on average
CELL_PAIRS = 4_000_000
#: rows of one block of the first search, and how many of them are compared with all at a time
BLOCK = 1024
SLICE = 256


class GraphIndex(NamedTuple):
    """Tables of an index; write them next to the chunk table to keep it."""

    nodes: DataFrame  # id, vec
    links: DataFrame  # id, near: own and reverse neighbours
    members: DataFrame  # id, chunk key


def _distances(Q: np.ndarray, C: np.ndarray, metric: str) -> np.ndarray:
    return _from_products(Q @ C.T, (Q * Q).sum(1)[:, None], (C * C).sum(1)[None, :], metric)


def _from_products(S: np.ndarray, q: np.ndarray, c: np.ndarray, metric: str) -> np.ndarray:
    """Distances from products and squared norms."""
    if metric == "IP":
        return -S
    if metric == "COSINE":
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.nan_to_num(1.0 - S / np.sqrt(q * c), nan=2.0)
    return np.sqrt(np.maximum(q + c - 2.0 * S, 0.0))


def _table(**cols: np.ndarray) -> pa.Table:
    return pa.table({c: pa.array(x) for c, x in cols.items()})


def _best(edges: DataFrame, degree: int, by: str = "u") -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(by).orderBy("d", "u", "v"))
    return edges.withColumn("_r", rank).where(F.col("_r") <= degree).drop("_r")


EDGES = "u long, v long, d double"


def _first_edges(nodes: DataFrame, n: int, degree: int, metric: str, opts: JobOptions) -> DataFrame:
    """Neighbours inside blocks of nodes that share a bucket of one of the bands."""
    planes = hyperplanes(opts.graph_bands, lsh_bits(n, opts), opts.embed_dim, "graph")
    keyed = band_keys(nodes, "vec", planes, mean_vector(nodes, "vec"))
    salts = keyed.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("salts"))
    dealt = keyed.join(salts, "bucket").withColumn("salt", F.pmod(F.xxhash64("id"), F.col("salts")))

    def kernel(block: pa.Table) -> pa.Table:
        ids, V = block["id"].to_numpy(), _arrow_matrix(block["vec"]).astype(np.float64)
        k = min(degree, len(ids) - 1)
        if k <= 0:
            return _table(u=ids[:0], v=ids[:0], d=np.empty(0))
        near, far = np.empty((len(ids), k), np.int64), np.empty((len(ids), k))
        for x in range(0, len(ids), SLICE):
            D = _distances(V[x : x + SLICE], V, metric)
            D[np.arange(len(D)), np.arange(x, x + len(D))] = np.inf
            near[x : x + SLICE] = np.argpartition(D, k - 1, axis=1)[:, :k]
            far[x : x + SLICE] = np.take_along_axis(D, near[x : x + SLICE], 1)
        return _table(u=np.repeat(ids, k), v=ids[near.ravel()], d=far.ravel())

    found = dealt.groupBy("bucket", "salt").applyInArrow(lambda block: kernel(block), EDGES)
    return _best(found.dropDuplicates(["u", "v"]), degree)


def _both_ways(edges: DataFrame, reverse: int) -> DataFrame:
    """(w, a): neighbours of w, and the nearest of those that have w as theirs."""
    back = _best(edges, reverse, "v").select(F.col("v").alias("w"), F.col("u").alias("a"))
    return edges.select(F.col("u").alias("w"), F.col("v").alias("a")).unionByName(back).distinct()


def _local_join(edges: DataFrame, nodes: DataFrame, groups: int, degree: int, reverse: int, metric: str) -> DataFrame:
    """Pairs of neighbours of one node that are nearer than the farthest neighbour of either."""
    lists = edges.groupBy("u").agg(F.collect_list("v").alias("have"), F.max("d").alias("worst"), F.count(F.lit(1)).alias("n"))
    known = nodes.join(lists, nodes["id"] == lists["u"], "left").select(
        F.col("id").alias("a"), "vec", "have", F.when(F.col("n") >= degree, F.col("worst")).otherwise(float("inf")).alias("worst")
    )
    sides = _both_ways(edges, reverse).join(known, "a").withColumn("g", F.pmod(F.xxhash64("w"), F.lit(groups)))

    def kernel(group: pa.Table) -> pa.Table:
        group = group.take(pa.array(np.argsort(group["w"].to_numpy(), kind="stable")))
        w, V, worst = group["w"].to_numpy(), _arrow_matrix(group["vec"]).astype(np.float64), group["worst"].to_numpy()
        # nodes by their place among the group's, a pair is one number
        names, first, code = np.unique(group["a"].to_numpy(), return_index=True, return_inverse=True)
        ends = np.flatnonzero(np.r_[w[1:] != w[:-1], True]) + 1
        pairs, far = [], []
        for x, y in zip(np.r_[0, ends[:-1]], ends):
            D = _distances(V[x:y], V[x:y], metric)
            np.fill_diagonal(D, np.inf)
            i, j = np.nonzero(D < worst[x:y, None])
            pairs.append(code[x + i] * len(names) + code[x + j])
            far.append(D[i, j])
        pairs, at = np.unique(np.concatenate(pairs), return_index=True)
        d = np.concatenate(far)[at]
        # what a node has already is no news
        have = group["have"].take(pa.array(first)).combine_chunks()
        own, to = np.repeat(np.arange(len(names)), pc.fill_null(pc.list_value_length(have), 0).to_numpy()), have.flatten().to_numpy()
        place = np.minimum(np.searchsorted(names, to), len(names) - 1)
        new = np.isin(pairs, (own * len(names) + place)[names[place] == to], assume_unique=True, invert=True)
        (u, v), d = np.divmod(pairs[new], len(names)), d[new]
        order = np.lexsort((v, d, u))
        u, v, d = u[order], v[order], d[order]
        keep = np.arange(len(u)) - np.searchsorted(u, u) < degree
        return _table(u=names[u[keep]], v=names[v[keep]], d=d[keep])

    return sides.groupBy("g").applyInArrow(lambda group: kernel(group), EDGES)


def build_graph(chunks: DataFrame, opts: JobOptions, ckey=("filename", "chunk_no"), cvec: str = "vector") -> GraphIndex:
    """The neighbour graph of a chunk table. Chunks without a vector are no nodes."""
    ckey, m, spark = list(ckey), normalise_metric(opts.metric), chunks.sparkSession
    degree, reverse = opts.graph_degree, opts.graph_degree
    vec = F.col(cvec)
    # a vector is told by 128 bits of hash; of a hot one each task sends a single row
    named = chunks.where(F.col(cvec).isNotNull()).select(*ckey, vec.alias("vec"), F.xxhash64(vec).alias("h1"), F.xxhash64(F.lit(1), vec).alias("h2"))
    nodes = named.groupBy("h1", "h2").agg(F.first("vec").alias("vec")).withColumn("id", F.monotonically_increasing_id()).checkpoint()
    members = named.drop("vec").join(nodes.drop("vec"), ["h1", "h2"]).select("id", *ckey).checkpoint()
    nodes = nodes.select("id", "vec")
    n = nodes.count()
    groups = max(1, -(-n // GROUP))
    edges, path = staged(_first_edges(nodes, n, degree, m, opts), "graph-edges")
    for _ in range(opts.graph_rounds):
        better, found = staged(_local_join(edges, nodes, groups, degree, reverse, m), "graph-better")
        if better.count() < opts.graph_least_gain * n * degree:
            unstage(spark, found)
            break
        both = edges.unionByName(better).dropDuplicates(["u", "v"])
        edges, now = staged(_best(both, degree), "graph-edges")
        unstage(spark, found)
        unstage(spark, path)
        path = now
    links = _both_ways(edges, reverse).groupBy(F.col("w").alias("id")).agg(F.collect_list("a").alias("near")).checkpoint()
    unstage(spark, path)
    return GraphIndex(nodes, links, members)


STATE = "q long, qv array<double>, ids array<long>, ds array<double>, opened array<boolean>, front array<long>"


def _front(ids: np.ndarray, opened: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The nearest nodes not yet opened, and the marks after they are."""
    at = np.flatnonzero(~opened)[:width]
    opened = opened.copy()
    opened[at] = True
    return ids[at], opened


def _entries(index: GraphIndex, n: int) -> tuple[np.ndarray, np.ndarray]:
    rows = index.nodes.orderBy(F.xxhash64("id"), "id").limit(n).collect()
    return np.array([r["id"] for r in rows], dtype=np.int64), np.array([r["vec"] for r in rows], dtype=np.float64)


def _start(questions: DataFrame, entries, beam: int, width: int, metric: str) -> DataFrame:
    ids, E = entries

    def kernel(frames):
        for f in frames:
            if not len(f):
                continue
            D = _distances(_matrix(f["qv"]), E, metric)
            out = []
            for q, qv, d in zip(f["q"], f["qv"], D):
                best = np.lexsort((ids, d))[:beam]
                front, opened = _front(ids[best], np.zeros(len(best), bool), width)
                out.append((q, qv, ids[best], d[best], opened, front))
            yield pd.DataFrame(out, columns=["q", "qv", "ids", "ds", "opened", "front"])

    return questions.mapInPandas(kernel, STATE)


def _met(front: DataFrame, state: DataFrame, index: GraphIndex, shape: tuple[int, int], beam: int, metric: str, kind: str, few: bool) -> DataFrame:
    """(q, id, d): the nearest nodes the fronts lead to. Pairs travel as two numbers; a
    vector is sent once to each cell of its row or column of cells, not with every pair.
    A cell is a task. With ``few`` pairs only the nodes they name are sent."""
    qb, nb = shape
    of = lambda key, n: F.pmod(F.xxhash64(key), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    pairs = front.join(index.links, "id").select("q", F.explode("near").alias("id"))
    named = index.nodes.join(pairs.select("id").distinct(), "id", "left_semi") if few else index.nodes
    pairs = pairs.select("q", "id", of("q", qb).alias("_q"), of("id", nb).alias("_n"))
    # a node beyond the last of a full beam does not get into it
    reach = F.when(F.size("ids") >= beam, F.element_at("ds", -1)).otherwise(float("inf"))
    asked = state.select(F.col("q").alias("key"), F.col("qv").cast(kind).alias("vec"), reach.alias("reach"), of("q", qb).alias("_q"), every(nb).alias("_n"))
    nodes = named.select(F.col("id").alias("key"), F.col("vec").cast(kind), F.lit(None).cast("double").alias("reach"), every(qb).alias("_q"), of("id", nb).alias("_n"))
    sides = (side.withColumn("_cell", F.col("_q") * nb + F.col("_n")).drop("_q", "_n").repartitionById(qb * nb, F.col("_cell")) for side in (pairs, asked.unionByName(nodes)))

    def kernel(pairs: pa.Table, vectors: pa.Table) -> pa.Table:
        if not len(pairs):
            return _table(q=np.empty(0, np.int64), id=np.empty(0, np.int64), d=np.empty(0))
        vectors = vectors.take(pc.sort_indices(vectors["key"]))
        is_q = np.asarray(vectors["reach"].is_valid())
        keys, V = vectors["key"].to_numpy(), _arrow_matrix(vectors["vec"])
        asked, named = keys[is_q], keys[~is_q]
        Q, C, reach = V[is_q].astype(np.float64), V[~is_q], vectors["reach"].to_numpy()[is_q]
        # a pair is one number: the places of its two keys
        both = np.sort(np.searchsorted(asked, pairs["q"].to_numpy()) * len(named) + np.searchsorted(named, pairs["id"].to_numpy()))
        qi, ni = np.divmod(both[np.r_[True, both[1:] != both[:-1]]], len(named))
        q2, c2 = np.einsum("ij,ij->i", Q, Q), np.einsum("ij,ij->i", C, C, dtype=np.float64)
        ends = np.flatnonzero(np.r_[qi[1:] != qi[:-1], True]) + 1
        at, far = [], []
        for x, y in zip(np.r_[0, ends[:-1]], ends):
            i, n = qi[x], ni[x:y]
            d = _from_products(C[n].astype(np.float64) @ Q[i], q2[i], c2[n], metric)
            last = min(reach[i], np.partition(d, beam - 1)[beam - 1]) if len(d) > beam else reach[i]
            near = np.flatnonzero(d <= last)
            at.append(x + near)
            far.append(d[near])
        at = np.concatenate(at)
        return _table(q=asked[qi[at]], id=named[ni[at]], d=np.concatenate(far))

    pairs, vectors = (side.groupBy("_cell") for side in sides)
    return pairs.cogroup(vectors).applyInArrow(lambda a, b: kernel(a, b), "q long, id long, d double")


def _step(state: DataFrame, index: GraphIndex, groups: int, shape: tuple[int, int], beam: int, width: int, metric: str, kind: str, few: bool = False) -> DataFrame:
    """Open the front of every question and merge what it leads to."""
    front = state.select("q", F.explode("front").alias("id"))
    found = _met(front, state, index, shape, beam, metric, kind, few)

    def kernel(states: pa.Table, found: pa.Table) -> pa.Table:
        if not len(states):
            return states.select(["q", "qv", "ids", "ds", "opened", "front"])
        states = states.take(pc.sort_indices(states["q"])).combine_chunks()
        asked, lists = states["q"].to_numpy(), {c: states[c].combine_chunks() for c in ("ids", "ds", "opened")}
        q = np.r_[np.repeat(np.arange(len(asked)), lists["ids"].value_lengths().to_numpy()), np.searchsorted(asked, found["q"].to_numpy())]
        ids, ds, opened = (lists[c].flatten().to_numpy(zero_copy_only=False) for c in ("ids", "ds", "opened"))
        late = np.r_[np.zeros(len(ids), bool), np.ones(len(found), bool)]
        ids, ds, opened = np.r_[ids, found["id"].to_numpy()], np.r_[ds, found["d"].to_numpy()], np.r_[opened, np.zeros(len(found), bool)]
        # a node that is in the beam stays as it is
        order = np.lexsort((late, ids, q))
        once = np.r_[True, (q[order][1:] != q[order][:-1]) | (ids[order][1:] != ids[order][:-1])]
        order = order[once]
        order = order[np.lexsort((ids[order], ds[order], q[order]))]
        order = order[np.arange(len(order)) - np.searchsorted(q[order], q[order]) < beam]
        q, ids, ds, opened = q[order], ids[order], ds[order], opened[order]
        # the nearest nodes not yet opened are the front, and count as opened from now on
        ahead = np.cumsum(~opened)
        starts = np.searchsorted(q, np.arange(len(asked)))
        fresh = ~opened & (ahead - np.r_[0, ahead][starts][q] <= width)
        listed = lambda x, q: pa.ListArray.from_arrays(np.searchsorted(q, np.arange(len(asked) + 1)).astype(np.int32), pa.array(x))
        return pa.table({"q": states["q"], "qv": states["qv"], "ids": listed(ids, q), "ds": listed(ds, q), "opened": listed(opened | fresh, q), "front": listed(ids[fresh], q[fresh])})

    group = F.pmod(F.xxhash64("q"), F.lit(groups)).alias("g")
    return state.groupBy(group).cogroup(found.groupBy(group)).applyInArrow(lambda a, b: kernel(a, b), STATE)


def _cells(asked: int, nodes: int, width: int, opts: JobOptions, cores: int) -> tuple[int, int]:
    """Blocks of questions and of nodes, so that a cell holds a bounded number of pairs and vectors."""
    rows = max(1, opts.knn_block_bytes // (8 * opts.embed_dim))
    nb = max(1, -(-nodes // rows))
    pairs = asked * width * 2 * opts.graph_degree // nb
    return max(1, -(-asked // rows), -(-pairs // CELL_PAIRS), min(-(-cores // nb), -(-asked // GROUP))), nb


def knn_graph(
    questions: DataFrame,
    chunks: DataFrame | None,
    k: int,
    opts: JobOptions,
    index: GraphIndex | None = None,
    qkey=("request_id", "q_no"),
    ckey=("filename", "chunk_no"),
    qvec: str = "qvec",
    cvec: str = "vector",
) -> DataFrame:
    """The k nearest chunks found by a walk over the neighbour graph, their
    distances exact; ``n_found`` per question. ``index``: a stored ``build_graph``
    result (else built here). The beam is at least k wide."""
    qkey, ckey, m = list(qkey), list(ckey), normalise_metric(opts.metric)
    index = index if index is not None else build_graph(chunks, opts, ckey, cvec)
    asked = questions.where(F.col(qvec).isNotNull()).select(*qkey, F.col(qvec).cast("array<double>").alias("qv"))
    asked = asked.withColumn("q", F.monotonically_increasing_id()).checkpoint()
    beam, width = max(opts.graph_beam, k), opts.graph_width
    n = asked.count()
    single = {dict(questions.dtypes)[qvec], dict(index.nodes.dtypes)["vec"]} == {"array<float>"}
    size, cores = index.nodes.count(), questions.sparkSession.sparkContext.defaultParallelism
    entries = _entries(index, opts.graph_entries)
    if not len(entries[0]):
        types = {**dict(index.members.dtypes), "distance": "double"}
        none = asked.where(F.lit(False)).select(*qkey, *[F.lit(None).cast(types[c]).alias(c) for c in (*ckey, "distance")])
        return _with_found(_final_topk(none, qkey, ckey, k), qkey)
    spark, base, round_ = questions.sparkSession, scratch_path(questions.sparkSession, "graph-walk"), 0
    kind = "array<float>" if single else "array<double>"
    state = _start(asked.select("q", "qv"), entries, beam, width, m)
    while True:
        # questions whose walk is over keep their nearest nodes only; the others' state goes once the next is written
        ended, at = F.size("front") == 0, f"{base}/round={round_}"
        kept = [F.when(ended, F.slice("ids", 1, k + opts.graph_spare)).otherwise(F.col("ids")).alias("ids"), *[F.when(~ended, F.col(c)).alias(c) for c in ("qv", "ds", "opened", "front")]]
        state.select("q", *kept, ended.alias("ended")).write.partitionBy("ended").parquet(at)
        if round_:
            unstage(spark, f"{base}/round={round_ - 1}/ended=false")
        state = spark.read.schema(f"{STATE}, ended boolean").parquet(at).where(~F.col("ended")).drop("ended")
        left = state.count()
        if not left:
            break
        shape = _cells(left, size, width, opts, cores)
        state = _step(state, index, max(1, -(-left // GROUP)), shape, beam, width, m, kind, left * width * 2 * opts.graph_degree < size)
        round_ += 1
    done = spark.read.schema(f"{STATE}, round int, ended boolean").parquet(base).where(F.col("ended")).select("q", "ids").join(asked.select("q", "qv"), "q")
    # every node stands for its chunks of the smallest keys; more than k of one node are never among the k nearest
    rank = F.row_number().over(Window.partitionBy("id").orderBy(*ckey))
    chosen = index.members.withColumn("_r", rank).where(F.col("_r") <= k).drop("_r")
    nearest = done.select("q", "qv", F.explode("ids").alias("id"))

    def exact(frames):
        for f in frames:
            if len(f):
                d = _exact(_matrix(f["qv"]), _matrix(f["vec"]), m)
                yield pd.DataFrame({"q": f["q"], "id": f["id"], "distance": np.where(np.isnan(d), 2.0, d)})

    scored = nearest.join(index.nodes, "id").mapInPandas(exact, "q long, id long, distance double")
    hits = scored.join(chosen, "id").join(asked.drop("qv"), "q").select(*qkey, *ckey, "distance")
    return _with_found(_final_topk(hits, qkey, ckey, k), qkey)


__all__ = ["GraphIndex", "build_graph", "knn_graph", "RANK_DIGITS"]
