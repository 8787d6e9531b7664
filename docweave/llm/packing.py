"""Best-fit packing of documents into training sequences, with conflicts.

A sequence (bin) of ``capacity`` tokens never holds two documents of one source
or of one duplicate cluster. Bins are kept in order of their residual space,
each with a bitmap of its sources and one of its clusters. A piece goes to the
tightest bin that it fits and that has neither of its bits set: the search
starts at the smallest sufficient residual and continues to its successors.

Documents are dealt by hash into blocks of bounded size that are packed
independently (best fit decreasing), so a source or cluster of any size is
spread evenly over the tasks; only numbers travel, no text. A document longer
than the capacity is cut: whole sequences of its own, and a rest that is packed.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty

CAPACITY = 2048


def best_fit(pieces: list[tuple[int, int, int]], capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) of each piece (size, source bit, cluster bit), given largest first.

    A bit is a power of two; 0 conflicts with nothing.
    """
    order: list[tuple[int, int]] = []  # (residual, bin), sorted
    sources: list[int] = []
    clusters: list[int] = []
    out: list[tuple[int, int]] = []
    for size, source, cluster in pieces:
        for k in range(bisect_left(order, (size, -1)), len(order)):
            residual, b = order[k]
            if not (sources[b] & source or clusters[b] & cluster):
                del order[k]
                break
        else:
            residual, b = capacity, len(sources)
            sources.append(0)
            clusters.append(0)
        sources[b] |= source
        clusters[b] |= cluster
        if residual > size:
            insort(order, (residual - size, b))
        out.append((b, capacity - residual))
    return out


def _pack_block(capacity: int):
    def pack(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values(["n_tokens", "doc_id", "cluster", "start"], ascending=[False, True, True, True], kind="stable", na_position="first")
        source_bit: dict = {}
        cluster_bit: dict = {}
        pieces = [
            (
                n,
                0 if s is None else 1 << source_bit.setdefault(s, len(source_bit)),
                0 if c is None else 1 << cluster_bit.setdefault(c, len(cluster_bit)),
            )
            for n, s, c in zip(f["n_tokens"].tolist(), f["source"].tolist(), f["cluster"].tolist())
        ]
        placed = best_fit(pieces, capacity)
        f["bin"] = [b for b, _ in placed]
        f["offset"] = [x for _, x in placed]
        return f[["doc_id", "source", "cluster", "piece", "start", "n_tokens", "block", "bin", "offset"]]

    return pack


def clusters_of_equal_texts(text="text"):
    """Default duplicate cluster: texts that are equal but for case and white space."""
    return F.md5(F.regexp_replace(F.lower(F.trim(text_or_empty(text))), r"\s+", " "))


def pack(docs: DataFrame, capacity: int = CAPACITY, block_docs: int = 4096, cluster=None) -> DataFrame:
    """One row per piece of ``docs(doc_id, text, source, ...)``: ``(doc_id, source,
    cluster, piece, start, n_tokens, block, bin, offset)``.

    Tokens are runs of non-space characters; ``start`` is the piece's first
    token in its document, ``offset`` its place in the sequence ``(block, bin)``;
    sequences filled by one long document have negative blocks.
    Null, empty and blank texts have no tokens and take one piece of size 0,
    placed by the same rules. A null source conflicts with nothing. Repeated
    rows are pieces of one cluster and never share a sequence. An empty table
    gives an empty result; extra columns are ignored. ``cluster`` may name
    another column (an expression) for the duplicate cluster.
    """
    tokens = F.regexp_count(text_or_empty(), F.lit(r"\S+")).cast("long")
    source = F.col("source").cast("string") if "source" in docs.columns else F.lit(None).cast("string")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        source.alias("source"),
        (clusters_of_equal_texts() if cluster is None else cluster).cast("string").alias("cluster"),
        tokens.alias("tokens"),
    ).checkpoint()  # the texts are read once
    rows = rows.withColumn("row", F.monotonically_increasing_id())  # fixed: the checkpoint's partitions are
    n = rows.count()
    blocks = max(1, -(-n // block_docs))
    last = F.greatest(F.lit(0), F.ceil(F.col("tokens") / F.lit(capacity)) - 1).cast("long")
    full = rows.where(F.col("tokens") > capacity).withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), last - 1)))
    rest = rows.withColumn("piece", last)
    spread = F.pmod(F.xxhash64("row"), F.lit(blocks))  # repeated rows are spread like any others
    whole = full.select(
        "doc_id", "source", "cluster", "piece", (F.col("piece") * capacity).alias("start"), F.lit(capacity).cast("long").alias("n_tokens"),
        (-1 - F.col("row")).alias("block"), F.col("piece").alias("bin"), F.lit(0).cast("long").alias("offset"),
    )
    rest = rest.select(
        "doc_id", "source", "cluster", "piece", (F.col("piece") * capacity).alias("start"),
        (F.col("tokens") - F.col("piece") * capacity).alias("n_tokens"), spread.alias("block"),
    )
    schema = "doc_id long, source string, cluster string, piece long, start long, n_tokens long, block long, bin long, offset long"
    packed = rest.groupBy("block").applyInPandas(_pack_block(capacity), schema)
    return packed.unionByName(whole)


def sequences(packed: DataFrame, docs: DataFrame) -> DataFrame:
    """Texts of the sequences: ``(block, bin, n_tokens, doc_ids, text)``, pieces
    joined by a blank line in order of their offset. One sequence is at most
    ``capacity`` tokens, so a group is bounded."""
    words = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.regexp_extract_all(text_or_empty(), F.lit(r"\S+"), 0).alias("words"))
    one = words.dropDuplicates(["doc_id"])
    cut = packed.join(one, "doc_id").withColumn(
        "text", F.array_join(F.slice("words", (F.col("start") + 1).cast("int"), F.greatest(F.col("n_tokens"), F.lit(0)).cast("int")), " ")
    )
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "text")))
    return cut.groupBy("block", "bin").agg(F.sum("n_tokens").alias("n_tokens"), parts.alias("p")).select(
        "block", "bin", "n_tokens", F.col("p.doc_id").alias("doc_ids"), F.array_join(F.col("p.text"), "\n\n").alias("text")
    )
