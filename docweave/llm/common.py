"""Helpers shared by the operators of this package."""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.session import ensure_checkpoint_dir, ship_package, table

#: words of letters, digits and everything beyond ASCII, on lower-cased UTF-8 bytes
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: words between ASCII white space, on lower-cased UTF-8 bytes
TOKEN = re.compile(rb"[^\x20\x09-\x0D]+")

#: Spark's setting for the bytes of an Arrow batch, and what is enough for the workers' functions
BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20


def prepare(spark: SparkSession) -> None:
    """Name the shared checkpoint folder to Spark, ship the package to the workers and
    keep the Arrow batches for them small: the executor's JVM holds one a task, its
    Python worker another."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    limit = spark.conf.get(BATCH_LIMIT).removesuffix("b")
    if not limit.isdigit() or int(limit) > BATCH_BYTES:
        spark.conf.set(BATCH_LIMIT, str(BATCH_BYTES))


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return table(spark, sf_dir, name)


def lower_ascii(text: str | None) -> bytes:
    """UTF-8 bytes with A-Z (and nothing else) lower-cased; null counts as empty."""
    return b"" if text is None else text.encode("utf-8", "replace").lower()


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


#: a join side is broadcast only while its measured size is below so many bytes
BROADCAST_BYTES = 64 << 20


def small(df: DataFrame, size: int) -> DataFrame:
    """Mark a side of measured ``size`` for broadcast if it is small enough; else
    Spark joins by shuffling."""
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x.astype(np.uint64)).astype(np.int64)


def local_components(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its component) of a small edge list, without the roots."""
    nodes, inv = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = inv[: len(a)], inv[len(a) :]
    label = np.arange(len(nodes))
    while True:
        old = label.copy()
        low = np.minimum(label[u], label[v])
        np.minimum.at(label, u, low)
        np.minimum.at(label, v, low)
        np.minimum.at(label, old[u], low)
        np.minimum.at(label, old[v], low)
        label = label[label]
        if np.array_equal(old, label):
            break
    child = label != np.arange(len(nodes))
    return nodes[child], nodes[label[child]]


def _stars(edges: DataFrame, larger: bool) -> DataFrame:
    """One star step: link every neighbour of ``u`` (the larger ones, or the
    smaller ones and ``u``) to the smallest node next to ``u``.

    ``min`` is combined before the shuffle, and the join back has one row per
    node on the small side, so a node with very many links is only a skewed
    join key, which adaptive execution splits.
    """
    if larger:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        out = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        moved = down.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        out = moved.unionByName(low.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """Connected components of ``edges(u, v)`` (longs): ``(node, root)``, root the
    smallest node of the component, for every node that has a link.

    Alternating large-star and small-star steps; each round ends in a reliable
    ``checkpoint()``, which cuts the lineage and survives lost executors. No
    link or label is collected; only a two-number digest per round is.
    """
    e = edges.select(F.col("u").cast("long"), F.col("v").cast("long")).where("u <> v").distinct().checkpoint()
    digest = None
    for _ in range(max_rounds):
        e = _stars(_stars(e, True), False).checkpoint()
        # two sums of independent hashes, kept in decimals so that they cannot overflow
        now = tuple(
            e.agg(
                F.count(F.lit(1)),
                F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
                F.sum(F.xxhash64("v", "u", F.lit(1)).cast("decimal(38,0)")),
            ).first()
        )
        if now == digest:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        digest = now
    raise RuntimeError("components did not converge")
