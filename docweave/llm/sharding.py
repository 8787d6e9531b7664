"""Sharding by vector bin packing.

A group (equal texts) is a vector (bytes, tokens, rows). It goes to the shard
whose residual capacity has the largest dot product with it, each dimension in
shares of a shard's capacity. Packing runs in levels, so that no task holds
more than a bounded number of vectors:

1. groups are dealt by hash into blocks; each block packs its groups, largest
   first, into its own set of bins, one per shard;
2. the bins of up to ``fan_in`` blocks are packed in turn, and so on, until one
   set of bins is left: the shards.

A group larger than ``piece_share`` of a shard is split by row numbers into
pieces below that size; any other group stays whole.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import text_or_empty

DIMENSIONS = ("bytes", "tokens", "rows")


def pack_vectors(vectors: np.ndarray, bins: int) -> np.ndarray:
    """Bin of each row of ``vectors`` (n x 3): largest first, to the largest dot
    product with the residual; ties go to the bin with the lower number."""
    total = vectors.sum(axis=0)
    share = vectors / np.where(total > 0, total / bins, 1.0)  # in capacities of one bin
    order = np.lexsort((np.arange(len(share)), -share.max(axis=1)))
    residual = np.ones((bins, share.shape[1]))
    out = np.empty(len(share), np.int64)
    for i in order:
        b = int((residual @ share[i]).argmax())
        residual[b] -= share[i]
        out[i] = b
    return out


def _pack_block(shards: int):
    def pack(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values("unit", kind="stable")
        f["bin"] = pack_vectors(f[list(DIMENSIONS)].to_numpy(float), shards)
        return f[["block", "unit", "bin"]]

    return pack


def shard(
    docs: DataFrame, shards: int = 40, block_units: int = 20_000, fan_in: int = 64, piece_share: float = 1 / 64, cell_rows: int = 50_000
) -> DataFrame:
    """``(doc_id, size, text_crc32, shard, slot)`` for every row of ``docs(doc_id, text)``.

    Sizes of shards come out near equal in bytes, tokens and rows. Null texts
    count as empty (size 16, crc32 0); rows with null or repeated doc_ids are
    placed like any other; slots run from 0 without gaps in each shard. An
    empty table gives an empty result, extra columns are ignored.
    """
    text = text_or_empty()
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + F.lit(16)).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.regexp_count(text, F.lit(r"\S+")).cast("long").alias("tokens"),
        F.unhex(F.md5(text)).alias("text_md5"),
    ).checkpoint()  # the texts are read once; what follows moves a few numbers per row
    total = rows.agg(F.count(F.lit(1)), F.sum("size"), F.sum("tokens")).first()
    n = total[0]
    limit = [max(1.0, float(x or 0) * piece_share / shards) for x in (total[1], total[2], n)]
    groups = rows.groupBy("text_md5").agg(F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows"))
    pieces = F.greatest(*[F.ceil(F.col(d) / F.lit(x)) for d, x in zip(DIMENSIONS, limit)])
    # only groups of several rows can be split; there are at most 3 * shards / piece_share of them
    large = groups.where("rows > 1").withColumn("pieces", F.least(pieces, F.col("rows"))).where("pieces > 1").select("text_md5", "pieces")
    # row numbers of a checkpoint are fixed; doc_ids may repeat or be null all over a group
    rows = (
        rows.withColumn("row", F.monotonically_increasing_id())
        .join(F.broadcast(large), "text_md5", "left")
        .withColumn("piece", F.when(F.col("pieces").isNotNull(), F.pmod(F.xxhash64("row"), F.col("pieces"))).otherwise(F.lit(0)))
        .withColumn("unit", F.concat_ws("-", F.hex("text_md5"), "piece"))
    )
    blocks = max(1, -(-n // block_units))
    units = (
        rows.groupBy("unit")
        .agg(F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows"))
        .withColumn("block", F.pmod(F.xxhash64("unit"), F.lit(blocks)))
        .checkpoint()
    )
    kind = dict(units.dtypes)
    level = units.groupBy("block").applyInPandas(_pack_block(shards), f"block long, unit {kind['unit']}, bin long")
    placed = level.checkpoint()  # unit -> bin of its block
    bins = (
        placed.join(units, ["block", "unit"])
        .groupBy("block", "bin")
        .agg(*[F.sum(d).alias(d) for d in DIMENSIONS])
    )
    where = bins.select("block", "bin", F.col("block").alias("b"), F.col("bin").alias("shard"))
    while blocks > 1:
        merged = -(-blocks // fan_in)
        units_now = bins.select(
            F.floor(F.col("block") / F.lit(fan_in)).cast("long").alias("block"),
            F.concat_ws("-", F.format_string("%020d", "block"), F.format_string("%06d", "bin")).alias("unit"),
            F.col("block").alias("b"),
            F.col("bin").alias("shard"),
            *DIMENSIONS,
        ).checkpoint()
        step = units_now.groupBy("block").applyInPandas(_pack_block(shards), "block long, unit string, bin long")
        moved = units_now.join(step, ["block", "unit"]).select("b", "shard", F.col("block").alias("b2"), F.col("bin").alias("s2"), *DIMENSIONS).checkpoint()
        where = where.join(moved.select("b", "shard", "b2", "s2"), ["b", "shard"]).select("block", "bin", F.col("b2").alias("b"), F.col("s2").alias("shard"))
        bins = moved.groupBy(F.col("b2").alias("block"), F.col("s2").alias("bin")).agg(*[F.sum(d).alias(d) for d in DIMENSIONS])
        blocks = merged
    home = placed.join(where.select("block", "bin", "shard"), ["block", "bin"]).select("unit", "shard")
    assigned = rows.join(home, "unit").select("doc_id", "size", "text_crc32", F.col("shard").cast("int").alias("shard")).checkpoint()
    return with_slots(assigned, n, shards, cell_rows)


def with_slots(assigned: DataFrame, n: int, shards: int, cell_rows: int = 50_000) -> DataFrame:
    """Gapless numbers from 0 in each shard of a checkpointed frame: rows are numbered in hash cells of
    bounded size, cells by a running sum over one row per cell."""
    cells = max(1, -(-n // (cell_rows * shards)))
    # row numbers of a checkpoint are fixed, so both uses below see the same cells
    rows = assigned.withColumn("cell", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(cells)))
    sizes = rows.groupBy("shard", "cell").agg(F.count(F.lit(1)).alias("held"))
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("shard", "cell", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("shard", "cell").orderBy("doc_id", "text_crc32", "size")
    return (
        rows.withColumn("at", F.row_number().over(inside) - 1)
        .join(offsets, ["shard", "cell"])
        .select("doc_id", "size", "text_crc32", "shard", (F.col("offset") + F.col("at")).cast("long").alias("slot"))
    )
