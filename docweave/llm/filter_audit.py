"""Filter interaction audit by incremental retraction streaming.

Documents arrive file by file, in available-now micro-batches. Four filters look at
a text alone, the fifth (``E``) at the whole table: a document fails it when a
smaller doc_id has the same text. Which one is the smallest is known only after
the last file, so the state holds, for every text seen, its smallest doc_id so far
with the counts that stand for it. A later document of a larger id is
counted as failing E at once; one of a smaller id becomes the smallest, and the
counts of the earlier holder are retracted and counted again with E. What leaves the
stream is a log of signed counts per (part, mask); their sum is the
result, in whatever order the files came.

Plan of a micro-batch: the texts are read once and leave the first kernel as 16 bytes of
digest and 5 bits; labels are joined to these narrow rows. Before the shuffle by
text, each task settles what it can: of the rows of one text it sends on those of
its smallest doc_id, all others surely fail E. So a text that a third of all
rows share is a few rows per task. State keys are hash buckets of some
hundred texts each, as calls into Python cost more than the texts; a bucket's
state is one packed table. The log goes to a Parquet sink, which writes every
micro-batch exactly once; state and log live in the shared checkpoint folder, so
a lost executor or a restarted query goes on from the last committed batch. The session
chooses the state store; beyond some hundred million texts it should be Spark's RocksDB provider.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from docweave.session import scratch_path

from .common import prepare, small

FILTERS = "ABCDE"
DUPLICATE = 1 << FILTERS.index("E")
_UPPER, _OTHER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"#$%&*|"
#: texts per state key, on average
PER_BUCKET = 512
GOOD, TOXIC = 1, 2
#: what counts stand for
KIND = ["part", "mask", "flags"]
LOG = "part string, mask int, n long, good long, toxic long"
HELD = "digest binary, doc_id long, part string, mask int, flags int, n long"
#: bytes that a labelled doc_id takes in a broadcast
LABEL_BYTES = 130


def text_mask(text: str | None) -> int:
    """Bits of the filters A to D that a whole text fails (null counts as empty)."""
    text = text or ""
    data = text.encode("utf-8", "replace")
    words = data.split()  # at runs of the six ASCII white space characters
    upper = len(data) - len(data.translate(None, _UPPER))
    fails = (len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * upper > 3 * len(text), len(data.translate(None, _OTHER)) < len(data))
    return sum(1 << i for i, f in enumerate(fails) if f)


def _masks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts to digests and masks. ``spread`` numbers the rows of a batch, to deal those without a doc_id."""
    for b in batches:
        digests, masks = [], []
        for t in b.column("text"):
            t = t.as_py()
            digests.append(hashlib.blake2b((t or "").encode("utf-8", "replace"), digest_size=16).digest())
            masks.append(text_mask(t))
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), b.column("part"), pa.array(digests, pa.binary()), pa.array(masks, pa.int32()), pa.array(range(b.num_rows), pa.int32())],
            ["doc_id", "part", "digest", "mask", "spread"],
        )


def _settle(frame: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
    """Split ``HELD`` rows into those of the smallest doc_id of each text, added up,
    and the rest, which fails E."""
    least = frame["doc_id"] == frame.groupby("digest")["doc_id"].transform("min")
    held = frame[least].groupby(["digest", "doc_id", *KIND], as_index=False, sort=False)["n"].sum()
    return held, frame[~least]


def _failing(frame: pd.DataFrame) -> pd.DataFrame:
    return frame[[*KIND, "n"]].assign(mask=frame["mask"] | DUPLICATE)


def _added(frames: list[pd.DataFrame]) -> pd.DataFrame:
    both = pd.concat([f[[*KIND, "n"]] for f in frames], ignore_index=True)
    both = both.groupby(KIND, as_index=False, sort=False)["n"].sum()
    return both[both["n"] != 0]


def _combined(buckets: int):
    """Kernel before the shuffle: what a task can settle by itself. Rows without a
    digest are settled counts; their bucket only spreads them."""

    def kernel(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            f = f.assign(n=np.int64(1))
            named = f["doc_id"].notna()
            known = f[named].assign(doc_id=f.loc[named, "doc_id"].astype("int64"))
            held, rest = _settle(known)
            # a row without a doc_id has no smaller one
            sure = _added([_failing(rest), f[~named]])
            held["bucket"] = [int.from_bytes(d[:8], "little") % buckets for d in held["digest"]]
            sure = sure.assign(bucket=[hash((int(m), int(x))) % buckets for m, x in zip(sure["mask"], sure["flags"])], digest=None, doc_id=None)
            yield pd.concat([p[["bucket", "digest", "doc_id", *KIND, "n"]].astype({"doc_id": "Int64"}) for p in (held, sure)], ignore_index=True)

    return kernel


def merge(state: pd.DataFrame | None, rows: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
    """New state of a bucket and the signed counts that ``rows`` bring.

    ``state`` and ``rows`` have the columns of ``HELD``. New counts enter with the mask they
    have now; those of a former smallest doc_id are retracted and enter again with E.
    """
    if state is None or not len(state):
        held, rest = _settle(rows)
        return held, _added([held, _failing(rest)])
    held, rest = _settle(pd.concat([state, rows], ignore_index=True))
    before = state.assign(n=-state["n"])
    # what stays the smallest cancels out
    return held, _added([before, held, _failing(rest)])


def _log_rows(counts: pd.DataFrame) -> pd.DataFrame:
    n = counts["n"].astype("int64")
    flags = counts["flags"].astype("int64")
    return pd.DataFrame({"part": counts["part"], "mask": counts["mask"].astype("int32"), "n": n, "good": n * ((flags & GOOD) > 0), "toxic": n * ((flags & TOXIC) > 0)})


_PACKED = pa.schema([("digest", pa.binary()), ("doc_id", pa.int64()), ("part", pa.string()), ("mask", pa.int32()), ("flags", pa.int32()), ("n", pa.int64())])


def _pack(held: pd.DataFrame) -> bytes:
    table = pa.Table.from_pandas(held, schema=_PACKED, preserve_index=False)
    with pa.BufferOutputStream() as sink:
        with pa.ipc.new_stream(sink, _PACKED) as out:
            out.write_table(table)
        return sink.getvalue().to_pybytes()


def _retract(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    rows = pd.concat(list(frames), ignore_index=True)
    settled = rows["digest"].isna()
    new = rows[~settled].astype({"doc_id": "int64"})
    changes = [rows[settled]]
    if len(new):
        (packed,) = state.get if state.exists else (None,)
        held, counts = merge(pa.ipc.open_stream(packed).read_pandas() if packed else None, new)
        state.update((_pack(held),))
        changes.append(counts)
    yield _log_rows(_added(changes))


def label_flags(labels: DataFrame) -> DataFrame:
    """``(id, flags)`` per labelled doc_id: quality 1 and toxic 1 in any of its rows."""
    has = lambda c: F.max((F.col(c) == 1).cast("int"))
    flags = F.coalesce(has("quality"), F.lit(0)) * GOOD + F.coalesce(has("toxic"), F.lit(0)) * TOXIC
    return labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("id")).agg(flags.cast("int").alias("flags"))


def retractions(documents: DataFrame, labels: DataFrame, buckets: int) -> DataFrame:
    """The stream of signed counts for a stream of documents."""
    part = F.coalesce(F.col("lang").cast("string"), F.lit(""))
    narrow = documents.select(F.col("doc_id").cast("long").alias("doc_id"), part.alias("part"), F.col("text").cast("string").alias("text"))
    masked = narrow.mapInArrow(_masks, "doc_id long, part string, digest binary, mask int, spread int")
    flagged = masked.join(labels, (F.col("doc_id") == F.col("id")) & (F.when(F.col("doc_id").isNull(), F.col("spread")).otherwise(0) == F.col("zero")), "left")
    rows = flagged.select("doc_id", "part", "digest", "mask", F.coalesce("flags", F.lit(0)).alias("flags"))
    combined = rows.mapInPandas(_combined(buckets), f"bucket long, {HELD}")
    return combined.groupBy("bucket").applyInPandasWithState(_retract, LOG, "packed binary", "append", GroupStateTimeout.NoTimeout)


def counters(spark: SparkSession, path: str, labels: DataFrame, batches: int = 8) -> DataFrame:
    """``(part, mask, n, good, toxic)``: documents of the Parquet table at ``path`` per
    part and set of failed filters, by streaming all its files in about ``batches`` micro-batches."""
    prepare(spark)
    table = spark.read.parquet(path)
    files, rows = len(table.inputFiles()), table.count()
    flags = scratch_path(spark, "audit-labels")
    label_flags(labels).withColumn("zero", F.lit(0)).write.parquet(flags)
    known = spark.read.schema("id long, flags int, zero int").parquet(flags)
    known = small(known, LABEL_BYTES * known.count())
    # the name with a pattern, as a stream takes a plain path for a folder, and the table may be one file
    stream = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", max(1, -(-files // batches))).parquet(f"{path[:-1]}[{path[-1]}]")
    log = retractions(stream, known, max(1, -(-rows // PER_BUCKET)))
    to, at = scratch_path(spark, "audit-log"), scratch_path(spark, "audit-stream")
    query = log.writeStream.format("parquet").option("path", to).option("checkpointLocation", at).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    changes = spark.read.schema(LOG).parquet(to)
    sums = changes.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])
    return sums.where("n <> 0")


def _steps() -> Column:
    """The 120 orders of the filters with their 5 steps each, as one constant array."""
    bit = {x: 1 << i for i, x in enumerate(FILTERS)}
    steps = [
        {"filter_order": "".join(order), "step": i + 1, "own": bit[own], "earlier": sum(bit[x] for x in order[:i])}
        for order in permutations(FILTERS)
        for i, own in enumerate(order)
    ]
    return F.from_json(F.lit(json.dumps(steps)), "array<struct<filter_order:string,step:int,own:int,earlier:int>>")


def interactions(counts: DataFrame) -> DataFrame:
    """Per part, order of the five filters and step: what the step's filter removes,
    what it would have removed, and what only it removes, from ``counters``.

    A document that fails f filters is removed by each of them in 120 / f of the 120 orders."""
    masks = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))  # 32 at most
    steps = masks.select("part", "masks", F.explode(_steps()).alias("s")).select("part", "masks", "s.*")
    own = lambda m: m["mask"].bitwiseAND(F.col("own")) != 0
    earlier = lambda m: m["mask"].bitwiseAND(F.col("earlier")) != 0

    def total(name: str, which: Callable[[Column], Column], what: Callable[[Column], Column] = lambda m: m["n"]) -> Column:
        return F.aggregate(F.filter("masks", which), F.lit(0).cast("long"), lambda s, m: s + what(m)).alias(name)

    removed = lambda m: own(m) & ~earlier(m)
    return steps.select(
        "part",
        "filter_order",
        "step",
        total("kept", lambda m: ~own(m) & ~earlier(m)),
        total("removed", removed),
        total("redundant", lambda m: own(m) & earlier(m)),
        total("unique_fails", lambda m: m["mask"] == F.col("own")),
        total("good_lost", removed, lambda m: m["good"]),
        total("toxic_lost", removed, lambda m: m["toxic"]),
        total("shapley", own, lambda m: m["n"] * F.floor(F.lit(120) / F.bit_count(m["mask"]))),
    )


def audit(spark: SparkSession, path: str, labels: DataFrame, batches: int = 8) -> DataFrame:
    """The interactions of all orders of the filters over the Parquet table ``documents``
    (doc_id, text, lang) at ``path``, with ``labels(doc_id, quality, toxic)``.

    Null texts are empty ones and equal to these; a null lang is the part ''. A
    row with a null doc_id has no smaller doc_id, and is no smaller one itself; rows
    that share a doc_id (repeated ones too) are documents of their own, none
    smaller than the other. Several labels of one doc_id count
    together. An empty table gives an empty result; extra columns are ignored.
    """
    return interactions(counters(spark, path, labels, batches))
