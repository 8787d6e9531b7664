"""The poll-with-stored-cursor refresh re-aimed as Structured Streaming.

Change files (filename, status, markdown, seq) arrive as Parquet files in a
folder. ``seq`` orders the changes of a file, in whatever files and micro-batches
they arrive: next to the chunk table stands a version table with the last applied
``seq`` of every file, tombstones of deleted files included, and a change older than that
is left out. Each micro-batch applies its changes to the stored chunk table with the
batch operator O4/O5 inside ``foreachBatch``, rewriting only the buckets the
batch touches in either table (the cursor is the stream checkpoint; a repeated
micro-batch gives the same tables).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docweave.operators.chunk import chunk_docs
from docweave.operators.tables import apply_changes_in_place, file_versions
from docweave.options import JobOptions
from docweave.session import scratch_path

CHANGE_SCHEMA = T.StructType(
    [
        T.StructField("filename", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("markdown", T.StringType()),
        T.StructField("seq", T.LongType()),
    ]
)


class ChunkTableState:
    """Path of a stored chunk table (bucket-partitioned, as K1 writes it)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self.versions_path = self.path + "-versions"

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.path).drop("bucket")

    def versions(self) -> DataFrame:
        """(filename, seq, deleted) of every file a change has been applied to."""
        return file_versions(self.spark, self.versions_path).drop("bucket")


def stream_refresh(
    spark: SparkSession,
    changes_dir: str,
    state: ChunkTableState,
    opts: JobOptions,
    checkpoint: str | None = None,
    embed=None,
    files_per_batch: int | None = None,
):
    """Apply every arriving change file to the chunk table (availableNow), at
    most ``files_per_batch`` of them in a micro-batch."""
    src = spark.readStream.schema(CHANGE_SCHEMA)
    if files_per_batch:
        src = src.option("maxFilesPerTrigger", files_per_batch)
    src = src.parquet(changes_dir)

    def apply_batch(batch: DataFrame, epoch: int) -> None:
        # only the buckets touched by this micro-batch are rewritten in place
        apply_changes_in_place(spark, state.path, batch, opts, embed, state.versions_path)

    q = (
        src.writeStream.foreachBatch(apply_batch)
        .option("checkpointLocation", checkpoint or scratch_path(spark, "stream-refresh-ckpt"))
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return state


def stream_chunks(spark: SparkSession, pages_dir: str, out_dir: str, opts: JobOptions, schema: T.StructType, key: str = "filename", text: str = "markdown", checkpoint: str | None = None):
    """Stateless chunking of arriving documents; each micro-batch runs T2
    and writes its chunks to its own partition of ``out_dir``, which a retried
    batch overwrites."""
    src = spark.readStream.schema(schema).parquet(pages_dir)

    def chunk_batch(batch: DataFrame, epoch: int) -> None:
        chunks = chunk_docs(batch, opts, key=key, text=text).withColumn("batch", F.lit(epoch))
        chunks.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(out_dir)

    q = (
        src.writeStream.foreachBatch(chunk_batch)
        .option("checkpointLocation", checkpoint or scratch_path(spark, "stream-chunks-ckpt"))
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return spark.read.parquet(out_dir).drop("batch")
