"""The corpus pipeline: five stages over ``documents``, each one an operator of
``docweave.llm``; every stage is written as Parquet and read again by the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docweave.llm import decontaminate, language, lines, packing, simhash
from docweave.llm.common import prepare, read
from docweave.session import scratch_path


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in no known language go; the model is learned from all labelled ones."""
    prepare(spark)
    return language.accepted(docs, language.train(docs))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of lines are taken out; a document left without words goes."""
    prepare(spark)
    return lines.dedup_lines(docs)


def dedup_simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    prepare(spark)
    return simhash.keep_one(docs, shingle=3)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of the documents' pieces in training sequences."""
    prepare(spark)
    return packing.pack(docs)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", dedup_simhash),
    ("benchmark_decontamination", decontaminate_benchmark),
    ("best_fit_packing", pack_sequences),
]

#: no stage but the decontamination can be said in SQL; the tests hold run() against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; what each returns is written to the
    shared checkpoint folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        out = stage(spark, docs, sf_dir)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
