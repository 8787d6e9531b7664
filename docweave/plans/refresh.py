"""Refresh control: tracking table (R1-R3, R5), the decision table (R4) and the
driver-side orchestration of DataFrame jobs (R6)."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.operators.tables import apply_changes_in_place, create_table, full_load, upsert_pk
from docweave.options import RELEASE_MODE, REPOSITORY_MODE, JobOptions
from docweave.session import stored

FULL_LOAD, SKIP, REBUILD, INCREMENTAL = "FULL_LOAD", "SKIP", "REBUILD", "INCREMENTAL"
TRACKING_FIELDS = (("product", "VARCHAR", 100, True), ("last_updated_ref", "VARCHAR", 100, False), ("last_updater_version", "VARCHAR", 100, False))
TRACKING_COLS = [f[0] for f in TRACKING_FIELDS]


def read_tracking(tracking: DataFrame, products: DataFrame) -> DataFrame:
    """Per product the last processed ref and updater version; no row -> NULLs."""
    return products.select("product").join(tracking.select(*TRACKING_COLS), "product", "left")


def write_tracking(tracking: DataFrame, updates: DataFrame) -> DataFrame:
    """R2: upsert (product, ref, updater version) keyed by product; of several
    updates of a product the one with the greatest ``seq`` is the last."""
    return upsert_pk(tracking.select(*TRACKING_COLS), updates, "product", order="seq" if "seq" in updates.columns else None)


def create_tracking(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create the tracking table if absent."""
    create_table(spark, name, TRACKING_FIELDS, location)


def has_version_column(tracking: DataFrame) -> bool:
    """False when the tracking table predates the updater-version column."""
    return "last_updater_version" in tracking.columns


def plan_refresh(
    latest: DataFrame,
    tracking: DataFrame,
    opts: JobOptions,
    collection_exists: bool = True,
    has_asset=True,
) -> DataFrame:
    """One action per product, first matching rule wins (see README).

    ``latest``: (product, ref); ``has_asset``: a bool or a boolean column name
    of ``latest`` (release mode: an asset with the configured prefix exists).
    """
    schema_ok = has_version_column(tracking)
    t = tracking.select("product", "last_updated_ref", (F.col("last_updater_version") if schema_ok else F.lit(None).cast("string")).alias("last_updater_version"))
    t = t.withColumn("_tracked", F.lit(True))
    j = latest.join(t, "product", "left")
    asset = F.col(has_asset) if isinstance(has_asset, str) else F.lit(bool(has_asset))
    tracked = F.col("_tracked").isNotNull()
    same_ref = tracked & (F.col("last_updated_ref") == F.col("ref"))
    ver_diff = ~F.col("last_updater_version").eqNullSafe(F.lit(opts.updater_version))
    if not collection_exists:
        release = F.when(asset, F.lit(FULL_LOAD)).otherwise(F.lit(SKIP))  # nothing to load without the asset
        repo = F.lit(FULL_LOAD)
    else:
        release = (
            F.when(~asset, F.lit(SKIP))
            .when(~tracked, F.lit(REBUILD))
            .when(same_ref, F.lit(SKIP))
            .when(F.lit(not schema_ok), F.lit(REBUILD))
            .when(ver_diff, F.lit(REBUILD))
            .otherwise(F.lit(INCREMENTAL))
        )
        repo = (
            F.when(~tracked, F.lit(FULL_LOAD))
            .when(same_ref, F.lit(SKIP))
            .when(ver_diff, F.lit(REBUILD))
            .otherwise(F.lit(INCREMENTAL))
        )
    action = release if opts.processing_mode == RELEASE_MODE else repo
    return j.select(
        "product",
        F.col("ref").alias("latest_ref"),
        "last_updated_ref",
        "last_updater_version",
        release.alias("release_action"),
        repo.alias("repo_action"),
        action.alias("action"),
    )


LOG_SCHEMA = ", ".join(f"{c} string" for c in TRACKING_COLS) + ", seq long"


def read_tracking_log(spark: SparkSession, path: str) -> DataFrame:
    """R1 on storage: the tracking table as the last entry of each product in a
    log of one small JSON file per entry."""
    try:
        log = spark.read.schema(LOG_SCHEMA).json(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        log = spark.createDataFrame([], LOG_SCHEMA)
    last = F.max_by(F.struct(*TRACKING_COLS[1:]), "seq").alias("r")
    # a writer that died inside its entry leaves a line that holds no product
    whole = log.where("product is not null and seq is not null")
    return whole.groupBy("product").agg(last, F.max("seq").alias("seq")).select("product", *[f"r.{c}" for c in TRACKING_COLS[1:]], "seq")


def commit_entry(spark: SparkSession, path: str, entry: dict) -> bool:
    """R2 on storage: the entry file of (product, seq), created only if there is none. False:
    another run has committed this ``seq`` first."""
    jvm = spark.sparkContext._jvm
    name = hashlib.sha256(entry["product"].encode()).hexdigest()[:16]
    file = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{name}-{entry['seq']:010d}.json")
    fs = file.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    try:
        out = fs.create(file, False)
    except Py4JJavaError as e:
        if "FileAlreadyExistsException" in e.java_exception.getClass().getName():
            return False
        raise
    try:
        out.write(bytearray(json.dumps(entry).encode() + b"\n"))
    finally:
        out.close()
    return True


def run_refresh(
    spark: SparkSession,
    product: str,
    latest_ref: str,
    tracking_path: str,
    table_path: str,
    full_chunks: Callable[[], DataFrame],
    changes_since: Callable[[str], DataFrame],
    opts: JobOptions,
    has_asset: bool = True,
    embed=None,
) -> str:
    """R1 -> R4 -> (K1 or O4/O5) -> R2 for one product, on storage. Returns the action.

    ``full_chunks()`` gives the whole chunk table, ``changes_since(ref)`` the
    change set since the last processed state. The chunk table at ``table_path``
    is written first, the tracking entry at ``tracking_path`` only after that
    has succeeded: a run that fails leaves the cursor where it was, and the next
    one repeats the (idempotent) action. (The reference advances it even when
    nothing loads.)

    The commit is optimistic: the entry takes the ``seq`` after the one the run has
    read, and only one run can create it. A run that comes second plans again from
    what the first has committed, and so finds nothing to do when both were after the same ref.
    """
    latest = spark.createDataFrame([(product, latest_ref)], "product string, ref string")
    after = 0  # numbers up to this one are taken
    while True:
        tracking = read_tracking_log(spark, tracking_path)
        before = tracking.where(F.col("product") == product).select("seq").first()
        seq = max(before["seq"] if before else 0, after) + 1
        plan = plan_refresh(latest, tracking, opts, collection_exists=stored(spark, table_path) is not None, has_asset=has_asset).first()
        action = plan["action"]
        if action == SKIP:
            return action
        if action == INCREMENTAL:
            apply_changes_in_place(spark, table_path, changes_since(plan["last_updated_ref"]), opts, embed)
        else:
            chunks = full_chunks()
            full_load(embed(chunks) if embed is not None else chunks, table_path, opts)
        if commit_entry(spark, tracking_path, dict(zip(TRACKING_COLS, (product, latest_ref, opts.updater_version)), seq=seq)):
            return action
        after = seq


__all__ = [
    "FULL_LOAD",
    "SKIP",
    "REBUILD",
    "INCREMENTAL",
    "RELEASE_MODE",
    "REPOSITORY_MODE",
    "read_tracking",
    "read_tracking_log",
    "commit_entry",
    "write_tracking",
    "create_tracking",
    "has_version_column",
    "plan_refresh",
    "run_refresh",
]
