"""J1-J5 snapshot / commit diffs and A1-A2 change summaries.

Only (rel_path, sha256) pairs go through the full outer join; page bodies
are fetched afterwards for changed paths only, with a semi join that AQE
turns into a broadcast when the change set is small at run time.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.functions.text import format_file_path
from docweave.options import JobOptions
from docweave.plans.pipelines import drop_ignored_paths, release_markdown
from docweave.session import scratch_path
from docweave.sources.scan import ignore_paths_predicate

ADDED, MODIFIED, DELETED, UNCHANGED = "added", "modified", "deleted", "unchanged"


def _hashes(snap: DataFrame, opts: JobOptions, name: str) -> DataFrame:
    s = drop_ignored_paths(snap, opts)
    if "sha256" not in s.columns:
        # a page without content is an empty one; without a hash it would count as missing
        s = s.withColumn("sha256", F.sha2(F.coalesce(F.col("html"), F.lit("")), 256))
    return s.select("rel_path", F.col("sha256").alias(name))


def snapshot_diff(old: DataFrame, new: DataFrame, opts: JobOptions) -> DataFrame:
    """(rel_path, filename, status) for every path of either snapshot; the hash
    covers the whole file, so a change outside the article counts as modified."""
    return _with_status(_hashes(old, opts, "o_sha").join(_hashes(new, opts, "n_sha"), "rel_path", "full_outer"))


def _with_status(j: DataFrame) -> DataFrame:
    status = (
        F.when(F.col("o_sha").isNull(), F.lit(ADDED))
        .when(F.col("n_sha").isNull(), F.lit(DELETED))
        .when(F.col("o_sha") != F.col("n_sha"), F.lit(MODIFIED))
        .otherwise(F.lit(UNCHANGED))
    )
    return j.select("rel_path", format_file_path(F.col("rel_path")).alias("filename"), status.alias("status"))


# ------------------------------------------------------------------ J1 over stored digests

PATHS = "rel_path string, sha256 string, leaf int, part int"
LEAVES = "part int, leaf int, n long, digest string"


class SnapshotDigests(NamedTuple):
    """A snapshot's content hashes as a two-level digest tree: paths by part and
    leaf (hash ranges of the path), a digest per leaf, and a digest per part."""

    spark: SparkSession
    path: str

    def paths(self) -> DataFrame:
        return self.spark.read.schema(PATHS).parquet(f"{self.path}/paths")

    def leaves(self) -> DataFrame:
        return self.spark.read.schema(LEAVES).parquet(f"{self.path}/leaves")

    def parts(self) -> DataFrame:
        return _digest(self.leaves(), "part", F.struct("leaf", "digest"))


def _digest(rows: DataFrame, *key: str | Column) -> DataFrame:
    """Digest of each group: a hash over its sorted entries (the last argument)."""
    *by, entry = key
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.sha2(F.to_json(F.sort_array(F.collect_list(entry))), 256).alias("digest"))


def write_digests(snap: DataFrame, path: str, opts: JobOptions) -> SnapshotDigests:
    """Store the digest tree of a snapshot (rel_path, html or sha256); it is written once
    with the snapshot. ``digest_parts`` and ``digest_leaves`` must be the same for trees that are
    compared; a leaf of a billion paths holds about a thousand."""
    spark = snap.sparkSession
    spread = F.xxhash64("rel_path")
    part, leaf = F.pmod(spread, F.lit(opts.digest_parts)), F.pmod(F.shiftright(spread, 20), F.lit(opts.digest_leaves))
    rows = _hashes(snap, opts, "sha256").select("rel_path", "sha256", leaf.cast("int").alias("leaf"), part.cast("int").alias("part"))
    rows.repartition("part").sortWithinPartitions("part", "leaf").write.partitionBy("part").parquet(f"{path}/paths")
    stored = SnapshotDigests(spark, path)
    _digest(stored.paths(), "part", "leaf", F.struct("rel_path", "sha256")).select("part", "leaf", "n", "digest").write.parquet(f"{path}/leaves")
    return stored


def _differing(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    a = old.select(*key, F.col("digest").alias("_a"))
    b = new.select(*key, F.col("digest").alias("_b"))
    return a.join(b, key, "full_outer").where(~F.col("_a").eqNullSafe(F.col("_b"))).select(*key)


def changed_paths(old: SnapshotDigests, new: SnapshotDigests) -> DataFrame:
    """J1 without the unchanged paths, from the digest trees of two snapshots:
    (rel_path, filename, status). Only parts whose digest differs are read, and
    only the paths of differing leaves reach the outer join."""
    parts = [r["part"] for r in _differing(old.parts(), new.parts(), ["part"]).collect()]  # digest_parts at most
    in_parts = F.col("part").isin(parts) if parts else F.lit(False)
    leaves = _differing(old.leaves().where(in_parts), new.leaves().where(in_parts), ["part", "leaf"])

    def side(tree: SnapshotDigests, name: str) -> DataFrame:
        rows = tree.paths().where(in_parts).join(leaves, ["part", "leaf"], "left_semi")
        return rows.select("rel_path", F.col("sha256").alias(name))

    j = side(old, "o_sha").join(side(new, "n_sha"), "rel_path", "full_outer")
    return _with_status(j).where(F.col("status") != UNCHANGED)


def _changed_markdown(new: DataFrame, diff: DataFrame, status: str, opts: JobOptions) -> DataFrame:
    paths = diff.where(F.col("status") == status).select("rel_path")
    pages = new.join(paths, "rel_path", "left_semi")
    return release_markdown(pages, opts)


def diff_added(old: DataFrame, new: DataFrame, opts: JobOptions, diff: DataFrame | None = None) -> DataFrame:
    """(filename, markdown) of pages only in the new snapshot (no article -> skipped)."""
    d = diff if diff is not None else snapshot_diff(old, new, opts)
    return _changed_markdown(new, d, ADDED, opts)


def diff_modified(old: DataFrame, new: DataFrame, opts: JobOptions, diff: DataFrame | None = None) -> DataFrame:
    """(filename, markdown) of pages whose hash changed (no article -> skipped)."""
    d = diff if diff is not None else snapshot_diff(old, new, opts)
    return _changed_markdown(new, d, MODIFIED, opts)


def diff_deleted(old: DataFrame, new: DataFrame, opts: JobOptions, diff: DataFrame | None = None) -> DataFrame:
    """(filename) of pages only in the old snapshot."""
    d = diff if diff is not None else snapshot_diff(old, new, opts)
    return d.where(F.col("status") == DELETED).select("filename")


def release_changes(old: DataFrame, new: DataFrame, opts: JobOptions, diff: DataFrame | None = None) -> DataFrame:
    """The release change set as one table (filename, status, markdown), a file
    once: added / modified with their Markdown (pages without an article are
    skipped, D8), deleted without.

    The changed paths and states are written first (short columns), so that
    their size is known: below Spark's broadcast threshold the pages are the
    streamed side of the join and no page body is shuffled. A snapshot table
    that stores ``sha256`` is not hashed again; ``diff`` (``changed_paths`` of
    stored digests) takes the place of the comparison."""
    spark = new.sparkSession
    path = scratch_path(spark, "changed-paths")
    (snapshot_diff(old, new, opts) if diff is None else diff).where(F.col("status") != UNCHANGED).write.parquet(path)
    d = spark.read.parquet(path)
    changed = d.where(F.col("status") != DELETED).select("rel_path", "status")
    md = release_markdown(new.select("rel_path", "html").join(changed, "rel_path"), opts, keep=("status",))
    gone = d.where(F.col("status") == DELETED).select("filename", "status", F.lit(None).cast("string").alias("markdown"))
    return md.select("filename", "status", "markdown").unionByName(gone)


def commit_diff(files: DataFrame, opts: JobOptions) -> DataFrame:
    """Changed files -> (filename, action): 'upsert' for added/modified,
    'delete' for removed; other statuses and filtered paths are ignored."""
    action = F.when(F.col("status").isin("added", "modified"), F.lit("upsert")).when(
        F.col("status") == "removed", F.lit("delete")
    )
    f = files.where(ignore_paths_predicate(F.col("filename"), opts))
    return f.select("filename", action.alias("action")).where(F.col("action").isNotNull())


def change_summary(diff: DataFrame) -> DataFrame:
    """A1: counts of added / modified / deleted (zeros shown) in one row."""
    return diff.agg(
        F.count_if(F.col("status") == ADDED).alias("n_added"),
        F.count_if(F.col("status") == MODIFIED).alias("n_modified"),
        F.count_if(F.col("status") == DELETED).alias("n_deleted"),
    )


def records_per_file(chunks: DataFrame, verb: str = "added", prep: str = "from") -> DataFrame:
    """A2: records per file with a message."""
    g = chunks.groupBy("filename").agg(F.count(F.lit(1)).alias("n_records"))
    # Fixed value: the message's wording
    msg = F.format_string(f"Successfully {verb} %d records {prep} %s", F.col("n_records"), F.col("filename"))
    return g.select("filename", "n_records", msg.alias("message"))
