"""J1 over digest trees."""

from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from docweave.operators import diff as DF
from docweave.options import DEFAULT

OPTS = DEFAULT.with_(digest_parts=128, digest_leaves=8)
SNAP = "rel_path string, html string"


def tree(spark, tmp_path, name, pages):
    df = spark.createDataFrame(list(pages.items()), SNAP)
    return df, DF.write_digests(df, str(tmp_path / name), OPTS)


def test_random_snapshots_equal_the_full_comparison(spark, tmp_path):
    rng = random.Random(2)
    old = {f"out-prod/p{i}/index.html": f"v{rng.randrange(3)}" for i in range(300)}
    new = {p: (h if rng.random() < 0.7 else h + "!") for p, h in old.items() if rng.random() < 0.9} | {f"out-prod/n{i}/index.html": "x" for i in range(20)}
    new["out-prod/docs/p3/index.html"] = "ignored"
    (a, ta), (b, tb) = tree(spark, tmp_path, "a", old), tree(spark, tmp_path, "b", new)
    want = {tuple(r) for r in DF.snapshot_diff(a, b, OPTS).where("status <> 'unchanged'").collect()}
    assert {tuple(r) for r in DF.changed_paths(ta, tb).collect()} == want and len(want) > 100
    assert DF.changed_paths(ta, ta).count() == 0
    # the change set of a release, from the trees alone
    full = {tuple(r) for r in DF.release_changes(a, b, OPTS).collect()}
    assert {tuple(r) for r in DF.release_changes(a, b, OPTS, diff=DF.changed_paths(ta, tb)).collect()} == full


def test_one_changed_file_reads_one_part(spark, tmp_path):
    old = {f"out-prod/p{i}/index.html": "v" for i in range(20_000)}
    (_, ta), (_, tb) = tree(spark, tmp_path, "a", old), tree(spark, tmp_path, "b", old | {"out-prod/p77/index.html": "w"})
    found = DF.changed_paths(ta, tb)
    assert [tuple(r)[::2] for r in found.collect()] == [("out-prod/p77/index.html", "modified")]
    plan = found._jdf.queryExecution().executedPlan().toString()
    parts = set(re.findall(r"PartitionFilters: \[[^\]]*\(part#\d+ = (\d+)\)", plan))
    assert len(parts) == 1
    read = ta.paths().where(F.col("part") == int(parts.pop())).count()
    assert 0 < read < 0.01 * len(old) * 1.3


def test_empty_snapshots(spark, tmp_path):
    none = spark.createDataFrame([], SNAP)
    empty = DF.write_digests(none, str(tmp_path / "e"), OPTS)
    _, one = tree(spark, tmp_path, "o", {"out-prod/a/index.html": None})
    assert DF.changed_paths(empty, empty).count() == 0
    assert [r["status"] for r in DF.changed_paths(empty, one).collect()] == ["added"]
    assert [r["status"] for r in DF.changed_paths(one, empty).collect()] == ["deleted"]
