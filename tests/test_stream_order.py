"""The order of changes across micro-batches, polls and restarts."""

from __future__ import annotations

import itertools
import random

from docweave.operators import tables as TB
from docweave.options import DEFAULT as OPTS
from docweave.streaming.refresh_stream import CHANGE_SCHEMA, ChunkTableState, stream_refresh

CHUNKS = "filename string, chunk_no long, header1 string, header2 string, header3 string, doc_link string, text string"
O = OPTS.with_(chunk_buckets=3)


def start(spark, tmp_path, name="t"):
    path = str(tmp_path / name)
    old = [(f"en/{x}.md", 1, None, None, None, "l", f"old {x}") for x in "abcd"]
    TB.full_load(spark.createDataFrame(old, CHUNKS), path, O)
    return ChunkTableState(spark, path)


def send(spark, tmp_path, state, polls, name="t"):
    """Every poll is one change file and one run of the stream from the stored cursor."""
    src, ckpt = str(tmp_path / f"{name}-changes"), str(tmp_path / f"{name}-ckpt")
    for rows in polls:
        spark.createDataFrame(rows, CHANGE_SCHEMA).coalesce(1).write.mode("append").parquet(src)
        stream_refresh(spark, src, state, O, checkpoint=ckpt, files_per_batch=1)


def texts(state):
    return {(r["filename"], r["text"]) for r in state.read().collect()}


def test_older_change_in_a_later_batch_loses(spark, tmp_path):
    state = start(spark, tmp_path)
    send(
        spark, tmp_path, state,
        [
            [("en/a.md", "modified", "# A\nnine", 9), ("en/b.md", "deleted", None, 9), ("en/n.md", "added", "# N\nnew", 4)],
            [("en/a.md", "modified", "# A\nthree", 3), ("en/b.md", "modified", "# B\nthree", 3), ("en/n.md", "deleted", None, 3)],
            [("en/a.md", "deleted", None, 8), ("en/c.md", "deleted", None, 1)],
            [("en/b.md", "added", "# B\nten", 10), ("en/c.md", "added", "# C\nlate", 0)],
        ],
    )
    assert texts(state) == {("en/a.md", "#A\nnine"), ("en/b.md", "#B\nten"), ("en/n.md", "#N\nnew"), ("en/d.md", "old d")}
    assert {tuple(r) for r in state.versions().collect()} == {
        ("en/a.md", 9, False), ("en/b.md", 10, False), ("en/n.md", 4, False), ("en/c.md", 1, True),
    }


def test_any_dealing_over_batches_gives_the_same_table(spark, tmp_path):
    rng = random.Random(5)
    seqs = itertools.count(1)
    changes = [(f"en/{rng.choice('abcxyz')}.md", *rng.choice([("deleted", None), ("modified", "# T\nv{}")]), next(seqs)) for _ in range(24)]
    changes = [(f, s, m and m.format(n), n) for f, s, m, n in changes]
    last = {f: (s, m) for f, s, m, _ in changes}
    want = {(f"en/{x}.md", f"old {x}") for x in "abcd" if f"en/{x}.md" not in last} | {(f, m.replace("# T", "#T")) for f, (s, m) in last.items() if m}
    for k in range(2):
        rng.shuffle(changes)
        state = start(spark, tmp_path, f"t{k}")
        send(spark, tmp_path, state, [changes[:9], changes[9:10], changes[10:]], f"t{k}")
        assert texts(state) == want


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    state = start(spark, tmp_path)
    rows = [("en/a.md", "modified", "# A\ntwo", 2), ("en/b.md", "deleted", None, 2)]
    batch = spark.createDataFrame(rows, CHANGE_SCHEMA)
    for _ in range(2):
        TB.apply_changes_in_place(spark, state.path, batch, O, versions_path=state.versions_path)
        assert texts(state) == {("en/a.md", "#A\ntwo"), ("en/c.md", "old c"), ("en/d.md", "old d")}
    # a broken run has written the chunks but not the versions: the repeat writes both
    later = spark.createDataFrame([("en/c.md", "modified", "# C\nthree", 3)], CHANGE_SCHEMA)
    TB.apply_changes_in_place(spark, state.path, later, O)
    assert ("en/c.md", 3) not in {(r["filename"], r["seq"]) for r in state.versions().collect()}
    TB.apply_changes_in_place(spark, state.path, later, O, versions_path=state.versions_path)
    assert ("en/c.md", "#C\nthree") in texts(state) and ("en/c.md", 3, False) in {tuple(r) for r in state.versions().collect()}


def test_changes_without_a_number_always_apply_and_keep_the_version(spark, tmp_path):
    state = start(spark, tmp_path)
    send(spark, tmp_path, state, [[("en/a.md", "modified", "# A\nfive", 5)], [("en/a.md", "modified", "# A\nplain", None)], [("en/a.md", "modified", "# A\nfour", 4)]])
    assert ("en/a.md", "#A\nplain") in texts(state)
    assert {tuple(r) for r in state.versions().collect()} == {("en/a.md", 5, False)}
