"""Page and chunk functions hold few values of a batch as Python objects."""

from __future__ import annotations

import sys
import tracemalloc

import numpy as np
import pyarrow as pa

from docweave.functions import html as H
from docweave.functions.arrow import STEP_ROWS, mapped, steps
from docweave.functions.vectors import bucket_vectors


def test_texts_come_in_steps():
    texts = pa.array([None, "", *["x" * 100_000] * 100, *["y"] * 1_000])
    parts = list(steps(texts))
    assert [t for p in parts for t in p] == texts.to_pylist()
    assert max(map(len, parts)) <= STEP_ROWS and max(sum(len(t or "") for t in p) for p in parts) < 5 << 20


def test_pages_of_a_batch_are_not_objects_at_once():
    page = "<article><h1>t</h1>" + "<p>some words</p>" * 60 + "</article>"
    pages = pa.array([page, None] * 1_000)
    for convert in (H._article, H._markdown, H._article_markdown):
        tracemalloc.start()
        out = convert.func(pages)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert len(out) == len(pages) and out.null_count == 1_000
        assert peak < 1_000 * sys.getsizeof(page) / 2
    assert mapped(pa.array([], pa.string()), len, pa.int64()).to_pylist() == []


def test_bucket_vectors():
    rng = np.random.default_rng(2)
    rows = [rng.integers(0, 16, n).tolist() for n in [0, 1, 50, *rng.integers(0, 9, 700)]]
    got = bucket_vectors(pa.array([[15], *rows], pa.list_(pa.int32())).slice(1), 16)
    for b, v in zip(rows, got.to_pylist(), strict=True):
        c = np.bincount(np.asarray(b, dtype=np.int64), minlength=16).astype(np.float64)
        norm = np.sqrt((c * c).sum())
        assert v == (c / norm if norm else c).astype(np.float32).tolist()


def test_stream_change_set_is_converted_before_it_is_one_file(spark, sf, monkeypatch):
    """The task that writes the file of a micro-batch converts no page."""
    from docweave.plans import catalog
    from docweave.streaming import refresh_stream

    monkeypatch.setattr(refresh_stream, "stream_refresh", lambda spark, changes_dir, state, *_, **__: state)
    plans, stale = [], catalog._with_stale_changes
    monkeypatch.setattr(catalog, "_with_stale_changes", lambda last: plans.append(last._jdf.queryExecution().toString()) or stale(last))
    catalog._x1_spark(spark, sf)
    assert len(plans) == 1 and "ArrowEvalPython" not in plans[0]
