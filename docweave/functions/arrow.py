"""Arrow arrays in bounded steps: a batch is never held as Python objects whole."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa

#: values (and characters of text, about) that are Python objects at a time
STEP_ROWS = 256
STEP_CHARS = 4 << 20


def steps(texts: pa.Array) -> Iterator[list]:
    """The values of an array of texts, some at a time."""
    held, size = [], 0
    for t in texts:
        t = t.as_py()
        held.append(t)
        size += len(t or "")
        if len(held) >= STEP_ROWS or size >= STEP_CHARS:
            yield held
            held, size = [], 0
    if held:
        yield held


def joined(parts: list[pa.Array], kind: pa.DataType) -> pa.Array:
    return pa.concat_arrays(parts) if parts else pa.array([], kind)


def mapped(texts: pa.Array, f: Callable, kind: pa.DataType) -> pa.Array:
    """``f`` of every text, null for null."""
    return joined([pa.array([None if t is None else f(t) for t in some], kind) for some in steps(texts)], kind)
