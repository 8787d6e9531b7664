"""docweave: a PySpark-native documentation-corpus engine.

Pages and files are tables; the article is extracted and converted to
Markdown with column expressions, split by heading into linked chunks with
window functions, embedded by feature hashing, diffed between snapshots by
content hash, and searched with exact or approximate nearest-neighbour jobs
that end in budgeted prompt tables.
"""

from docweave.options import JobOptions

__all__ = ["JobOptions"]
__version__ = "0.1.0"
