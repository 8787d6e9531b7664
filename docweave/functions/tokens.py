"""F11 token counting as a column expression.

The exact BPE vocabulary of the reference needs a download, so the counter
is pluggable: the default counts word runs and single other visible
characters, computed JVM-side with ``regexp_count``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docweave.functions.regex import sql_lit

TOKEN_RE = "[0-9A-Za-z_]+|[^ \\t\\n\\r\\f\\x0B0-9A-Za-z_]"


def token_count(text) -> Column:
    t = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(t, F.lit(TOKEN_RE)), F.lit(0)).cast("bigint")


def token_count_sql(e: str) -> str:
    return f"coalesce(len(regexp_extract_all({e}, {sql_lit(TOKEN_RE)})), 0)::BIGINT"
