"""Regex rules written once and rendered for Spark (Java regex) and for SQL
engines with RE2 regexes, so batch jobs and their SQL checks share one spec.

Patterns use only syntax both engines accept: no look-around and no
back-references inside patterns. Replacements name groups as ``{1}``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    pattern: str
    replacement: str = ""
    literal: bool = False  # plain string replacement, no regex scan

    def spark_replacement(self) -> str:
        r = self.replacement.replace("\\", "\\\\").replace("$", "\\$")
        return re.sub(r"\{(\d)\}", r"$\1", r)

    def sql_replacement(self) -> str:
        return re.sub(r"\{(\d)\}", r"\\\1", self.replacement)

    def col(self, c: Column) -> Column:
        if self.literal:
            return F.replace(c, F.lit(self.pattern), F.lit(self.replacement))
        return F.regexp_replace(c, F.lit(self.pattern), F.lit(self.spark_replacement()))

    def sql(self, expr: str) -> str:
        if self.literal:
            return f"replace({expr}, {sql_lit(self.pattern)}, {sql_lit(self.replacement)})"
        return f"regexp_replace({expr}, {sql_lit(self.pattern)}, {sql_lit(self.sql_replacement())}, 'g')"


def apply_rules(c: Column, rules) -> Column:
    for r in rules:
        c = r.col(c)
    return c


def apply_rules_sql(expr: str, rules) -> str:
    for r in rules:
        expr = r.sql(expr)
    return expr


def sql_lit(s: str) -> str:
    """A SQL string literal; control characters become ``chr(n)`` pieces."""
    parts: list[str] = []
    buf = []
    for ch in s:
        if ord(ch) < 32:
            if buf:
                parts.append("'" + "".join(buf).replace("'", "''") + "'")
                buf = []
            parts.append(f"chr({ord(ch)})")
        else:
            buf.append(ch)
    if buf or not parts:
        parts.append("'" + "".join(buf).replace("'", "''") + "'")
    return parts[0] if len(parts) == 1 else "(" + " || ".join(parts) + ")"


def regex_quote(s: str) -> str:
    """Escape regex metacharacters with backslashes (valid in Java and RE2)."""
    return re.sub(r"([\\.^$|?*+()\[\]{}])", r"\\\1", s)
