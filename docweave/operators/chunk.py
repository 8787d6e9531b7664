"""T1 split-by-heading, W1 heading carry, W4 chunk numbers and T2 chunk_docs.

A document is one row: an Arrow UDF walks its lines once (linear in the text)
and returns the document's sections as one array, which is exploded once. No
exchange, no sort, and rows that share a key are split apart from each other.
W1 states the heading carry line by line, with windows.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docweave.functions.arrow import joined, steps
from docweave.functions.text import doc_link, prefix_headings, rewrite_links
from docweave.options import JobOptions

# White space removed at both ends of a line (Python str.strip).
STRIP_CLASS = (
    "[\\x{9}-\\x{d}\\x{1c}-\\x{20}\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}"
    "\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"
)
STRIP_RE = f"^{STRIP_CLASS}+|{STRIP_CLASS}+$"
# Characters that are not printable (removed inside a line).
NONPRINT_RE = (
    "[\\x{0}-\\x{1f}\\x{7f}-\\x{a0}\\x{ad}\\x{600}-\\x{605}\\x{61c}\\x{6dd}\\x{70f}\\x{180e}"
    "\\x{1680}\\x{2000}-\\x{200f}\\x{2028}-\\x{202f}\\x{205f}-\\x{2064}\\x{2066}-\\x{206f}"
    "\\x{3000}\\x{e000}-\\x{f8ff}\\x{feff}\\x{fff9}-\\x{fffb}]"
)
FENCE_TICK = "```"
FENCE_TILDE = "~~~"


def clean_line(x: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(x, F.lit(STRIP_RE), F.lit("")), F.lit(NONPRINT_RE), F.lit(""))


def _fence_kind(x: Column) -> Column:
    n_tick = (F.length(x) - F.length(F.replace(x, F.lit(FENCE_TICK), F.lit("")))) / 3
    return (
        F.when(F.startswith(x, F.lit(FENCE_TICK)), F.when(n_tick == 1, 1).otherwise(2))
        .when(F.startswith(x, F.lit(FENCE_TILDE)), 3)
        .otherwise(0)
    )


def _fence_roles(cleaned: Column) -> Column:
    """In-row fold over fence lines: map line position -> 1 (opens) / 2 (closes).

    A fence line with one ``` or a ~~~ line opens a block; inside a block, a
    line that starts with the opening fence closes it.
    """
    fences = F.filter(
        F.transform(cleaned, lambda x, i: F.struct(i.alias("pos"), _fence_kind(x).alias("kind"))),
        lambda f: f["kind"] > 0,
    )
    init = F.struct(
        F.lit(0).alias("open"),
        F.array().cast("array<struct<pos:int,role:int>>").alias("roles"),
    )

    def step(acc, f):
        o, k, p = acc["open"], f["kind"], f["pos"]
        opens = (o == 0) & ((k == 1) | (k == 3))
        closes = ((o == 1) & ((k == 1) | (k == 2))) | ((o == 3) & (k == 3))
        new_open = F.when(opens, k).when(closes, F.lit(0)).otherwise(o)
        role = F.when(opens, 1).when(closes, 2)
        roles = F.when(role.isNull(), acc["roles"]).otherwise(
            F.concat(acc["roles"], F.array(F.struct(p.alias("pos"), role.alias("role"))))
        )
        return F.struct(new_open.alias("open"), roles.alias("roles"))

    folded = F.aggregate(fences, init, step)
    return F.when(F.size(fences) == 0, F.create_map().cast("map<int,int>")).otherwise(
        F.map_from_entries(folded["roles"])
    )


def split_lines(docs: DataFrame, key: str = "filename", text: str = "text") -> DataFrame:
    """(key, text) -> (key, pos, s, role): cleaned lines with fence roles."""
    # a NULL text gives an empty line array instead of a filter: a filter on an
    # expensive derived text would be pushed below its projection and
    # evaluate the expression twice
    raw = F.when(F.col(text).isNull(), F.array().cast("array<string>")).otherwise(F.split(F.col(text), "\n", -1))
    cleaned = F.transform(raw, clean_line)
    # the one exchange by document happens here, on whole documents; the
    # windows below find their distribution satisfied, and line cleaning runs
    # spread over all shuffle partitions
    staged = docs.select(F.col(key).alias("_k"), F.col(text)).repartition("_k").select(F.col("_k"), cleaned.alias("_lines")).select(
        "_k", "_lines", _fence_roles(F.col("_lines")).alias("_roles")
    )
    # the _outer generator keeps Spark from inferring a size(lines) > 0 filter
    # below the generate (which would evaluate the text expression twice);
    # the one NULL row it emits for an empty array is dropped above it
    exploded = staged.select("_k", "_roles", F.posexplode_outer("_lines").alias("pos", "s")).where(
        F.col("pos").isNotNull()
    )
    return exploded.select(
        F.col("_k").alias(key), "pos", "s", F.try_element_at("_roles", F.col("pos")).alias("role")
    )


def heading_carry(lines: DataFrame, key: str = "filename", split_on_h3: bool = False) -> DataFrame:
    """W1 over split lines: the headings in force at each line, code state, and the
    content flag. A new H1 clears H2 (and H3); a new H2 clears H3."""
    w = Window.partitionBy(key).orderBy("pos")
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    s = F.col("s")
    o_last = F.max(F.when(F.col("role") == 1, F.col("pos"))).over(run)
    c_prev = F.max(F.when(F.col("role") == 2, F.col("pos"))).over(before)
    lines = lines.withColumn("in_code", o_last.isNotNull() & (c_prev.isNull() | (o_last > c_prev)))

    def is_h(marker: str) -> Column:
        return ~F.col("in_code") & ((s == marker) | F.startswith(s, F.lit(marker + " ")))

    h3 = is_h("###") if split_on_h3 else F.lit(False)
    h2 = ~h3 & is_h("##")
    h1 = ~h3 & ~h2 & is_h("#")
    lines = lines.withColumn("lvl", F.when(h1, 1).when(h2, 2).when(h3, 3).otherwise(0))
    val = F.trim(F.substring(s, F.col("lvl") + 1, F.lit(1 << 30)))
    for n in (1, 2, 3):
        lines = lines.withColumn(
            f"_h{n}", F.max(F.when(F.col("lvl") == n, F.struct(F.col("pos").alias("p"), val.alias("v")))).over(run)
        )
    p1 = F.coalesce(F.col("_h1.p"), F.lit(-1))
    p2 = F.coalesce(F.col("_h2.p"), F.lit(-1))
    return lines.select(
        key,
        "pos",
        "s",
        "in_code",
        F.col("_h1.v").alias("header1"),
        F.when(F.col("_h2.p") > p1, F.col("_h2.v")).alias("header2"),
        F.when((F.col("_h3.p") > p1) & (F.col("_h3.p") > p2), F.col("_h3.v")).alias("header3"),
        (F.col("in_code") | ((F.col("lvl") == 0) & (s != ""))).alias("is_content"),
    )


def sections(text: str, deepest: int = 2) -> list[tuple[str | None, str | None, str | None, str]]:
    """T1 on one document: (header1, header2, header3, content) in order.

    A run of lines under the same headings is one section; lines of a paragraph
    join with a line feed, paragraphs with two blanks and a line feed.
    """
    out: list[tuple[tuple, list[str]]] = []
    heads: list[str | None] = [None, None, None]
    fence, paragraph_ends = "", True
    for raw in text.split("\n"):
        line = "".join(filter(str.isprintable, raw.strip()))
        in_code = bool(fence)
        if in_code:
            fence = "" if line.startswith(fence) else fence
        elif line.startswith(FENCE_TILDE) or (line.startswith(FENCE_TICK) and line.count(FENCE_TICK) == 1):
            fence, in_code = line[:3], True
        marks = len(line) - len(line.lstrip("#"))
        if not in_code and 0 < marks <= deepest and line[marks : marks + 1] in ("", " "):
            heads = [*heads[: marks - 1], line[marks:].strip(), *[None] * (3 - marks)]
            paragraph_ends = True
        elif line or in_code:
            if out and out[-1][0] == tuple(heads):
                out[-1][1].append(("  \n" if paragraph_ends else "\n") + line)
            else:
                out.append((tuple(heads), [line]))
            paragraph_ends = False
        else:
            paragraph_ends = True
    return [(*h, "".join(lines)) for h, lines in out]


def split_by_heading(docs: DataFrame, key: str = "filename", text: str = "text", split_on_h3: bool = False) -> DataFrame:
    """Markdown documents -> (key, chunk_no, header1, header2, header3, content)."""
    deepest = 3 if split_on_h3 else 2

    @F.arrow_udf("array<struct<header1:string,header2:string,header3:string,content:string>>")
    def split(texts: pa.Array) -> pa.Array:
        names = ("header1", "header2", "header3", "content")
        kind = pa.list_(pa.struct([(c, pa.string()) for c in names]))
        rows = lambda t: [] if t is None else [dict(zip(names, x)) for x in sections(t, deepest)]
        return joined([pa.array([rows(t) for t in some], kind) for some in steps(texts)], kind)

    # the outer generator keeps the UDF from being repeated in a pushed-down filter
    found = docs.select(F.col(key), F.posexplode_outer(split(F.col(text))).alias("_n", "_s")).where(F.col("_s").isNotNull())
    return found.select(key, (F.col("_n") + 1).cast("bigint").alias("chunk_no"), "_s.header1", "_s.header2", "_s.header3", "_s.content")


def chunk_docs(docs: DataFrame, opts: JobOptions, key: str = "filename", text: str = "text") -> DataFrame:
    """T1 -> doc link (F2) -> link rewrites (F3) -> heading prefix (F4) -> W4 numbers.

    Output: (filename, chunk_no, header1, header2, header3, doc_link, text).
    """
    t1 = split_by_heading(docs, key, text, opts.split_on_h3)
    return t1.select(
        F.col(key).alias("filename"),
        F.col("chunk_no").cast("bigint").alias("chunk_no"),
        "header1",
        "header2",
        "header3",
        doc_link(F.col(key), F.col("header2"), F.col("header3"), opts.web_path, opts.doc_path).alias("doc_link"),
        prefix_headings(
            F.col("header1"), F.col("header2"), F.col("header3"), rewrite_links(F.col("content"), opts.web_path)
        ).alias("text"),
    )
