"""T1 / T2 against a plain-Python reading of the heading-split rules."""

from pyspark.sql import functions as F

from docweave.operators.chunk import chunk_docs, split_by_heading
from docweave.options import JobOptions


def py_split(text, h3=False):
    """Brute-force reading of the rules: returns [(h1, h2, h3, content)]."""
    seps = [("###", 3), ("##", 2), ("#", 1)] if h3 else [("##", 2), ("#", 1)]
    out, cur, meta, state = [], [], {}, {}
    in_code, fence = False, ""

    def flush():
        if cur:
            out.append((dict(meta), "\n".join(cur)))
            cur.clear()

    for line in text.split("\n"):
        s = "".join(ch for ch in line.strip() if ch.isprintable())
        if not in_code:
            if s.startswith("```") and s.count("```") == 1:
                in_code, fence = True, "```"
            elif s.startswith("~~~"):
                in_code, fence = True, "~~~"
        elif s.startswith(fence):
            in_code, fence = False, ""
        if in_code:
            cur.append(s)
            continue
        for sep, lvl in seps:
            if s.startswith(sep) and (len(s) == len(sep) or s[len(sep)] == " "):
                for k in [k for k in state if k >= lvl]:
                    del state[k]
                state[lvl] = s[len(sep):].strip()
                flush()
                break
        else:
            if s:
                cur.append(s)
            else:
                flush()
        meta = dict(state)
    flush()
    chunks = []
    for m, c in out:
        if chunks and chunks[-1][0] == m:
            chunks[-1] = (m, chunks[-1][1] + "  \n" + c)
        else:
            chunks.append((m, c))
    return [(m.get(1), m.get(2), m.get(3), c) for m, c in chunks]


EDGE_DOCS = {
    "preamble": "intro line\nsecond\n\n# Title\nbody",
    "repeat_h2": "# T\n## B\none\n## B\ntwo\n\nthree",
    "h3_plain": "# T\n### not split\ntext",
    "empty_sections": "# A\n# B\n## C\n\n## D\nd text",
    "fence_hash": "# T\n```\n# not a heading\n\ncode\n```\nafter",
    "inline_ticks": "# T\n```x``` inline\n# real heading\ntext",
    "no_space": "#NoSpace\n##AlsoNot\ntext",
    "tilde_fence": "# T\n~~~\n## inside\n```\n~~~\nout",
    "marker_only": "#\nempty h1\n##\nempty h2",
    "nonprint": "  # Spaced  \n\ttabbed\x07 text\xa0x\n\n\x00\nlast",
    "h1_clears_h2": "# A\n## B\nb\n# C\nc",
}


def test_split_matches_python_rules(spark):
    rows = [(k, v) for k, v in EDGE_DOCS.items()]
    df = spark.createDataFrame(rows, "doc string, text string")
    got = {}
    for r in split_by_heading(df, key="doc", text="text").collect():
        got.setdefault(r["doc"], []).append((r["chunk_no"], (r["header1"], r["header2"], r["header3"], r["content"])))
    for k, v in EDGE_DOCS.items():
        want = py_split(v)
        have = [x for _, x in sorted(got.get(k, []))]
        assert have == want, (k, have, want)


def test_split_h3_option(spark):
    text = "# A\n## B\n### C\nc\n## D\nd"
    df = spark.createDataFrame([("d", text)], "doc string, text string")
    have = [(r["header1"], r["header2"], r["header3"], r["content"]) for r in split_by_heading(df, "doc", "text", split_on_h3=True).orderBy("chunk_no").collect()]
    assert have == py_split(text, h3=True)


def test_chunk_docs_link_and_prefix(spark):
    opts = JobOptions(web_path="https://w/", doc_path="en/")
    df = spark.createDataFrame([("en/docs/a.md", "# Top\n## Sub Part!\nsee ../x.md and ../../y{.cInlineImage-full}")], "filename string, text string")
    r = chunk_docs(df, opts).collect()[0]
    assert r["doc_link"] == "https://w/docs/a/#sub-part"
    assert r["text"] == "#Top\n##Sub Part!\nsee https://w/x and https://w/y"


def test_no_h1_text_starts_with_newline(spark):
    opts = JobOptions()
    df = spark.createDataFrame([("en/a.md", "just text")], "filename string, text string")
    r = chunk_docs(df, opts).collect()[0]
    assert r["text"] == "\njust text" and r["doc_link"].endswith("/a/")


def test_no_shuffle(spark, sf):
    from docweave.session import table

    docs = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("doc"), "text")
    df = chunk_docs(docs, JobOptions(), key="doc", text="text")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 0, plan


LINE_KINDS = [
    "# H{n}", "## S{n}", "### T{n}", "#", "##", "#x{n}", "  ## padded {n}  ", "```", "```py", "``` x ```", "~~~",
    "````", "", "   ", "\t", "text {n}", "more text {n} with ../link.md", "\x07bell {n}", "a\xa0b {n}", "  lead {n}",
    "# in {n}   ", "~~~~", "* item {n}",
]


def test_split_random_documents(spark):
    import random

    rnd = random.Random(42)
    docs = []
    for d in range(300):
        n = rnd.randint(0, 25)
        lines = [rnd.choice(LINE_KINDS).format(n=rnd.randint(0, 3)) for _ in range(n)]
        docs.append((f"d{d}", "\n".join(lines)))
    df = spark.createDataFrame(docs, "doc string, text string")
    got = {}
    for r in split_by_heading(df, key="doc", text="text").collect():
        got.setdefault(r["doc"], []).append((r["chunk_no"], (r["header1"], r["header2"], r["header3"], r["content"])))
    for k, v in docs:
        have = [x for _, x in sorted(got.get(k, []))]
        assert have == py_split(v), (k, v)


def test_sql_twin_matches_rules():
    """The DuckDB twin of T1 on the edge and random documents equals the rules."""
    import random

    import duckdb
    import pandas as pd

    from docweave.plans import sqlcheck as S

    rnd = random.Random(7)
    docs = dict(EDGE_DOCS)
    for d in range(200):
        docs[f"r{d}"] = "\n".join(rnd.choice(LINE_KINDS).format(n=rnd.randint(0, 3)) for _ in range(rnd.randint(0, 25)))
    con = duckdb.connect()
    con.register("src_docs", pd.DataFrame({"doc": list(docs), "text": list(docs.values())}))
    q = S.Q()
    t = S.split_by_heading(q, "src_docs", "doc", "text")
    got = {}
    for k, n, h1, h2, h3, c in con.execute(q.render(f"SELECT k, chunk_no, header1, header2, header3, content FROM {t}")).fetchall():
        got.setdefault(k, []).append((n, (h1, h2, h3, c)))
    for k, v in docs.items():
        assert [x for _, x in sorted(got.get(k, []))] == py_split(v), (k, v)
