"""Golden pages, and properties on random ones."""

from __future__ import annotations

import random
import re

import pytest

from docweave.functions.html import article, article_markdown, extract_article, html_to_markdown, to_markdown

GOLDEN = {
    # entities: decoded once, after the tags are known
    "<p>use &#60;b&#62; tag</p>": "use <b> tag",
    "a &#38;lt; b": "a &lt; b",
    "&#0; &#xD800; &nbsp;x &copy; &amp &quo": "&#0; &#xD800; x © & &quo",
    # a sign that opens no tag is text
    "1 < 2 and 3 > 2": "1 < 2 and 3 > 2",
    # nested and spanning inline elements
    "<b>bold <i>it</i></b>": "**bold *it***",
    "a <b> sp </b>b <code>a`b</code>": "a **sp** b ``a`b``",
    "<b>x<p>y</b>z": "**x**\n\n**y**z",
    "<p><b>unclosed<br><p>next": "unclosed\n\nnext",
    "<b><i>x</b></i>y": "**x**y",
    "<i></i><p></p>": None,
    # links and images
    "<a href='x'>single</a>": "[single](x)",
    "<a title=\"a>b\" href=y>t</a>": "[t](y)",
    "<a href=\"u\"><div>block</div><p>two</p></a>z": "[block](u)\n\n[two](u)\n\nz",
    "<a name=n>anchor</a> <img alt=\"q r\" src=s>": "anchor ![q r](s)",
    # lists
    "<ul><li>one<ul><li>two</li><li>three<p>para</p></li></ul></li><li>four</ul><p>x": "* one\n  * two\n  * three\n\n    para\n\n* four\n\nx",
    "<ol><li>x</li><li>y<ol><li>z</ol></li></ol>t": "1. x\n2. y\n   1. z\n\nt",
    "<ul><li>a<li><li>b</ul>": "* a\n* b",
    # quotes, headings, rules, breaks
    "<blockquote><p>q1</p><p>q2<br>q3</p></blockquote>end": "> q1\n>\n> q2  \n> q3\n\nend",
    "<h2>Head<br>two <b>x</b></h2>text<hr>more": "## Head two **x**\n\ntext\n\n---\n\nmore",
    "<h2></h2><h3>T</h3>": "### T",
    "x<br><br>y<br><p>z": "x  \n  \ny\n\nz",
    # tables
    "<table><tr><th>a</th><th>b|c</th></tr><tr><td>1<br>2<td><p>p</p><p>q</p></table>after": "| a | b\\|c |\n| --- | --- |\n| 1 2 | p q |\n\nafter",
    # code
    "<ul><li><pre>x\n  y</pre></ul>": "* ```\n  x\n    y\n  ```",
    "<pre><code>&lt;a&gt; <b>1</b></code></pre>": "```\n<a> 1\n```",
    # what is no text
    "a<!-- <b>c</b> -->b <script>x<p></script>c<STYLE>d</STYLE>": "ab c",
    "<noscript>kept</noscript> text": "kept text",
    # white space
    "<p> a\n\t b </p>\n\n<p>c</p>": "a b\n\nc",
    # stray closing tags
    "</ul></li></td></b></table>q": "q",
}

ARTICLES = {
    "<!-- <article>old</article> --><article>real</article>": "<article>real</article>",
    "<article>a<!-- </article> -->b</article>c": "<article>a<!-- </article> -->b</article>",
    "<script>\"<article>\"</script><article>r</article>": "<article>r</article>",
    "<article>a<script>'</article>'</script>b</article>c": "<article>a<script>'</article>'</script>b</article>",
    "<article x=1>one <article>two</article> tail</article> after": "<article>one <article>two</article> tail</article>",
    "<main><article><p>open</main><footer>foot</footer>": "<article><p>open</article>",
    "<article><main>q</main>r</article>s": "<article><main>q</main>r</article>",
    "</article>x<article>y": "<article>y</article>",
    "<articles>no</articles>": None,
    "": None,
}


def test_golden():
    assert {k: to_markdown(k) or None for k in GOLDEN} == GOLDEN
    assert {k: article(k) for k in ARTICLES} == ARTICLES


def test_columns(spark):
    df = spark.createDataFrame([(k,) for k in [*GOLDEN, *ARTICLES, None]], "html string")
    got = df.select("html", html_to_markdown("html").alias("md"), extract_article("html").alias("a"), article_markdown("html").alias("am")).collect()
    for r in got:
        whole = None if r["html"] is None else article(r["html"])
        assert r["md"] == (GOLDEN.get(r["html"], r["md"]) if r["html"] else None)
        assert r["a"] == whole
        assert r["am"] == (to_markdown(whole) or None if whole else None)


def test_one_evaluation_a_page(spark):
    """A page is converted once, and nothing is shuffled."""
    from docweave.options import DEFAULT
    from docweave.plans.pipelines import build_release_chunks

    pages = spark.createDataFrame([("out-prod/a/index.html", "<article><h1>T</h1>x</article>")], "rel_path string, html string")
    plan = build_release_chunks(pages, DEFAULT)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("_article_markdown(") == 1 and "Exchange" not in plan


TAGS = ["b", "i", "code", "p", "div", "ul", "ol", "li", "blockquote", "h2", "table", "tr", "td", "th", "article", "a"]


@pytest.mark.parametrize("seed", range(40))
def test_no_text_is_lost_or_invented(seed):
    """Random nestings, closed or not: every word comes out once, in order."""
    rng = random.Random(seed)
    words, page = [], []
    for n in range(120):
        kind = rng.random()
        if kind < 0.45:
            words.append(f"w{n}")
            page.append(f" w{n} " if rng.random() < 0.5 else f"w{n}")
        elif kind < 0.75:
            page.append(f"<{rng.choice(TAGS)}>")
        elif kind < 0.95:
            page.append(f"</{rng.choice(TAGS)}>")
        else:
            page.append(rng.choice(["<br>", "<!-- c -->", "<hr>", "<x-y z='>'>", " < ", "&amp;"]))
    got = to_markdown("".join(page))
    assert re.findall(r"w\d+", got) == words
    assert "\n\n\n" not in got.replace("\n>", "\n")


def test_work_is_linear_in_the_page():
    import time

    def seconds(page):
        t = time.perf_counter()
        to_markdown(page), article(page)
        return time.perf_counter() - t

    for piece in ("<a href=\"x>", "<div ", "<ul><li>", "<b>x", "<!-", "<td>y", "&#", "<p>t</b>", "<script "):
        seconds(piece * 2000)
        assert seconds(piece * 20_000) < 60 * max(seconds(piece * 2000), 0.005), piece
