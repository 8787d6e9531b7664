import base64

from pyspark.sql import functions as F

from docweave.functions.html import article_markdown
from docweave.functions.text import format_file_path, heading_anchor, scrub_question
from docweave.functions.tokens import token_count
from docweave.functions.vectors import distance, hashed_embedding
from docweave.sources.scan import decode_content


def one(spark, col, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("r")).first()["r"]


def test_anchor(spark):
    assert one(spark, heading_anchor(F.col("v")), "Hello World, v2.0!") == "#hello-world-v20"


def test_file_path(spark):
    assert one(spark, format_file_path(F.col("v")), "out-prod/docs/p1/index.html") == "en/docs/p1.md"


def test_scrub(spark):
    assert one(spark, scrub_question(F.col("v"), "in Docsite"), "How IN docsite to? in docsite") == "How  to? "


def test_tokens(spark):
    assert one(spark, token_count(F.col("v")), "Hé llo, w_1!") == 6


def test_markdown_golden(spark):
    html = (
        "<nav>menu</nav><article><h1>Title</h1><h2>Sub</h2><p>a <b>bold</b> and <i>it</i> "
        "<code>x</code> <a href=\"u\">link</a><br>next</p><ul><li>one</li><li>two</li></ul>"
        "<script>var a='<p>';</script><!-- c --><p>&lt;tag&gt; &amp;amp;</p></article>"
    )
    md = one(spark, article_markdown(F.col("v")), html)
    assert md == "# Title\n\n## Sub\n\na **bold** and *it* `x` [link](u)  \nnext\n\n* one\n* two\n\n<tag> &amp;"


def test_no_article_is_null(spark):
    assert one(spark, article_markdown(F.col("v")), "<div>x</div>") is None


def test_decode_invalid_utf8(spark):
    bad = base64.b64encode(b"\xff\xfeabc").decode()
    assert one(spark, decode_content(F.lit("base64"), F.col("v")), bad) == ""
    good = base64.b64encode("héllo".encode()).decode()
    assert one(spark, decode_content(F.lit("base64"), F.col("v")), good) == "héllo"
    assert one(spark, decode_content(F.lit(""), F.col("v")), "plain") == "plain"


def test_embedding_unit_and_distance(spark):
    df = spark.createDataFrame([("alpha beta beta",), ("",)], "v string").select(hashed_embedding(F.col("v"), 16).alias("e"))
    rows = [r["e"] for r in df.collect()]
    assert abs(sum(x * x for x in rows[0]) - 1.0) < 1e-6 and all(x == 0 for x in rows[1])
    d = spark.createDataFrame([([3.0, 0.0], [0.0, 4.0])], "a array<float>, b array<float>")
    r = d.select(distance("a", "b", "L2").alias("l2"), distance("a", "b", "IP").alias("ip"), distance("a", "b", "bogus").alias("x")).first()
    assert r["l2"] == 5.0 and r["ip"] == 0.0 and r["x"] == 5.0


def test_html_cases(spark):
    from docweave.functions.html import article_markdown, extract_article

    cases = {
        # nested and unclosed articles keep all of their text
        "<div><article a='1'>one <article>two</article> tail</article> after</div>": "one two tail",
        "<main><article><p>open text</p></main><footer>foot</footer>": "open text",
        "<ARTICLE>A</ARTICLE><article>B</article>": "A",
        "<p>none</p>": None,
        "<articles>no</articles>": None,
        # entities
        "<article>a &mdash; b &#8217;c&#x2019; &amp;lt; &#128512; &#0; &#xD800;</article>": "a — b ’c’ &lt; 😀 &#0; &#xD800;",
        # ordered lists
        "<article><ol><li>x</li><li>y</li></ol><ul><li>z</li></ul></article>": "1. x\n2. y\n\n* z",
        # pre: nothing inside is converted
        "<article><p>t</p><pre>a  <b>b</b>\n\n\n\n* &lt;i&gt;</pre><p>u</p></article>": "t\n\n```\na  b\n\n\n\n* <i>\n```\n\nu",
    }
    df = spark.createDataFrame([(k,) for k in cases], "html string")
    got = {r["html"]: r["md"] for r in df.select("html", article_markdown("html").alias("md")).collect()}
    assert got == cases
    nested = spark.createDataFrame([(next(iter(cases)),)], "html string").select(extract_article("html")).first()[0]
    assert nested == "<article>one <article>two</article> tail</article>"


def test_metric_names_as_spelled():
    from docweave.functions.vectors import normalise_metric

    assert [normalise_metric(x) for x in ("L2", "IP", "INNER_PRODUCT", "COSINE", "cosine", "HAMMING", None)] == ["L2", "IP", "IP", "COSINE", "L2", "L2", "L2"]
