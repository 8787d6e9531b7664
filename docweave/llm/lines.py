"""Line dedup by an exact set-similarity join, in DataFrame functions only.

A line is the set of its lower-cased words. A word is a number: its high bits
rank its rarity (rarest first), its low 58 bits are a hash; a line is the
sorted array of its numbers. Two lines with Jaccard similarity t or more share
a word among the first n - ceil(t n) + 1 of each (prefix filter); their lengths
differ by a factor of t at most (length filter), and what can still follow the
shared word bounds the overlap (positional filter). A 128-bit sketch of each set
(the parity of its words per bit) differs in no more bits than the sets differ in
words, which drops nearly all other pairs inside the join, before they are rows.
What passes is verified on the whole sets. Of two matching lines the later one goes.

Lines with equal sets are one class, kept once in the join. Within a group that
shares a word, every class first meets only the group's earliest class (one
pair each); classes that are settled by this leave, and only the rest meet all
others. Copies of any number are so removed without listing pairs of copies.
Groups of very common words are salted.

The index of prefixes is built in ``SLICES`` parts of its tokens, one after the
other, and what a step has shuffled goes when its table is written: the disk never
holds the whole index as shuffle files and as tables at once.

The words of lines are written out only for lines in a candidate pair; they are
computed again from the texts, which meet the list of such lines (broadcast
while its measured size is below ``common.BROADCAST_BYTES``, shuffled beyond it).
"""

from __future__ import annotations

from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docweave.session import scratch_path

from .common import small

THRESHOLD = 0.8
RANK_SLOTS = 1 << 16
#: words of this rank (2 ** 20 occurrences) or a higher one have salted groups
HOT_RANK = 20
#: bits a word keeps below its rank in the index of prefixes; fewer bits only add candidates
INDEX_BITS = 35
#: the index is shuffled and written in so many parts (a power of two)
SLICES = 4
#: Spark's setting to release the shuffle files of a query when it ends
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _scratch(spark: SparkSession):
    """A database below the shared checkpoint folder; it goes, with its files, at the end.
    Until then each query releases its shuffle files when its result is written: no
    frame is computed twice here without being staged."""
    path = scratch_path(spark, "lines")
    name = "docweave_" + path.rsplit("-", 1)[-1]
    spark.sql(f"CREATE DATABASE {name} LOCATION '{path}'")
    before = spark.conf.get(RELEASE, None)
    spark.conf.set(RELEASE, "true")
    try:
        yield name
    finally:
        if before is None:
            spark.conf.unset(RELEASE)
        else:
            spark.conf.set(RELEASE, before)
        spark.sql(f"DROP DATABASE {name} CASCADE")


def _stage(df: DataFrame, name: str) -> DataFrame:
    """Write a table and read it again: cuts the lineage, compressed."""
    df.write.format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)


def _bucketed(df: DataFrame, key: str, name: str) -> DataFrame:
    """Write a frame that is partitioned by ``key`` as a table bucketed by it: it joins
    itself on the key without another shuffle."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(n, key).sortBy(key).format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)


#: white space within a line, beside blanks
OTHER_SPACE = "\t\r\f\x0b"


def _words(line: Column) -> Column:
    """The lower-cased words (runs without white space), repeats and empty strings included."""
    odd = F.lit(False)
    for c in OTHER_SPACE:
        odd = odd | line.contains(c)
    blanks = F.when(odd, F.translate(line, OTHER_SPACE, " " * len(OTHER_SPACE))).otherwise(line)
    return F.split(F.lower(blanks), " ")  # a single blank splits without a regex


def _word_hashes(line: Column) -> Column:
    """Hashes of the words, repeats included; empty words are taken out by their hash."""
    return F.array_remove(F.transform(_words(line), lambda w: F.xxhash64(w)), F.xxhash64(F.lit("")))


def rarity(docs: DataFrame) -> list[int]:
    """Rank 0..31 per hash slot of words, by the number of their occurrences in
    all texts: 0 for the rarest. At most RANK_SLOTS numbers come to the driver."""
    text = F.replace(F.col("text").cast("string"), F.lit("\n"), F.lit(" "))
    # words become rows before they are hashed: generated code, where a lambda is interpreted word by word
    words = docs.select(F.explode(_words(text)).alias("w")).where("w <> ''")
    slot = F.xxhash64("w").bitwiseAND(F.lit(RANK_SLOTS - 1)).cast("int").alias("slot")
    slots = words.groupBy(slot).agg(F.count(F.lit(1)).alias("n"))
    ranks = [0] * RANK_SLOTS
    for r in slots.select("slot", F.least(F.lit(31), F.floor(F.log2("n"))).cast("int").alias("rank")).collect():
        ranks[r["slot"]] = r["rank"]
    return ranks


def numbered_words(line: Column, ranks: list[int]) -> Column:
    """The set of a line's words as sorted numbers, rarest first."""
    table = F.split(F.lit(",".join(map(str, ranks))), ",").cast("array<long>")  # folded to one constant
    rank = lambda h: F.coalesce(F.get(table, h.bitwiseAND(F.lit(RANK_SLOTS - 1)).cast("int")), F.lit(0).cast("long"))  # noqa: E731 - never null: sorted as primitives
    number = lambda h: F.shiftleft(rank(h), 58).bitwiseOR(F.shiftrightunsigned(h, 6))
    return F.sort_array(F.transform(F.array_distinct(_word_hashes(line)), number))


def raw_lines(docs: DataFrame) -> DataFrame:
    """``(doc_id, text_key, line_no, line)`` of every line."""
    text = F.col("text").cast("string")
    lines = F.posexplode(F.split(text, "\n", -1)).alias("line_no", "line")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), lines)


def lines_of(docs: DataFrame, ranks: list[int]) -> DataFrame:
    """``(doc_id, text_key, line_no, words)`` for every line with a word. The lines are
    filtered by their texts: a filter on ``words`` would number every line twice."""
    worded = raw_lines(docs).where(F.btrim("line", F.lit(" " + OTHER_SPACE)) != "")
    return worded.select("doc_id", "text_key", "line_no", numbered_words(F.col("line"), ranks).alias("words"))


def _place() -> Column:
    """Order of lines: by doc_id (null last), line number, text under one doc_id."""
    return F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "line_no", "text_key")


def _prefix(t: float) -> Column:
    """The first words of a set, as index tokens. Sets so small that only equal
    sets reach t (these are one class) have none."""
    n = F.size("words")
    first = F.slice("words", F.lit(1), _prefix_size(t, n).cast("int"))
    token = lambda w: F.shiftright(w, 58 - INDEX_BITS)
    return F.when(n * (1 - t) + 1e-9 >= t, F.transform(first, token)).otherwise(F.array().cast("array<long>"))


def _needed(t: float, n: Column, m: Column) -> Column:
    """Overlap that sets of n and m words need for Jaccard t."""
    return F.ceil(F.lit(t / (1 + t)) * (n + m) - 1e-9)


def _prefix_size(t: float, n: Column) -> Column:
    return n - F.ceil(F.lit(t) * n - 1e-9) + 1


def _fits(t: float, a: str, b: str) -> Column:
    """Length, positional and sketch filter for two token rows (n words, position p
    of the shared word, sketch), given as prefixes of their columns."""
    n, m = F.col(a + "n"), F.col(b + "n")
    needed = _needed(t, n, m)
    bits = sum((F.bit_count(F.col(a + c).bitwiseXOR(F.col(b + c))) for c in SKETCH), F.lit(0))
    return (
        (F.least(n, m) >= F.lit(t) * F.greatest(n, m) - 1e-9)
        & (F.least(n - F.col(a + "p"), m - F.col(b + "p")) >= needed)
        & (bits <= n + m - 2 * needed)
    )


#: the 64-bit words of the sketch of a set
SKETCH = ("even", "odd")


def _sketches() -> list[Column]:
    """The parity sketch of ``words``, in two columns."""
    bit = "shiftleft(1L, cast(w & 63 as int))"
    return [F.expr(f"aggregate(words, 0L, (s, w) -> if((w & 64) = {64 * k}, s ^ {bit}, s))").alias(c) for k, c in enumerate(SKETCH)]


def _sets(docs: DataFrame, ranks: list[int], classes: DataFrame, ids: DataFrame, name: str) -> DataFrame:
    """``(cls, words)`` of some classes, from the texts of their first lines."""
    firsts = classes.join(ids, "cls").select(F.col("at.doc_id").alias("__id"), F.col("at.text_key").alias("__key"), F.col("at.line_no").alias("__no"), "cls").checkpoint()
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("text_key") == F.col("__key")) & (F.col("line_no") == F.col("__no"))
    chosen = raw_lines(docs).join(small(firsts, 48 * firsts.count()), same).select("cls", "line")
    sets = _stage(chosen.select("cls", numbered_words(F.col("line"), ranks).alias("words")), name)
    # rows that repeat a whole document repeat its lines
    return sets.dropDuplicates(["cls"]) if sets.count() > firsts.count() else sets


def _matches(pairs: DataFrame, docs: DataFrame, ranks: list[int], classes: DataFrame, t: float, name: str) -> DataFrame:
    """The ``later`` classes of those candidate pairs whose whole sets reach t."""
    pairs = pairs.distinct().checkpoint()
    ids = pairs.select(F.explode(F.array("later", "earlier")).alias("cls")).distinct()
    sets = _sets(docs, ranks, classes, ids, name)
    a = sets.select(F.col("cls").alias("later"), F.col("words").alias("a"))
    b = sets.select(F.col("cls").alias("earlier"), F.col("words").alias("b"))
    both = F.size(F.array_intersect("a", "b"))
    alike = both >= F.lit(t) * (F.size("a") + F.size("b") - both) - 1e-9
    return pairs.join(a, "later").join(b, "earlier").where(alike).select("later").distinct().checkpoint()


def removed_lines(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, text_key, line_no)`` of every line that matches an earlier line
    of any document (or its own) with a Jaccard similarity of ``threshold`` or more.
    What is staged on the way is released before this returns."""
    with _scratch(docs.sparkSession) as db:
        return _removed_lines(docs, threshold, db).checkpoint()


def _index_slice(classes: DataFrame, t: float, k: int, name: str) -> DataFrame:
    """Part ``k`` of the index: rows for tokens of classes' prefixes that other classes have
    too, with the group's earliest class where that may match (``pivot``); ``meets`` marks
    those that others than this class are still to be compared with."""
    n = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # order of classes by their first lines, as columns: a null doc_id is last, the class number breaks ties
    last = F.lit((1 << 63) - 1)
    order = F.coalesce(F.col("at.doc_id"), last).alias("doc"), F.col("at.line_no").alias("line_no"), "cls"
    tokens = classes.select(*order, "n", *SKETCH, F.posexplode("prefix").alias("p", "token"))
    # one shuffle by token serves the window and the buckets
    tokens = tokens.where(F.col("token").bitwiseAND(F.lit(SLICES - 1)) == k).repartition(n, "token")
    rank = F.shiftright("token", INDEX_BITS)
    salts = F.pow(F.lit(2), F.greatest(rank - (HOT_RANK - 1), F.lit(0))).cast("long")
    tokens = tokens.withColumn("salt", F.when(rank >= HOT_RANK, F.pmod(F.xxhash64("cls"), salts)).otherwise(F.lit(0)))
    group = Window.partitionBy("token", "salt")
    of = ("doc", "line_no", "cls", "n", "p", *SKETCH)
    tokens = tokens.withColumn("held", F.count(F.lit(1)).over(group)).withColumn("first", F.min(F.struct(*of)).over(group))
    easy = _fits(t, "", "first.") & (F.col("cls") != F.col("first.cls"))
    # every class has met the first of its group here: the join is for the others, and for groups that salt has parted
    meets = ((F.col("held") > 2) & (F.col("cls") != F.col("first.cls"))) | (rank >= HOT_RANK)
    tokens = tokens.select("token", *of, F.when(easy, F.col("first.cls")).alias("pivot"), meets.alias("meets"))
    return _bucketed(tokens.where("meets or pivot is not null"), "token", name)


def _hard_pairs(tokens: DataFrame, settled: DataFrame, t: float) -> DataFrame:
    """Candidate pairs of one part of the index: classes not settled yet with all earlier ones."""
    tokens = tokens.where("meets")
    left = tokens.withColumnRenamed("cls", "later").join(settled, "later", "left_anti").alias("l")
    # the size test comes first, as it drops most; places are compared by columns: a struct would be an object a pair
    after = F.lit(False)
    for x, y in (("l.later", "r.cls"), ("l.line_no", "r.line_no"), ("l.doc", "r.doc")):
        after = (F.col(x) > F.col(y)) | ((F.col(x) == F.col(y)) & after)
    hard = left.join(tokens.alias("r"), F.col("l.token") == F.col("r.token")).where(_fits(t, "l.", "r.") & after)
    tried = F.coalesce(F.col("l.pivot") == F.col("r.cls"), F.lit(False))
    return hard.where(~tried).select("later", F.col("r.cls").alias("earlier"))


def _removed_lines(docs: DataFrame, t: float, db: str) -> DataFrame:
    spark = docs.sparkSession
    ranks = rarity(docs)
    # the one pass that numbers all words: a line keeps its class (128 hash bits of its set), size and prefix
    h = [F.xxhash64("words").alias("h1"), F.xxhash64(F.lit(7), "words").alias("h2")]
    numbered = lines_of(docs, ranks).select("doc_id", "text_key", "line_no", *h, F.size("words").alias("n"), *_sketches(), _prefix(t).alias("prefix"))
    numbered = _stage(numbered, f"{db}.numbered")
    first = F.min(F.struct(_place().alias("at"), "n", *SKETCH, "prefix")).alias("f")
    classes = numbered.groupBy("h1", "h2").agg(first, F.count(F.lit(1)).alias("held"))
    classes = classes.select("h1", "h2", "held", "f.at", "f.n", *[f"f.{c}" for c in SKETCH], "f.prefix", F.monotonically_increasing_id().alias("cls"))
    classes = _stage(classes, f"{db}.classes")
    # sizes, sketches and prefixes are with the classes now; of a line its place is needed
    lines = _stage(numbered.select("doc_id", "text_key", "line_no", "h1", "h2"), f"{db}.lines")
    spark.sql(f"DROP TABLE {db}.numbered")

    index = [_index_slice(classes, t, k, f"{db}.tokens{k}") for k in range(SLICES)]
    easy = [x.where("pivot is not null").select(F.col("cls").alias("later"), F.col("pivot").alias("earlier")) for x in index]
    settled = _matches(reduce(DataFrame.unionByName, easy), docs, ranks, classes, t, f"{db}.easy")
    gone_already = small(settled, 16 * settled.count())
    hard = []
    for k, part in enumerate(index):  # a job each: all run the same generated code, and a part goes when its pairs are found
        hard.append(_hard_pairs(part, gone_already, t).distinct().checkpoint())
        spark.sql(f"DROP TABLE {db}.tokens{k}")
    more = _matches(reduce(DataFrame.unionByName, hard), docs, ranks, classes, t, f"{db}.hard")

    # every line of a class but its first goes, and the first of a class that matched an earlier one
    gone = settled.unionByName(more).select(F.col("later").alias("cls"), F.lit(True).alias("gone"))
    touched = classes.join(gone, "cls", "left").where("held > 1 or gone").select("h1", "h2", "at", F.coalesce("gone", F.lit(False)).alias("gone"))
    places = lines.select("h1", "h2", _place().alias("here"))
    out = places.join(touched, ["h1", "h2"]).where((F.col("here") != F.col("at")) | F.col("gone"))
    return out.select("here.doc_id", "here.text_key", "here.line_no").distinct()


def report(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, n_lines, n_removed, removed)`` for every row of ``docs(doc_id,
    text)``: ``removed`` lists the numbers (from 0) of the lines that go.

    Lines are what stands between line feeds; blank lines never match and always
    stay. Null texts have no lines, empty ones a blank line. Rows that repeat
    both doc_id and text are one document. Rows with a null doc_id come last in
    the order of lines. An empty table gives an empty result; extra columns are
    ignored.
    """
    text = F.col("text").cast("string")
    removed = removed_lines(docs, threshold).groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_list("line_no")).alias("removed"))
    removed = removed.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), "removed")
    keys = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), F.coalesce(F.size(F.split(text, "\n", -1)), F.lit(0)).alias("n"))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("text_key") == F.col("__key"))
    return keys.join(removed, same, "left").select(
        "doc_id",
        F.greatest("n", F.lit(0)).cast("long").alias("n_lines"),
        F.when(F.col("removed").isNull(), 0).otherwise(F.size("removed")).cast("long").alias("n_removed"),
        F.coalesce("removed", F.array().cast("array<int>")).alias("removed"),
    )


def dedup_lines(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with the later of matching lines taken out of the texts. A text
    that had words and has none left goes; all other rows and columns stay."""
    text = F.col("text").cast("string")
    removed = removed_lines(docs, threshold).groupBy("doc_id", "text_key").agg(F.collect_list("line_no").alias("__removed"))
    removed = removed.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), "__removed")
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64(text) == F.col("__key"))
    removed = removed.checkpoint()
    n = removed.agg(F.count(F.lit(1)), F.sum(F.size("__removed"))).first()
    joined = docs.join(small(removed, 48 * n[0] + 4 * (n[1] or 0)), same, "left")
    kept = F.array_join(F.filter(F.split(text, "\n", -1), lambda line, i: ~F.array_contains("__removed", i)), "\n")
    new = F.when(F.col("__removed").isNull(), text).otherwise(kept)
    out = joined.withColumn("__text", new).where(F.col("__removed").isNull() | (F.trim(F.regexp_replace("__text", r"\s+", " ")) != ""))
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        out = out.withColumn("n_chars", F.when(F.col("__removed").isNull(), F.col("n_chars")).otherwise(F.length("__text").cast(kind)))
    return out.withColumn("text", F.col("__text")).select(docs.columns)

