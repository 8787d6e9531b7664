"""Personal data by bootstrapped contextual extraction, in DataFrame functions only.

Four patterns find the base entities: e-mail and IP addresses, card and phone
numbers. Their whole spans are the seeds. Tokens in the shape of a key or
credential are seeds of a fifth kind, ``secret``, unless a word before them
names a digest; as their shape alone proves nothing, they are reported only
where a pattern marks them. The words around a seed are lexical patterns; all
identifier-like tokens, numbers written in groups of digits, and quoted values
after ``=`` or ``:`` that occur in the same contexts are instances. Spark scores the graph of
patterns and instances in rounds: a pattern by the share of its instances that
are believed to be of a kind, an instance by the patterns it occurs in. From the
second round on, believed instances count as seeds. Patterns that end with a
high score, on several distinct seeds, mark further identifiers that no base
pattern knows.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import text_or_empty

# Kinds in their order, and their patterns. Possessive repeats and
# the conditions on what stands before a match keep the search linear; they
# match what the plain patterns match, leftmost and without overlaps.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){15,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
OCTET = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
#: an identifier-like token: a run of 6 or more of these characters with a digit in it
TOKEN = r"(?<![A-Za-z0-9@._%+-])(?=[A-Za-z@._%+-]*+[0-9])[A-Za-z0-9@._%+-]{6,}+"
#: a number in groups: digits with blanks or brackets (and other separators) between them
GROUP = r"(?<![A-Za-z0-9@._%+-])[+(]{0,2}+[0-9]++(?:(?:[ .-]|\)[ .-]?+|[ .-]?+\()[0-9]++)++(?![A-Za-z0-9@_%])"
#: a quoted value after a key, of any characters
VALUE = r"""(?<=[:=]["']|[:=] ["'])[^\s"']{6,}+(?=["'])"""
#: other candidates than base matches
CANDIDATES = {"token": TOKEN, "group": GROUP, "value": VALUE}
#: shapes of keys and credentials: hexadecimal with digits and letters, or three classes of characters
SECRET = r"^(?:(?=[A-Fa-f]*[0-9])(?=[0-9]*[A-Fa-f])[0-9A-Fa-f]{32,}|(?=[^0-9]*[0-9])(?=[^a-z]*[a-z])(?=[^A-Z]*[A-Z])[A-Za-z0-9+/_=-]{24,})$"
#: words that name a digest of something, not a credential
DIGEST = r"commit|revision|sha|md5|hash|checksum|digest|etag|integrity|blob"
#: characters before and after an occurrence in which its context words are looked for
BEFORE, AFTER = 256, 128
#: what a text must contain to be searched for a kind
GATE = {"email": "@", "phone": "+"}


def _found(kind: str, pattern: str, text: Column) -> Column:
    """Array of (kind, gap before the match, match, words around), in order."""
    gate = text.contains(GATE[kind]) if kind in GATE else F.regexp_like(text, F.lit(pattern))
    parts, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), 0)
    empty = F.array().cast("array<struct<kind:string,gap:int,hit:string,left:string,right:string>>")
    zipped = F.arrays_zip(parts.alias("gap"), hits.alias("hit"), F.slice(parts, 2, 1_000_000_000).alias("next"))
    item = lambda x: F.struct(
        F.lit(kind).alias("kind"), F.length(x["gap"]).alias("gap"), x["hit"].alias("hit"),
        F.right(x["gap"], F.lit(BEFORE)).alias("left"), F.left(x["next"], F.lit(AFTER)).alias("right"),
    )
    return F.when(gate, F.filter(F.transform(zipped, item), lambda x: x["hit"].isNotNull())).otherwise(empty)


def occurrences(docs: DataFrame) -> DataFrame:
    """``(doc_id, text_key, kind, start, stop, hit, left, right)`` of all base
    matches that pass their checks, and of all candidates (kinds ``token``,
    ``group`` and ``value``). ``left`` and ``right`` are the lower-cased text around
    the span, other matches included, so one place has one context for seeds and
    candidates of every kind. Rows that repeat both doc_id and text count once."""
    text = text_or_empty()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).where(F.regexp_like("text", F.lit("""[0-9@]|[:=] ?["']""")))
    found = F.concat(*[_found(k, p, F.col("text")) for k, p in (PATTERNS | CANDIDATES).items()])
    rows = rows.select("doc_id", F.xxhash64("text").alias("text_key"), F.posexplode(found).alias("at", "x")).select("doc_id", "text_key", "at", "x.*")
    rows = rows.repartition("doc_id", "text_key").dropDuplicates(["doc_id", "text_key", "at"])
    run = Window.partitionBy("doc_id", "text_key", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    spans = rows.withColumn("stop", F.sum(F.col("gap") + F.length("hit")).over(run).cast("long")).withColumn("start", F.col("stop") - F.length("hit"))
    by = Window.partitionBy("doc_id", "text_key", "kind").orderBy("at")
    near = lambda f, c, k: F.coalesce(f(c, k).over(by), F.lit(""))
    left = F.concat(*[near(F.lag, c, k) for k in (3, 2, 1) for c in ("left", "hit")], "left")
    right = F.concat("right", *[near(F.lead, c, k) for k in (1, 2) for c in ("hit", "right")])
    spans = spans.withColumns({"left": F.lower(F.right(left, F.lit(BEFORE))), "right": F.lower(F.left(right, F.lit(AFTER)))})
    spans = spans.withColumn("digits", F.regexp_replace("hit", "[^0-9]", ""))
    n = F.length("digits")
    luhn = F.expr(
        "aggregate(sequence(1, length(digits)), 0, (s, i) -> s + int(substr(digits, -i, 1)) * (2 - i % 2)"
        " - if(i % 2 = 0 and substr(digits, -i, 1) > '4', 9, 0)) % 10 = 0"
    )
    right = (
        F.when(F.col("kind") == "ip", F.regexp_like("hit", F.lit(rf"^{OCTET}(?:\.{OCTET}){{3}}$")))
        .when(F.col("kind") == "card", n.between(16, 19) & luhn)
        .when(F.col("kind") == "phone", n.between(8, 15))
        .when(F.col("kind") == "group", n.between(6, 19) & F.regexp_like("hit", F.lit("[ ()]")))
        .otherwise(True)
    )
    return spans.where(right).select("doc_id", "text_key", "kind", "start", "stop", "hit", "left", "right")


def _words(tokens: DataFrame) -> DataFrame:
    """Add the words ``l`` before and ``r`` after each occurrence; a word that the
    window of characters cuts is none."""
    l, r = F.split(F.trim("left"), r"\s+"), F.split(F.trim("right"), r"\s+")
    l = F.when(F.length("left") >= BEFORE, F.slice(l, F.lit(2), F.size(l))).otherwise(l)
    r = F.when(F.length("right") >= AFTER, F.slice(r, F.lit(1), F.size(r) - 1)).otherwise(r)
    return tokens.withColumns({"l": F.slice(l, F.greatest(F.size(l) - 2, F.lit(1)), F.lit(3)), "r": F.slice(r, 1, 1)}).drop("left", "right")


def _contexts(tokens: DataFrame) -> DataFrame:
    """Explode each occurrence into its lexical patterns: the word before, the two and
    the three words before, the words on both sides. One without a letter is none."""
    word = lambda a, k: F.get(F.col(a), F.lit(k) if k >= 0 else F.size(a) + k)
    before, after = word("l", -1), word("r", 0)
    two = F.when(F.size("l") > 1, F.concat_ws(" ", word("l", -2), before))
    three = F.when(F.size("l") > 2, F.concat_ws(" ", "l"))
    both = F.when((before != "") & (after != ""), F.concat_ws(" _ ", before, after))
    patterns = [F.concat(F.lit("1:"), F.when(before != "", before)), F.concat(F.lit("2:"), two), F.concat(F.lit("3:"), three), F.concat(F.lit("b:"), both)]
    lexical = F.filter(F.array(*patterns), lambda p: F.regexp_like(p, F.lit(r"^[123b]:.*\p{L}")))
    return tokens.withColumn("pattern", F.explode(lexical)).drop("l", "r")


def bootstrap(tokens: DataFrame, rounds: int = 3, min_seeds: int = 3, doubt: float = 2.0, min_belief: float = 0.5) -> DataFrame:
    """``(pattern, kind, score, seeds)`` of the lexical patterns next to seeds.

    ``tokens(hit, seed, pattern)``: instances, the base kind of each (null if
    unknown) and a pattern it occurs in. Edges are made distinct before they are
    scored, so a context that occurs everywhere is one row per different token.
    A pattern is scored in the rounds in which it has ``min_seeds`` instances that
    are seeds or believed with ``min_belief``.
    """
    edges = tokens.groupBy("pattern", "hit").agg(F.max("seed").alias("seed"))
    # patterns with fewer instances never have enough seeds
    sizes = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_seeds)
    edges = edges.join(sizes, "pattern").checkpoint()
    known = edges.where("seed is not null").groupBy("hit", F.col("seed").alias("kind")).agg(F.lit(1.0).alias("belief"))
    belief, scores = known, None
    for k in range(rounds):
        believed = belief.groupBy("hit").agg(F.collect_list(F.struct("kind", "belief")).alias("b"), F.max("belief").alias("most"))
        per = edges.select("pattern", "hit", "n").join(believed, "hit")
        seeds = per.groupBy("pattern").agg(F.count(F.when(F.col("most") >= min_belief, 1)).alias("seeds")).where(F.col("seeds") >= min_seeds)
        sums = per.select("pattern", "n", F.inline("b")).groupBy("pattern", "kind").agg(F.sum("belief").alias("sum"), F.max("n").alias("n"))
        scores = sums.join(seeds, "pattern").select("pattern", "kind", (F.col("sum") / (F.col("n") + doubt)).alias("score"), "seeds").checkpoint()
        if k + 1 < rounds:
            # an unknown instance: noisy-or over its patterns; seeds stay certain
            unknown = edges.where("seed is null").select("pattern", "hit").join(scores, "pattern")
            guess = unknown.groupBy("hit", "kind").agg((0.9 * (1 - F.exp(F.sum(F.log(1 - F.least("score", F.lit(0.999))))))).alias("belief"))
            belief = known.unionByName(guess).groupBy("hit", "kind").agg(F.max("belief").alias("belief"))
    return scores


def extract(docs: DataFrame, rounds: int = 3, min_seeds: int = 3, min_score: float = 0.5) -> DataFrame:
    """Spans ``(doc_id, text_key, kind, start, stop)``: base kinds, and ``ctx_<kind>``
    for candidates outside base spans that a pattern of that kind with ``min_score``
    marks (a ``secret`` seed only by patterns of its own kind); of candidates inside
    one another, the outer one."""
    all_ = occurrences(docs).checkpoint()  # the texts are read once
    is_base = F.col("kind").isin(*KINDS)
    base = all_.where(is_base).select("doc_id", "text_key", "kind", "start", "stop")
    # what overlaps a base span is part of that instance, as is a base span inside another
    back = Window.partitionBy("doc_id", "text_key").orderBy("start", F.desc("stop"), F.when(is_base, 0).otherwise(1), "kind").rowsBetween(Window.unboundedPreceding, -1)
    ahead = Window.partitionBy("doc_id", "text_key").orderBy(F.desc("start"), F.when(is_base, 0).otherwise(1)).rowsBetween(Window.unboundedPreceding, 0)
    swept = all_.withColumn("last", F.max(F.when(is_base, F.col("stop"))).over(back)).withColumn("next", F.min(F.when(is_base, F.col("start"))).over(ahead))
    apart = F.coalesce(F.col("last") <= F.col("start"), F.lit(True)) & F.coalesce(F.col("next") >= F.col("stop"), F.lit(True))
    within = F.coalesce(F.col("last") >= F.col("stop"), F.lit(False))
    instances = swept.where(F.when(is_base, ~within).otherwise(apart))
    secret = F.regexp_like("hit", F.lit(SECRET)) & ~F.regexp_like(F.concat_ws(" ", "l"), F.lit(DIGEST))
    instances = _words(instances).withColumn("seed", F.when(is_base, F.col("kind")).when(secret, F.lit("secret")))
    placed = _contexts(instances.select("doc_id", "text_key", "start", "stop", F.lower("hit").alias("hit"), "l", "r", "seed")).checkpoint()
    good = bootstrap(placed, rounds, min_seeds).where(F.col("score") >= min_score)
    best = good.groupBy("pattern").agg(F.max(F.struct("score", "kind")).alias("b")).withColumn("seed", F.lit(None).cast("string"))
    best = best.unionByName(good.where("kind = 'secret'").select("pattern", F.struct("score", "kind").alias("b"), F.lit("secret").alias("seed")))
    marked = placed.where("seed is null or seed = 'secret'").join(best.withColumnRenamed("seed", "__seed"), "pattern").where(F.col("seed").eqNullSafe(F.col("__seed")))
    new = marked.groupBy("doc_id", "text_key", "start", "stop").agg(F.max("b").alias("b"))
    outer = Window.partitionBy("doc_id", "text_key").orderBy("start", F.desc("stop")).rowsBetween(Window.unboundedPreceding, -1)
    new = new.withColumn("reach", F.max("stop").over(outer)).where("reach is null or reach < stop")
    return base.unionByName(new.select("doc_id", "text_key", F.concat(F.lit("ctx_"), F.col("b.kind")).alias("kind"), "start", "stop"))


def find(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans)`` for every
    row of ``docs(doc_id, text)``.

    Offsets are code points, ends exclusive. Null texts count as empty. Repeated
    rows get equal answers, rows with a null doc_id are searched like any other,
    extra columns are ignored.
    """
    order = {k: i for i, k in enumerate([*KINDS, *(f"ctx_{k}" for k in (*KINDS, "secret"))])}
    number = F.create_map(*[x for k, i in order.items() for x in (F.lit(k), F.lit(i))])
    spans = extract(docs).select("doc_id", "text_key", number[F.col("kind")].alias("no"), "kind", "start", "stop")
    per_doc = spans.groupBy("doc_id", "text_key").agg(
        *[F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{k}") for k in KINDS],
        F.array_sort(F.collect_list(F.struct("no", "start", "stop", "kind"))).alias("s"),
    )
    write = lambda a: F.array_join(F.transform(a, lambda x: F.concat_ws(":", x["kind"], x["start"], x["stop"])), ",")
    per_doc = per_doc.select(
        F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), *[f"n_{k}" for k in KINDS],
        write(F.filter("s", lambda x: x["no"] < len(KINDS))).alias("base"), write(F.col("s")).alias("all"),
    )
    keys = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_or_empty()).alias("text_key"))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("text_key") == F.col("__key"))
    return keys.join(per_doc, same, "left").select(
        "doc_id", *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"), F.coalesce("all", F.lit("")).alias("spans"),
    )


