"""License scans with ordered signature rules, in DataFrame functions only.

A rule has a keyword, a pattern, a label, a priority and a weight. A text is
tested only against the rules whose keyword it contains. A blank in a keyword or
pattern stands for any separator: white space, also broken over lines with
comment signs. Detections that lie
inside a detection of the same or a higher priority are suppressed. Besides the
rules, three base phrases are located by word, and always kept.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import text_or_empty

#: a word's characters, and all others, before lower-casing A-Z
W = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
S = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"

# Base phrases and their labels.
BASE = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

#: white space; with comment signs where it breaks over lines, at the end of a line and at the start of the next
BLANK, BREAK, SIGNS = r" \t\x0B\f\xA0", r"\r\n", r"*#/;%!|>-"
SEP = rf"(?>(?=[{BLANK}{BREAK}])(?:[{BLANK}]*+(?:[{SIGNS}]++[{BLANK}]*+)?+[{BREAK}][{BLANK}{BREAK}{SIGNS}]*+|[{BLANK}]++))"
#: a separator that is not one plain blank between words
FOLD = rf"(?! [^{BLANK}{BREAK}{SIGNS}]){SEP}"

EXACT, FAMILY, GENERIC = 3, 2, 1  # priorities


def separated(pattern: str) -> str:
    """The pattern with each blank, also one in a character class, as ``SEP``."""
    classes = re.sub(r"(?<!\\)\[(\^?[^\]]*)\]", lambda m: rf"(?:[{m[1].replace(' ', '')}]| )" if " " in m[1] else m[0], pattern)
    return classes.replace(" ", SEP)


@dataclass(frozen=True)
class Rule:
    label: str
    keyword: str  # lower case; the text must contain it, with any separators
    pattern: str  # Java regex, matched without regard to ASCII case
    priority: int
    weight: float


def _version(v: str) -> str:
    """Ways to write a version: '2', 'v2', 'version 2.0', ', version 2'."""
    tail = v.replace(".", r"\.") + (r"(?:\.0)?" if "." not in v else "")
    return rf"[ ,(-]*(?:v|ver\.?|version)?[ .]?{tail}(?![\d.]*\d)"


# Fixed values: (SPDX family, keyword, name pattern, versions). Each version of
# a family gives one rule for the written name and one for the SPDX identifier.
VERSIONED = (
    ("AFL", "academic free", r"academic free licen[cs]e", "1.1 1.2 2.0 2.1 3.0"),
    ("AGPL", "affero", r"(?:gnu )?affero general public licen[cs]e", "1.0 3.0"),
    ("APSL", "apple public", r"apple public source licen[cs]e", "1.0 1.1 1.2 2.0"),
    ("Apache", "apache", r"apache(?: software)? licen[cs]e", "1.0 1.1 2.0"),
    ("Artistic", "artistic", r"artistic licen[cs]e", "1.0 2.0"),
    ("BSL", "boost", r"boost software licen[cs]e", "1.0"),
    ("BUSL", "business source", r"business source licen[cs]e", "1.1"),
    ("BitTorrent", "bittorrent", r"bittorrent open source licen[cs]e", "1.0 1.1"),
    ("CAL", "cryptographic autonomy", r"cryptographic autonomy licen[cs]e", "1.0"),
    ("CATOSL", "computer associates", r"computer associates trusted open source licen[cs]e", "1.1"),
    ("CDDL", "common development", r"common development and distribution licen[cs]e", "1.0 1.1"),
    ("CDLA-Permissive", "community data", r"community data licen[cs]e agreement(?:.{1,3}| ?.? )permissive", "1.0 2.0"),
    ("CECILL", "cecill", r"cecill(?: free software)? licen[cs]e", "1.0 1.1 2.0 2.1"),
    ("CERN-OHL", "cern", r"cern open hardware licen[cs]e", "1.1 1.2 2.0"),
    ("CPAL", "common public attribution", r"common public attribution licen[cs]e", "1.0"),
    ("CPL", "common public licen", r"common public licen[cs]e", "0.5 1.0"),
    ("ECL", "educational community", r"educational community licen[cs]e", "1.0 2.0"),
    ("EFL", "eiffel", r"eiffel forum licen[cs]e", "1.0 2.0"),
    ("EPL", "eclipse", r"eclipse public licen[cs]e", "1.0 2.0"),
    ("EUDatagrid", "eu datagrid", r"eu datagrid software licen[cs]e", "2.0"),
    ("EUPL", "european union public", r"european union public licen[cs]e", "1.0 1.1 1.2"),
    ("Elastic", "elastic", r"elastic licen[cs]e", "1.0 2.0"),
    ("GFDL", "free documentation", r"(?:gnu )?free documentation licen[cs]e", "1.1 1.2 1.3"),
    ("GPL", "general public", r"(?:gnu )?general public licen[cs]e", "1.0 2.0 3.0"),
    ("IPL", "ibm public", r"ibm public licen[cs]e", "1.0"),
    ("LGPL", "general public", r"(?:gnu )?(?:lesser|library) general public licen[cs]e", "2.0 2.1 3.0"),
    ("LPL", "lucent", r"lucent public licen[cs]e", "1.0 1.02"),
    ("LPPL", "latex project", r"latex project public licen[cs]e", "1.0 1.1 1.2 1.3"),
    ("LiLiQ-P", "liliq", r"liliq-p", "1.1"),
    ("MPL", "mozilla", r"mozilla public licen[cs]e", "1.0 1.1 2.0"),
    ("MulanPSL", "mulan", r"mulan permissive software licen[cs]e", "1.0 2.0"),
    ("NPL", "netscape", r"netscape public licen[cs]e", "1.0 1.1"),
    ("NPOSL", "non-profit open", r"non-profit open software licen[cs]e", "3.0"),
    ("OCLC", "oclc", r"oclc research public licen[cs]e", "2.0"),
    ("ODC-By", "open data commons", r"open data commons attribution licen[cs]e", "1.0"),
    ("ODbL", "open database", r"open database licen[cs]e", "1.0"),
    ("OFL", "open font", r"(?:sil )?open font licen[cs]e", "1.0 1.1"),
    ("OLDAP", "openldap", r"openldap public licen[cs]e", "1.1 2.0 2.4 2.7 2.8"),
    ("OSL", "open software licen", r"open software licen[cs]e", "1.0 1.1 2.0 2.1 3.0"),
    ("PDDL", "public domain dedication", r"public domain dedication and licen[cs]e", "1.0"),
    ("PHP", "php licen", r"php licen[cs]e", "3.0 3.01"),
    ("PolyForm-Noncommercial", "polyform", r"polyform noncommercial licen[cs]e", "1.0.0"),
    ("Python", "python", r"python software foundation licen[cs]e", "2.0"),
    ("QPL", "q public", r"q public licen[cs]e", "1.0"),
    ("RPL", "reciprocal public", r"reciprocal public licen[cs]e", "1.1 1.5"),
    ("RPSL", "realnetworks", r"realnetworks public source licen[cs]e", "1.0"),
    ("SGI-B", "sgi free", r"sgi free software licen[cs]e b", "1.0 1.1 2.0"),
    ("SPL", "sun public", r"sun public licen[cs]e", "1.0"),
    ("SSPL", "server side public", r"server side public licen[cs]e", "1.0"),
    ("UPL", "universal permissive", r"universal permissive licen[cs]e", "1.0"),
    ("VSL", "vovida", r"vovida software licen[cs]e", "1.0"),
    ("Watcom", "watcom", r"sybase open watcom public licen[cs]e", "1.0"),
    ("ZPL", "zope", r"zope public licen[cs]e", "1.1 2.0 2.1"),
)

# Fixed values: (label, keyword, pattern) of licenses known by one wording.
SINGLE = (
    ("0BSD", "bsd", r"(?:zero-clause bsd|bsd zero clause licen[cs]e|\b0bsd\b)"),
    ("BSD-1-Clause", "bsd", r"(?:1-clause bsd|bsd[- ]1[- ]clause)"),
    ("BSD-2-Clause", "bsd", r"(?:2-clause bsd|bsd[- ]2[- ]clause|simplified bsd|freebsd licen[cs]e)"),
    ("BSD-3-Clause", "bsd", r"(?:3-clause bsd|bsd[- ]3[- ]clause|(?:new|revised|modified) bsd)"),
    ("BSD-4-Clause", "bsd", r"(?:4-clause bsd|bsd[- ]4[- ]clause|original bsd)"),
    ("BSD-3-Clause", "endorse or promote", r"may be used to endorse or promote products derived from this software"),
    ("BSD-2-Clause", "redistributions of source", r"redistributions of source code must retain the above copyright notice"),
    ("BSD-4-Clause", "advertising materials", r"all advertising materials mentioning features or use of this software"),
    ("Beerware", "beer", r"beer-?ware licen[cs]e"),
    ("BlueOak-1.0.0", "blue oak", r"blue oak model licen[cs]e"),
    ("CC0-1.0", "cc0", r"\bcc0(?:[ -]1\.0)?\b"),
    ("CC0-1.0", "creative commons zero", r"creative commons zero(?:[ ,]*v?1\.0)?"),
    ("Commons-Clause", "commons clause", r"commons clause(?: licen[cs]e condition)?"),
    ("FTL", "freetype", r"freetype (?:project )?licen[cs]e"),
    ("HPND", "historical permission", r"historical permission notice and disclaimer"),
    ("ICU", "icu licen", r"icu licen[cs]e"),
    ("IJG", "independent jpeg", r"independent jpeg group"),
    ("ISC", "isc licen", r"\bisc licen[cs]e"),
    ("ISC", "permission to use, copy", r"permission to use, copy, modify,? and/?o?r? distribute this software"),
    ("JSON", "used for good", r"shall be used for good, not evil"),
    ("Libpng", "libpng", r"libpng licen[cs]e"),
    ("MIT", "mit", r"\bmit(?:/expat)? licen[cs]e"),
    ("MIT", "expat", r"expat licen[cs]e"),
    ("MIT", "free of charge", r"permission is hereby granted, free of charge"),
    ("MIT-0", "mit", r"mit no attribution"),
    ("MS-PL", "microsoft public", r"microsoft public licen[cs]e"),
    ("MS-RL", "microsoft reciprocal", r"microsoft reciprocal licen[cs]e"),
    ("NCSA", "ncsa", r"(?:university of illinois/)?ncsa open source licen[cs]e"),
    ("OpenRAIL", "rail", r"(?:bigscience |creativeml )?open ?rail(?:-m)?(?: licen[cs]e)?"),
    ("OpenSSL", "openssl", r"openssl licen[cs]e"),
    ("PostgreSQL", "postgresql", r"postgresql licen[cs]e"),
    ("Ruby", "ruby", r"\bruby licen[cs]e"),
    ("Sleepycat", "sleepycat", r"sleepycat licen[cs]e"),
    ("Unicode-DFS", "unicode", r"unicode licen[cs]e agreement"),
    ("Unlicense", "unlicense", r"\bunlicense\b"),
    ("Unlicense", "unencumbered", r"free and unencumbered software released into the public domain"),
    ("Vim", "vim licen", r"\bvim licen[cs]e"),
    ("W3C", "w3c", r"w3c(?: software(?: notice and)?)? licen[cs]e"),
    ("WTFPL", "wtfpl", r"\bwtfpl\b"),
    ("X11", "x11", r"\bx11 licen[cs]e"),
    ("Zlib", "zlib", r"zlib(?:/libpng)? licen[cs]e"),
    ("bzip2", "bzip2", r"bzip2(?: and libbzip2)? licen[cs]e"),
    ("curl", "curl licen", r"\bcurl licen[cs]e"),
)

# Fixed values: (label, keyword, pattern) of general notices.
NOTICES = (
    ("copyright", "copyright", r"copyright(?: \(c\)| ©)? ?(?:19|20)\d\d"),
    ("copyright", "copyright", r"copyright (?:notice|holders?|owner)"),
    ("public-domain", "public domain", r"public domain"),
    ("proprietary", "proprietary", r"proprietary and confidential"),
    ("proprietary", "prior written", r"without (?:the )?(?:express |prior )*written (?:permission|consent)"),
    ("reserved", "rights reserved", r"(?:all|some|no) rights reserved"),
    ("terms", "terms of use", r"terms of use"),
    ("licensed", "licensed under", r"licensed under the terms of"),
)

# Creative Commons elements and versions.
CC_ELEMENTS = ("by", "by-sa", "by-nd", "by-nc", "by-nc-sa", "by-nc-nd")
CC_WORDS = {"by": "attribution", "sa": "share ?-?alike", "nd": "no ?-?deriv(?:ative)?s?(?: works)?", "nc": "non ?-?commercial"}
CC_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")


def rules() -> list[Rule]:
    """All rules, several hundred, from the tables above."""
    out = []
    for family, keyword, name, versions in VERSIONED:
        out.append(Rule(family, keyword, name, FAMILY, 0.8))
        for v in versions.split():
            # the short and the long way of a version: 2 and 2.0
            short = v.removesuffix(".0") if v.count(".") == 1 else v
            spdx = f"{family}-{v}"
            out.append(Rule(spdx, keyword, name + _version(short), EXACT, 0.95))
            out.append(Rule(spdx, family.lower(), rf"\b{family.lower()}[- ]?v?{short.replace('.', r'[.]')}(?:\.0)?\b", EXACT, 0.9))
            if family in ("AGPL", "GFDL", "GPL", "LGPL"):
                later = rf"(?:[ ,]*(?:of the licen[cs]e)?[ ,]*or (?:\(at your option\) )?(?:any )?later|\+)"
                out.append(Rule(f"{spdx}-or-later", keyword, name + _version(short) + later, EXACT, 0.95))
                out.append(Rule(f"{spdx}-or-later", family.lower(), rf"\b{family.lower()}[- ]?v?{short.replace('.', r'[.]')}(?:\.0)?(?:\+|-or-later)", EXACT, 0.9))
    for e in CC_ELEMENTS:
        words = "[ -]+".join(CC_WORDS[x] for x in e.split("-"))
        shorts = "[ -]".join(e.split("-"))
        end = r"(?![ -](?:sa|nd|nc)\b)"
        out.append(Rule(f"CC-{e.upper()}", "cc", rf"\bcc[ -]{shorts}\b{end}", FAMILY, 0.8))
        out.append(Rule(f"CC-{e.upper()}", "creative commons", rf"creative commons {words}", FAMILY, 0.8))
        for v in CC_VERSIONS:
            number = v.replace(".", r"\.")
            out.append(Rule(f"CC-{e.upper()}-{v}", "cc", rf"\bcc[ -]{shorts}[ -]v?{number}", EXACT, 0.9))
            out.append(Rule(f"CC-{e.upper()}-{v}", "creative commons", rf"creative commons {words}[ ,]*(?:licen[cs]e,? )?(?:version )?{number}", EXACT, 0.95))
    out += [Rule(a, k, p, EXACT, 0.9) for a, k, p in SINGLE]
    out += [Rule(a, k, p, GENERIC, 0.5) for a, k, p in NOTICES]
    spdx = sorted({r.label for r in out if r.priority == EXACT})
    out += [Rule(x, "spdx-license-identifier", rf"spdx-license-identifier: ?{x.replace('.', '[.]').replace('+', '[+]')}(?![\w.+-])", EXACT, 1.0) for x in spdx]
    return [replace(r, pattern=separated(r.pattern)) for r in out]


def base_pattern() -> str:
    phrases = "|".join(f"{S}+".join(p.split()) for p in BASE)
    return f"(?i)(?<!{W})(?:{phrases})(?!{W})"


def word_count(text: Column) -> Column:
    """Words of a whole text: the pieces between separators, but for empty ones at either end."""
    empty = lambda p: F.when(p == "", 1).otherwise(0)
    count = lambda p: F.size(p) - empty(F.element_at(p, 1)) - empty(F.element_at(p, -1))
    pieces = F.array(F.split(text, f"{S}++", -1))
    return F.greatest(F.get(F.transform(pieces, count), F.lit(0)), F.lit(0)).cast("long")


def base_columns(text: Column) -> list[Column]:
    """``n_words`` and the base matches with the text parts around them; gated by
    words that every base phrase needs."""
    low = F.lower(text)
    gate = F.lit(False)
    for p in BASE:
        one = F.lit(True)
        for w in p.split():
            one = one & low.contains(w)
        gate = gate | one
    return [
        word_count(text).alias("n_words"),
        F.when(gate, F.regexp_extract_all(text, F.lit(base_pattern()), 0)).alias("found"),
        F.when(gate, F.split(text, base_pattern(), -1)).alias("parts"),
    ]


def _rule_table(spark: SparkSession) -> DataFrame:
    rows = [(r.keyword, "(?i)" + r.pattern, r.label.lower(), r.priority, r.weight) for r in rules()]
    return spark.createDataFrame(rows, "keyword string, pattern string, label string, priority int, weight double")


#: characters of a stem of the keyword gate
STEM = 3


def stems(keywords: list[str]) -> dict[str, list[str]]:
    """A small set of short pieces such that every keyword holds one, with the
    keywords of each: the piece that most keywords still without one share comes next."""
    left, out = set(keywords), {}
    while left:
        holders: dict[str, set[str]] = {}
        for k in left:
            for i in range(max(1, len(k) - STEM + 1)):
                holders.setdefault(k[i : i + STEM], set()).add(k)
        piece = max(holders, key=lambda s: (len(holders[s]), s))
        out[piece] = sorted(holders[piece])
        left -= holders[piece]
    return out


def _held(low: Column, keywords: list[str]) -> Column:
    """The keywords a folded text holds: it is searched for the stems, and for the keywords of the stems found."""
    table = json.dumps([{"stem": s, "keywords": k} for s, k in stems(keywords).items()])
    found = F.filter(F.from_json(F.lit(table), "array<struct<stem:string,keywords:array<string>>>"), lambda x: F.contains(low, x["stem"]))
    return F.filter(F.flatten(F.transform(found, lambda x: x["keywords"])), lambda k: F.contains(low, k))


def detections(docs: DataFrame) -> DataFrame:
    """Rule detections that survive suppression: ``(doc_id, text_key, start, stop,
    label, priority, weight)``, in characters, stop exclusive. Rows that repeat
    both doc_id and text count once."""
    spark = docs.sparkSession
    rules_of = _rule_table(spark)
    keywords = sorted({r.keyword for r in rules()})
    text = text_or_empty()
    low = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.regexp_replace(F.lower(text), FOLD, " ").alias("low"))
    gated = low.select("doc_id", "text", F.explode(_held(F.col("low"), keywords)).alias("keyword"))
    # the rule table has a few hundred rows, whatever the input
    tried = gated.join(F.broadcast(rules_of), "keyword").where(F.regexp_like("text", F.col("pattern")))
    lengths = tried.select(
        "doc_id", F.xxhash64("text").alias("text_key"), "pattern", "label", "priority", "weight",
        F.posexplode(
            F.arrays_zip(
                F.transform(F.split("text", F.col("pattern"), -1), F.length).alias("gap"),
                F.transform(F.regexp_extract_all("text", F.col("pattern"), F.lit(0)), F.length).alias("size"),
            )
        ).alias("at", "x"),
    ).select("doc_id", "text_key", "pattern", "label", "priority", "weight", "at", "x.gap", "x.size")
    lengths = lengths.where("size is not null").dropDuplicates(["doc_id", "text_key", "pattern", "at"])
    run = Window.partitionBy("doc_id", "text_key", "pattern").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    spans = lengths.withColumn("stop", F.sum(F.col("gap") + F.col("size")).over(run)).withColumn("start", F.col("stop") - F.col("size"))
    earlier = (
        Window.partitionBy("doc_id", "text_key")
        .orderBy("start", F.desc("stop"), F.desc("priority"), F.desc("weight"), "label", "pattern")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    reach = {p: F.max(F.when(F.col("priority") >= p, F.col("stop"))).over(earlier) for p in (EXACT, FAMILY, GENERIC)}
    outer = F.when(F.col("priority") == EXACT, reach[EXACT]).when(F.col("priority") == FAMILY, reach[FAMILY]).otherwise(reach[GENERIC])
    return (
        spans.withColumn("outer", outer)
        .where("outer is null or outer < stop")
        .select("doc_id", "text_key", F.col("start").cast("long").alias("start"), F.col("stop").cast("long").alias("stop"), "label", "priority", "weight")
    )


def scan(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score, spans)`` for every row of ``docs(doc_id, text)``.

    ``score`` is the largest weight of a detection (0.5 for a base phrase
    alone, 0 for none); ``spans`` the surviving detections. Null texts count as
    empty. Repeated rows get equal answers; rows with a null doc_id are scanned
    like any other; extra columns are ignored.
    """
    text = text_or_empty()
    per_doc = (
        detections(docs)
        .groupBy("doc_id", "text_key")
        .agg(
            F.collect_set("label").alias("rule_labels"),
            F.max("weight").alias("weight"),
            F.array_sort(F.collect_list(F.struct("start", "stop", "label"))).alias("spans"),
        )
        .select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), "rule_labels", "weight", "spans")
    )
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), *base_columns(text))
    n = F.coalesce(F.size("found"), F.lit(0))
    n = F.when(n > 0, n).otherwise(F.lit(0))
    words = lambda c: F.regexp_count(c, F.lit(f"{W}+")).cast("long")
    of = lambda x: F.when(F.lower(F.left(x, F.lit(1))) == "c", F.lit("cc-by")).when(F.lower(F.left(x, F.lit(1))) == "g", F.lit("gpl")).otherwise(F.lit("reserved"))
    base = base.select(
        "doc_id", "text_key", "n_words",
        n.cast("long").alias("n_base"),
        F.when(n > 0, words(F.element_at("parts", 1))).alias("first_word"),
        F.when(n > 0, F.col("n_words") - words(F.element_at("parts", -1)) - words(F.element_at("found", -1))).alias("last_word"),
        F.when(n > 0, F.array_sort(F.array_distinct(F.transform("found", of)))).otherwise(F.array().cast("array<string>")).alias("base"),
    )
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("text_key") == F.col("__key"))
    no_labels = F.array().cast("array<string>")
    return base.join(per_doc, same, "left").select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", F.coalesce("rule_labels", no_labels))), ",").alias("labels"),
        F.greatest(F.coalesce("weight", F.lit(0.0)), F.when(F.col("n_base") > 0, 0.5).otherwise(0.0)).alias("score"),
        "spans",
    )
