import hashlib
import random
import re

from helpers import collect, docs, empty_docs, odd_docs, prose

from docweave.llm import licenses as L
from docweave.llm import pii as P

BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


def brute_base(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    starts, labels = [], set()
    for phrase, label in BASE.items():
        p = phrase.split()
        for i in range(len(w) - len(p) + 1):
            if w[i : i + len(p)] == p:
                starts.append(i)
                labels.add(label)
    return len(w), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def license_texts():
    rng = random.Random(4)
    out = [None, "", "cc by", "CC-BY cc by, ccby xcc by", "cc cc by by", "All. Rights\n\nRESERVED! all rights reserved", "ñall rights reserved", "all rights reservedé"]
    out += ["Licensed under the Apache License, Version 2.0.", "This work is licensed under the GNU General Public License, version 3.", "Released under the MIT License."]
    out += ["CC BY-NC-SA 4.0 and cc-by 3.0", "SPDX-License-Identifier: MPL-2.0", "gpl-2.0-or-later", "GNU Lesser General Public License v2.1 or any later version"]
    bits = ["cc", "by", "general", "public", "license", "all", "rights", "reserved", "x", "é"]
    for _ in range(60):
        out.append(rng.choice([" ", "-", ", "]).join(rng.choice(bits) for _ in range(rng.randrange(1, 60))))
    return out


def test_licenses_base(spark):
    texts = license_texts()
    got = {r["doc_id"]: r for r in collect(L.scan(docs(spark, texts)))}
    for i, t in enumerate(texts):
        r = got[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute_base(t), t
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
        assert r["labels"].split(",") == sorted(set(r["labels"].split(",")))


def test_license_rules():
    rules = L.rules()
    assert len(rules) >= 300 and len({r.pattern for r in rules}) > 290
    for r in rules:
        re.compile(r.pattern)
        assert r.keyword == r.keyword.lower() and 0 < r.weight <= 1


def brute_detections(text):
    spans = []
    for r in L.rules():
        if r.keyword in text.lower():
            spans += [(m.start(), m.end(), r.label.lower(), r.priority, r.weight, "(?i)" + r.pattern) for m in re.finditer(r.pattern, text, re.I | re.A)]
    spans.sort(key=lambda s: (s[0], -s[1], -s[3], -s[4], s[2], s[5]))
    return sorted(s[:3] for k, s in enumerate(spans) if not any(o[1] >= s[1] and o[3] >= s[3] for o in spans[:k]))


def test_license_detections(spark):
    texts = [t for t in license_texts() if t]
    got = {i: [] for i in range(len(texts))}
    for r in collect(L.detections(docs(spark, texts))):
        got[r["doc_id"]].append((r["start"], r["stop"], r["label"]))
    for i, t in enumerate(texts):
        assert sorted(got[i]) == brute_detections(t), t
    labels = {t: {x[2] for x in brute_detections(t)} for t in texts}
    assert labels["Licensed under the Apache License, Version 2.0."] == {"apache-2.0"}
    assert labels["This work is licensed under the GNU General Public License, version 3."] == {"gpl-3.0"}
    assert labels["SPDX-License-Identifier: MPL-2.0"] == {"mpl-2.0"}


def plain_base(text):
    """The contract's patterns, read plainly; code point offsets."""
    text = text or ""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((0, m.start(), m.end(), "email"))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append((1, m.start(), m.end(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()]
        odd = [x * 2 - 9 * (x > 4) if k % 2 else x for k, x in enumerate(reversed(d))]
        if 16 <= len(d) <= 19 and sum(odd) % 10 == 0:
            out.append((2, m.start(), m.end(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append((3, m.start(), m.end(), "phone"))
    return [f"{k}:{a}:{z}" for _, a, z, k in sorted(out)]


def pii_texts():
    rng = random.Random(6)
    out = [
        None, "", "é😀 a.b+c@d-e.co.uk x@y z@@q.r a@b.c_d@e.f", "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.255 1.2.3", "4111 1111 1111 1111", "4111-1111-1111-1111 9",
        "x4111111111111111y 41111111111111111111 5 4111111111111111", "+1 (771) 555-1655 On +123 +1.2.3.4.5.6.7.8.9.10.11.12.13.14", "mail a@b.com.", "a@b.c@d.e",
        "1" * 3000 + " " + "a" * 3000 + "@b.c", "0000 0000 0000 0000", "12--34 4111 1111  1111 1111", "+1 2 3 4 5 6 7 8 ", "++49 30 1234567-",
    ]
    alphabet = "0123456789" * 3 + "ab@.+- ()é"
    for _ in range(300):
        out.append("".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 120))))
    return out


def test_pii_base(spark):
    texts = pii_texts()
    got = {r["doc_id"]: r for r in collect(P.find(docs(spark, texts)))}
    for i, t in enumerate(texts):
        want = plain_base(t)
        spans = [s for s in got[i]["spans"].split(",") if s]
        assert [s for s in spans if not s.startswith("ctx_")] == want, t
        assert got[i]["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [got[i][f"n_{k}"] for k in P.KINDS] == [sum(s.startswith(k + ":") for s in want) for k in P.KINDS]


def test_pii_bootstrap_finds_unseen(spark):
    """Identifiers without a base pattern, in the contexts of seeds."""
    rng = random.Random(2)
    texts = [f"{' '.join(prose(rng, 5))} write to user{i}@host{i}.org or call later {i}" for i in range(40)]
    texts += [f"please write to member-{i}77x or call back" for i in range(5)]
    texts += [f"build number{i}00 of the day" for i in range(20)]
    got = {r["doc_id"]: r for r in collect(P.find(docs(spark, texts)))}
    for i in range(40, 45):
        start = texts[i].index("member")
        assert got[i]["spans"] == f"ctx_email:{start}:{start + len(f'member-{i - 40}77x')}"
    assert all(got[i]["spans"] == "" for i in range(45, 65))


def test_odd_rows(spark):
    df = odd_docs(spark).selectExpr("*", "'x' AS labels", "1 AS kind", "2 AS start", "'y' AS hit")
    extra = spark.createDataFrame([(None, "mail a@b.org", None, None, 1), (5, "all rights reserved a@b.org", None, None, 1)], odd_docs(spark).schema)
    df = df.unionByName(extra.union(extra), allowMissingColumns=True)
    found, scanned = collect(P.find(df)), collect(L.scan(df))
    assert len(found) == len(scanned) == 15
    assert sum(r["n_email"] for r in found) == 4 and {r["spans"] for r in found} == {"", "email:5:12", "email:20:27"}
    assert [r["n_base"] for r in scanned if r["doc_id"] == 5] == [1, 1]
    assert collect(P.find(empty_docs(spark))) == [] == collect(L.scan(empty_docs(spark)))
