import random

import pytest
from helpers import collect, docs, prose

from docweave.llm import pii as P


def luhn(rng, valid=True):
    d = [4] + [rng.randrange(10) for _ in range(14)]
    total = sum(x * 2 - 9 * (x > 4) if k % 2 == 0 else x for k, x in enumerate(reversed(d)))
    d.append((-total + (not valid)) % 10)
    s = "".join(map(str, d))
    return " ".join(s[k : k + 4] for k in range(0, 16, 4))


#: words before and after, a seed of the base pattern, an identifier it does not know
FORMS = {
    "email": ("write to", "for answers", lambda r, i: f"user{i}@host{i}.org", lambda r, i: f"member-{i}77x"),
    "ip": ("log in at", "from home", lambda r, i: f"10.{i}.7.{r.randrange(256)}", lambda r, i: f"node{i}-rack77"),
    "card": ("charged to card", "of the customer", lambda r, i: luhn(r), lambda r, i: luhn(r, False)),
    "phone": ("please call", "after noon", lambda r, i: f"+{1 + i % 3} ({100 + i}) 555-{r.randrange(1000, 9999)}", lambda r, i: f"({200 + i}) 555-{r.randrange(1000, 9999)}"),
    "phone in short groups": ("please call", "after noon", lambda r, i: f"+49 {30 + i} {100 + i} {r.randrange(100, 999)}", lambda r, i: f"0{30 + i} {100 + i} {r.randrange(100, 999)}"),
}


@pytest.mark.parametrize("form", FORMS)
def test_unseen_identifier_of_each_kind(spark, form):
    before, after, seed, other = FORMS[form]
    rng, kind = random.Random(3), form.split()[0]
    unseen = [other(rng, i) for i in range(5)]
    texts = [f"{' '.join(prose(rng, 4))} {before} {seed(rng, i)} {after}" for i in range(30)]
    texts += [f"{' '.join(prose(rng, 4))} {before} {x} {after}" for x in unseen]
    texts += [f"the number {1000 + i} 55512{i} was in the list" for i in range(10)]
    got = {r["doc_id"]: r for r in collect(P.find(docs(spark, texts)))}
    assert all(got[i][f"n_{kind}"] == 1 and "ctx_" not in got[i]["spans"] for i in range(30))
    for i, x in enumerate(unseen, 30):
        at = texts[i].index(x)
        assert got[i]["spans"] == f"ctx_{kind}:{at}:{at + len(x)}", texts[i]
    assert all(got[i]["spans"] == "" for i in range(35, 45))


def test_area_codes_are_no_patterns(spark):
    texts = [f"call +1 (017) 555-77{i} now" for i in range(10, 30)] + ["lot (017) 555-7799 of goods"]
    got = {r["doc_id"]: r for r in collect(P.find(docs(spark, texts)))}
    assert got[20]["spans"] == ""


def test_believed_instances_are_seeds_of_new_patterns(spark):
    """'owned by' has no base seed: only identifiers believed from 'write to'."""
    rng = random.Random(9)
    texts = [f"{' '.join(prose(rng, 4))} write to user{i}@host{i}.org today" for i in range(40)]
    texts += [f"{' '.join(prose(rng, 4))} write to member-{i}77x today" for i in range(12)]
    texts += [f"the file owned by member-{i}77x was read" for i in range(12)]
    texts += ["the file owned by guest-9981 was read"]
    got = {r["doc_id"]: r for r in collect(P.find(docs(spark, texts)))}
    at = texts[64].index("guest")
    assert got[64]["spans"] == f"ctx_email:{at}:{at + 10}"


def secret(rng, n=40):
    return "".join(rng.choice("0123456789abcdef") for _ in range(n - 2)) + "a1"


def test_secrets_and_values_in_their_contexts(spark):
    """Seeds by shape are reported where a pattern of several marks them, as are
    passwords without a digit there; lone shapes and digests are not."""
    rng = random.Random(5)
    texts = [f'{" ".join(prose(rng, 4))} Token = "{secret(rng)}" {" ".join(prose(rng, 3))}' for _ in range(12)]
    texts += [f'{" ".join(prose(rng, 4))} token = "correcthorse" and on', f"{secret(rng)} stands alone"]
    texts += [f"in commit {secret(rng)} of the tree" for _ in range(6)]
    texts += [f'set colour = "{w}" here' for w in ("crimson", "magenta", "viridian", "emerald")]
    got = {r["doc_id"]: r["spans"] for r in collect(P.find(docs(spark, texts)))}
    for i in range(13):
        at = texts[i].lower().index('token = "') + 9
        assert got[i] == f"ctx_secret:{at}:{texts[i].index(chr(34), at)}", texts[i]
    assert [got[i] for i in range(13, 24)] == [""] * 11


def test_long_words_are_no_cut_patterns(spark):
    """Words that differ before the window of context do not become one pattern."""
    rng = random.Random(6)
    texts = [f"{secret(rng)}{'x' * 300} user{i}@host{i}.org" for i in range(6)] + [f"{secret(rng)}{'x' * 300} member-77x"]
    got = {r["doc_id"]: r["spans"] for r in collect(P.find(docs(spark, texts)))}
    assert all("ctx_email" not in s for s in got.values())


def plain_bootstrap(rows, rounds, min_seeds, doubt, min_belief):
    """The scores by plain loops."""
    edges = {}
    for hit, seed, pattern in rows:
        if pattern is not None:
            edges[pattern, hit] = max(filter(None, (edges.get((pattern, hit)), seed)), default=None)
    held = {}
    for p, h in edges:
        held.setdefault(p, set()).add(h)
    edges = {e: s for e, s in edges.items() if len(held[e[0]]) >= min_seeds}
    known = {(h, s): 1.0 for (_, h), s in edges.items() if s}
    belief, scores = dict(known), {}
    for _ in range(rounds):
        scores, seeds, most = {}, {}, {}
        for (h, _), b in belief.items():
            most[h] = max(most.get(h, 0), b)
        for p, h in edges:
            seeds[p] = seeds.get(p, 0) + (most.get(h, 0) >= min_belief)
            for (x, kind), b in belief.items():
                if x == h:
                    scores[p, kind] = scores.get((p, kind), 0) + b
        scores = {(p, k): (v / (len(held[p]) + doubt), seeds[p]) for (p, k), v in scores.items() if seeds[p] >= min_seeds}
        miss = {}
        for (p, h), s in edges.items():
            for (x, kind), (score, _) in scores.items():
                if x == p and s is None:
                    miss[h, kind] = miss.get((h, kind), 1.0) * (1 - min(score, 0.999))
        belief = dict(known)
        for key, m in miss.items():
            belief[key] = max(belief.get(key, 0), 0.9 * (1 - m))
    return scores


def test_scores_equal_plain_loops(spark):
    rng = random.Random(8)
    rows = [(f"h{rng.randrange(25)}", None, f"p{rng.randrange(9)}") for _ in range(150)]
    kinds = {f"h{i}": rng.choice(["email", "phone", "secret"]) for i in range(0, 25, 2)}
    rows = [(h, kinds.get(h), p) for h, _, p in rows]
    edges = spark.createDataFrame(rows, "hit string, seed string, pattern string")
    for rounds in (1, 2, 3):
        got = {(r["pattern"], r["kind"]): (r["score"], r["seeds"]) for r in P.bootstrap(edges, rounds).collect()}
        want = plain_bootstrap(rows, rounds, 3, 2.0, 0.5)
        assert set(got) == set(want) and want
        assert all(abs(got[k][0] - want[k][0]) < 1e-9 and got[k][1] == want[k][1] for k in want)
