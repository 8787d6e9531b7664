import pytest
from helpers import collect, docs

from docweave.llm import licenses as L

NOTICES = {
    "gpl-2.0-or-later": "under the terms of the GNU General Public License version 2 or any later version",
    "bsd-2-clause": "Redistributions of source code must retain the above copyright notice, this list of conditions",
    "bsd-3-clause": "The names may not be used: it may be used to endorse or promote products derived from this software",
    "mit": "Permission is hereby granted, free of charge, to any person. This is the MIT License",
    "apache-2.0": "Licensed under the Apache Software License, Version 2.0 (the terms)",
    "cc-by-sa-4.0": "Creative Commons Attribution Share Alike 4.0",
    "isc": "Permission to use, copy, modify, and distribute this software",
    "cdla-permissive": "Community Data License Agreement - Permissive",
}
BREAKS = ["  ", "\t", "\n", "\r\n", " ", "\n * ", "\n# ", "\n// ", "\n;; ", "  *\n *   ", "\n\n-- ", "\n *\n * "]


def test_wrapped_notices(spark):
    """A break at every blank in turn, and at all of them."""
    texts, want = [], []
    for label, notice in NOTICES.items():
        words = notice.split(" ")
        for b in BREAKS:
            for k in range(1, len(words)):
                texts.append(" ".join(words[:k]) + b + " ".join(words[k:]))
            texts.append(b.join(words))
            want += [label] * len(words)
    got = {r["doc_id"]: r for r in collect(L.scan(docs(spark, texts)))}
    for i, (t, label) in enumerate(zip(texts, want)):
        assert label in got[i]["labels"].split(",") and got[i]["score"] >= 0.8, (t, label, got[i]["labels"])


def test_spans_are_places_of_the_text(spark):
    text = "/* é This is under the GNU  General\n * Public License,\n * version 3, and\n * no more. */"
    (r,) = collect(L.detections(docs(spark, [text])).where("label = 'gpl-3.0'"))
    assert text[r["start"] : r["stop"]] == "GNU  General\n * Public License,\n * version 3"


@pytest.mark.parametrize("text", ["general - public license", "general, public license", "general\n1. public licenses", "apache * license"])
def test_other_signs_do_not_join(spark, text):
    assert collect(L.detections(docs(spark, [text]))) == []
