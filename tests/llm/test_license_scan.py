from __future__ import annotations

import math
import re

import pytest
from pyspark.sql import functions as F

from cardwatch.llm import license_scan as ls

#: What the given texts have, and the families that they are of.
LINES = {
    "CC BY-NC 4.0": "cc-by-nc",
    "GNU General Public License, version 3": "gpl",
    "Apache License, Version 2.0": "apache",
    "MIT License": "mit",
    "All rights reserved.": "reserved",
}


@pytest.fixture(scope="module")
def model(corpus):
    return ls.fit(corpus, 100)


def hashed(spark, words):
    df = spark.createDataFrame([(words,)], "words array<string>")
    return set(df.select(ls._hashed()).first()[0])


def tokens(text):
    return re.findall(r"[^\W_]+", text.lower())


def test_given_documents(corpus, texts, model):
    got = ls.scan(corpus, model).collect()
    assert len(got) == len(texts)
    for r in got:
        text = texts[r["doc_id"]]
        assert r["licenses"] == sorted(f for k, f in LINES.items() if k in text)
        assert r["n_paragraphs"] == sum(bool(tokens(x)) for x in text.split("\n"))
        assert r["n_notices"] == len(r["lines"])


def test_scores_against_a_plain_loop(spark, frame, model):
    cases = [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
        "The permission of the author and the software of the other",
        "Licensed under the GNU Affero General Public License, version 3.",
        "all rights",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "plain words about nothing at all",
    ]
    weights = dict(model.weights)
    got = {r["doc_id"]: r for r in ls.scan(frame(list(enumerate(cases))), model).collect()}
    templates = [(f, tokens(t)) for f, t in ls.TEMPLATES]
    shingles = lambda w: {tuple(w[i : i + 3]) for i in range(max(1, len(w) - 2))}
    for i, text in enumerate(cases):
        z = list(model.bias)
        for g in hashed(spark, tokens(text)):
            z = [a + b for a, b in zip(z, weights.get(g, [0] * len(z)), strict=True)]
        top = max(z)
        p = [math.exp((v - top) / model.temperature) for v in z]
        best = z.index(top)
        told = best > 0 and p[best] / sum(p) >= model.least
        similar = max((len(shingles(w) & shingles(tokens(text))) / min(len(shingles(w)), len(shingles(tokens(text)))) for f, w in templates if f == model.families[best]), default=0)
        sure = told and similar >= ls.SIMILARITY
        assert got[i]["licenses"] == ([model.families[best]] if sure else [])
        assert got[i]["n_rejected"] == int(told and not sure)
        if sure:
            assert got[i]["probability"] == pytest.approx(p[best] / sum(p)) and got[i]["similarity"] == pytest.approx(similar)
    assert got[0]["licenses"] == ["mit"] and got[2]["licenses"] == ["agpl"] and got[4]["licenses"] == ["cc-by-sa"]


def test_edge_cases(frame, model):
    notice = "Released under the MIT License."
    rows = [(1, None), (2, ""), (3, " \n!!\n"), (None, "x\n" + notice), (4, "word " * 20_000 + "\n" + notice), (5, notice + "\nAll rights reserved."), (5, notice + "\nAll rights reserved.")]
    got = ls.scan(frame(rows, licenses=F.lit("x"), line=F.lit(1), words=F.lit(2)), model).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    assert by[None]["licenses"] == ["mit"] and by[None]["lines"] == [1]
    assert by[4]["licenses"] == ["mit"] and by[4]["n_paragraphs"] == 2
    assert [r["licenses"] for r in got if r["doc_id"] == 5] == [["mit", "reserved"]] * 2
    assert by[1]["n_paragraphs"] == by[2]["n_paragraphs"] == by[3]["n_paragraphs"] == 0
    assert ls.scan(frame([]), model).collect() == []


def test_without_documents(frame):
    assert ls.scan(frame([(None, None)])).collect()[0]["n_notices"] == 0
