from __future__ import annotations

import itertools

import numpy as np
from pyspark.sql import functions as F

from cardwatch.llm import crf_language as crf


def test_held_out_accuracy(corpus):
    field = crf.train(corpus.where(~crf.held_out()), 30)
    got = crf.label(corpus, field, ["doc_id", "lang"]).collect()
    assert len(got) == corpus.count()
    assert np.mean([r["lang"] == r["lang_pred"] for r in got]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in got)


def test_forward_backward_adds_all_paths():
    rng = np.random.default_rng(2)
    e, moves = rng.normal(size=(7, 3)), rng.normal(size=(3, 3))
    owner = np.array([0, 0, 0, 2, 2, 2, 2])
    got = crf.posteriors(e, owner, moves, 4)
    for text in (0, 2):
        own = np.flatnonzero(owner == text)
        want = np.zeros((len(own), 3))
        for start, *path in itertools.product(range(3), repeat=len(own) + 1):
            w = np.exp(sum(e[i, y] for i, y in zip(own, path, strict=True)) + sum(moves[a, b] for a, b in itertools.pairwise([start, *path])))
            for k, y in enumerate(path):
                want[k, y] += w
        assert np.allclose(got[own], want / want.sum(axis=1, keepdims=True))


def test_move_gradient_is_that_of_the_likelihood(monkeypatch):
    rng = np.random.default_rng(5)
    owner = np.repeat([0, 2, 3], [5, 1, 6])
    e, moves = rng.normal(size=(len(owner), 3)), rng.normal(size=(3, 3))
    y = rng.integers(3, size=len(owner))

    def weight(own, path, moves):
        steps = np.exp(moves[:, path[0]]).sum() * np.exp(sum(moves[a, b] for a, b in itertools.pairwise(path)))
        return steps * np.exp(sum(e[i, k] for i, k in zip(own, path, strict=True)))

    def log_likelihood(moves):
        total = 0.0
        for text in set(owner):
            own = np.flatnonzero(owner == text)
            all_paths = sum(weight(own, p, moves) for p in itertools.product(range(3), repeat=len(own)))
            total += np.log(weight(own, y[own], moves) / all_paths)
        return total

    step = 1e-5
    want = np.zeros((3, 3))
    for i, j in itertools.product(range(3), repeat=2):
        d = np.zeros((3, 3))
        d[i, j] = step
        want[i, j] = (log_likelihood(moves + d) - log_likelihood(moves - d)) / (2 * step)
    for block in (2, 32):
        monkeypatch.setattr(crf, "BLOCK", block)
        got = crf.seen_moves(y, owner, moves) - crf.marginals(e, owner, moves, 4)[1]
        assert np.allclose(got, want, atol=1e-7)


def test_blocks_change_nothing(monkeypatch):
    rng = np.random.default_rng(3)
    size = [1, 0, 31, 32, 33, 200]
    owner = np.repeat(np.arange(6), size)
    e, moves = rng.normal(size=(len(owner), 4)) * 3, rng.normal(size=(4, 4))
    got = crf.posteriors(e, owner, moves, 6)
    monkeypatch.setattr(crf, "BLOCK", 1000)
    assert np.allclose(got, crf.posteriors(e, owner, moves, 6))


def test_switched_text_and_edge_cases(corpus, frame, texts):
    field = crf.train(corpus, 30)
    by = {r["lang"]: r["text"] for r in corpus.where("n_chars > 1500").select("lang", "text").collect()}
    words = [(lang, w) for lang in ("de", "es") for w in by[lang].split()[:40]]
    f = crf.features([" ".join(w for _, w in words)])
    p = crf.posteriors(field.emissions(f), f.owner, field.moves, 1)
    half = [field.labels[k] for k in p.argmax(axis=1)]
    assert half[:35].count("de") > 30 and half[-35:].count("es") > 30
    rows = [(1, None), (2, ""), (3, "12 34 !!"), (None, by["de"]), (4, by["fr"] * 60), (5, "日本語"), (6, by["es"]), (6, by["es"])]
    got = crf.label(frame(rows, lang_pred=F.lit("x"), score=F.lit(1)), field).collect()
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in got}
    assert len(got) == len(rows)
    assert found[1] == found[2] == found[3] == ("und", 0.0)
    assert found[None][0] == "de" and found[4][0] == "fr" and found[6][0] == "es"
    assert crf.label(frame([]), field).collect() == []


def test_nothing_to_learn_from(frame):
    docs = frame([(1, "some words", None), (2, None, "en")])
    assert {r["lang_pred"] for r in crf.label(docs, crf.train(docs)).collect()} == {"und"}
    one = frame([(1, "some words", "en")])
    assert crf.label(one, crf.train(one)).collect()[0]["lang_pred"] == "en"


def test_sample_is_bounded_and_fixed(corpus):
    n = crf.training_rows(corpus, 5).groupBy("lang").count().collect()
    assert all(r["count"] == 5 for r in n)
    assert crf.training_rows(corpus, 5, 3000).agg(F.sum(F.octet_length("text"))).first()[0] <= 3000 * 4
    ids = lambda df: sorted(r["doc_id"] for r in crf.training_rows(df, 5).collect())
    assert ids(corpus) == ids(corpus.repartition(7))
