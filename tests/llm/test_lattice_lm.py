from __future__ import annotations

import math
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cardwatch.llm import lattice_lm as lm
from cardwatch.llm.heap_bpe import tokenizer_path


def tokens(text):
    return (text or "").encode().lower().split()


def learns(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 != 2


def base(rows):
    c = Counter()
    for i, t in rows:
        if learns(i):
            c.update([*tokens(t), None])
    n, v = sum(c.values()), len(c)
    out = []
    for i, t in rows:
        w = [*tokens(t), None]
        out.append((i, not learns(i), len(w), sum(c[x] > 0 for x in w), n, sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w)))
    return out, c


def lattice(c):
    model = lm._model(tokenizer_path())
    pieces = Counter()
    for w, k in c.items():
        for p in [model.eos_id()] if w is None else model.encode(w.decode()):
            pieces[p] += k
    return lm.Lattice(tokenizer_path(), pieces)


def paths(lat, text):
    """Probability of every segmentation by plain enumeration."""
    if not text:
        return 1.0
    total = 0.0
    for k in range(1, len(text) + 1):
        if text[:k] in lat.pieces:
            total += math.exp(lat.pieces[text[:k]]) * paths(lat, text[k:])
    if text[0] not in lat.pieces:
        total += math.exp(sum(lat.bytes[b] for b in text[0].encode())) * paths(lat, text[1:])
    return total


def check(got, rows):
    want, c = base(rows)
    lat = lattice(c)
    text = dict(rows)
    got = sorted(got, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0))
    want = sorted(want, key=lambda r: (r[0] is None, r[0] or 0))
    assert len(got) == len(want)
    for r, w in zip(got, want, strict=True):
        assert (r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == w[:5]
        assert r["base_score"] == pytest.approx(w[5], rel=1e-9)
        own = sum(lat.word(x.decode()) for x in tokens(text[r["doc_id"]])) + lat.end
        assert r["score"] == pytest.approx(own, rel=1e-9)


def test_counts_and_scores(corpus, texts):
    got = lm.score(corpus).collect()
    check(got, list(texts.items()))
    out = [r for r in got if r["held_out"]]
    blank = lm.Lattice(tokenizer_path(), {})
    assert sum(r["score"] for r in out) > 0.8 * sum(blank.word(w.decode()) for r in out for w in tokens(texts[r["doc_id"]]))


def test_small_chunks_change_nothing(corpus, texts, monkeypatch):
    monkeypatch.setattr(lm, "CHUNK_WORDS", 300)
    check(lm.score(corpus.repartition(2)).collect(), list(texts.items()))


def test_forward_recursion_adds_all_segmentations():
    lat = lattice(Counter({b"the": 50, b"there": 7, b"ere": 3, None: 4}))
    for word in ("the", "there", "é日x", "theree", "🙂"):
        assert 10 ** lat.word(word) == pytest.approx(paths(lat, "▁" + word), rel=1e-9)
    total = sum(math.exp(s) for s in [*lat.pieces.values(), *lat.bytes.values()]) + 10**lat.end
    assert total == pytest.approx(1.0)


def test_edge_cases(frame):
    rows = [(1, "One two  TWO\x0bthree x"), (2, None), (3, ""), (None, "one null id"), (4, "x" * 50_000), (5, "é " * 30_000), (6, " \n")]
    got = lm.score(frame(rows, held_out=F.lit(1), n=F.lit("x"))).collect()
    check(got, rows)
    again = lm.score(frame([(1, "a b"), (1, "a b")])).collect()
    assert len(again) == 2 and again[0] == again[1]
    assert lm.score(frame([])).collect() == []
    alone = lm.score(frame([(None, "a b")])).collect()[0]
    assert alone["train_tokens"] == 0 and alone["n_known"] == 0 and alone["base_score"] == 0.0
