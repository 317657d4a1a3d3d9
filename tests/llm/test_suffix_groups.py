from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardwatch.llm import suffix_groups as sg


def brute(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for (i, _), t in zip(rows, texts, strict=True):
        gone = np.zeros(len(t) + 1, bool)
        for k in range(len(t) - length + 1):
            if seen[t[k : k + length]] > 1:
                gone[k : k + length] = True
        kept = bytes(b for b, g in zip(t, gone, strict=False) if not g)
        spans = int((np.diff(np.concatenate([[False], gone]).astype(int)) == 1).sum())
        out.append((i, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def result(df):
    return sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in df.collect()), key=repr)


@pytest.mark.parametrize("letters", [1, 2, 3, 6])
def test_suffix_order(letters):
    rng = random.Random(letters)
    for _ in range(800):
        s = [rng.randint(0, letters) for _ in range(rng.randint(0, 45))]
        assert sg.suffix_order(s) == sorted(range(len(s)), key=lambda i: s[i:])


def test_whole_corpus(corpus, texts):
    got = result(sg.dedup(corpus))
    assert got == brute(list(texts.items()), 400)
    assert sum(r[2] for r in got) > 0


@pytest.mark.parametrize("limit", [1, 2000])
def test_short_windows_and_counted_groups(corpus, texts, limit):
    """Small windows make many groups of different contexts; a limit of one counts the windows of all of them."""
    rows = list(texts.items())[:60]
    docs = corpus.where(F.col("doc_id").isin([i for i, _ in rows]))
    assert result(sg.dedup(docs, 40, 24, limit)) == brute(rows, 40)


def test_edge_cases(frame):
    rng = random.Random(4)
    word = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    shared, other = word(90), word(60) + "é日" * 20
    rows = [
        (1, word(50) + shared + word(70)),
        (2, word(10) + shared + word(30) + shared[5:80]),
        (2, word(33)),
        (3, "a" * 300),
        (4, "ab" * 200 + other),
        (5, other[3:] + shared),
        (None, None),
        (None, shared),
        (6, ""),
        (7, "short"),
        (8, word(30_000)),
    ]
    rows += [rows[0]]
    assert result(sg.dedup(frame(rows, spans=F.lit(1)), 40, 24)) == brute(rows, 40)
    assert result(sg.dedup(frame([]))) == []
