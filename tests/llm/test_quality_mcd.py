from __future__ import annotations

import json
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardwatch.llm import quality_mcd as q

WORD = re.compile(r"[^\x20\x09-\x0d]+")


def counts(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    seen = Counter(windows)
    repeat = {i + k for i, x in enumerate(windows) if seen[x] > 1 for k in range(3)}
    return (
        len(w),
        sum(map(len, w)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(repeat),
        len(lines),
    )


def vector(c):
    n, chars, symbols, dup, repeat, lines = c
    share = lambda a, b: math.asin(math.sqrt(min(1.0, a / max(1, b))))
    x = [math.log1p(n), math.log(max(1, chars) / max(1, n)), share(symbols, chars), share(dup, lines), share(repeat, n)]
    return np.array([round(v * q.UNIT) / q.UNIT for v in x])


def bins(d2):
    return np.floor(np.log(d2 + 1e-9) * q.BIN)


def moments(x):
    return x.mean(axis=0), np.cov(x.T, bias=True) + np.diag(np.square(q.LEAST_SPREAD))


def distances(x, mean, cov):
    y = x - mean
    return np.einsum("ij,jk,ik->i", y, np.linalg.inv(cov), y)


def factor(x, est):
    b = np.sort(bins(distances(x, *est)))
    return q.MEDIAN / max(math.exp((b[(len(b) - 1) // 2] + 0.5) / q.BIN), q.MEDIAN / 100)


def fence(d2):
    low, _, high = (math.sqrt(math.exp((np.sort(bins(d2))[math.ceil(len(d2) * k / 4) - 1] + 0.5) / q.BIN)) for k in (1, 2, 3))
    return (high + q.FENCE * (high - low)) ** 2


def mcd(x):
    def concentrate(d2):
        b = bins(d2)
        values, n = np.unique(b, return_counts=True)
        seen = np.cumsum(n) - n
        return moments(x[np.isin(b, values[seen < math.ceil(len(x) * q.SHARE)])])

    def middle(v):
        return np.sort(v)[(len(v) - 1) // 2]

    rough = np.trunc(x * 1000 + np.sign(x) * 1e-7)
    centre = np.array([middle(c) for c in rough.T])
    spread = np.array([middle(abs(c - m)) for c, m in zip(rough.T, centre, strict=True)]) / 1000 * 1.4826
    spread = np.maximum(spread, q.LEAST_SPREAD)
    found = []
    for d2 in (np.zeros(len(x)), np.square((x - centre / 1000) / spread).sum(axis=1)):
        est = concentrate(d2)
        for _ in range(q.STEPS):
            est = concentrate(distances(x, *est))
        found.append((np.linalg.slogdet(est[1])[1], len(found), est))
    est = min(found, key=lambda f: f[:2])[2]
    est = moments(x[distances(x, *est) * factor(x, est) <= q.WEIGHT_LIMIT])
    f = factor(x, est)
    return distances(x, *est) * f, max(q.LEAST_CUT, fence(distances(x, *est)) * f)


def brute(rows, min_rows):
    """(counts, distance) of each (lang, source, text) by arrays, one group after the other."""
    found = [counts(t) for _, _, t in rows]
    fine = Counter((a, b) for (a, b, _), c in zip(rows, found, strict=True) if c[0])
    pool = Counter()
    for (a, _), n in fine.items():
        pool[a] += n if n < min_rows else 0
    groups = defaultdict(list)
    for i, ((a, b, _), c) in enumerate(zip(rows, found, strict=True)):
        if c[0]:
            g = json.dumps([a, b]) if fine[a, b] >= min_rows else json.dumps([a]) if pool[a] >= min_rows else ""
            groups[g].append(i)
    d2 = [None] * len(rows)
    for own in groups.values():
        away, cut = mcd(np.array([vector(found[i]) for i in own]))
        for i, v in zip(own, away, strict=True):
            d2[i] = (v, len(own), cut)
    return found, d2


def check(got, rows, ids, min_rows):
    found, d2 = brute(rows, min_rows)
    by_id = {r["doc_id"]: r for r in got}
    for i, c, d in zip(ids, found, d2, strict=True):
        r = by_id[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == c[:5]
        failed = c[0] < 50 or 100 * c[4] > 50 * c[0]
        assert r["base_failed"] == failed
        if d is None:
            assert r["distance2"] is None and not r["kept"]
            continue
        if d[1] >= 2 * q.P:
            assert r["distance2"] == pytest.approx(d[0], rel=1e-5)
        assert r["kept"] == (not failed and (d[1] < 2 * q.P or d[0] <= d[2]))


def test_counts_and_distances(spark, corpus):
    rows = corpus.select("doc_id", "lang", "source", "text").collect()
    one = corpus.withColumn("source", F.when(F.col("doc_id") % 3 > 0, "a").otherwise(F.col("source")))
    got = q.verdicts(one, min_rows=40).collect()
    assert len(got) == len(rows)
    full = [(r["lang"], "a" if r["doc_id"] % 3 else r["source"], r["text"]) for r in rows]
    check(got, full, [r["doc_id"] for r in rows], 40)
    assert any(r["kept"] for r in got) and any(not r["kept"] and not r["base_failed"] for r in got)


def test_edge_cases(frame):
    rows = [
        (1, None), (2, ""), (3, " \n\t"), (4, "a b c a b c a b c"), (5, "x\n\nx\ny\nx \n"),
        (6, "word " * 20_000, None, None), (7, " ".join(f"w{i}" for i in range(60)), None, None),
        (8, "é日🙂 #*$%&|<> a\x0bb\x0cc\rd"), (9, "a b c d a b c"),
    ]
    rows += [(100 + i, " ".join(f"v{i}x{j}" for j in range(60 + i)), "de", None) for i in range(30)]
    rows.append(rows[-1])
    got = q.verdicts(frame(rows, kept=F.lit("clash"), n_words=F.lit(None)), min_rows=20).collect()
    assert len(got) == len(rows)
    full = [(*(list(r[2:]) + ["en", "s"][len(r) - 2 :]), r[1]) for r in rows]
    check(got, full, [r[0] for r in rows], 20)
    assert q.verdicts(frame([])).collect() == []
