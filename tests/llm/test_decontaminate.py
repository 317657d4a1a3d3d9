from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from cardwatch.llm import decontaminate as dc

PLAIN = re.compile(r"[^\x20\x09-\x0d!-/:-@\[-`{-~]+")


def words(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in PLAIN.findall(text or "")]


def shingles(w):
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def brute(docs, items):
    """Best similarity of each pair over all windows of the item's size, without fingerprints."""
    items = [(i, words(t)) for i, t in items if i is not None and t is not None]
    n = len(items)
    having = Counter(s for _, w in items for s in shingles(w))
    out = {}
    for d, text in docs:
        w = words(text)
        for i, item in items:
            if not item:
                continue
            own, best = shingles(item), 0.0
            size = min(len(item), len(w))
            if len(item) < 5 and size < len(item):
                continue
            if not any(s in own for s in (shingles(w) if len(item) >= 5 else {tuple(w[k : k + len(item)]): 1 for k in range(len(w))})):
                continue
            for k in range(len(w) - size + 1):
                other = shingles(w[k : k + size])
                weigh = lambda s: math.log1p(n / max(1, having[s]))
                low = sum(weigh(s) * min(own[s], other[s]) for s in own)
                best = max(best, low / sum(weigh(s) * max(own[s], other[s]) for s in own.keys() | other.keys()))
            if best >= 0.8:
                out.setdefault(d, {})[i] = best
    return out


def compare(got, want):
    for r in got:
        mine = want.get(r["doc_id"], {})
        assert r["items"] == sorted(mine) and r["n_items"] == len(mine) and r["contaminated"] == bool(mine)
        assert math.isclose(r["similarity"], max(mine.values(), default=0.0), abs_tol=1e-9)


def test_matches_all_windows(spark, corpus, texts):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    rows = [tuple(r) for r in items.select("item_id", "text").collect()]
    want = brute(texts.items(), rows)
    assert want
    compare(dc.contamination(corpus, items).collect(), want)
    # items in several blocks: the same results
    compare(dc.contamination(corpus, items, at_once=3).collect(), want)


def test_edited_passages_and_edge_cases(spark, frame):
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(400)]
    items = [(k, " ".join(rng.choice(vocabulary, 30 + k))) for k in range(20)]
    items += [(50, "Tiny item here"), (51, ""), (52, None), (None, items[0][1]), (53, items[3][1])]
    docs = [(None, items[1][1]), (900, None), (901, ""), (902, "Say: TINY, item-here!"), (903, "tiny item")]
    for k in range(20):
        w = items[k][1].split()
        if k % 2:
            w[1] = "changed"
        docs.append((k, " ".join([*rng.choice(vocabulary, 50), *w, *rng.choice(vocabulary, 50)]).upper()))
    docs.append((950, " ".join(rng.choice(vocabulary, 60_000)) + " " + items[7][1]))
    docs.append((0, docs[5][1]))
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = dc.contamination(frame(docs, items=F.lit("clash")), bench).collect()
    assert len(got) == len(docs)
    want = brute([d for d in docs if d[0] != 950], items) | {950: {7: 1.0}}
    compare(got, want)
    assert want[902] == {50: 1.0} and want[3][3] == want[3][53]
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert not any(r["contaminated"] for r in dc.contamination(frame(docs), none).collect())
    assert dc.contamination(frame([]), bench).collect() == []


def test_index_finds_all_within_the_radius():
    rng = np.random.default_rng(3)
    bench = dc.Benchmark([1, 2], [rng.integers(0, 2**63, 40, dtype=np.uint64) for _ in range(2)], dc.RADIUS, 2, {})
    for _ in range(300):
        k = rng.integers(0, 2)
        flips = rng.choice(64, rng.integers(0, dc.RADIUS + 1), replace=False)
        fp = bench.fps[k] ^ np.bitwise_or.reduce(np.uint64(1) << flips.astype(np.uint64), initial=np.uint64(0))
        window, item = bench.candidates(np.array([fp]))
        assert k in item
