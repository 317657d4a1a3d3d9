from __future__ import annotations

import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from cardwatch.llm import simhash_trie as st

WORD = re.compile(rb"[^\x20\x09-\x0d]+")


def fingerprint(text):
    low = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    w = WORD.findall(low)
    if not w:
        return 0
    shingles = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    bits = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for k in range(64):
            bits[k] += h >> k & 1
    return sum(1 << k for k in range(64) if 2 * bits[k] > len(shingles))


def classes(fps, radius=3):
    """Component of each position by comparing all pairs."""
    a = np.array(fps, np.uint64)
    of = np.arange(len(a))
    for i in range(len(a)):
        near = np.flatnonzero(np.bitwise_count(a ^ a[i]) <= radius)
        merged = np.isin(of, of[near])
        of[merged] = of[merged].min()
    return of


def brute(rows):
    fps = [fingerprint(t) for _, t in rows]
    of = classes(fps)
    least = {}
    for (i, _), c in zip(rows, of, strict=True):
        least[c] = min((x for x in (i, least.get(c)) if x is not None), default=None)
    return sorted(((i, f"{f:016x}", least[c]) for (i, _), f, c in zip(rows, fps, of, strict=True)), key=repr)


def result(df):
    return sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in df.collect()), key=repr)


@pytest.mark.parametrize("limit", [2, 20_000])
def test_corpus(corpus, texts, limit):
    assert result(st.groups(corpus, root_limit=limit)) == brute(list(texts.items()))


@pytest.mark.parametrize("seed", range(6))
def test_node_pairs_against_all_pairs(seed):
    rng = np.random.default_rng(seed)
    centres = rng.integers(0, 2**63, 5, dtype=np.uint64)
    x = np.unique(np.concatenate([c ^ np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, (60, 4), dtype=np.uint64), axis=1) for c in centres]))
    for radius in (0, 1, 3):
        assert (st.self_join(x, 0, radius) == classes(x, radius)).all()


def test_hot_root_is_opened(spark):
    rng = np.random.default_rng(8)
    near = [int(5 << 50 ^ (1 << a) ^ (1 << b) ^ (1 << c)) for a, b, c in rng.integers(0, 48, (300, 3))]
    fps = sorted({*near, *rng.integers(0, 2**62, 200).tolist()})
    df = spark.createDataFrame([(f,) for f in fps], "fp bigint")
    of = classes(fps)
    for limit in (3, 50):
        got = st.components(st.links(df, 3, limit)).collect()
        root = {r["node"]: r["root"] for r in got}
        assert [root.get(f, f) for f in fps] == [fps[c] for c in of]


def test_edge_cases_and_one_row_per_group(frame):
    rows = [(7, None), (3, ""), (None, " \n"), (9, "one"), (8, "One"), (5, "two words"), (None, "alone here now and then"), (2, "é日 " * 30_000), (2, "é日 " * 30_000)]
    docs = frame(rows, fp=F.lit(1), component_id=F.lit("clash"))
    assert result(st.groups(docs)) == brute(rows)
    left = st.dedup(docs).collect()
    assert sorted((r["doc_id"], (r["text"] or "")[:5]) for r in left if r["doc_id"] is not None) == [(2, "é日 é日"), (3, ""), (5, "two w"), (8, "One")]
    assert [r["text"] for r in left if r["doc_id"] is None] == ["alone here now and then"]
    assert left[0]["component_id"] == "clash"
    assert st.groups(frame([])).collect() == [] and st.dedup(frame([])).collect() == []


def test_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)], "a bigint, b bigint")
    got = st.components(edges).collect()
    assert len(got) == 201 and {r["root"] for r in got} == {0}
