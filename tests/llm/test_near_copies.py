from __future__ import annotations

import re

import numpy as np
import pyarrow as pa

import corpus_pipeline as cp
from cardwatch.llm import near_copies as nc
from cardwatch.llm import simhash_trie as st

WORD = re.compile(r"[^\x20\x09-\x0d]+")


def shingles(text):
    w = WORD.findall(re.sub("[A-Z]", lambda x: x[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    """The ids that stay, by comparing all pairs."""
    rows = sorted(rows)
    sets, of = [shingles(t) for _, t in rows], list(range(len(rows)))
    inverted = {}
    for i, s in enumerate(sets):
        for x in s:
            inverted.setdefault(x, []).append(i)
    for i, s in enumerate(sets):
        shared = np.bincount([j for x in s for j in inverted[x]], minlength=len(rows)) if s else np.zeros(len(rows))
        for j, n in enumerate(shared):
            if j < i and ((not s and not sets[j]) or (n and 5 * n >= 4 * (len(s) + len(sets[j]) - n))):
                a, b = of[i], of[j]
                of = [min(a, b) if c in (a, b) else c for c in of]
    return {rows[c][0] for c in of}


def planted(n_groups=30, n_copies=5):
    """Groups of texts with some words changed, so that similarities lie on both sides of 0.8."""
    rng = np.random.default_rng(11)
    rows = []
    for g in range(n_groups):
        base = [f"w{x}" for x in rng.integers(0, 5_000, 120 + 10 * g)]
        rows.append((len(rows), " ".join(base)))
        for k in range(n_copies):
            text = list(base)
            for at in rng.choice(len(base), max(1, len(base) * (k + 1) // 130), replace=False):
                text[at] = f"x{rng.integers(0, 10**9)}"
            rows.append((len(rows), " ".join(text)))
    return rows


def test_stage_finds_near_copies_beyond_three_bits(spark, frame):
    rows = planted()
    got = {r["doc_id"] for r in cp.near_duplicates(spark, frame(rows), "").collect()}
    assert got == brute(rows)
    assert len(got) < len({r["doc_id"] for r in st.dedup(frame(rows)).collect()})


def test_corpus_and_edge_cases(spark, corpus, texts, frame):
    assert {r["doc_id"] for r in nc.dedup(corpus).collect()} == brute(texts.items())
    rows = [(7, None), (3, ""), (None, " \n"), (9, "one"), (8, "One"), (5, "two words"), (None, "alone here now and then"), (2, "é日 " * 9_000), (2, "é日 " * 9_000)]
    left = nc.dedup(frame(rows)).collect()
    assert sorted(r["doc_id"] for r in left if r["doc_id"] is not None) == [2, 3, 5, 8]
    assert [r["text"] for r in left if r["doc_id"] is None] == ["alone here now and then"]
    assert nc.dedup(frame([])).collect() == []


def test_a_bucket_of_different_groups_is_taken_apart(spark):
    rows = planted(4, 3)
    docs = spark.createDataFrame([(i, t, str(i), i) for i, t in rows], "doc_id bigint, text string, k string, h bigint")
    sig = nc.save(nc.signatures(docs).selectExpr("doc_id", "k", "h", "node", "array(1L) AS bands"), "signatures")
    node = {r["doc_id"]: r["node"] for r in sig.collect()}
    root = {r["node"]: r["root"] for r in nc.roots(docs, sig, 3, 20_000).collect()}
    least = {}
    for i, _ in rows:
        least.setdefault(root.get(node[i], node[i]), i)
    assert set(least.values()) == brute(rows)


def test_similarity_is_exact():
    a = ["a b c d e f g h i j k l m n", "A b", "", "x y z"]
    b = ["a b c d e f g h i j k l m q", "a B", "", "x y"]
    want = [5 * len(shingles(x) & shingles(y)) >= 4 * len(shingles(x) | shingles(y)) for x, y in zip(a, b, strict=True)]
    assert nc.similar(pa.array(a), pa.array(b)).tolist() == want == [True, True, True, False]


def test_a_large_group_of_edited_copies(spark, frame):
    """Most pairs of the group are not similar themselves; pairs compared stay near the number of its texts."""
    rng = np.random.default_rng(7)
    base = [f"w{x}" for x in rng.integers(0, 10_000, 140)]
    rows = []
    for i in range(1_500):
        text = list(base)
        for at in rng.integers(0, 140, rng.integers(0, 9)):
            text[at] = f"x{i}y{at}"
        rows.append((i, " ".join(text)))
    assert {r["doc_id"] for r in nc.dedup(frame(rows)).collect()} == brute(rows)
    texts = spark.createDataFrame([(i, t) for i, t in rows], "node bigint, text string")
    sets = [shingles(t) for _, t in rows]
    similar = [(a, b) for a in range(200) for b in range(a + 1, 200) if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    alone = texts.selectExpr("node", "node AS root").where("node < 200")
    got = {tuple(r) for r in nc.rare_pairs(alone, texts).collect()}
    assert set(similar) <= got and len(got) < 200 * 199 / 2
    together = texts.selectExpr("node", "if(node < 10, node, 10) AS root")
    assert nc.rare_pairs(together, texts).count() < 10 * 1_500
