from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from cardwatch.llm import bloom_rank as br

TERM = re.compile("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")


def terms(text):
    return Counter(re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in TERM.findall(text or ""))


def brute(docs, items, k=br.K):
    found = [(i, terms(t)) for i, t in docs]
    n_docs, n_terms = sum(bool(c) for _, c in found), sum(c.total() for _, c in found)
    having = defaultdict(list)
    for j, (_, c) in enumerate(found):
        for t in c:
            having[t].append(j)
    out = []
    for item, text in sorted(set(items), key=repr):
        scores = Counter()
        for t in terms(text):
            w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * len(having[t]) + 1)))
            for j in having[t]:
                c = found[j][1]
                scores[j] += w * ((10**9 * c[t]) // (1000 * c[t] + 20 * (100 - 50 + (50 * c.total() * n_docs) // n_terms)))
        order = sorted((-s, found[j][0] is None, found[j][0] or 0) for j, s in scores.items() if s > 0)
        out += [(item, r + 1, None if no else i, -s) for r, (s, no, i) in enumerate(order[:k])]
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id bigint, text string")


def test_given_documents(spark, corpus, texts):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    want = brute(texts.items(), [tuple(r) for r in items.select("item_id", "text").collect()])
    assert found(br.search(corpus.repartition(5), items)) == want
    assert found(br.search(corpus, items, item_block=7)) == want


@pytest.mark.parametrize("k", [1, 4, 50])
def test_ties_copies_and_edge_cases(spark, frame, scattered, k):
    rng = np.random.default_rng(2)
    rows = [(i, " ".join(f"w{x}" for x in rng.zipf(1.4, rng.integers(1, 60)) % 300)) for i in range(150)]
    rows += [(1000 + i, "One common, passage; in MANY documents!") for i in range(70)] + [(1000, "One common, passage; in MANY documents!")] * 2
    rows += [(None, "one common passage"), (None, ""), (2000, None), (2001, " .,;! "), (2002, "Ünïcödé日本 ÄÖ w1" * 50), (2003, "w2 " * 20_000)]
    asked = [(1, "one COMMON passage"), (2, "w1 w2 w3 w3 nowhere"), (3, "absent words only"), (4, None), (5, ""), (None, "w7 w8"), (6, "Ünïcödé日本"), (1, "w5"), (2, "w1 w2 w3 w3 nowhere")]
    docs = frame(rows, score=F.lit("x"), item_id=F.lit(1), k=F.lit(0))
    assert found(br.search(docs, items_of(spark, asked), k, item_block=2)) == brute(rows, asked, k)


def test_empty_tables(spark, frame):
    assert found(br.search(frame([]), items_of(spark, [(1, "a")]))) == []
    assert found(br.search(frame([(1, "a b"), (2, "c")]), items_of(spark, []))) == []
    assert found(br.search(frame([(1, None), (2, "?")]), items_of(spark, [(1, "a")]))) == []


def test_bounds_hold_and_are_tight(frame, spark):
    rng = np.random.default_rng(4)
    rows = [(i, " ".join(f"w{x}" for x in rng.zipf(1.3, 20 + i) % 500)) for i in range(200)]
    docs = frame(rows).select("doc_id", F.lit("").alias("k"), F.xxhash64("text").alias("h"), "text")
    names = [f"w{i}" for i in range(520)]
    data = np.frombuffer("".join(names).encode(), np.uint8)
    ends = np.cumsum([len(n) for n in names])
    hashes = br.textnum.RangeHash(data)(np.append(0, ends[:-1]), ends)
    total = sum(len(t.split()) for _, t in rows)
    text = dict(rows)
    loose = all_ = 0
    for block in br.index(docs, np.zeros(1 << (br.TERM_FILTER_BITS - 3), np.uint8)).where("block IS NOT NULL").collect():
        items = {"terms": hashes.tobytes(), "weights": np.ones(520, np.int64).tobytes(), "ends": np.arange(1, 521).tobytes()}
        ids = np.frombuffer(block["ids"], np.int64)
        count = [Counter(text[i].split()) for i in ids]
        m = br.relative_length(np.array([c.total() for c in count]), len(rows), total)
        for t, bound in br.upper_bounds(block.asDict(), items, len(rows), total):
            exact = np.array([br.gain(c[names[t]], x) for c, x in zip(count, m, strict=True)])
            assert (bound >= exact).all()
            loose += int(((bound > 0) & (exact == 0)).sum())
            all_ += len(exact)
    assert all_ == 200 * 520 and loose < all_ / 1000


def test_blocks_of_short_texts_are_bounded():
    build, blocks = br._Builder(0), []
    for i in range(3 * br.BLOCK_DOCS - 5):
        one = br._level_keys(np.array([i], np.uint64), 0)
        blocks += build.add((i, i, 1, 1), [one, *[one[:0]] * (len(br.LEVELS) - 1)])
    sizes = [row[3] for row in [*blocks, *build.rest()]]
    assert sizes == [br.BLOCK_DOCS, br.BLOCK_DOCS, br.BLOCK_DOCS - 5]


def test_cell_gets_each_block_once(frame, spark):
    """A cell of several blocks of both sides gives the best of each item over all its blocks, k and not k of each block."""
    rng = np.random.default_rng(5)
    docs = frame([(i, " ".join(f"w{x}" for x in rng.zipf(1.3, 20 + i) % 200)) for i in range(240)]).select("doc_id", F.xxhash64("text").alias("h"), "text")
    blocks = br.index(docs.repartition(3), np.zeros(1 << (br.TERM_FILTER_BITS - 3), np.uint8)).where("block IS NOT NULL").select("n_docs", "bits", "ids", "hashes", "lengths", "most", "slices").toArrow()
    data = np.frombuffer(b"".join(b"w%d" % i for i in range(200)), np.uint8)
    ends = np.cumsum([len(f"w{i}") for i in range(200)])
    terms = br.textnum.RangeHash(data)(np.append(0, ends[:-1]), ends).view(np.int64)
    asked = []
    for block in range(3):
        columns = {"item": np.repeat(np.arange(20) + 20 * block, 10), "term_hash": rng.choice(terms, 200), "weight": rng.integers(1, 9000, 200)}
        columns |= {"threshold": np.full(200, 5_000_000), "tie": np.full(200, 120), "item_block": np.full(200, block)}
        asked.append(br._pack_items(br.pa.table(columns)))
    items = br.pa.concat_tables(asked)
    want = defaultdict(list)
    for q in items.to_pylist():
        for block in blocks.to_pylist():
            for i, total in br.upper_bounds(block, q, 240, 30_000):
                want[int(np.frombuffer(q["items"], np.int64)[i])] += zip(total.tolist(), np.frombuffer(block["ids"], np.int64).tolist(), strict=True)
    assert blocks.num_rows > 6 and len(want) == 60

    best = defaultdict(list)
    for row in br.cell_pairs(items, blocks, 7, 240, 30_000).to_pylist():
        best[row["item"]].append(row["bound"])
    assert {i: sorted(b) for i, b in best.items()} == {i: sorted(sorted(b for b, _ in w if b)[-7:]) for i, w in want.items()}
    through = {(r["item"], r["bound"], r["doc_id"]) for r in br.cell_pairs(items, blocks, None, 240, 30_000).to_pylist()}
    assert through == {(i, b, d) for i, w in want.items() for b, d in w if b > 5_000_000 or b == 5_000_000 and d <= 120}
    assert 0 < len(through) < 60 * 240
    assert br.cell_pairs(items.slice(0, 0), blocks, 7, 240, 30_000).num_rows == br.cell_pairs(items, blocks.slice(0, 0), None, 240, 30_000).num_rows == 0


def test_signatures_are_stored_in_small_groups_of_rows(spark):
    """Readers hold a group of rows as a whole, so its bytes are bounded, and a term is counted once for a batch of texts."""
    text = "concat_ws(' ', transform(sequence(1, {}), x -> cast(x * 1501 + {} as string)))"
    docs = spark.range(0, 1500, 1, 1).selectExpr("id AS doc_id", "id AS h", text.format(3000, "id") + " AS text")
    stored = br.index(docs, np.zeros(1 << (br.TERM_FILTER_BITS - 3), np.uint8))
    groups = []
    for name in stored.inputFiles():
        meta = pq.read_metadata(name.removeprefix("file:").replace("///", "/"))
        groups += [meta.row_group(i).total_byte_size for i in range(meta.num_row_groups)]
    assert sum(groups) > 10_000_000 and max(groups) < 8_000_000

    alike = spark.range(0, 150, 1, 1).selectExpr("id AS doc_id", "id AS h", text.format(600, "0") + " AS text")
    rows = br.index(alike, np.full(1 << (br.TERM_FILTER_BITS - 3), 255, np.uint8)).where("h IS NOT NULL").collect()
    assert len(rows) == 600 and {r["df"] for r in rows} == {150}
