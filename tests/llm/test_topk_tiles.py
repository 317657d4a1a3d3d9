from __future__ import annotations

import math
import random

from pyspark.sql import functions as F

from cardwatch.llm import topk_tiles as tk

SCHEMA = "vec_id bigint, embedding array<float>"


def brute(rows, k=tk.K, every=tk.QUERY_EVERY):
    good = [(i, [math.floor(64 * x) if abs(x) < 2**53 else 64 * int(x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for at, (i, a) in enumerate(good):
        if i is None or i % every:
            continue
        scores = [(max(-(2**63), min(2**63 - 1, sum(x * y for x, y in zip(a, b, strict=False)))), j) for n, (j, b) in enumerate(good) if n != at]
        scores.sort(key=lambda s: (-s[0], s[1] is None, s[1] or 0))
        out += [(i, r + 1, j, s) for r, (s, j) in enumerate(scores[:k])]
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_given_vectors_in_small_tiles(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select("vec_id", "embedding")
    want = brute([tuple(r) for r in vectors.collect()])
    assert len(want) == 500
    assert found(tk.search(vectors)) == want
    assert found(tk.search(vectors.repartition(7), shard=16, query_block=3)) == want


def test_ties_copies_nulls_and_odd_vectors(spark, scattered):
    rng = random.Random(3)
    same = [0.5, -0.25, 0.125]
    rows = [(i, same if i % 3 else [rng.uniform(-1, 1) for _ in range(3)]) for i in range(130)]
    rows += [(20, same), (20, same), (None, same), (None, [9.0, 9.0, 9.0]), (-40, same)]
    rows += [(200, None), (220, [1.0, None, 2.0]), (240, [float("nan"), 0.0, 0.0]), (260, [float("inf"), 0.0, 0.0]), (280, []), (300, [0.1] * 9)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4).withColumns({"score": F.lit("x"), "rank": F.lit(1)})
    for shard, block in ((8, 4), (4096, 1024)):
        assert found(tk.search(df, shard=shard, query_block=block)) == brute(spark.createDataFrame(rows, SCHEMA).collect())
    assert found(tk.search(df.where("vec_id = 20").limit(1))) == []
    assert found(tk.search(df.limit(0))) == []


def test_large_components(spark):
    rng = random.Random(5)
    rows = [(i, [rng.uniform(-1, 1) * 10.0 ** rng.choice([0, 3, 8, 12, 20, 37]) for _ in range(4)]) for i in range(60)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(tk.search(df, shard=9)) == brute([tuple(r) for r in df.collect()])
    middle = spark.createDataFrame([(i, [rng.uniform(-1, 1) * 1e4 for _ in range(4)]) for i in range(60)], SCHEMA)
    assert found(tk.search(middle)) == brute([tuple(r) for r in middle.collect()])


def test_grid():
    for n_queries, n_rows, blocks, shards in ((1, 1, 1, 1), (150_000, 3_000_000, 150, 800), (2_000, 40_000, 2, 16), (5, 10**9, 1, 250_000)):
        rows, columns = tk.grid(n_queries, n_rows, 6, blocks, shards)
        assert 1 <= rows <= blocks and 1 <= columns <= shards
        assert rows * columns * tk.CELL_MOST * 2 >= n_queries * n_rows or (rows, columns) == (blocks, shards)
