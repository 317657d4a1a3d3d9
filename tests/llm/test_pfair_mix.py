from __future__ import annotations

from collections import Counter

import pytest
from compare import connect, mismatch
from pyspark.sql import functions as F

from cardwatch.llm import pfair_mix as pm
from cardwatch.llm import queries


def test_default_mixture_equals_sql(spark):
    src = "/root/testdata/sf0.001"
    assert mismatch(queries.op6_pfair_mix(spark, src), queries.oracle_sql()["op6_pfair_mix"], connect(src)) is None


@pytest.mark.parametrize("weights", [[1], [3, 3, 3], [1, 2, 4, 8, 16], [7, 1, 1, 1, 1, 13], [50, 33, 17]])
def test_every_block_lies_in_its_window(spark, weights):
    frame = spark.createDataFrame([(f"={k}", n) for k, n in enumerate(weights)], "mix_source string, n bigint")
    rows = pm.schedule(frame).collect()
    period = sum(weights)
    assert sorted(r["slot"] for r in rows) == list(range(period))
    for r in rows:
        assert r["k"] * period // r["n"] <= r["slot"] < -(-(r["k"] + 1) * period // r["n"])
    done = Counter()
    for t, r in enumerate(sorted(rows, key=lambda r: r["slot"]), 1):
        done[r["mix_source"]] += 1
        for k, n in enumerate(weights):
            assert abs(done[f"={k}"] - t * n / period) < 1


def test_edge_cases(spark, frame):
    rows = [(i, "x" * (i % 7 * 10), "en", ["a", "b", None][i % 3]) for i in range(60)]
    rows += [(1, None, "en", "a"), (None, "null id", "en", "b"), (1, "x" * 10, "en", "b"), (1, "x" * 10, "en", "b"), (90, "y" * 5000, "en", "")]
    docs = frame(rows, slot=F.lit("clash"), chars=F.lit("clash"), n=F.lit(1))
    got = pm.mix(docs, docs.columns, block_chars=100).collect()
    assert len(got) == len(rows)
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=repr) == sorted(((r[0], r[1]) for r in rows), key=repr)
    assert all(r["n"] == 1 and r["chars"] == len(r["text"] or "") for r in got)
    for source in ("a", "b", None, ""):
        own = sorted((r for r in got if r["source"] == source), key=lambda r: (r["slot"], r["block_offset"], r["order_key"]))
        at = 0
        for r in sorted(own, key=lambda r: r["order_key"]):
            assert (r["block"], r["block_offset"]) == (at // 100, at % 100)
            at += r["chars"]
        assert [r["block"] for r in own] == sorted(r["block"] for r in own)
    given = spark.createDataFrame([("=a", 3), ("=b", 1), ("", 1), ("=", 2)], "mix_source string, n bigint")
    again = pm.mix(docs, ["doc_id", "source"], given, 100).collect()
    assert len(again) == len(rows) and max(r["slot"] for r in again if r["source"] == "") % 7 >= 0
    assert pm.mix(frame([]), ["doc_id"]).collect() == []
