from __future__ import annotations

import corpus_pipeline as cp
from test_decontaminate import brute as windows
from test_near_copies import brute as near
from test_sentence_dedup import brute as spans

from cardwatch.llm import crf_language
from cardwatch.llm.common import save


def test_stages_against_brute_force(spark, corpus):
    src = "/root/testdata/sf0.001"
    items = [tuple(r) for r in spark.read.parquet(f"{src}/benchmark.parquet").select("item_id", "text").collect()]
    docs, kept = corpus, {}
    for k, (name, stage) in enumerate(cp.STAGES):
        before = {r["doc_id"]: r for r in docs.collect()}
        out = stage(spark, docs, src)
        if k < len(cp.STAGES) - 1:
            assert out.columns == corpus.columns and out.dtypes == corpus.dtypes
        docs = save(out, name)
        kept[name] = {r["doc_id"]: r for r in docs.collect()}
        after, text = kept[name], {i: r["text"] for i, r in before.items()}
        assert docs.count() == len(after)
        if name == "language":
            field = crf_language.train(corpus)
            label = {r["doc_id"]: r for r in crf_language.label(corpus, field).collect()}
            assert set(after) == {i for i, r in label.items() if r["lang_pred"] != "und" and r["score"] >= cp.LEAST_SCORE}
        elif name == "near_duplicates":
            assert set(after) == near(text.items())
        elif name == "repeated_sentences":
            want = spans(text.items())
            left = {i: w for (i, _), w in want.items() if w[2] == 0 or w[2] < w[1]}
            assert {i: r["text"] for i, r in after.items()} == {i: w[0] for i, w in left.items()}
            assert all(r["n_chars"] == (len(r["text"]) if left[i][2] else before[i]["n_chars"]) for i, r in after.items())
        elif name == "benchmark_passages":
            assert set(after) == set(before) - set(windows(text.items(), items))
        else:
            assert set(after) == set(before)
            assert all(after[i]["text"] == text[i] for i in after)
    assert len(kept["mixture"]) < corpus.count()


def test_run_gives_the_last_stage(spark):
    got = cp.run(spark, "/root/testdata/sf0.001").collect()
    assert got and len({r["doc_id"] for r in got}) == len(got)
    assert {"slot", "block_offset", "order_key"} <= set(got[0].asDict())


def test_empty_and_null_documents(spark, frame):
    for rows in ([], [(1, None, None), (None, "", None), (2, "12 34", "en")]):
        docs = frame(rows)
        for _, stage in cp.STAGES:
            docs = stage(spark, docs, "/root/testdata/sf0.001")
        assert docs.collect() == []
