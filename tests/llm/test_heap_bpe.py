from __future__ import annotations

import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cardwatch.llm import heap_bpe as hb

PATH = hb.tokenizer_path()
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)


def check(got, texts):
    for r in got:
        text = texts[r["doc_id"]] or ""
        n = len(LIBRARY.encode(text))
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), n, n > 4096)


def test_corpus(corpus, texts):
    got = hb.token_counts(corpus).collect()
    assert len(got) == len(texts)
    check(got, texts)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab the\n\t \x00.,_=é日🙂　▁12<s>/ing")), max_size=60) | st.text(max_size=40))
def test_any_text(text):
    assert hb.counter(PATH).count(text) == len(LIBRARY.encode(text))


def test_table_of_segments_is_emptied(monkeypatch):
    monkeypatch.setattr(hb, "CACHE_SIZE", 3)
    bpe = hb.HeapBpe(PATH)
    text = " ".join(f"word{i} again" for i in range(50))
    assert bpe.count(text) == len(LIBRARY.encode(text)) and len(bpe.seen) <= 3


def test_edge_cases(frame):
    rows = [(1, None), (2, ""), (None, "a b"), (3, "x" * 20_000), (4, "<s>é日🙂</s>" * 3000), (5, " \n" * 50), (5, " \n" * 50)]
    got = hb.token_counts(frame(rows, n_tokens=F.lit("clash"))).collect()
    assert len(got) == len(rows)
    check(got, dict(rows))
    assert hb.token_counts(frame([])).collect() == []
