"""Substring de-duplication by sliding sentence spans.

A text is cut into sentences: after a word that ends with a full stop, exclamation or question mark and at a
line end. A sentence of more than `LONG_WORDS` words, far above the ordinary length, is cut by its content, so that a
passage is cut alike wherever it stands in one: after each word whose hash is 0 modulo `CUT_EVERY`, and after each
word that ends `PIECE_WORDS` words of the sentence without such a word. Every run of `SPAN` consecutive sentences is
hashed (128 bits, over words in lower case A-Z); a run of fewer than `SPAN_WORDS` words takes as many sentences
more, before or behind it, as it needs, so that nothing shorter than that goes. The hashes are joined over all
documents, and a sentence goes if a run that covers it is found more than once and not for the first time.
The first time is the one of smallest id, then text hash, then place; a passage within one text counts too.

Only hashes with their places are shuffled: once to count each run and take its first place, and once to join the
runs with the firsts of those that repeat. A run that a third of all documents share makes one aggregated row and a
join side that adaptive execution splits. Places are collected per document only, which its own length bounds.

Defined results: rows with equal id and text are one document, and get equal results; null ids come first.
A null text stays null and has no sentences, an empty one stays empty, one of fewer than `SPAN` sentences or
`SPAN_WORDS` words has no run and stays, very long texts are cut whole. An empty table gives an empty one. Columns named like one of the result are replaced by it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch.llm import textnum
from cardwatch.llm.common import map_text, save, text_bytes

SPAN = 3
SPAN_WORDS = 30
LONG_WORDS = 24
PIECE_WORDS = 16
CUT_EVERY = 8
_STOPS = np.zeros(256, bool)
_STOPS[[ord(c) for c in ".!?"]] = True
_CLOSERS = np.zeros(256, bool)
_CLOSERS[[ord(c) for c in "\"')]"]] = True


class Sentences:
    """The sentences of some texts: first word, number of words, text number, first byte, place in the text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, long_words: int = LONG_WORDS):
        self.low = textnum.lower_ascii(data)
        self.starts, self.ends, owner = textnum.words(data, offsets)
        n = len(self.starts)
        if not n:
            self.first = self.size = self.owner = self.byte = self.place = np.zeros(0, np.int64)
            self.count = np.zeros(len(offsets) - 1, np.int64)
            return
        tail = data[self.ends - 1]
        stop = _STOPS[tail] | (_CLOSERS[tail] & _STOPS[data[np.maximum(self.ends - 2, self.starts)]])
        feeds = np.concatenate([[0], np.cumsum(data == 10)])
        begins = np.ones(n, bool)
        begins[1:] = stop[:-1] | (owner[1:] != owner[:-1]) | (feeds[self.starts[1:]] > feeds[self.ends[:-1]])
        at = np.flatnonzero(begins)
        length = np.diff(np.append(at, n))
        mark = textnum.RangeHash(self.low)(self.starts, self.ends) % np.uint64(CUT_EVERY) == 0
        # the last such word, or else the one before the sentence
        last = np.maximum.accumulate(np.where(mark, np.arange(n), np.where(begins, np.arange(n) - 1, -1)))
        cut = np.repeat(length > long_words, length) & (mark | (np.arange(n) - last >= PIECE_WORDS))
        begins[1:] |= cut[:-1]
        self.first = np.flatnonzero(begins)
        self.size = np.diff(np.append(self.first, n))
        self.owner = owner[self.first]
        self.byte = self.starts[self.first]
        self.count = np.bincount(self.owner, minlength=len(offsets) - 1)
        self.place = np.arange(len(self.first)) - np.repeat(np.cumsum(self.count) - self.count, self.count)

    def runs(self, span: int, least_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """First sentence, number of sentences and two hashes of each run."""
        n = len(self.first)
        upto = np.concatenate([[0], np.cumsum(self.size)])
        at = np.arange(n)
        # the shortest run from each sentence on, and the shortest one up to each
        last = np.maximum(at + span - 1, np.searchsorted(upto, upto[:-1] + least_words, "left") - 1)
        begin = np.minimum(at - span + 1, np.searchsorted(upto, upto[1:] - least_words, "right") - 1)
        first, last = np.concatenate([at, begin]), np.concatenate([last, at])
        inside = (first >= 0) & (last < n)
        first, last = first[inside], last[inside]
        inside = self.owner[first] == self.owner[last]
        pairs = np.unique(first[inside] * (n + 1) + last[inside])
        first, last = pairs // (n + 1), pairs % (n + 1)
        out = []
        for which in (0, 1):
            word = textnum.RangeHash(self.low, which)(self.starts, self.ends)
            run = textnum.RangeHash(textnum.mix(word), which)
            out.append(run(self.first[first], (self.first + self.size)[last]))
        return first, last - first + 1, out[0], out[1]


def span_hashes(docs: DataFrame, span: int, least_words: int, long_words: int) -> DataFrame:
    """h1, h2, doc_id, text_hash, place and number of sentences of every run of every text."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        s = Sentences(*text_bytes(batch.column("text")), long_words)
        at, size, h1, h2 = s.runs(span, least_words)
        rows = pa.array(s.owner[at])
        return pa.RecordBatch.from_arrays(
            [
                pa.array(h1.view(np.int64)),
                pa.array(h2.view(np.int64)),
                batch.column("doc_id").take(rows),
                batch.column("text_hash").take(rows),
                pa.array(s.place[at].astype(np.int32)),
                pa.array(size.astype(np.int32)),
            ],
            ["h1", "h2", "doc_id", "text_hash", "place", "size"],
        )

    rows = docs.select(F.col("doc_id").cast("bigint"), F.xxhash64("text").alias("text_hash"), "text")
    return map_text(rows, work, "h1 bigint, h2 bigint, doc_id bigint, text_hash bigint, place int, size int")


def dedup(
    docs: DataFrame, span: int = SPAN, least_words: int = SPAN_WORDS, long_words: int = LONG_WORDS
) -> DataFrame:
    """The rows with the text that is left, n_sentences and n_removed."""
    spans = span_hashes(docs, span, least_words, long_words)
    place = F.struct("doc_id", "text_hash", "place")
    # hashed twice rather than stored; first places are taken before the shuffle, so a hot run is a row per task
    first = spans.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1").drop("n")
    again = spans.join(save(first, "repeated-spans"), ["h1", "h2"]).where(~place.eqNullSafe(F.col("first")))
    cuts = again.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("place", "size")).alias("runs"))
    cuts = cuts.select(F.col("doc_id").alias("cut_id"), F.col("text_hash").alias("cut_hash"), F.col("runs.place").alias("places"), F.col("runs.size").alias("sizes"))
    names = [c for c in docs.columns if c not in ("n_sentences", "n_removed")]
    inner = [f"c{i}" for i in range(len(names))]
    rows = docs.select(*[F.col(c).alias(x) for c, x in zip(names, inner, strict=True)])
    text = inner[names.index("text")]
    doc_id = F.col(inner[names.index("doc_id")]).cast("bigint")
    same = doc_id.eqNullSafe(F.col("cut_id")) & F.xxhash64(text).eqNullSafe(F.col("cut_hash"))
    joined = rows.join(cuts, same, "left").select(
        *inner, *[F.coalesce(c, F.array().cast("array<int>")).alias(c) for c in ("places", "sizes")]
    )
    schema = rows.schema.add("n_sentences", "long").add("n_removed", "long")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        column = batch.column(text)
        data, offsets = text_bytes(column)
        s = Sentences(data, offsets, long_words)
        lists = batch.column("places")
        row = np.repeat(np.arange(len(column)), np.diff(lists.offsets.to_numpy()))
        place = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        size = batch.column("sizes").flatten().to_numpy(zero_copy_only=False)
        first = (np.cumsum(s.count) - s.count)[row] + place
        marks = np.zeros(len(s.first) + 1, np.int64)
        np.add.at(marks, first, 1)
        np.add.at(marks, first + size, -1)
        gone = np.cumsum(marks)[:-1] > 0
        # a sentence goes with the space behind it
        stops = np.append(s.byte, len(data))[1:]
        stops = np.minimum(stops, offsets[s.owner + 1]) if len(stops) else stops
        edge = np.zeros(len(data) + 1, np.int8)
        np.add.at(edge, s.byte[gone], 1)
        np.add.at(edge, stops[gone], -1)
        left = np.cumsum(edge[:-1], dtype=np.int8) == 0
        kept = np.concatenate([[0], np.cumsum(left)])[offsets].astype(np.int32)
        valid = column.is_valid()
        new = pa.StringArray.from_buffers(len(column), pa.py_buffer(kept), pa.py_buffer(data[left]))
        new = pa.compute.if_else(valid, new, pa.scalar(None, pa.string()))
        columns = [new if c == text else batch.column(c) for c in inner]
        n_removed = np.bincount(s.owner[gone], minlength=len(column)).astype(np.int64)
        return pa.RecordBatch.from_arrays([*columns, pa.array(s.count), pa.array(n_removed)], [*inner, "n_sentences", "n_removed"])

    out = map_text(joined, work, schema, text)
    return out.select(*[F.col(x).alias(c) for c, x in zip(names, inner, strict=True)], "n_sentences", "n_removed")
