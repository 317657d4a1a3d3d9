"""Token counts of byte-pair encoding with a heap and a linked list, without identifiers.

Pieces and their scores come from an existing model file. Per segment of text the adjacent pairs that form
a piece lie in a heap by score (best first, then leftmost); each pop joins two neighbours of a linked list
and pushes the two new pairs. The count is that of the initial symbols less one for each merge; a symbol
that is no piece counts as its UTF-8 bytes (byte fallback).

No piece of the vocabulary spans a boundary from another character to a space, nor a line feed, which is
checked when the model is loaded; so a text is cut there, and the count of a segment met before is looked
up. The table of such segments belongs to a worker and is emptied at a fixed size, which bounds memory and
changes no result.

Defined results: a null or empty text has no bytes and no tokens. Repeated rows get equal results, a null
id stays null, an empty table gives an empty one, other columns are not read.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch.llm.common import map_text, text_bytes

TOKENIZER = "piece_bpe_32k.model"
TOKEN_LIMIT = 4096
CACHE_SIZE = 500_000
_SEGMENT = re.compile(r" *[^ \n]+| +|\n")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class HeapBpe:
    """Counts the tokens of texts with the pieces of a sentence-piece byte-pair model."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.rank = {}
        for i in range(model.get_piece_size()):
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)):
                self.rank.setdefault(model.id_to_piece(i).replace("▁", " "), -model.get_score(i))
        for piece in self.rank:
            if "\n" in piece and len(piece) > 1 or " " in piece.lstrip(" "):
                raise ValueError(f"a piece crosses a boundary of segments: {piece!r}")
        self.seen: dict[str, int] = {}

    def segment(self, text: str) -> int:
        """Tokens of one segment."""
        rank = self.rank
        symbols = list(text)
        n = len(symbols)
        weight = [1 if c in rank else len(c.encode()) for c in symbols]
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            pair = symbols[i] + symbols[i + 1]
            if pair in rank:
                heap.append((rank[pair], i, pair))
        heapq.heapify(heap)
        total = sum(weight)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = after[i]
            if not symbols[i] or j >= n or symbols[i] + symbols[j] != pair:
                continue
            total -= weight[i] + weight[j] - 1
            weight[i] = 1
            symbols[i], symbols[j] = pair, ""
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                new = pair + symbols[k]
                if new in rank:
                    heapq.heappush(heap, (rank[new], i, new))
            k = before[i]
            if k >= 0:
                new = symbols[k] + pair
                if new in rank:
                    heapq.heappush(heap, (rank[new], k, new))
        return total

    def count(self, text: str) -> int:
        if not text:
            return 0
        total = 0
        seen = self.seen
        for part, times in Counter(_SEGMENT.findall(" " + text.replace("▁", " "))).items():
            n = seen.get(part)
            if n is None:
                if len(seen) >= CACHE_SIZE:
                    seen.clear()
                n = self.segment(part)
                if len(part) <= 64:
                    seen[part] = n
            total += times * n
        return total


@lru_cache(maxsize=2)
def counter(path: str) -> HeapBpe:
    return HeapBpe(path)


def token_counts(docs: DataFrame, path: str | None = None, limit: int = TOKEN_LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (n_tokens > limit) of each row.

    `path` is the model file; by default the public one, looked up where the task runs.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        bpe = counter(path or tokenizer_path())
        texts = batch.column("text")
        n = np.fromiter((bpe.count(t) for t in texts.to_pylist()), np.int64, len(texts))
        _, offsets = text_bytes(texts)
        columns = [batch.column("doc_id"), pa.array(np.diff(offsets)), pa.array(n), pa.array(n > limit)]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    schema = "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"
    return map_text(docs.select(F.col("doc_id").cast("bigint"), "text"), work, schema)
