"""Benchmark decontamination by SimHash windows and exact verification.

Words are runs of what is neither white space nor ASCII punctuation, in lower case A-Z. Shingles are five
words; a shingle's weight is ln(1 + items / items that have it), so wording that many items share counts
less. A benchmark item of n words is compared with windows of n words of each document.

1. Windows: those that share a shingle with an item of that size; others have similarity 0.
2. Candidates: a window's SimHash (64 bits, weighted) is cut into `BLOCKS` blocks; an index has, for each value of
   a block, the items that differ in at most RADIUS / BLOCKS bits there. At least one block of two
   fingerprints within the radius is that close, so no such pair is lost.
3. Verification: the weighted Jaccard similarity of the shingles, with repeats, is `SIMILARITY` or more.

Items are sent to the tasks in blocks of at most `ITEMS_AT_ONCE`, each a pass over the documents; what is
sent does not grow with the documents.

Defined results: an item or window with fewer than five words has its whole sequence as shingle, so it is
found where its words stand in order. Null or empty texts and items without a word match nothing. Repeated
rows get equal results, a null id stays null, a null item id is not reported. Empty tables: no item, no
match; no document, no row. Only id and text are read.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch.llm import textnum
from cardwatch.llm.common import map_text, text_bytes

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 15
BLOCKS = 5
ITEMS_AT_ONCE = 4000
_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[65:91] += 32
_PLAIN[[c for c in range(33, 127) if not chr(c).isalnum()]] = 32


def _words(data: np.ndarray, offsets: np.ndarray):
    """Hash and text number of each word."""
    plain = _PLAIN[data]
    starts, ends, owner = textnum.words(plain, offsets)
    return textnum.RangeHash(plain)(starts, ends), owner


@dataclass
class Benchmark:
    """A block of items and its index."""

    ids: list[int]
    words: list[np.ndarray]  # of each item: word hashes
    radius: int
    n_items: int
    weight: dict[int, float]
    shingles: list[Counter] = field(default_factory=list)

    def __post_init__(self):
        self.shingles = [Counter(_shingles(w).tolist()) for w in self.words]
        self.size = np.array([len(w) for w in self.words], np.int64)
        pairs = sorted({(h, int(n)) for s, n in zip(self.shingles, self.size, strict=True) if n >= SHINGLE for h in s})
        self.known = np.array([h for h, _ in pairs], np.uint64)
        self.known_size = np.array([n for _, n in pairs], np.int64)
        self.fps = np.concatenate([window_prints(_shingles(w), np.array([0]), np.array([max(1, len(w) - SHINGLE + 1)]), self.weights) for w in self.words] or [np.zeros(0, np.uint64)])
        edges = np.linspace(0, 64, BLOCKS + 1).astype(int)
        self.blocks = list(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True))
        self.index = []
        for lo, hi in self.blocks:
            own = (self.fps >> np.uint64(lo)) & np.uint64((1 << (hi - lo)) - 1)
            values = np.arange(1 << (hi - lo), dtype=np.uint64)
            rows = [np.flatnonzero(np.bitwise_count(v ^ own) <= self.radius // BLOCKS) for v in values]
            self.index.append((np.concatenate([[0], np.cumsum([len(r) for r in rows])]), np.concatenate(rows).astype(np.int32)))
        self.short = defaultdict(dict)
        for i, w in enumerate(self.words):
            if 0 < len(w) < SHINGLE:
                self.short[len(w)].setdefault(int(_shingles(w)[0]), []).append(i)

    def weights(self, shingles: np.ndarray) -> np.ndarray:
        other = np.log1p(self.n_items)
        values, back = np.unique(shingles, return_inverse=True)
        return np.array([self.weight.get(v, other) for v in values.tolist()])[back] if len(values) else np.zeros(0)

    def candidates(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Window and item numbers within the radius."""
        found = []
        for (lo, hi), (begin, items) in zip(self.blocks, self.index, strict=True):
            v = ((fps >> np.uint64(lo)) & np.uint64((1 << (hi - lo)) - 1)).astype(np.int64)
            n = begin[v + 1] - begin[v]
            window = np.repeat(np.arange(len(fps)), n)
            item = items[np.repeat(begin[v] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
            near = np.bitwise_count(fps[window] ^ self.fps[item]) <= self.radius
            found.append(window[near] * np.int64(len(self.ids)) + item[near])
        both = np.unique(np.concatenate(found))
        return both // max(1, len(self.ids)), both % max(1, len(self.ids))

    def similarity(self, item: int, shingles: np.ndarray) -> float:
        ours, theirs = self.shingles[item], Counter(shingles.tolist())
        other = float(np.log1p(self.n_items))
        low = high = 0.0
        for s in ours.keys() | theirs.keys():
            w = self.weight.get(s, other)
            low += w * min(ours[s], theirs[s])
            high += w * max(ours[s], theirs[s])
        return low / high if high else 0.0


def _shingles(words: np.ndarray) -> np.ndarray:
    return textnum.join_hashes(words, min(SHINGLE, len(words))) if len(words) else np.zeros(0, np.uint64)


def window_prints(shingles: np.ndarray, begin: np.ndarray, stop: np.ndarray, weights) -> np.ndarray:
    """SimHash of each range of shingles."""
    used = np.zeros(len(shingles) + 1, np.int64)
    np.add.at(used, begin, 1)
    np.add.at(used, stop, -1)
    inside = np.flatnonzero(np.cumsum(used)[:-1] > 0)
    if not len(inside):
        return np.zeros(len(begin), np.uint64)
    place = np.zeros(len(shingles) + 1, np.int64)
    place[inside] = np.arange(len(inside))
    own = shingles[inside]
    bits = np.unpackbits(textnum.mix(own).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    sums = np.concatenate([np.zeros((1, 64)), np.cumsum((2.0 * bits - 1) * weights(own)[:, None], axis=0)])
    total = sums[place[stop - 1] + 1] - sums[place[begin]]
    return np.packbits(total > 1e-9, axis=1, bitorder="little").view(np.uint64)[:, 0]


def matches(bench: Benchmark, data: np.ndarray, offsets: np.ndarray, least: float) -> list[tuple[int, int, float]]:
    """(text number, item number, similarity) of what is found, the most similar window of each pair."""
    word, owner = _words(data, offsets)
    best: dict[tuple[int, int], float] = {}
    for size, known in bench.short.items():
        runs = textnum.join_hashes(word, size)
        whole = owner[: len(runs)] == owner[size - 1 :] if len(runs) else np.zeros(0, bool)
        wanted = np.array(list(known), np.uint64)
        for at in np.flatnonzero(whole & np.isin(runs, wanted)).tolist():
            for item in known[int(runs[at])]:
                best[int(owner[at]), item] = 1.0
    shingles = textnum.join_hashes(word, SHINGLE)
    if len(shingles) and len(bench.known):
        whole = owner[: len(shingles)] == owner[SHINGLE - 1 :]
        lo = np.searchsorted(bench.known, shingles)
        lo[lo == len(bench.known)] = 0
        hit = np.flatnonzero(whole & (bench.known[lo] == shingles))
        n = np.searchsorted(bench.known, shingles[hit], "right") - lo[hit]
        at = np.repeat(hit, n)
        size = bench.known_size[np.repeat(lo[hit] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        # windows of that size around each hit, inside the text
        count = np.bincount(owner, minlength=len(offsets) - 1)
        head = (np.cumsum(count) - count)[owner[at]]
        tail = head + count[owner[at]]
        first = np.maximum(head, at + SHINGLE - size)
        last = np.maximum(first, np.minimum(at, tail - size))
        n = last - first + 1
        begin = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
        windows = np.unique(np.stack([begin, np.repeat(size, n)], 1), axis=0)
        begin = windows[:, 0]
        end = np.minimum(begin + windows[:, 1], (np.cumsum(count))[owner[begin]]) if len(begin) else begin
        stop = end - SHINGLE + 1
        fps = window_prints(shingles, begin, stop, bench.weights)
        window, item = bench.candidates(fps)
        same = windows[window, 1] == bench.size[item]
        for w, i in zip(window[same].tolist(), item[same].tolist(), strict=True):
            key = (int(owner[begin[w]]), i)
            if best.get(key, 0.0) < 1.0:
                s = bench.similarity(i, shingles[begin[w] : stop[w]])
                if s >= least and s > best.get(key, 0.0):
                    best[key] = s
    return [(*k, v) for k, v in best.items()]


def _load(items: DataFrame, radius: int, at_once: int) -> list[Benchmark]:
    rows = sorted({(r["item_id"], r["text"]) for r in items.where("item_id IS NOT NULL AND text IS NOT NULL").select("item_id", "text").toLocalIterator()})
    column = pa.array([t for _, t in rows], pa.string())
    data, offsets = text_bytes(column)
    word, owner = _words(data, offsets)
    words = [word[owner == i] for i in range(len(rows))]
    having = Counter(h for w in words for h in set(_shingles(w).tolist()))
    weight = {h: float(np.log1p(len(rows) / n)) for h, n in having.items()}
    full = [i for i, w in enumerate(words) if len(w)]
    return [
        Benchmark([rows[i][0] for i in full[k : k + at_once]], [words[i] for i in full[k : k + at_once]], radius, len(rows), weight)
        for k in range(0, len(full), at_once)
    ]


def contamination(
    docs: DataFrame, items: DataFrame, least: float = SIMILARITY, radius: int = RADIUS, at_once: int = ITEMS_AT_ONCE
) -> DataFrame:
    """doc_id, contaminated, n_items, items (their ids in order) and similarity (the greatest) of each row."""
    return annotate(docs.select(F.col("doc_id").cast("bigint"), "text"), items, least, radius, at_once).select(
        "doc_id", (F.size("items") > 0).alias("contaminated"), F.size("items").cast("bigint").alias("n_items"), "items", "similarity"
    )


def annotate(
    docs: DataFrame, items: DataFrame, least: float = SIMILARITY, radius: int = RADIUS, at_once: int = ITEMS_AT_ONCE
) -> DataFrame:
    """The rows with the columns items and similarity."""
    names = [c for c in docs.columns if c not in ("items", "similarity")]
    inner = [f"c{i}" for i in range(len(names))]
    rows = docs.select(*[F.col(c).alias(x) for c, x in zip(names, inner, strict=True)])
    rows = rows.withColumn("items", F.array().cast("array<bigint>")).withColumn("similarity", F.lit(0.0))
    text = inner[names.index("text")]

    def step(rows: DataFrame, bench: Benchmark) -> DataFrame:
        shared = rows.sparkSession.sparkContext.broadcast(bench)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = matches(shared.value, *text_bytes(batch.column(text)), least)
            ids, top = batch.column("items").to_pylist(), batch.column("similarity").to_pylist()
            for row, item, similarity in found:
                ids[row].append(shared.value.ids[item])
                top[row] = max(top[row], similarity)
            columns = [*(batch.column(c) for c in inner), pa.array([sorted(set(x)) for x in ids], pa.list_(pa.int64())), pa.array(top, pa.float64())]
            return pa.RecordBatch.from_arrays(columns, [*inner, "items", "similarity"])

        return map_text(rows, work, rows.schema, text)

    rows = reduce(step, _load(items, radius, at_once), rows)
    return rows.select(*[F.col(x).alias(c) for c, x in zip(names, inner, strict=True)], "items", "similarity")
