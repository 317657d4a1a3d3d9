"""Removal of repeated byte strings by suffix sorting with Lyndon groups.

A byte goes if a string of `length` bytes that covers it also starts anywhere else, in the same text or in
another. All such windows are judged on the input.

Where windows can be equal is found by anchors. The anchor of a window is its leftmost gram of `gram` bytes of
smallest hash, so equal windows have equal anchors at the same place; the windows of a text fall into runs with
one anchor. Anchors whose gram occurs once are done with. A run's context are the bytes of its windows; a
context that occurs again repeats all its windows. Contexts that differ but share an anchor gram need the
order of their windows: there the gram is one symbol, and the suffixes of the contexts of some groups are
sorted in a task by their Lyndon groups (`suffix_order`); equal windows are neighbours in that order. Groups
with more than `group_limit` contexts aren't put into one task: their windows are counted by key instead.

Hashes decide only where to look, and which contexts are equal (128 bits); windows are compared by symbols.
The two filters sent to the tasks have a fixed size. They let all through that is wanted and some that is
not, which exact joins then drop. Text is shuffled once, to the ranges of its document.

Defined results: a null text counts as empty; texts shorter than `length` stay as they are. Repeated rows are
copies of each other like any other texts, with equal results. A null id stays null, an empty table gives an
empty one, other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch.llm import textnum
from cardwatch.llm.common import map_text, save, text_bytes

LENGTH = 400
GRAM = 320
GROUP_LIMIT = 2000
#: Symbols that are sorted at once.
SORT_SYMBOLS = 1 << 16
#: Contexts that a task sorts, about.
TASK_CONTEXTS = 4000
FILTER_BITS = 27
_RANGES = 64


def suffix_order(s: list[int]) -> list[int]:
    """Suffix array of a sequence of small non-negative integers.

    First the suffixes are put into groups, of equal Lyndon prefix in the end: groups are taken in descending
    order, each suffix of a group looks up its previous smaller suffix, and those found go into new groups right
    above their old ones, the more often found the higher. Then the order is emitted from the smallest suffix on:
    each suffix puts those that it ends, found along the previous-smaller pointers, in the next place of their group.
    """
    n = len(s)
    values = sorted(set(s))
    rank = {v: g for g, v in enumerate(values)}
    group = [rank[v] for v in s]
    members: list[list[int]] = [[] for _ in values]
    for i, g in enumerate(group):
        members[g].append(i)
    up = [*range(1, len(values)), -1]
    down = list(range(-1, len(values) - 1))
    smaller = [-1] * n
    done = bytearray(n)
    descending = []
    g = len(values) - 1
    while g >= 0:
        own = [i for i in members[g] if group[i] == g]
        members[g] = own
        if own:
            descending.append(g)
            for i in own:
                done[i] = 1
            found: dict[int, int] = {}
            for i in own:  # in ascending order
                p = i - 1
                while p >= 0 and done[p]:
                    p = smaller[p]
                smaller[i] = p
                if p >= 0:
                    found[p] = found.get(p, 0) + 1
            by_count: dict[int, list[int]] = {}
            for p, times in found.items():
                by_count.setdefault(times, []).append(p)
            for times in sorted(by_count, reverse=True):
                fresh: dict[int, int] = {}
                for p in by_count[times]:
                    old = group[p]
                    new = fresh.get(old)
                    if new is None:
                        new = fresh[old] = len(members)
                        members.append([])
                        above = up[old]
                        up.append(above)
                        down.append(old)
                        up[old] = new
                        if above >= 0:
                            down[above] = new
                    group[p] = new
                    members[new].append(p)
        g = down[g]
    place = [0] * len(members)
    at = 0
    for g in reversed(descending):
        place[g] = at
        at += len(members[g])
    order = [-1] * n
    placed = bytearray(n)
    for k in range(-1, n):
        p = (order[k] if k >= 0 else n) - 1
        while p >= 0 and not placed[p]:
            g = group[p]
            order[place[g]] = p
            place[g] += 1
            placed[p] = 1
            p = smaller[p]
    return order


def anchors(data: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """Text number, anchor x, window starts lo..hi (all as places in data) and gram hash of every run."""
    width = length - gram + 1
    n = len(data) - gram + 1
    if n < width or not (np.diff(offsets) >= length).any():
        return *(np.zeros(0, np.int64) for _ in range(4)), np.zeros(0, np.uint64)
    ranges = textnum.RangeHash(data)
    h = (ranges.sums[gram:] - ranges.sums[:n]) * ranges.down[:n]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    # least hash of each window, by doubling
    low, span = h, 1
    while span * 2 <= width:
        low = np.minimum(low[: len(low) - span], low[span:])
        span *= 2
    m = len(h) - width + 1
    low = np.minimum(low[:m], low[width - span : width - span + m])
    starts = np.ones(m, bool)
    np.not_equal(low[1:], low[:-1], out=starts[1:])
    starts[offsets[:-1][offsets[:-1] < m]] = True
    s = np.flatnonzero(starts)
    owner = np.searchsorted(offsets, s, "right") - 1
    e = np.minimum(np.append(s[1:], m) - 1, offsets[owner + 1] - length)
    s, e, owner = (v[s <= e] for v in (s, e, owner))
    out = []
    steps = np.arange(width)
    while len(s):
        x = np.empty(len(s), np.int64)
        for k in range(0, len(s), 20_000):
            x[k : k + 20_000] = s[k : k + 20_000] + h[s[k : k + 20_000, None] + steps].argmin(axis=1)
        out.append((owner, x, s, np.minimum(e, x), h[x]))
        more = e > x  # the anchor repeats further on in these
        s, e, owner = x[more] + 1, e[more], owner[more]
    return tuple(np.concatenate(v) for v in zip(*out, strict=True))


def _bit_filter(keys: DataFrame) -> np.ndarray:
    """Bits of all keys (column h): 2 ** FILTER_BITS of them, in as many rows as there are ranges."""
    bits = FILTER_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, np.ndarray] = {}
        for batch in batches:
            slot = batch.column("h").to_numpy().view(np.uint64) >> np.uint64(64 - bits)
            part = (slot >> np.uint64(bits - 6)).astype(np.int64)
            for r in np.unique(part).tolist():
                own = parts.setdefault(r, np.zeros((1 << (bits - 6)) // 8, np.uint8))
                at = (slot[part == r] & np.uint64((1 << (bits - 6)) - 1)).astype(np.int64)
                np.bitwise_or.at(own, at >> 3, (1 << (at & 7)).astype(np.uint8))
        yield pa.RecordBatch.from_arrays([pa.array(list(parts), pa.int32()), pa.array([v.tobytes() for v in parts.values()], pa.binary())], ["part", "bits"])

    out = np.zeros((_RANGES, (1 << (bits - 6)) // 8), np.uint8)
    ranges = keys.select("h").repartition(_RANGES, F.shiftrightunsigned("h", 58))
    for row in ranges.mapInArrow(run, "part int, bits binary").toLocalIterator():
        out[row["part"]] |= np.frombuffer(row["bits"], np.uint8)
    return out.reshape(-1)


def _passes(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    slot = (h >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
    return (bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1


class _Runs:
    """Runs of the texts of a batch, those that pass a filter."""

    def __init__(self, batch: pa.RecordBatch, length: int, gram: int, bits: np.ndarray | None = None):
        self.data, self.offsets = text_bytes(batch.column("text"))
        self.owner, self.x, self.lo, self.hi, self.h = anchors(self.data, self.offsets, length, gram)
        if bits is not None:
            ok = _passes(bits, self.h)
            self.owner, self.x, self.lo, self.hi, self.h = (v[ok] for v in (self.owner, self.x, self.lo, self.hi, self.h))

    def context_hash(self, length: int) -> np.ndarray:
        own = textnum.RangeHash(self.data, 1)(self.lo, self.hi + length)
        return textnum.mix(own + (self.x - self.lo).astype(np.uint64))


def _binaries(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    whole = data.tobytes()
    return pa.array([whole[s:e] for s, e in zip(starts.tolist(), ends.tolist(), strict=True)], pa.binary())


def _sort_contexts(length: int, gram: int):
    """Windows found twice, as first and last window of each stretch, of the contexts of whole groups."""
    window = length - gram + 1

    def solve(rows: list[tuple[int, int, bytes, bytes]]) -> Iterator[tuple[int, int, int, int]]:
        symbols: list[int] = []
        begin, count, groups = [], [], {}
        for h, _, left, right in rows:
            begin.append(len(symbols))
            symbols += [b + 1 for b in left]
            symbols.append(257 + groups.setdefault(h, len(groups)))
            symbols += [b + 1 for b in right]
            count.append(len(left) + 1 + len(right) - window + 1)
            symbols.append(0)
        order = np.array(suffix_order(symbols))
        s = np.array(symbols + [0] * window, np.int32)
        valid = np.zeros(len(symbols), bool)
        for b, c in zip(begin, count, strict=True):
            valid[b : b + c] = True
        order = order[valid[order]]
        twice = np.zeros(len(symbols), bool)
        views = np.lib.stride_tricks.sliding_window_view(s, window)
        for k in range(0, len(order) - 1, 20_000):
            a, b = order[k : k + 20_000], order[k + 1 : k + 20_001]
            a = a[: len(b)]
            same = (views[a] == views[b]).all(axis=1)
            twice[a[same]] = True
            twice[b[same]] = True
        for (h, c, _, _), b, n in zip(rows, begin, count, strict=True):
            for first, last in stretches(twice[b : b + n]):
                yield h, c, first, last

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, bytes, bytes]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            found = list(solve(held))
            h, c, first, last = zip(*found, strict=True) if found else ((), (), (), ())
            return pa.RecordBatch.from_arrays(
                [pa.array(h, pa.int64()), pa.array(c, pa.int64()), pa.array(first, pa.int32()), pa.array(last, pa.int32())], ["h", "c", "first", "last"]
            )

        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in ("h", "c", "left", "right")), strict=True):
                if size >= SORT_SYMBOLS and held[-1][0] != row[0]:
                    yield flush()
                    held, size = [], 0
                held.append(row)
                size += len(row[2]) + len(row[3]) + 2
        if held:
            yield flush()

    return run


def stretches(marks: np.ndarray) -> list[tuple[int, int]]:
    """First and last place of each stretch of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], marks, [False]]).astype(np.int8)))
    return list(zip(edges[::2].tolist(), (edges[1::2] - 1).tolist(), strict=True))


def _window_keys(length: int, gram: int):
    """A row for each window of each context: its hash, and which it is."""
    rest = length - gram

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for h, c, left, right in zip(*(batch.column(k).to_pylist() for k in ("h", "c", "left", "right")), strict=True):
                n = len(left) + len(right) - rest + 1
                keys = [hashlib.md5(b"%d:" % (len(left) - k) + left[k:] + right[: rest - len(left) + k]).digest() for k in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([h] * n, pa.int64()), pa.array([c] * n, pa.int64()), pa.array(range(n), pa.int32()), pa.array(keys, pa.binary())], ["h", "c", "first", "key"]
                )

    return run


def repeated_runs(docs: DataFrame, length: int, gram: int, group_limit: int) -> DataFrame:
    """doc_id, text_hash, and the first and last start (bytes) of stretches of repeated windows."""
    rows = docs.select(F.col("doc_id").cast("bigint"), F.xxhash64("text").alias("text_hash"), "text")

    def grams(batch: pa.RecordBatch) -> pa.RecordBatch:
        h, n = np.unique(_Runs(batch, length, gram).h, return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], ["h", "n"])

    twice = map_text(rows.select("text"), grams, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n"))
    twice = save(twice.where("n > 1").select("h"), "grams")
    sc = docs.sparkSession.sparkContext
    wanted = sc.broadcast(_bit_filter(twice))

    def runs(batch: pa.RecordBatch) -> pa.RecordBatch:
        r = _Runs(batch, length, gram, wanted.value)
        row = pa.array(r.owner)
        start = r.lo - r.offsets[r.owner]
        columns = [pa.array(r.h.view(np.int64)), pa.array(r.context_hash(length).view(np.int64)), batch.column("doc_id").take(row), batch.column("text_hash").take(row)]
        columns += [pa.array(start.astype(np.int32)), pa.array((r.hi - r.lo).astype(np.int32))]
        return pa.RecordBatch.from_arrays(columns, ["h", "c", "doc_id", "text_hash", "start", "more"])

    found = map_text(rows, runs, "h bigint, c bigint, doc_id bigint, text_hash bigint, start int, more int")
    found = save(found, "runs")
    contexts = save(found.groupBy("h", "c").agg(F.count("*").alias("n")), "contexts")
    groups = contexts.groupBy("h").agg(F.count("*").alias("contexts")).where("contexts > 1")
    groups = save(groups, "groups")
    mixed = sc.broadcast(_bit_filter(groups))

    def bytes_of(batch: pa.RecordBatch) -> pa.RecordBatch:
        r = _Runs(batch, length, gram, mixed.value)
        c = r.context_hash(length)
        _, one = np.unique(np.stack([r.h, c], 1), axis=0, return_index=True)
        columns = [pa.array(r.h[one].view(np.int64)), pa.array(c[one].view(np.int64))]
        columns += [_binaries(r.data, r.lo[one], r.x[one]), _binaries(r.data, r.x[one] + gram, r.hi[one] + length)]
        return pa.RecordBatch.from_arrays(columns, ["h", "c", "left", "right"])

    texts = map_text(rows.select("text"), bytes_of, "h bigint, c bigint, left binary, right binary")
    texts = texts.groupBy("h", "c").agg(F.first("left").alias("left"), F.first("right").alias("right"))
    texts = save(texts.join(groups, "h"), "context-bytes")
    small = texts.where(F.col("contexts") <= group_limit).select("h", "c", "left", "right")
    n_tasks = max(1, -(-texts.count() // TASK_CONTEXTS))  # sorting takes long for its bytes
    sorted_ = small.repartition(n_tasks, "h").sortWithinPartitions("h", "c").mapInArrow(_sort_contexts(length, gram), "h bigint, c bigint, first int, last int")
    keys = texts.where(F.col("contexts") > group_limit).select("h", "c", "left", "right")
    keys = save(keys.mapInArrow(_window_keys(length, gram), "h bigint, c bigint, first int, key binary"), "window-keys")
    again = keys.groupBy("h", "key").agg(F.count("*").alias("n")).where("n > 1").select("h", "key")
    counted = keys.join(again, ["h", "key"], "left_semi").select("h", "c", "first", F.col("first").alias("last"))
    parts = sorted_.union(counted).groupBy("h", "c").agg(F.collect_list(F.struct("first", "last")).alias("parts"))
    whole = contexts.where("n > 1").select("h", "c", F.lit(True).alias("whole"))
    marks = whole.join(parts, ["h", "c"], "full")
    span = F.when(F.col("whole"), F.array(F.struct(F.lit(0).alias("first"), F.col("more").alias("last")))).otherwise(F.col("parts"))
    return (
        found.join(marks, ["h", "c"])
        .select("doc_id", "text_hash", "start", F.explode(span).alias("p"))
        .select("doc_id", "text_hash", (F.col("start") + F.col("p.first")).alias("first"), (F.col("start") + F.col("p.last")).alias("last"))
    )


def dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the kept bytes of each row."""
    spans = repeated_runs(docs, length, gram, group_limit)
    spans = spans.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("first", "last")).alias("spans"))
    spans = spans.select(F.col("doc_id").alias("cut_id"), F.col("text_hash").alias("cut_hash"), "spans")
    rows = docs.select(F.col("doc_id").cast("bigint"), F.xxhash64("text").alias("text_hash"), "text")
    same = F.col("doc_id").eqNullSafe(F.col("cut_id")) & F.col("text_hash").eqNullSafe(F.col("cut_hash"))
    rows = rows.join(spans, same, "left").select("doc_id", "text", F.col("spans.first").alias("first"), F.col("spans.last").alias("last"))
    rows = rows.withColumns({c: F.coalesce(c, F.array().cast("array<int>")) for c in ("first", "last")})

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = text_bytes(batch.column("text"))
        edge = np.zeros(len(data) + 1, np.int64)
        lists = batch.column("first")
        row = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
        np.add.at(edge, offsets[row] + lists.flatten().to_numpy(zero_copy_only=False), 1)
        np.add.at(edge, offsets[row] + batch.column("last").flatten().to_numpy(zero_copy_only=False) + length, -1)
        gone = np.cumsum(edge[:-1]) > 0
        heads = gone.copy()
        heads[1:] &= ~gone[:-1]
        heads[offsets[:-1][offsets[:-1] < len(data)]] |= gone[offsets[:-1][offsets[:-1] < len(data)]]
        sums = lambda v: np.diff(np.concatenate([[0], np.cumsum(v)])[offsets])
        ends = np.concatenate([[0], np.cumsum(~gone)])[offsets]
        left = data[~gone].tobytes()
        kept = [left[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
        columns = [batch.column("doc_id"), pa.array(np.diff(offsets)), pa.array(sums(gone)), pa.array(sums(heads))]
        columns += [pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()), pa.array(kept, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"
    return map_text(rows, work, schema)
