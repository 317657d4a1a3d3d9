"""SimHash near-duplicates by a self-join of binary tries.

A document's fingerprint has a bit for each bit of the 64-bit hashes of its word shingles: 1 if it is set
in over half of them. Fingerprints that differ in at most `radius` bits are linked, and linked
fingerprints make components.

The trie is cut into `radius + 1` rotations: with at most `radius` differing bits, one of so many blocks of
bits is equal, so each pair meets below one root of the trie whose first bits are that block. Roots are
dealt to tasks; in a task the sorted fingerprints are the trie (a node is a range with a common prefix),
and node pairs are taken down together, their differing bits counted on the common prefix and dropped
when they pass the budget. Node pairs whose leaves are all in one component already are dropped too, so a
group of near copies costs about its size and not its square, and a task returns at most one edge a
fingerprint. A root with more fingerprints than `root_limit` is opened into pairs of deeper nodes first.

Defined results: a null or empty text, or one without a word, has fingerprint zero and is linked like any
other. Fewer words than a shingle: the whole sequence is the shingle. Repeated rows get equal results; a
null id counts as no id when the smallest one is taken. An empty table gives an empty one. Columns beside
the id and the text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch.llm import textnum
from cardwatch.llm.common import components, map_text, row_key, save, text_bytes

SHINGLE = 3
RADIUS = 3
SEED = 42
#: Fingerprints below one root (or pair of nodes) that a task takes at once.
ROOT_LIMIT = 20_000
#: Node pairs that are taken down together.
FRONTIER = 1 << 16
_LANES = np.array([sum(((b >> k) & 1) << (8 * k) for k in range(8)) for b in range(256)], np.uint64)


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of every shingle of every text, and the number of shingles of each text."""
    low = textnum.lower_ascii(data)
    starts, ends, owner = textnum.words(low, offsets)
    n_words = np.bincount(owner, minlength=len(offsets) - 1)
    # words with one space after each
    lengths = ends - starts + 1
    at = np.concatenate([[0], np.cumsum(lengths)])
    flat = np.full(int(at[-1]), 32, np.uint8)
    keep = np.ones(len(flat), bool)
    keep[at[1:] - 1] = False
    inside = np.zeros(len(low) + 1, np.int8)
    inside[starts] += 1
    np.subtract.at(inside, ends, 1)
    flat[keep] = low[np.cumsum(inside[:-1], dtype=np.int8).astype(bool)]
    buffer = flat.tobytes()
    count = np.where(n_words == 0, 0, np.maximum(1, n_words - shingle + 1))
    first_word = np.cumsum(n_words) - n_words
    first = np.repeat(first_word, count) + (np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count))
    last = first + np.repeat(np.minimum(shingle, n_words), count) - 1
    digest = xxhash.xxh64_intdigest
    spans = zip(at[first].tolist(), (at[last + 1] - 1).tolist(), strict=True)
    return np.fromiter((digest(buffer[s:e], SEED) for s, e in spans), np.uint64, len(first)), count


def majority(hashes: np.ndarray, count: np.ndarray) -> np.ndarray:
    """A fingerprint for each run of `count` hashes: the bits that over half of them have."""
    out = np.zeros(len(count), np.uint64)
    full = np.flatnonzero(count)
    if not len(full):
        return out
    size = count[full]
    begin = np.cumsum(size) - size
    parts = -(-size // 255)  # the sums of 255 bits fit into a byte
    owner_begin = np.cumsum(parts) - parts
    cut = np.repeat(begin, parts) + 255 * (np.arange(parts.sum()) - np.repeat(owner_begin, parts))
    columns = hashes.view(np.uint8).reshape(-1, 8)
    for j in range(8):
        sums = np.add.reduceat(_LANES[columns[:, j]], cut).view(np.uint8).reshape(-1, 8)
        bits = 2 * np.add.reduceat(sums, owner_begin, axis=0, dtype=np.int64) > size[:, None]
        for k in range(8):
            out[full] |= bits[:, k].astype(np.uint64) << np.uint64(8 * j + k)
    return out


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, keep: list[str] | None = None) -> DataFrame:
    """Columns `keep` (doc_id by default) and the fingerprint fp of each row."""
    keep = keep or ["doc_id"]
    rows = docs.select(*keep, "text")
    schema = rows.select(*keep).schema.add("fp", "long")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        hashes, count = shingle_hashes(*text_bytes(batch.column("text")), shingle)
        columns = [*(batch.column(c) for c in keep), pa.array(majority(hashes, count).view(np.int64))]
        return pa.RecordBatch.from_arrays(columns, [*keep, "fp"])

    return map_text(rows, work, schema)


def _prefix_bits(lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Number of leading bits that all of x[lo:hi] share; x is sorted and distinct."""
    diff = x[lo] ^ x[hi - 1]
    out = np.full(len(diff), 64, np.int64)
    left = diff != 0
    d = diff[left]
    bits = np.zeros(len(d), np.int64)
    for s in (32, 16, 8, 4, 2, 1):
        big = d >= (np.uint64(1) << np.uint64(s))
        bits += np.where(big, s, 0)
        d = np.where(big, d >> np.uint64(s), d)
    out[left] = 63 - bits
    return out


def _halves(lo: np.ndarray, hi: np.ndarray, p: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Where the right child of each node begins."""
    shift = (63 - p).astype(np.uint64)
    return np.searchsorted(x, ((x[lo] >> shift) | np.uint64(1)) << shift)


class _Labels:
    """Components of the positions of a sorted array, and whether a range of it lies in one."""

    def __init__(self, n: int):
        self.of = np.arange(n)
        self._spread()

    def _spread(self) -> None:
        self.changes = np.concatenate([[0], np.cumsum(self.of[1:] != self.of[:-1])])

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        roots_a, roots_b = self.of[a], self.of[b]
        fresh = roots_a != roots_b
        if not fresh.any():
            return
        parent: dict[int, int] = {}

        def find(r: int) -> int:
            while parent.get(r, r) != r:
                r = parent[r]
            return r

        for u, v in set(zip(roots_a[fresh].tolist(), roots_b[fresh].tolist(), strict=True)):
            u, v = find(u), find(v)
            if u != v:
                parent[max(u, v)] = min(u, v)
        table = np.arange(len(self.of))
        for r in parent:
            table[r] = find(r)
        self.of = table[self.of]
        self._spread()

    def one(self, alo, ahi, blo, bhi) -> np.ndarray:
        c = self.changes
        return (c[ahi - 1] == c[alo]) & (c[bhi - 1] == c[blo]) & (self.of[alo] == self.of[blo])


def join_nodes(x: np.ndarray, pairs: list[np.ndarray], radius: int, labels: _Labels) -> None:
    """Take node pairs (alo, ahi, blo, bhi) of the trie x down and link the leaves within the radius."""
    stack = [pairs]
    while stack:
        alo, ahi, blo, bhi = stack.pop()
        if len(alo) > FRONTIER:
            stack += [[v[:FRONTIER] for v in (alo, ahi, blo, bhi)], [v[FRONTIER:] for v in (alo, ahi, blo, bhi)]][::-1]
            continue
        pa_, pb = _prefix_bits(alo, ahi, x), _prefix_bits(blo, bhi, x)
        common = np.minimum(pa_, pb)
        shift = np.minimum(64 - common, 63).astype(np.uint64)
        spent = np.bitwise_count(np.where(common == 0, np.uint64(0), (x[alo] ^ x[blo]) >> shift))
        live = (spent <= radius) & ~labels.one(alo, ahi, blo, bhi)
        leaf = live & (common == 64)
        if leaf.any():
            labels.link(alo[leaf], blo[leaf])
        live &= common < 64
        if not live.any():
            continue
        alo, ahi, blo, bhi, pa_, pb = (v[live] for v in (alo, ahi, blo, bhi, pa_, pb))
        left = pa_ <= pb  # open the node whose common prefix ends first
        olo, ohi = np.where(left, alo, blo), np.where(left, ahi, bhi)
        mid = _halves(olo, ohi, np.where(left, pa_, pb), x)
        klo, khi = np.where(left, blo, alo), np.where(left, bhi, ahi)
        stack.append(
            [np.concatenate(v) for v in ((olo, mid), (mid, ohi), (klo, klo), (khi, khi))]
        )


def self_join(x: np.ndarray, depth: int, radius: int) -> np.ndarray:
    """Components, as the position of the smallest member, of the sorted distinct fingerprints x, linking
    those within the radius that share their first `depth` bits."""
    labels = _Labels(len(x))
    if len(x) < 2:
        return labels.of
    # the branching nodes: of each, the range and the place of its right child
    split = _prefix_bits(np.arange(len(x) - 1), np.arange(2, len(x) + 1), x)
    for level in range(63, depth - 1, -1):
        mid = np.flatnonzero(split == level) + 1
        if not len(mid):
            continue
        shift = np.uint64(64 - level)
        low = (x[mid] >> shift) << shift if level else np.zeros(len(mid), np.uint64)
        high = low + ((np.uint64(1) << shift) - np.uint64(1)) if level else np.full(len(mid), ~np.uint64(0))
        lo, hi = np.searchsorted(x, low), np.searchsorted(x, high, "right")
        join_nodes(x, [lo, mid, mid, hi], radius, labels)
    return labels.of


def _rotate(fp, by: int):
    return fp if not by else F.shiftleft(fp, by).bitwiseOR(F.shiftrightunsigned(fp, 64 - by))


_SIGN = np.uint64(1 << 63)


def _values(column: pa.Array) -> np.ndarray:
    """Unsigned values of a column of signed ones that sort alike."""
    return np.ascontiguousarray(column.to_numpy(zero_copy_only=False)).astype(np.int64).view(np.uint64) ^ _SIGN


def _edge_batch(x: np.ndarray, to: np.ndarray, turn: int) -> pa.RecordBatch:
    """An edge from each fingerprint that was linked to its representative, rotated back."""
    moved = np.flatnonzero(to != np.arange(len(x)))
    v = np.stack([x[to[moved]], x[moved]])
    back = np.uint64(turn % 64)
    v = v if not back else (v >> back) | (v << (np.uint64(64) - back))
    v = np.ascontiguousarray(v).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(v[0]), pa.array(v[1])], ["a", "b"])


def _join_roots(bits: int, radius: int):
    """Edges below whole roots; rows come sorted by rotation and order key, roots are never cut by a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns: list[np.ndarray] = []
        keys: list[np.ndarray] = []

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            turn, x = np.concatenate(turns), np.concatenate(keys)
            stop = len(x)
            if not last:  # the last root may go on in the next batch
                root = x >> np.uint64(64 - bits)
                stop = int(np.flatnonzero((turn == turn[-1]) & (root == root[-1]))[0])
            turns[:], keys[:] = [turn[stop:]], [x[stop:]]
            for t in np.unique(turn[:stop]):
                own = x[:stop][turn[:stop] == t]
                yield _edge_batch(own, self_join(own, bits, radius), int(t))

        for batch in batches:
            if batch.num_rows:
                turns.append(batch.column("turn").to_numpy(zero_copy_only=False))
                keys.append(_values(batch.column("o")))
                if sum(map(len, keys)) >= 50_000:
                    yield from flush(False)
        if keys:
            yield from flush(True)

    return run


def _join_pair(radius: int):
    """Edges between two deeper nodes, or inside one, of one rotation."""

    def run(table: pa.Table) -> pa.Table:
        turn, depth, na, nb = (table.column(c)[0].as_py() for c in ("turn", "depth", "na", "nb"))
        x = np.sort(_values(table.column("o").combine_chunks()))
        if na == nb:
            to = self_join(x, depth, radius)
        else:
            labels = _Labels(len(x))
            mid = int(np.searchsorted(x >> np.uint64(64 - depth), x[0] >> np.uint64(64 - depth), "right"))
            lo, hi = np.array([0]), np.array([len(x)])
            join_nodes(x, [lo, np.array([mid]), np.array([mid]), hi], radius, labels)
            to = labels.of
        return pa.Table.from_batches([_edge_batch(x, to, turn)])

    return run


def links(fps: DataFrame, radius: int = RADIUS, root_limit: int = ROOT_LIMIT) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column fp) that give the same components as all pairs
    within the radius."""
    bits = 64 // (radius + 1)
    turns = [t * bits for t in range(radius + 1)]
    sign = F.lit(-(1 << 63)).cast("bigint")
    rotated = fps.select(
        F.explode(F.array(*[F.struct(F.lit(t).alias("turn"), _rotate(F.col("fp"), t).alias("x")) for t in turns]))
    ).select("col.turn", "col.x")
    rows = save(
        rotated.select("turn", F.shiftrightunsigned("x", 64 - bits).alias("root"), F.col("x").bitwiseXOR(sign).alias("o")),
        "turns",
    )
    hot = rows.groupBy("turn", "root").count().where(F.col("count") > root_limit).select("turn", "root")
    whole = (
        rows.join(hot, ["turn", "root"], "left_anti")
        .repartition("turn", "root")
        .sortWithinPartitions("turn", "o")
        .select("turn", "o")
        .mapInArrow(_join_roots(bits, radius), "a bigint, b bigint")
    )
    hot = save(hot, "hot-roots")
    if hot.isEmpty():
        return whole
    opened = save(rows.join(hot, ["turn", "root"], "left_semi").withColumn("x", F.col("o").bitwiseXOR(sign)), "hot-rows")
    front = hot.select("turn", F.col("root").alias("na"), F.col("root").alias("nb"))
    depth, out = bits, [whole]
    while depth < 64:
        depth = min(64, depth + 4)
        step = F.col("x") if depth == 64 else F.shiftrightunsigned("x", 64 - depth)
        nodes = opened.groupBy("turn", step.alias("node")).agg(F.count("*").alias("n"))
        nodes = nodes.withColumn("up", F.shiftrightunsigned("node", 4))
        a = nodes.select("turn", F.col("up").alias("na"), F.col("node").alias("ca"), F.col("n").alias("n_a"))
        b = nodes.select("turn", F.col("up").alias("nb"), F.col("node").alias("cb"), F.col("n").alias("n_b"))
        near = F.bit_count(F.col("ca").bitwiseXOR(F.col("cb"))) <= radius
        once = (F.col("na") != F.col("nb")) | (F.col("ca") <= F.col("cb"))
        pairs = front.join(a, ["turn", "na"]).join(b, ["turn", "nb"]).where(near & once)
        pairs = save(
            pairs.select(
                "turn",
                F.col("ca").alias("na"),
                F.col("cb").alias("nb"),
                (F.col("n_a") + F.when(F.col("ca") != F.col("cb"), F.col("n_b")).otherwise(0)).alias("n"),
            ),
            "node-pairs",
        )
        ready = pairs if depth == 64 else pairs.where(F.col("n") <= root_limit)
        ends = ready.select("turn", "na", "nb", F.explode(F.array_distinct(F.array("na", "nb"))).alias("node"))
        members = ends.join(opened.select("turn", step.alias("node"), "o"), ["turn", "node"])
        out.append(
            members.select("turn", F.lit(depth).alias("depth"), "na", "nb", "o")
            .groupBy("turn", "depth", "na", "nb")
            .applyInArrow(_join_pair(radius), "a bigint, b bigint")
        )
        front = pairs.where(F.col("n") > root_limit).select("turn", "na", "nb")
        if depth == 64 or front.isEmpty():
            break
    for more in out[1:]:
        out[0] = out[0].union(more)
    return out[0]


def _grouped(docs: DataFrame, shingle: int, radius: int, root_limit: int, keep: list[str]) -> DataFrame:
    """keep, fp, and of its component the smallest fingerprint root and the smallest doc_id of each row."""
    fps = save(fingerprints(docs, shingle, keep), "fingerprints")
    nodes = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(links(nodes.select("fp"), radius, root_limit))
    linked = roots.join(nodes.withColumnRenamed("fp", "node"), "node")
    least = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    moved = save(roots.join(least, "root").select(F.col("node").alias("fp"), "root", "component_id"), "moved")
    named = nodes.join(moved, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), F.coalesce("component_id", "least").alias("component_id")
    )
    return fps.join(named, "fp", "left")


def groups(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, root_limit: int = ROOT_LIMIT) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id (smallest doc_id reachable) of each row."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return _grouped(rows, shingle, radius, root_limit, ["doc_id"]).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def dedup(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, root_limit: int = ROOT_LIMIT) -> DataFrame:
    """One row of each component: that of the smallest doc_id, then of the smallest text hash; null ids last."""
    key, h = row_key()
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", key.alias("k"), h.alias("h"))
    grouped = _grouped(rows, shingle, radius, root_limit, ["doc_id", "k", "h"])
    first = grouped.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "h", "k")).alias("first"))
    stay = first.select(F.col("first.k").alias("stay_k"), F.col("first.h").alias("stay_h"))
    named = docs.withColumns({"stay_k": key, "stay_h": h})
    return named.join(stay, ["stay_k", "stay_h"], "left_semi").dropDuplicates(["stay_k", "stay_h"]).select(*docs.columns)
