"""Ranked lexical search over bit-sliced Bloom signatures.

Each document has a Bloom filter of its terms, with a key for each of a few levels of occurrences (1, 2, 3, 5, 9, ...)
that a term reaches. Documents of similar size make a block, which is stored by bit: for each bit of the filters
a bitmap over its documents. The bitmaps of a term's bits, taken together by AND, mark all documents that have the
term (and few others), so the slices of a level, summed with the weights of an item's terms and scaled by what the
level adds at most to a document of that length, bound the document's score from above.

An item's documents of greatest bounds are scored exactly from their texts. The k-th of these scores is a threshold:
a document whose bound is below it, or equal to it with a greater id, is provably not among the k best. All others
are scored exactly too, and the best are taken. Bounds decide only what is left out, so the result is exact.

Blocks of items and blocks of documents meet on a grid, as a stated query set against all rows: item blocks travel
to all columns, signatures to one row as a rule. A cell gets the blocks of both sides once, not a copy of the
signatures for each block of items, and gives the best of each item over all its blocks. Weights come from counts
over all documents; a bit filter of fixed size over the items' terms keeps other terms out of that count's shuffle.
Texts are read once for the signatures and once for each round of exact scores, where they are joined with the
wanted pairs only.
Terms are counted by a 64-bit hash; exact scores compare the terms themselves.

Defined results: a null or empty text, or one without a term, has no score, and is not counted in N. An item without a
term, or whose terms no document has, gets no row. Rows of `documents` with equal id and text are documents of
their own, ranked one after the other; a null id comes last among equal scores. Items with equal id and text
are one item; a null item id stays null. Empty tables give an empty one. Other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardwatch.llm import textnum
from cardwatch.llm.common import map_text, row_key, save, slices, text_bytes
from cardwatch.llm.topk_tiles import grid
from cardwatch.session import with_package

K = 50
#: Documents scored for the threshold, as a multiple of k: some have their bounds from terms that they haven't.
SEEDS = 2
ITEM_BLOCK = 64
#: A level's key is set for terms of at least so many occurrences.
LEVELS = (1, 2, 3, 5, 9, 17, 33)
#: Hashes of a key. One term too many lifts a bound over most thresholds, so the first level has more of them; a higher
#: level is asked only where the one below is set.
HASHES = (10, 4, 4, 4, 4, 4, 4)
#: Bits of a filter for each bit set: a term that a document hasn't passes about once in 50,000 times.
SPARSE = 2.4
#: Cells (bits times documents) of a block, and keys that a task holds back, at most about.
BLOCK_CELLS, HELD_KEYS = 1 << 24, 1 << 22
#: Bytes of text whose terms a task hashes at once: the hashes take some fifty times as much.
TERM_BYTES = 1 << 18
#: Documents of a block at most: a task holds their marks for each term of an item block, and short texts have few bits.
BLOCK_DOCS = 4096
#: Bytes of signatures in one column of the grid, about: a task holds a cell of it, and Spark may deal it a few.
COLUMN_BYTES = 1 << 23
#: The stored signatures are read by groups of rows, each into memory as a whole. Blocks are large, so each row is weighed.
ROW_GROUPS = {"parquet.block.size": 1 << 22, "parquet.page.size.row.check.min": 1, "parquet.page.size.row.check.max": 1}
TERM_FILTER_BITS = 22
_LAST_ID = np.iinfo(np.int64).max
_BREAKS = np.ones(256, bool)
_BREAKS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
_TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_INDEX = "h bigint, df bigint, block bigint, n_docs int, n_terms bigint, bits int, ids binary, hashes binary, lengths binary, most binary, slices binary"


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a text in order, only A-Z in lower case."""
    return [t.lower() for t in _TERM.findall(text)]


def _term_runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, hash and occurrences of each distinct term of each text."""
    low = textnum.lower_ascii(data)
    starts, ends, owner = textnum.words(low, offsets, _BREAKS)
    h = textnum.RangeHash(low)(starts, ends)
    order = np.lexsort((h, owner))
    owner, h = owner[order], h[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = (owner[1:] != owner[:-1]) | (h[1:] != h[:-1])
    at = np.flatnonzero(fresh)
    return owner[at], h[at], np.diff(np.append(at, len(h)))


def _level_keys(h: np.ndarray, level: int) -> np.ndarray:
    return textnum.mix(h + np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1)))


def _positions(keys: np.ndarray, hashes: int, bits: int) -> np.ndarray:
    """The bits of each key: (keys, hashes)."""
    low, high = keys & np.uint64(0xFFFFFFFF), (keys >> np.uint64(32)) | np.uint64(1)
    return ((low[:, None] + high[:, None] * np.arange(hashes, dtype=np.uint64)) % np.uint64(bits)).astype(np.int64)


class _Builder:
    """Collects the documents of a task by size, and makes blocks of them."""

    def __init__(self, first: int):
        self.sizes: dict[int, list[tuple]] = {}
        self.keys: Counter[int] = Counter()
        self.block = first

    def add(self, doc: tuple, keys: list[np.ndarray]) -> Iterator[list]:
        n_set = sum(len(own) * hashes for own, hashes in zip(keys, HASHES, strict=True))
        size = int(4 * np.log2(n_set))
        self.sizes.setdefault(size, []).append((*doc, int(n_set * SPARSE), keys))
        self.keys[size] += sum(map(len, keys))
        if len(self.sizes[size]) >= BLOCK_DOCS or len(self.sizes[size]) * n_set * SPARSE >= BLOCK_CELLS:
            yield self.flush(size)
        elif self.keys.total() > HELD_KEYS:
            yield self.flush(self.keys.most_common(1)[0][0])

    def flush(self, size: int) -> list:
        ids, hashes, lengths, most, wanted, keys = zip(*self.sizes.pop(size), strict=True)
        self.keys.pop(size)
        self.block += 1
        bits = max(wanted)
        cells = np.zeros((bits, len(ids)), bool)
        for d, own in enumerate(keys):
            for level, n_hashes in zip(own, HASHES, strict=True):
                cells[_positions(level, n_hashes, bits), d] = True
        packed = [np.array(v, np.int64).tobytes() for v in (ids, hashes, lengths, most)]
        return [None, None, self.block, len(ids), sum(lengths), bits, *packed, np.packbits(cells, axis=1).tobytes()]

    def rest(self) -> Iterator[list]:
        for size in list(self.sizes):
            yield self.flush(size)


def _index_batch(rows: list[list]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), *[pa.binary()] * 5]
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], [f.split()[0] for f in _INDEX.split(", ")])


def index(docs: DataFrame, wanted: np.ndarray) -> DataFrame:
    """Blocks of signatures, and the counts of documents of the terms that pass the filter, stored as one table."""
    sent = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        build = _Builder(TaskContext.get().partitionId() << 40)
        mask = np.uint64((1 << TERM_FILTER_BITS) - 1)
        for batch in batches:
            wanted_terms = []
            for piece in slices(batch, most=TERM_BYTES):
                owner, h, tf = _term_runs(*text_bytes(piece.column("text")))
                slot = (h & mask).astype(np.int64)
                wanted_terms.append(h[(sent.value[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1])
                ids = piece.column("doc_id").fill_null(_LAST_ID).to_numpy().tolist()
                hashes = piece.column("h").to_numpy().tolist()
                upto = np.searchsorted(owner, np.arange(piece.num_rows + 1))
                for d in range(piece.num_rows):
                    a, b = upto[d], upto[d + 1]
                    if a == b:
                        continue
                    own, times = h[a:b], tf[a:b]
                    keys = [_level_keys(own[times >= least], level) for level, least in enumerate(LEVELS)]
                    for row in build.add((ids[d], hashes[d], int(times.sum()), int(times.max())), keys):
                        yield _index_batch([row])
            terms, df = np.unique(np.concatenate(wanted_terms), return_counts=True) if wanted_terms else ((), ())
            if len(terms):
                rest = pa.nulls(len(terms))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(terms.view(np.int64)), pa.array(df), *[rest.cast(k) for k in (pa.int64(), pa.int32(), pa.int64(), pa.int32())], *[rest.cast(pa.binary())] * 5],
                    [f.split()[0] for f in _INDEX.split(", ")],
                )
        for row in build.rest():
            yield _index_batch([row])

    with_package(docs.sparkSession)
    return save(docs.select("doc_id", "h", "text").mapInArrow(run, _INDEX), "signatures", **ROW_GROUPS)


def gain(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a weight counts for, with `tf` occurrences in a document of relative length `m`."""
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


def relative_length(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    return 100 - 50 + (50 * n * n_docs) // n_terms


def bounds(block: dict, terms: np.ndarray, n_docs: int, n_terms: int):
    """For a block of documents: how often each level's slice of each term is set, and what the level adds at most.

    Gives (places of terms, slices as 0 or 1 by term and document, gain by document) for each level.
    """
    width = (block["n_docs"] + 7) // 8
    sliced = np.frombuffer(block["slices"], np.uint8).reshape(block["bits"], width)
    most = np.frombuffer(block["most"], np.int64)
    m = relative_length(np.frombuffer(block["lengths"], np.int64), n_docs, n_terms)
    at = np.arange(len(terms))
    before, reached, out = None, np.zeros(block["n_docs"], np.int64), []
    for level, top in enumerate([*(least - 1 for least in LEVELS[1:]), None]):
        marks = np.bitwise_and.reduce(sliced[_positions(_level_keys(terms[at], level), HASHES[level], block["bits"])], axis=1)
        if before is not None:
            marks &= before  # a term with so many occurrences has fewer as well
        some = marks.any(axis=1)
        at, before = at[some], marks[some]
        if not len(at):
            break
        here = gain(most if top is None else np.minimum(top, most), m)
        out.append((at, np.unpackbits(before, axis=1, count=block["n_docs"]), here - reached))
        reached = here
    return out


def upper_bounds(block: dict, items: dict, n_docs: int, n_terms: int) -> Iterator[tuple[int, np.ndarray]]:
    """Number of each item of an item block, and the bounds of all documents of a block of documents."""
    terms, places = np.unique(np.frombuffer(items["terms"], np.uint64), return_inverse=True)
    weights = np.frombuffer(items["weights"], np.int64)
    ends = np.frombuffer(items["ends"], np.int64)
    levels = []
    for at, marks, adds in bounds(block, terms, n_docs, n_terms):
        row = np.full(len(terms), -1)
        row[at] = np.arange(len(at))
        # sums of weights are whole numbers, exact in either float
        levels.append((row, marks.astype(np.float32 if weights.sum() < 1 << 24 else np.float64), adds))
    begin = 0
    for i, end in enumerate(ends.tolist()):
        total = np.zeros(block["n_docs"], np.int64)
        for row, marks, adds in levels:
            own = row[places[begin:end]]
            hit = own >= 0
            if not hit.any():
                break
            total += adds * (weights[begin:end][hit].astype(marks.dtype) @ marks[own[hit]]).astype(np.int64)
        yield i, total
        begin = end


def _pack_items(table: pa.Table) -> pa.Table:
    rows = table.sort_by([("item", "ascending"), ("term_hash", "ascending")])
    item = rows.column("item").to_numpy()
    ends = np.append(np.flatnonzero(np.diff(item)) + 1, len(item))
    first = np.concatenate([[0], ends[:-1]])
    columns = {k: rows.column(k).to_numpy() for k in ("term_hash", "weight", "threshold", "tie")}
    values = [item[first], columns["threshold"][first], columns["tie"][first], ends, columns["term_hash"], columns["weight"]]
    names = ["items", "thresholds", "ties", "ends", "terms", "weights"]
    cells = [pa.array([np.ascontiguousarray(v.astype(np.int64)).tobytes()], pa.binary()) for v in values]
    return pa.table([pa.array([int(rows.column("item_block")[0].as_py())], pa.int32()), *cells], ["item_block", *names])


def _lines(table: pa.Table) -> Iterator[dict]:
    """The rows of a table, binary cells as buffers of the table itself."""
    for batch in table.to_batches():
        binary = [pa.types.is_binary(f.type) or pa.types.is_large_binary(f.type) for f in batch.schema]
        for i in range(batch.num_rows):
            yield {f.name: c[i].as_buffer() if b else c[i].as_py() for f, c, b in zip(batch.schema, batch.columns, binary, strict=True)}


def cell_pairs(items: pa.Table, blocks: pa.Table, k: int | None, n_docs: int, n_terms: int) -> pa.Table:
    """The wanted pairs of a cell: the k of greatest bound of each item, or with k None all that a threshold lets through."""
    asked = [(q, *(np.frombuffer(q[c], np.int64) for c in ("items", "thresholds", "ties"))) for q in _lines(items)]
    found: dict[tuple[int, int], tuple[np.ndarray, ...]] = {}
    for block in _lines(blocks):
        ids, hashes = np.frombuffer(block["ids"], np.int64), np.frombuffer(block["hashes"], np.int64)
        for n, (q, _, least, ties) in enumerate(asked):
            for i, total in upper_bounds(block, q, n_docs, n_terms):
                if k is None:
                    at = np.flatnonzero((total > least[i]) | ((total == least[i]) & (ids <= ties[i])))
                else:
                    at = np.flatnonzero(total > 0)
                if not len(at):
                    continue
                own = (ids[at], hashes[at], total[at])
                if (n, i) in found:
                    own = tuple(np.concatenate(x) for x in zip(found[n, i], own, strict=True))
                if k is not None and len(own[2]) > k:
                    most = np.argpartition(-own[2], k - 1)[:k]
                    own = tuple(x[most] for x in own)
                found[n, i] = own
    none = np.zeros(0, np.int64)
    item = np.concatenate([none, *(np.full(len(own[0]), asked[n][1][i]) for (n, i), own in found.items())])
    doc, h, bound = (np.concatenate([none, *x]) for x in (zip(*found.values(), strict=True) if found else ([], [], [])))
    return pa.table([pa.array(item), pa.array(doc, mask=doc == _LAST_ID), pa.array(h), pa.array(bound)], ["item", "doc_id", "h", "bound"])


def _wanted_pairs(cells: tuple[DataFrame, DataFrame], k: int | None, n_docs: int, n_terms: int) -> DataFrame:
    """item, doc_id, h and bound of the wanted pairs of all cells, each of which gets its blocks of both sides once."""

    def work(items: pa.Table, blocks: pa.Table) -> pa.Table:
        return cell_pairs(items, blocks, k, n_docs, n_terms)

    q, d = (side.groupBy("row", "part") for side in cells)
    return q.cogroup(d).applyInArrow(work, "item bigint, doc_id bigint, h bigint, bound bigint")


def _exact(pairs: DataFrame, docs: DataFrame, items: DataFrame, n_docs: int, n_terms: int) -> DataFrame:
    """item, doc_id, h and exact score of each row of `docs` named by the pairs (item, k, h)."""
    rows = pairs.join(items, "item").join(docs, ["k", "h"]).select("item", "doc_id", "h", "terms", "weights", "text")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores, before = [], None
        for terms, weights, text in zip(*(batch.column(c).to_pylist() for c in ("terms", "weights", "text")), strict=True):
            if text != before:  # the pairs of a document come together
                found, before = Counter(terms_of(text.encode())), text
                m = int(relative_length(found.total(), n_docs, n_terms))
            scores.append(sum(w * int(gain(found[t], m)) for t, w in ((t.encode(), w) for t, w in zip(terms, weights, strict=True)) if found[t]))
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("item", "doc_id", "h")), pa.array(scores, pa.int64())], ["item", "doc_id", "h", "score"])

    return map_text(rows, work, "item bigint, doc_id bigint, h bigint, score bigint")


def _item_terms(items: DataFrame) -> DataFrame:
    """item (a key), item_id, term and its hash, a row for each distinct term of each item."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [sorted(set(terms_of((t or "").encode()))) for t in batch.column("text").to_pylist()]
        flat = [t for own in found for t in own]
        data = np.frombuffer(b"".join(flat), np.uint8)
        ends = np.cumsum([len(t) for t in flat], dtype=np.int64) if flat else np.zeros(0, np.int64)
        h = textnum.RangeHash(data)(np.concatenate([[0], ends[:-1]]).astype(np.int64)[: len(flat)], ends)
        row = pa.array(np.repeat(np.arange(len(found)), [len(own) for own in found]))
        columns = [batch.column("item").take(row), batch.column("item_id").take(row), pa.array([t.decode() for t in flat], pa.string()), pa.array(h.view(np.int64))]
        return pa.RecordBatch.from_arrays(columns, ["item", "item_id", "term", "term_hash"])

    key = F.xxhash64(F.col("item_id").isNull(), F.col("item_id"), F.col("text"))
    rows = items.select(key.alias("item"), F.col("item_id").cast("bigint"), "text").dropDuplicates(["item"])
    return save(map_text(rows, work, "item bigint, item_id bigint, term string, term_hash bigint"), "item-terms")


def _term_filter(terms: DataFrame) -> np.ndarray:
    """Bits of the terms' hashes, as many as there are slots whatever the number of terms."""
    slot = F.col("term_hash").bitwiseAND(F.lit((1 << TERM_FILTER_BITS) - 1))
    parts = terms.select(slot.alias("slot")).groupBy(F.shiftright("slot", 15).alias("part")).agg(F.bitmap_construct_agg(F.col("slot").bitwiseAND(F.lit(0x7FFF))).alias("bits"))
    out = np.zeros((1 << (TERM_FILTER_BITS - 15), 1 << 12), np.uint8)
    for r in parts.toLocalIterator():
        out[r["part"]] = np.frombuffer(r["bits"], np.uint8)
    return out.reshape(-1)


def search(docs: DataFrame, items: DataFrame, k: int = K, item_block: int = ITEM_BLOCK) -> DataFrame:
    """item_id, rank, doc_id and score of the k documents of highest score above 0 of each item."""
    spark = docs.sparkSession
    key, h = row_key()
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), key.alias("k"), h.alias("h"), "text")
    terms = _item_terms(items)
    table = index(rows, _term_filter(terms))
    blocks = table.where("block IS NOT NULL")
    total = blocks.agg(F.sum("n_docs").alias("docs"), F.sum("n_terms").alias("terms"), F.count("*").alias("blocks"), F.sum(F.length("slices")).alias("bytes")).first()
    n_items = terms.select("item").distinct().count()
    if not total["docs"] or not n_items:
        return spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    counts = table.where("h IS NOT NULL").groupBy("h").agg(F.sum("df").alias("df"))
    weight = F.floor(1000 * F.log((2.0 * total["docs"] + 2) / (2.0 * F.col("df") + 1))).cast("bigint")
    weighted = save(terms.join(counts, terms["term_hash"] == counts["h"]).select("item", "item_id", "term", "term_hash", weight.alias("weight")).where("weight > 0"), "weights")
    by_item = save(weighted.groupBy("item", "item_id").agg(F.collect_list(F.struct("term", "weight")).alias("t")).select("item", "item_id", F.col("t.term").alias("terms"), F.col("t.weight").alias("weights")), "items")
    n_item_blocks = -(-n_items // item_block)
    n_rows, n_columns = grid(n_items, total["docs"], spark.sparkContext.defaultParallelism, n_item_blocks, total["blocks"])
    n_columns = max(n_columns, min(total["blocks"], -(-total["bytes"] // COLUMN_BYTES)))

    def cells(of: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
        numbered = weighted.withColumn("item_block", F.pmod("item", F.lit(n_item_blocks)).cast("int"))
        if of is None:
            numbered = numbered.withColumns({"threshold": F.lit(1).cast("bigint"), "tie": F.lit(_LAST_ID)})
        else:
            numbered = numbered.join(of, "item", "left").withColumns({"threshold": F.coalesce("threshold", F.lit(1)).cast("bigint"), "tie": F.coalesce("tie", F.lit(_LAST_ID))})
        schema = "item_block int, items binary, thresholds binary, ties binary, ends binary, terms binary, weights binary"
        packed = numbered.select("item_block", "item", "term_hash", "weight", "threshold", "tie").groupBy("item_block").applyInArrow(_pack_items, schema)
        q = packed.select("*", F.pmod("item_block", F.lit(n_rows)).alias("row"), F.explode(F.sequence(F.lit(0), F.lit(n_columns - 1))).alias("part"))
        d = blocks.select(
            F.explode(F.sequence(F.lit(0), F.lit(n_rows - 1))).alias("row"), F.pmod(F.xxhash64("block"), F.lit(n_columns)).cast("int").alias("part"), "n_docs", "bits", "ids", "hashes", "lengths", "most", "slices"
        )
        return tuple(side.repartition(n_rows * n_columns, "row", "part") for side in (q, d))

    def best(of: DataFrame, order: str, k: int = k) -> DataFrame:
        by = Window.partitionBy("item").orderBy(F.col(order).desc(), F.col("doc_id").asc_nulls_last(), "h")
        return of.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)

    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("k")
    seeds = save(best(_wanted_pairs(cells(), SEEDS * k, total["docs"], total["terms"]), "bound", SEEDS * k).select("item", name, "h").distinct(), "seeds")
    known = save(best(_exact(seeds, rows, by_item, total["docs"], total["terms"]).where("score > 0"), "score").drop("rank"), "seed-scores")
    last = best(known, "score").where(F.col("rank") == k).select("item", F.col("score").alias("threshold"), F.coalesce("doc_id", F.lit(_LAST_ID)).alias("tie"))
    others = _wanted_pairs(cells(save(last, "thresholds")), None, total["docs"], total["terms"]).select("item", name, "h").distinct()
    others = save(others.join(seeds, ["item", "k", "h"], "left_anti"), "others")
    found = known.union(_exact(others, rows, by_item, total["docs"], total["terms"]).where("score > 0"))
    return best(found, "score").join(by_item.select("item", "item_id"), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
