"""Near copies: documents whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

Pairs to look at come from buckets of two kinds: components of SimHash tries over the same shingles
(`simhash_trie`), and bands of minimum hashes, which also bring pairs together whose fingerprints differ in more
bits than a trie can search. With 26 bands of 6 a pair of similarity 0.8 shares no band once in about 2,700
times, and one of 0.85 once in 400,000. Every pair is verified by the exact similarity of the two sets before
it is linked, and linked documents make components.

Documents of equal words are one node. The nodes of a bucket are first compared with its smallest and its
greatest one, which puts most of a group of near copies into one component. What is left are the buckets with nodes
of several components. Two sets of similarity 0.8 share one of their rarest fifth of shingles, and enough
shingles from there on; so the nodes of these buckets are joined on those shingles, those outside a shingle's
largest component with all others, and only pairs that can still reach the similarity are compared. So all pairs
that share a bucket are decided, and a large group of near copies costs about its size.

Defined results: a null or empty text, or one without a word, has no shingle; such documents are one group.
Fewer words than a shingle: the whole sequence is the shingle. Rows with equal id and text are one document;
null ids come last. An empty table gives an empty one. Columns beside the id and the text are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardwatch.llm import simhash_trie, textnum
from cardwatch.llm.common import components, map_text, row_key, save, slices, text_bytes

SHINGLE = 5
#: The least similarity, as a fraction.
LEAST = (4, 5)
BANDS, ROWS = 26, 6
_KEYS = textnum.mix(np.arange(1, 2 * BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).reshape(2, -1)


def shingle_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of every shingle of every text, the number of shingles and the hash of all words of each text."""
    low = textnum.lower_ascii(data)
    starts, ends, owner = textnum.words(low, offsets)
    n_words = np.bincount(owner, minlength=len(offsets) - 1)
    word = textnum.mix(textnum.RangeHash(low)(starts, ends))
    count = np.where(n_words == 0, 0, np.maximum(1, n_words - SHINGLE + 1))
    first_word = np.cumsum(n_words) - n_words
    first = np.repeat(first_word, count) + (np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count))
    hashes = textnum.RangeHash(word)(first, first + np.repeat(np.minimum(SHINGLE, n_words), count))
    return hashes, count, textnum.RangeHash(word, 1)(first_word, first_word + n_words)


def bands(hashes: np.ndarray, count: np.ndarray) -> np.ndarray:
    """A hash of each band of minimum hashes of each text; zero for a text without a shingle."""
    out = np.zeros((len(count), BANDS), np.uint64)
    full = np.flatnonzero(count)
    if not len(full):
        return out
    begin = (np.cumsum(count) - count)[full]
    for band in range(BANDS):
        seen = np.full(len(full), band, np.uint64)
        for j in range(band * ROWS, (band + 1) * ROWS):
            seen = textnum.mix(seen + np.minimum.reduceat((hashes ^ _KEYS[0, j]) * (_KEYS[1, j] | np.uint64(1)), begin))
        out[full, band] = seen
    return out


def signatures(rows: DataFrame) -> DataFrame:
    """doc_id, k and h of each row, the node (hash of its words) and its bands."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        hashes, count, node = shingle_hashes(*text_bytes(batch.column("text")))
        flat = pa.array(bands(hashes, count).reshape(-1).view(np.int64))
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(count) + 1, dtype=np.int32) * BANDS), flat)
        columns = [*(batch.column(c) for c in ("doc_id", "k", "h")), pa.array(node.view(np.int64)), lists]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "k", "h", "node", "bands"])

    return map_text(rows.select("doc_id", "k", "h", "text"), work, "doc_id bigint, k string, h bigint, node bigint, bands array<bigint>")


def _distinct(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct shingles of each text as (text number, hash), and how many each text has."""
    hashes, count, _ = shingle_hashes(*text_bytes(column))
    owner = np.repeat(np.arange(len(count)), count)
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    fresh = np.ones(len(owner), bool)
    fresh[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
    owner, hashes = owner[fresh], hashes[fresh]
    return owner, hashes, np.bincount(owner, minlength=len(count))


def similar(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Whether the texts of each pair have the least similarity."""
    owner_a, hash_a, n_a = _distinct(a)
    owner_b, hash_b, n_b = _distinct(b)
    owner, hashes = np.concatenate([owner_a, owner_b]), np.concatenate([hash_a, hash_b])
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    both = owner[1:][(owner[1:] == owner[:-1]) & (hashes[1:] == hashes[:-1])]
    common = np.bincount(both, minlength=len(a))
    return common * LEAST[1] >= LEAST[0] * (n_a + n_b - common)


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose texts are similar."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    rows = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        ok = [similar(p.column("text_a"), p.column("text_b")) for p in slices(batch, "text_b")]
        return batch.select(["a", "b"]).filter(pa.array(np.concatenate(ok)))

    return map_text(rows, work, "a bigint, b bigint", "text_a")


def _named(members: DataFrame, roots: DataFrame) -> DataFrame:
    return members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def roots(docs: DataFrame, sig: DataFrame, radius: int, root_limit: int) -> DataFrame:
    """node and root of all nodes that are linked. `docs` has doc_id, text, k and h, `sig` their signatures."""
    fps = save(simhash_trie.fingerprints(docs, SHINGLE, ["k", "h"]).join(sig.select("k", "h", "node"), ["k", "h"]).select("fp", "node").distinct(), "fingerprints")
    tries = components(simhash_trie.links(fps.select("fp").distinct(), radius, root_limit)).withColumnRenamed("node", "fp")
    near = fps.join(tries, "fp", "left").select(F.xxhash64(F.lit("trie"), F.coalesce("root", "fp")).alias("bucket"), "node")
    buckets = save(sig.select(F.explode("bands").alias("bucket"), "node").union(near).distinct(), "buckets")
    ends = buckets.groupBy("bucket").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi")
    members = save(buckets.join(ends, "bucket"), "members")
    first = sig.join(members.select("node").distinct(), "node", "left_semi").groupBy("node").agg(F.min(F.struct("h", "k")).alias("r"))
    wanted = docs.join(first.select("node", "r.h", "r.k"), ["k", "h"])
    texts = save(wanted.groupBy("node").agg(F.min(F.coalesce("text", F.lit(""))).alias("text")), "texts")
    pairs = members.select(F.col("lo").alias("a"), F.col("node").alias("b")).union(members.select(F.col("node").alias("a"), F.col("hi").alias("b")))
    pairs = save(pairs.where("a < b").distinct(), "pairs")
    links = save(verified(pairs, texts), "links")
    named = _named(members.select("bucket", "node"), components(links))
    split = named.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("bucket")
    open_ = save(named.join(split, "bucket", "left_semi").select("node", "root").distinct(), "open-nodes")
    more = save(rare_pairs(open_, texts).join(pairs, ["a", "b"], "left_anti"), "pairs")
    return components(links.union(verified(more, texts)))


def shingle_rows(texts: DataFrame) -> DataFrame:
    """node, root, n (how many distinct shingles) and h of each distinct shingle."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        owner, hashes, count = _distinct(batch.column("text"))
        row = pa.array(owner)
        columns = [batch.column("node").take(row), batch.column("root").take(row), pa.array(count[owner].astype(np.int32)), pa.array(hashes.view(np.int64))]
        return pa.RecordBatch.from_arrays(columns, ["node", "root", "n", "h"])

    return map_text(texts.select("node", "root", "text"), work, "node bigint, root bigint, n int, h bigint")


def rare_pairs(nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (a, b) of different roots among `nodes` that can have the least similarity, by their rarest shingles."""
    least, of = LEAST
    rows = save(shingle_rows(nodes.join(texts, "node")), "open-shingles")
    often = rows.groupBy("h").agg(F.count("*").alias("times")).where("times > 1")
    # shingles of one node alone come before all others, so they only move the places of the rest
    by = Window.partitionBy("node")
    place = F.col("n") - F.count("*").over(by) + F.row_number().over(by.orderBy("times", "h")) - 1
    rare = rows.join(often, "h").withColumn("place", place).where(F.col("place") <= F.col("n") - F.ceil(F.lit(least) * F.col("n") / F.lit(of)))
    sizes = nodes.groupBy("root").agg(F.count("*").alias("size"))
    rare = save(rare.join(sizes, "root").select("h", "node", "n", "place", F.struct("size", "root").alias("part")), "rare-shingles")
    most = rare.groupBy("h").agg(F.max("part").alias("most"), F.min("part").alias("least")).where("least < most").select("h", "most")
    mixed = rare.join(most, "h")
    left = mixed.where("part < most").select("h", F.col("node").alias("x"), F.col("n").alias("n_x"), F.col("place").alias("place_x"), F.col("part").alias("part_x"))
    right = mixed.select("h", F.col("node").alias("y"), F.col("n").alias("n_y"), F.col("place").alias("place_y"), F.col("part").alias("part_y"))
    common = F.ceil(F.lit(least) * (F.col("n_x") + F.col("n_y")) / F.lit(least + of))
    can = (F.col("n_x") - F.col("place_x") >= common) & (F.col("n_y") - F.col("place_y") >= common)
    pairs = left.join(right, (left["h"] == right["h"]) & (F.col("part_x") < F.col("part_y")) & can)
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def dedup(docs: DataFrame, radius: int = simhash_trie.RADIUS, root_limit: int = simhash_trie.ROOT_LIMIT) -> DataFrame:
    """One row of each component: that of the smallest doc_id, then of the smallest text hash; null ids last."""
    key, h = row_key()
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", key.alias("k"), h.alias("h"))
    sig = save(signatures(rows), "signatures")
    grouped = _named(sig.select("doc_id", "k", "h", "node"), save(roots(rows, sig, radius, root_limit), "roots"))
    first = grouped.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "h", "k")).alias("first"))
    stay = first.select(F.col("first.k").alias("stay_k"), F.col("first.h").alias("stay_h"))
    named = docs.withColumns({"stay_k": key, "stay_h": h})
    return named.join(stay, ["stay_k", "stay_h"], "left_semi").dropDuplicates(["stay_k", "stay_h"]).select(*docs.columns)
