"""The registered queries of this package, each over its whole table, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.llm import (
    bloom_rank,
    crf_language,
    decontaminate,
    heap_bpe,
    lattice_lm,
    license_scan,
    pfair_mix,
    quality_mcd,
    sentence_dedup,
    simhash_trie,
    suffix_groups,
    topk_tiles,
    turn_repair,
)
from cardwatch.llm.common import read_table


def op1_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return sentence_dedup.dedup(docs)


def op2_quality_mcd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_mcd.verdicts(read_table(spark, sf_dir, "documents"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op4_simhash_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_trie.groups(read_table(spark, sf_dir, "documents"))


def op5_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_lm.score(read_table(spark, sf_dir, "documents"))


def op6_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pfair_mix.mix(read_table(spark, sf_dir, "documents"), ["doc_id", "source"])


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(read_table(spark, sf_dir, "documents"))


def op8_suffix_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_groups.dedup(read_table(spark, sf_dir, "documents"))
    # a cut inside a character leaves bytes that are no text, which the digest counts as they are
    return found.withColumn("text", F.make_valid_utf8(F.col("kept").cast("string"))).drop("kept")


def op9_heap_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return heap_bpe.token_counts(read_table(spark, sf_dir, "documents"))


def op10_crf_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    field = crf_language.train(docs.where(~crf_language.held_out()))
    rows = docs.select("doc_id", "text", crf_language.held_out().alias("held_out"))
    return crf_language.label(rows, field, ["doc_id", "held_out"])


def op11_suffix_dawg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.repair(read_table(spark, sf_dir, "conversations"))


def op12_tiled_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_tiles.search(read_table(spark, sf_dir, "embeddings"))


def op13_bloom_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bloom_rank.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {k: v for k, v in globals().items() if k.startswith("op") and k[2].isdigit()}
    return dict(sorted(found.items(), key=lambda x: int(x[0][2:].split("_")[0])))


#: The mixture of pfair_mix with its default weights. The first recursive step takes the slots of a period in turn.
PFAIR_SQL = f"""
WITH RECURSIVE d AS (
    SELECT doc_id, source, coalesce('=' || source, '') AS mix_source, coalesce(length(text), 0)::BIGINT AS chars,
           md5(coalesce(doc_id::VARCHAR, '')) || '-' || md5(coalesce(text, '')) AS order_key
    FROM documents),
sized AS (SELECT mix_source, sum(chars) AS chars FROM d GROUP BY mix_source),
weights AS (
    SELECT mix_source, row_number() OVER (ORDER BY mix_source) AS i,
           greatest(1, floor({pfair_mix.SLOTS} * sqrt(CASE WHEN (SELECT sum(chars) FROM sized) > 0
               THEN chars::DOUBLE / (SELECT sum(chars) FROM sized)::DOUBLE ELSE 0 END)))::BIGINT AS n
    FROM sized),
total AS (SELECT sum(n)::BIGINT AS period, list(n ORDER BY i) AS w FROM weights),
picks AS (
    SELECT -1::BIGINT AS slot, NULL::BIGINT AS i, NULL::BIGINT AS k, list_transform(w, lambda x: 0::BIGINT) AS done FROM total
    UNION ALL
    SELECT slot + 1, p.i, p.k, list_transform(done, lambda x, j: CASE WHEN j = p.i THEN x + 1 ELSE x END)
    FROM (
        SELECT slot, done, list_min(list_transform(
            list_filter(list_transform(w, lambda x, j: {{'n': x, 'i': j::BIGINT, 'k': done[j]}}),
                        lambda x: x.k < x.n AND (x.k * period) // x.n <= slot + 1),
            lambda x: {{'deadline': ((x.k + 1) * period + x.n - 1) // x.n, 'i': x.i, 'k': x.k}})) AS p
        FROM picks, total WHERE slot + 1 < period)),
placed AS (
    SELECT *, (sum(chars) OVER (PARTITION BY mix_source ORDER BY order_key, doc_id ROWS UNBOUNDED PRECEDING) - chars)::BIGINT AS pos
    FROM d)
SELECT doc_id, source, chars, pos // {pfair_mix.BLOCK_CHARS} AS block,
       ((pos // {pfair_mix.BLOCK_CHARS}) // n) * period + slot AS slot, pos % {pfair_mix.BLOCK_CHARS} AS block_offset, order_key
FROM placed JOIN weights USING (mix_source), total
JOIN picks ON picks.i = weights.i AND picks.k = (pos // {pfair_mix.BLOCK_CHARS}) % n
"""


#: The inner products of all queries with all rows, in doubles, where their integers are exact.
TOPK_SQL = f"""
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor({topk_tiles.SCALE} * x::DOUBLE)) AS x
    FROM embeddings
    WHERE embedding IS NOT NULL AND coalesce(list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))), TRUE)),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.x, c.x)::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id % {topk_tiles.QUERY_EVERY} = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
WHERE rank <= {topk_tiles.K}
"""

#: The scores of all documents that have a term of an item.
RANK_SQL = f"""
WITH words AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
    FROM documents),
sizes AS (SELECT doc_id, count(*)::BIGINT AS n FROM words GROUP BY doc_id),
total AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM sizes),
tf AS (SELECT doc_id, term, count(*)::BIGINT AS tf FROM words GROUP BY doc_id, term),
item_terms AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
    FROM benchmark),
weights AS (
    SELECT term, floor(1000 * ln((2.0::DOUBLE * docs + 2) / (2.0::DOUBLE * count(*) + 1)))::BIGINT AS w
    FROM tf, total GROUP BY term, docs),
scored AS (
    SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // terms))))::BIGINT AS score
    FROM item_terms JOIN weights USING (term) JOIN tf USING (term) JOIN sizes USING (doc_id), total
    GROUP BY item_id, doc_id)
SELECT item_id, rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM scored WHERE score > 0)
WHERE rank <= {bloom_rank.K}
"""


def oracle_sql() -> dict[str, str]:
    return {"op6_pfair_mix": PFAIR_SQL, "op12_tiled_topk": TOPK_SQL, "op13_bloom_rank": RANK_SQL}
