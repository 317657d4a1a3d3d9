"""The corpus pipeline: documents through five of the text operators, stage by stage.

Every stage takes all that the one before kept. Rejected documents, other members of a near-duplicate group and
contaminated documents go; repeated sentences are cut out of their texts, and a document of which nothing
is left goes too. The last stage puts the documents in the order of the mixture and adds their places in it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.llm import crf_language, decontaminate, near_copies, pfair_mix, sentence_dedup
from cardwatch.llm.common import read_table, save

#: A text of whose words no language has at least this mean probability is rejected; texts of two languages stay.
LEAST_SCORE = 0.4


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents whose language is known with enough probability."""
    field = crf_language.train(docs)
    labelled = crf_language.label(docs, field, docs.columns)
    kept = (F.col("lang_pred") != crf_language.UNKNOWN) & (F.col("score") >= LEAST_SCORE)
    return labelled.where(kept).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group linked by a similarity of 0.8 or more over five-word shingles."""
    return near_copies.dedup(docs)


def repeated_sentences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut sentences out that repeated spans cover, but for the first time."""
    cut = sentence_dedup.dedup(docs).where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_sentences")))
    n_chars = F.when(F.col("n_removed") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", n_chars).select(*docs.columns)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents without a benchmark item."""
    found = decontaminate.annotate(docs, read_table(spark, sf_dir, "benchmark"))
    return found.where(F.size("items") == 0).select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in the order of the mixture, with their block, slot and place."""
    mixed = pfair_mix.mix(docs, docs.columns)
    return mixed.repartitionByRange("slot", "block_offset", "order_key").sortWithinPartitions("slot", "block_offset", "order_key")


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("repeated_sentences", repeated_sentences),
    ("benchmark_passages", benchmark_passages),
    ("mixture", mixture),
]

#: The language field, the fingerprints and the sentence spans are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = save(docs, name)
    return docs
