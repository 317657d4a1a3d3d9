"""Helpers that the operators of this package share: row keys, stored tables, text slices, components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.session import run_dir, with_package

#: Java pattern of what separates words.
SPACES = "[\\x20\\x09-\\x0D]+"
#: Bytes of text that a task works on at once; a longer text makes a slice of its own.
SLICE_BYTES = 1 << 20


def save(df: DataFrame, label: str, **options) -> DataFrame:
    """The rows as a table in the shared folder: cuts the lineage and survives a lost executor."""
    path = run_dir(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_key(id_col: str = "doc_id", text_col: str = "text") -> tuple[Column, Column]:
    """Key of a document that is defined for a null or repeated id: rows with equal id and text are one document."""
    h = F.xxhash64(F.col(id_col).isNull(), F.col(text_col).isNull(), text_col)
    return F.coalesce(F.col(id_col).cast("string"), F.lit("")), h


def map_text(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str, text: str = "text") -> DataFrame:
    """Apply `work` to slices of the rows of bounded text size, inside the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, text):
                yield work(piece)

    with_package(df.sparkSession)
    return df.mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, text: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    if not batch.num_rows:
        return
    ends = np.cumsum(np.diff(offsets_of(batch.column(text))))
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
        yield batch.slice(at, stop - at)
        at = stop


def offsets_of(column: pa.Array) -> np.ndarray:
    """Byte offsets of a text column, the first one as it lies in the buffer."""
    width = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    raw = np.frombuffer(column.buffers()[1], width, len(column) + 1, column.offset * np.dtype(width).itemsize)
    return raw.astype(np.int64)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column one after the other, and the offset of each text; null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    offsets = offsets_of(column)
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of undirected edges (a, b): node, root, the root being the smallest node reachable.

    Alternates the large-star and the small-star step, each one aggregation per node and one join, and
    stores the edges after each pair of steps, until a pair changes nothing. Nodes without an edge do not
    appear. The driver sees only counts. A hub is aggregated before the shuffle, and the join that
    hands out its smallest neighbour is one that adaptive execution splits.
    """

    def star(e: DataFrame, large: bool) -> DataFrame:
        if large:
            both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        else:
            both = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        joined = both.join(least, "a")
        if large:
            out = joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
                least.select("a", F.col("m").alias("b"))
            )
        return out.where(F.col("a") != F.col("b")).distinct()

    now = save(edges.where(F.col("a") != F.col("b")).distinct(), "edges")
    for _ in range(max_rounds):
        after = save(star(star(now, True), False), "edges")
        mark = [F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")]
        seen, now = now.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).agg(*mark).first(), after
        if seen == after.agg(*mark).first():
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
