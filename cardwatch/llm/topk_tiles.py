"""Exact top-k search by tiled matrix products.

Every vector becomes integers, floor(SCALE * x). Rows are packed into shards of at most `SHARD` vectors, ordered by
id, and the query rows among them into blocks of at most `QUERY_BLOCK`. A grid deals query blocks to its rows and
shards to its columns; each block travels to every cell of its line, and inside a cell every pair of blocks is
one tile: a matrix product, from which each query keeps its k best. The lists of a query then meet in a tree, `FAN_IN`
columns at a time, until one list is left. A task holds two blocks and the lists of the query blocks of its cell;
a merge holds `FAN_IN` lists of one block, so no group grows with the data.

A tile is computed in 32-bit or 64-bit floats where their integers are exact, else in 64-bit integers, and in Python's
integers where even those could overflow. The order is that of the composite of score and place in the shard,
so ties go to the smaller id exactly.

Defined results: a vector that is null or holds a null or non-finite component takes no part. Vectors of different
length are compared on their common components. Scores beyond 64 bits count as the greatest or smallest long.
A row with a null id is no query; as a candidate it comes last among equals. Repeated rows are rows of their
own: each is a candidate of the others, and each repeated query gets its list. An empty table gives an
empty one. Columns beside the id and the vector are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch.llm.common import save
from cardwatch.session import with_package

SCALE = 64
K = 20
QUERY_EVERY = 20
SHARD = 4096
QUERY_BLOCK = 1024
#: Columns of the grid whose lists are merged at once.
FAN_IN = 16
#: Scores of one cell, at most about, and at least where there are cores to use.
CELL_MOST, CELL_LEAST = 1 << 28, 1 << 22
_LAST_ID = np.iinfo(np.int64).max
_LONG = np.iinfo(np.int64)
_BLOCKS = "is_query boolean, block bigint, n int, dim int, bound double, width int, ids binary, no_id binary, rows binary, vectors binary"
_LISTS = "block bigint, part int, n int, k int, query_ids binary, scores binary, ids binary, no_id binary, rows binary"


def _as_integers(vectors: list[np.ndarray]) -> tuple[np.ndarray, int, float]:
    """The matrix of floor(SCALE * x), bytes per component (0: Python's integers as text), greatest magnitude."""
    dim = max(map(len, vectors), default=0)
    real = np.zeros((len(vectors), dim))
    for row, v in zip(real, vectors, strict=True):
        row[: len(v)] = v
    with np.errstate(over="ignore"):
        whole = np.floor(real * SCALE)
    bound = float(np.abs(whole).max(initial=0))
    for width in (1, 2, 4, 8):
        if bound < 2.0 ** (8 * width - 1):
            return whole.astype(f"i{width}"), width, bound
    return real, 0, bound


def _matrix(b: dict) -> np.ndarray:
    if b["width"]:
        return np.frombuffer(b["vectors"], f"i{b['width']}").reshape(b["n"], b["dim"])
    real = np.frombuffer(b["vectors"], np.float64).reshape(b["n"], b["dim"])
    # beyond 2 ** 53 a float is a whole number
    whole = [int(x) * SCALE if abs(x) > 2.0**53 else math.floor(x * SCALE) for x in real.reshape(-1).tolist()]
    return np.array(whole, object).reshape(real.shape)


def _pack(is_query: bool, block: int, rows: list[tuple]) -> list:
    """One block of (id or None, row, vector), ordered by id."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    vectors, width, bound = _as_integers([r[2] for r in rows])
    ids = np.array([_LAST_ID if r[0] is None else r[0] for r in rows], np.int64)
    no_id = np.array([r[0] is None for r in rows], bool)
    places = np.array([r[1] for r in rows], np.int64)
    return [is_query, block, len(rows), vectors.shape[1], bound, width, ids.tobytes(), no_id.tobytes(), places.tobytes(), vectors.tobytes()]


def _batch(rows: list[list], like: str) -> pa.RecordBatch:
    kinds = {"boolean": pa.bool_(), "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "binary": pa.binary()}
    fields = [f.split() for f in like.split(", ")]
    columns = [pa.array(list(c), kinds[kind]) for c, (_, kind) in zip(zip(*rows, strict=True), fields, strict=True)]
    return pa.RecordBatch.from_arrays(columns, [name for name, _ in fields])


def blocks(vectors: DataFrame, id_col: str, vector_col: str, every: int, shard: int, query_block: int) -> DataFrame:
    """Shards and query blocks, stored once: rows are named by where they were packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 40
        row = first
        held: dict[bool, list] = {False: [], True: []}
        for batch in batches:
            ids, lists = batch.column(0).to_pylist(), batch.column(1)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            ends = np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            fine = lists.is_valid().to_pylist()
            for i, (vec_id, ok) in enumerate(zip(ids, fine, strict=True)):
                v = flat[(ends[i - 1] if i else 0) : ends[i]]
                if not ok or not np.isfinite(v).all():
                    continue
                row += 1
                for is_query, most in ((False, shard), (True, query_block)):
                    if is_query and (vec_id is None or vec_id % every):
                        continue
                    held[is_query].append((vec_id, row, v))
                    if len(held[is_query]) == most:
                        yield _batch([_pack(is_query, row, held[is_query])], _BLOCKS)
                        held[is_query] = []
        for is_query, rows in held.items():
            if rows:
                yield _batch([_pack(is_query, row, rows)], _BLOCKS)

    with_package(vectors.sparkSession)
    rows = vectors.select(F.col(id_col).cast("bigint"), F.col(vector_col).cast("array<double>"))
    return save(rows.mapInArrow(run, _BLOCKS), "vector-blocks")


def products(q: dict, c: dict) -> np.ndarray:
    """Integer inner products of all rows of two blocks."""
    a, b = _matrix(q), _matrix(c)
    dim = min(a.shape[1], b.shape[1])
    a, b = a[:, :dim], b[:, :dim]
    bound = q["bound"] * c["bound"] * max(1, dim)
    if q["width"] and c["width"] and bound < 2.0**62:
        kind = np.float32 if bound < 2.0**24 else np.float64 if bound < 2.0**53 else np.int64
        return (a.astype(kind) @ b.astype(kind).T).astype(np.int64)
    whole = np.dot(a.astype(object), b.astype(object).T) if dim else np.zeros((len(a), len(b)), object)
    return np.clip(whole, _LONG.min, _LONG.max).astype(np.int64)


def best(scores: np.ndarray, valid: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best of each line, best first: by score, then id, then row. Those not valid come last."""
    n = scores.shape[1]
    k = min(k, n)
    top = int(np.abs(scores).max(initial=0)) if n and not (scores == _LONG.min).any() else _LONG.max
    if ids.ndim == 1 and top < (1 << 61) // max(1, n):
        # a shard is in the order of its ids, so the place decides ties
        order = scores * n - np.arange(n)
        order[~valid] = _LONG.min
        part = np.argpartition(order, n - k, axis=1)[:, n - k :] if k < n else np.broadcast_to(np.arange(n), scores.shape)
        return np.take_along_axis(part, np.argsort(np.take_along_axis(order, part, 1), axis=1)[:, ::-1], 1)
    ids, rows = np.broadcast_to(ids, scores.shape), np.broadcast_to(rows, scores.shape)
    # the complement orders all longs downwards
    return np.lexsort((rows, ids, ~scores, ~valid), axis=1)[:, :k]


class _Lists:
    """The best so far of each query of one block."""

    def __init__(self, n: int):
        self.scores, self.ids, self.rows = (np.zeros((n, 0), np.int64) for _ in range(3))
        self.no_id = self.valid = np.zeros((n, 0), bool)

    def add(self, k: int, scores, ids, no_id, rows, valid) -> None:
        joined = [np.concatenate(x, axis=1) for x in ((self.scores, scores), (self.ids, ids), (self.no_id, no_id), (self.rows, rows), (self.valid, valid))]
        at = best(joined[0], joined[4], joined[1], np.where(joined[2], joined[3] | (1 << 62), joined[3]), k)
        self.scores, self.ids, self.no_id, self.rows, self.valid = (np.take_along_axis(x, at, 1) for x in joined)


def _line(block: int, part: int, query_ids: bytes, lists: _Lists) -> list:
    # what is not valid travels as row zero, which no row has
    rows = np.where(lists.valid, lists.rows, 0)
    return [block, part, *lists.scores.shape, query_ids, lists.scores.tobytes(), lists.ids.tobytes(), lists.no_id.tobytes(), rows.tobytes()]


def _tiles(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], tuple[bytes, _Lists]] = {}
        for batch in batches:
            for pair in batch.to_pylist():
                q, c = pair["q"], pair["c"]
                scores = products(q, c)
                ids, no_id, rows = np.frombuffer(c["ids"], np.int64), np.frombuffer(c["no_id"], bool), np.frombuffer(c["rows"], np.int64)
                own = np.frombuffer(q["rows"], np.int64)[:, None] == rows if np.isin(np.frombuffer(q["rows"], np.int64), rows).any() else None
                valid = np.ones(scores.shape, bool) if own is None else ~own
                at = best(scores, valid, ids, np.where(no_id, rows | (1 << 62), rows), k)
                _, lists = held.setdefault((q["block"], pair["part"]), (q["ids"], _Lists(q["n"])))
                lists.add(k, np.take_along_axis(scores, at, 1), ids[at], no_id[at], rows[at], np.take_along_axis(valid, at, 1))
        for (block, part), (query_ids, lists) in held.items():
            yield _batch([_line(block, part, query_ids, lists)], _LISTS)

    return run


def _merge(k: int):
    def run(table: pa.Table) -> pa.Table:
        parts = table.to_pylist()
        lists = _Lists(parts[0]["n"])
        for p in sorted(parts, key=lambda p: p["part"]):
            shape = (p["n"], p["k"])
            rows = np.frombuffer(p["rows"], np.int64).reshape(shape)
            lists.add(k, np.frombuffer(p["scores"], np.int64).reshape(shape), np.frombuffer(p["ids"], np.int64).reshape(shape), np.frombuffer(p["no_id"], bool).reshape(shape), rows, rows != 0)
        return pa.Table.from_batches([_batch([_line(parts[0]["block"], parts[0]["part"] // FAN_IN, parts[0]["query_ids"], lists)], _LISTS)])

    return run


def _ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for p in batch.to_pylist():
            shape = (p["n"], p["k"])
            good = np.frombuffer(p["rows"], np.int64).reshape(shape) != 0
            query = np.broadcast_to(np.frombuffer(p["query_ids"], np.int64)[:, None], shape)[good]
            rank = np.broadcast_to(np.arange(1, shape[1] + 1, dtype=np.int32), shape)[good]
            ids = pa.array(np.frombuffer(p["ids"], np.int64).reshape(shape)[good], mask=np.frombuffer(p["no_id"], bool).reshape(shape)[good])
            scores = np.frombuffer(p["scores"], np.int64).reshape(shape)[good]
            yield pa.RecordBatch.from_arrays([pa.array(query), pa.array(rank), ids, pa.array(scores)], ["query_id", "rank", "vec_id", "score"])


def grid(n_queries: int, n_rows: int, cores: int, query_blocks: int, shards: int) -> tuple[int, int]:
    """Rows and columns of the grid: cells of bounded work, and of a shape for which blocks travel least."""
    work = n_queries * n_rows
    cells = max(1, -(-work // CELL_MOST), min(-(-work // CELL_LEAST), 3 * cores))
    rows = max(1, min(query_blocks, round((cells * n_queries / max(1, n_rows)) ** 0.5)))
    return rows, max(1, min(shards, -(-cells // rows)))


def search(
    vectors: DataFrame,
    k: int = K,
    every: int = QUERY_EVERY,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    shard: int = SHARD,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """query_id, rank, vec_id and score of the k best rows of each query, the rows whose id `every` divides."""
    spark = vectors.sparkSession
    packed = blocks(vectors, id_col, vector_col, every, shard, query_block)
    size = {r["is_query"]: r for r in packed.groupBy("is_query").agg(F.sum("n").alias("n"), F.count("*").alias("blocks")).collect()}
    if len(size) < 2:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    n_rows, n_columns = grid(size[True]["n"], size[False]["n"], spark.sparkContext.defaultParallelism, size[True]["blocks"], size[False]["blocks"])

    def line(count: int):
        return F.pmod(F.xxhash64("block"), F.lit(count)).cast("int")

    def every_one(count: int):
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    whole = F.struct("block", "n", "dim", "bound", "width", "ids", "no_id", "rows", "vectors")
    q = packed.where("is_query").select(whole.alias("q"), line(n_rows).alias("row"), every_one(n_columns).alias("part"))
    c = packed.where("NOT is_query").select(whole.alias("c"), line(n_columns).alias("part"), every_one(n_rows).alias("row"))
    cells = n_rows * n_columns
    pairs = q.repartition(cells, "row", "part").join(c.repartition(cells, "row", "part"), ["row", "part"])
    lists = pairs.select("part", "q", "c").mapInArrow(_tiles(k), _LISTS)
    while True:
        lists = lists.groupBy("block", F.expr(f"part div {FAN_IN}")).applyInArrow(_merge(k), _LISTS)
        n_columns = -(-n_columns // FAN_IN)
        if n_columns == 1:
            return lists.mapInArrow(_ranked, "query_id bigint, rank int, vec_id bigint, score bigint")
