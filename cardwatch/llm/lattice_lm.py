"""Language-model scores by the marginal probability of all segmentations of a text into subwords.

The vocabulary is that of an existing model file; the tokenizer itself is not trained. A piece's unigram score
is the smoothed frequency of the piece in the training documents, (count + 1) / (all + pieces), where the file's
own segmentation is counted; an end of text is a piece too. A word's segmentations are the paths of a
lattice over its characters (with the space before it); the forward recursion in log space adds up the
probabilities of all of them. No piece of the vocabulary spans two words, so a text's log10 probability is the
sum of those of its words and its end. A character that no piece has counts as its bytes.

The base score is the one of smoothed words. Words are runs of what is no white space, with A-Z in lower case.

The tasks read texts once and leave, per chunk of documents, the distinct words with their training counts and
the documents as word numbers. Words meet in a window per word (a row per chunk at most), each distinct
word is scored once, and the values go back to the chunks. Nothing that grows with the corpus is broadcast;
the driver gets the counts of pieces, as many as the vocabulary has, and two totals.

Defined results: a null or empty text has only its end. Documents without an id are never learned from and
count as held out. Repeated rows get equal results, an empty table gives an empty one, other columns are not
read. Without training documents all counts are zero.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardwatch.llm.common import save
from cardwatch.llm.heap_bpe import tokenizer_path
from cardwatch.session import with_package

FOLDS, FOLD = 7, 2
#: A chunk of documents ends at so many bytes of text, or so many distinct words.
CHUNK_BYTES = 24 << 20
CHUNK_WORDS = 400_000
MISS = -math.inf


@lru_cache(maxsize=2)
def _model(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def held_out(folds: int = FOLDS, fold: int = FOLD):
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == fold, F.lit(True))


class Lattice:
    """Log probabilities of words from counts of pieces."""

    def __init__(self, path: str, counts: dict[int, int]):
        model = _model(path)
        ids = [i for i in range(model.get_piece_size()) if i == model.eos_id() or not (model.is_control(i) or model.is_unknown(i))]
        total = sum(counts.get(i, 0) for i in ids) + len(ids)
        score = {i: math.log((counts.get(i, 0) + 1) / total) for i in ids}
        self.end = score[model.eos_id()] / math.log(10)
        self.bytes = {int(model.id_to_piece(i)[3:5], 16): s for i, s in score.items() if model.is_byte(i)}
        self.pieces = {model.id_to_piece(i): s for i, s in score.items() if i != model.eos_id() and not model.is_byte(i)}
        if any("▁" in p.lstrip("▁") for p in self.pieces):
            raise ValueError("a piece spans two words")
        self.longest = max(map(len, self.pieces))

    def word(self, word: str) -> float:
        """log10 of the summed probabilities of all segmentations."""
        text = "▁" + word
        get, exp, log = self.pieces.get, math.exp, math.log
        ahead = [0.0]
        for j in range(1, len(text) + 1):
            ways = []
            for i in range(max(0, j - self.longest), j):
                s = get(text[i:j])
                if s is not None:
                    ways.append(ahead[i] + s)
            if text[j - 1] not in self.pieces:
                ways.append(ahead[j - 1] + sum(self.bytes[b] for b in text[j - 1].encode()))
            top = max(ways)
            ahead.append(top if len(ways) == 1 else top + log(sum(exp(w - top) for w in ways)))
        return ahead[-1] / log(10)


_CHUNKS = (
    "chunk bigint, doc_id bigint, held_out boolean, n_words bigint, ids binary, times binary, "
    "word string, id int, n bigint"
)


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents as word numbers, and the words of each chunk with their counts in training documents."""
    schema = pa.schema(
        [("chunk", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_words", pa.int64()), ("ids", pa.binary()), ("times", pa.binary()), ("word", pa.string()), ("id", pa.int32()), ("n", pa.int64())]
    )
    number = TaskContext.get().partitionId() << 24

    def batch(rows: int, **columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(rows, f.type) for f in schema], schema=schema)

    def close() -> Iterator[pa.RecordBatch]:
        chunk = number + closed
        for k in range(0, len(docs), 2000):
            d = list(zip(*docs[k : k + 2000], strict=True))
            yield batch(len(d[0]), chunk=[chunk] * len(d[0]), doc_id=d[0], held_out=d[1], n_words=d[2], ids=[x.tobytes() for x in d[3]], times=[x.tobytes() for x in d[4]])
        learned = [(x[3], x[4]) for x in docs if not x[1]]
        n = np.zeros(len(index), np.int64)
        if learned:
            n += np.bincount(np.concatenate([x[0] for x in learned]), np.concatenate([x[1] for x in learned]), len(index)).astype(np.int64)
        words = list(index)
        for k in range(0, len(words), 20_000):
            own = [w.decode() for w in words[k : k + 20_000]]
            yield batch(len(own), chunk=[chunk] * len(own), word=own, id=np.arange(k, k + len(own), dtype=np.int32), n=n[k : k + len(own)])

    closed, size, docs = 0, 0, []
    index: defaultdict[bytes, int] = defaultdict(count().__next__)
    for rows in batches:
        for doc_id, text, out in zip(*(rows.column(c).to_pylist() for c in ("doc_id", "text", "held_out")), strict=True):
            words = (text or "").encode().lower().split()
            ids, times = np.unique(np.fromiter((index[w] for w in words), np.int32, len(words)), return_counts=True)
            docs.append((doc_id, out, len(words), ids.astype(np.int32), times.astype(np.int32)))
            size += len(text or "")
            if size >= CHUNK_BYTES or len(index) >= CHUNK_WORDS:
                yield from close()
                closed, size, docs = closed + 1, 0, []
                index = defaultdict(count().__next__)
    if docs:
        yield from close()


def score(docs: DataFrame, path: str | None = None, folds: int = FOLDS, fold: int = FOLD) -> DataFrame:
    """held_out, n_tokens, n_known, train_tokens, base_score and score of each row.

    Learns from documents whose crc32(doc_id as text) mod `folds` is not `fold`.
    """
    rows = docs.select(F.col("doc_id").cast("bigint"), "text").withColumn("held_out", held_out(folds, fold))
    with_package(docs.sparkSession)
    chunks = save(rows.mapInArrow(_encode, _CHUNKS), "chunks")
    words = chunks.where("word IS NOT NULL").select("word", "chunk", "id", "n")
    by_word = Window.partitionBy("word")
    words = save(
        words.select(
            "word", "chunk", "id", F.sum("n").over(by_word).alias("c"), (F.row_number().over(by_word.orderBy("chunk")) == 1).alias("first")
        ),
        "words",
    )
    learned = words.where("first AND c > 0")
    totals = learned.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    n_ends = chunks.where("word IS NULL AND NOT held_out").count()
    n, v = totals["n"] + n_ends, totals["v"] + (n_ends > 0)

    def segment(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(path or tokenizer_path())
        found: Counter[int] = Counter()
        for batch in batches:
            texts = batch.column("word").to_pylist()
            for ids, c in zip(model.encode(texts, num_threads=1), batch.column("c").to_pylist(), strict=True):
                for i in ids:
                    found[i] += c
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int32()), pa.array(list(found.values()), pa.int64())], ["piece", "n"])

    pieces = learned.select("word", "c").mapInArrow(segment, "piece int, n bigint").groupBy("piece").agg(F.sum("n").alias("n"))
    counts = {r["piece"]: r["n"] for r in pieces.collect()}  # as many as the vocabulary has at most
    counts[_model(path or tokenizer_path()).eos_id()] = n_ends
    shared = docs.sparkSession.sparkContext.broadcast(counts)

    def value(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(path or tokenizer_path(), shared.value)
        last, own = None, 0.0
        for batch in batches:
            out = []
            for word in batch.column("word").to_pylist():  # equal words follow each other
                if word != last:
                    last, own = word, lattice.word(word)
                out.append(own)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("chunk", "id", "c")), pa.array(out, pa.float64())], ["chunk", "id", "c", "lp"])

    values = words.select("word", "chunk", "id", "c").mapInArrow(value, "chunk bigint, id int, c bigint, lp double")
    coded = chunks.where("word IS NULL").select("chunk", "doc_id", "held_out", "n_words", "ids", "times")

    def finish(docs: pa.Table, values: pa.Table) -> pa.Table:
        lattice = Lattice(path or tokenizer_path(), shared.value)
        order = np.argsort(values.column("id").to_numpy())
        c, lp = values.column("c").to_numpy()[order], values.column("lp").to_numpy()[order]
        base = np.log10((c + 1) / (n + v + 1))
        ids, times = (np.frombuffer(b"".join(docs.column(k).to_pylist()), np.int32) for k in ("ids", "times"))
        owner = np.repeat(np.arange(docs.num_rows), [len(x) // 4 for x in docs.column("ids").to_pylist()])
        add = lambda x: np.bincount(owner, x[ids] * times, docs.num_rows)
        known = add((c > 0).astype(np.int64)).astype(np.int64) + (n_ends > 0)
        n_tokens = docs.column("n_words").to_numpy() + 1
        out = {
            "doc_id": docs.column("doc_id"),
            "held_out": docs.column("held_out"),
            "n_tokens": n_tokens,
            "n_known": known,
            "train_tokens": np.full(docs.num_rows, n, np.int64),
            "base_score": add(base) + math.log10((n_ends + 1) / (n + v + 1)),
            "score": add(lp) + lattice.end,
        }
        return pa.table(out)

    schema = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    return coded.groupBy("chunk").cogroup(values.groupBy("chunk")).applyInArrow(finish, schema)
