"""Language of texts by a linear-chain conditional random field over their words.

A word (a run of letters, in lower case) has as features its character n-grams (two and three characters,
boundaries included), its affixes (first and last characters, up to three) and its entry in a lexicon (words
of the training sample that several documents share). Labels are the languages of the sample. Transitions
are learned from sequences in which pieces of documents of different languages follow each other, so a
text may switch between languages; forward-backward over the whole text gives each word's probabilities.
The text's language is the one with the greatest mean probability over its words, the score is that mean.

The field is fitted on at most `rows_per_label` labelled rows and `BYTES_PER_LABEL` bytes of each language, those
of smallest id hash, by gradient ascent on the penalised likelihood; the expected moves are the pair marginals of
forward-backward. Labelling works on whole texts: transfer matrices of blocks
of words are multiplied along a text first, then all blocks of a slice go forward and backward at once.

Defined results: a null text or one without a letter is `und` with score 0. If no row has a label to learn
from, all are `und`. Repeated rows get equal results, a null id stays null and its row counts as held out
(its hash has no value), an empty table gives an empty one. Language and source are never read when a
text is labelled.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardwatch.llm import textnum
from cardwatch.llm.common import map_text

ROWS_PER_LABEL = 100
#: The texts that one language is learned from have at most so many bytes together.
BYTES_PER_LABEL = 1 << 20
UNKNOWN = "und"
ROUNDS = 40
RATE = 0.3
PENALTY = 1e-5
SWITCH_WORDS = (4, 40)
BITS = 15
BLOCK = 32
_M = (1 << BITS) - 1


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


@dataclass
class WordFeatures:
    """Hashed features of all words of some texts."""

    chars: np.ndarray  # of each letter: word number
    gram2: np.ndarray
    gram3: np.ndarray
    affixes: np.ndarray  # of each word: four hashed features
    word: np.ndarray  # of each word: 64-bit hash
    owner: np.ndarray  # of each word: text number
    begin: np.ndarray  # of each word: first letter in `chars`


def features(texts: list[str | None]) -> WordFeatures:
    low = [(t or "").lower() for t in texts]
    codes = np.frombuffer("\n".join(["", *low, ""]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    solid = _letters()[codes]
    c = np.where(solid, codes, 0).astype(np.uint64)
    at = np.flatnonzero(solid)
    first = at[~solid[at - 1]]
    last = at[~solid[at + 1]] + 1
    ends = np.cumsum([1 + len(t) for t in low]) + 1 if low else np.zeros(0, np.int64)
    k = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
    a, b, z = c[at - 1] * k[0], c[at] * k[1], c[at + 1]

    def slot(x: np.ndarray, kind: int) -> np.ndarray:
        x = (x ^ (x >> np.uint64(29))) * k[3] + np.uint64(kind * 0x51ED27)
        return ((x >> np.uint64(40)) & np.uint64(_M)).astype(np.int32)

    def letter(i: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return np.where((i >= lo) & (i < hi), c[np.clip(i, 0, len(c) - 1)], 0)

    def some(i, step) -> np.ndarray:
        out = np.zeros(len(first), np.uint64)
        for j, f in enumerate((k[0], k[1], k[2])):
            out += letter(i + step * j, first, last) * f
        return out

    affixes = [slot(c[first] * k[0], 3), slot(c[last - 1] * k[0], 4), slot(some(first, 1), 5), slot(some(last - 1, -1), 6)]
    word = textnum.RangeHash(textnum.mix(c))(first, last)
    size = last - first
    return WordFeatures(
        chars=np.repeat(np.arange(len(first)), size),
        gram2=slot(b + z * k[2], 1),
        gram3=slot(a + b + z * k[2], 2),
        affixes=np.stack(affixes, 1) if len(first) else np.zeros((0, 4), np.int32),
        word=word,
        owner=np.searchsorted(ends, first, "right"),
        begin=np.cumsum(size) - size,
    )


@dataclass
class Field:
    labels: list[str]
    weights: np.ndarray  # slots x labels
    lexicon: np.ndarray  # sorted word hashes
    words: np.ndarray  # words of the lexicon, and one row of zeros, x labels
    moves: np.ndarray  # labels x labels

    def emissions(self, f: WordFeatures) -> np.ndarray:
        out = self.weights[f.affixes].sum(axis=1) + self.words[look_up(self.lexicon, f.word)]
        if len(f.begin):
            out += np.add.reduceat(self.weights[f.gram2] + self.weights[f.gram3], f.begin, axis=0)
        return out


def look_up(lexicon: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Place in the lexicon; of other words, the place after its end."""
    if not len(lexicon):
        return np.zeros(len(word), np.int64)
    at = np.searchsorted(lexicon, word)
    at[at == len(lexicon)] = 0
    return np.where(lexicon[at] == word, at, len(lexicon))


def posteriors(emissions: np.ndarray, owner: np.ndarray, moves: np.ndarray, n_texts: int) -> np.ndarray:
    """Probability of each label at each word; the words of a text follow each other. Before its first word
    all labels are equally likely."""
    return marginals(emissions, owner, moves, n_texts)[0]


def marginals(emissions: np.ndarray, owner: np.ndarray, moves: np.ndarray, n_texts: int) -> tuple[np.ndarray, np.ndarray]:
    """The same probabilities, and the expected number of each move: those from label to label, and those from
    the unseen label before a text to its first word."""
    n, n_labels = emissions.shape
    if not n:
        return emissions, np.zeros((n_labels, n_labels))
    e = np.exp(emissions - emissions.max(axis=1, keepdims=True)) + 1e-30
    a = np.exp(moves - moves.max())
    size = np.bincount(owner, minlength=n_texts)
    blocks = -(-size // BLOCK)
    first_block = np.cumsum(blocks) - blocks
    within = np.arange(n) - np.repeat(np.cumsum(size) - size, size)
    block, step = np.repeat(first_block, size) + within // BLOCK, within % BLOCK
    n_blocks = int(blocks.sum())
    grid = np.ones((BLOCK, n_blocks, n_labels))
    grid[step, block] = e
    live = np.zeros((BLOCK, n_blocks, 1), bool)
    live[step, block] = True
    # what a block does to a vector of label weights that enters it
    whole = np.tile(np.eye(n_labels), (n_blocks, 1, 1))
    for t in range(BLOCK):
        moved = (whole.reshape(-1, n_labels) @ a).reshape(whole.shape) * grid[t][:, None, :]
        moved /= moved.max(axis=(1, 2), keepdims=True)
        whole = np.where(live[t][:, :, None], moved, whole)
    enter, leave = np.ones((n_blocks, n_labels)), np.ones((n_blocks, n_labels))
    for j in range(1, int(blocks.max(initial=0))):
        b = first_block[blocks > j] + j
        v = np.einsum("bi,bij->bj", enter[b - 1], whole[b - 1])
        enter[b] = v / v.sum(axis=1, keepdims=True)
        texts = np.flatnonzero(blocks > j)
        b = first_block[texts] + blocks[texts] - j
        v = np.einsum("bij,bj->bi", whole[b], leave[b])
        leave[b - 1] = v / v.sum(axis=1, keepdims=True)
    forward = np.empty_like(grid)
    v = enter
    for t in range(BLOCK):
        moved = (v @ a) * grid[t]
        v = np.where(live[t], moved / moved.sum(axis=1, keepdims=True), v)
        forward[t] = v
    v = leave
    pairs = np.zeros((n_labels, n_labels))
    for t in range(BLOCK - 1, -1, -1):
        here = live[t][:, 0]
        # alpha of the word before, times the move, times emission and beta of this word, each pair's sum being one
        before, after = (forward[t - 1] if t else enter)[here], (v * grid[t])[here]
        weight = np.einsum("bi,ij,bj->b", before, a, after)
        pairs += a * ((before / weight[:, None]).T @ after)
        forward[t] *= v
        moved = (v * grid[t]) @ a.T
        v = np.where(live[t], moved / moved.sum(axis=1, keepdims=True), v)
    out = forward[step, block]
    return out / out.sum(axis=1, keepdims=True), pairs


def seen_moves(y: np.ndarray, owner: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """How often each move is made by the labels y; the unseen label before a text has its share of each label."""
    out = np.zeros_like(moves)
    inside = owner[1:] == owner[:-1]
    np.add.at(out, (y[:-1][inside], y[1:][inside]), 1)
    start = np.exp(moves - moves.max(axis=0))
    first = np.concatenate([[True], ~inside]) if len(y) else np.zeros(0, bool)
    return out + start / start.sum(axis=0) * np.bincount(y[first], minlength=len(moves))


def fit(texts: list[str], labels: list[str], rounds: int = ROUNDS, seed: int = 7) -> Field:
    """Field that explains the labelled texts; the pieces of different texts are strung together."""
    names = sorted(set(labels))
    n_labels = len(names)
    f = features(texts)
    y = np.searchsorted(names, labels)[f.owner] if len(f.owner) else np.zeros(0, np.int64)
    # lexicon: words of at least two texts
    pairs = np.unique(np.stack([f.word, f.owner.astype(np.uint64)], 1), axis=0) if len(f.word) else np.zeros((0, 2), np.uint64)
    values, counts = np.unique(pairs[:, 0], return_counts=True)
    lexicon = values[counts >= 2]
    entry = look_up(lexicon, f.word)
    # cut into pieces and deal them out in another order
    rng = np.random.default_rng(seed)
    starts = np.flatnonzero(np.concatenate([[True], f.owner[1:] != f.owner[:-1]])) if len(y) else np.zeros(0, np.int64)
    cuts = np.unique(np.concatenate([starts, np.cumsum(rng.integers(*SWITCH_WORDS, size=len(y) // SWITCH_WORDS[0] + 1))]))
    cuts = cuts[cuts < len(y)]
    piece_size = np.diff(np.append(cuts, len(y)))
    order = rng.permutation(len(cuts))
    moved_size = piece_size[order]
    words = np.repeat(cuts[order] - (np.cumsum(moved_size) - moved_size), moved_size) + np.arange(len(y))
    chain = np.arange(len(y)) // 64  # chains of equal length keep all steps in one array operation
    n_chains = int(chain[-1]) + 1 if len(chain) else 0
    weights, lex, moves = np.zeros((1 << BITS, n_labels)), np.zeros((len(lexicon) + 1, n_labels)), np.zeros((n_labels, n_labels))
    field = Field(names, weights, lexicon, lex, moves)
    if not len(y) or n_labels < 2:
        return field
    truth = np.eye(n_labels)[y]
    y_chain = y[words]
    params = [weights, lex, moves]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, rounds + 1):
        e = field.emissions(f)[words]
        p_chain, expected = marginals(e, chain, moves, n_chains)
        p = np.empty_like(p_chain)
        p[words] = p_chain
        miss = truth - p
        g = np.zeros_like(weights)
        per_char = miss[f.chars]
        for label in range(n_labels):
            for slots in (f.gram2, f.gram3):
                g[:, label] += np.bincount(slots, per_char[:, label], 1 << BITS)
            for j in range(4):
                g[:, label] += np.bincount(f.affixes[:, j], miss[:, label], 1 << BITS)
        g_lex = np.stack([np.bincount(entry, miss[:, label], len(lexicon) + 1) for label in range(n_labels)], 1)
        g_lex[-1] = 0
        g_moves = seen_moves(y_chain, chain, moves) - expected
        for i, (param, grad) in enumerate(zip(params, (g, g_lex, g_moves), strict=True)):
            grad = grad / len(y) - PENALTY * param
            first[i] = 0.9 * first[i] + 0.1 * grad
            second[i] = 0.99 * second[i] + 0.01 * grad * grad
            param += RATE * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.99**step)) + 1e-8) * (0.98**step)
    lex[-1] = 0
    return field


def training_rows(docs: DataFrame, rows_per_label: int, bytes_per_label: int = BYTES_PER_LABEL) -> DataFrame:
    """At most so many labelled rows of each language: those of smallest id hash, as far as their texts together
    have at most so many bytes; longer texts are not learned from. The hash thins out frequent
    languages where they are read, so that no text is shuffled but some times the number wanted."""
    size = F.octet_length("text").cast("bigint")
    rows = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & (size <= bytes_per_label)).select(
        "doc_id", "text", "lang", F.xxhash64("doc_id").alias("h")
    )
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}  # a row per language
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, 3.0 * rows_per_label / n))])
    thin = rows.where((F.col("h") / 2.0**64 + 0.5) <= share[F.col("lang")]) if counts else rows
    w = Window.partitionBy("lang").orderBy("h", "doc_id", "text")
    few = thin.withColumn("r", F.row_number().over(w)).where(F.col("r") <= rows_per_label)
    upto = F.sum(size).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return few.withColumn("upto", upto).where(F.col("upto") <= bytes_per_label).select("doc_id", "text", "lang")


def train(docs: DataFrame, rows_per_label: int = ROWS_PER_LABEL) -> Field:
    """Field fitted on a bounded sample of the labelled rows."""
    rows = sorted(training_rows(docs, rows_per_label).collect(), key=lambda r: (r["lang"], r["doc_id"] or 0, r["text"]))
    return fit([r["text"] for r in rows], [r["lang"] for r in rows])


def held_out(folds: int = 4, fold: int = 2):
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == fold, F.lit(True))


def label(docs: DataFrame, field: Field, keep: list[str] | None = None) -> DataFrame:
    """Columns `keep` of each row (doc_id by default), lang_pred and score."""
    keep = keep or ["doc_id"]
    rows = docs.select(*keep, *([] if "text" in keep else ["text"]))
    schema = rows.select(*keep).schema.add("lang_pred", "string").add("score", "double")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column("text").to_pylist()
        f = features(texts)
        p = posteriors(field.emissions(f), f.owner, field.moves, len(texts)) if field.labels else np.zeros((len(f.owner), 1))
        n = np.bincount(f.owner, minlength=len(texts))
        mean = np.stack([np.bincount(f.owner, v, len(texts)) for v in p.T], 1) / np.maximum(n, 1)[:, None]
        best = mean.argmax(axis=1)
        sure = (n > 0) & bool(field.labels)
        names = [field.labels[b] if s else UNKNOWN for b, s in zip(best, sure, strict=True)]
        score = np.where(sure, np.clip(mean[np.arange(len(texts)), best], 0, 1), 0.0)
        columns = [*(batch.column(c) for c in keep), pa.array(names, pa.string()), pa.array(score)]
        return pa.RecordBatch.from_arrays(columns, [*keep, "lang_pred", "score"])

    return map_text(rows, work, schema)
