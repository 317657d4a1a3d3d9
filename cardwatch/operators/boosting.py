"""Gradient-boosted trees over rows that are held as bins: the method and the model of Spark ML, in fewer passes.

The method is that of `GBTClassifier`: logistic loss, variance as impurity, at most 32 bins of about equal weight per
input, trees grown level by level over all rows. Spark ML visits every input of every row once per level. Here a row is
one byte per input (inputs of two values share bytes), a task adds its rows up per byte with array operations, and of two
children only the smaller one is added up; the other is what is left of the parent. The fitted model is Spark ML's.

Two things differ: the thresholds come from all rows (Spark ML looks at some 10,000), and of splits that are equally good but
for rounding the first input is taken, so that the choice does not depend on how the rows are dealt.
"""

from __future__ import annotations

import json
import math
import time
import uuid
from collections.abc import Iterator, Sequence
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.session import run_dir, with_package

#: Most bins of an input, as in Spark ML.
MAX_BINS = 32
#: Points of a task's summary of an input; fewer distinct values are kept as they are.
SUMMARY = 4096
#: Rows that are worked on together.
BLOCK_ROWS = 1 << 16
#: After so many trees the margins are stored; until then each pass adds the trees again, which costs less than storing.
STORED_EVERY = 4
#: After so many trees they are derived from the last kept ones at once, so that lineage stays short.
KEPT_EVERY = 32
#: Gains below this share of the mean square are rounding.
ROUNDING = 1e-12
#: A node of less variance is pure, as in Spark ML.
PURE = 2.0**-52
VALIDATION_TOL = 0.01


class Layout(NamedTuple):
    """Where the inputs are among the byte columns of a block."""

    thresholds: list[np.ndarray]  # per input, ascending
    column: list[int]  # byte column of each input, -1 for a constant one
    bit: list[int]  # the bit of an input of two bins, 0 for an input with a column of its own
    plain: int  # columns of one input each; the packed ones come after them
    packed: int


class Block(NamedTuple):
    """Rows as byte columns, with label and margin; `squares` are those of the last tree's leaves."""

    codes: np.ndarray
    label: np.ndarray
    held: bool  # validation rows, which are not learned from
    margin: np.ndarray | None = None
    squares: np.ndarray | None = None


class Tree(NamedTuple):
    """Splits per level as (position, column, bit, last bin on the left), and the values of the last level's positions.

    The children of position p are 2p and 2p + 1; rows of a leaf go on to the left.
    """

    levels: list[list[tuple[int, int, int, int]]]
    values: np.ndarray


# Binning


def _summary(value: np.ndarray, label: np.ndarray, weights: tuple[float, float]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values with their weights."""
    by_class = [(np.unique(value[side], return_counts=True), w) for side, w in ((~label, weights[0]), (label, weights[1]))]
    return _merged([(distinct, n * w) for (distinct, n), w in by_class])


def _shortened(found: np.ndarray, total: np.ndarray, points: int) -> tuple[np.ndarray, np.ndarray]:
    """As many points of about equal weight when there are more values."""
    if len(found) <= points:
        return found, total
    upto = np.cumsum(total)
    cell = np.minimum((upto - total / 2) * points / upto[-1], points - 1).astype(np.intp)
    last = np.flatnonzero(np.diff(cell, append=points))
    return found[last], np.diff(upto[last], prepend=0.0)


def find_thresholds(value: np.ndarray, weight: np.ndarray, bins: int = MAX_BINS) -> np.ndarray:
    """Midpoints between ascending distinct values, all or those closest to equal shares of the weight."""
    middle = (value[:-1] + value[1:]) / 2.0
    if len(middle) < bins:
        return middle
    upto, stride = np.cumsum(weight), weight.sum() / bins
    chosen, target = [], stride
    for i in range(len(middle)):
        if abs(upto[i] - target) < abs(upto[i + 1] - target):
            chosen.append(i)
            target += stride
    return middle[chosen]


def _merged(parts: Sequence[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    value, weight = (np.concatenate(x) for x in zip(*parts))
    found, place = np.unique(value, return_inverse=True)
    return found, np.bincount(place, weights=weight)


def _matrix(batch: pa.RecordBatch, inputs: Sequence[str]) -> np.ndarray:
    """The inputs as rows of a matrix; a missing one is an error, as for Spark ML's assembler."""
    x = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.float64) for c in inputs])
    if np.isnan(x).any():
        raise ValueError(f"missing values among {', '.join(inputs)}")
    return x


def _flag(batch: pa.RecordBatch, column: str) -> np.ndarray:
    return batch.column(column).to_numpy(zero_copy_only=False).astype(bool)


def _gathered(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Batches joined to at least `rows` rows."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def fit_layout(
    rows: DataFrame, inputs: Sequence[str], weights: tuple[float, float], held: str | None, summary: int = SUMMARY
) -> Layout:
    """Thresholds of all inputs from all training rows: each task sends a summary, and the driver joins them."""
    inputs = list(inputs)

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [[] for _ in inputs]
        for batch in _gathered(batches, 4 * BLOCK_ROWS):
            x, label = _matrix(batch, inputs), _flag(batch, "is_fraud")
            if held:
                x, label = x[:, ~_flag(batch, held)], label[~_flag(batch, held)]
            for i, value in enumerate(x):
                if len(value):
                    found[i].append(_shortened(*_summary(value, label, weights), summary))
        for i, parts in enumerate(found):
            if parts:
                value, weight = _shortened(*_merged(parts), summary)
                yield pa.record_batch({"input": [i], "value": [value], "weight": [weight]}, schema=schema)

    schema = pa.schema([("input", pa.int32()), ("value", pa.list_(pa.float64())), ("weight", pa.list_(pa.float64()))])
    flags = ["is_fraud", *([held] if held else [])]
    parts: list[list] = [[] for _ in inputs]
    for r in rows.select(*inputs, *flags).mapInArrow(summarise, "input int, value array<double>, weight array<double>").collect():
        parts[r["input"]].append((np.array(r["value"]), np.array(r["weight"])))
    n = rows.count() if held is None else rows.where(~F.col(held)).count()
    thresholds = [find_thresholds(*_merged(p), min(MAX_BINS, n)) if p else np.array([]) for p in parts]
    plain = [i for i, t in enumerate(thresholds) if len(t) > 1]
    two = [i for i, t in enumerate(thresholds) if len(t) == 1]
    column, bit = [-1] * len(inputs), [0] * len(inputs)
    for at, i in enumerate(plain):
        column[i] = at
    for at, i in enumerate(two):
        column[i], bit[i] = len(plain) + at // 8, 1 << at % 8
    return Layout(thresholds, column, bit, len(plain), math.ceil(len(two) / 8))


def _blocks(rows: DataFrame, inputs: Sequence[str], layout: Layout, held: str | None) -> RDD:
    """The rows as blocks of bytes."""
    inputs = list(inputs)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _gathered(batches, BLOCK_ROWS):
            codes = np.zeros((layout.plain + layout.packed, batch.num_rows), np.uint8)
            for i, value in enumerate(_matrix(batch, inputs)):
                if layout.bit[i]:
                    codes[layout.column[i]] |= (value > layout.thresholds[i][0]).astype(np.uint8) * np.uint8(layout.bit[i])
                elif layout.column[i] >= 0:
                    codes[layout.column[i]] = np.searchsorted(layout.thresholds[i], value)
            label = _flag(batch, "is_fraud")
            out = _flag(batch, held) if held else np.zeros(len(label), bool)
            for side in (False, True):
                mine = np.flatnonzero(out == side)
                if len(mine):
                    parts = [codes[:, mine].tobytes()], [label[mine].tobytes()], [side]
                    yield pa.record_batch(dict(zip(("codes", "label", "held"), parts)), schema=schema)

    schema = pa.schema([("codes", pa.binary()), ("label", pa.binary()), ("held", pa.bool_())])
    flags = ["is_fraud", *([held] if held else [])]
    frame = rows.select(*inputs, *flags).mapInArrow(encode, "codes binary, label binary, held boolean")
    return frame.rdd.map(partial(_block, layout.plain + layout.packed))


def _block(columns: int, row) -> Block:
    label = np.frombuffer(bytes(row["label"]), bool)
    return Block(np.frombuffer(bytes(row["codes"]), np.uint8).reshape(columns, len(label)), label, row["held"])


# What tasks do with a block


def _positions(codes: np.ndarray, levels: Sequence[Sequence[tuple[int, int, int, int]]], depth: int) -> np.ndarray:
    """Position of each row after the given levels of a tree."""
    at = np.zeros(codes.shape[1], np.min_scalar_type((1 << depth) - 1))
    for splits in levels:
        right = np.zeros(codes.shape[1], bool)
        for position, column, bit, last in splits:
            goes = (codes[column] & np.uint8(bit)) != 0 if bit else codes[column] > last
            right |= goes & (at == position)
        at = (at << 1) | right
    return at


def _residual(label: np.ndarray, margin: np.ndarray | None) -> np.ndarray:
    """Labels of -1 and 1 for the first tree, then the falling gradient of the logistic loss."""
    y = np.where(label, 1.0, -1.0)
    return y if margin is None else 4.0 * y / (1.0 + np.exp(2.0 * y * margin))


def _advance(trees: Sequence[tuple[Tree, float]], depth: int, squared: bool, block: Block) -> Block:
    """The block after some more trees, with the squares in the leaves of the last one if they are asked for."""
    if not trees:
        return block
    margin, squares = block.margin, None
    for i, (tree, weight) in enumerate(trees):
        at = _positions(block.codes, tree.levels, depth)
        if squared and i == len(trees) - 1 and not block.held:
            key = at.astype(np.intp) * 2 + block.label
            squares = np.bincount(key, weights=_residual(block.label, margin) ** 2, minlength=2 << depth).reshape(-1, 2)
        step = weight * tree.values[at]
        margin = step if margin is None else margin + step
    return block._replace(margin=margin, squares=squares)


class Sums(NamedTuple):
    """Added up rows: [slot, class, input, bin] of rows and residuals; [slot, class] of squares, and what root passes bring."""

    rows: np.ndarray
    residuals: np.ndarray
    squares: np.ndarray
    whole: np.ndarray  # [slot, class, (rows, residuals)]
    leaf_squares: np.ndarray
    held_loss: np.ndarray  # loss and weight of the validation rows


def _add_up(
    layout: Layout,
    weights: tuple[float, float],
    depth: int,
    levels: Sequence[Sequence[tuple[int, int, int, int]]],
    slots: Sequence[int],
    trees: Sequence[tuple[Tree, float]],
    blocks: Iterator[Block],
) -> Iterator[Sums]:
    """Sums of the rows of a partition at the given positions of a level, which are the slots; `trees` are not in the margins yet."""
    n_slots, columns = len(slots), layout.plain + layout.packed
    keys = n_slots * 2
    widths = [MAX_BINS] * layout.plain + [256] * layout.packed
    rows = [np.zeros(keys * w, np.int64) for w in widths]
    residuals = [np.zeros(keys * w) for w in widths]
    squares, whole = np.zeros(keys), np.zeros((2, keys))
    leaf_squares, held_loss = np.zeros((1 << depth, 2)), np.zeros(2)
    none = n_slots
    slot_of = np.full(1 << len(levels), none, np.intp)
    slot_of[list(slots)] = np.arange(n_slots)
    for block in blocks:
        if block.held and levels:
            continue
        block = _advance(trees, depth, not levels, block)
        if block.held:
            if block.margin is not None:
                weight = np.where(block.label, weights[1], weights[0])
                wrong = np.where(block.label, -2.0, 2.0) * block.margin
                held_loss += (weight * 2.0 * np.logaddexp(0.0, wrong)).sum(), weight.sum()
            continue
        if not levels and block.squares is not None:
            leaf_squares += block.squares
        codes, label, margin = block.codes, block.label, block.margin
        key = label.astype(np.intp)
        if levels:
            slot = slot_of[_positions(codes, levels, depth)]
            mine = np.flatnonzero(slot != none)
            key = slot[mine] * 2 + key[mine]
            codes, label = codes[:, mine], label[mine]
            margin = None if margin is None else margin[mine]
        r = _residual(label, margin)
        whole[0] += np.bincount(key, minlength=keys)
        whole[1] += np.bincount(key, weights=r, minlength=keys)
        squares += np.bincount(key, weights=r * r, minlength=keys)
        base = {w: key * w for w in set(widths)}
        for c in range(columns):
            at = base[widths[c]] + codes[c]
            rows[c] += np.bincount(at, minlength=keys * widths[c])
            residuals[c] += np.bincount(at, weights=r, minlength=keys * widths[c])
    shape = (n_slots, 2)
    yield Sums(
        _by_input(layout, [x.reshape(*shape, -1) for x in rows]).astype(np.int64),
        _by_input(layout, [x.reshape(*shape, -1) for x in residuals]),
        squares.reshape(shape),
        np.moveaxis(whole.reshape(2, *shape), 0, -1),
        leaf_squares,
        held_loss,
    )


def _by_input(layout: Layout, sums: Sequence[np.ndarray]) -> np.ndarray:
    """Sums per byte as sums per input and bin."""
    shape = sums[0].shape[:2] if sums else (1, 2)
    out = np.zeros((*shape, len(layout.thresholds), MAX_BINS))
    for i, column in enumerate(layout.column):
        if layout.bit[i]:
            has = (np.arange(256) & layout.bit[i]) != 0
            out[:, :, i, 0], out[:, :, i, 1] = sums[column][..., ~has].sum(-1), sums[column][..., has].sum(-1)
        elif column >= 0:
            out[:, :, i] = sums[column]
    return out


# Growing a tree on the driver, which sees sums only


class Node:
    """A node with its sums by class; the histograms are dropped when its children have theirs."""

    def __init__(self, rows, residuals, squares, whole):
        self.rows, self.residuals = rows, residuals  # [class, input, bin]
        self.squares, self.whole = squares, whole  # [class]; [class, (rows, residuals)]
        self.split: tuple[int, int] | None = None  # input, last bin on the left
        self.gain = 0.0
        self.children: list[Node] = []

    def stats(self, weights: np.ndarray) -> tuple[float, float, float]:
        """Weight, and weighted sums of the residuals and their squares."""
        return (*map(float, weights @ self.whole), float(weights @ self.squares))

    def rest(self, other: Node) -> Node:
        """What is left of this node without one child."""
        rows = self.rows - other.rows
        residuals = np.where(rows > 0, self.residuals - other.residuals, 0.0)
        whole = self.whole - other.whole
        return Node(rows, residuals, np.maximum(self.squares - other.squares, 0.0), whole)


def _variance(weight: float, total: float, squares: float) -> float:
    return (squares - total * total / weight) / weight


def _choose(nodes: Sequence[Node], layout: Layout, weights: np.ndarray) -> None:
    """Gives each node its best split, if one is better than none."""
    if not nodes:
        return
    n = np.cumsum(np.stack([x.rows for x in nodes]), -1)  # [node, class, input, bin]
    total = np.cumsum(np.stack([x.residuals for x in nodes]), -1)
    left_n, left_w = n.sum(1), np.tensordot(weights, n, (0, 1))
    left_g = np.tensordot(weights, total, (0, 1))
    stats = np.array([x.stats(weights) for x in nodes])
    all_n = np.array([x.whole[:, 0].sum() for x in nodes])[:, None, None]
    all_w, all_g = stats[:, 0, None, None], stats[:, 1, None, None]
    allowed = np.arange(MAX_BINS) < np.array([len(t) for t in layout.thresholds])[:, None]
    valid = allowed & (left_n > 0) & (left_n < all_n)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = (left_g**2 / left_w + (all_g - left_g) ** 2 / (all_w - left_w) - all_g**2 / all_w) / all_w
    by_node = np.where(valid, gain, -np.inf).reshape(len(nodes), -1)
    for node, gains, (weight, g, squares) in zip(nodes, by_node, stats):
        rounding = ROUNDING * squares / weight
        if gains.max(initial=-np.inf) <= rounding or abs(_variance(weight, g, squares)) < PURE:
            continue
        first = int(np.argmax(gains >= gains.max() - rounding))
        node.split, node.gain = divmod(first, MAX_BINS), float(gains[first])


class _Grower:
    """Grows one tree after the other; the rows stay in `state`."""

    def __init__(self, blocks: RDD, layout: Layout, weights: tuple[float, float], depth: int):
        self.layout, self.weights, self.depth = layout, weights, depth
        self.kept = self.state = blocks.persist(StorageLevel.MEMORY_AND_DISK)
        self.since: list[tuple[Tree, float]] = []  # trees after the kept blocks
        self.pending: list[tuple[Tree, float]] = []  # those that are not in the margins of the state

    def sums(self, levels, slots) -> Sums:
        work = partial(_add_up, self.layout, self.weights, self.depth, levels, slots, self.pending)
        parts = self.state.mapPartitions(work).collect()
        return Sums(*[sum(p[1:], start=p[0]) for p in zip(*parts)])

    def grow(self, root: Sums) -> tuple[Node, Tree, list[tuple[int, Node]]]:
        """A tree from the sums at its root; also its leaves by position in the last level."""
        layout, weights = self.layout, np.array(self.weights)
        top = Node(root.rows[0], root.residuals[0], root.squares[0], root.whole[0])
        levels, open_nodes, leaves = [], {0: top}, []
        for level in range(self.depth):
            _choose(list(open_nodes.values()), layout, weights)
            leaves += [(p << self.depth - level, node) for p, node in open_nodes.items() if not node.split]
            parents = {p: node for p, node in open_nodes.items() if node.split}
            if not parents:
                break
            levels.append([(p, layout.column[i], layout.bit[i], last) for p, (i, last) in ((p, node.split) for p, node in parents.items())])
            open_nodes = self._children(parents, levels, level + 1 < self.depth)
        leaves += [(p, node) for p, node in open_nodes.items()] if len(levels) == self.depth else []
        levels += [[] for _ in range(self.depth - len(levels))]
        values = np.zeros(1 << self.depth)
        for p, node in leaves:
            weight, total, _ = node.stats(weights)
            values[p] = total / weight
        return top, Tree(levels, values), leaves

    def _children(self, parents: dict[int, Node], levels, inner: bool) -> dict[int, Node]:
        """Both children of each parent: the one with fewer rows is added up, unless its leaves need no more than their sums."""
        smaller = {}
        for p, node in parents.items():
            i, last = node.split
            left = np.stack([x[:, i, : last + 1].sum(-1) for x in (node.rows, node.residuals)], -1)
            if not inner:
                node.children = [Node(None, None, np.zeros(2), whole) for whole in (left, node.whole - left)]
            else:
                smaller[p] = 2 * p + int(2 * left[:, 0].sum() > node.whole[:, 0].sum())
        if inner:
            found = self.sums(levels, list(smaller.values()))
            for k, (p, node) in enumerate(parents.items()):
                one = Node(found.rows[k], found.residuals[k], found.squares[k], found.whole[k])
                node.children = [one, node.rest(one)][:: -1 if smaller[p] % 2 else 1]
        for node in parents.values():
            node.rows = node.residuals = None
        return {2 * p + side: child for p, node in parents.items() for side, child in enumerate(node.children)}

    def advance(self, tree: Tree, weight: float) -> Sums:
        """Adds a tree to the margins of all rows, and gives the sums of the next root."""
        self.since, self.pending = [*self.since, (tree, weight)], [*self.pending, (tree, weight)]
        if len(self.pending) < STORED_EVERY:
            return self.sums([], [0])
        before, source, trees = self.state, self.state, self.pending
        if len(self.since) >= KEPT_EVERY:
            source, trees = self.kept, self.since
        self.state = source.map(partial(_advance, trees, self.depth, True)).persist(StorageLevel.MEMORY_AND_DISK)
        self.pending = []
        root = self.sums([], [0])
        if before is not self.kept:
            before.unpersist()
        if source is self.kept and len(self.since) >= KEPT_EVERY:
            self.kept.unpersist()
            self.kept, self.since = self.state, []
        return root

    def close(self) -> None:
        self.state.unpersist()
        self.kept.unpersist()


def boost(
    rows: DataFrame,
    inputs: Sequence[str],
    weights: tuple[float, float],
    trees: int,
    step: float,
    depth: int,
    held: str | None = None,
) -> tuple[list[Node], Layout]:
    """Trees over the rows with `is_fraud`; `weights` are those of a legitimate row and of a fraud.

    `held` marks validation rows: boosting ends when a tree lowers their loss by less than a hundredth, and the
    trees up to the least loss stay.
    """
    with_package(rows.sparkSession)
    layout = fit_layout(rows, inputs, weights, held)
    grower = _Grower(_blocks(rows, inputs, layout, held), layout, weights, depth)
    tops, best, least = [], 0, math.inf
    try:
        root = grower.sums([], [0])
        for m in range(trees):
            top, tree, leaves = grower.grow(root)
            root = grower.advance(tree, step if m else 1.0)
            for p, node in leaves:
                node.squares = root.leaf_squares[p]
            tops.append(top)
            if held:
                loss = float(root.held_loss[0] / root.held_loss[1])
                if m and least - loss < VALIDATION_TOL * max(loss, 0.01):
                    break
                if loss < least:
                    least, best = loss, m + 1
    finally:
        grower.close()
    return tops[:best] if held else tops, layout


# The fitted trees as a model of Spark ML


def _nodes(top: Node, layout: Layout, weights: np.ndarray) -> list[tuple]:
    """Nodes in the order and form in which Spark ML stores a tree; twin leaves of one value become one leaf."""
    out: list[tuple] = []

    def mean(node: Node) -> float:
        weight, total, _ = node.stats(weights)
        return total / weight

    def is_leaf(node: Node) -> bool:
        return not node.children or (all(map(is_leaf, node.children)) and len({mean(x) for x in node.children}) == 1)

    def add(node: Node) -> int:
        at, stats = len(out), node.stats(weights)
        out.append(())
        children, gain, split = [-1, -1], -1.0, (-1, [], -1)
        if not is_leaf(node):
            children, gain = [add(x) for x in node.children], node.gain
            split = (node.split[0], [float(layout.thresholds[node.split[0]][node.split[1]])], -1)
        impurity = max(_variance(*stats), 0.0)
        out[at] = (at, mean(node), impurity, list(stats), int(node.whole[:, 0].sum()), gain, *children, split)
        return at

    add(top)
    return out


_NODE = (
    "id int, prediction double, impurity double, impurityStats array<double>, rawCount bigint, gain double, "
    "leftChild int, rightChild int, split struct<featureIndex int, leftCategoriesOrThreshold array<double>, numCategories int>"
)


def as_model(
    spark: SparkSession, tops: Sequence[Node], layout: Layout, weights: tuple[float, float], step: float, params: dict
) -> GBTClassificationModel:
    """Spark ML reads the trees from the form in which it stores its models."""
    path, now = run_dir(spark, "boosted"), int(time.time() * 1000)

    def about(name: str, prefix: str, own: dict, **more) -> str:
        said = {"class": f"org.apache.spark.ml.{name}", "timestamp": now, "sparkVersion": spark.version}
        return json.dumps(said | {"uid": f"{prefix}_{uuid.uuid4().hex[:12]}", "paramMap": own, "defaultParamMap": {"impurity": "variance"}} | more)

    shared = {k: v for k, v in params.items() if k in ("maxDepth", "seed")}
    model = about("classification.GBTClassificationModel", "GBTClassifier", params, numFeatures=len(layout.thresholds), numTrees=len(tops))
    each = [(i, about("regression.DecisionTreeRegressionModel", "dtr", shared), step if i else 1.0) for i in range(len(tops))]
    nodes = [(i, node) for i, top in enumerate(tops) for node in _nodes(top, layout, np.array(weights))]
    spark.createDataFrame([(model,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    spark.createDataFrame(each, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    spark.createDataFrame(nodes, f"treeID int, nodeData struct<{_NODE}>").coalesce(1).write.parquet(f"{path}/data")
    return GBTClassificationModel.load(path)
