"""Repair of conversations by a suffix-shared automaton.

Every row of a conversation has a signature: whether its role starts with s, u, a or anything else, and whether it
must go (blank, duplicate) or is truncated. A conversation is the word of its rows' signatures. What its rows from
some place on cost at least, and the edits that cost so much, depend on the rest of the word and on the state of
the grammar `(s?(ua)+)?` alone. So the words of all conversations are put into one automaton that shares their
ends: words are sorted from behind, each end that they share is one node, and each node gets its cost-to-go and its
best edits once for each state, from the node behind it. Ranges of that order are dealt to tasks, which hold
the path of the word at hand and nothing else.

The rows are dealt by ranges of (conversation, turn), so a conversation with very many rows lies in several
ranges and is cut into chunks of at most `CHUNK` rows. A chunk that is not the last of its conversation is solved
for each state that it may end in, and the chunks of a conversation are put together from its end. Duplicates
are found by an aggregation over hashes (128 bits) of role and text. Texts are shuffled once, at the end, where the
repaired rows are hashed in order; that hash needs one pass over a conversation's rows by definition, and holds none.

Defined results: a null role or text reads as one space, so does a null id or turn in the key of the damage. A null
conv_id is a conversation; null turns come first. Rows of equal turn are put in the order of role and of a
hash of role and text. Only s, u and a as first letters are roles that may stay. Repeated rows are rows of their own.
A conversation that loses all its rows has zeros, an empty audit and the hash of nothing. An empty table gives an
empty one. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardwatch.llm.common import save
from cardwatch.session import with_package

#: Rows of a conversation that are solved as one word.
CHUNK = 1024
# Costs of edits.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
# States of the grammar: nothing yet, after s, after u, after a. What each letter leads to.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
MOVES = {"s": {START: AFTER_S}, "u": {START: AFTER_U, AFTER_S: AFTER_U, AFTER_A: AFTER_U}, "a": {AFTER_U: AFTER_A}}
#: What a new or changed row becomes in each state.
NEEDED = {START: "u", AFTER_S: "u", AFTER_U: "a", AFTER_A: "u"}
NAMES = {"u": "user", "a": "assistant"}
_SPACE = " \t\n\x0b\f\r"

#: For each state the least (cost, edits), or None.
Costs = list[tuple[int, str] | None]


def damage(turns: DataFrame) -> DataFrame:
    """The rows after damage: conv, turn, role, text, and a number of the row."""
    conv, turn = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn"))
    kind = F.crc32(F.concat(conv, F.lit(":"), turn)) % 20
    rows = turns.select(
        conv.alias("conv"), F.col("turn").cast("bigint").alias("turn"), kind.alias("kind"), *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")], F.monotonically_increasing_id().alias("row")
    ).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv", "turn", role.alias("role"), text.alias("text"), "row", F.explode(times).alias("copy"))


def signed(damaged: DataFrame) -> DataFrame:
    """Without texts: conv, turn, role, h, row, copy, the role's letter, and the fault of each row."""
    bare = F.rtrim("text", F.lit(_SPACE))
    kind = F.when(bare == "", "blank").when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), "truncated")
    h = F.xxhash64("role", "text")
    first = F.substring("role", 1, 1)
    rows = damaged.select("conv", "turn", "role", h.alias("h"), F.xxhash64(F.lit(1), "role", "text").alias("h2"), "row", "copy", F.when(first.isin("s", "u", "a"), first).otherwise("o").alias("letter"), kind.alias("fault"))
    order = F.struct(F.col("turn").isNotNull(), "turn", "role", "h", "row", "copy")
    again = rows.where("fault IS DISTINCT FROM 'blank'").groupBy("conv", "h", "h2").agg(F.min(order).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    # adaptive execution splits the rows of a text that is repeated very often
    marked = rows.join(again, ["conv", "h", "h2"], "left")
    fault = F.when((F.col("fault").isNull() | (F.col("fault") == "truncated")) & (order > F.col("first")), "duplicate").otherwise(F.col("fault"))
    return marked.select("conv", "turn", "role", "h", "row", "copy", "letter", fault.alias("fault"))


def chunks(rows: DataFrame, chunk: int) -> DataFrame:
    """A row for each chunk of each conversation: its word, its counts and what its ends need to be put together."""
    symbol = F.when(F.col("fault").isin("blank", "duplicate"), "x").when(F.col("fault") == "truncated", F.upper("letter")).otherwise(F.col("letter"))
    order = ["conv", F.col("turn").asc_nulls_first(), "role", "h", "row", "copy"]
    dealt = rows.select("conv", "turn", "role", "h", "row", "copy", "letter", "fault", symbol.alias("symbol")).repartitionByRange(*order).sortWithinPartitions(*order)
    counts = ("blank", "duplicate", "truncated")

    def closed(part: int, number: int, conv: str, held: list[tuple]) -> list:
        turns, letters, faults, symbols = zip(*held, strict=True)
        known = [t for t in turns if t is not None]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(letters, letters[1:], strict=False))
        new = sum(a != b for a, b in zip(known, known[1:], strict=False)) + bool(known)
        ends = [known[0], known[-1]] if known else [None, None]
        return [conv, part, number, "".join(symbols), *(faults.count(c) for c in counts), illegal, new, *ends, letters[0], letters[-1]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number, conv, held, out = TaskContext.get().partitionId(), 0, None, [], []
        for batch in batches:
            for c, *row in zip(*(batch.column(k).to_pylist() for k in ("conv", "turn", "letter", "fault", "symbol")), strict=True):
                if held and (c != conv or len(held) == chunk):
                    out.append(closed(part, number, conv, held))
                    number, held = number + 1, []
                conv = c
                held.append(row)
            if out:
                yield _batch(out, _CHUNKS)
                out = []
        if held:
            yield _batch([closed(part, number, conv, held)], _CHUNKS)

    with_package(rows.sparkSession)
    return save(dealt.mapInArrow(run, _CHUNKS), "chunks")


_CHUNKS = "conv string, part int, number int, word string, blank bigint, duplicate bigint, truncated bigint, illegal bigint, turns bigint, first_turn bigint, last_turn bigint, first_letter string, last_letter string"
_SOLVED = "word string, last boolean, costs array<bigint>, edits array<string>"
_AUDITS = "conv string, cost bigint, audit string"
_KINDS = {
    "string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "boolean": pa.bool_(), "array<bigint>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string()),
}


def _batch(rows: list[list], like: str) -> pa.RecordBatch:
    fields = [f.split() for f in like.split(", ")]
    columns = zip(*rows, strict=True) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(list(c), _KINDS[kind]) for c, (_, kind) in zip(columns, fields, strict=True)], [name for name, _ in fields])


def _least(found: list[tuple[int, str]]) -> tuple[int, str] | None:
    return min(found, default=None)


def with_inserts(costs: Costs) -> Costs:
    """Rows may be inserted before what the costs are for. Three in a row would end where one does."""
    out: Costs = []
    for state in range(4):
        found, at, cost, edits = [], state, 0, ""
        for _ in range(3):
            if costs[at]:
                found.append((cost + costs[at][0], edits + costs[at][1]))
            at, cost, edits = MOVES[NEEDED[at]][at], cost + INSERT, edits + "I"
        out.append(_least(found))
    return out


def before_row(symbol: str, behind: Costs) -> Costs:
    """The costs before a row and the inserts in front of it, from those behind the row."""
    extra = TRUNCATED if symbol.isupper() else 0
    letter = symbol.lower()
    out: Costs = []
    for state in range(4):
        ways = [(DELETE, "D", state)]
        if letter != "x":
            ways.append((REROLE + extra, "R", MOVES[NEEDED[state]][state]))
            if state in MOVES.get(letter, {}):
                ways.append((extra, "K", MOVES[letter][state]))
        out.append(_least([(cost + behind[to][0], edit + behind[to][1]) for cost, edit, to in ways if behind[to]]))
    return with_inserts(out)


#: Behind a conversation, and behind a chunk that has to end in each of the states.
END = with_inserts([(0, ""), None, None, (0, "")])
OPEN_ENDS: list[Costs] = [[(0, "") if state == end else None for state in range(4)] for end in range(4)]


class Automaton:
    """Nodes of the words' shared ends, as long as words come in the order of their reverses.

    Of that order the path of the word at hand is all that later words can share. A node has the costs of each
    state, and for words without their end those for each state behind them.
    """

    def __init__(self):
        self.path: list[tuple[str, list[Costs]]] = []
        self.last: bool | None = None
        self.nodes = 0

    def costs(self, word: str, last: bool) -> list[Costs]:
        if last != self.last:
            self.last, self.path = last, []
        shared = 0
        while shared < min(len(word), len(self.path)) and self.path[shared][0] == word[-1 - shared]:
            shared += 1
        del self.path[shared:]
        ends = [END] if last else OPEN_ENDS
        for symbol in reversed(word[: len(word) - shared]):
            behind = self.path[-1][1] if self.path else ends
            self.path.append((symbol, [before_row(symbol, costs) for costs in behind]))
            self.nodes += 1
        return self.path[-1][1]


def solve(words: DataFrame) -> DataFrame:
    """Costs and edits of each word (word, last): the states in front of it, for each state behind it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton()
        for batch in batches:
            out = []
            for word, last in zip(batch.column("word").to_pylist(), batch.column("last").to_pylist(), strict=True):
                flat = [c for costs in automaton.costs(word, last) for c in costs]
                out.append([word, last, [c and c[0] for c in flat], [c and c[1] for c in flat]])
            yield _batch(out, _SOLVED)

    with_package(words.sparkSession)
    order = ["last", F.reverse("word")]
    return words.distinct().repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, _SOLVED)


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cost and audit of each conversation, from its chunks with the last one first."""
    conv, costs = None, END
    for batch in batches:
        out = []
        for c, now, edits in zip(*(batch.column(k).to_pylist() for k in ("conv", "costs", "edits")), strict=True):
            if conv is not None and c != conv:
                out.append([conv, *costs[START]])
            if c != conv:
                conv, costs = c, [(0, "")]
            table = [x if x[0] is not None else None for x in zip(now, edits, strict=True)]
            costs = [
                _least([(t[0] + behind[0], t[1] + behind[1]) for end, behind in enumerate(costs) if behind and (t := table[4 * end + state])])
                for state in range(4)
            ]
        yield _batch(out, _AUDITS)
    if conv is not None:
        yield _batch([[conv, *costs[START]]], _AUDITS)


def repaired(rows: list[tuple[str, str]] | Iterator[tuple[str, str]], audit: str) -> Iterator[str]:
    """The rows (role, text) after the edits, as `role:text`; takes a row when an edit needs it."""
    state, rows = START, iter(rows)
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(rows)
        if edit == "D":
            continue
        letter = role[0] if edit == "K" else NEEDED[state]
        state = MOVES[letter][state]
        yield f"{role if edit == 'K' else NAMES[letter]}:{text}"


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of the repaired rows of each conversation; its audit comes first, then its rows in order."""

    def stream() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(batch.column(k).to_pylist() for k in ("conv", "audit", "role", "text")), strict=True)

    rows, out = stream(), []
    ahead = next(rows, None)
    while ahead:
        conv, audit = ahead[:2]

        def own(conv: str = conv) -> Iterator[tuple[str, str]]:
            nonlocal ahead
            while (ahead := next(rows, None)) and ahead[0] == conv:
                yield ahead[2:]

        turns = own()
        digest, joint = hashlib.sha256(), b""
        for line in repaired(turns, audit):
            digest.update(joint + line.encode())
            joint = b"\n"
        for _ in turns:
            pass
        out.append([conv, digest.hexdigest()])
        if len(out) == 1000 or not ahead:
            yield _batch(out, "conv string, repaired_sha256 string")
            out = []


def repair(turns: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256 of each conversation."""
    damaged = damage(turns)
    parts = chunks(signed(damaged), chunk)
    by = Window.partitionBy("conv").orderBy("part", "number")
    ahead = F.lead("conv").over(by)
    parts = parts.select("*", ahead.isNull().alias("last"), F.lag("last_letter").over(by).alias("letter_before"), F.last("last_turn", True).over(by.rowsBetween(Window.unboundedPreceding, -1)).alias("turn_before"))
    parts = save(parts, "linked-chunks")
    broken = F.when(F.concat("letter_before", "first_letter").isin("su", "ua", "au"), 0).otherwise(F.when(F.col("letter_before").isNotNull(), 1).otherwise(0))
    same = F.when(F.col("turn_before") == F.col("first_turn"), 1).otherwise(0)
    counts = parts.groupBy("conv").agg(
        (F.max("last_turn") - F.min("first_turn") + 1 - F.sum(F.col("turns") - same)).alias("gaps"),
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")],
        F.sum(F.col("illegal") + broken).alias("illegal"),
    )
    solved = solve(parts.select("word", "last"))
    order = ["conv", F.col("part").desc(), F.col("number").desc()]
    joined = parts.join(solved, ["word", "last"]).select("conv", "part", "number", "costs", "edits")
    audits = save(joined.repartition("conv").sortWithinPartitions(*order).mapInArrow(_fold, _AUDITS), "audits")
    heads = audits.select("conv", F.lit(0).alias("kind"), "audit", *[F.lit(None).cast(t).alias(c) for c, t in (("turn", "bigint"), ("role", "string"), ("text", "string"), ("h", "bigint"), ("row", "bigint"), ("copy", "int"))])
    rows = damaged.select("conv", F.lit(1).alias("kind"), F.lit(None).cast("string").alias("audit"), "turn", "role", "text", F.xxhash64("role", "text").alias("h"), "row", "copy")
    order = ["conv", "kind", F.col("turn").asc_nulls_first(), "role", "h", "row", "copy"]
    lines = heads.union(rows).repartition("conv").sortWithinPartitions(*order).select("conv", "audit", "role", "text")
    hashes = lines.mapInArrow(_hashes, "conv string, repaired_sha256 string")
    all_ = turns.select("conv_id", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")).alias("conv")).distinct()
    out = all_.join(counts, "conv", "left").join(audits, "conv", "left").join(hashes, "conv", "left")
    none = {"audit": "", "repaired_sha256": hashlib.sha256(b"").hexdigest()}
    return out.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        *[F.coalesce(c, F.lit(text)).alias(c) for c, text in none.items()],
    )
