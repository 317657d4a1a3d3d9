from __future__ import annotations

import hashlib
import heapq
import itertools
import random
import re
import zlib

import pytest
import xxhash
from pyspark.sql import functions as F

from cardwatch.llm import turn_repair as tr

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def cheapest(rows):
    """Cheapest edits of (role, fault) rows by a search over all edit sequences; ties by the text of the edits."""
    heap = [(0, "", 0, "")]
    seen = set()
    while heap:
        cost, audit, at, roles = heapq.heappop(heap)
        if at == len(rows) and re.fullmatch("(s?(ua)+)?", roles):
            return cost, audit
        state = roles[-1:]
        if (at, state) in seen:
            continue
        seen.add((at, state))
        fits = lambda r: re.fullmatch("s?(ua)*u?", roles[:1] * (roles[:1] == "s") + {"": "", "s": "", "u": "u", "a": "ua"}[state] + r)  # noqa: E731, B023
        for r in "ua":
            if fits(r):
                heapq.heappush(heap, (cost + 3, audit + "I", at, roles + r))
        if at < len(rows):
            role, fault = rows[at]
            heapq.heappush(heap, (cost + 4, audit + "D", at + 1, roles))
            if fault in ("blank", "duplicate"):
                continue
            extra = 3 if fault else 0
            for r in "ua":
                if fits(r):
                    heapq.heappush(heap, (cost + 3 + extra, audit + "R", at + 1, roles + r))
            if role[:1] in ("s", "u", "a") and role[:1] and fits(role[0]):
                heapq.heappush(heap, (cost + extra, audit + "K", at + 1, roles + role[0]))


def spark_hash(*values):
    seed = 42
    for v in values:
        seed = xxhash.xxh64_intdigest(v.encode(), seed)
    return seed - (1 << 64) if seed >> 63 else seed


def brute(turns):
    out = {}
    for conv, turn, role, text in turns:
        rows = out.setdefault(conv, [])
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        rows += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    for conv, rows in out.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), spark_hash(*r[1:])))
        seen, faulty = set(), []
        for _, role, text in rows:
            solid = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else None
            seen.add((role, text))
            faulty.append((role, fault))
        known = [r[0] for r in rows if r[0] is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        n = [sum(f == x for _, f in faulty) for x in ("blank", "duplicate", "truncated")]
        illegal = sum((a[0][:1] + "|" + b[0][:1]) not in ("s|u", "u|a", "a|u") for a, b in itertools.pairwise(faulty))
        cost, audit = cheapest(faulty)
        left, at, state = [], 0, ""
        for edit in audit:
            role, text = ("", "") if edit == "I" else rows[at][1:]
            at += edit != "I"
            if edit == "D":
                continue
            role = role if edit == "K" else "assistant" if state == "u" else "user"
            state = role[0]
            left.append(f"{role}:{text}")
        out[conv] = (gaps, *n, illegal, cost, audit, hashlib.sha256("\n".join(left).encode()).hexdigest())
    return out


def results(df):
    rows = df.collect()
    got = {r[0]: tuple(r)[1:] for r in rows}
    assert len(got) == len(rows)
    return got


def test_given_conversations(spark):
    turns = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    want = brute([tuple(r) for r in turns.select("conv_id", "turn", "role", "text").collect()])
    assert results(tr.repair(turns)) == want
    assert len({w[6] for w in want.values()}) > 20


@pytest.mark.parametrize("chunk", [1, 3, 1024])
def test_random_conversations_in_chunks(spark, scattered, chunk):
    rng = random.Random(chunk)
    texts = ["Yes.", "No", "What now?", "", " \t", None, "Well!", "go on"]
    roles = ["user", "assistant", "system", "tool", "", None, "User"]
    rows = []
    for conv in [None, *range(40)]:
        for turn in range(rng.choice([1, 2, 5, 9, 30])):
            rows.append((conv, rng.choice([turn, turn, turn, None, 3]), rng.choice(roles[: rng.choice([2, 3, 7])]), rng.choice(texts) if rng.random() < 0.5 else f"t{rng.random()}."))
    rows += rng.sample(rows, 25)
    turns = spark.createDataFrame(rows, SCHEMA).repartition(5).withColumns({"word": F.lit(1), "cost": F.lit("x")})
    assert results(tr.repair(turns, chunk)) == brute(rows)


def test_lost_empty_and_long(spark):
    lost = next(c for c in range(10_000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows = [(lost, 0, "user", "Hello."), *((7, t, "user" if t % 2 else "assistant", "long " * 5_000 + f"{t}.") for t in range(60)), *((8, 1, "user", "Same.") for _ in range(3_000))]
    got = results(tr.repair(spark.createDataFrame(rows, SCHEMA), 16))
    assert got == brute(rows)
    assert got[lost] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert tr.repair(spark.createDataFrame([], SCHEMA)).collect() == []


def test_every_short_word():
    """Costs and edits of all words of four signatures, each shared end worked out once."""
    automaton = tr.Automaton()
    fault = {"x": "blank"}
    words = sorted(("".join(w) for n in range(1, 5) for w in itertools.product("suaoxSUAO", repeat=n)), key=lambda w: w[::-1])
    for word in words:
        rows = [(c.lower(), fault.get(c, "truncated" if c.isupper() else None)) for c in word]
        assert automaton.costs(word, True)[0][tr.START] == cheapest(rows), word
    assert automaton.nodes == len(words)
