from __future__ import annotations

import re
from collections import defaultdict
from functools import lru_cache

from pyspark.sql import functions as F

from cardwatch.llm import sentence_dedup as sd

WORD = re.compile(r"[^\x20\x09-\x0d]+")


@lru_cache(maxsize=None)
def marked(word):
    raw = sd.np.frombuffer(word.encode(), sd.np.uint8)
    return int(sd.textnum.RangeHash(raw)(sd.np.array([0]), sd.np.array([len(raw)]))[0]) % sd.CUT_EVERY == 0


def cut(text, long_words=sd.LONG_WORDS):
    """Sentences as (words, first character) by a plain loop."""
    whole, now, last = [], [], 0
    for m in WORD.finditer(text or ""):
        if now and ("\n" in text[last : m.start()] or re.search(r"[.!?][\"')\]]?$", now[-1][0])):
            whole.append(now)
            now = []
        now.append((re.sub("[A-Z]", lambda x: x[0].lower(), m[0]), m.start()))
        last = m.end()
    out = []
    for s in [*whole, now] if now else whole:
        piece, since = [], 0
        for word, begin in s:
            piece.append((word, begin))
            since = 0 if marked(word) else since + 1
            if len(s) > long_words and (since == 0 or since >= sd.PIECE_WORDS):
                out.append(piece)
                piece = []
        if piece:
            out.append(piece)
    return [([w for w, _ in p], p[0][1]) for p in out]


def brute(rows):
    rows = sorted({(i, t) for i, t in rows}, key=lambda r: (r[0] is not None, r[0] or 0))
    cuts = {r: cut(r[1]) for r in rows}
    runs, gone, place = defaultdict(set), defaultdict(set), {r: n for n, r in enumerate(rows)}
    for r in rows:
        s = [w for w, _ in cuts[r]]
        size = lambda a, b: sum(map(len, s[a : b + 1]))  # noqa: E731, B023
        for k in range(len(s)):
            end = next((e for e in range(k + 2, len(s)) if size(k, e) >= sd.SPAN_WORDS), None)
            begin = next((b for b in range(k - 2, -1, -1) if size(b, k) >= sd.SPAN_WORDS), None)
            for a, b in [(k, end)] * (end is not None) + [(begin, k)] * (begin is not None):
                runs[tuple(w for x in s[a : b + 1] for w in x)].add((place[r], a, b))
    for found in runs.values():
        first = min(found)[:2]
        for r, a, b in found:
            if (r, a) != first:
                gone[rows[r]] |= set(range(a, b + 1))
    out = {}
    for r in rows:
        text, s = r[1], cuts[r]
        if text is None:
            out[r] = (None, 0, 0)
            continue
        stops = [b for _, b in s[1:]] + [len(text)]
        left = text[: s[0][1]] if s else text
        for k, (_, b) in enumerate(s):
            left += "" if k in gone[r] else text[b : stops[k]]
        out[r] = (left, len(s), len(gone[r]))
    return out


def test_matches_a_plain_loop(corpus, texts):
    # a part of the documents, as the loop is slow: those with copies and repeats among them
    texts = {i: t for i, t in texts.items() if len(t) < 3000}
    want = brute(texts.items())
    got = sd.dedup(corpus.where(F.length("text") < 3000)).collect()
    assert len(got) == len(texts) > 100
    for r in got:
        assert (r["text"], r["n_sentences"], r["n_removed"]) == want[r["doc_id"], texts[r["doc_id"]]]
    assert sum(r["n_removed"] for r in got) > 0


def test_edge_cases(frame):
    passage = " ".join(f"One{k} two three four five six seven eight nine ten eleven{k}{end}" for k, end in enumerate(".!?"))
    singles = " ".join(f"w{k}!" for k in range(24))
    rows = [
        (1, "Start here. " + passage + "\nEnd here."),
        (2, "  Other start. " + passage.upper() + " Other end."),
        (2, "  Other start. " + passage.upper() + " Other end."),
        (3, None),
        (None, passage),
        (4, ""),
        (5, " \n "),
        (6, "Ho. Ho. Ho. Ho. Ho. Ho."),
        (8, f"Odd one out here.\n{singles} Long sentence to end it all now. K! L!\nUnlike the rest."),
        (9, f"{singles} Long sentence to end it all now. K! L!"),
        (10, "Short before. One two three. Four five six. Seven eight nine. Short behind."),
        (11, "Other before. One two three. Four five six. Seven eight nine. Other behind."),
        (7, ("é日 " * 4_000).strip()),
    ]
    got = sd.dedup(frame(rows, n_removed=F.lit("clash"), places=F.lit(1))).collect()
    want = brute([(r[0], r[1]) for r in rows])
    assert len(got) == len(rows)
    assert sum(r["doc_id"] == 2 for r in got) == 2
    before = {(r[0], (r[1] or "")[:8]): r[1] for r in rows}
    for r in got:
        key = next(k for k in want if k[0] == r["doc_id"])
        assert (r["text"], r["n_sentences"], r["n_removed"]) == want[key], before
        assert r["places"] == 1
    assert {r["doc_id"]: r["n_removed"] for r in got if r["doc_id"] in (1, 2, None)} == {1: 3, 2: 3, None: 0}
    assert {r["doc_id"]: r["n_removed"] for r in got if r["doc_id"] in (8, 9, 10, 11)} == {8: 0, 9: 27, 10: 0, 11: 0}
    assert sd.dedup(frame([])).collect() == []


def test_passages_at_different_offsets_in_long_sentences(frame):
    rows = []
    for k in range(24):
        passage = [f"p{k}x{j}" for j in range(51 + k)]
        for copy, before in enumerate((3 + k % 5, 20 + k)):
            lead, tail = ([f"{side}{k}y{copy}z{j}" for j in range(n)] for side, n in (("a", before), ("b", 9 + copy)))
            rows.append((2 * k + copy, " ".join([*lead, *passage, *tail])))
    got = {r["doc_id"]: r["text"].split() for r in sd.dedup(frame(rows)).collect()}
    for k in range(24):
        assert got[2 * k] == rows[2 * k][1].split()
        left = got[2 * k + 1]
        assert sum(w.startswith(f"p{k}x") for w in left) < (51 + k) / 2
        assert [w for w in left if not w.startswith("p")] == [w for w in rows[2 * k + 1][1].split() if not w.startswith("p")]


def test_words_without_a_cut_are_cut_alike():
    words = [w for w in (f"q{i}" for i in range(400)) if int(sd.textnum.RangeHash(sd.np.frombuffer(w.encode(), sd.np.uint8))(sd.np.array([0]), sd.np.array([len(w)]))[0]) % sd.CUT_EVERY][:60]
    for lead in ([], ["lead"] * 5, ["other"] * 11):
        text = " ".join([*lead, *words]).encode()
        s = sd.Sentences(sd.np.frombuffer(text, sd.np.uint8), sd.np.array([0, len(text)]))
        assert set(range(len(lead) + sd.PIECE_WORDS, len(lead) + 60)) <= set(s.first.tolist())
