"""Late labels: merged when the fact is read, in any order, over merges, replays and broken batches."""

import datetime
import os
import random
from pathlib import Path

import pytest

from cardwatch.operators.load import complete_labels
from cardwatch.session import run_dir
from cardwatch.streaming.labels import LABELS, LabelStore, start_labels
from cardwatch.streaming.store import FOLD

START = datetime.datetime(2024, 1, 1, tzinfo=datetime.UTC)


def batches_of(n, rows, seed):
    """Labels for known and unknown keys, some twice, some in conflict, some without key or verdict."""
    rng = random.Random(seed)
    key = lambda: rng.choice([None, "T0", *[f"T{rng.randrange(60)}" for _ in range(6)]])
    return [[(key(), rng.choice([True, False, False, None]), rng.choice([None, "card", "id"])) for _ in range(rows)] for _ in range(n)]


def facts(spark, keys):
    rows = [(k, True if k == "T7" else None, "own" if k == "T7" else None, i) for i, k in enumerate(keys)]
    return spark.createDataFrame(rows, "transaction_bk string, is_fraud boolean, fraud_type string, n int")


def plain(batches, keys):
    out = {}
    for k in keys:
        found = [(f, t or "") for b in batches for x, f, t in b if x == k and f is not None]
        out[k] = (True, "own") if k == "T7" else max(found, default=(None, None))
    return {k: (f, t or None) for k, (f, t) in out.items()}


def got(store, fact):
    return {r["transaction_bk"]: (r["is_fraud"], r["fraud_type"]) for r in store.complete(fact).collect()}


def files(folder):
    return {str(p): p.stat().st_mtime_ns for p in Path(folder).rglob("*.parquet")}


def test_merges_change_no_label_and_touch_no_fact(spark):
    root = run_dir(spark, "labels-test")
    local = root.removeprefix("file:")
    store = LabelStore(f"{root}/store")
    keys = [f"T{i}" for i in range(50)]
    facts(spark, keys).write.parquet(f"{root}/fact")
    before = files(f"{local}/fact")
    batches = batches_of(2 * FOLD + 3, 12, 5)
    for i, batch in enumerate(batches):
        store.add(spark.createDataFrame(batch, LABELS), i)
        if i % 5 == 0:
            store.add(spark.createDataFrame(batch, LABELS), i)  # runs again
        if i in (0, FOLD, 2 * FOLD + 2):
            assert got(store, spark.read.parquet(f"{root}/fact")) == plain(batches[: i + 1], keys)
    assert store.live(spark) == [(0, FOLD - 1, 1), (FOLD, 2 * FOLD - 1, 1), *[(b, b, 0) for b in range(2 * FOLD, 2 * FOLD + 3)]]
    assert before and files(f"{local}/fact") == before
    # the folders of the first merge went with the second one
    assert sorted(n for n in os.listdir(f"{local}/store/labels") if n.endswith("-0") and int(n.split("-")[0]) < FOLD) == []


def test_a_batch_touches_its_own_folder_only(spark):
    root = run_dir(spark, "labels-test")
    store = LabelStore(f"{root}/store")
    local = root.removeprefix("file:")
    for i in range(3):
        store.add(spark.createDataFrame([(f"T{i}", True, "card")], LABELS), i)
    before = files(local)
    store.add(spark.createDataFrame([("T0", False, None)], LABELS), 3)
    after = files(local)
    assert {k: after[k] for k in before} == before
    assert all("/3-3-0/" in k for k in after.keys() - before.keys())


def test_label_before_its_transaction_and_broken_batch(spark, monkeypatch):
    store = LabelStore(f"{run_dir(spark, 'labels-test')}/store")
    assert got(store, facts(spark, ["T1"])) == {"T1": (None, None)}
    store.add(spark.createDataFrame([("T1", True, "card")], LABELS), 0)
    assert got(store, facts(spark, [])) == {}
    assert got(store, facts(spark, ["T1", "T2"])) == {"T1": (True, "card"), "T2": (None, None)}
    with monkeypatch.context() as m, pytest.raises(RuntimeError):
        m.setattr("cardwatch.streaming.store.touch", lambda *_: (_ for _ in ()).throw(RuntimeError("broken")))
        store.add(spark.createDataFrame([("T2", True, "card")], LABELS), 1)
    assert got(store, facts(spark, ["T2"])) == {"T2": (None, None)}
    store.add(spark.createDataFrame([("T2", False, None)], LABELS), 1)
    assert got(store, facts(spark, ["T2"])) == {"T2": (False, None)}


def test_from_a_stream(spark):
    root = run_dir(spark, "labels-test")
    store = LabelStore(f"{root}/store")
    batches = batches_of(FOLD + 2, 6, 9)
    for i, batch in enumerate(batches):
        spark.createDataFrame(batch, LABELS).coalesce(1).write.parquet(f"{root}/in/{i}")
    stream = spark.readStream.schema(LABELS).option("maxFilesPerTrigger", 1).parquet(f"{root}/in/*")
    start_labels(stream, store, f"{root}/cp", available_now=True).awaitTermination()
    keys = [f"T{i}" for i in range(60)]
    assert got(store, facts(spark, keys)) == plain(batches, keys)
    same = complete_labels(facts(spark, keys), spark.createDataFrame([r for b in batches for r in b if r[1] is not None], LABELS))
    assert {r[0]: (r[1], r[2]) for r in same.select("transaction_bk", "is_fraud", "fraud_type").collect()} == plain(batches, keys)
    assert any(level == 1 for *_, level in store.live(spark))
