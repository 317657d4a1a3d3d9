"""Ordered work over several ranges and chunks gives what one big window would give."""

import datetime
import random

import numpy as np
from pyspark.sql import functions as F

from cardwatch.functions.spread import exact_quantiles, running_totals, time_chunks
from cardwatch.operators import windows

START = datetime.datetime(2024, 1, 1)


def test_running_totals_cross_ranges(scattered):
    rng = random.Random(1)
    rows = [(f"g{i % 3}", i // 3, rng.randint(1, 9)) for i in range(600)]
    rng.shuffle(rows)
    df = scattered.createDataFrame(rows, "g string, x int, n long")
    got = running_totals(df, ["x"], ["n"], by=["g"], next_of="x").collect()
    assert len(got) == 600
    for g in ("g0", "g1", "g2"):
        want, total = {}, 0
        mine = sorted(r[1:] for r in rows if r[0] == g)
        for x, n in mine:
            total += n
            want[x] = total
        assert {r["x"]: r["run_n"] for r in got if r["g"] == g} == want
        following = dict(zip([x for x, _ in mine], [x for x, _ in mine[1:]] + [None]))
        assert {r["x"]: r["next_x"] for r in got if r["g"] == g} == following


def test_running_totals_descending(scattered):
    df = scattered.range(1000).select(F.col("id").alias("x"), F.lit(1).alias("n"))
    got = {r["x"]: r["run_n"] for r in running_totals(df, [F.desc("x")], ["n"]).collect()}
    assert got == {x: 1000 - x for x in range(1000)}


def test_exact_quantiles_interpolate(scattered):
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.normal(size=500), np.repeat(0.25, 400)])
    df = scattered.createDataFrame([(float(v), i % 2) for i, v in enumerate(values)], "v double, c int")
    probs = [0.0, 0.1, 0.25, 0.5, 0.99, 1.0]
    row = exact_quantiles(df, "v", probs).first()
    assert np.allclose(row, np.quantile(values, probs))
    for r in exact_quantiles(df, "v", probs, by=["c"]).collect():
        mine = values[np.arange(len(values)) % 2 == r["c"]]
        assert np.allclose(r[1:], np.quantile(mine, probs))


def test_exact_quantiles_of_bracketed_rows(scattered):
    rng = np.random.default_rng(6)
    values = np.concatenate([rng.exponential(size=60_000), np.repeat(0.7, 30_000)])
    df = scattered.createDataFrame([(float(v), i % 3) for i, v in enumerate(values)], "v double, c int").persist()
    probs = [0.001, 0.25, 0.5, 0.62, 0.99, 1.0]
    for accuracy in (100, 1000, 10_000):
        assert np.allclose(exact_quantiles(df, "v", probs, accuracy=accuracy).first(), np.quantile(values, probs))
    for r in exact_quantiles(df, "v", probs, by=["c"], accuracy=200).collect():
        assert np.allclose(r[1:], np.quantile(values[np.arange(len(values)) % 3 == r["c"]], probs))


def hot_rows(spark, n=900, seed=5):
    """A third of the rows belongs to one client, with bursts, ties and pauses."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        client = "hot" if i % 3 == 0 else f"c{rng.randint(0, 40)}"
        at = START + datetime.timedelta(minutes=rng.choice([rng.randint(0, 9000), rng.randint(300, 420)]))
        rows.append((f"t{i:05d}", client, at, rng.randint(-500, 5000) / 100, "ab"[i % 2], 1.0))
    return spark.createDataFrame(
        rows, "transaction_bk string, client_id string, event_ts timestamp, amount double, channel string, hour double"
    )


def test_time_chunks_cut_only_heavy_keys(scattered):
    rows = hot_rows(scattered)
    cut = time_chunks(rows, "client_id", "event_ts", max_rows=60)
    assert cut.count() == 900
    sizes = {(r[0], r[1]): r[2] for r in cut.groupBy("client_id", "_chunk").count().collect()}
    hot = sorted(c for k, c in sizes if k == "hot")
    assert hot == list(range(1, len(hot) + 1)) and len(hot) >= 4
    assert all(c == 0 for k, c in sizes if k != "hot")
    ranges = cut.where("client_id = 'hot'").groupBy("_chunk").agg(F.min("event_ts"), F.max("event_ts"))
    ordered = sorted(tuple(r) for r in ranges.collect())
    assert all(a[2] < b[1] for a, b in zip(ordered, ordered[1:]))
    assert time_chunks(rows, "client_id", "event_ts", max_rows=10_000).where("_chunk > 0").isEmpty()


def same(a, b):
    def rows(df):
        return sorted(map(repr, df.select(*sorted(df.columns)).collect()))

    return rows(a) == rows(b)


def test_sequences_of_a_hot_client(scattered):
    rows = hot_rows(scattered)
    fields = ("amount", "channel")
    whole = windows.sequences(rows, fields=fields)
    assert whole.where("client_id = 'hot'").count() == 300 - 4
    for limit in (1, 7, 60):
        assert same(windows.sequences(rows, fields=fields, max_rows=limit), whole)


def test_sequences_count_identity(spark):
    rows = hot_rows(spark)
    sizes = rows.groupBy("client_id").count().agg(F.sum(F.greatest(F.col("count") - 4, F.lit(0)))).first()[0]
    assert windows.sequences(rows, fields=("amount",)).count() == sizes


def test_session_counters_of_a_hot_client(scattered):
    rows = hot_rows(scattered)
    for gap in (60, 900, 3600):
        whole = windows.session_counters(rows, gap_s=gap)
        for limit in (1, 7, 60):
            assert same(windows.session_counters(rows, gap_s=gap, max_rows=limit), whole)


def test_session_counters_by_hand(spark):
    at = lambda s: START + datetime.timedelta(seconds=s)
    rows = [("a", "c", at(0), 1.0), ("b", "c", at(3599), 2.0), ("d", "c", at(3599 + 3600), 4.0), ("e", "c", at(8000), 8.0)]
    df = spark.createDataFrame(rows, "transaction_bk string, client_id string, event_ts timestamp, amount double")
    got = {r["transaction_bk"]: (r["n_session"], r["amount_session"]) for r in windows.session_counters(df).collect()}
    assert got == {"a": (1, 1.0), "b": (2, 3.0), "d": (1, 4.0), "e": (2, 12.0)}


def test_trailing_counters_against_brute_force(scattered):
    rows = hot_rows(scattered)
    local = [(r["transaction_bk"], r["client_id"], r["event_ts"], r["amount"]) for r in rows.collect()]
    span = datetime.timedelta(seconds=3600)
    want = {}
    for bk, client, at, _ in local:
        inside = [x[3] for x in local if x[1] == client and at - span < x[2] <= at]
        want[bk] = (len(inside), round(sum(inside), 2))
    for limit in (5, 60, 10_000):
        got = windows.trailing_counters(rows, max_rows=limit).collect()
        assert {r["transaction_bk"]: (r["n_trailing"], round(r["amount_trailing"], 2)) for r in got} == want


def test_positional_split_with_ties(scattered):
    rows = scattered.range(1000).select(
        F.format_string("t%05d", "id").alias("transaction_bk"),
        # Most rows share one hour and many share one instant.
        F.timestamp_seconds(F.lit(1704067200) + F.when(F.col("id") < 700, F.col("id") % 5).otherwise(F.col("id") * 60)).alias("event_ts"),
    )
    split = windows.split_positional(rows, 0.6)
    got = {r["transaction_bk"] for r in split.where("split = 'train'").collect()}
    order = sorted(rows.collect(), key=lambda r: (r["event_ts"], r["transaction_bk"]))
    assert got == {r["transaction_bk"] for r in order[:600]}
    assert windows.split_positional(rows, 1.0).where("split = 'test'").isEmpty()
