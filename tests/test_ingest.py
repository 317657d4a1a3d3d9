"""Ingestion: validation reasons, idempotence, replay, counters and logs."""

import datetime
import json
import time

import pytest
from pyspark.sql import functions as F

from cardwatch import schema
from cardwatch.operators import audit, dimensions, load, quality, score
from cardwatch.plans import inputs
from cardwatch.session import run_dir
from cardwatch.sources import events, logs, tables
from cardwatch.sources.events import text_events
from cardwatch.streaming import ingest, store, validate

GOOD = {
    "transaction_bk": "TX-000000001", "client_id": "C1", "horodatage": "2024-01-05T10:20:30", "montant": 12.5,
    "canal": "puce", "mcc_code": "5411", "pays_transaction": "FR", "distance_domicile_km": 3, "authentification": "3ds",
}


def variant(**changes):
    return json.dumps({k: v for k, v in {**GOOD, **changes}.items() if v is not ...})


CASES = [
    (json.dumps(GOOD), None),
    (variant(extra=1), None),
    (variant(montant=7), None),
    (variant(horodatage="2024-01-05 10:20:30.25"), None),
    ('{"transaction_bk": ', "json_invalide"),
    ("", "json_invalide"),
    ("42", "champ_manquant: transaction_bk"),
    ("[1, 2]", "champ_manquant: transaction_bk"),
    ("null", "champ_manquant: transaction_bk"),
    (variant(canal=...), "champ_manquant: canal"),
    (variant(montant="12.5"), "type_invalide: montant"),
    (variant(montant=True), "type_invalide: montant"),
    (variant(montant=None), "type_invalide: montant"),
    (variant(client_id=5), "type_invalide: client_id"),
    (variant(client_id=5, canal=...), "type_invalide: client_id"),
    (variant(transaction_bk=..., montant="x"), "champ_manquant: transaction_bk"),
    (variant(horodatage="tomorrow"), "valeur_invalide: horodatage"),
    (variant(montant=1e15), "valeur_invalide: montant"),
    (variant(mcc_code="54111"), "valeur_invalide: mcc_code"),
]


def test_reason_of_every_message(spark):
    raw = spark.createDataFrame([(line,) for line, _ in CASES], "value string")
    got = {r["raw"]: r["reason"] for r in validate.judge_events(raw).collect()}
    assert got == dict(CASES)


def test_bytes_that_are_no_text(spark):
    raw = spark.createDataFrame([(bytearray(b'{"a": "\xff"}'),), (bytearray(json.dumps(GOOD).encode()),)], "value binary")
    valid, dead = validate.validate_events(raw)
    assert valid.count() == 1
    row = dead.first()
    assert json.loads(row["envelope"]) == {"raw": '{"a": "�"}', "erreur": "json_invalide"}


def test_dead_letter_topic(spark):
    names = [("transactions.raw", "transactions.dlq"), ("a.b.c", "a.b.dlq"), ("plain", "plain.dlq")]
    df = spark.createDataFrame(names, "t string, want string")
    assert df.where(events.dlq_topic(F.col("t")) != F.col("want")).isEmpty()


@pytest.fixture(scope="module")
def small_dims(spark):
    client = spark.createDataFrame([(1, "C1", "premium", 10.0), (2, "C2", "premium", 20.0)], "client_key int, client_id string, segment string, net_income double")
    time = dimensions.calendar(spark, "2024-01-05 00:00:00", "2024-01-05 23:00:00")
    channel = dimensions.channel_dimension(spark.createDataFrame([("puce", "5411")], "channel string, mcc_code string"))
    branch = spark.createDataFrame([(1, "b")], "branch_key int, name string")
    return dimensions.Dims(branch, client, time, channel)


def write_lines(spark, folder, lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(folder)


def test_streaming_job_once_and_replayed(spark, small_dims):
    root = run_dir(spark, "t")
    house = ingest.Warehouse(f"{root}/tables")
    first = [
        json.dumps(GOOD), json.dumps(GOOD), variant(transaction_bk="TX-2", client_id="nobody"), "junk",
        variant(transaction_bk="TX-3", horodatage="2024-02-01T00:00:00", canal="other"),
        variant(transaction_bk="TX-4", horodatage="2024-01-05T10:50:00", montant=1.25),
    ]
    second = [json.dumps(GOOD), variant(transaction_bk="TX-5", horodatage="2024-01-05T11:30:00", montant=2)]
    for i, lines in enumerate((first, second)):
        write_lines(spark, f"{root}/inbox/{i}", lines)
        stream = events.text_events(spark, f"{root}/inbox")
        ingest.start_ingestion(stream, small_dims, house, f"{root}/cp", available_now=True).awaitTermination()
    facts = {r["transaction_bk"]: r for r in house.facts(spark).collect()}
    assert set(facts) == {GOOD["transaction_bk"], "TX-3", "TX-4", "TX-5"}
    assert house.facts(spark).count() == 4
    assert (facts["TX-3"]["time_key"], facts["TX-3"]["channel_key"]) == (0, 0)
    assert facts["TX-4"]["time_key"] > 0 and facts["TX-4"]["is_fraud"] is None
    # Every message takes exactly one branch.
    sums = ingest.totals(house.run_log(spark)).first()
    assert tuple(sums) == (5, 1, 2) and sum(sums) == len(first) + len(second)
    counters = {r["client_id"]: (r["nb_tx_1h"], r["amount_1h"]) for r in house.counters(spark).collect()}
    # The late row of the first wave follows 27 days of silence; the second wave is older than that.
    assert counters["nobody"] == (1, 12.5)
    before = sorted(map(repr, house.facts(spark).drop("created_at").collect()))
    # A batch that failed after its writes runs again with the same number: nothing changes.
    raw = spark.createDataFrame([(x,) for x in second], "value string")
    ingest.ingest_batch(raw, 1, small_dims, house)
    assert sorted(map(repr, house.facts(spark).drop("created_at").collect())) == before
    assert tuple(ingest.totals(house.run_log(spark)).first()) == (5, 1, 2)
    # The client that was unknown appears: its row is still pending and can be loaded.
    known = small_dims._replace(
        client=small_dims.client.unionByName(spark.createDataFrame([(3, "nobody", "premium", 1.0)], small_dims.client.schema))
    )
    assert [r["transaction_bk"] for r in ingest.retry_pending(spark, known, house).collect()] == ["TX-2"]
    # The next batch finds it by itself, as its dimensions are read anew; a key of a batch load is a duplicate.
    stored = house.facts(spark).limit(1).withColumn("transaction_bk", F.lit("TX-8"))
    stored = stored.withColumns({"ingestion_mode": F.lit("batch"), "batch_id": F.lit(0)})
    stored.write.mode("append").partitionBy("ingestion_mode", "batch_id").parquet(house.path("facts"))
    third = [(variant(transaction_bk="TX-8"),), (variant(transaction_bk="TX-9"),)]
    ingest.ingest_batch(spark.createDataFrame(third, "value string"), 2, lambda: known, house)
    added = house.facts(spark).where("batch_id = 2").select("transaction_bk").collect()
    assert sorted(r[0] for r in added) == ["TX-2", "TX-9"]
    assert house.pending(spark, 2).isEmpty() and house.pending(spark, 1).count() == 1


def test_counters_continue_across_batches(spark):
    at = lambda m: datetime.datetime(2024, 1, 5) + datetime.timedelta(minutes=m)
    ddl = "transaction_bk string, client_id string, event_ts timestamp, amount decimal(12,2)"
    from decimal import Decimal as D

    one = spark.createDataFrame([("a", "x", at(0), D(1)), ("b", "x", at(30), D(2)), ("c", "y", at(0), D(4))], ddl)
    two = spark.createDataFrame([("d", "x", at(80), D(8)), ("e", "y", at(60), D(16)), ("f", "z", at(5), D(1))], ddl)
    none = spark.createDataFrame([], ingest.STATE)
    state = ingest.next_counters(one, none).withColumn("batch_id", F.lit(0).cast("long"))
    later = ingest.next_counters(two, state)
    got = {r["client_id"]: (r["nb_tx_1h"], r["amount_1h"]) for r in later.collect()}
    assert got == {"x": (3, 11.0), "y": (1, 16.0), "z": (1, 1.0)}


def test_error_in_a_batch_is_logged_and_raised(spark, small_dims):
    house = ingest.Warehouse(run_dir(spark, "t"))
    raw = spark.createDataFrame([(json.dumps(GOOD),)], "value string")
    broken = small_dims._replace(client=small_dims.client.withColumn("client_id", F.raise_error(F.lit("no clients")).cast("string")))
    with pytest.raises(Exception):
        ingest.ingest_batch(raw, 0, broken, house)
    assert [r["status"] for r in house.run_log(spark).collect()] == ["ERROR"]
    ingest.ingest_batch(raw, 0, small_dims, house)
    assert [r["status"] for r in house.run_log(spark).collect()] == ["OK"] and house.facts(spark).count() == 1


def test_keys_of_other_loads_are_duplicates(spark, small_dims):
    house = ingest.Warehouse(run_dir(spark, "t"))
    raw = spark.createDataFrame([(json.dumps(GOOD),), (variant(transaction_bk="TX-9"),)], "value string")
    known = spark.createDataFrame([(GOOD["transaction_bk"],)], "transaction_bk string")
    ingest.ingest_batch(raw, 0, small_dims, house, known)
    assert [r["transaction_bk"] for r in house.facts(spark).collect()] == ["TX-9"]
    assert tuple(ingest.totals(house.run_log(spark)).first()) == (1, 0, 1)


def test_summary_export(spark):
    one = spark.createDataFrame([(1, 2.5)], "a int, b double")
    path = run_dir(spark, "t")
    logs.export_json(logs.summary({"x": one, "y": one.select("a")}), path)
    got = {(r["section"], r["key"], r["value"]) for r in spark.read.json(path).collect()}
    assert got == {("x", "a", "1"), ("x", "b", "2.5"), ("y", "a", "1")}


def test_loading_twice_inserts_nothing(spark, src):
    staging, dims = inputs.staging(spark, src), inputs.dims(spark, src)
    first = load.load_facts(staging, dims, mode="batch").facts.persist()
    again = load.load_facts(staging, dims, fact=first, mode="batch")
    assert first.count() > 0 and again.facts.isEmpty()
    assert again.rejects.count() == load.load_facts(staging, dims, mode="batch").rejects.count()


def test_stream_and_batch_agree(spark, src):
    """The same accepted rows through the batch function give the facts that the stream wrote."""
    house = inputs.ingested(spark, src)
    valid, _ = validate.validate_events(inputs.messages(spark, src))
    staged = load.stage_insert(valid.withColumn("ingested_at", F.current_timestamp()), None)
    batch = load.load_facts(staged, inputs.dims(spark, src), mode="stream").facts
    columns = ["transaction_bk", "client_key", "time_key", "channel_key", "amount", "event_ts"]
    stream = house.facts(spark).select(*columns)
    assert stream.exceptAll(batch.select(*columns)).isEmpty() and batch.select(*columns).exceptAll(stream).isEmpty()


def test_first_writer_wins(spark):
    rows = [("k", 2, "late"), ("k", 1, "early"), ("m", 5, "only")] + [("k", 9, "copy")] * 50
    df = spark.createDataFrame(rows, "transaction_bk string, at int, v string")
    got = {r["transaction_bk"]: r["v"] for r in load.first_per_key(df, "transaction_bk", ["at"]).collect()}
    assert got == {"k": "early", "m": "only"}


def test_labels_fill_only_open_cases(spark):
    fact = spark.createDataFrame([("a", None, None), ("b", False, None), ("c", None, None)], "transaction_bk string, is_fraud boolean, fraud_type string")
    labels = spark.createDataFrame([("a", True, "x"), ("a", False, None), ("b", True, "y")], fact.schema)
    got = {r[0]: (r[1], r[2]) for r in load.complete_labels(fact, labels).collect()}
    assert got == {"a": (True, "x"), "b": (False, None), "c": (None, None)}


def test_bulk_text_round_trip(spark):
    path = run_dir(spark, "t")
    rows = [("a\tb", None, 1), ("", "x", None), ('quote " and \\ back', "é", 3)]
    df = spark.createDataFrame(rows, "s string, t string, n int")
    tables.write_tsv(df, path)
    got = sorted(map(tuple, tables.read_tsv(spark, path, df.schema).collect()), key=repr)
    assert got == sorted([("a b", None, 1), ("", "x", None), ('quote " and \\ back', "é", 3)], key=repr)


def test_facts_are_stored_by_mode_and_day(spark, src):
    path = run_dir(spark, "t")
    tables.write_facts(inputs.fact(spark, src), path)
    stored = spark.read.parquet(path)
    plan = stored.where("ingestion_mode = 'batch' AND event_date = DATE'2024-01-03'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingestion_mode" in plan
    assert stored.count() == inputs.fact(spark, src).count()


def test_run_log_state(spark):
    t0, t1 = datetime.datetime(2024, 1, 1), datetime.datetime(2024, 1, 1, 1)
    rows = [
        logs.run_log_event(spark, run_id="r", source="batch", mode="batch", status="RUNNING", at=t0),
        logs.run_log_event(spark, run_id="r", source="batch", mode="batch", status="OK", n_rows=5, duration_ms=7, at=t1),
        logs.run_log_event(spark, run_id="s", source="batch", mode="batch", status="RUNNING", at=t1),
    ]
    state = {r["run_id"]: r for r in logs.run_log_state(rows[0].unionByName(rows[1]).unionByName(rows[2])).collect()}
    assert (state["r"]["status"], state["r"]["n_rows"], state["r"]["started_at"], state["r"]["ended_at"]) == ("OK", 5, t0, t1)
    assert (state["s"]["status"], state["s"]["ended_at"]) == ("RUNNING", None)


def test_check_results_and_assertion(spark):
    results = spark.createDataFrame([("a", "OK"), ("b", "KO")], "check_name string, status string")
    path = run_dir(spark, "t")
    logs.log_results(results, path)
    logs.log_results(results, path)
    assert spark.read.parquet(path).count() == 4
    assert tuple(logs.audit_totals(results).first()) == (1, 2)
    with pytest.raises(AssertionError, match="b"):
        quality.assert_passed(results)
    quality.assert_passed(results.where("status = 'OK'"))


def test_a_rule_without_value_fails(spark, small_dims):
    staging = spark.createDataFrame([], schema.STAGING)
    fact = load.load_facts(staging, small_dims).facts
    got = {r["check_name"]: r["status"] for r in quality.run_checks(staging, fact, small_dims, F.current_timestamp(), branches=1, channels=2).collect()}
    assert got.pop("fraud_rate_plausible") == "KO" and set(got.values()) == {"OK"}


def test_foreign_and_unique_violations(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (9, None)], "k int, s string")
    rules = schema.Constraints(not_null=("s",), unique=(("k",),), foreign={"k": "parent"})
    got = {r["rule"]: r["n_rows"] for r in quality.violations(df, rules, {"parent": spark.createDataFrame([(1,)], "k int")}).collect()}
    assert got == {"not_null:s": 1, "unique:k": 1, "foreign:k": 1}


def test_calendar_parts(spark):
    rows = {r["hour_ts"]: r for r in dimensions.calendar(spark, "2025-01-01", "2025-12-31 23:00:00").collect()}
    assert len(rows) == 8760 + 1
    sunday = rows[datetime.datetime(2025, 1, 5, 5)]
    assert (sunday["dow"], sunday["is_weekend"], sunday["is_night"], sunday["hour"]) == (7, True, True, 5)
    unknown = rows[datetime.datetime(1900, 1, 1)]
    assert (unknown["time_key"], unknown["dow"], unknown["is_night"]) == (0, 1, False)


def test_request_rules(spark):
    base = dict(amount=42.5, home_distance_km=8.0, net_income=2400.0, hour=14, dow=3, month=6, is_weekend=False, is_night=False, auth_method="puce_pin", channel="puce", segment="particulier")
    rows = [base, {**base, "channel": "pigeon"}, {**base, "amount": -10.0}, {**base, "hour": 24, "dow": 0}, {**base, "segment": None}]
    ddl = (
        "amount double, home_distance_km double, net_income double, hour int, dow int, month int, is_weekend boolean, "
        "is_night boolean, auth_method string, channel string, segment string"
    )
    good, bad = score.validate_requests(spark.createDataFrame(rows, ddl))
    assert good.count() == 1
    assert sorted(r["errors"] for r in bad.collect()) == [["amount"], ["channel"], ["hour", "dow"], ["segment"]]


def test_unknown_client_is_not_enriched(spark):
    features = spark.createDataFrame([("a", 3, 9.999), ("b", None, None), ("c", None, 2.0)], "client_id string, nb_tx_1h long, amount_1h double")
    rows = spark.createDataFrame([("a",), ("b",), ("c",), (None,), ("zz",)], "client_id string")
    got = {r["client_id"]: r["online"] and tuple(r["online"]) for r in score.enrich_online(rows, features).collect()}
    assert got == {"a": (3, 10.0), "b": None, "c": (0, 2.0), None: None, "zz": None}


def test_audit_finds_what_it_should(spark, small_dims):
    people = spark.createDataFrame([("C1", "x@y")], "client_id string, email string")
    fact = load.load_facts(spark.createDataFrame([], schema.STAGING), small_dims).facts
    tables_ = {"people": people, "branch": small_dims.branch, "fact": fact, "run_log": fact, "check_results": fact}
    report = {r["control"]: r["findings"] for r in audit.audit(spark, tables_, small_dims.client, fact, None, F.current_timestamp()).collect()}
    assert report == {
        "no_identifying_column": 1, "client_key_opaque": 2, "no_card_data": 0, "decisions_explained": 1,
        "processing_logged": 0, "retention_respected": 0, "no_identity_mapping": 1,
    }


def test_catalog_columns_from_the_session(spark):
    spark.range(1).createOrReplaceTempView("some_view")
    found = audit.metastore_columns(spark, "default")
    assert found.columns == ["table", "column", "type"]


def test_enforced_constraints(spark):
    rules = schema.Constraints(
        not_null=("k",), max_length={"t": 3}, domain={"m": ("a", "b")}, unique=(("k",), ("t", "m")), foreign={"c": "parent"}
    )
    rows = [
        (1, "x", "a", 1), (1, "y", "a", 1), (None, "z", "a", 1), (2, "long", "a", 1), (3, "q", "z", 1), (4, "w", "a", 9),
        (5, "x", "a", 1), (6, None, "a", None), (7, None, "a", None), (8, "v", "b", 2), (8, "v", "b", 2),
    ]
    df = spark.createDataFrame(rows, "k int, t string, m string, c int")
    parent = spark.createDataFrame([(1,), (2,)], "c int")
    good, bad = quality.enforce(df, rules, {"parent": parent})
    assert sorted(r["k"] for r in good.collect()) == [1, 6, 7, 8, 8]
    broken = {(r["k"], r["t"]): r["broken_rules"] for r in bad.collect()}
    assert broken == {
        (1, "y"): ["unique:k"], (None, "z"): ["not_null:k"], (2, "long"): ["length:t"], (3, "q"): ["domain:m"],
        (4, "w"): ["foreign:c"], (5, "x"): ["unique:t,m"],
    }
    with pytest.raises(KeyError):
        quality.enforce(df, rules)


def message(key, time="2024-01-05T10:00:00", amount=1, client="C1"):
    return json.dumps({**GOOD, "transaction_bk": key, "horodatage": time, "montant": amount, "client_id": client})


def raw_batch(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")


def test_first_to_arrive_wins_whatever_its_time(spark, small_dims):
    root = run_dir(spark, "t")
    house = ingest.Warehouse(f"{root}/tables")
    # a late copy with an earlier time in a later file, and one further down in the same file
    for wave, lines in enumerate(([message("A", amount=5), message("B", amount=7), message("A", "2024-01-05T09:00:00", 6)], [message("B", "2024-01-01T00:00:00", 8), message("C", amount=9)])):
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{root}/inbox/{wave}")
        time.sleep(1.1)
    query = ingest.start_ingestion(text_events(spark, f"{root}/inbox"), small_dims, house, f"{root}/checkpoint", available_now=True)
    query.awaitTermination()
    assert {r["transaction_bk"]: int(r["amount"]) for r in house.staged(spark).collect()} == {"A": 5, "B": 7, "C": 9}
    log = house.run_log(spark).collect()
    assert [(r["n_rows"], r["n_duplicates"]) for r in log] == [(3, 2)]


def test_key_index_opens_few_segments(spark, monkeypatch):
    monkeypatch.setattr(store, "FOLD", 4)
    index = store.KeyIndex(run_dir(spark, "t"))
    keys = lambda names: spark.createDataFrame([(x,) for x in names], "transaction_bk string")
    for batch in range(23):
        if batch in (2, 22):
            assert index.known(keys([f"new{i}" for i in range(200)]), batch) is None
            asked = keys(["k1-3", "k0-39", "absent", "k21-0"])
            assert {r[0] for r in index.known(asked, batch).collect()} == ({"k1-3", "k0-39"} if batch == 2 else {"k1-3", "k0-39", "k21-0"})
            opened = {f.split("segment=")[1].split("/")[0] for f in index.known(keys(["k1-3"]), batch).inputFiles() if "/keys/" in f}
            assert len(opened) == 1
        index.add(keys([f"k{batch}-{i}" for i in range(40)]), batch, 40)
        index.fold(spark, batch)
    assert [x[:2] for x in index.live(spark, 23)] == [(0, 15), (16, 19), (20, 20), (21, 21), (22, 22)]
    # of foreign keys, few pass a full filter
    many = store.KeyIndex(run_dir(spark, "t"))
    many.add(spark.range(20_000).selectExpr("concat('m', id) AS transaction_bk"), 0, 20_000)
    others = spark.range(20_000).selectExpr("concat('n', id) AS transaction_bk")
    assert many.suspects(others, 1).count() < 200 and many.known(others.union(keys(["m5"])), 1).count() == 1


@pytest.mark.parametrize("step", ["staging", "facts", "pending", "key-index", "commit"])
def test_a_broken_batch_shows_nothing(spark, small_dims, monkeypatch, step):
    house = ingest.Warehouse(run_dir(spark, "t"))
    ingest.ingest_batch(raw_batch(spark, [message("A"), message("X", client="C9")]), 0, small_dims, house)
    put, touch = ingest._put, store.touch

    def breaks(df, path, *rest):
        if f"/{step}/" in path:
            raise OSError("disk")
        put(df, path, *rest)

    def no_touch(session, path):
        if (step == "commit" and "/commits/" in path) or (step == "key-index" and "/key-index/" in path):
            raise OSError("disk")
        touch(session, path)

    monkeypatch.setattr(ingest, "_put", breaks)
    monkeypatch.setattr(store, "touch", no_touch)
    lines = [message("A"), message("B", "2024-01-05T10:10:00", 3), "broken", message("Y", client="C8")]
    with pytest.raises(OSError):
        ingest.ingest_batch(raw_batch(spark, lines), 1, small_dims, house)
    assert {r["transaction_bk"] for r in house.staged(spark).collect()} == {"A", "X"}
    assert house.facts(spark).count() == 1 and house.dead_letters(spark).isEmpty() and house.pending(spark, 1).isEmpty()
    assert [r["nb_tx_1h"] for r in house.counters(spark).where("client_id = 'C1'").collect()] == [1]
    assert house.run_log(spark).where("status = 'OK'").count() == 1
    monkeypatch.undo()
    for _ in range(2):  # and once more, as if the offsets had not been written
        ingest.ingest_batch(raw_batch(spark, lines), 1, small_dims, house)
        assert {r["transaction_bk"] for r in house.staged(spark).collect()} == {"A", "B", "X", "Y"}
        assert house.facts(spark).count() == 2 and house.dead_letters(spark).count() == 1 and house.pending(spark, 1).count() == 2
        assert [(r["nb_tx_1h"], r["amount_1h"]) for r in house.counters(spark).where("client_id = 'C1'").collect()] == [(2, 4.0)]


def test_counters_from_snapshot_and_deltas(spark, small_dims, monkeypatch):
    monkeypatch.setattr(store, "FOLD", 2)
    monkeypatch.setattr(ingest, "FOLD", 2)
    house = ingest.Warehouse(run_dir(spark, "t"))
    for batch in range(5):
        ingest.ingest_batch(raw_batch(spark, [message(f"K{batch}", f"2024-01-05T10:{10 * batch:02d}:00", 2)]), batch, small_dims, house)
        if batch in (2, 4):
            ingest.ingest_batch(raw_batch(spark, [message(f"K{batch}", f"2024-01-05T10:{10 * batch:02d}:00", 2)]), batch, small_dims, house)
        assert [(r["nb_tx_1h"], r["amount_1h"]) for r in house.counters(spark).collect()] == [(batch + 1, 2.0 * (batch + 1))]
    assert house.snapshots.last(spark, 99) == 3
    read = house.counter_states(spark)
    assert any("upto=3" in f for f in read.inputFiles()) and not any("upto=1" in f for f in read.inputFiles())
    assert read.where("batch_id < 3 AND last_ts IS NULL").isEmpty() and read.count() == 2  # one of the snapshot, one change since


def test_commits_are_folded(spark):
    commits = store.Commits(run_dir(spark, "t"))
    for batch in [*range(70), 72, 73]:
        commits.add(spark, batch)
    assert commits.ranges(spark) == [(0, 69), (72, 73)] and len(store.names(spark, commits.root)) < 20
    assert commits.before(spark, 72) == 69 and commits.before(spark, 73) == 72 and commits.before(spark, 0) is None
    ids = [r[0] for r in spark.range(80).where(commits.listed(spark, "id", before=73)).collect()]
    assert ids == [*range(70), 72]


def test_a_message_is_searched_twice_only(spark):
    plan = validate.judge_events(raw_batch(spark, ["{}"]))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("variant_get(") == 2


def test_lookup_reads_the_filters_once(spark):
    index = store.KeyIndex(run_dir(spark, "t"))
    index.add(spark.range(9_000).selectExpr("concat('k', id) AS transaction_bk"), 0, 9_000)
    asked = spark.range(0, 18_000, 3).selectExpr("concat('k', id) AS transaction_bk")
    found = index.known(asked, 1)
    assert found.inputFiles() and all("/keys/" in f for f in found.inputFiles())
    assert found.distinct().count() == found.count() == 3_000
