"""The same results as plain SQL over the given tables, for checking the queries in another engine."""

from __future__ import annotations

import math

from cardwatch.plans.inputs import ROWS_PER_BATCH

BASE = """
WITH e AS (
  SELECT event_id, user_id, ts, event_type, value, cast(json_extract_string(props, '$.k') AS int) AS k FROM events),
staging AS (
  SELECT concat('TX-', lpad(cast(event_id + 1 AS varchar), 9, '0')) AS transaction_bk,
         concat('C', lpad(cast(user_id AS varchar), 8, '0')) AS client_id,
         ts AS event_ts, ts AS ingested_at,
         cast(value AS decimal(12,2)) AS amount,
         event_type AS channel,
         lpad(cast(k % 3 AS varchar), 4, '0') AS mcc_code,
         CASE WHEN k >= 95 THEN 'ES' ELSE 'FR' END AS tx_country,
         cast(k * 1.25 AS decimal(8,2)) AS home_distance_km,
         CASE WHEN k < 55 THEN 'puce_pin' WHEN k < 90 THEN '3ds' ELSE 'none' END AS auth_method,
         CASE WHEN event_id % 10 = 0 THEN NULL ELSE (event_type = 'error' AND k < 8) END AS is_fraud,
         CASE WHEN event_id % 10 <> 0 AND event_type = 'error' AND k < 8
              THEN concat('type_', cast(k % 6 AS varchar)) END AS fraud_type,
         CASE WHEN event_id % 10 = 0 THEN 'stream' ELSE 'batch' END AS ingestion_mode
  FROM e),
dim_branch AS (
  SELECT n_nationkey + 1 AS branch_key, n_name AS name, r_name AS region
  FROM nation JOIN region ON n_regionkey = r_regionkey),
dim_client AS (
  SELECT c_custkey + 1 AS client_key, concat('C', lpad(cast(c_custkey AS varchar), 8, '0')) AS client_id,
         c_nationkey + 1 AS branch_key, c_mktsegment AS segment, cast(c_acctbal AS decimal(10,2)) AS net_income
  FROM customer WHERE c_custkey % 50 <> 49),
known_time AS (
  SELECT row_number() OVER (ORDER BY h) AS time_key, h AS hour_ts
  FROM (SELECT DISTINCT date_trunc('hour', ts) AS h FROM events WHERE ts < TIMESTAMP '2024-01-29 00:00:00') x),
dim_time AS (
  SELECT time_key, hour_ts, hour(hour_ts) AS hour, isodow(hour_ts) AS dow, day(hour_ts) AS day, month(hour_ts) AS month,
         isodow(hour_ts) >= 6 AS is_weekend, hour(hour_ts) < 6 AS is_night FROM known_time
  UNION ALL SELECT 0, TIMESTAMP '1900-01-01 00:00:00', 0, 1, 1, 1, false, false),
known_channel AS (
  SELECT row_number() OVER (ORDER BY channel, mcc_code) AS channel_key, channel, mcc_code
  FROM (SELECT DISTINCT channel, mcc_code FROM staging WHERE NOT (channel = 'view' AND mcc_code = '0002')) y),
dim_channel AS (
  SELECT * FROM known_channel UNION ALL SELECT 0, 'unknown', '0000'),
fact AS (
  SELECT s.transaction_bk, s.client_id, c.client_key, coalesce(t.time_key, 0) AS time_key,
         coalesce(a.channel_key, 0) AS channel_key, s.event_ts, s.amount, 'EUR' AS currency, s.tx_country,
         'FR' AS home_country, s.home_distance_km, s.auth_method, s.is_fraud, s.fraud_type, s.ingestion_mode,
         s.ingested_at AS created_at
  FROM staging s
  JOIN dim_client c ON c.client_id = s.client_id
  LEFT JOIN known_time t ON t.hour_ts = date_trunc('hour', s.event_ts)
  LEFT JOIN known_channel a ON a.channel = s.channel AND a.mcc_code = s.mcc_code),
labelled AS (
  SELECT f.transaction_bk, f.client_id, f.event_ts, t.hour_ts, cast(f.amount AS double) AS amount,
         cast(f.home_distance_km AS double) AS home_distance_km, cast(c.net_income AS double) AS net_income,
         t.hour, t.dow, t.day, t.month, cast(t.is_weekend AS int) AS is_weekend, cast(t.is_night AS int) AS is_night,
         f.auth_method, a.channel, c.segment, f.is_fraud, f.fraud_type, f.tx_country <> f.home_country AS unusual_country
  FROM fact f JOIN dim_client c ON c.client_key = f.client_key
  JOIN dim_time t ON t.time_key = f.time_key JOIN dim_channel a ON a.channel_key = f.channel_key
  WHERE f.ingestion_mode = 'batch'),
scored AS (
  SELECT *, round(1.0 / (1.0 + exp(-(2.0 - 0.15 * home_distance_km + 0.004 * amount
                 + CASE WHEN channel = 'error' THEN 1.2 ELSE 0.0 END))), 6) AS score,
         round(1.0 / (1.0 + exp(-(CASE WHEN channel = 'error' THEN 1.5 ELSE -1.5 END + 0.002 * amount))), 6) AS score_b
  FROM labelled)
"""

RATE = "round(100.0 * count(*) FILTER (WHERE is_fraud) / nullif(count(is_fraud), 0), 3)"
RATIO = "CASE WHEN ({den}) = 0 THEN 0.0 ELSE cast({num} AS double) / ({den}) END"


def _ratio(num: str, den: str) -> str:
    return RATIO.format(num=num, den=den)


def _card(digits: int = 3) -> str:
    return f"""
, counts AS (SELECT count(*) FILTER (WHERE flag) AS n_signals, count(*) FILTER (WHERE flag AND is_fraud) AS tp,
    count(*) FILTER (WHERE flag AND NOT is_fraud) AS fp, count(*) FILTER (WHERE NOT flag AND is_fraud) AS fn FROM flagged),
pr AS (SELECT *, {_ratio('tp', 'tp + fp')} AS p, {_ratio('tp', 'tp + fn')} AS r FROM counts)
SELECT n_signals, tp, fp, round_even(p, {digits}) AS precision, round_even(r, {digits}) AS recall,
       round_even({_ratio('2.0 * p * r', 'p + r')}, {digits}) AS f1 FROM pr"""


STEPS = """
, cnt AS (SELECT score, count(*) FILTER (WHERE is_fraud) AS pos, count(*) FILTER (WHERE NOT is_fraud) AS neg
          FROM scored GROUP BY score),
steps AS (SELECT *, cast(sum(pos) OVER (ORDER BY score DESC) AS bigint) AS tp,
                 cast(sum(neg) OVER (ORDER BY score DESC) AS bigint) AS fp,
                 cast(sum(pos) OVER () AS bigint) AS p, cast(sum(neg) OVER () AS bigint) AS n FROM cnt)
"""

SWEEP = f"""
, marks AS (SELECT cast(i / 100.0 AS double) AS threshold FROM range(1, 100) r(i)),
hits AS (SELECT threshold, count(*) FILTER (WHERE score >= threshold AND is_fraud) AS tp,
                count(*) FILTER (WHERE score >= threshold AND NOT is_fraud) AS fp,
                count(*) FILTER (WHERE is_fraud) AS p FROM marks, scored GROUP BY threshold),
prec AS (SELECT *, {_ratio('tp', 'tp + fp')} AS pr, {_ratio('tp', 'p')} AS rc FROM hits),
sweep AS (SELECT threshold, tp, fp, round(pr, 6) AS precision, round(rc, 6) AS recall,
                 round({_ratio('2.0 * pr * rc', 'pr + rc')}, 6) AS f1 FROM prec)
"""

ORDERED = """
, numbered AS (SELECT *, row_number() OVER (ORDER BY event_ts, transaction_bk) AS rn, count(*) OVER () AS total FROM scored),
split_rows AS (SELECT *, CASE WHEN rn <= floor(total * cast(0.8 AS double)) THEN 'train' ELSE 'test' END AS split FROM numbered)
"""

SUMMARY = """
SELECT split, count(*) AS n_rows, count(*) FILTER (WHERE is_fraud) AS n_fraud,
       round_even(avg(cast(is_fraud AS int)) * 100, 3) AS fraud_rate_pct,
       strftime(min(event_ts), '%Y-%m-%d %H:%M:%S') AS first_ts, strftime(max(event_ts), '%Y-%m-%d %H:%M:%S') AS last_ts
FROM split_rows GROUP BY split"""


MESSAGES = """
, lines0 AS (SELECT *, cast(substr(transaction_bk, 4, 9) AS bigint) - 1 AS event_id,
    (cast(substr(transaction_bk, 4, 9) AS bigint) - 1) % 40 AS m FROM staging),
lines1 AS (SELECT event_id, m, event_ts, concat('{', concat_ws(',',
    concat('"transaction_bk":"', transaction_bk, '"'),
    CASE WHEN m = 23 THEN '"client_id":null' ELSE concat('"client_id":"', client_id, '"') END,
    concat('"horodatage":"', CASE WHEN m = 31 THEN 'no time' ELSE strftime(event_ts, '%Y-%m-%dT%H:%M:%S') END, '"'),
    CASE WHEN m = 19 THEN concat('"montant":"', cast(amount AS varchar), '"') WHEN m = 29 THEN '"montant":true'
         ELSE concat('"montant":', cast(amount AS varchar)) END,
    concat('"canal":"', channel, '"'),
    CASE WHEN m <> 17 THEN concat('"mcc_code":"', mcc_code, '"') END,
    concat('"pays_transaction":"', tx_country, '"'),
    concat('"distance_domicile_km":', cast(home_distance_km AS varchar)),
    concat('"authentification":"', auth_method, '"'),
    CASE WHEN m = 37 THEN '"note":"kept out"' END), '}') AS full_line FROM lines0),
lines AS (SELECT l.event_id, l.event_ts, CASE m WHEN 7 THEN substr(full_line, 1, 30) WHEN 11 THEN '42' WHEN 13 THEN '[1,2]' ELSE full_line END AS line
    FROM lines1 l JOIN (SELECT unnest([1, 2]) AS c) x ON c = 1 OR m = 3),
parsed AS (SELECT *, CASE WHEN json_valid(line) THEN line END AS j FROM lines),
judged AS (SELECT event_id, j, coalesce(
    CASE WHEN j IS NULL THEN 'json_invalide' END,
""" + ",\n".join(
    f"""    CASE WHEN json_type(j, '$.{name}') IS NULL THEN 'champ_manquant: {name}'
         WHEN json_type(j, '$.{name}') NOT IN ({kinds}) THEN 'type_invalide: {name}' END"""
    for name, kinds in [
        (n, "'DOUBLE', 'BIGINT', 'UBIGINT'" if n in ("montant", "distance_domicile_km") else "'VARCHAR'")
        for n in (
            "transaction_bk", "client_id", "horodatage", "montant", "canal", "mcc_code", "pays_transaction",
            "distance_domicile_km", "authentification",
        )
    ]
) + """,
    CASE WHEN try_cast(json_extract_string(j, '$.horodatage') AS timestamp) IS NULL THEN 'valeur_invalide: horodatage' END) AS reason
    FROM parsed),
accepted AS (SELECT DISTINCT json_extract_string(j, '$.transaction_bk') AS transaction_bk, json_extract_string(j, '$.client_id') AS client_id,
    cast(json_extract_string(j, '$.horodatage') AS timestamp) AS event_ts, cast(json_extract_string(j, '$.montant') AS decimal(12,2)) AS amount,
    json_extract_string(j, '$.canal') AS channel, json_extract_string(j, '$.mcc_code') AS mcc_code FROM judged WHERE reason IS NULL),
runs AS (SELECT *, CASE WHEN epoch_us(event_ts) - lag(epoch_us(event_ts)) OVER w >= 3600000000 THEN 1 ELSE 0 END AS opens
    FROM accepted WINDOW w AS (PARTITION BY client_id ORDER BY event_ts, transaction_bk)),
sess AS (SELECT *, sum(opens) OVER (PARTITION BY client_id ORDER BY event_ts, transaction_bk) AS sid FROM runs),
counters AS (SELECT client_id, max(event_ts) AS last_ts, count(*) AS nb_tx_1h, cast(sum(amount) AS double) AS amount_1h
    FROM (SELECT *, max(sid) OVER (PARTITION BY client_id) AS top FROM sess) z WHERE sid = top GROUP BY client_id)
"""


DRIFT_NUMERIC = ("amount", "home_distance_km", "net_income", "hour", "dow", "day")
DRIFT_CATEGORICAL = ("is_weekend", "is_night", "auth_method", "channel", "segment")


def _drift(columns_by_scenario: dict[str, dict[str, str]]) -> str:
    """Distances per scenario and column; a scenario maps columns to their expression on the current side."""
    long, texts = [], []
    for scenario, changed in columns_by_scenario.items():
        for c in (*DRIFT_NUMERIC, *DRIFT_CATEGORICAL):
            expr = f"CASE WHEN split = 'train' THEN {c} ELSE {changed.get(c, c)} END" if c in changed else c
            if c in DRIFT_NUMERIC:
                long.append(f"SELECT '{scenario}' AS scenario, '{c}' AS feature, split, cast({expr} AS double) AS x FROM split_rows")
            texts.append(
                f"SELECT '{scenario}' AS scenario, '{c}' AS feature, split, cast({expr} AS varchar) AS x FROM split_rows"
            )
    return f"""
, longnum AS ({' UNION ALL '.join(long)}),
numcnt AS (SELECT scenario, feature, x, count(*) FILTER (WHERE split = 'train') AS r, count(*) FILTER (WHERE split = 'test') AS c
    FROM longnum GROUP BY scenario, feature, x),
numcdf AS (SELECT *, sum(r) OVER w / sum(r) OVER f AS fr, sum(c) OVER w / sum(c) OVER f AS fc, lead(x) OVER w - x AS dx FROM numcnt
    WINDOW w AS (PARTITION BY scenario, feature ORDER BY x), f AS (PARTITION BY scenario, feature)),
numstd AS (SELECT scenario, feature, stddev_pop(x) AS sd, count(DISTINCT x) AS n_values FROM longnum WHERE split = 'train' GROUP BY scenario, feature),
numdist AS (SELECT d.scenario, d.feature, sum(abs(fr - fc) * coalesce(dx, 0.0)) / greatest(max(sd), 0.001) AS score, max(n_values) AS n_values
    FROM numcdf d JOIN numstd s ON s.scenario = d.scenario AND s.feature = d.feature GROUP BY d.scenario, d.feature),
longtxt AS ({' UNION ALL '.join(texts)}),
txtcnt AS (SELECT scenario, feature, x, count(*) FILTER (WHERE split = 'train') AS r, count(*) FILTER (WHERE split = 'test') AS c
    FROM longtxt GROUP BY scenario, feature, x),
txtp AS (SELECT *, r / sum(r) OVER f AS p, c / sum(c) OVER f AS q FROM txtcnt WINDOW f AS (PARTITION BY scenario, feature)),
txtdist AS (SELECT scenario, feature, sqrt(greatest(sum((CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0.0 END
      + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0.0 END) / 2), 0.0)) AS score,
      count(*) FILTER (WHERE p > 0) AS n_values FROM txtp GROUP BY scenario, feature)
"""


def oracle_sql() -> dict[str, str]:
    sql: dict[str, str] = {}

    sql["load_facts"] = BASE + """
SELECT transaction_bk, client_id, cast(client_key AS bigint) AS client_key, cast(time_key AS bigint) AS time_key,
       cast(channel_key AS bigint) AS channel_key, strftime(event_ts, '%Y-%m-%d %H:%M:%S') AS event_time,
       cast(amount AS double) AS amount, currency, tx_country, home_country,
       cast(home_distance_km AS double) AS home_distance_km, auth_method,
       coalesce(cast(is_fraud AS varchar), 'open') AS label, coalesce(fraud_type, '') AS fraud_type, ingestion_mode
FROM fact"""
    sql["rejects"] = BASE + """
SELECT s.transaction_bk, s.client_id, s.ingestion_mode FROM staging s
WHERE NOT EXISTS (SELECT 1 FROM dim_client c WHERE c.client_id = s.client_id)"""
    sql["pending"] = BASE + """
SELECT ingestion_mode, count(*) AS n_pending FROM staging s
WHERE s.ingestion_mode = 'stream' AND NOT EXISTS (
  SELECT 1 FROM fact f WHERE f.transaction_bk = s.transaction_bk AND f.ingestion_mode = 'batch')
GROUP BY ingestion_mode"""
    sql["mart_kpis"] = BASE + f"""
SELECT count(*) AS n_transactions, count(*) FILTER (WHERE is_fraud) AS n_frauds, {RATE} AS fraud_rate_pct,
       cast(sum(amount) FILTER (WHERE is_fraud) AS double) AS fraud_amount,
       count(*) FILTER (WHERE is_fraud IS NULL) AS n_unlabelled FROM fact"""
    sql["mart_ingestion"] = BASE + """
SELECT ingestion_mode, count(*) AS n_transactions, count(*) FILTER (WHERE is_fraud) AS n_frauds,
       strftime(min(created_at), '%Y-%m-%d %H:%M:%S') AS first_write,
       strftime(max(created_at), '%Y-%m-%d %H:%M:%S') AS last_write FROM fact GROUP BY ingestion_mode"""
    sql["mart_hourly"] = BASE + f"""
SELECT cast(t.hour AS bigint) AS hour, count(*) AS n_transactions, count(*) FILTER (WHERE is_fraud) AS n_frauds,
       {RATE} AS fraud_rate_pct FROM fact f JOIN dim_time t ON t.time_key = f.time_key GROUP BY t.hour"""
    sql["mart_fraud_type"] = BASE + """
SELECT fraud_type, count(*) AS n_frauds, cast(sum(amount) AS double) AS amount_total,
       round(sum(amount) / count(*), 2) AS amount_mean FROM fact WHERE is_fraud GROUP BY fraud_type"""
    sql["integrity_anti"] = BASE + """
SELECT client_id, count(*) AS n_rows FROM staging s
WHERE NOT EXISTS (SELECT 1 FROM dim_client c WHERE c.client_id = s.client_id) GROUP BY client_id"""
    sql["quality_suite"] = BASE + f"""
, v AS (
  SELECT 'fact_keys_complete' AS check_name, 'completeness' AS category, 0.0 AS threshold,
         cast(count(*) FILTER (WHERE client_key IS NULL OR time_key IS NULL OR channel_key IS NULL) AS double) AS value FROM fact
  UNION ALL SELECT 'staging_client_known', 'integrity', 0.0, count(*) FROM staging s LEFT JOIN dim_client c
         ON c.client_id = s.client_id WHERE c.client_key IS NULL
  UNION ALL SELECT 'business_key_unique', 'uniqueness', 0.0, count(*) - count(DISTINCT transaction_bk) FROM fact
  UNION ALL SELECT 'amount_positive', 'coherence', 0.0, count(*) FILTER (WHERE amount <= 0) FROM fact
  UNION ALL SELECT 'distance_not_negative', 'coherence', 0.0, count(*) FILTER (WHERE home_distance_km < 0) FROM fact
  UNION ALL SELECT 'label_coherent', 'coherence', 0.0, count(*) FILTER (WHERE (is_fraud IS TRUE AND fraud_type IS NULL)
         OR (is_fraud IS FALSE AND fraud_type IS NOT NULL)) FROM fact
  UNION ALL SELECT 'fraud_rate_plausible', 'plausibility', 3.0, {RATE} FROM fact
  UNION ALL SELECT 'staging_transformed', 'completeness', 0.0, count(*) FROM staging s
         WHERE NOT EXISTS (SELECT 1 FROM fact f WHERE f.transaction_bk = s.transaction_bk)
         AND s.ingested_at < TIMESTAMP '2024-02-01 00:00:00' - INTERVAL 10 MINUTE
  UNION ALL SELECT 'branch_rows', 'completeness', 25.0, count(*) FROM dim_branch
  UNION ALL SELECT 'channel_rows', 'completeness', 15.0, count(*) FROM dim_channel)
SELECT check_name, category, value, cast(threshold AS double) AS threshold,
       CASE WHEN check_name = 'fraud_rate_plausible' THEN CASE WHEN value BETWEEN 0.5 AND 3.0 THEN 'OK' ELSE 'KO' END
            WHEN value = threshold THEN 'OK' ELSE 'KO' END AS status FROM v"""
    sql["constraint_violations"] = BASE + """
SELECT 'not_null:is_fraud' AS rule, count(*) AS n_rows FROM staging WHERE is_fraud IS NULL
UNION ALL SELECT 'length:auth_method', count(*) FROM staging WHERE length(auth_method) > 4
UNION ALL SELECT 'domain:ingestion_mode', count(*) FROM staging WHERE ingestion_mode <> 'batch'
UNION ALL SELECT 'unique:client_id,channel', count(*) - (SELECT count(*) FROM (SELECT DISTINCT client_id, channel FROM staging)) FROM staging
UNION ALL SELECT 'foreign:client_id', count(*) FROM staging s
  WHERE NOT EXISTS (SELECT 1 FROM dim_client c WHERE c.client_id = s.client_id)"""
    sql["late_labels"] = BASE + """
SELECT coalesce(cast(coalesce(f.is_fraud, CASE WHEN f.event_ts < TIMESTAMP '2024-01-15 00:00:00' THEN f.home_distance_km < 10 END)
         AS varchar), 'open') AS label, count(*) AS n FROM fact f GROUP BY 1"""
    sql["label_deltas"] = BASE + """
, l AS (SELECT is_fraud, fraud_type, CASE WHEN event_ts < TIMESTAMP '2024-01-15 00:00:00' THEN home_distance_km < 10 END AS late FROM fact)
SELECT coalesce(cast(coalesce(is_fraud, late) AS varchar), 'open') AS label, count(*) AS n,
       count(*) FILTER (WHERE is_fraud IS NULL AND late IS NOT NULL) AS n_late
FROM l GROUP BY 1"""
    sql["calendar"] = BASE + """
SELECT strftime(h, '%Y-%m-%d %H:%M:%S') AS hour_ts, cast(row_number() OVER (ORDER BY h) AS bigint) AS time_key,
       cast(year(h) AS bigint) AS year, cast(month(h) AS bigint) AS month, cast(day(h) AS bigint) AS day,
       cast(hour(h) AS bigint) AS hour, cast(isodow(h) AS bigint) AS dow, isodow(h) >= 6 AS is_weekend, hour(h) < 6 AS is_night
FROM (SELECT unnest(generate_series(date_trunc('hour', min(ts)), date_trunc('hour', max(ts)), INTERVAL 1 HOUR)) AS h FROM events) x"""

    # Profiles
    sql["class_imbalance"] = BASE + """
SELECT count(*) AS n_total, count(*) FILTER (WHERE is_fraud) AS n_fraud, count(*) FILTER (WHERE NOT is_fraud) AS n_legit,
       round_even(100.0 * count(*) FILTER (WHERE is_fraud) / count(*), 3) AS fraud_rate_pct,
       cast(round_even(cast(count(*) FILTER (WHERE NOT is_fraud) AS double) / count(*) FILTER (WHERE is_fraud), 0) AS bigint) AS legit_per_fraud
FROM labelled"""
    dims = ["channel", "auth_method", "segment", "unusual_country", "hour"]
    sql["rate_by_dimension"] = BASE + " UNION ALL ".join(
        f"""SELECT '{d}' AS dimension, cast({d} AS varchar) AS value, count(is_fraud) AS n,
        round_even(100.0 * cast(count(*) FILTER (WHERE is_fraud) AS double) / count(is_fraud), 2) AS fraud_rate_pct
        FROM labelled GROUP BY {d}"""
        for d in dims
    )
    sql["country_pivot"] = BASE + """
SELECT round_even(coalesce(avg(cast(is_fraud AS int)) FILTER (WHERE NOT unusual_country) * 100, 0.0), 2) AS usual_country_pct,
       round_even(coalesce(avg(cast(is_fraud AS int)) FILTER (WHERE unusual_country) * 100, 0.0), 2) AS unusual_country_pct
FROM labelled"""
    sql["peak_rates"] = BASE + """
, r AS (SELECT 'hour' AS dimension, cast(hour AS varchar) AS value, hour AS ord, '' AS ord2, avg(cast(is_fraud AS int)) * 100 AS rate FROM labelled GROUP BY hour
  UNION ALL SELECT 'channel', channel, 0, channel, avg(cast(is_fraud AS int)) * 100 FROM labelled GROUP BY channel)
SELECT dimension, value, round_even(rate, 2) AS fraud_rate_pct FROM r
QUALIFY row_number() OVER (PARTITION BY dimension ORDER BY rate DESC, ord, ord2) = 1"""
    sql["describe_by_class"] = BASE + " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, is_fraud, count({c}) AS n, round_even(avg({c}), 2) AS mean, round_even(stddev_samp({c}), 2) AS std,
        round_even(min({c}), 2) AS min, round_even(quantile_cont({c}, 0.25), 2) AS q25, round_even(quantile_cont({c}, 0.5), 2) AS q50,
        round_even(quantile_cont({c}, 0.75), 2) AS q75, round_even(max({c}), 2) AS max FROM labelled GROUP BY is_fraud"""
        for c in ("amount", "home_distance_km")
    )
    sql["boxplot"] = BASE + """
, b AS (SELECT is_fraud, quantile_cont(home_distance_km, 0.25) AS q25, quantile_cont(home_distance_km, 0.5) AS q50,
               quantile_cont(home_distance_km, 0.75) AS q75 FROM labelled GROUP BY is_fraud)
SELECT l.is_fraud, min(home_distance_km) AS whisker_low, max(q25) AS q25, max(q50) AS q50, max(q75) AS q75,
       max(home_distance_km) AS whisker_high FROM labelled l JOIN b ON b.is_fraud = l.is_fraud
WHERE home_distance_km BETWEEN q25 - 1.5 * (q75 - q25) AND q75 + 1.5 * (q75 - q25) GROUP BY l.is_fraud"""
    sql["histogram_log_amount"] = BASE + """
, x AS (SELECT is_fraud, round(log10(greatest(amount, 0.5)), 9) AS x FROM labelled),
s AS (SELECT is_fraud, min(x) AS lo, max(x) AS hi, count(*) AS total,
             CASE WHEN max(x) > min(x) THEN (max(x) - min(x)) / cast(50.0 AS double) ELSE 1.0 END AS width FROM x GROUP BY is_fraud),
b AS (SELECT x.is_fraud, least(floor((x - lo) / width), 49) AS bin, lo, width, total FROM x JOIN s ON s.is_fraud = x.is_fraud)
SELECT is_fraud, cast(bin AS bigint) AS bin, round(min(lo) + bin * min(width), 6) AS bin_start, count(*) AS n,
       round(count(*) / (min(total) * min(width)), 6) AS density FROM b GROUP BY is_fraud, bin"""
    sql["zscore_card"] = BASE + """
, st AS (SELECT avg(amount) AS m, stddev_samp(amount) AS s FROM labelled),
flagged AS (SELECT abs((amount - m) / s) > 3 AS flag, is_fraud FROM labelled, st)""" + _card()
    sql["iqr_card"] = BASE + """
, st AS (SELECT quantile_cont(amount, 0.25) AS q1, quantile_cont(amount, 0.75) AS q3 FROM labelled),
flagged AS (SELECT amount > q3 + 1.5 * (q3 - q1) AS flag, is_fraud FROM labelled, st)""" + _card()

    # Windows and splits
    sql["sequences"] = BASE + """
, n AS (SELECT *, row_number() OVER w AS rn, lag(amount, 4) OVER w AS a1, lag(amount, 3) OVER w AS a2, lag(amount, 2) OVER w AS a3,
        lag(amount, 1) OVER w AS a4, lag(channel, 4) OVER w AS c1, lag(channel, 3) OVER w AS c2, lag(channel, 2) OVER w AS c3,
        lag(channel, 1) OVER w AS c4 FROM labelled WINDOW w AS (PARTITION BY client_id ORDER BY event_ts, transaction_bk))
SELECT transaction_bk, client_id, segment, is_fraud, concat_ws('|', a1, a2, a3, a4, amount) AS amounts,
       concat_ws('|', c1, c2, c3, c4, channel) AS channels FROM n WHERE rn >= 5"""
    sql["split_positional"] = BASE + ORDERED + SUMMARY
    sql["split_quantile"] = BASE + """
, q AS (SELECT quantile_cont(cast(epoch_us(event_ts) AS double), 0.8) AS cut FROM scored),
split_rows AS (SELECT scored.*, CASE WHEN epoch_us(event_ts) < cut THEN 'train' ELSE 'test' END AS split FROM scored, q)
""" + SUMMARY
    sql["session_counters"] = BASE + """
, g AS (SELECT transaction_bk, client_id, event_ts, amount,
        CASE WHEN epoch_us(event_ts) - lag(epoch_us(event_ts)) OVER w >= 3600000000 THEN 1 ELSE 0 END AS opens
        FROM fact WINDOW w AS (PARTITION BY client_id ORDER BY event_ts, transaction_bk)),
s AS (SELECT *, sum(opens) OVER (PARTITION BY client_id ORDER BY event_ts, transaction_bk) AS sid FROM g)
SELECT transaction_bk, client_id, count(*) OVER w AS n_session, cast(sum(amount) OVER w AS double) AS amount_session
FROM s WINDOW w AS (PARTITION BY client_id, sid ORDER BY event_ts, transaction_bk ROWS UNBOUNDED PRECEDING)"""
    sql["trailing_hour_counters"] = BASE + """
SELECT transaction_bk, client_id, count(*) OVER w AS n_trailing, cast(sum(amount) OVER w AS double) AS amount_trailing
FROM fact WINDOW w AS (PARTITION BY client_id ORDER BY epoch_us(event_ts) RANGE BETWEEN 3599999999 PRECEDING AND CURRENT ROW)"""
    sql["sampled_rows"] = BASE + """
SELECT transaction_bk, amount FROM labelled ORDER BY md5(concat('42|', transaction_bk)), transaction_bk LIMIT 300"""

    below, term, steps = 0.0, math.exp(-0.2), []
    for k in range(1, 21):
        below += term
        steps.append(f"(draw >= {below!r}::DOUBLE)::INTEGER")
        term *= 0.2 / k
    sql["resampled_rows"] = BASE + f""",
drawn AS (SELECT transaction_bk, amount,
    ('0x' || substr(md5(concat('42|', transaction_bk)), 1, 8))::BIGINT::DOUBLE / 4294967296.0 AS draw FROM labelled)
SELECT transaction_bk, amount FROM drawn, unnest(range(1, 1 + {' + '.join(steps)})) AS u(i)"""

    # Evaluation
    sql["roc_points"] = BASE + STEPS + f"""
SELECT score, round({_ratio('fp', 'n')}, 6) AS fpr, round({_ratio('tp', 'p')}, 6) AS tpr FROM steps"""
    sql["pr_points"] = BASE + STEPS + f"""
SELECT score, round({_ratio('tp', 'tp + fp')}, 6) AS precision, round({_ratio('tp', 'p')}, 6) AS recall FROM steps"""
    sql["evaluate_scores"] = BASE + STEPS + f"""
, a AS (SELECT cast(sum(neg * (2 * tp - pos)) AS double) AS area2, sum(pos * {_ratio('tp', 'tp + fp')}) AS ap,
        max(p) AS p, max(n) AS n, sum(pos) FILTER (WHERE score >= 0.5) AS hit, sum(neg) FILTER (WHERE score >= 0.5) AS alarm FROM steps),
b AS (SELECT *, area2 / (2.0 * p * n) AS auc, {_ratio('hit', 'hit + alarm')} AS pr, {_ratio('hit', 'p')} AS rc FROM a)
SELECT cast(0.5 AS double) AS threshold, round_even(auc, 4) AS auc_roc, round_even(auc * 2 - 1, 4) AS gini,
       round_even(ap / p, 4) AS average_precision, round_even(pr, 4) AS precision, round_even(rc, 4) AS recall,
       round_even({_ratio('2.0 * pr * rc', 'pr + rc')}, 4) AS f1 FROM b"""
    sql["threshold_sweep"] = BASE + SWEEP + "SELECT * FROM sweep"
    sql["best_threshold"] = BASE + SWEEP + "SELECT threshold, f1 FROM sweep ORDER BY f1 DESC, threshold LIMIT 1"
    sql["confusion"] = BASE + """
SELECT cast(is_fraud AS int) AS label, cast(score >= 0.5 AS int) AS predicted, count(*) AS n FROM scored GROUP BY 1, 2"""
    sql["detection_by_type"] = BASE + """
SELECT fraud_type, count(*) AS n_frauds, round_even(avg(cast(score >= 0.9 AS int)) * 100, 2) AS detected_pct
FROM scored WHERE is_fraud GROUP BY fraud_type"""
    sql["complementarity"] = BASE + """
SELECT count(*) FILTER (WHERE score >= 0.95 AND score_b >= 0.85) AS "both", count(*) FILTER (WHERE score >= 0.95 AND score_b < 0.85) AS only_a,
       count(*) FILTER (WHERE score < 0.95 AND score_b >= 0.85) AS only_b, count(*) FILTER (WHERE score < 0.95 AND score_b < 0.85) AS none
FROM scored WHERE is_fraud"""
    sql["business_kpis"] = BASE + """
, m AS (SELECT unnest([0.5, 0.9, 0.98])::double AS threshold),
k AS (SELECT threshold, cast(sum(cast(amount AS decimal(12,2))) FILTER (WHERE is_fraud) AS double) AS total,
   coalesce(cast(sum(cast(amount AS decimal(12,2))) FILTER (WHERE is_fraud AND score >= threshold) AS double), 0.0) AS avoided,
   count(*) FILTER (WHERE NOT is_fraud AND score >= threshold) AS fa FROM scored, m GROUP BY threshold)
SELECT threshold, round(total, 2) AS fraud_amount_total, round(avoided, 2) AS fraud_amount_avoided, round(total - avoided, 2) AS fraud_amount_missed,
       fa AS false_alerts, cast(fa * 8.0 AS double) AS alert_cost, round(avoided - cast(fa * 8.0 AS double), 2) AS net_benefit,
       round((avoided - cast(fa * 8.0 AS double)) * cast(4.8 AS double), 2) AS net_benefit_per_year FROM k"""
    sql["top_fraud"] = BASE + """
SELECT transaction_bk, score FROM scored WHERE is_fraud AND score >= 0.5 ORDER BY score DESC, transaction_bk LIMIT 1"""

    sql["staged_once"] = BASE + """
SELECT ingestion_mode, count(*) AS n, cast(sum(amount) AS double) AS amount FROM staging
WHERE event_ts >= TIMESTAMP '2024-01-15 00:00:00' GROUP BY ingestion_mode"""
    sql["processed_rows"] = BASE + """
SELECT ingestion_mode, count(*) AS n FROM staging s
WHERE EXISTS (SELECT 1 FROM fact f WHERE f.transaction_bk = s.transaction_bk) GROUP BY ingestion_mode"""
    sql["enforced_rows"] = BASE + """
SELECT concat_ws(',', CASE WHEN is_fraud IS NULL THEN 'not_null:is_fraud' END, CASE WHEN length(auth_method) > 4 THEN 'length:auth_method' END,
       CASE WHEN tx_country <> 'FR' THEN 'domain:tx_country' END) AS broken, count(*) AS n FROM staging GROUP BY 1"""
    sql["column_defaults"] = BASE + """
SELECT coalesce(fraud_type, 'none') AS fraud_type, 'active' AS status, count(*) AS n FROM staging GROUP BY 1"""
    sql["bulk_text"] = BASE + """
SELECT transaction_bk, strftime(event_ts, '%Y-%m-%d %H:%M:%S') AS event_time, cast(amount AS double) AS amount, channel,
       coalesce(cast(is_fraud AS varchar), 'open') AS label, coalesce(fraud_type, '') AS fraud_type FROM staging"""
    sql["channel_reload"] = BASE + """
SELECT row_number() OVER (ORDER BY channel, mcc_code) AS channel_key, channel, mcc_code
FROM (SELECT DISTINCT channel, mcc_code FROM staging) x UNION ALL SELECT 0, 'unknown', '0000'"""
    sql["dimension_growth"] = BASE + """
, r AS (SELECT DISTINCT channel, mcc_code, (channel <> 'click' OR mcc_code = '0001') AS early FROM staging),
k AS (SELECT row_number() OVER (ORDER BY channel, mcc_code) AS n, * FROM r WHERE early),
f AS (SELECT row_number() OVER (ORDER BY channel, mcc_code) AS n, * FROM r WHERE NOT early)
SELECT n AS channel_key, channel, mcc_code FROM k UNION ALL SELECT 0, 'unknown', '0000'
UNION ALL SELECT n + (SELECT max(n) FROM k), channel, mcc_code FROM f"""
    sql["random_clients"] = BASE + """
SELECT client_id FROM (SELECT DISTINCT client_id FROM fact) x ORDER BY md5(concat('42|', client_id)), client_id LIMIT 20"""
    sql["holdout"] = BASE + """
SELECT cast(concat('0x', substr(md5(concat('42|', transaction_bk)), 1, 8)) AS bigint) / 4294967296.0 < 0.1 AS is_validation,
       count(*) AS n, count(*) FILTER (WHERE is_fraud) AS n_fraud FROM labelled GROUP BY 1"""
    sql["class_weights"] = BASE + """
SELECT round(cast(count(*) FILTER (WHERE NOT is_fraud) AS double) / count(*) FILTER (WHERE is_fraud), 6) AS ratio,
       round(sqrt(cast(count(*) FILTER (WHERE NOT is_fraud) AS double) / count(*) FILTER (WHERE is_fraud)), 6) AS root,
       count(DISTINCT client_id) AS n_clients FROM labelled"""
    sql["production_models"] = BASE + """
SELECT channel AS name, max(day(event_ts)) AS version, concat(channel, '/', cast(max(day(event_ts)) AS varchar)) AS path
FROM staging GROUP BY channel"""
    sql["smote"] = BASE + ORDERED + """
, c AS (SELECT count(*) FILTER (WHERE is_fraud) AS p, count(*) FILTER (WHERE NOT is_fraud) AS n FROM split_rows WHERE split = 'train')
SELECT true AS is_fraud, false AS synthetic, p AS n FROM c UNION ALL SELECT false, false, n FROM c
UNION ALL SELECT true, true, cast(floor(cast(0.3 AS double) * n) AS bigint) - p FROM c"""
    sql["smote_points"] = BASE + ORDERED + """
, c AS (SELECT count(*) FILTER (WHERE is_fraud) AS p, count(*) FILTER (WHERE NOT is_fraud) AS n FROM split_rows WHERE split = 'train')
SELECT cast(floor(cast(0.3 AS double) * n) AS bigint) - p AS n, 0::BIGINT AS n_outside FROM c"""
    sql["scored_requests"] = BASE + ORDERED + """
, q AS (SELECT concat_ws(',',
    CASE WHEN NOT amount > 0 THEN 'amount' END,
    CASE WHEN NOT home_distance_km >= 0 THEN 'home_distance_km' END,
    CASE WHEN NOT net_income > 0 THEN 'net_income' END) AS errors FROM split_rows WHERE split = 'test')
SELECT errors, count(*) AS n, 0::BIGINT AS n_wrong FROM q GROUP BY errors"""
    sql["model_properties"] = BASE + ORDERED + """
, n AS (SELECT count(*) FILTER (WHERE split = 'test') AS test,
        count(*) FILTER (WHERE split = 'train' AND NOT is_fraud) AS legit FROM split_rows)
SELECT property, CASE property WHEN 'importances' THEN 0 WHEN 'reconstruction' THEN legit ELSE test END AS n, 0::BIGINT AS n_wrong
FROM n, unnest(['boosted_explanations', 'logistic_explanations', 'stored_model', 'reconstruction', 'importances']) AS u(property)"""
    sql["metric_summary"] = BASE + """
, st AS (SELECT avg(amount) AS m, stddev_samp(amount) AS s FROM labelled),
z AS (SELECT abs((amount - m) / s) > 3 AS flag, is_fraud FROM labelled, st)
SELECT 'imbalance' AS section, 'n_total' AS key, cast(count(*) AS double) AS value FROM labelled
UNION ALL SELECT 'imbalance', 'n_fraud', count(*) FILTER (WHERE is_fraud) FROM labelled
UNION ALL SELECT 'imbalance', 'n_legit', count(*) FILTER (WHERE NOT is_fraud) FROM labelled
UNION ALL SELECT 'imbalance', 'fraud_rate_pct', round_even(100.0 * count(*) FILTER (WHERE is_fraud) / count(*), 3) FROM labelled
UNION ALL SELECT 'imbalance', 'legit_per_fraud',
    round_even(cast(count(*) FILTER (WHERE NOT is_fraud) AS double) / count(*) FILTER (WHERE is_fraud), 0) FROM labelled
UNION ALL SELECT 'zscore', 'n_signals', count(*) FILTER (WHERE flag) FROM z
UNION ALL SELECT 'zscore', 'tp', count(*) FILTER (WHERE flag AND is_fraud) FROM z
UNION ALL SELECT 'zscore', 'fp', count(*) FILTER (WHERE flag AND NOT is_fraud) FROM z
UNION ALL SELECT 'mart', 'n_transactions', count(*) FROM fact
UNION ALL SELECT 'mart', 'n_frauds', count(*) FILTER (WHERE is_fraud) FROM fact
UNION ALL SELECT 'mart', 'n_unlabelled', count(*) FILTER (WHERE is_fraud IS NULL) FROM fact"""
    scaled = ["amount", "home_distance_km", "net_income", "hour", "dow", "month"]
    sql["standardised_features"] = (
        BASE
        + ", st AS (SELECT "
        + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in scaled)
        + " FROM labelled) SELECT transaction_bk, "
        + ", ".join(f"round(({c} - m_{c}) / CASE WHEN s_{c} = 0 THEN 1.0 ELSE s_{c} END, 6) AS x_{c}" for c in scaled)
        + ", cast(is_weekend AS double) AS x_is_weekend, cast(is_night AS double) AS x_is_night FROM labelled, st"
    )
    hot = [
        f"cast({c} = '{v}' AS double) AS x_{c}_{v}"
        for c, values in (
            ("auth_method", ("3ds", "none", "puce_pin")),
            ("channel", ("click", "error", "purchase", "signup", "unknown", "view")),
            ("segment", ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")),
        )
        for v in values
    ]
    sql["one_hot"] = BASE + f"""
SELECT {', '.join(hot)},
       cast(CASE auth_method WHEN 'puce_pin' THEN 0 WHEN '3ds' THEN 1 ELSE -1 END AS bigint) AS idx, count(*) AS n
FROM labelled GROUP BY ALL"""
    sql["risk_bands"] = BASE + """
SELECT CASE WHEN score >= 0.9 THEN 'high' WHEN score >= 0.5 THEN 'medium' ELSE 'low' END AS risk_level,
       score >= 0.5 AS fraud_at_default, score >= 0.9 AS fraud_at_tuned, count(*) AS n FROM scored GROUP BY 1, 2, 3"""
    sql["validate_requests"] = BASE + """
, r AS (SELECT *, cast(substr(transaction_bk, 4, 9) AS bigint) AS nr FROM labelled),
q AS (SELECT concat_ws(',',
    CASE WHEN NOT (CASE WHEN nr % 11 = 0 THEN -amount ELSE amount END > 0) THEN 'amount' END,
    CASE WHEN NOT home_distance_km >= 0 THEN 'home_distance_km' END,
    CASE WHEN NOT net_income > 0 THEN 'net_income' END,
    CASE WHEN nr % 13 = 0 THEN 'hour' END,
    CASE WHEN nr % 17 = 0 THEN 'dow' END,
    CASE WHEN nr % 19 = 0 THEN 'month' END,
    CASE WHEN auth_method NOT IN ('puce_pin', '3ds') THEN 'auth_method' END,
    CASE WHEN channel NOT IN ('click', 'error', 'view', 'purchase', 'login') THEN 'channel' END,
    CASE WHEN segment NOT IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY') THEN 'segment' END) AS errors FROM r)
SELECT errors, count(*) AS n FROM q GROUP BY errors"""
    weights = {"home_distance_km": -0.15, "amount": 0.004, "net_income": 0.0001, "hour": 0.02, "dow": -0.05, "month": 0.5}
    sql["top_contributions_linear"] = (
        BASE
        + ", st AS (SELECT " + ", ".join(f"avg({c}) AS m_{c}" for c in weights) + " FROM labelled), c AS ("
        + " UNION ALL ".join(
            f"SELECT transaction_bk, '{c}' AS feature, cast({w} AS double) * ({c} - m_{c}) AS v FROM labelled, st" for c, w in weights.items()
        )
        + """), o AS (SELECT *, row_number() OVER (PARTITION BY transaction_bk ORDER BY abs(v) DESC, feature) - 1 AS place FROM c)
SELECT transaction_bk, place, feature, round_even(v, 4) AS impact FROM o WHERE place < 5"""
    )
    plain = {"normal": {}}
    moved = {
        "hour": "(hour + 9) % 24",
        "amount": "round_even(amount * cast(1.8 AS double), 2)",
        "day": "((day - 1 + 4 + cast(concat('0x', substr(md5(transaction_bk), 1, 4)) AS int) % 3) % 31) + 1",
    }
    sql["drift_numeric"] = BASE + ORDERED + _drift(plain) + """
SELECT feature, 'wasserstein' AS method, round(score, 6) AS score, n_values FROM numdist"""
    sql["drift_categorical"] = BASE + ORDERED + _drift(plain) + f"""
SELECT feature, 'jensen_shannon' AS method, round(score, 6) AS score, n_values FROM txtdist
WHERE feature IN {DRIFT_CATEGORICAL}"""
    sql["drift_verdict"] = BASE + ORDERED + _drift({**plain, "injected": moved}) + f"""
, verdict AS (SELECT scenario, feature, score >= 0.1 AS drifted FROM numdist WHERE n_values > 5
  UNION ALL SELECT scenario, feature, score >= 0.1 FROM txtdist WHERE feature IN {DRIFT_CATEGORICAL} OR n_values <= 5)
SELECT scenario, count(*) AS n_columns, count(*) FILTER (WHERE drifted) AS n_drifted,
       round_even(avg(cast(drifted AS int)) * 100, 2) AS drifted_pct, avg(cast(drifted AS int)) > 0.2 AS alert,
       coalesce(string_agg(feature, ',' ORDER BY feature) FILTER (WHERE drifted), '') AS drifted_columns FROM verdict GROUP BY scenario"""
    sql["retention_check"] = BASE + """
SELECT ingestion_mode, count(*) AS n_expired FROM fact WHERE event_ts < TIMESTAMP '2024-02-01 00:00:00' - INTERVAL 20 DAY
GROUP BY ingestion_mode"""
    sql["audit_report"] = BASE + """
, a AS (SELECT 'minimisation' AS principle, 'no_identifying_column' AS control, cast(0 AS bigint) AS findings
  UNION ALL SELECT 'pseudonymisation', 'client_key_opaque', count(*) FROM dim_client WHERE NOT regexp_matches(client_id, '^C[0-9]{7}[02468]$')
  UNION ALL SELECT 'security', 'no_card_data', 0
  UNION ALL SELECT 'explanation', 'decisions_explained', 0
  UNION ALL SELECT 'accountability', 'processing_logged', 1
  UNION ALL SELECT 'storage_limitation', 'retention_respected', count(*) FROM fact WHERE event_ts < TIMESTAMP '2024-02-01 00:00:00' - INTERVAL 25 DAY
  UNION ALL SELECT 'subject_rights', 'no_identity_mapping', 0)
SELECT *, CASE WHEN findings = 0 THEN 'OK' ELSE 'KO' END AS status FROM a"""

    # Streaming
    sql["validate_events"] = BASE + MESSAGES + """
SELECT coalesce(reason, 'valid') AS reason, count(*) AS n,
       cast(sum(CASE WHEN json_type(j, '$.montant') = 'DOUBLE' THEN cast(json_extract_string(j, '$.montant') AS decimal(12,2))
                     WHEN reason = 'type_invalide: montant' AND json_type(j, '$.montant') = 'VARCHAR'
                     THEN cast(json_extract_string(j, '$.montant') AS decimal(12,2))
                     WHEN json_type(j, '$.montant') = 'BOOLEAN' THEN 1.00 END) AS double) AS amount
FROM judged GROUP BY 1"""
    sql["stream_ingest"] = BASE + MESSAGES + """
SELECT s.transaction_bk, cast(c.client_key AS bigint) AS client_key, cast(coalesce(t.time_key, 0) AS bigint) AS time_key,
       cast(coalesce(a.channel_key, 0) AS bigint) AS channel_key, strftime(s.event_ts, '%Y-%m-%d %H:%M:%S') AS event_time,
       cast(s.amount AS double) AS amount, 'open' AS label, 'stream' AS ingestion_mode
FROM accepted s JOIN dim_client c ON c.client_id = s.client_id
LEFT JOIN known_time t ON t.hour_ts = date_trunc('hour', s.event_ts)
LEFT JOIN known_channel a ON a.channel = s.channel AND a.mcc_code = s.mcc_code"""
    sql["stream_dead_letters"] = BASE + MESSAGES + """
SELECT reason, count(*) AS n FROM judged WHERE reason IS NOT NULL GROUP BY reason"""
    sql["stream_totals"] = BASE + MESSAGES + """
SELECT (SELECT count(*) FROM accepted) AS ingested, (SELECT count(*) FROM judged WHERE reason IS NOT NULL) AS rejected,
       (SELECT count(*) FROM judged WHERE reason IS NULL) - (SELECT count(*) FROM accepted) AS duplicates"""
    sql["stream_known"] = BASE + MESSAGES + """
SELECT s.transaction_bk, a.transaction_bk IS NOT NULL AS known
FROM staging s LEFT JOIN (SELECT DISTINCT transaction_bk FROM accepted) a ON a.transaction_bk = s.transaction_bk"""
    sql["stream_staged"] = BASE + MESSAGES + """
SELECT cast(CASE WHEN event_ts < TIMESTAMP '2024-01-11' THEN 0 WHEN event_ts < TIMESTAMP '2024-01-21' THEN 1 ELSE 2 END AS bigint) AS wave,
       count(*) AS n, true AS placed, cast(sum(amount) AS double) AS amount
FROM accepted GROUP BY 1"""
    sql["online_counters"] = BASE + MESSAGES + """
SELECT client_id, strftime(last_ts, '%Y-%m-%d %H:%M:%S') AS last_ts, nb_tx_1h, amount_1h FROM counters"""
    sql["enrich_online"] = BASE + MESSAGES + """
SELECT l.transaction_bk, coalesce(c.nb_tx_1h, -1) AS nb_tx_1h, coalesce(c.amount_1h, -1.0) AS amount_1h
FROM labelled l LEFT JOIN counters c ON c.client_id = l.client_id"""
    sql["run_log_state"] = BASE + """
, d AS (SELECT cast(event_ts AS date) AS day, min(event_ts) AS s, max(event_ts) AS e, count(*) AS n FROM staging GROUP BY 1),
x AS (SELECT *, day = max(day) OVER () AS newest FROM d)
SELECT strftime(day, '%Y-%m-%d') AS run_id, CASE WHEN newest THEN 'RUNNING' WHEN n % 7 = 0 THEN 'ERROR' ELSE 'OK' END AS status,
       CASE WHEN newest THEN -1 ELSE n END AS n_rows,
       CASE WHEN newest THEN -1 ELSE (epoch_us(e) - epoch_us(s)) // 1000 END AS duration_ms,
       CASE WHEN NOT newest AND n % 7 = 0 THEN 'row count is a multiple of seven' ELSE '' END AS message,
       strftime(s, '%Y-%m-%d %H:%M:%S') AS started_at,
       CASE WHEN newest THEN 'open' ELSE strftime(e, '%Y-%m-%d %H:%M:%S') END AS ended_at FROM x"""
    sql["stream_dedup"] = BASE + """
SELECT client_id, count(*) AS n, cast(sum(amount) AS double) AS amount FROM staging GROUP BY client_id"""
    sql["stream_sessions"] = BASE + """
, g AS (SELECT client_id, transaction_bk, event_ts, amount, CASE WHEN epoch_us(event_ts) - lag(epoch_us(event_ts)) OVER w > 3600000000 THEN 1 ELSE 0 END AS opens
  FROM staging WINDOW w AS (PARTITION BY client_id ORDER BY event_ts, transaction_bk)),
s AS (SELECT *, sum(opens) OVER (PARTITION BY client_id ORDER BY event_ts, transaction_bk) AS sid FROM g),
c AS (SELECT client_id, sid, min(event_ts) AS s, max(event_ts) AS e, count(*) AS n, sum(amount) AS amount FROM s GROUP BY client_id, sid)
SELECT client_id, strftime(s, '%Y-%m-%d %H:%M:%S') AS start_ts, n, cast(amount AS double) AS amount FROM c
WHERE e + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 24 HOUR"""
    sql["stream_trailing"] = BASE + """
, t AS (SELECT transaction_bk, client_id, event_ts, count(*) OVER w AS n_trailing, cast(sum(amount) OVER w AS double) AS amount_trailing
  FROM staging WINDOW w AS (PARTITION BY client_id ORDER BY epoch_us(event_ts) RANGE BETWEEN 3599999999 PRECEDING AND CURRENT ROW))
SELECT transaction_bk, client_id, n_trailing, amount_trailing FROM t
WHERE (epoch_us(event_ts) // 3600000000 + 1) * 3600000 < (SELECT epoch_ms(max(ts)) FROM events) - 86400000"""
    sql["stream_row_batches"] = f"""
WITH n AS (SELECT count(*) + count(*) FILTER (WHERE event_id % 40 = 3) AS n FROM events)
SELECT i AS batch_id, least({ROWS_PER_BATCH}, n - i * {ROWS_PER_BATCH}) AS n, 0::BIGINT AS n_gaps
FROM n, unnest(range(0, (n + {ROWS_PER_BATCH - 1}) // {ROWS_PER_BATCH})) AS u(i)"""
    sql["check_log"] = f"SELECT *, 2::BIGINT AS n_runs FROM ({sql['quality_suite']})"
    sql["audit_log"] = sql["audit_report"]
    sql["load_log"] = BASE + """
, n AS (SELECT count(*) AS n FROM fact WHERE ingestion_mode = 'batch')
SELECT 'first' AS run_id, 'batch' AS mode, 'OK' AS status, n AS n_rows, n AS n_stored FROM n
UNION ALL SELECT 'second', 'batch', 'OK', 0, n FROM n"""
    return sql
