"""Tables of the warehouse: columns, keys, defaults and constraints."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

UNKNOWN_KEY = 0

# Currency and home country of every fact, the unknown hour and the unknown channel.
CURRENCY = "EUR"
HOME_COUNTRY = "FR"
UNKNOWN_HOUR = "1900-01-01 00:00:00"
UNKNOWN_CHANNEL = "unknown"
UNKNOWN_MCC = "0000"

STAGING = T.StructType(
    [
        T.StructField("transaction_bk", T.StringType(), False),
        T.StructField("client_id", T.StringType(), False),
        T.StructField("event_ts", T.TimestampType(), False),
        T.StructField("amount", T.DecimalType(12, 2), False),
        T.StructField("channel", T.StringType(), False),
        T.StructField("mcc_code", T.StringType(), False),
        T.StructField("tx_country", T.StringType(), False),
        T.StructField("home_distance_km", T.DecimalType(8, 2), False),
        T.StructField("auth_method", T.StringType(), False),
        T.StructField("is_fraud", T.BooleanType(), True),
        T.StructField("fraud_type", T.StringType(), True),
        T.StructField("ingestion_mode", T.StringType(), False),
        T.StructField("ingested_at", T.TimestampType(), False),
    ]
)

BRANCH = T.StructType(
    [
        T.StructField("branch_key", T.IntegerType(), False),
        T.StructField("branch_code", T.StringType(), False),
        T.StructField("name", T.StringType(), False),
        T.StructField("region", T.StringType(), False),
        T.StructField("city", T.StringType(), False),
    ]
)

CLIENT = T.StructType(
    [
        T.StructField("client_key", T.IntegerType(), False),
        T.StructField("client_id", T.StringType(), False),
        T.StructField("branch_key", T.IntegerType(), False),
        T.StructField("birth_date", T.DateType(), False),
        T.StructField("postal_code", T.StringType(), False),
        T.StructField("department", T.StringType(), False),
        T.StructField("segment", T.StringType(), False),
        T.StructField("net_income", T.DecimalType(10, 2), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("client_since", T.DateType(), False),
        T.StructField("created_at", T.TimestampType(), False),
    ]
)

CHANNEL = T.StructType(
    [
        T.StructField("channel_key", T.IntegerType(), False),
        T.StructField("channel", T.StringType(), False),
        T.StructField("mcc_code", T.StringType(), False),
        T.StructField("mcc_label", T.StringType(), False),
        T.StructField("is_online", T.BooleanType(), False),
        T.StructField("is_contactless", T.BooleanType(), False),
    ]
)

CARD_BLOCK = T.StructType(
    [
        T.StructField("block_key", T.IntegerType(), False),
        T.StructField("client_key", T.IntegerType(), False),
        T.StructField("time_key", T.IntegerType(), False),
        T.StructField("reason", T.StringType(), False),
        T.StructField("unblocked_at", T.TimestampType(), True),
        T.StructField("created_at", T.TimestampType(), False),
    ]
)


@dataclass(frozen=True)
class Constraints:
    """What a table rejects: NULLs, over-long text, values outside a set, repeated keys, dangling keys."""

    not_null: tuple[str, ...] = ()
    max_length: dict[str, int] = field(default_factory=dict)
    domain: dict[str, tuple] = field(default_factory=dict)
    unique: tuple[tuple[str, ...], ...] = ()
    foreign: dict[str, str] = field(default_factory=dict)


FACT_CONSTRAINTS = Constraints(
    not_null=(
        "transaction_bk", "client_key", "time_key", "channel_key", "amount", "currency", "tx_country",
        "home_country", "home_distance_km", "auth_method", "ingestion_mode",
    ),
    max_length={
        "transaction_bk": 50, "currency": 3, "tx_country": 2, "home_country": 2, "auth_method": 20,
        "fraud_type": 30, "ingestion_mode": 10,
    },
    domain={"ingestion_mode": ("batch", "stream")},
    unique=(("transaction_bk",),),
    foreign={"client_key": "client", "time_key": "time", "channel_key": "channel"},
)

STAGING_CONSTRAINTS = Constraints(
    not_null=(
        "transaction_bk", "client_id", "event_ts", "amount", "channel", "mcc_code", "tx_country",
        "home_distance_km", "auth_method", "ingestion_mode",
    ),
    max_length={
        "transaction_bk": 50, "channel": 20, "mcc_code": 4, "tx_country": 2, "auth_method": 20,
        "fraud_type": 30, "ingestion_mode": 10,
    },
    domain={"ingestion_mode": ("batch", "stream")},
    unique=(("transaction_bk",),),
)

CLIENT_CONSTRAINTS = Constraints(
    not_null=("client_key", "client_id", "branch_key", "segment", "net_income"),
    max_length={"segment": 20},
    unique=(("client_id",),),
    foreign={"branch_key": "branch"},
)
