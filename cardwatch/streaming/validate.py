"""Validation of JSON events with the reason of the first failure."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwatch.functions.scalar import iso_timestamp
from cardwatch.sources.events import ARRIVAL, envelope


@dataclass(frozen=True)
class Field:
    """A required field: its name on the wire, its JSON kind, and the column it fills."""

    wire: str
    kind: str
    column: str
    cast: str = "string"
    max_length: int | None = None


# The event fields in the order in which they are checked.
EVENT_FIELDS = (
    Field("transaction_bk", "string", "transaction_bk", max_length=50),
    Field("client_id", "string", "client_id"),
    Field("horodatage", "string", "event_ts", cast="timestamp"),
    Field("montant", "number", "amount", cast="decimal(12,2)"),
    Field("canal", "string", "channel", max_length=20),
    Field("mcc_code", "string", "mcc_code", max_length=4),
    Field("pays_transaction", "string", "tx_country", max_length=2),
    Field("distance_domicile_km", "number", "home_distance_km", cast="decimal(8,2)"),
    Field("authentification", "string", "auth_method", max_length=20),
)

# Reasons in the dead-letter envelope.
BAD_JSON, MISSING, BAD_TYPE, BAD_VALUE = "json_invalide", "champ_manquant", "type_invalide", "valeur_invalide"


def _has_kind(json_type: Column, kind: str) -> Column:
    if kind == "string":
        return json_type == "STRING"
    return json_type.isin("BIGINT", "DOUBLE", "FLOAT") | json_type.startswith("DECIMAL")


def judge_events(raw: DataFrame, fields: Sequence[Field] = EVENT_FIELDS) -> DataFrame:
    """`raw` text, `reason` (NULL when valid), `arrival` and the typed columns of every message.

    Missing fields and wrong types are looked for field by field in the given order. Values that the
    warehouse could not store (no time, too long, too large) get a reason of their own after that.
    """
    text = F.col("value").cast("string")
    valid_text = F.when(F.is_valid_utf8(text), text)
    arrival = F.col("arrival") if "arrival" in raw.columns else F.lit(None)
    parsed = raw.select(F.col("value"), arrival.cast(ARRIVAL).alias("arrival"), F.try_parse_json(valid_text).alias("_v"))
    # One pass over a message for the JSON types of all fields, and one for their values; no object gives NULL.
    shape = lambda kinds: "struct<" + ", ".join(f"`{f.wire}`: {kinds(f)}" for f in fields) + ">"
    items = F.try_variant_get("_v", "$", shape(lambda f: "variant")).alias("_items")
    values = F.try_variant_get("_v", "$", shape(lambda f: "string" if f.cast == "timestamp" else f.cast)).alias("_values")
    parsed = parsed.select("*", items, values)
    typed, kinds, checks, value_checks = {}, {}, [], []
    for f in fields:
        kinds[f"_kind_{f.column}"] = F.schema_of_variant(F.col("_items")[f.wire])
        json_type = F.col(f"_kind_{f.column}")
        checks.append((json_type.isNull(), f"{MISSING}: {f.wire}"))
        checks.append((~_has_kind(json_type, f.kind), f"{BAD_TYPE}: {f.wire}"))
        value = F.col("_values")[f.wire]
        typed[f.column] = iso_timestamp(value) if f.cast == "timestamp" else value
        bad = F.col(f.column).isNull()
        if f.max_length:
            bad = bad | (F.length(f.column) > f.max_length)
        value_checks.append((bad, f"{BAD_VALUE}: {f.wire}"))
    reason = F.when(F.col("_v").isNull(), F.lit(BAD_JSON))
    for failed, name in [*checks, *value_checks]:
        reason = reason.when(failed, F.lit(name))
    judged = parsed.withColumns({**typed, **kinds}).withColumn("reason", reason)
    # Filters on the reason must not move below this point: they would parse the text once per use.
    whole = F.struct(F.col("value").alias("raw"), "reason", "arrival", *typed)
    return judged.select(F.explode(F.array(whole)).alias("_judged")).select("_judged.*")


def valid_events(judged: DataFrame, fields: Sequence[Field] = EVENT_FIELDS) -> DataFrame:
    """Accepted events as staging rows of the stream; their label is still open."""
    return judged.where(F.col("reason").isNull()).select(
        *[f.column for f in fields],
        F.lit(None).cast("boolean").alias("is_fraud"),
        F.lit(None).cast("string").alias("fraud_type"),
        F.lit("stream").alias("ingestion_mode"),
        "arrival",
    )


def dead_letters(judged: DataFrame) -> DataFrame:
    bad = judged.where(F.col("reason").isNotNull())
    return bad.select("raw", "reason", envelope(F.col("raw"), F.col("reason")).alias("envelope"))


def validate_events(raw: DataFrame, fields: Sequence[Field] = EVENT_FIELDS) -> tuple[DataFrame, DataFrame]:
    """Valid staging rows, and dead letters with their reason."""
    judged = judge_events(raw, fields)
    return valid_events(judged, fields), dead_letters(judged)
