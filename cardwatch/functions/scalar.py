"""Column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def hour_of(ts: str | Column) -> Column:
    return F.date_trunc("hour", ts)


def business_key(n: Column) -> Column:
    """TX- and the number on nine digits."""
    return F.concat(F.lit("TX-"), F.lpad(n.cast("string"), 9, "0"))


def iso_timestamp(text: str | Column) -> Column:
    """Parsed ISO time, NULL when the text is no time."""
    return F.try_to_timestamp(text)


def ratio(num: Column, den: Column) -> Column:
    """Quotient as double, 0 where the denominator is 0."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def percent_of(num: Column, den: Column, digits: int = 3) -> Column:
    """Rounded percentage, NULL where the denominator is 0."""
    return F.round(F.try_divide(F.lit(100.0) * num.cast("double"), den.cast("double")), digits)


def f1(precision: Column, recall: Column) -> Column:
    return ratio(F.lit(2.0) * precision * recall, precision + recall)


def sigmoid(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def log10_floor(value: Column, lower: float = 0.5) -> Column:
    """log10 of the value clipped below at `lower`."""
    return F.log10(F.greatest(value.cast("double"), F.lit(lower)))


def as_flag(value: Column) -> Column:
    return value.cast("int")


def category_index(value: str | Column, known: Sequence[str]) -> Column:
    """Position in the list of known values, NULL for any other value."""
    pairs = [F.lit(x) for i, name in enumerate(known) for x in (name, i)]
    return F.try_element_at(F.create_map(*pairs), F.col(value) if isinstance(value, str) else value)


def one_hot(column: str, known: Sequence[str]) -> dict[str, Column]:
    """One 0/1 column per known value in sorted order; an unknown value gives zeros throughout."""
    return {
        f"{column}_{name}": F.coalesce((F.col(column) == F.lit(name)).cast("double"), F.lit(0.0))
        for name in sorted(known)
    }


def standardised(column: str, mean: float, std: float) -> Column:
    """(x - mean) / population deviation; a constant column is only centred."""
    return (F.col(column).cast("double") - F.lit(mean)) / F.lit(std if std else 1.0)


def calendar_parts(ts: str | Column) -> dict[str, Column]:
    """Attributes of an hour: weekdays run from 1 = Monday to 7 = Sunday, nights end at six."""
    at = F.col(ts) if isinstance(ts, str) else ts
    dow = F.weekday(at) + 1
    return {
        "day_date": F.to_date(at),
        "year": F.year(at),
        "month": F.month(at),
        "day": F.dayofmonth(at),
        "hour": F.hour(at),
        "dow": dow,
        "is_weekend": dow >= 6,
        "is_night": F.hour(at) < 6,
    }


def risk_band(score: Column, tuned: float, default: float = 0.5) -> Column:
    return F.when(score >= tuned, "high").when(score >= default, "medium").otherwise("low")


def shift_cyclic(value: Column, by: Column | int, period: int, start: int = 0) -> Column:
    """Move a value around a cycle of `period` values that begins at `start`."""
    return F.pmod(value - start + by, F.lit(period)) + start


def failed_rules(rules: Mapping[str, Column]) -> Column:
    """Names of the rules that do not hold; a rule that evaluates to NULL does not hold."""
    named = [F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()]
    return F.filter(F.array(*named), lambda x: x.isNotNull())
