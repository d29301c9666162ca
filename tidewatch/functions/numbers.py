"""Lenient casts, exact rounding and time conversions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as a number in a dump: decimal notation, or a spelled infinity or nan.
_NUMBER = r"(?i)^[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|inf|infinity|nan)$"


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def first_present(*columns: Column | str, default: Column | None = None) -> Column:
    """The first value that is neither null nor an empty string, else ``default``."""
    values = [F.nullif(_column(c).cast("string"), F.lit("")) for c in columns]
    return F.coalesce(*values, *([default] if default is not None else []))


def lenient_double(value: Column | str, default: float = 0.0) -> Column:
    text = F.trim(_column(value).cast("string"))
    return F.coalesce(F.when(text.rlike(_NUMBER), text.try_cast("double")), F.lit(default))


def lenient_long(value: Column | str, default: int | None = 0) -> Column:
    """Through double, cut toward zero; whatever does not fit is ``default``."""
    number = lenient_double(value, float("nan"))
    return F.coalesce(
        F.when(~F.isnan(number), number.try_cast("bigint")), F.lit(default).cast("bigint")
    )


def round_even(value: str, places: int = 4) -> Column:
    """Round the exact binary value of an SQL expression half to even.

    Spark's ``bround`` rounds the shortest decimal form instead, which differs when the
    double lies just beside a decimal tie. The product with ten to the ``places`` is
    therefore split into its double and its exact rounding error (Dekker), and the error
    decides the apparent ties.
    """
    x = f"CAST({value} AS DOUBLE)"
    scale = f"{float(10**places)}D"
    product, below = f"({x} * {scale})", f"floor({x} * {scale})"
    high = f"({x} * 134217729D - ({x} * 134217729D - {x}))"
    error = f"(({high} * {scale} - {product}) + ({x} - {high}) * {scale})"
    return F.expr(f"""
        CASE WHEN {product} - {below} = 0.5D AND {error} > 0 THEN {below} + 1
        WHEN {product} - {below} = 0.5D AND {error} < 0 THEN CAST({below} AS DOUBLE)
        ELSE rint({product}) END / {scale}""")


def epoch_millis(time: Column | str) -> Column:
    return F.unix_millis(_column(time).cast("timestamp"))


def epoch_seconds(time: Column | str) -> Column:
    return epoch_millis(time) / F.lit(1000.0)


def from_epoch_seconds(seconds: Column | str) -> Column:
    """Timestamp of an epoch-seconds number, cut to milliseconds."""
    return F.timestamp_millis((_column(seconds) * 1000).try_cast("bigint"))


def event_time(created: Column | str, broker_time: Column | None = None) -> Column:
    """Event time of a message; a number that is no time falls back to the broker's time.

    A message without any number has no event time.
    """
    number = _column(created).try_cast("double")
    stamp = F.timestamp_millis((number * 1000).try_cast("bigint"))
    if broker_time is None:
        return stamp
    return F.when(number.isNotNull(), F.coalesce(stamp, broker_time))


def reach_weight(score: Column | str) -> Column:
    """``log1p`` of a message's score, with nothing below zero."""
    return F.log1p(F.greatest(F.coalesce(_column(score).cast("bigint"), F.lit(0)), F.lit(0)))
