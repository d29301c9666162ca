"""Record layouts."""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    FloatType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(**columns) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


_TEXT, _LONG, _DOUBLE, _TIME = StringType(), LongType(), DoubleType(), TimestampType()

# Field names of the message, aggregate and alert contracts.

# A dump record before normalisation; every field is text because dumps disagree on types.
DUMP = _struct(
    id=_TEXT, name=_TEXT, type=_TEXT, kind=_TEXT, subreddit=_TEXT, author=_TEXT, title=_TEXT,
    body=_TEXT, selftext=_TEXT, text=_TEXT, permalink=_TEXT, score=_TEXT, parent_id=_TEXT,
    created_utc=_TEXT, created=_TEXT, timestamp=_TEXT,
)

RAW_MESSAGE = _struct(
    id=_TEXT, type=_TEXT, subreddit=_TEXT, author=_TEXT, brand=_TEXT, title=_TEXT, body=_TEXT,
    permalink=_TEXT, score=_LONG, parent_id=_TEXT, created_utc=_DOUBLE, ingested_at=_DOUBLE,
)

SCORED_MESSAGE = StructType(
    RAW_MESSAGE.fields + _struct(text=_TEXT, label=_TEXT, neg_prob=_DOUBLE).fields
)

# Aggregates and alerts in flight: epoch seconds and doubles.
AGGREGATE = _struct(
    brand=_TEXT, window_start=_DOUBLE, window_end=_DOUBLE, volume=_LONG, neg_count=_LONG,
    neg_ratio=_DOUBLE, avg_neg_prob=_DOUBLE, unique_authors=_LONG, influencer_neg=_DOUBLE,
    sample_text=_TEXT,
)

ALERT = _struct(
    brand=_TEXT, triggered_at=_DOUBLE, window_start=_DOUBLE, window_end=_DOUBLE, z_score=_DOUBLE,
    neg_ratio=_DOUBLE, volume=_LONG, severity=_TEXT, sample_text=_TEXT,
)

# The same records at rest: UTC timestamps, 32-bit ratios.
AGGREGATE_TABLE = _struct(
    brand=_TEXT, window_start=_TIME, window_end=_TIME, volume=_LONG,
    neg_count=_LONG, neg_ratio=FloatType(), avg_neg_prob=FloatType(),
    unique_authors=_LONG, influencer_neg=FloatType(),
)

ALERT_TABLE = _struct(
    id=_LONG, brand=_TEXT, triggered_at=_TIME, window_start=_TIME, window_end=_TIME,
    z_score=FloatType(), neg_ratio=FloatType(), volume=_LONG, severity=_TEXT,
    sample_text=_TEXT,
)

CORPUS = _struct(text=_TEXT, label=_TEXT, source=_TEXT)
