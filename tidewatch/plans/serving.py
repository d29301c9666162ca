"""Queries on the stored aggregates and alerts."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.numbers import round_even

# Columns of the answers, default of the minutes, headlines, their text and signs.
SERIES = ("window_start", "window_end", "volume", "neg_count", "neg_ratio", "avg_neg_prob",
          "unique_authors", "influencer_neg")
ALERTS = ("id", "brand", "triggered_at", "window_start", "window_end", "z_score", "neg_ratio",
          "volume", "severity", "sample_text")
RECENT = ("triggered_at", "brand", "severity", "z_score", "neg_ratio", "volume", "sample_text")
MINUTES = 120
HEADLINES = 10
HEADLINE = "%s **%s** — z=%.2f, neg_ratio=%.2f, volume=%d"
SIGNS = {"low": "🟡", "medium": "🟠", "high": "🔴", "critical": "🚨"}
OTHER_SIGN = "⚠️"


def _now(as_of: datetime.datetime | str | None) -> Column:
    return F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")


def brands(aggregates: DataFrame) -> DataFrame:
    return aggregates.select("brand").distinct().orderBy("brand")


def series(
    aggregates: DataFrame, brand: str, minutes: int = MINUTES, as_of=None
) -> DataFrame:
    """A brand's windows that start in the last ``minutes`` before ``as_of`` (now), in order."""
    if minutes < 1:
        raise ValueError("minutes must be at least 1")
    since = _now(as_of) - F.make_dt_interval(mins=F.lit(minutes))
    recent = (F.col("brand") == brand) & (F.col("window_start") >= since)
    if "window_date" in aggregates.columns:
        recent &= F.col("window_date") >= since.cast("date")
    return aggregates.where(recent).select(*SERIES).orderBy("window_start")


def alerts(
    stored: DataFrame, active: bool = False, limit: int | None = None, as_of=None
) -> DataFrame:
    """The alerts, newest first; only those of the last hour if ``active``.

    All of them, or the first ``limit``.
    """
    if limit is not None and limit < 1:
        raise ValueError("limit must be at least 1")
    if active:
        since = _now(as_of) - F.make_dt_interval(hours=F.lit(1))
        stored = stored.where(F.col("triggered_at") >= since)
        if "triggered_date" in stored.columns:
            stored = stored.where(F.col("triggered_date") >= since.cast("date"))
    ordered = stored.select(*ALERTS).orderBy(F.desc("triggered_at"), "id")
    return ordered if limit is None else ordered.limit(limit)


def headlines(active_alerts: DataFrame, most: int = HEADLINES) -> DataFrame:
    """The first active alerts as a line of text each."""
    signs = F.create_map(*[F.lit(x) for pair in SIGNS.items() for x in pair])
    sign = F.coalesce(F.try_element_at(signs, F.col("severity")), F.lit(OTHER_SIGN))
    text = F.format_string(
        HEADLINE, sign, "brand",
        round_even("z_score", 2), round_even("neg_ratio", 2), "volume")
    return (
        active_alerts.orderBy(F.desc("triggered_at"), "id").limit(most)
        .select("id", "triggered_at", text.alias("headline"), "sample_text")
    )


def recent_alerts(latest: DataFrame) -> DataFrame:
    return latest.select(*RECENT)


def trend(brand_series: DataFrame) -> DataFrame:
    """The two charts of a brand in long form: one row per window and measure."""
    measures = [F.struct(F.lit(chart).alias("chart"), F.lit(name).alias("measure"),
                         F.col(name).cast("double").alias("value"))
                for chart, name in (("counts", "volume"), ("counts", "neg_count"),
                                    ("ratios", "neg_ratio"), ("ratios", "avg_neg_prob"))]
    return brand_series.select("window_start", F.inline(F.array(*measures)))


def window_count(brand_series: DataFrame) -> DataFrame:
    return brand_series.agg(F.count("*").alias("windows"))
