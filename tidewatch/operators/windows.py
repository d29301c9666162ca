"""Per-brand aggregates over sliding event-time windows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch import session
from tidewatch.functions.numbers import epoch_millis, epoch_seconds, reach_weight, round_even
from tidewatch.functions.text import SAMPLE_LIMIT
from tidewatch.operators.messages import brand_key

# Probabilities and reach are added up as whole billionths, so that a sum does not depend on row
# order, in decimals, so that no number of messages is too large for it.
_PARTS = 1e9
_SUM = "decimal(38,0)"
# Bits of a packed place that hold milliseconds: windows of up to 99 days.
_TIME_BITS = 33
_SUMS = ("volume", "neg", "prob", "reach")


def _prob() -> Column:
    return F.coalesce(F.col("neg_prob"), F.lit(0.0))


def _sums() -> dict[str, Column]:
    """What is added up of a message."""
    return {
        "volume": F.lit(1),
        "neg": F.coalesce((F.col("label") == "neg").cast("int"), F.lit(0)),
        "prob": F.rint(_prob() * _PARTS).cast(_SUM),
        "reach": F.rint(_prob() * reach_weight("score") * _PARTS).cast(_SUM),
    }


def measures(time: str, text: str) -> dict[str, Column]:
    """What is added up, and the sample: most negative, then earliest, then smallest id."""
    return _sums() | {
        "sample": F.when(_prob() > 0, F.struct(
            (-_prob()).alias("order"), epoch_millis(time).alias("at"),
            F.col("id").cast("string").alias("id"),
            F.left(text, F.lit(SAMPLE_LIMIT)).alias("text"))),
    }


def _packed(parts: Column, offset: Column) -> Column:
    """One number that is smallest for the most negative, then the earliest message.

    ``parts`` are the billionths of its probability, ``offset`` the milliseconds since the
    start of the pane or window. A minimum of numbers stays in a hash aggregate, where one of
    structs or texts would need sorted rows.
    """
    return F.shiftleft(F.lit(int(_PARTS)).cast("bigint") - parts, _TIME_BITS) + offset


def _unpacked(place: Column) -> tuple[Column, Column]:
    parts = F.lit(int(_PARTS)).cast("bigint") - F.shiftright(place, _TIME_BITS)
    return parts, place.bitwiseAND(F.lit((1 << _TIME_BITS) - 1))


def window_aggregates(
    scored: DataFrame, window: int, slide: int, time: str = "event_time", text: str = "text",
    stored: bool = False,
) -> DataFrame:
    """One row per brand and window that holds a message; ``window`` and ``slide`` in seconds.

    ``scored`` has ``brand, id, author, score, label, neg_prob``, a text and an event time.
    A table is read with few columns each for measures, authors and the samples' texts. Rows that
    are not ``stored`` yet are written first, so that they are computed once. Streams go through
    ``streaming.windows.aggregate_stream``.
    """
    if not stored:
        scored = session.stored(scored.select(
            "brand", "id", "author", "score", "label", "neg_prob", time, text), "scored")
    return finish(_passes(scored, window, slide, time, text))


def _passes(scored: DataFrame, window: int, slide: int, time: str, text: str) -> DataFrame:
    """Measures, distinct authors and the texts of samples apart.

    The first two start from panes, the stretches in which no window begins or ends, so that no
    message is copied into every window it lies in, and both are combined on the map side before
    they are shuffled, also when one brand or one author has most messages. Measures are numbers
    only; which message is the sample is known by its probability and time, and its text is
    fetched once the windows are combined.
    """
    if window * 1000 >= 1 << _TIME_BITS:
        raise ValueError(f"windows of {window} seconds are too long")
    second = F.unix_seconds(F.col(time).cast("timestamp"))
    step = math.gcd(window, slide)
    pane = F.col("pane")
    keyed = scored.where(F.col(time).isNotNull()).withColumns({
        "brand": brand_key(), "pane": _floor(second, step)})
    at, parts = epoch_millis(time), F.rint(_prob() * _PARTS).cast("bigint")

    sums = {name: c.alias(name) for name, c in _sums().items()}
    place = F.when(_prob() > 0, _packed(parts, at - pane * 1000)).alias("place")
    added = [F.sum(c).alias(c) for c in _SUMS]
    panes = keyed.select("brand", "pane", *sums.values(), place).groupBy("brand", "pane").agg(
        *added, F.min("place").alias("place"))
    starts = F.sequence(_after(pane - window, slide), _floor(pane, slide), F.lit(slide).cast("bigint"))
    totals = panes.select("brand", "pane", F.explode(starts).alias("start"), *_SUMS, "place").withColumn(
        "place", F.col("place") + (pane - F.col("start")) * 1000).groupBy("brand", "start").agg(
        *added, F.min("place").alias("place"))

    # An author seen in a pane is in the windows that start from after (pane - window) up to the
    # pane. Those that start no later than the author's previous pane hold the author already.
    # What is left begins and ends once, and a running sum over the window starts counts it.
    seen = keyed.where("author <> ''").select("brand", "author", "pane").distinct().withColumn(
        "previous", F.lag("pane").over(Window.partitionBy("brand", "author").orderBy("pane")))
    new = seen.select("brand", F.inline(F.array(
        F.struct(_after(F.greatest("previous", pane - window), slide).alias("start"), F.lit(1).alias("change")),
        F.struct(_after(pane, slide).alias("start"), F.lit(-1).alias("change")))))
    changes = new.groupBy("brand", "start").agg(F.sum("change").alias("change"))

    # From here on there is one row per brand and window start at most.
    held = (*_SUMS, "place")
    both = totals.select("brand", "start", F.lit(0).cast("bigint").alias("change"), *held).unionByName(
        changes, allowMissingColumns=True)
    merged = both.groupBy("brand", "start").agg(
        F.sum("change").alias("change"), *[F.max(c).alias(c) for c in held])
    upto = Window.partitionBy("brand").orderBy("start").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    best, offset = _unpacked(F.col("place"))
    counted = merged.withColumn("authors", F.sum("change").over(upto)).where(
        F.col("volume").isNotNull()).select(
        "brand", *_SUMS, "authors", best.alias("best"), (F.col("start") * 1000 + offset).alias("at"),
        F.struct(F.timestamp_seconds("start").alias("start"),
                 F.timestamp_seconds(F.col("start") + window).alias("end")).alias("window"))

    # Messages of one probability, brand and time: the smallest id.
    wanted = panes.where("place IS NOT NULL")
    best, offset = _unpacked(F.col("place"))
    wanted = wanted.select("brand", best.alias("best"), (pane * 1000 + offset).alias("at"))
    sample = F.struct(
        F.col("id").cast("string").alias("id"), F.left(text, F.lit(SAMPLE_LIMIT)).alias("text"))
    texts = (
        keyed.where(_prob() > 0).select("brand", parts.alias("best"), at.alias("at"), sample.alias("sample"))
        .join(wanted, ["brand", "best", "at"], "left_semi")
        .groupBy("brand", "best", "at").agg(F.min("sample").alias("sample")))
    return counted.join(texts, ["brand", "best", "at"], "left")


def _floor(second: Column, step: int) -> Column:
    """The last multiple of ``step`` that is not after ``second``."""
    return second - F.pmod(second, F.lit(step))


def _after(second: Column, step: int) -> Column:
    """The first multiple of ``step`` after ``second``."""
    return _floor(second, step) + step


def finish(totals: DataFrame) -> DataFrame:
    return totals.select(
        "brand",
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        F.col("volume"),
        F.col("neg").alias("neg_count"),
        round_even("neg / volume").alias("neg_ratio"),
        round_even(f"prob / {_PARTS}D / volume").alias("avg_neg_prob"),
        F.col("authors").alias("unique_authors"),
        round_even(f"reach / {_PARTS}D").alias("influencer_neg"),
        F.col("sample.text").alias("sample_text"),
    )


def as_stream_record(aggregates: DataFrame) -> DataFrame:
    """Window bounds as epoch seconds, the form aggregates travel in."""
    return aggregates.withColumns({
        "window_start": epoch_seconds("window_start"), "window_end": epoch_seconds("window_end")})
