"""Window aggregates and the detector, in batch."""

import datetime
import math
import random

import pytest
from pyspark.sql import functions as F

from tidewatch.config import Detection, Thresholds
from tidewatch.operators import spikes, windows
from tidewatch.streaming import detector

SCORED = ("id string, brand string, author string, score bigint, label string, neg_prob double, "
          "text string, event_time timestamp")


def at(second):
    return datetime.datetime.fromtimestamp(second, datetime.timezone.utc)


def messages(spark, rows):
    return spark.createDataFrame([(*r[:-1], at(r[-1])) for r in rows], SCORED)


SIX = [
    ("b", "acme", "ann", 3, "neg", 0.5, "first of the tie" + "x" * 300, 61.0),
    ("a", "acme", "bob", -7, "neg", 0.5, "same time, smaller id", 61.0),
    ("c", "acme", "ann", None, "pos", 0.0, "c", 70.0),
    ("d", "acme", "", 10, "neu", 0.25, "d", 80.0),
    ("e", "acme", None, 1, "neg", None, "e", 119.999),
    ("f", "", "cid", 0, "pos", 0.0, "f", 120.0),
]


@pytest.mark.parametrize("stored", [True, False])
def test_one_minute_windows(spark, stored):
    got = windows.as_stream_record(
        windows.window_aggregates(messages(spark, SIX), 120, 60, stored=stored))
    rows = [r.asDict() for r in got.orderBy("brand", "window_start").collect()]
    reach = round(0.5 * math.log1p(3) + 0.25 * math.log1p(10), 4)
    acme = {"brand": "acme", "volume": 5, "neg_count": 3, "neg_ratio": 0.6, "avg_neg_prob": 0.25,
            "unique_authors": 2, "influencer_neg": reach, "sample_text": "same time, smaller id"}
    assert [r for r in rows if r["brand"] == "acme"] == [
        {**acme, "window_start": 0.0, "window_end": 120.0},
        {**acme, "window_start": 60.0, "window_end": 180.0}]
    other = [r for r in rows if r["brand"] == "_"]
    assert [(r["window_start"], r["unique_authors"], r["sample_text"]) for r in other] == [
        (60.0, 1, None), (120.0, 1, None)]


def test_sample_is_cut_and_earliest(spark):
    rows = [("z", "a", "u", 1, "neg", 0.5, "early" + "y" * 300, 10.0), ("a", "a", "u", 1, "neg", 0.5, "late", 11.0)]
    got = windows.window_aggregates(messages(spark, rows), 60, 60).first()
    assert got["sample_text"] == ("early" + "y" * 300)[:280]


def brute(rows, window, slide):
    """Aggregates by plain loops over every row and window."""
    found = {}
    for id_, brand, author, score, label, prob, text, second in rows:
        start = int(second // slide) * slide
        while start > second - window:
            found.setdefault((brand, start), []).append((id_, author, score, label, prob, text, second))
            start -= slide
    out = {}
    for key, group in found.items():
        worst = min(((-g[4], int(g[6] * 1000), g[0], g[5]) for g in group if g[4] > 0), default=[None])
        out[key] = (
            len(group), sum(g[3] == "neg" for g in group), round(sum(g[3] == "neg" for g in group) / len(group), 4),
            round(sum(round(g[4] * 1e4) for g in group) / 1e4 / len(group), 4),
            len({g[1] for g in group if g[1]}), worst[-1])
    return out


@pytest.mark.parametrize("window, slide", [(300, 60), (150, 60), (60, 60), (100, 40)])
def test_both_plans_match_plain_loops(spark, window, slide):
    draw = random.Random(window + slide)
    rows = []
    for i in range(600):
        brand = "hot" if draw.random() < 0.5 else draw.choice("abc")
        author = draw.choice(["[deleted]"] * 5 + ["", None] + [f"u{j}" for j in range(40)])
        prob = draw.choice([0.0, 0.0, 0.1234, 0.5, 0.9])
        rows.append((str(i), brand, author, draw.randint(-5, 50), draw.choice(["neg", "neu", "pos"]), prob,
                     f"t{i}", draw.randint(0, 3_000_000) / 1000))
    want = brute(rows, window, slide)
    for stored in (True, False):
        got = windows.as_stream_record(windows.window_aggregates(
            messages(spark, rows), window, slide, stored=stored)).collect()
        assert {(r["brand"], r["window_start"]): (
            r["volume"], r["neg_count"], r["neg_ratio"], r["avg_neg_prob"], r["unique_authors"],
            r["sample_text"]) for r in got} == want


def test_messages_shrink_before_the_shuffle(spark):
    """Measures and authors are combined by hash before they are shuffled; texts are fetched late."""
    for stored in (True, False):
        df = windows.window_aggregates(messages(spark, SIX), 120, 60, stored=stored)
        lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
        keys = ("hashpartitioning(brand", "pane", "start", "author")
        after = [lines[i + 1] for i, line in enumerate(lines)
                 if "Exchange " + keys[0] in line and "best" not in line and any(k in line for k in keys[1:])]
        assert len(after) >= 4 and all("HashAggregate" in line for line in after)
        sorted_ = [line for line in lines if "SortAggregate" in line]
        assert sorted_ and all("min(struct(id" in line or "min(sample" in line for line in sorted_)


def test_windows_too_long_for_a_packed_place(spark):
    with pytest.raises(ValueError, match="too long"):
        windows.window_aggregates(messages(spark, SIX), 100 * 86400, 86400)


AGGREGATES = ("brand string, window_start timestamp, window_end timestamp, volume bigint, neg_count bigint, "
              "neg_ratio double, sample_text string")


def series(spark, counts, brand="acme", volume=100):
    rows = [(brand, at(60.0 * i), at(60.0 * i + 120), volume, c, c / volume, f"w{i}") for i, c in enumerate(counts)]
    return spark.createDataFrame(rows, AGGREGATES)


CALM = [3, 5, 4, 6, 3, 5, 4]
LENIENT = Thresholds(alpha=0.3, spike_k=3.0, min_volume=25, min_neg_ratio=0.2, cooldown_seconds=300)


def plain_scores(counts, alpha=0.3):
    """z-scores by the definition: moments over the windows before, warm after five."""
    out, mean, var = [], None, 0.0
    for n, x in enumerate(counts):
        std = math.sqrt(var)
        out.append((x - mean) / std if n >= 5 and std > 1e-6 else 0.0)
        if mean is None:
            mean = float(x)
        else:
            d = x - mean
            mean, var = mean + alpha * d, (1 - alpha) * (var + alpha * d * d)
    return out


def test_scores_follow_the_definition(spark):
    counts = CALM + [40, 41, 3, 50]
    got = spikes.score_windows(series(spark, counts), Detection(thresholds=LENIENT)).orderBy("window_start")
    assert [r["z_score"] for r in got.collect()] == pytest.approx(plain_scores(counts), abs=1e-12)


def test_burst_cooldown_and_alert_record(spark):
    calm, burst = CALM, [60, 20, 20, 20, 95]
    assert plain_scores(calm + burst)[11] > 3  # only the cooldown holds it back
    found = spikes.detect_spikes(series(spark, calm + burst), Detection(thresholds=LENIENT))
    rows = found.orderBy("window_end").collect()
    assert [r["window_start"].timestamp() for r in rows] == [7 * 60.0]
    alert = rows[0]
    z = plain_scores(calm + burst)[7]
    assert (alert["brand"], alert["volume"], alert["neg_ratio"], alert["severity"], alert["sample_text"]) == (
        "acme", 100, 0.6, "critical", "w7")
    assert alert["z_score"] == round(z, 4) and alert["triggered_at"] == alert["window_end"]


def test_second_alert_after_the_cooldown(spark):
    counts = CALM + [60, 90] + CALM * 4 + [90]
    short = Thresholds(0.3, 1.5, 25, 0.2, 120)
    got = spikes.detect_spikes(series(spark, counts), Detection(thresholds=short)).orderBy("window_end").collect()
    assert [int(r["sample_text"][1:]) for r in got] == [7, len(counts) - 1]


def test_nothing_from_constant_or_short_series(spark):
    eager = Detection(thresholds=Thresholds(0.3, 0.5, 1, 0.0, 0))
    both = series(spark, [7] * 30, "flat").unionByName(series(spark, [1, 50, 1, 99, 3], "short"))
    assert spikes.detect_spikes(both, eager).isEmpty()


def test_guardrails(spark):
    counts = CALM + [60]
    for limits in (Thresholds(0.3, 3.0, 101, 0.2, 0), Thresholds(0.3, 3.0, 25, 0.61, 0),
                   Thresholds(0.3, 99.0, 25, 0.2, 0)):
        assert spikes.detect_spikes(series(spark, counts), Detection(thresholds=limits)).isEmpty()
    edge = Thresholds(0.3, 3.0, 100, 0.6, 0)
    assert spikes.detect_spikes(series(spark, counts), Detection(thresholds=edge)).count() == 1


def test_per_brand_thresholds(spark):
    counts = CALM + [60]
    both = series(spark, counts, "a").unionByName(series(spark, counts, "b"))
    detection = Detection(thresholds=LENIENT, per_brand={"a": Thresholds(0.3, 3.0, 1000, 0.2, 300)})
    assert [r["brand"] for r in spikes.detect_spikes(both, detection).collect()] == ["b"]


def test_stream_state_is_carried_over_batches():
    windows_ = [(c, 9, 0.5, 60000 * n) for n, c in enumerate((CALM * 4)[:24])]
    limits = Thresholds(0.3, 1.0, 1, 0.1, 60)
    whole = detector.take_in(detector.Series(), windows_, limits)
    series_, scores, alerts = detector.Series(), [], []
    for part in (windows_[:5], windows_[5:13], [], windows_[13:]):
        series_, z, alert = detector.take_in(series_, part, limits)
        scores, alerts = scores + z, alerts + alert
    assert (series_, scores, alerts) == whole and any(alerts)
    assert scores[:6] == [0.0] * 5 + scores[5:6] and scores[5] != 0


@pytest.mark.parametrize("alpha", [0.3, 0.02, 0.95, 1.0, 0.0])
@pytest.mark.parametrize("block", [1, 7, 25])
def test_a_brand_cut_into_blocks_scores_as_a_whole(spark, alpha, block):
    """200 windows in 8 blocks of 25 and in other ways, with gaps in time, against the definition."""
    rng = random.Random(8)
    counts = [rng.choice([0, 1, 3, 7, 1000, 10**6]) if n % 50 < 30 else 5 for n in range(200)]
    limits = Thresholds(alpha, 0.5, 1, 0.0, 300)
    both = series(spark, counts).unionByName(series(spark, counts[7:90], "other"))
    got = spikes.score_windows(both.repartition(5), Detection(thresholds=limits, slide_seconds=60), block)
    for brand, own in (("acme", counts), ("other", counts[7:90])):
        rows = got.where(F.col("brand") == brand).orderBy("window_end").collect()
        want, _, flags = None, None, None
        windows_ = [(c, 100, c / 100, int(60000 * n + 120000)) for n, c in enumerate(own)]
        _, want, flags = detector.take_in(detector.Series(), windows_, limits)
        assert [r["z_score"] for r in rows] == pytest.approx(want, rel=1e-6, abs=1e-4)
        assert [r["alert"] for r in rows] == flags


def test_more_windows_than_a_block_has_time_for(spark):
    counts = [3, 9, 4, 40, 2, 8] * 30
    dense = Detection(thresholds=LENIENT, slide_seconds=3600)  # windows come 60 times as often
    rows = spikes.score_windows(series(spark, counts), dense, 4).orderBy("window_end").collect()
    assert [r["z_score"] for r in rows] == pytest.approx(plain_scores(counts), abs=1e-9)


def test_scoring_needs_no_python_per_window(spark):
    df = spikes.score_windows(series(spark, CALM * 9), Detection(thresholds=LENIENT), 8)
    plan = df._jdf.queryExecution().executedPlan().toString()
    # What Python sees are block totals and candidates for the cooldown.
    python = [line for line in plan.splitlines() if "InArrow" in line or "Python" in line]
    assert python and all("carried(" in line or "spaced(" in line for line in python)


def test_small_batches_and_many_brands_on_spark(spark):
    counts = CALM * 6 + [60]
    df = series(spark, counts, "b0")
    for i in range(1, 6):
        df = df.unionByName(series(spark, counts, f"b{i}"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = spikes.score_windows(df.orderBy(F.rand(1)), Detection(thresholds=LENIENT)).orderBy(
            "brand", "window_start").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert [r["z_score"] for r in got] == pytest.approx(plain_scores(counts) * 6, abs=1e-12)
