"""Sampling, splits, corpora, metrics and the gate."""

import hashlib

import pytest
from pyspark.sql import functions as F

from tidewatch.operators.dedupe import first_per_key
from tidewatch.operators.sampling import (
    exact_split,
    first_rows,
    hash_split,
    sample_rows,
    shuffle_rows,
    with_position,
)
from tidewatch.plans import corpus, quality
from tidewatch.sinks import reports
from tidewatch.sources.tables import public_corpus


def in_order(n, seed=42):
    return sorted(range(n), key=lambda i: hashlib.md5(f"{seed}:{i}".encode()).hexdigest())


@pytest.mark.parametrize("n", [0, 1, 2, 9, 10, 1000])
def test_exact_split(spark, n):
    got = exact_split(spark.range(n), "id").collect()
    order = in_order(n)
    a, b = int(n * 0.8), int(n * 0.8) + int(n * 0.1)
    want = {**{i: "train" for i in order[:a]}, **{i: "val" for i in order[a:b]}, **{i: "test" for i in order[b:]}}
    assert {r["id"]: r["split"] for r in got} == want


def test_exact_split_when_many_rows_share_a_bucket(spark, monkeypatch):
    from tidewatch.operators import sampling

    monkeypatch.setattr(sampling, "_DIGITS", 1)
    got = exact_split(spark.range(3000), "id").groupBy("split").count().collect()
    assert dict(map(tuple, got)) == {"train": 2400, "val": 300, "test": 300}


def test_sample_and_shuffle(spark):
    for n in (0, 1, 137, 1000, 5000):
        got = {r["id"] for r in sample_rows(spark.range(1000), n, "id", seed=3).collect()}
        assert got == set(in_order(1000, 3)[:n])
    assert [r["id"] for r in shuffle_rows(spark.range(50), "id").collect()] == in_order(50)
    placed = with_position(spark.range(700), "id").orderBy("position").collect()
    assert [r["id"] for r in placed] == in_order(700) and [r["position"] for r in placed] == list(range(1, 701))
    assert [r["id"] for r in first_rows(spark.range(50), 3, F.desc("id")).collect()] == [49, 48, 47]


def test_splitting_sorts_nothing(spark):
    """Rows get their split by comparison: the table itself is neither sorted nor shuffled."""
    plan = exact_split(spark.range(1000), "id")._jdf.queryExecution().executedPlan().toString()
    main = plan.split("Subquery")[0]
    assert "Exchange" not in main and "Sort" not in main


def test_hash_split_is_about_right(spark):
    got = dict(map(tuple, hash_split(spark.range(20000), "id").groupBy("split").count().collect()))
    assert abs(got["train"] - 16000) < 300 and abs(got["val"] - 2000) < 200


def test_first_per_key_reduces_copies_before_the_shuffle(spark):
    rows = [("hot", i % 3, i) for i in range(300)] + [("x", 1, 500), ("x", 0, 501), (None, 0, 1)]
    df = spark.createDataFrame(rows, "text string, rank int, id int")
    once = first_per_key(df, "text", "rank", "id")
    assert sorted(map(tuple, once.collect())) == [("hot", 0, 0), ("x", 0, 501)]
    lines = once._jdf.queryExecution().executedPlan().toString().splitlines()
    exchange = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line)
    assert "partial_min" in lines[exchange + 1]


def records(spark):
    return spark.createDataFrame([
        (1, "  great phone, love it  ", None, "t"), (2, "", "terrible worthless thing", "t"),
        (3, None, "", "only a title"), (4, "short", None, None), (5, "12345678", None, None),
        (6, "   ", "not looked at", None), (7, "shared text", None, None), (8, "fine " + "x" * 600, None, None),
    ], "row_id int, body string, selftext string, title string")


def test_weak_corpus(spark):
    got = corpus.weak_corpus(records(spark), rows=None, keep=("row_id",)).orderBy("row_id").collect()
    assert [(r["row_id"], r["text"][:11], r["label"]) for r in got] == [
        (1, "great phone", "pos"), (2, "terrible wo", "neg"), (3, "only a titl", "neu"), (5, "12345678", "neu"),
        (7, "shared text", "neu"), (8, "fine xxxxxx", "neu")]
    assert len(got[-1]["text"]) == 512 and got[0]["text"] == "great phone, love it"
    assert {r["source"] for r in got} == {"reddit_weak"}
    first = corpus.weak_corpus(records(spark), ["row_id"], rows=2, keep=("row_id",))
    assert [r["row_id"] for r in first.orderBy("row_id").collect()] == [1, 2]


def test_build_and_write(spark, tmp_path):
    public = public_corpus(spark.createDataFrame(
        [(1, "shared text", 2), (2, "dupe", 0), (3, "dupe", 1), (4, None, 1)],
        "row_id int, text string, label int")).select("row_id", "text", "label", "source")
    weak = corpus.weak_corpus(records(spark), rows=None, keep=("row_id",))
    built = corpus.build_corpus(public, weak, "row_id")
    got = {r["text"]: (r["label"], r["source"]) for r in built.collect()}
    assert len(got) == 7 and got["shared text"] == ("pos", "public") and got["dupe"] == ("neg", "public")
    reports.write_corpus(built, str(tmp_path / "c"))
    stats = spark.read.json(str(tmp_path / "c" / "stats")).collect()
    assert {r["total"] for r in stats} == {7} and sum(r["label_count"] for r in stats) == 7
    sizes = {s: reports.read_split(spark, str(tmp_path / "c"), s).count() for s in ("train", "test")}
    assert sizes == {"train": 5, "test": 2}
    assert corpus.build_corpus(public, None, "row_id").count() == 2
    assert corpus.sample_public(public, 2, "row_id").count() == 2 and corpus.sample_public(public, None).count() == 4


def predictions(spark, pairs):
    return spark.createDataFrame(pairs, "label string, predicted string")


def test_metrics(spark):
    pairs = [("neg", "neg")] * 5 + [("neg", "pos")] * 2 + [("pos", "pos")] * 3 + [("neu", "pos")] + [("pos", "odd")]
    row = quality.metrics(predictions(spark, pairs)).first()
    f1 = {"neg": 10 / 12, "pos": 6 / 10, "neu": 0.0, "odd": 0.0}
    assert row["n"] == 12 and row["accuracy"] == pytest.approx(8 / 12)
    assert row["f1_macro"] == pytest.approx(sum(f1.values()) / 4)


def test_gate(spark, tmp_path):
    def judged(right, baseline):
        pairs = [("neg", "neg"), ("pos", "pos")] * right + [("neg", "pos"), ("pos", "neg")] * (1000 - right)
        return quality.gate(quality.metrics(predictions(spark, pairs)), baseline)

    path = str(tmp_path / "baseline")
    assert judged(800, None).first()["verdict"] == "first" and reports.write_baseline(judged(800, None), path)
    for right, verdict, save, code in (
            (795, "kept", False, 0), (789, "regression", False, 2), (800, "kept", False, 0), (810, "improved", True, 0)):
        result = judged(right, reports.read_baseline(spark, path))
        row = result.first()
        assert (row["verdict"], row["save"], row["exit_code"]) == (verdict, save, code)
        assert reports.write_baseline(result, path) is save
    assert reports.read_baseline(spark, path).first()["f1_macro"] == pytest.approx(0.81)
