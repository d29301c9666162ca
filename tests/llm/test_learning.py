"""Classifiers: accuracy on texts held out, fixed parts against plain versions, odd inputs."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import hilbert, langid, quality, toxicity

SYLLABLES = {"aa": ["ka", "lo", "mi", "tur", "en"], "bb": ["sch", "eit", "ung", "ver", "ö"],
             "cc": ["ción", "lla", "ez", "que", "ar"]}


def sentence(rng, lang="aa", words=40, more=()):
    out = ["".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(words)]
    for w in more:
        out.insert(rng.randint(0, len(out)), w)
    return " ".join(out)


@pytest.fixture(scope="module")
def corpus(spark):
    """Texts in three languages, some junk, some with insults; labels for most."""
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(420):
        lang = rng.choice(list(SYLLABLES))
        good, toxic = rng.random() < 0.7, rng.random() < 0.25
        stem = {"aa": "grobu", "bb": "pfuisch", "cc": "chonta"}[lang]
        more = [stem + rng.choice(["", "ra", "ren", "lo"]) for _ in range(3)] if toxic else []
        text = sentence(rng, lang, rng.randint(20, 60), more)
        if not good:
            text = "".join(w + rng.choice(["*** ", "$$$ "]) for w in text.split(" "))
        rows.append((i, text, lang))
        if i % 10:
            labels.append((i, int(good), int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), rows, labels


ODD = [(None, "ka lo mi", None), (-1, None, None), (-1, None, None), (-2, "", None), (-3, " \n 12", None),
       (-4, "ka", "aa"), (-5, "lo mi ka " * 30_000, "aa")]


def held_out(doc_id, divisor, rest):
    text = "" if doc_id is None else str(doc_id)
    return zlib.crc32(text.encode()) % divisor == rest


@pytest.mark.parametrize(("operator", "label", "divisor", "rest"),
                         [(quality, "quality", 4, 2), (toxicity, "toxic", 3, 1)])
def test_labels_are_learnt(spark, corpus, operator, label, divisor, rest):
    docs, labels, _, known = corpus
    odd = spark.createDataFrame(ODD, docs.schema)
    table = docs.union(odd).withColumns({"score": F.lit("x"), "label": F.lit(3), "predicted": F.lit(None)})
    noise = spark.createDataFrame([(1, None, None), (None, 1, 1), (2, 7, 7)], labels.schema)
    rows = operator.predictions(table, labels.union(noise)).collect()
    assert len(rows) == 427
    truth = {i: dict(quality=q, toxic=t)[label] for i, q, t in known}
    tested = [r for r in rows if r["doc_id"] in truth and r["held_out"]]
    assert np.mean([(r["score"] >= 0.5) == truth[r["doc_id"]] for r in tested]) > 0.9
    for r in rows:
        assert r["held_out"] == held_out(r["doc_id"], divisor, rest)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7)
    twice = [r["score"] for r in rows if r["doc_id"] == -1]
    assert len(twice) == 2 and twice[0] == twice[1]


@pytest.mark.parametrize(("operator", "label"), [(quality, "quality"), (toxicity, "toxic")])
def test_without_labels_or_documents(spark, corpus, operator, label):
    docs, labels, _, _ = corpus
    few, none = docs.limit(20), labels.limit(0)
    assert operator.predictions(few, none).count() == 20
    assert operator.predictions(docs.limit(0), labels).count() == 0
    same = labels.withColumn(label, F.lit(1))
    assert operator.predictions(few, same).count() == 20


def test_languages_are_told_apart(spark, corpus):
    docs, _, rows, _ = corpus
    table = docs.union(spark.createDataFrame(ODD, docs.schema)).withColumn("lang_pred", F.lit("x"))
    got = langid.predictions(table).collect()
    truth = {i: lang for i, _, lang in rows}
    tested = [r for r in got if r["doc_id"] in truth and r["held_out"]]
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in tested]) > 0.97
    for r in got:
        assert r["held_out"] == held_out(r["doc_id"], 3, 1) and 0 <= r["score"] <= 1
    odd = {r["doc_id"]: r["lang_pred"] for r in got if r["doc_id"] is None or r["doc_id"] < 0}
    assert odd == {None: "aa", -1: "und", -2: "und", -3: "und", -4: "aa", -5: "aa"}
    unknown = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in langid.predictions(unknown).select("lang_pred").distinct().collect()} == {"und"}
    one = docs.withColumn("lang", F.lit("aa"))
    assert {r["lang_pred"] for r in langid.predictions(one).select("lang_pred").distinct().collect()} == {"aa"}
    assert langid.predictions(docs.limit(0)).count() == 0


def test_codewords_are_far_apart():
    for classes in (2, 3, 4, 6, 7, 30):
        code = langid.codewords(classes)
        assert code.shape[0] == classes and set(np.unique(code)) == {-1, 1}
        apart = (code.shape[1] - code @ code.T) // 2 + 999 * np.eye(classes, dtype=int)
        assert apart.min() >= max(1, code.shape[1] // 4)
        assert (code != code[0]).any(axis=0).all()  # no classifier without two sides


def test_gram_counts_match_a_plain_version():
    text = "Ab  c1dé"
    grams = [" ab c dé "[i:i + n] for n in (1, 2, 3) for i in range(10 - n)]
    assert langid.gram_counts(text).sum() == len([g for g in grams if g])
    assert langid.gram_counts("12 3") is None
    assert (langid.gram_counts("AB") == langid.gram_counts("1ab--")).all()


def test_contexts_match_a_plain_sum():
    rng = np.random.default_rng(0)
    buckets = rng.integers(0, 50, 700)
    index = quality.index_vectors()
    total = np.zeros((quality.BUCKETS + 1, quality.SIZE))
    block, quality.BLOCK = quality.BLOCK, 64
    try:
        quality._add_contexts(total, buckets, index)
    finally:
        quality.BLOCK = block
    want = np.zeros_like(total)
    for i, b in enumerate(buckets):
        for j in range(max(0, i - 2), min(len(buckets), i + 3)):
            if j != i:
                want[b] += index[buckets[j]]
    assert np.allclose(total[:-1], want[:-1])
    assert (np.abs(index[:-1]).sum(axis=1) == quality.NONZERO).all()


def test_pooling_is_the_same_in_blocks(monkeypatch):
    rng = np.random.default_rng(1)
    vectors = rng.standard_normal((quality.BUCKETS + 1, quality.SIZE)).astype(np.float32)
    text = " ".join(str(rng.integers(0, 999)) for _ in range(300)).encode()
    whole = quality.pooled(text, vectors)
    monkeypatch.setattr(quality, "BLOCK", 37)
    assert np.allclose(whole, quality.pooled(text, vectors), atol=1e-5)


def test_the_label_model_weighs_voters_and_shares_correlated_evidence():
    rng = np.random.default_rng(3)
    truth = rng.random(6000) < 0.3
    sure = np.where(rng.random(6000) < 0.9, truth, ~truth) * 2 - 1
    weak = np.where(rng.random(6000) < 0.6, truth, ~truth) * 2 - 1
    votes = np.stack([sure, weak, weak, weak], axis=1)
    patterns, count = np.unique(votes, axis=0, return_counts=True)
    model = toxicity.fit_labels(patterns, count.astype(float), votes[:300], truth[:300].astype(int))
    assert model.share[0] > 0.8 and np.allclose(model.share[1:], 1 / 3, atol=0.05)
    told = np.log(model.chances[1] / model.chances[0])[:, 2]
    assert told[0] > told[1] > 0
    assert np.mean((model.posterior(votes) > 0.5) == truth) > 0.85


def test_hilbert_keys_visit_every_cell_by_single_steps():
    for axes, bits in ((2, 4), (3, 3)):
        side = 1 << bits
        cells = np.stack(np.meshgrid(*[np.arange(side)] * axes), axis=-1).reshape(-1, axes)
        keys = hilbert.hilbert_keys(cells, bits)
        assert sorted(keys) == list(range(side ** axes))
        path = cells[np.argsort(keys)]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_nearest_matches_brute_force(spark):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((700, 6)).astype(np.float32)
    x[100:300] = x[100]  # a very common vector
    rows = [(i, [float(a) for a in v]) for i, v in enumerate(x)]
    odd = [(None, [1.0] * 6), (1000, None), (1001, [0.0] * 6), (1002, [float("nan")] * 6), (1003, []),
           (1004, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (1005, [float("inf")] * 6), (1010, [1.0, 2.0]), (1020, [1.0, 3.0])]
    df = spark.createDataFrame(rows + rows[:50] + odd, "vec_id long, embedding array<float>").repartition(3)
    df = df.withColumns({"rank": F.lit(1), "score": F.lit("s"), "rep": F.lit(0)})
    got = {}
    for r in hilbert.nearest(df, F.col("id") % 10 == 0, window=400).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == {*range(0, 700, 10), 1010, 1020}
    assert [(v, s) for _, v, s in got[1010]] == [(1020, 1.0)] and len(got[1020]) == 1
    found = 0
    for q in range(0, 700, 10):
        d = np.sqrt(((x.astype(np.float64) - x[q].astype(np.float64)) ** 2).sum(1))
        want = [i for i in np.lexsort((np.arange(700), d)) if i != q][:10]
        mine = sorted(got[q])
        assert [k for k, _, _ in mine] == list(range(1, 11))
        assert np.allclose([s for _, _, s in mine], d[[v for _, v, _ in mine]], rtol=0, atol=1e-12)
        assert [(s, v) for _, v, s in mine] == sorted((s, v) for _, v, s in mine)
        found += len({v for _, v, _ in mine} & set(want))
        if 100 <= q < 300:
            assert [v for _, v, _ in mine] == want
    assert found / 700 > 0.98
    assert hilbert.nearest(df.limit(0), F.col("id") % 10 == 0).count() == 0


def test_window_grows_with_the_table(spark, monkeypatch):
    assert hilbert.window_for(100) == hilbert.window_for(51_282) == hilbert.WINDOW
    for rows in (500_000, 100_000_000):
        assert hilbert.CURVES * 2 * hilbert.window_for(rows) >= hilbert.SHARE * rows
    # The rule at windows far below the number of rows. So small a table needs a larger share than
    # those of 100,000 rows and more, for which ``WINDOW`` is not enough.
    monkeypatch.setattr(hilbert, "WINDOW", 1)
    monkeypatch.setattr(hilbert, "SHARE", 0.7)
    n = 12_000
    assert hilbert.window_for(n) < n / 130
    x = np.random.default_rng(4).standard_normal((n, 64)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {}
    for r in hilbert.nearest(df, F.col("id") % 200 == 0).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    found = [len(got[q] & set(np.argsort(((x - x[q]) ** 2).sum(1))[1:11].tolist())) for q in range(0, n, 200)]
    assert np.mean(found) / 10 >= 0.9


def test_range_sample_orders_few_rows(spark, monkeypatch):
    monkeypatch.setattr(hilbert, "SAMPLE", 50)
    x = np.random.default_rng(6).standard_normal((3000, 4)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist(), 4) for i, v in enumerate(x)], "rep long, v array<float>, n int")
    seen = []
    monkeypatch.setattr(hilbert, "Curves", lambda sample, curves: seen.append(sample))
    ranked = []
    where = type(df).withColumn
    monkeypatch.setattr(type(df), "withColumn", lambda self, name, c: (
        ranked.append(self.count()) if name == "k" else None, where(self, name, c))[1])
    hilbert.fit(df, 1)
    want = df.orderBy(F.xxhash64("v"), "rep").limit(50).collect()
    assert sorted(map(tuple, seen[0].tolist())) == sorted(tuple(r["v"]) for r in want)
    assert 50 <= ranked[0] < 100
