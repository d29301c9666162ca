import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewatch.functions import numbers, sentiment, text
from tidewatch.functions.lexicon import Lexicon, load_lexicon, load_phrases


def test_round_even_is_the_rounding_of_the_binary_value(one):
    draw = random.Random(7)
    values = [draw.random() for _ in range(5000)] + [i / 20000 for i in range(5000)]
    values += [i / 32 for i in range(200)] + [0.00015, -0.00015, 0.0, 2.5, -1.00005]
    for places in (2, 3, 4):
        got = one(lambda x, p=places: numbers.round_even(x, p), values, "double")
        assert got == [round(v, places) for v in values]


def test_first_present_keeps_zero_and_skips_empty(spark):
    rows = spark.createDataFrame(
        [("", "0", "x"), (None, None, "x"), (None, "", "")], "a string, b string, c string")
    got = rows.select(numbers.first_present("a", "b", "c", default=F.lit("d"))).collect()
    assert [r[0] for r in got] == ["0", "x", "d"]


def test_lenient_numbers(one):
    texts = ["3.7", "-3.9", "x", "", None, "0", "inf", "nan", " 12 ", "1d", "0x1", "1e3", ".5", "-"]
    assert one(numbers.lenient_long, texts) == [3, -3, 0, 0, 0, 0, 0, 0, 12, 0, 0, 1000, 0, 0]
    doubles = one(numbers.lenient_double, texts)
    assert doubles[0] == 3.7 and doubles[6] == float("inf") and doubles[9:13] == [0, 0, 1000, 0.5]


def test_times(one):
    got = one(lambda x: numbers.epoch_millis(numbers.event_time(x)), [1.5, 0.0, 1700000000.1239, None], "double")
    assert got == [1500, 0, 1700000000123, None]
    assert one(lambda x: numbers.epoch_seconds(numbers.from_epoch_seconds(x)), [12.25], "double") == [12.25]


def test_reach_weight(one):
    got = one(numbers.reach_weight, [-4, 0, None, 1], "bigint")
    assert got[:3] == [0, 0, 0] and got[3] == pytest.approx(0.6931471805599453)


def test_cleaning_order_and_white_space(one):
    texts = ["see https://a.b/c, now", "**bold** _it_ >q ~s~ `c`", "a\u00a0\u2003b\x1cc\n d", "  ",
             "https://x"]
    assert one(lambda x: text.clean(F.col(x)), texts) == ["see now", "bold it q s c", "a b c d", "", ""]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(alphabet=" ab\t\n\u00a0\u2028\x85*_>~`h:/tps", max_size=30), min_size=1, max_size=20))
def test_cleaning_matches_a_plain_version(spark, texts):
    import re

    def plain(t):
        t = re.sub(r"https?://\S+", " ", t)
        return " ".join(re.sub(r"[*_>~`]+", " ", t).split())

    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string")
    got = [r[0] for r in df.orderBy("i").select(text.clean(F.col("x"))).collect()]
    assert got == [plain(t) for t in texts]


def test_bots(one):
    names = ["AutoModerator", " robot ", "x_BOT", "botanist", "bot2", None, "", "  "]
    assert one(text.is_bot, names) == [True, True, True, False, False, False, False, False]


def polarity(spark, texts, lexicon=None):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = sentiment.with_polarity(df, "t", lexicon or Lexicon()).orderBy("i").collect()
    return [r["polarity"] for r in rows]


def compound(total):
    return round(total / (total * total + 15) ** 0.5, 4)


def test_polarity_rules(spark):
    cases = {
        "this is good": 1.9,
        "this is very good": 1.9 + 0.293,
        "very much really good": (1.9 + 0.293) + 0.293 * 0.9,
        "this is somewhat bad": -2.5 + 0.293,
        "this is not good": 1.9 * -0.74,
        "isn't that good": 1.9 * -0.74,
        "this is GOOD": 1.9 + 0.733,
        "THIS IS GOOD": 1.9,
        "this VERY good": 1.9 + 0.293 + 0.733,
        "bad but good": -2.5 * 0.5 + 1.9 * 1.5,
        "bad, but good.": -2.5 * 0.5 + 1.9 * 1.5,
        "good thing!!": 1.9 + 2 * 0.292,
        "good thing!!!!!!": 1.9 + 4 * 0.292,
        "bad thing??": -2.5 - 2 * 0.18,
        "bad thing?????": -2.5 - 0.96,
        "\"good\" (good) good... a.good": 0.0,
        "good bad": 1.9 - 2.5,
        "nothing to see": 0.0,
    }
    got = polarity(spark, list(cases))
    assert {t: p["compound"] for t, p in zip(cases, got)} == {
        t: compound(total) for t, total in cases.items()}


def plain_polarity(text, lexicon):
    """The published rules by a plain loop over the words, without marks and capitals."""
    words = [w for w in text.lower().split() if len(w) > 1]
    total = 0.0
    for i, word in enumerate(words):
        if word not in lexicon.scored:
            continue
        v = lexicon.valences[word]
        at = lambda d: words[i - d] if i >= d else None
        for d in (1, 2, 3):
            if at(d) is None or at(d) in lexicon.valences:
                continue
            v += (1, 0.95, 0.9)[d - 1] * lexicon.degrees.get(at(d), 0) * (-1 if v < 0 else 1)
            so = lexicon.turns.so
            strong = d == 2 and at(2) == "never" and at(1) in so or d == 3 and (
                at(3) == "never" and at(2) in so or at(1) in so)
            kept = d > 1 and at(d) == "without" and "doubt" in [at(n) for n in range(1, d)]
            negates = at(d) in lexicon.negators or "n't" in at(d)
            v *= 1.25 if strong else 1 if kept else -0.74 if negates else 1
            if d == 3:
                seen = [[1, 0], [2, 1, 0], [2, 1], [3, 2, 1], [3, 2]]
                phrases = [" ".join(at(n) for n in p) for p in seen]
                v = next((lexicon.phrases[p] for p in phrases if p in lexicon.phrases), v)
                for n in (2, 3):
                    own = " ".join(words[i:i + n])
                    v = lexicon.phrases.get(own, v) if len(words) >= i + n else v
                v += sum(lexicon.degrees.get(phrases[k], 0) for k in (3, 4, 2))
        if at(1) == "least" and at(1) not in lexicon.valences and at(2) not in ("at", "very"):
            v *= -0.74
        total += v
    return total / (total * total + 15) ** 0.5


def test_phrases_and_turned_words(spark):
    lexicon = Lexicon(
        valences={"good": 1.9, "bad": -2.5, "bomb": -2.2, "die": -2.9, "ass": -2.5, "broken": -2.1, "heart": 0.5},
        degrees={"very": 0.293, "sort of": -0.293, "kind of": -0.293})
    rng = random.Random(5)
    pool = ["good", "bad", "bomb", "die", "ass", "broken", "heart", "the", "to", "for", "least", "at", "very",
            "never", "so", "this", "without", "doubt", "not", "isn't", "sort", "kind", "of", "day", "night"]
    texts = [" ".join(rng.choice(pool) for _ in range(rng.randint(1, 9))) for _ in range(1500)]
    texts += ["this is the bomb", "we think it was to die for", "it is the least good", "it is at least good",
              "it was never so good", "day night broken heart", "day it is sort of good"]
    got = [p["compound"] for p in polarity(spark, texts, lexicon)]
    assert got == pytest.approx([plain_polarity(t, lexicon) for t in texts], abs=6e-5)
    assert len(set(got)) > 200


def test_phrases_from_a_file(tmp_path):
    path = tmp_path / "phrases.txt"
    path.write_text("Kiss  of death\t-1.5\tmore\nno valence\n")
    assert load_phrases(path) == {"kiss of death": -1.5}


def test_polarity_shares_and_empty_texts(spark):
    good, empty, none, short = polarity(spark, ["good bad day", "", None, "a b"])
    mass = 2.9 + 3.5 + 1
    assert good.asDict() == {
        "compound": compound(-0.6), "neg": round(3.5 / mass, 3), "neu": round(1 / mass, 3),
        "pos": round(2.9 / mass, 3)}
    nothing = {"compound": 0.0, "neg": 0.0, "neu": 0.0, "pos": 0.0}
    assert empty.asDict() == none.asDict() == short.asDict() == nothing


def test_own_lexicon_with_signs_and_many_words(spark, tmp_path):
    path = tmp_path / "lexicon.txt"
    lines = [f"word{i}\t{i % 7 - 3}\t0.5\t[1, 2]" for i in range(8000)] + [":)\t2.0", "it's\t1.0"]
    path.write_text("\n".join(lines))
    lexicon = load_lexicon(path)
    texts = ["word10 word11", "aa :) it", "yes it's it", "Word4, word5!"]
    got = [p["compound"] for p in polarity(spark, texts, lexicon)]
    # 10 % 7 - 3 = 0 and 11 % 7 - 3 = 1; 4 - 3 = 1 and 5 - 3 = 2, one exclamation mark
    assert got == [compound(1.0), compound(2.0), compound(1.0), compound(3.0 + 0.292)]


def test_labels(spark, one):
    cut = one(lambda x: sentiment.label_of(F.col(x)), [-0.05, -0.049, 0.05, 0.049], "double")
    assert cut == ["neg", "neu", "pos", "neu"]
    weak = one(lambda x: sentiment.weak_label(F.col(x)), [-0.3, -0.29, 0.3, 0.29], "double")
    assert weak == ["neg", "neu", "pos", "neu"]
    assert one(lambda x: sentiment.confidence(F.col(x)), [-0.4, 0.0, 0.2], "double") == [0.4, 1.0, 0.2]
    prob = one(lambda x: sentiment.negative_probability(F.col(x), F.lit(0.5)), [-0.1, 0.0, 0.1], "double")
    assert prob == [0.5, 0.15, 0.15]


def test_severity_edges(one):
    got = one(lambda x: sentiment.severity(F.col(x)), [2.99, 3.0, 4.4999, 4.5, 5.99, 6.0], "double")
    assert got == ["low", "medium", "medium", "high", "high", "critical"]


def test_softmax_of_large_logits(spark):
    df = spark.createDataFrame([([1000.0, 1000.0, 999.0],)], "l array<double>")
    p = sentiment.softmax(F.col("l"))
    row = df.select(p.alias("p"), *[c.alias(n) for n, c in zip("abc", sentiment.class_scores(p))]).first()
    assert sum(row["p"]) == pytest.approx(1) and row["a"] == "neg" and row["b"] == row["c"]
