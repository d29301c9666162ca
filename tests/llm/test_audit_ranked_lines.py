"""Filter audit, ranked search and line de-duplication against plain versions."""

import math
import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from tidewatch.llm import audit, lines, ranked

DOCS = StructType([StructField("doc_id", LongType()), StructField("text", StringType()),
                   StructField("source", StringType())])
LABELS = StructType([StructField("doc_id", LongType()), StructField("quality", IntegerType()),
                     StructField("toxic", IntegerType())])
ITEMS = StructType([StructField("item_id", LongType()), StructField("text", StringType())])


def plain_audit(docs, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    texts = defaultdict(list)
    for i, text, _ in docs:
        if i is not None:
            texts[text or ""].append(i)
    by = defaultdict(list)
    for row, (i, text, source) in enumerate(docs):
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        by[source or ""].append((row, {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": i is not None and min(texts[text]) < i}))
    out = {}
    for part, rows in by.items():
        shapley = Counter()
        for order in permutations("ABCDE"):
            left = rows
            for step, x in enumerate(order, 1):
                stay = {r[0] for r in left}
                gone = [r for r in rows if r[0] not in stay]
                removed = [r for r in left if r[1][x]]
                left = [r for r in left if not r[1][x]]
                out[part, "".join(order), step] = [
                    len(left), len(removed), sum(r[1][x] for r in gone),
                    sum(r[1][x] and sum(r[1].values()) == 1 for r in rows),
                    sum(docs[r[0]][0] in good for r in removed), sum(docs[r[0]][0] in toxic for r in removed)]
                shapley[x] += len(removed)
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return out


def words(n, rng, upper=False):
    return " ".join(("W" if upper else "w") + str(rng.randrange(10**6)) for _ in range(n))


def test_audit(spark):
    rng = random.Random(1)
    texts = ["", None, "a # b", words(300, rng), words(300, rng, True), "same word " * 150,
             "É" * 30 + " A", words(250, rng) + " | x", "x y z " + words(199, rng), "A" * 5000]
    docs = [(n, texts[n % len(texts)], ["s1", None, "s2"][n % 3]) for n in range(40)]
    docs += [(3, texts[3], "s1"), (3, texts[3], "s1"), (None, texts[3], "s2"), (None, "alone", "s2")]
    labels = [(n, n % 2, int(n % 5 == 0)) for n in range(0, 30, 2)] + [(4, 1, None), (None, 1, 1), (3, None, 1)]
    df = spark.createDataFrame(docs, DOCS).repartition(5).withColumn("code", F.lit(1)).withColumn("part", F.lit(2))
    marks = spark.createDataFrame(labels, LABELS).withColumn("first", F.lit(1))
    got = {tuple(r)[:3]: list(r)[3:] for r in audit.audit(df, marks).collect()}
    want = plain_audit([tuple(d) for d in docs], labels)
    assert len(got) == 3 * 600
    assert got == want


def test_audit_of_an_empty_table(spark):
    empty = spark.createDataFrame([], DOCS)
    assert audit.audit(empty, spark.createDataFrame([], LABELS)).collect() == []


def test_packed_counters_do_not_overflow():
    many = (1 << 62) - 1
    n, counts = audit.unpacked(audit.packed(0b1111111) * many)
    assert n == many and counts.max() == many
    first = [k for k, order in enumerate(audit.ORDERS) if order[0] == "E"]
    assert (counts[[5 * k for k in first]] == [many, 0, many, many]).all()
    # The sum of two masks is the sum of their fields.
    a, b = audit.packed(3), audit.packed(28)
    assert (audit.unpacked(a + b)[1] == audit.unpacked(a)[1] + audit.unpacked(b)[1]).all()


def plain_search(docs, items, top=10):
    def terms(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub(
            "[A-Z]", lambda m: m[0].lower(), text or ""))

    counts = [(i, Counter(terms(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    total, n = sum(sum(c.values()) for _, c in counts), len(counts)
    df = Counter(t for _, c in counts for t in c)
    wanted = defaultdict(set)
    for item, text in items:
        wanted[item] |= set(terms(text))
    out = []
    for item, own in wanted.items():
        scores = []
        for i, c in counts:
            m = 10 + 90 * sum(c.values()) * n // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                        * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in own if t in c)
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(
            scores, key=lambda s: s[:3])[:top], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("more", [{}, {"block": 7}, {"bundle_items": 3, "block": 5}])
def test_ranked(spark, more):
    rng = random.Random(2)
    vocabulary = [f"t{int(rng.paretovariate(0.7)) % 90}" for _ in range(400)]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(40))) for _ in range(120)]
    texts += ["Ünï-CODE naïve_day", "ünï code", "İstanbul  x", None, "", "---", "t1 " * 5000]
    texts += ["t3 t5 unique"] * 25  # ties
    docs = list(enumerate(texts)) + [(130, "t3 t5 unique"), (None, "t3 t5 unique"), (None, "t7")]
    items = [(n, " ".join(rng.choice(vocabulary) for _ in range(12))) for n in range(8)]
    items += [(8, "t3 T5, UNIQUE"), (9, "ÜNÏ code day"), (10, ""), (11, None), (12, "not there"),
              (0, "t5 t5 more"), (None, "t1"), (13, "t3 t5 unique")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4).withColumn("block", F.lit(1))
    wanted = spark.createDataFrame(items, ITEMS).withColumn("term", F.lit("x"))
    got = sorted((tuple(r) for r in ranked.search(df, wanted, **more).collect()), key=str)
    assert got == plain_search(docs, items)


def test_ranked_of_empty_tables(spark):
    docs, items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], ITEMS)
    some = spark.createDataFrame([(1, "a b")], ITEMS)
    assert ranked.search(docs, some).collect() == []
    assert ranked.search(some.withColumnRenamed("item_id", "doc_id"), items).collect() == []


def plain_lines(docs):
    def key(line):
        k = re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))
        return k if len(k) >= 20 else None

    held = defaultdict(list)
    for i, text in docs:
        for k in {key(x) for x in (text or "").split("\n")} - {None}:
            held[k].append(i)
    keeper = {k: max(ids, key=lambda i: (i is not None, i or 0)) for k, ids in held.items() if len(ids) >= 3}
    out = []
    for i, text in docs:
        all_ = (text or "").split("\n")
        stay = [x for x in all_ if (k := key(x)) not in keeper or keeper[k] == i]
        out.append((i, "\n".join(stay), len(all_), len(all_) - len(stay)))
    return sorted(out, key=str)


def some_lines(seed, n):
    rng = random.Random(seed)
    pool = [f"a line that many documents hold number {k}" for k in range(30)]
    pool += ["Short", "", "  ", "ÄÖÜ" * 6 + "é", "ÄÖÜ" * 6 + "éé", "\x0bpadded line of twenty!!\r", "x\x85" + "y" * 19]
    pool += [f"Only {rng.random()} here and nowhere else" for _ in range(30)]
    return ["\n".join(rng.choice(pool).upper() if rng.random() < .1 else rng.choice(pool)
                      for _ in range(rng.randrange(12))) for _ in range(n)]


def rows(df):
    return sorted((tuple(r) for r in df.select("doc_id", "kept", "n_lines", "n_dropped").collect()), key=str)


def test_lines(spark, frame):
    texts = some_lines(3, 80)
    docs = [*enumerate(texts), (200, None), (201, ""), (202, "\n\n"), (5, texts[5]), (5, texts[5]), (5, "new"),
            (None, texts[7]), (None, None), (203, "the same long line again\n" * 3000)]
    docs += [(300 + n, "the same long line again\nThe Same LONG line again ") for n in range(40)]
    df = frame(docs, row=F.lit(1), key=F.lit(2), shard=F.lit(3))
    assert rows(lines.deduplicated(df)) == plain_lines(docs)
    assert lines.deduplicated(frame([])).collect() == []


def test_lines_come_and_go(spark, frame):
    texts = some_lines(4, 90)
    first, second = list(enumerate(texts))[:50], list(enumerate(texts))[50:]
    store = lines.Store.empty(spark, shards=4).insert(frame(first))
    both = store.insert(frame(second))
    assert rows(both.clean(frame(first + second))) == plain_lines(first + second)
    ids = spark.createDataFrame([(n,) for n in range(40, 90, 2)] + [(None,), (999,)], "doc_id long")
    less = both.delete(ids)
    left = [d for d in first + second if d[0] < 40 or d[0] % 2]
    assert rows(less.clean(frame(left))) == plain_lines(left)
    # Back to the first batch: counts and what the filters hold are as before.
    back = both.delete(spark.createDataFrame([(n,) for n in range(50, 90)], "doc_id long"))
    assert sorted(map(tuple, back.counts.collect())) == sorted(map(tuple, store.counts.collect()))
    held = {r["shard"]: Counter(np.frombuffer(r["slots"], np.uint16).tolist()) for r in store.filters.collect()}
    now = {r["shard"]: Counter(np.frombuffer(r["slots"], np.uint16).tolist()) for r in back.filters.collect()}
    assert {k: {p: n for p, n in c.items() if p} for k, c in held.items()} == {
        k: {p: n for p, n in now[k].items() if p} for k in held}
    assert rows(back.clean(frame(first))) == plain_lines(first)
    everything = both.delete(spark.createDataFrame([(n,) for n in range(90)], "doc_id long"))
    assert everything.counts.count() == 0
    assert rows(everything.insert(frame(second)).clean(frame(second))) == plain_lines(second)


def test_full_filters_are_built_anew(spark, frame):
    """A filter made for few keys, then given many."""
    few = [(n, "a line to begin the only shard with") for n in range(3)]
    many = [(10 + n, "\n".join(f"later line of the only shard {k}" for k in range(400))) for n in range(4)]
    store = lines.Store.empty(spark, shards=1).insert(frame(few)).insert(frame(many))
    assert [r["full"] for r in store.filters.collect()] == [False]
    assert rows(store.clean(frame(few + many))) == plain_lines(few + many)


def test_cuckoo_filter():
    keys = [lines._digest(str(n).encode()) for n in range(5000)]
    made = lines.built(keys[:3000])
    assert made.holds(keys[:3000]).all()
    assert made.holds(keys[3000:]).mean() < 0.01
    made.delete(keys[:1500])
    assert made.holds(keys[1500:3000]).all()
    assert made.holds(keys[:1500]).mean() < 0.01
    made.delete(keys[1500:3000])
    assert not made.slots.any()
    assert not lines.CuckooFilter.of_size(4).insert(keys)
