"""SimHash fingerprints and classes against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidewatch.llm import simhash
from tidewatch.llm.components import components


def plain_print(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", low) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_classes(prints, distance=3):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(prints))]


def texts():
    rng = random.Random(4)
    words = [f"w{i}" for i in range(300)]
    base = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 120))) for _ in range(60)]
    near = []
    for text in base[:25]:
        for _ in range(rng.randint(1, 4)):
            cut = text.split(" ")
            cut[rng.randrange(len(cut))] = rng.choice(words)
            near.append(" ".join(cut))
    return [None, "", " \t\n", "One", "ONE", "two words", "é É", *base, *near, *base[:5]]


def test_fingerprint_is_that_of_the_shingles():
    for text in texts():
        assert simhash.fingerprint((text or "").encode()) == plain_print(text)
    long = " ".join(str(i) for i in range(70_000))  # more than one block of shingles
    assert simhash.fingerprint(long.encode()) == plain_print(long)


def test_classes_match_brute_force(frame):
    values = texts()
    prints = [plain_print(t) for t in values]
    want = plain_classes(prints)
    rows = simhash.near_duplicates(frame(values)).collect()
    assert len(rows) == len(values)
    for row in rows:
        assert row["fingerprint"] == f"{prints[row['doc_id']]:016x}"
        assert row["component_id"] == want[row["doc_id"]]


def _values():
    rng = random.Random(9)
    centres = [rng.getrandbits(64) for _ in range(8)]
    return [*centres, *(c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5)))
                        for c in centres for _ in range(40)), 0, 1, (1 << 64) - 1]


@pytest.mark.parametrize("plan", [
    None,
    simhash.Plan((tuple(range(32)), tuple(range(32, 64))), (1, 1)),
    simhash.Plan((tuple(range(0, 64, 2)), tuple(range(1, 64, 2))), (2, 0)),
    simhash.Plan((tuple(range(20)), tuple(range(20, 40)), tuple(range(40, 64))), (0, 0, 1)),
    simhash.Plan(tuple(tuple(range(i, i + 16)) for i in range(0, 64, 16)), (1, -1, 0, 0)),
])
@pytest.mark.parametrize("bucket", [1 << 14, 4])
def test_links_connect_what_is_near(spark, plan, bucket):
    """Any allowed plan finds the same classes, with small buckets and by the way around large ones."""
    values = sorted(set(_values()))
    signed = [int(np.uint64(v).astype(np.int64)) for v in values]
    prints = spark.createDataFrame([(v,) for v in signed], "fingerprint long")
    found = {r["node"]: r["root"] for r in components(simhash.links(prints, 3, plan, bucket)).collect()}
    want = plain_classes(values)
    classes = {}
    for v, c in zip(signed, want, strict=True):
        classes.setdefault(c, set()).add(v)
    for members in classes.values():
        if len(members) > 1:
            assert {found.get(v) for v in members} == {min(members)}
        else:
            assert found.get(next(iter(members)), next(iter(members))) in members


def test_thresholds_add_up_and_cost_least():
    cost, chosen = simhash.allocate([[5, 9, 1e9, 1e9], [50, 60, 1e9, 1e9]], [32, 32], 0, 3)
    assert chosen == (1, 1) and cost == 69
    _, chosen = simhash.allocate([[0, 0, 0, 0], [1e6] * 4], [8, 56], 0, 3)
    assert chosen == (3, -1)
    both = np.full((64, 64), 25) + np.eye(64, dtype=int) * 25
    both[0, 63] = both[63, 0] = 50  # these two bits always agree
    parts = simhash.group_bits(both, 100, 4)
    assert sorted(b for p in parts for b in p) == list(range(64)) and {len(p) for p in parts} == {16}
    assert any(0 in p and 63 in p for p in parts)


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7), (3, 2)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(60)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_nulls_repeats_clashing_names_and_empty_tables(frame):
    rows = [(None, "a b c d"), (3, "a b c d"), (3, "a b c d"), (9, "quite another text"), (None, None)]
    df = frame(rows, fingerprint=F.lit("x"), component_id=F.lit(7), root=F.lit(1), links=F.lit(None))
    got = {(r["doc_id"], r["component_id"], r["copies"]) for r in simhash.near_duplicates(df).collect()}
    assert got == {(None, 3, 3), (3, 3, 3), (9, 9, 1), (None, None, 1)}
    assert simhash.near_duplicates(frame([])).count() == 0


def test_one_row_of_each_class_stays(frame):
    rows = [(5, "a b c d"), (2, "a b c d"), (2, "a b c d"), (None, "A B C D"), (None, "only null ids"),
            (None, "only null ids"), (8, None), (7, "")]
    kept = simhash.keep_first(frame(rows, root=F.lit("r")))
    assert kept.columns == ["doc_id", "text", "root"]
    got = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert sorted(got, key=str) == sorted([(2, "a b c d"), (None, "only null ids"), (7, "")], key=str)
    assert simhash.keep_first(frame([])).count() == 0
