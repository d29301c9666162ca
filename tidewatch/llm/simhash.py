"""Near-duplicates by SimHash fingerprints, linked through a generalised pigeonhole search.

Fingerprints are 64 bits. Two of them within ``distance`` bits must, for any split of the bits
into parts with thresholds t_1 .. t_m where the sum of (t_i + 1) is ``distance`` + 1, differ in
at most t_i bits in some part i. Parts hold correlated bits; which split and which thresholds
cost least is decided by dynamic programming on candidate counts estimated from all distinct
fingerprints. Each part with a threshold of 0 or more is probed, every candidate is verified.

Edge cases: null, empty and blank texts have the fingerprint zero and are linked like any
other; repeated rows share a fingerprint; an empty table gives an empty result; a null doc_id
keeps its row, and the component id is the smallest non-null id (null if there is none).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import byte_texts, named, small, stage_table
from tidewatch.llm.components import components

BITS = 64
SEED = 42
WORDS = 3
DISTANCE = 3
SPLITS = (2, 3, 4)
BUCKET = 16_384
PAIRS = 1 << 21
#: What a shuffled probe costs, counted in verified pairs.
PROBE_COST = 40
CANONICAL = bytes(
    0x20 if 0x09 <= c <= 0x0D else c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))


def fingerprint(data: bytes, words: int = WORDS) -> int:
    """SimHash of a UTF-8 text over word shingles, repeats included."""
    parts = data.translate(CANONICAL).split()
    if not parts:
        return 0
    if len(parts) < words:
        return xxhash.xxh64_intdigest(b" ".join(parts), SEED)
    joined = b" ".join(parts)
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(parts) - words + 1].tolist()
    ends = ends[words - 1:].tolist()
    ones, digest = np.zeros(BITS, np.int64), xxhash.xxh64_intdigest
    for i in range(0, len(starts), 1 << 16):
        hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(
            starts[i:i + (1 << 16)], ends[i:i + (1 << 16)], strict=True)], "<u8")
        ones += np.unpackbits(
            hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(starts), bitorder="little")
    return int.from_bytes(bits.tobytes(), "little")


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 words: int = WORDS) -> DataFrame:
    """``doc_id``, ``print`` (a hash of the text) and ``fingerprint`` (as a signed long) per row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(x, words) for x in byte_texts(batch["text"])]
            yield pa.record_batch({
                "doc_id": batch["doc_id"], "print": batch["print"],
                "fingerprint": pa.array(np.array(values, np.uint64).view(np.int64))})

    kind = docs.schema[doc_id].dataType.simpleString()
    return named(docs, doc_id=doc_id, text=text).select("doc_id", "text", F.xxhash64("text").alias(
        "print")).mapInArrow(run, f"doc_id {kind}, print bigint, fingerprint bigint")


@dataclass(frozen=True)
class Plan:
    """Parts as tuples of bit numbers, and the threshold of each (-1: not probed)."""

    parts: tuple[tuple[int, ...], ...]
    thresholds: tuple[int, ...]


def together(prints: DataFrame) -> np.ndarray:
    """How many fingerprints have both bit i and bit j, over all rows (64 x 64)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BITS, BITS), np.int64)
        for batch in batches:
            values = np.asarray(batch["fingerprint"]).astype("<i8")
            bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            bits = bits.astype(np.float32)
            total += (bits.T @ bits).astype(np.int64)
        yield pa.record_batch({"cell": np.arange(BITS * BITS), "n": total.ravel()})

    cells = prints.select("fingerprint").mapInArrow(run, "cell bigint, n bigint")
    out = np.zeros(BITS * BITS, np.int64)
    for cell, n in cells.groupBy("cell").agg(F.sum("n")).collect():  # 4096 rows at any size
        out[cell] = n
    return out.reshape(BITS, BITS)


def group_bits(both: np.ndarray, rows: int, parts: int) -> tuple[tuple[int, ...], ...]:
    """Split the bits into parts of near-equal width, correlated bits together."""
    rate = np.diag(both) / max(rows, 1)
    spread = np.sqrt(np.maximum(rate * (1 - rate), 1e-9))
    link = np.abs(both / max(rows, 1) - np.outer(rate, rate)) / np.outer(spread, spread)
    np.fill_diagonal(link, 0)
    free, out = list(range(BITS)), []
    for k in range(parts):
        width = len(free) // (parts - k)
        part = [max(free, key=lambda i: (link[i][free].sum(), -i))]
        free.remove(part[0])
        while len(part) < width:
            part.append(max(free, key=lambda i: (link[i][part].sum(), -i)))
            free.remove(part[-1])
        out.append(tuple(sorted(part)))
    return tuple(out)


def _differing(rates: np.ndarray) -> np.ndarray:
    """Chance of 0, 1, 2 .. differing bits, if bits differ independently at the given rates."""
    chance = np.array([1.0])
    for p in rates:
        chance = np.convolve(chance, [1 - p, p])
    return chance


def allocate(pairs: list[list[float]], widths: list[int], rows: int,
             distance: int) -> tuple[float, tuple[int, ...]]:
    """Thresholds of least cost: sum of (t + 1) equal to distance + 1, by dynamic programming.

    ``pairs[i][t]`` estimates the candidate pairs of part i at threshold t.
    """
    best: dict[int, tuple[float, tuple[int, ...]]] = {0: (0.0, ())}
    for own, width in zip(pairs, widths, strict=True):
        new: dict[int, tuple[float, tuple[int, ...]]] = {}
        for spent, (cost, taken) in best.items():
            for t in range(-1, distance - spent + 1):
                probes = sum(comb(width, j) for j in range(t + 1))
                option = (cost + (own[t] if t >= 0 else 0) + PROBE_COST * rows * probes,
                          (*taken, t))
                if spent + t + 1 not in new or option < new[spent + t + 1]:
                    new[spent + t + 1] = option
        best = new
    return best[distance + 1]


def part_key(values: np.ndarray, part: tuple[int, ...]) -> np.ndarray:
    """The bits of a part, moved together."""
    key = np.zeros(len(values), np.uint64)
    for place, bit in enumerate(part):
        key |= ((values >> np.uint64(bit)) & np.uint64(1)) << np.uint64(place)
    return key


def choose(prints: DataFrame, distance: int = DISTANCE) -> Plan:
    """The cheapest split and thresholds for the given distinct fingerprints (all are counted)."""
    rows = prints.count()
    both = together(prints)
    splits = [group_bits(both, rows, m) for m in SPLITS]
    flat = [(s, k, part) for s, parts in enumerate(splits) for k, part in enumerate(parts)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.asarray(batch["fingerprint"]).view(np.uint64)
            for number, (_, _, part) in enumerate(flat):
                yield pa.record_batch({
                    "part": np.full(len(values), number, np.int32),
                    "key": part_key(values, part).view(np.int64)})

    met = (prints.select("fingerprint").mapInArrow(run, "part int, key bigint")
           .groupBy("part", "key").count()
           .groupBy("part").agg(F.sum(F.expr("double(count) * (count - 1) / 2"))))
    same = dict(met.collect())  # one row per part
    rate = np.diag(both) / max(rows, 1)
    plans = []
    for s, parts in enumerate(splits):
        pairs = []
        for number, (split, _, part) in enumerate(flat):
            if split == s:
                chance = np.cumsum(_differing(2 * rate[list(part)] * (1 - rate[list(part)])))
                grown = chance[: distance + 1] / max(chance[0], 1e-12)
                pairs.append([min(same.get(number, 0.0) * x, rows * rows / 2) for x in grown])
        cost, thresholds = allocate(pairs, [len(p) for p in parts], rows, distance)
        plans.append((cost, Plan(parts, thresholds)))
    return min(plans, key=lambda p: p[0])[1]


def probes(prints: DataFrame, plan: Plan) -> DataFrame:
    """Rows (part, key, fingerprint, exact): a fingerprint's own key, and its probes if t > 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.asarray(batch["fingerprint"]).view(np.uint64)
            for number, (part, t) in enumerate(zip(plan.parts, plan.thresholds, strict=True)):
                key = part_key(values, part)
                for flips in (f for j in range(t + 1) for f in combinations(range(len(part)), j)):
                    mask = np.uint64(sum(1 << f for f in flips))
                    yield pa.record_batch({
                        "part": np.full(len(values), number, np.int32),
                        "key": (key ^ mask).view(np.int64), "fingerprint": batch["fingerprint"],
                        "exact": np.full(len(values), not flips)})

    return prints.select("fingerprint").mapInArrow(
        run, "part int, key bigint, fingerprint bigint, exact boolean")


def _join(roots: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member of each row's class after the rows a and b have been linked."""
    while True:
        old = roots.copy()
        low = np.minimum(roots[a], roots[b])
        np.minimum.at(roots, roots[a], low)
        np.minimum.at(roots, roots[b], low)
        roots = roots[roots]
        if (old == roots).all() and (roots[a] == roots[b]).all():
            return roots


def _links(key: np.ndarray, values: np.ndarray, exact: np.ndarray,
           distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Verify all pairs of rows with equal keys (sorted), a block of pairs at a time.

    Returns every linked row's value and that of its class, so n rows give under n edges.
    """
    n = len(key)
    ends = np.searchsorted(key, key, side="right")
    counts = ends - np.arange(n) - 1
    total = np.concatenate([[0], np.cumsum(counts)])
    roots, at = np.arange(n), 0
    while at < n:
        stop = max(at + 1, int(np.searchsorted(total, total[at] + PAIRS, side="right")) - 1)
        left = np.repeat(np.arange(at, stop), counts[at:stop])
        right = left + 1 + np.arange(len(left)) - np.repeat(
            total[at:stop] - total[at], counts[at:stop])
        good = (np.bitwise_count(values[left] ^ values[right]) <= distance)
        good &= exact[left] | exact[right]
        left, right = left[good], right[good]
        if len(left):
            roots = _join(roots, left, right)
        at = stop
    linked = roots != np.arange(n)
    return values[linked], values[roots[linked]]


def _bucket_edges(rows: DataFrame, distance: int) -> DataFrame:
    """Edges within buckets, of rows sorted by (part, key) in their partitions."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def verified(part, key, value, exact):
            run_id = np.cumsum(np.concatenate(
                [[0], (np.diff(part) != 0) | (np.diff(key) != 0)]).astype(np.int64))
            a, b = _links(run_id, value.view(np.uint64), exact, distance)
            return pa.record_batch({"a": a.view(np.int64), "b": b.view(np.int64)})

        for batch in batches:
            if not batch.num_rows:
                continue
            now = [np.asarray(batch[c]) if c != "exact" else batch[c].to_numpy(zero_copy_only=False)
                   for c in ("part", "key", "fingerprint", "exact")]
            held = [np.concatenate(x) for x in zip(held, now, strict=True)] if held else now
            # The last bucket may go on in the next batch; a bucket is bounded.
            whole = int(np.argmax((held[0] == held[0][-1]) & (held[1] == held[1][-1])))
            if whole:
                yield verified(*[x[:whole] for x in held])
                held = [x[whole:] for x in held]
        if held:
            yield verified(*held)

    return rows.mapInArrow(run, "a bigint, b bigint")


def _star_edges(prints: DataFrame, distance: int) -> DataFrame:
    """Edges among the given fingerprints with work in proportion to their number.

    Two values within ``distance`` bits meet at some value that is within the smaller half of
    the distance from one and within the rest from the other. All that meet at a value are
    linked to the smallest of its near side. At most a fixed number of distinct values can meet.
    """
    near, far = distance // 2, distance - distance // 2
    masks = [(j <= near, sum(1 << b for b in f))
             for j in range(far + 1) for f in combinations(range(BITS), j)]

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.asarray(batch["fingerprint"]).view(np.uint64)
            for close, mask in masks:
                yield pa.record_batch({
                    "place": (values ^ np.uint64(mask)).view(np.int64),
                    "value": batch["fingerprint"], "close": np.full(len(values), close)})

    met = prints.select("fingerprint").mapInArrow(
        spread, "place bigint, value bigint, close boolean")
    # Both sides are combined per meeting place; a place holds a bounded number of values.
    per_place = met.groupBy("place").agg(
        F.min(F.when(F.col("close"), F.col("value"))).alias("b"), F.collect_set("value").alias("all"))
    return per_place.where("b IS NOT NULL AND size(all) > 1").select(
        F.explode("all").alias("a"), "b").where("a != b").distinct()


def links(prints: DataFrame, distance: int = DISTANCE, plan: Plan | None = None,
          bucket: int = BUCKET) -> DataFrame:
    """Edges (a, b) that connect all distinct fingerprints within ``distance`` bits.

    Not every pair is listed, but two fingerprints are connected here exactly if they are so
    by pairs. Buckets of up to ``bucket`` rows are verified pair by pair inside a task; what is
    in larger ones is linked by ``_star_edges``, whose work does not grow with the bucket.
    """
    plan = plan or choose(prints, distance)
    rows = probes(prints, plan)
    sizes = stage_table(
        rows.groupBy("part", "key").agg(F.count("*").alias("n"), F.max("exact").alias("met"))
        .where("n > 1 AND met").select("part", "key", "n"), "simhash-buckets")
    shared = rows.join(sizes.where(F.col("n") <= bucket).select("part", "key"), ["part", "key"],
                       "left_semi")
    edges = _bucket_edges(
        shared.repartition("part", "key").sortWithinPartitions("part", "key", "fingerprint"), distance)
    if sizes.where(F.col("n") > bucket).limit(1).count():
        hot = rows.join(sizes.where(F.col("n") > bucket), ["part", "key"], "left_semi")
        edges = edges.union(_star_edges(hot.select("fingerprint").distinct(), distance))
    return edges


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS,
            distance: int = DISTANCE, bucket: int = BUCKET) -> DataFrame:
    """``doc_id``, ``print``, ``fingerprint`` (long), ``root`` (of the class), ``component_id`` and
    ``copies`` (rows of the same fingerprint) of every row."""
    prints = stage_table(fingerprints(docs, doc_id, text, words), "simhash-prints")
    distinct = stage_table(prints.groupBy("fingerprint").agg(
        F.min("doc_id").alias("first"), F.count("*").alias("copies")), "simhash-distinct")
    roots = components(links(distinct, distance, bucket=bucket))
    rooted = distinct.join(
        roots, distinct["fingerprint"] == roots["node"], "left").select(
        "fingerprint", "first", "copies", F.coalesce("root", "fingerprint").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return prints.join(rooted.join(least, "root").drop("first"), "fingerprint")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    words: int = WORDS, distance: int = DISTANCE,
                    bucket: int = BUCKET) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits), ``component_id`` and ``copies`` per row.

    ``component_id`` is the smallest doc_id reachable through links, itself included; ``copies``
    counts the rows that share the fingerprint.
    """
    return classes(docs, doc_id, text, words, distance, bucket).select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id", "copies")


def _of(docs: DataFrame, keys: DataFrame) -> Column:
    return (docs["doc_id"].eqNullSafe(keys["id"])
            & F.xxhash64(docs["text"]).eqNullSafe(keys["of"]))


def keep_first(docs: DataFrame) -> DataFrame:
    """One row of each class of near-duplicates, with all columns of ``docs``.

    It is the row of the smallest doc_id (null ids come last, then the hash of the text decides);
    of repeated rows one stays. What is joined is the table of rows to drop, not the texts.
    """
    rows = classes(docs).select(F.col("doc_id").alias("id"), F.col("print").alias("of"), "root")
    order = F.struct(F.col("id").isNull(), "id", "of")
    first = rows.groupBy("root").agg(F.min(order).alias("k")).select("root", "k.id", "k.of")
    counted = stage_table(rows.groupBy("root", "id", "of").count(), "simhash-rows")
    kept = stage_table(counted.join(first.withColumnsRenamed({"root": "r", "id": "i", "of": "o"}), (
        F.col("root") == F.col("r")) & F.col("id").eqNullSafe(F.col("i"))
        & F.col("of").eqNullSafe(F.col("o"))).select("id", "of", "count"), "simhash-kept")
    gone = stage_table(counted.select("id", "of").subtract(kept.select("id", "of")), "simhash-gone")
    out = docs.join(small(gone), _of(docs, gone), "left_anti")
    again = kept.where("count > 1").select("id", "of")
    if not again.limit(1).count():
        return out
    many = out.join(again, _of(out, again), "left_semi").withColumn("_print", F.xxhash64("text"))
    by = Window.partitionBy("doc_id", "_print").orderBy(F.xxhash64(*docs.columns))
    one = many.withColumn("_place", F.row_number().over(by)).where("_place = 1").select(*docs.columns)
    return out.join(again, _of(out, again), "left_anti").unionByName(one)
