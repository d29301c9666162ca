"""Language identification by error-correcting output codes.

Every language has a codeword. For each bit a binary classifier, from counts of hashed letter
n-grams (1 to 3) over all learnable documents, tells the languages with a 1 there from those with
a 0. A text gets the language whose codeword costs least: the losses of all bits, weighted by how
well the bit's classifier separates its two sides. If the second best costs nearly as little the
answer is flagged as ambiguous.

Edge cases: null texts and texts without a letter get ``und`` with score 0; with a single
language all texts with a letter get it with score 1, with none they get ``und``; ties go to the
language first in order; repeated rows get equal answers; an empty table gives an empty result.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import named, remainder

BUCKETS = 1 << 14
GRAMS = 3
#: Up to so many languages all splits into two sides are used as bits; beyond, random ones.
ALL_SPLITS = 6
#: Evidence of n-grams that overlap, as a share of independent ones.
INDEPENDENT = 0.3
#: An answer is ambiguous if the second best costs less than this more, or less than this share
#: of what languages cost more on average (texts of two languages).
MARGIN, MARGIN_SHARE = 0.5, 0.15
#: Share of what all languages have in common in each one's n-grams: some foreign words in a text
#: must not outweigh the rest.
COMMON = 0.2
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point if it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def gram_counts(text: str) -> np.ndarray | None:
    """Counts of hashed n-grams of the letters of a text, words set apart; None without a letter."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    is_letter = _letters()[codes]
    if not is_letter.any():
        return None
    codes = np.where(is_letter, codes, 32)
    codes = codes[is_letter | np.concatenate([[False], is_letter[:-1]])]  # one gap between words
    codes = np.concatenate([[32], codes[:-1] if codes[-1] == 32 else codes, [32]])
    out = np.zeros(BUCKETS, np.int64)
    value = np.zeros(len(codes), np.int64)
    for n in range(1, GRAMS + 1):
        value = value[:len(codes) - n + 1] * 1_000_003 + codes[n - 1:] + n
        mixed = value * 0x9E3779B1 & 0xFFFFFFFF
        out += np.bincount(mixed >> 18, minlength=BUCKETS)
    return out


def codewords(classes: int, seed: int = 5) -> np.ndarray:
    """Codewords of -1 and 1, one row per class, any two rows apart in many places."""
    if classes <= ALL_SPLITS:
        bits = (1 << max(classes - 1, 0)) - 1
        # Bit b parts the classes whose digit is set in b + 1 from the rest; the first is never set.
        numbers = np.arange(1, bits + 1)
        rows = [np.zeros(bits, int)] + [(numbers >> i) & 1 for i in range(classes - 1)]
        return np.stack(rows[:classes]) * 2 - 1
    rng = np.random.default_rng(seed)
    bits = int(np.ceil(10 * np.log2(classes)))
    tries = [rng.choice([-1, 1], (classes, bits)) for _ in range(64)]

    def apart(code: np.ndarray) -> int:
        differ = (bits - code @ code.T) // 2
        return int((differ + bits * np.eye(classes, dtype=int)).min())

    best = max(tries, key=apart)
    return best[:, (best != best[0]).any(axis=0)]


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    code: np.ndarray
    weights: np.ndarray  # bucket, bit
    trust: np.ndarray  # bit

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        counts = gram_counts(text) if text else None
        if counts is None or not self.languages:
            return UNKNOWN, 0.0, True
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False
        margin = counts @ self.weights * INDEPENDENT
        cost = np.logaddexp(0, -self.code * margin) @ self.trust
        best = int(np.argmin(cost))
        more = np.delete(cost, best) - cost[best]
        unsure = more.min() < max(MARGIN, MARGIN_SHARE * more.mean())
        return self.languages[best], float(1 / (1 + np.exp(-more).sum())), bool(unsure)


def fit(docs: DataFrame) -> Model:
    """From text and lang of all documents whose crc32(doc_id) mod 3 is not 1."""
    rows = docs.where((remainder(F.col("doc_id"), 3) != 1) & F.col("lang").isNotNull()).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist(), strict=True):
                found = gram_counts(text) if text else None
                if found is not None:
                    total[lang] = total.get(lang, 0) + found
        for lang, found in total.items():
            used = np.flatnonzero(found)
            yield pa.record_batch({
                "lang": pa.array([lang] * len(used), pa.string()), "bucket": used.astype(np.int32),
                "n": found[used]})

    # At most languages x buckets rows, whatever the number of documents.
    table = rows.mapInArrow(count, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(
        F.sum("n").alias("n")).toArrow()
    languages = tuple(sorted(set(table["lang"].to_pylist())))
    place = {x: i for i, x in enumerate(languages)}
    counts = np.zeros((len(languages), BUCKETS))
    counts[[place[x] for x in table["lang"].to_pylist()], np.asarray(table["bucket"])] = np.asarray(table["n"])
    if len(languages) < 2:
        return Model(languages, np.zeros((len(languages), 0)), np.zeros((BUCKETS, 0)), np.zeros(0))
    # Each language counts alike, however many documents it has.
    share = (counts + 0.1) / (counts + 0.1).sum(axis=1, keepdims=True)
    share = (1 - COMMON) * share + COMMON * share.mean(axis=0)
    code = codewords(len(languages))
    sides = [np.stack([share[code[:, b] == s].mean(axis=0) for s in (-1, 1)]) for b in range(code.shape[1])]
    weights = np.stack([np.log(hi) - np.log(lo) for lo, hi in sides], axis=1)
    # Evidence per n-gram for the right side, on average over the languages.
    trust = (code * (share @ weights)).mean(axis=0)
    return Model(languages, code, weights, np.maximum(trust, 1e-6) / max(trust.mean(), 1e-6))


def predictions(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred``, ``score``, ``ambiguous`` of every document."""
    plain = named(docs, doc_id="doc_id", text="text", lang="lang")
    shared = docs.sparkSession.sparkContext.broadcast(fit(plain))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.predict(t) for t in batch["text"].to_pylist()]
            lang, score, unsure = zip(*found, strict=True) if found else ((), (), ())
            yield pa.record_batch({
                "doc_id": batch["doc_id"], "lang_pred": pa.array(lang, pa.string()),
                "score": pa.array(score, pa.float64()), "ambiguous": pa.array(unsure, pa.bool_())})

    kind = docs.schema["doc_id"].dataType.simpleString()
    told = plain.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, lang_pred string, score double, ambiguous boolean")
    return told.select("doc_id", (remainder(F.col("doc_id"), 3) == 1).alias("held_out"),
                       "lang_pred", "score", "ambiguous")
