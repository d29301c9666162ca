"""Toxicity by weak supervision: many weak voters, a generative model of them, a linear classifier.

Voters look for listed insults, for words and beginnings of words that a bounded sample of labelled
rows shows to go with toxic texts (beginnings find forms not seen there), for an insult near a second
person, for shouting, and for the absence of all of these.
Each votes toxic (1), clean (-1) or not at all (0). A generative model (a class, and for each voter
the chances of its votes given the class) is fitted by expectation maximisation to the counts of
all vote patterns in all documents; it starts from the labelled rows. Voters that agree beyond what
the class explains are correlated, and their evidence is shared out accordingly. A linear classifier
is then fitted to the model's posterior labels of a bounded sample, on words and votes.

Edge cases: null, empty and wordless texts get only the vote for the absence of insults; without
labels of both classes the listed insults alone stand; without any document the result is empty;
repeated rows get equal scores.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import byte_texts, named, remainder
from tidewatch.llm.learn import append_column, fit_in_one_task, labelled_sample, sigmoid

TOXIC = 0.7
INSULTS = ("bastard", "clown", "creep", "disgusting", "dumb", "filthy", "idiot", "jerk", "loser",
           "moron", "pathetic", "scum", "stupid", "trash", "vermin", "worthless")
WORD = re.compile(rb"[a-z\x80-\xff]+")
NEAR_YOU = re.compile(rb"\b(?:you|your|you're|u)\b\W+(?:\w+\W+){0,2}?(" + "|".join(INSULTS).encode() + rb")\b")
LEXICONS = 6
#: Beginnings of words are terms like words, marked by a star. Lengths in bytes.
PREFIXES = (4, 5, 6)
#: Terms of a lexicon: seen in so many toxic texts, whose share among all texts with the term
#: surely lies so far between the usual one and all.
SEEN, SURE, ABOVE = 5, 3.0, 0.25
FEATURE_TERMS = 512
CACHED = 500_000
VOTERS = LEXICONS + 5
PRIOR = 0.1


def terms(word: bytes) -> list[bytes]:
    """A word and its beginnings."""
    return [word, *(word[:n] + b"*" for n in PREFIXES if len(word) >= n)]


class Words:
    """Terms of the induced lexicons (with the voter of each), and terms the classifier looks at."""

    def __init__(self, lexicon: dict[bytes, int], features: dict[bytes, int]) -> None:
        self.lexicon, self.features = lexicon, features
        self.cache: dict[bytes, tuple[tuple[int, ...], tuple[int, ...]]] = {}

    def of(self, word: bytes) -> tuple[tuple[int, ...], tuple[int, ...]]:
        """Voters and features that a word speaks to."""
        if word not in self.cache:
            if len(self.cache) > CACHED:
                self.cache.clear()
            own = terms(word)
            self.cache[word] = (tuple({self.lexicon[t] for t in own if t in self.lexicon}),
                                tuple(self.features[t] for t in own if t in self.features))
        return self.cache[word]


def votes_and_words(data: bytes, words: Words) -> tuple[np.ndarray, list[int]]:
    """Votes of all voters on a text, and the numbers of the feature terms in it."""
    low = data.lower()
    found = set(WORD.findall(low))
    votes, seen = np.zeros(VOTERS, np.int64), set()
    for word in found:
        voters, features = words.of(word)
        if voters:
            votes[list(voters)] = 1
        seen.update(features)
    listed = not found.isdisjoint(_LISTED)
    votes[LEXICONS] = listed
    votes[LEXICONS + 1] = bool(listed and NEAR_YOU.search(low))
    upper = sum(map(data.count, _CAPITALS))
    votes[LEXICONS + 2] = 1 if upper >= 20 and 2 * upper > len(data) else 0
    votes[LEXICONS + 3] = 1 if data.count(b"!!") >= 3 else 0
    votes[LEXICONS + 4] = 0 if votes[:LEXICONS + 2].any() else -1
    return votes, sorted(seen)


_LISTED = frozenset(w.encode() for w in INSULTS)
_CAPITALS = [bytes([c]) for c in range(0x41, 0x5B)]


def induce(sample: DataFrame) -> Words:
    """Words from texts labelled 0 or 1, which are a bounded sample.

    Every term that passes is in a lexicon; the classifier looks at these and at ``FEATURE_TERMS``
    more.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, label in zip(byte_texts(batch["text"]), batch["label"].to_pylist(), strict=True):
                words = {w for w in WORD.findall(data.lower()) if len(w) >= 2}
                found = sorted({t for w in words for t in terms(w)})
                yield pa.record_batch({
                    "word": pa.array(found, pa.binary()),
                    "label": pa.array([label] * len(found), pa.int32())})

    totals = sample.groupBy("label").count()
    size = {r["label"]: r["count"] for r in totals.collect()}
    bad, good = size.get(1, 0), size.get(0, 0)
    if not bad or not good:
        return Words({}, {})
    counts = sample.mapInArrow(run, "word binary, label int").groupBy("word").agg(
        F.sum("label").alias("bad"), F.count("*").alias("all")).where(F.col("all") >= SEEN)
    share = F.col("all") / (bad + good)
    surprise = (F.col("bad") / bad - (F.col("all") - F.col("bad")) / good) / F.sqrt(
        share * (1 - share) * (1 / bad + 1 / good) + 1e-12)
    # Lower end of the interval for the share of toxic texts among those with the term.
    n, p, z = F.col("all"), F.col("bad") / F.col("all"), F.lit(SURE)
    low = (p + z * z / (2 * n) - z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)
    scored = counts.withColumn("surprise", surprise).withColumn("low", low)
    listed = scored.where((F.col("bad") >= SEEN) & (
        F.col("low") >= F.lit((bad + ABOVE * good) / (bad + good))))
    lexicon = [bytes(r["word"]) for r in listed.orderBy(F.desc("surprise"), "word").collect()]
    other = [bytes(r["word"]) for r in scored.orderBy(
        F.desc(F.abs("surprise")), "word").limit(FEATURE_TERMS).collect()]
    features = sorted({*lexicon, *other, *_LISTED})
    return Words({w: i % LEXICONS for i, w in enumerate(lexicon)},
                 {w: i for i, w in enumerate(features)})


@dataclass(frozen=True)
class LabelModel:
    """Class prior, chances of each vote per voter and class, and the share of its evidence."""

    prior: float
    chances: np.ndarray  # class, voter, vote + 1
    share: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Chance of class 1 for rows of votes."""
        told = np.log(self.chances[1]) - np.log(self.chances[0])
        evidence = told[np.arange(votes.shape[1]), votes + 1]
        return sigmoid(np.log(self.prior / (1 - self.prior)) + evidence @ self.share)


def _chances(votes: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Smoothed shares of the votes -1, 0, 1 of each voter, over weighted rows."""
    counted = np.stack([((votes == v) * weight[:, None]).sum(0) for v in (-1, 0, 1)], axis=1) + 0.5
    return counted / counted.sum(axis=1, keepdims=True)


def fit_labels(votes: np.ndarray, count: np.ndarray, known: np.ndarray, label: np.ndarray,
               rounds: int = 20) -> LabelModel:
    """Fit to vote patterns and how often each occurs, from the accuracies on labelled rows."""
    if len(np.unique(label)) == 2:
        prior = float(np.clip(label.mean(), 1e-3, 0.5))
        chances = np.stack([_chances(known, (label == c).astype(float)) for c in (0, 1)])
    else:
        prior = PRIOR
        start = np.array([[0.05, 0.9, 0.05], [0.05, 0.55, 0.4]])
        chances = np.repeat(start[:, None, :], votes.shape[1], axis=1)
        chances[:, -1] = [[0.9, 0.05, 0.05], [0.1, 0.85, 0.05]]
    model = LabelModel(prior, chances, np.ones(votes.shape[1]))
    for _ in range(rounds):
        p = model.posterior(votes)
        share = _shares(votes, count, p)
        prior = float(np.clip((p * count).sum() / max(count.sum(), 1), 1e-3, 0.5))
        model = LabelModel(prior, np.stack(
            [_chances(votes, (1 - p) * count), _chances(votes, p * count)]), share)
    return model


def _shares(votes: np.ndarray, count: np.ndarray, p: np.ndarray) -> np.ndarray:
    """One over the sum of a voter's correlations within the classes, itself included."""
    total = np.zeros((votes.shape[1],) * 2)
    for weight in (p * count, (1 - p) * count):
        size = max(weight.sum(), 1e-9)
        centred = votes - (votes * weight[:, None]).sum(0) / size
        total += (centred * weight[:, None]).T @ centred
    spread = np.sqrt(np.maximum(np.diag(total), 1e-9))
    link = np.clip(total / np.outer(spread, spread), 0, 1)
    np.fill_diagonal(link, 1)
    return 1 / link.sum(axis=1)


def fit_linear(x: np.ndarray, p: np.ndarray, ridge: float = 1.0, rounds: int = 12) -> np.ndarray:
    """Logistic regression on posterior labels by Newton steps; the last weight is the constant."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-3
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        now = sigmoid(x @ w)
        gradient = x.T @ (now - p) + penalty * w
        weight = np.maximum(now * (1 - now), 1e-6)
        step = np.linalg.solve((x * weight[:, None]).T @ x + np.diag(penalty), gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


@dataclass(frozen=True)
class Model:
    words: Words
    weights: np.ndarray

    def score(self, data: bytes) -> float:
        votes, words = votes_and_words(data, self.words)
        n = len(self.words.features)
        return float(sigmoid(self.weights[words].sum() + votes @ self.weights[n:n + VOTERS]
                             + self.weights[-1]))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """From all documents, and labels whose crc32(doc_id) mod 3 is not 1."""
    docs = named(docs, doc_id="doc_id", text="text")
    spark = docs.sparkSession
    sample = labelled_sample(docs, labels, "toxic", remainder(F.col("doc_id"), 3) != 1)
    words = induce(sample)
    shared = spark.sparkContext.broadcast(words)
    places = 3 ** np.arange(VOTERS)

    def ballot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch({"code": pa.array(
                [int((votes_and_words(t, shared.value)[0] + 1) @ places)
                 for t in byte_texts(batch["text"])], pa.int64())})

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = [votes_and_words(t, shared.value) for t in byte_texts(batch["text"])]
            yield pa.record_batch({
                "code": pa.array([int((v + 1) @ places) for v, _ in seen], pa.int64()),
                "words": pa.array([w for _, w in seen], pa.list_(pa.int32())), "label": batch["label"]})

    # At most 3 ** VOTERS patterns, whatever the number of documents.
    patterns = docs.select("text").mapInArrow(ballot, "code bigint").groupBy("code").count().toArrow()
    code, count = np.asarray(patterns["code"]), np.asarray(patterns["count"], np.float64)

    def train(table: pa.Table) -> tuple:
        return _train(table, code, count, len(words.features), places)

    rows = sample.mapInArrow(describe, "code bigint, words array<int>, label int")
    weights = fit_in_one_task(rows, train)
    if weights is None:  # no labelled text: the voters alone, on their vote patterns
        votes = code[:, None] // places % 3 - 1
        labelled = fit_labels(votes, count, np.zeros((0, VOTERS)), np.zeros(0))
        weights = fit_linear(votes.astype(float), labelled.posterior(votes)) if len(votes) else np.zeros(
            VOTERS + 1)
    return Model(words, np.asarray(weights))


def _train(table: pa.Table, code: np.ndarray, count: np.ndarray, n: int, places: np.ndarray) -> np.ndarray:
    by = code.argsort()
    patterns = code[by, None] // places % 3 - 1
    known = np.asarray(table["code"])[:, None] // places % 3 - 1
    label = np.asarray(table["label"])
    model = fit_labels(patterns, count[by], known, label)
    lists = table["words"].combine_chunks()
    x = np.zeros((table.num_rows, n + VOTERS), np.float32)
    x[np.repeat(np.arange(table.num_rows), np.asarray(pa.compute.list_value_length(lists))),
      np.asarray(lists.flatten())] = 1
    x[:, n:] = known
    order = np.lexsort(x.T)  # rows come in any order; the fit must not depend on it
    return fit_linear(x[order].astype(np.float64), model.posterior(known)[order])


def predictions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` of every document."""
    plain = named(docs, doc_id="doc_id", text="text")
    shared = docs.sparkSession.sparkContext.broadcast(fit(plain, labels))
    scored = append_column(plain, "score", "double", lambda batch: pa.array(
        [shared.value.score(t) for t in byte_texts(batch["text"])], pa.float64()), drop="text")
    return scored.select(
        "doc_id", (remainder(F.col("doc_id"), 3) == 1).alias("held_out"), "score",
        F.when(F.col("score") >= TOXIC, 1).otherwise(0).alias("predicted"))
