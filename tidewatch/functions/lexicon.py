"""Word lists of the rule-based scorer."""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from functools import cached_property
from pathlib import Path

# A lexicon travels inside the plan, so its size is checked; real ones hold some ten thousand words.
MAX_WORDS = 200_000
_WORDS_PER_BUCKET = 8

# A small English lexicon, valence from -4 to 4.
VALENCES = {
    "awful": -2.0, "bad": -2.5, "boycott": -1.3, "broken": -2.1, "clown": -1.2, "crash": -1.7,
    "crisis": -3.1, "disappointed": -2.1, "disappointing": -2.2, "disaster": -3.1,
    "disgusting": -2.4, "fail": -2.5, "failing": -2.3, "failure": -2.3, "fraud": -2.8,
    "garbage": -1.9, "hate": -2.7, "horrible": -2.5, "idiot": -2.3, "loser": -2.4, "moron": -2.2,
    "outrage": -2.3, "pathetic": -2.7, "problem": -1.7, "recall": -0.9, "refund": -1.1,
    "scam": -2.7, "scandal": -1.9, "scum": -2.6, "stupid": -2.4, "terrible": -2.1, "trash": -2.0,
    "useless": -1.8, "worse": -2.1, "worst": -3.1, "worthless": -1.9, "wrong": -2.1,
    "amazing": 2.8, "awesome": 3.1, "best": 3.2, "excellent": 2.7, "excited": 1.4,
    "fantastic": 2.6, "fast": 0.7, "favorite": 2.0, "fine": 0.8, "glad": 2.0, "good": 1.9,
    "great": 3.1, "happy": 2.7, "helpful": 1.8, "impressed": 2.1, "improved": 2.1, "like": 1.5,
    "love": 3.2, "loved": 2.9, "nice": 1.8, "perfect": 2.7, "recommend": 1.5, "reliable": 1.7,
    "thanks": 1.9, "win": 2.8, "wonderful": 2.7, "worth": 0.9, "wow": 2.8,
}

# Degree adverbs that strengthen or weaken the word they precede.
STRONGER = (
    "absolutely", "amazingly", "awfully", "completely", "considerably", "decidedly", "deeply",
    "enormously", "entirely", "especially", "exceptionally", "extremely", "greatly", "highly",
    "hugely", "incredibly", "intensely", "more", "most", "particularly", "purely", "quite",
    "really", "remarkably", "so", "substantially", "thoroughly", "totally", "tremendously",
    "unbelievably", "unusually", "utterly", "very",
)
WEAKER = (
    "almost", "barely", "hardly", "kinda", "less", "little", "marginally", "occasionally",
    "partly", "scarcely", "slightly", "somewhat", "sorta",
)
DEGREE = 0.293

# Words that turn the meaning of what follows; any word with "n't" does too.
NEGATORS = (
    "aint", "arent", "cannot", "cant", "couldnt", "didnt", "doesnt", "dont", "hadnt", "hasnt",
    "havent", "isnt", "neither", "never", "none", "nope", "nor", "not", "nothing", "nowhere",
    "shouldnt", "wasnt", "werent", "without", "wont", "wouldnt", "rarely", "seldom", "despite",
)


# Phrases with a valence of their own, from the published rules.
PHRASES = {
    "the shit": 3.0, "the bomb": 3.0, "bad ass": 1.5, "badass": 1.5, "bus stop": 0.0, "yeah right": -2.0,
    "kiss of death": -1.5, "to die for": 3.0, "beating heart": 3.1, "broken heart": -2.9,
}


@dataclass(frozen=True)
class Turns:
    """Words that change what stands around them, and by how much."""

    # Fixed values of the published rules: "never so", "never this", "without doubt", "at least".
    never: str = "never"
    so: tuple[str, ...] = ("so", "this")
    stronger: float = 1.25
    without: tuple[str, str] = ("without", "doubt")
    least: str = "least"
    not_least: tuple[str, ...] = ("at", "very")


@dataclass(frozen=True)
class Lexicon:
    """Valences by lower-case word, plus the degree adverbs and negators to honour."""

    valences: Mapping[str, float] = field(default_factory=lambda: VALENCES)
    degrees: Mapping[str, float] = field(
        default_factory=lambda: {w: DEGREE for w in STRONGER} | {w: -DEGREE for w in WEAKER}
    )
    negators: tuple[str, ...] = NEGATORS
    #: Phrases of two or three words that have a valence of their own.
    phrases: Mapping[str, float] = field(default_factory=lambda: dict(PHRASES))
    turns: Turns = field(default_factory=lambda: Turns())

    def __post_init__(self):
        if len(self.valences) > MAX_WORDS:
            raise ValueError(f"lexicon has {len(self.valences)} words, more than {MAX_WORDS}")

    @cached_property
    def scored(self) -> dict[str, float]:
        """Words that carry a valence themselves; a degree adverb never does."""
        return {w: float(v) for w, v in self.valences.items() if w not in self.degrees}

    # The conditions and look-ups are SQL text over a word: parsing one text is much faster
    # than building a column for every entry of a long list.

    def valence(self, word: str) -> str:
        return _lookup(word, self.scored)

    def degree(self, word: str) -> str:
        return _lookup(word, self.degrees)

    def contains(self, word: str) -> str:
        return one_of(word, self.valences)

    def scores(self, word: str) -> str:
        return one_of(word, self.scored)

    def phrase(self, words: str) -> str:
        return _lookup(words, self.phrases)

    def phrase_degree(self, words: str) -> str:
        return _lookup(words, {p: d for p, d in self.degrees.items() if " " in p})

    def negates(self, word: str) -> str:
        return f"({one_of(word, self.negators)} OR contains({word}, 'n\\'t'))"


def quoted(text: str) -> str:
    """An SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def one_of(word: str, values: Iterable[str]) -> str:
    """Whether ``word`` is among ``values``; Spark looks it up in a hash set."""
    return f"{word} IN ({', '.join(map(quoted, values)) or 'NULL'})"


def _lookup(word: str, table: Mapping[str, float]) -> str:
    """Value of ``word`` in a constant table, null if absent.

    A map is searched entry by entry, so the constant is an array of small maps and a
    checksum of the word picks the one to search.
    """
    size = max(1, len(table) // _WORDS_PER_BUCKET)
    buckets: list[dict[str, float]] = [{} for _ in range(size)]
    for key, value in table.items():
        buckets[zlib.crc32(key.encode()) % size][key] = float(value)
    constant = f"from_json({quoted(json.dumps(buckets))}, 'array<map<string,double>>')"
    bucket = f"CAST(pmod(crc32(CAST({word} AS BINARY)), {size}) AS INT)"
    return f"try_element_at(get({constant}, {bucket}), {word})"


def load_phrases(path: str | Path) -> dict[str, float]:
    """A phrase file: words in lower case between single spaces and their valence, tab-separated."""
    rows = (line.split("\t") for line in Path(path).read_text(encoding="utf-8").splitlines())
    return {" ".join(row[0].lower().split()): float(row[1]) for row in rows if len(row) > 1}


def load_lexicon(path: str | Path) -> Lexicon:
    """A lexicon file: a word and its valence per line, tab-separated; more columns are ignored."""
    rows = (line.split("\t") for line in Path(path).read_text(encoding="utf-8").splitlines())
    return Lexicon({row[0].lower(): float(row[1]) for row in rows if len(row) > 1})
