"""The words a scorer has to look at, found in Arrow.

Most words of a text are not in the lexicon. A slice of texts is split and looked up at once, and
only words that may be scored are handed on, with the words around them; what they count for is decided
by Spark's expressions.
"""

from __future__ import annotations

from collections.abc import Collection, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F


# Fixed value: bytes of text that are split at once.
SLICE_BYTES = 4 << 20

# Places of the words around a found one, by field.
AROUND = {"r1": -1, "r2": -2, "r3": -3, "s1": 1, "s2": 2}
_FOUND = pa.struct([("at", pa.int32()), *[(n, pa.string()) for n in ("word", *AROUND)]])
_SEEN = pa.struct([("words", pa.int32()), ("loud", pa.int32()), ("turn", pa.int32()), ("found", pa.list_(_FOUND))])
_TYPE = "words int, loud int, turn int, found array<struct<at int, word string, {}>>".format(
    ", ".join(f"{n} string" for n in AROUND))


def _slices(texts: pa.Array) -> Iterator[pa.Array]:
    """The texts in order, in slices of about ``SLICE_BYTES``."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype="int64")
    cuts = np.flatnonzero(np.diff(ends // SLICE_BYTES)) + 1
    for start, end in zip([0, *cuts], [*cuts, len(texts)]):
        yield texts.slice(start, end - start)


def _folded(words: Collection[str]) -> pa.Array:
    """Words to look for, also as Arrow's lower case has them, which knows no dotted capital I and no final sigma."""
    return pa.array(sorted({*words, *[w.replace("i\u0307", "i").replace("ς", "σ") for w in words]}), pa.string())


def look_at(texts: pa.Array, scored: Collection[str], whole: Collection[str], turns: Collection[str], marks: str) -> pa.Array:
    """Per text its words of two characters or more: how many, how many in capitals, and which are found.

    Found are words that are in ``scored`` without the ``marks`` at their ends, or in ``whole`` as they are; ``turn`` is
    the place of the first one in ``turns``, from one. All are compared in lower case.
    """
    lists = pc.utf8_split_whitespace(texts)  # the characters of text.SPACE
    row = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    words = lists.flatten()
    two = pc.greater(pc.utf8_length(words), 1)
    words, row = words.filter(two), row[two.to_numpy(zero_copy_only=False)]
    lower = pc.utf8_lower(words)

    def places(chosen: pa.Array) -> np.ndarray:
        return np.flatnonzero(chosen.to_numpy(zero_copy_only=False))

    found = places(pc.or_(pc.is_in(pc.utf8_trim(lower, characters=marks), value_set=_folded(scored)),
                          pc.is_in(lower, value_set=_folded(whole))))
    turning = places(pc.is_in(lower, value_set=_folded(turns)))
    loud = places(pc.and_not(pc.equal(words, pc.utf8_upper(words)), pc.equal(words, lower)))
    # Some letters have capitals of several letters, which Arrow does not know.
    loud = loud[np.array([w == w.upper() for w in words.take(loud).to_pylist()], dtype=bool)]

    def per_text(rows: np.ndarray) -> np.ndarray:
        return np.bincount(rows, minlength=len(texts))

    count = per_text(row)
    at = np.arange(len(row)) - (np.cumsum(count) - count)[row]
    turn = np.zeros(len(texts), dtype="int64")
    turn[row[turning][::-1]] = at[turning][::-1] + 1  # the first one is written last
    own, last = at[found], count[row[found]]
    columns = [pa.array(own, pa.int32()), words.take(found)]
    for step in AROUND.values():
        outside = (own + step < 0) | (own + step >= last)
        columns.append(words.take(pa.array(np.where(outside, found, found + step), mask=outside)))
    ends = np.concatenate([[0], np.cumsum(per_text(row[found]))])
    hits = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(columns, fields=list(_FOUND)))
    numbers = [pa.array(n, pa.int32()) for n in (count, per_text(row[loud]), turn)]
    return pa.StructArray.from_arrays([*numbers, hits], fields=list(_SEEN))


def seen_words(text: str, scored: Collection[str], whole: Collection[str], turns: Collection[str], marks: str) -> Column:
    """``look_at`` as a column; ``text`` is an SQL expression that is never null."""
    scored, whole, turns = frozenset(scored), frozenset(whole), frozenset(turns)

    @F.arrow_udf(_TYPE)
    def seen(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            parts = [look_at(part, scored, whole, turns, marks) for part in _slices(texts.cast(pa.string()))]
            yield pa.concat_arrays(parts)

    return seen(F.make_valid_utf8(F.expr(text)))
