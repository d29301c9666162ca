"""Matching a text to a brand by whole-word keywords."""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidewatch.config import Brand

# Keywords per bucket of the constant look-up table, on average.
_PER_BUCKET = 8
_WORD = r"\p{L}\p{N}_"
_CUT = "\x01"


def _is_word(sign: str) -> bool:
    return sign == "_" or sign.isalnum()


def keyword_pattern(keyword: str) -> str:
    """Java pattern for ``keyword`` between two word boundaries.

    A boundary next to a sign that is no word character asks for a word character on the
    other side, so ``r/`` is found in ``r/python`` but not in ``see r/ here``.
    """
    if not keyword:
        return f"[{_WORD}]"
    left = f"(?<![{_WORD}])" if _is_word(keyword[0]) else f"(?<=[{_WORD}])"
    right = f"(?![{_WORD}])" if _is_word(keyword[-1]) else f"(?=[{_WORD}])"
    return left + re.escape(keyword) + right


def _split_at_edges(keyword: str) -> list[str]:
    """The runs of word and of other characters, in order."""
    return re.findall(r"\w+|\W+", keyword)


def match_brand(text: Column, brands: Sequence[Brand]) -> Column:
    """Name of the first brand, in dictionary order, with any keyword in ``text``; else null.

    Text and keywords get a separator at every word boundary. A keyword then is in the text
    between boundaries exactly if its marked form is a plain substring, and its longest word is
    among the words of the text. These words are looked up in a constant table, an array of
    small maps by checksum, so the work per text does not grow with the dictionary, and nothing
    is joined, shuffled or copied. Keywords without any word character stay patterns.
    """
    rows: list[tuple[str, str, int]] = []
    wordless: list[tuple[str, int]] = []
    for order, brand in enumerate(brands):
        for keyword in brand.keywords:
            runs = _split_at_edges(keyword)
            anchors = [run for run in runs if _is_word(run[0])]
            if anchors:
                rows.append((max(anchors, key=len), _CUT + _CUT.join(runs) + _CUT, order))
            else:
                wordless.append((keyword_pattern(keyword), order))
    if not rows and not wordless:
        return F.lit(None).cast("string")
    size = max(1, len(rows) // _PER_BUCKET)
    buckets: list[dict[str, list]] = [{} for _ in range(size)]
    for word, marked, order in rows:
        buckets[zlib.crc32(word.encode()) % size].setdefault(word, []).append(
            {"marked": marked, "order": order})
    table = F.from_json(
        F.lit(json.dumps(buckets)), "array<map<string,array<struct<marked:string,order:int>>>>")
    names = F.from_json(F.lit(json.dumps([b.name for b in brands])), "array<string>")

    def known(word: Column) -> Column:
        bucket = F.get(table, F.pmod(F.crc32(word.cast("binary")), F.lit(size)).cast("int"))
        return F.coalesce(F.try_element_at(bucket, word), F.expr(
            "CAST(array() AS array<struct<marked:string,order:int>>)"))

    def orders(marked: Column) -> Column:
        words = F.array_distinct(F.split(marked, _CUT))
        found = F.flatten(F.transform(words, lambda word: F.transform(
            F.filter(known(word), lambda k: F.contains(marked, k["marked"])), lambda k: k["order"])))
        plain = F.replace(marked, F.lit(_CUT), F.lit(""))
        signs = [F.when(plain.rlike(pattern), F.lit(order)) for pattern, order in wordless]
        return F.least(F.array_min(found), *signs) if signs else F.array_min(found)

    # One-element arrays make Spark mark the text once and not once per use.
    clear = F.replace(F.lower(text), F.lit(_CUT), F.lit(" "))
    marked = F.regexp_replace(clear, f"([{_WORD}]+)", f"{_CUT}$1{_CUT}")
    return F.get(F.transform(F.transform(F.array(marked), orders), lambda o: F.get(names, o)), 0)


def keep_matched(
    df: DataFrame, text: str, brands: Sequence[Brand], counters: Observation | None = None,
) -> DataFrame:
    """The rows that match a brand, with its name as ``brand``.

    ``counters`` reports how many rows were ``sent`` on and how many ``skipped``.
    """
    matched = df.withColumn("brand", match_brand(F.col(text), brands))
    if counters is not None:
        matched = matched.observe(
            counters, F.count("brand").alias("sent"),
            F.count_if(F.col("brand").isNull()).alias("skipped"))
    return matched.where(F.col("brand").isNotNull())
