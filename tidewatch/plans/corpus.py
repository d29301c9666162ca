"""Labelled text corpora: a public part, a weakly labelled part, exact splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.lexicon import Lexicon
from tidewatch.functions.numbers import first_present
from tidewatch.functions.sentiment import weak_label, with_polarity
from tidewatch.functions.text import MESSAGE_LIMIT, MIN_CORPUS_TEXT, clip, strip_space
from tidewatch.operators.messages import keep_long
from tidewatch.operators.sampling import random_key, sample_rows, split_by_key
from tidewatch.session import stored

# The names of the two sources.
PUBLIC, WEAK = "public", "reddit_weak"


def weak_corpus(
    records: DataFrame, order: list[str | Column] | None = None, rows: int | None = None,
    lexicon: Lexicon | None = None, keep: tuple[str, ...] = (),
    limit: int | None = MESSAGE_LIMIT,
) -> DataFrame:
    """Texts of dump records with the label the scorer gives them.

    All texts are taken, or the first ``rows`` by ``order``, which is needed then. The whole text is scored;
    ``limit`` is how many of its characters the corpus keeps.
    """
    text = strip_space(first_present("body", "selftext", "title"))
    texts = keep_long(records, text, "text", MIN_CORPUS_TEXT)
    if rows is not None:
        if not order:
            raise ValueError("a number of rows needs an order")
        texts = texts.orderBy(*order).limit(rows)
    scored = with_polarity(texts.select(*keep, "text"), "text", lexicon or Lexicon())
    return scored.select(
        *keep, clip(F.col("text"), limit).alias("text"),
        weak_label(F.col("polarity.compound")).alias("label"), F.lit(WEAK).alias("source"))


def build_corpus(public: DataFrame, weak: DataFrame | None, *order: str, seed: int = 42) -> DataFrame:
    """Both parts together, every text once (public first, then by ``order``), with its split.

    The rows are computed once and stored with a digest of the text and their random key. What is
    then compared, split and joined are these; texts are read once more, for the result.
    """
    rows = public if weak is None else public.unionByName(weak)
    columns = rows.columns
    base = stored(rows.where(F.col("text").isNotNull()).withColumns({
        "_digest": F.unhex(F.md5(F.col("text").cast("binary"))), "_key": random_key(seed, "text"),
        "_at": F.monotonically_increasing_id()}), "corpus")
    rank = [(F.col("source") != PUBLIC).alias("_other"), *order,
            *[c for c in columns if c not in ("text", *order)], "_at", "_key"]
    once = stored(base.groupBy("_digest").agg(F.min(F.struct(*rank)).alias("_first")).select(
        "_first._at", "_first._key"), "corpus-once")
    chosen = split_by_key(once, "_key").select("_at", "split")
    return base.join(chosen, "_at").select(*columns, "split")


def sample_public(public: DataFrame, n: int | None, *ids: str, seed: int = 42) -> DataFrame:
    """The public part cut to ``n`` seeded rows."""
    return public if n is None else sample_rows(public, n, *ids, seed=seed)


def split_stats(corpus: DataFrame) -> DataFrame:
    """Rows per split and label, with the rows of the split and of the corpus."""
    cells = corpus.groupBy("split", "label").agg(F.count("*").alias("label_count"))
    # Nine rows at most from here on.
    totals = cells.groupBy("split").agg(F.sum("label_count").alias("rows"))
    everything = cells.agg(F.sum("label_count")).scalar()
    return cells.join(totals, "split").withColumn("total", everything)
