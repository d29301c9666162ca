"""From dump records and live items to the message contract."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.numbers import first_present, lenient_double, lenient_long
from tidewatch.functions.text import join_parts, strip_space
from tidewatch.schemas import DUMP, RAW_MESSAGE


def with_missing(records: DataFrame) -> DataFrame:
    """Add the dump columns a source does not have, as nulls."""
    absent = [f for f in DUMP.fields if f.name not in records.columns]
    return records.withColumns({f.name: F.lit(None).cast(f.dataType) for f in absent})


def record_text(title="title", selftext="selftext", body="body") -> Column:
    """The text a brand is looked for in."""
    return join_parts(title, selftext, body)


def ingest_seconds() -> Column:
    return F.unix_micros(F.current_timestamp()) / F.lit(1e6)


def record_type() -> Column:
    """``submission`` or ``comment``: as stated, else a body without a title is a comment."""
    stated = F.lower(strip_space(first_present("type", "kind", default=F.lit(""))))
    untitled = first_present("body").isNotNull() & first_present("title").isNull()
    return (
        F.when(stated.isin("comment", "submission"), stated)
        .when(untitled, "comment").otherwise("submission")
    )


def normalise(records: DataFrame, brand: str = "brand") -> DataFrame:
    """Dump records, already matched to a brand, as messages."""
    nothing = F.lit("")
    values = {
        "id": first_present("id", "name", default=nothing),
        "type": record_type(),
        "subreddit": first_present("subreddit", default=F.lit("unknown")),
        "author": first_present("author"),
        "brand": F.col(brand),
        "title": first_present("title"),
        "body": first_present("body", "selftext", "text", default=nothing),
        "permalink": first_present("permalink"),
        "score": lenient_long(first_present("score")),
        "parent_id": first_present("parent_id"),
        "created_utc": lenient_double(first_present("created_utc", "created", "timestamp")),
        "ingested_at": ingest_seconds(),
    }
    return with_missing(records).select(*[values[f.name].alias(f.name) for f in RAW_MESSAGE])


def normalise_items(items: DataFrame, kind: str, brand: str = "brand") -> DataFrame:
    """Items of the live listing, all ``submission`` or all ``comment``, as messages."""
    if kind not in ("submission", "comment"):
        raise ValueError(f"unknown kind {kind!r}")
    post = kind == "submission"
    none = F.lit(None).cast("string")
    values = {
        "type": F.lit(kind),
        "brand": F.col(brand),
        "title": F.col("title") if post else none,
        "body": F.coalesce(F.col("selftext" if post else "body"), F.lit("")),
        "score": F.coalesce(F.col("score").cast("bigint"), F.lit(0)),
        "parent_id": none if post else F.col("parent_id"),
        "created_utc": F.col("created_utc").cast("double"),
        "ingested_at": ingest_seconds(),
    }
    return items.select(*[values.get(f.name, F.col(f.name)).alias(f.name) for f in RAW_MESSAGE])


def item_text(kind: str) -> Column:
    """The text of a live item a brand is looked for in."""
    return join_parts("title", "selftext") if kind == "submission" else F.coalesce("body", F.lit(""))
