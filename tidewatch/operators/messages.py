"""Decoding, cleaning and filtering of messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from tidewatch.functions.numbers import event_time, lenient_long
from tidewatch.functions.text import MESSAGE_LIMIT, MIN_MESSAGE, clean, clip, is_bot, join_parts
from tidewatch.schemas import RAW_MESSAGE

UNREADABLE = "_unreadable"


def _parsed(value: str | Column, names: list[str]) -> Column:
    """A JSON text as a record of texts."""
    wide = StructType([StructField(n, StringType()) for n in (*names, UNREADABLE)])
    return F.from_json(value, wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": UNREADABLE})


def _readable(record: Column) -> Column:
    """Whether what ``_parsed`` gives comes from a JSON object."""
    return F.coalesce(record.isNotNull() & record[UNREADABLE].isNull(), F.lit(False))


def _typed(field: StructField) -> Column:
    """A field read as text in its type; numbers may be quoted, whole ones have decimals."""
    text = F.col(f"_record.{field.name}")
    if isinstance(field.dataType, LongType):
        whole = F.trim(text).try_cast("bigint")
        return F.coalesce(whole, lenient_long(text, None))
    if isinstance(field.dataType, DoubleType):
        return F.trim(text).try_cast("double")
    return text.cast(field.dataType)


def decode(
    df: DataFrame, value: str = "value", schema: StructType = RAW_MESSAGE, marked: str | None = None
) -> DataFrame:
    """Parse a JSON text column once into typed columns; rows that are no JSON object go.

    Every field is read as text first, so a value of another type costs that value at most
    (it becomes null) and never the record. Columns of ``df`` other than ``value`` are kept.
    With ``marked`` all rows stay, and a column of that name tells which are JSON objects.
    """
    others = [c for c in df.columns if c != value]
    # As in keep_long: conditions on the fields would else be pushed down and parse the text again.
    record = F.array(_parsed(value, schema.names))
    rows = df.select(*others, F.explode(record if marked else F.filter(record, _readable)).alias("_record"))
    mark = [_readable(F.col("_record")).alias(marked)] if marked else []
    return rows.select(*others, *[_typed(f).alias(f.name) for f in schema], *mark)


def unreadable(df: DataFrame, value: str = "value") -> DataFrame:
    """The rows ``decode`` leaves out."""
    return df.where(~_readable(_parsed(value, [])))


def encode(df: DataFrame) -> DataFrame:
    """Every row as one JSON text column ``value``."""
    return df.select(F.to_json(F.struct("*")).alias("value"))


def brand_key(brand: str | Column = "brand") -> Column:
    """The key a record is grouped by; a record without a brand goes to ``_``."""
    name = F.col(brand) if isinstance(brand, str) else brand
    return F.coalesce(F.nullif(name, F.lit("")), F.lit("_"))


def with_event_time(df: DataFrame, broker_time: str | None = None) -> DataFrame:
    broker = F.col(broker_time) if broker_time else None
    return df.withColumn("event_time", event_time("created_utc", broker))


def clean_messages(df: DataFrame, text: Column | None = None) -> DataFrame:
    """Add the whole cleaned ``text``; drop automated authors and texts that are too short."""
    raw = join_parts("title", "body") if text is None else text
    kept = df.where(~is_bot("author")) if "author" in df.columns else df
    return keep_long(kept, clean(raw), "text", MIN_MESSAGE)


def sent_on(scored: DataFrame, limit: int | None = MESSAGE_LIMIT) -> DataFrame:
    """Scored messages as they are sent on: with the first ``limit`` characters of their text."""
    return scored.withColumn("text", clip(F.col("text"), limit))


def keep_long(df: DataFrame, text: Column, into: str, shortest: int) -> DataFrame:
    """Add ``text`` and keep the rows where it has at least ``shortest`` characters.

    A filter on a computed column is pushed below its projection and computes it a second
    time. Exploding an array of one or no element computes the text once.
    """
    others = [c for c in df.columns if c != into]
    long_enough = F.filter(F.array(text), lambda t: F.length(t) >= shortest)
    return df.select(*others, F.explode(long_enough).alias(into))
