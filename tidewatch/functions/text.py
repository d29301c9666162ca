"""Text cleaning as column expressions that stay inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space, links, markdown signs, automated authors.
SPACE = r"\t-\r\x1c-\x20\x85\p{Z}"
LINK = rf"https?://[^{SPACE}]+"
MARKDOWN = r"[*_>~`]+"
# What cleaning turns into one blank: a run of space and marks, unless it is a single blank already.
_BETWEEN = rf"(?! [^{SPACE}*_>~`])[{SPACE}*_>~`]+"
BOT = r"(?i)(bot|automoderator)$"

MESSAGE_LIMIT = 512
SAMPLE_LIMIT = 280
MIN_MESSAGE = 5
MIN_CORPUS_TEXT = 8


def strip_space(text: Column) -> Column:
    """Strip any Unicode white space from both ends (``trim`` knows only the blank)."""
    return F.regexp_replace(text, rf"^[{SPACE}]+|[{SPACE}]+$", "")


def join_parts(*parts: Column | str) -> Column:
    """The non-empty parts, one blank between them."""
    columns = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.concat_ws(" ", *[F.nullif(c, F.lit("")) for c in columns])


def drop_links(text: Column | str) -> Column:
    text = F.col(text) if isinstance(text, str) else text
    # Most texts have none, which is found out much faster.
    return F.when(F.contains(text, F.lit("://")), F.regexp_replace(text, LINK, " ")).otherwise(text)


def drop_markdown(text: Column) -> Column:
    return F.regexp_replace(text, MARKDOWN, " ")


def collapse_space(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, rf"[{SPACE}]+", " "))


def clean(text: Column) -> Column:
    """Links, then markdown, then white space; the whole text, nothing cut."""
    return F.trim(F.regexp_replace(drop_links(text), _BETWEEN, " "))


def clip(text: Column, limit: int | None) -> Column:
    """The first ``limit`` characters, or the whole text without a limit."""
    return text if limit is None else F.left(text, F.lit(limit))


def is_bot(author: Column | str) -> Column:
    """Whether the author's name ends like an automated account; null and blank do not."""
    name = F.col(author) if isinstance(author, str) else author
    return F.coalesce(strip_space(name).rlike(BOT), F.lit(False))
