"""Chat formatting with typed content parts, native operations only.

A message holds parts of type text, image, audio or document. A visitor flattens them in order
into one text: text as it is, every attachment as a numbered placeholder, while references and
the tokens an attachment expands to are recorded. A turn becomes

    <|turn|>ROLE\\nTEXT<|end|>\\n

In texts and roles a backslash is put into every control string (and into every string that
already holds such a backslash), which ``restore`` takes out again: no text can close a turn.
Texts of the roles in ``LEARNT`` are under the loss mask; its spans are recorded with the turn.

A turn is one row, so a conversation of any length is never held as a whole; offsets within the
conversation come from sums over blocks of turns. ``assembled`` joins the turns of a conversation
into a text where one is wanted.

Edge cases: null texts and roles are empty, null parts of a message are skipped; turns of equal
number are ordered by role and text, those without a number come first; repeated rows all count;
a null conv_id is a conversation of its own; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN, END = "<|turn|>", "<|end|>"
#: Also the markers of other templates, so that no text can forge those either.
_CONTROL = r"(\||/?s>|/?INST\])"
LEARNT = ("assistant",)
BLOCK = 256
#: Tokens that an attachment expands to: per image tile, per second of audio, per page.
TILE, TILE_TOKENS, IMAGE_TOKENS, SECOND_TOKENS, PAGE_TOKENS = 512, 170, 85, 25, 600
PART = ("struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>")


def escape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])(\\*){_CONTROL}", r"$1$2\\$3")


def restore(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])(\\*)\\{_CONTROL}", r"$1$2$3")


def _escape_role(role: Column) -> Column:
    return F.replace(F.replace(escape(role), F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A"))


def _restore_role(role: Column) -> Column:
    return restore(F.replace(F.replace(role, F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%")))


def text_part(text: Column) -> Column:
    """A message of one text part."""
    return F.array(F.struct(
        F.lit("text").alias("type"), text.alias("text"), F.lit(None).cast("string").alias("ref"),
        F.lit(None).cast("int").alias("width"), F.lit(None).cast("int").alias("height"),
        F.lit(None).cast("double").alias("seconds"), F.lit(None).cast("int").alias("pages"))
    ).cast(f"array<{PART}>")


def expanded_tokens(part: Column) -> Column:
    """Tokens that stand for an attachment: image tiles, seconds of audio, pages."""
    def tiles(size: str) -> Column:
        return F.ceil(F.greatest(F.coalesce(part[size], F.lit(TILE)), F.lit(1)) / TILE)

    return F.when(part["type"] == "image", IMAGE_TOKENS + TILE_TOKENS * tiles("width") * tiles("height")).when(
        part["type"] == "audio",
        F.ceil(F.greatest(F.coalesce(part["seconds"], F.lit(0.0)), F.lit(0.0)) * SECOND_TOKENS)).when(
        part["type"] == "document", PAGE_TOKENS * F.greatest(F.coalesce(part["pages"], F.lit(1)), F.lit(1))
    ).otherwise(0).cast("bigint")


def visited(parts: Column) -> Column:
    """The message as (text, attachments): escaped text with placeholders, and what they stand for."""
    real = F.transform(F.filter(parts, lambda p: p.isNotNull()), lambda p: F.struct(
        F.coalesce(F.regexp_replace(F.lower(p["type"]), "[^a-z]", ""), F.lit("file")).alias("type"),
        F.coalesce(p["text"], F.lit("")).alias("text"), p.alias("part")))
    files = F.filter(real, lambda p: p["type"] != "text")

    # Texts in a row are joined before they are escaped: together they could form a control string.
    def visit(acc: Column, p: Column) -> Column:
        last, is_text = F.get(acc, F.size(acc) - 1), p["type"] == "text"
        number = F.coalesce(last["number"], F.lit(0))
        return F.when(is_text & (F.coalesce(last["type"], F.lit("")) == "text"), F.concat(
            F.slice(acc, 1, F.size(acc) - 1),
            F.array(F.struct(p["type"].alias("type"), F.concat(last["text"], p["text"]).alias("text"),
                             number.alias("number"))))).otherwise(F.concat(acc, F.array(F.struct(
                                 p["type"].alias("type"), p["text"].alias("text"),
                                 (number + F.when(is_text, 0).otherwise(1)).alias("number")))))

    flat = F.aggregate(
        real, F.expr("CAST(array() AS array<struct<type:string,text:string,number:int>>)"), visit)
    pieces = F.transform(flat, lambda p: F.when(p["type"] == "text", escape(p["text"])).otherwise(
        F.concat(F.lit("<|"), p["type"], F.lit(":"), p["number"].cast("string"), F.lit("|>"))))
    found = F.transform(files, lambda p, i: F.struct(
        (i + 1).alias("number"), p["type"].alias("type"), p["part"]["ref"].alias("ref"),
        expanded_tokens(p["part"]).alias("tokens")))
    return F.struct(F.array_join(pieces, "").alias("text"), found.alias("attachments"))


def formatted_turns(messages: DataFrame, learnt: tuple[str, ...] = LEARNT) -> DataFrame:
    """One row per turn, from ``conv_id``, ``turn``, ``role``, ``parts``.

    Returns ``conv_id``, ``turn``, ``role``, ``block`` (of turns), ``segment``, ``loss`` (offset
    and length of the text under the loss mask within the segment, null if none) and
    ``attachments`` (number, type, reference and tokens of each). Offsets count code points.
    """
    role = F.coalesce(messages["role"], F.lit(""))
    head = F.concat(F.lit(TURN), _escape_role(role), F.lit("\n"))
    seen = messages.select(
        messages["conv_id"], messages["turn"], role.alias("role"), head.alias("head"),
        visited(F.coalesce(messages["parts"], F.expr(f"CAST(array() AS array<{PART}>)"))).alias("seen"))
    return seen.select(
        "conv_id", "turn", "role", F.col("seen.attachments").alias("attachments"),
        F.concat("head", "seen.text", F.lit(END + "\n")).alias("segment"),
        F.when(F.col("role").isin(*learnt), F.struct(
            F.length("head").alias("at"), F.length("seen.text").alias("length"))).alias("loss"),
        # Turns are blocked by their number: no window holds a whole long conversation.
        F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-(1 << 62))).cast("bigint").alias("block"))


def with_offsets(turns: DataFrame) -> DataFrame:
    """Add ``start``, the offset of each segment in its conversation."""
    size = F.length("segment").cast("bigint")
    within = Window.partitionBy("conv_id", "block").orderBy("turn", "role", "segment").rowsBetween(
        Window.unboundedPreceding, -1)
    blocks = turns.groupBy("conv_id", "block").agg(F.sum(size).alias("size"))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select(
        F.col("conv_id").alias("of"), F.col("block").alias("in"),
        F.coalesce(F.sum("size").over(before), F.lit(0)).alias("first"))
    inner = turns.withColumn("inner", F.coalesce(F.sum(size).over(within), F.lit(0)))
    return (inner.join(starts, inner["conv_id"].eqNullSafe(starts["of"]) & (inner["block"] == starts["in"]))
            .withColumn("start", F.col("first") + F.col("inner")).drop("of", "in", "first", "inner"))


def assembled(turns: DataFrame) -> DataFrame:
    """Whole conversations: ``conv_id``, ``formatted``, ``mask`` (per turn, as in ``loss``).

    Blocks of turns are joined first. A row holds one conversation's text, as its reader must.
    """
    ordered = F.sort_array(F.collect_list(F.struct("turn", "role", "segment", "loss")))
    blocks = turns.groupBy("conv_id", "block").agg(ordered.alias("turns")).select(
        "conv_id", "block", F.array_join(F.col("turns.segment"), "").alias("text"),
        F.col("turns.loss").alias("mask"))
    joined = blocks.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("block", "text", "mask"))).alias("blocks"))
    return joined.select(
        "conv_id", F.array_join(F.col("blocks.text"), "").alias("formatted"),
        F.flatten("blocks.mask").alias("mask"))


def parsed(formatted: Column) -> Column:
    """Turns of a formatted conversation as (role, text, segment), texts restored."""
    segments = F.filter(F.split(formatted, r"(?=<\|turn\|>)", -1), lambda s: s != "")

    def turn(segment: Column) -> Column:
        inner = F.substring(segment, len(TURN) + 1, F.length(segment) - len(TURN + END) - 1)
        cut = F.instr(inner, "\n")
        return F.struct(
            _restore_role(F.substring(inner, F.lit(1), cut - 1)).alias("role"),
            restore(F.substring(inner, cut + 1, F.length(inner))).alias("text"), segment.alias("segment"))

    return F.transform(segments, turn)


def digests(whole: DataFrame) -> DataFrame:
    """What reading formatted conversations and their masks back gives, as counts and digests."""
    read = whole.select("conv_id", "formatted", "mask", parsed(F.col("formatted")).alias("turns"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learnt = F.transform(F.filter(F.arrays_zip("turns", "mask"), lambda z: z["mask"].isNotNull()),
                         lambda z: restore(F.substring(
                             z["turns"]["segment"], z["mask"]["at"] + 1, z["mask"]["length"])))
    texts = read.select("conv_id", "formatted", F.size("turns").cast("bigint").alias("n_turns"),
                        told.alias("told"), F.array_join(learnt, "").alias("learnt"))
    return texts.select(
        "conv_id", "n_turns", F.sha2(F.col("told").cast("binary"), 256).alias("turns_sha256"),
        F.length("learnt").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("learnt").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"))
