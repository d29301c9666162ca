"""Personal data: fixed patterns, and a bootstrapped search by context, native operations only.

E-mail addresses, IP addresses, card and phone numbers are found by pattern and check. They are
the seeds: the two words before a seed are a context, and contexts that mostly lead to known
identifiers discover others that no fixed pattern covers. Identifiers and contexts form a graph.
A context's confidence is the summed score of the identifiers it led to, over all places of the
corpus where it stands; an identifier's score is 1 for seeds, else the mean confidence of its
contexts. A context that could not reach ``CONFIDENT`` if all it led to were known identifiers
has confidence 0. Both are computed in turns, ``ROUNDS`` times; candidates in contexts of confidence
``CONFIDENT`` or more become spans of kind ``id``.

Positions count code points, ends are exclusive. Edge cases: null, empty and blank texts have no
spans; rows of equal doc_id and equal text have equal spans; a null doc_id keeps its row; an
empty table gives an empty result. Work grows in proportion to a text and its finds but for sorting
them; the context of a find does not reach back over the find of its kind before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import small, stage_table

KINDS = ("email", "ip", "card", "phone")
FOUND = "id"
# A find may start where the last one ended or where its run of characters starts; all others
# would end alike, so leaving them out keeps the search linear. Possessive repeats cannot matter
# where what follows is none of the repeated characters; they keep long runs off the stack.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Runs of letters and digits with at least one digit, joined by single signs.
CANDIDATE = (r"(?<![A-Za-z0-9])(?=[A-Za-z]*+[0-9])[A-Za-z0-9]++(?:[._@+/:-][A-Za-z0-9]++)*+")
DIGITS = 4
#: The two words before a find; their end is looked at first in so many characters.
CONTEXT = r"(\S++\s++\S++)\s++[\"'(\[]?$"
REACH = 80
ROUNDS = 3
#: Distinct identifiers that a context must have led to.
SUPPORT = 3
CONFIDENT = 0.5
BLOCK = 256
_FAR = (1 << 62)
SPAN = "struct<kind:string,start:bigint,end:bigint>"


def _last(items: Column) -> Column:
    return F.element_at(items, -1)


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once: what stands inside a lambda function as an
    expression, and not as a variable, is computed anew for every entry."""
    return F.element_at(F.transform(F.array(value), body), 1)


def scanned(items: Column, first: Column, merge) -> Column:
    """What ``merge`` makes of ``first`` and all entries before each entry; one entry more at the end.

    Done in blocks, whose arrays are copied per entry.
    """
    def cut(held: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(held) - 1, F.lit(0)), F.lit(BLOCK))
        return F.transform(starts, lambda b: F.slice(held, b + 1, BLOCK))

    def within(block: Column) -> Column:
        return F.aggregate(block, F.array(first), lambda acc, x: F.concat(
            acc, F.array(merge(_last(acc), x))))

    def whole(inner: Column, outer: Column) -> Column:
        pairs = F.arrays_zip(inner.alias("i"), F.slice(outer, F.lit(1), F.size(inner)).alias("o"))
        return F.concat(F.flatten(F.transform(pairs, lambda z: F.transform(
            F.slice(z["i"], F.lit(1), F.size(z["i"]) - 1), lambda x: merge(z["o"], x)))),
            F.array(_last(outer)))

    return let(items, lambda held: let(F.transform(cut(held), within), lambda inner: let(
        within(F.transform(inner, _last)), lambda outer: whole(inner, outer))))


def _zero() -> Column:
    return F.lit(0).cast("bigint")


def running(lengths: Column) -> Column:
    """Sum of all entries before each entry."""
    return scanned(lengths, _zero(), lambda a, b: a + b)


def _valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        part = r"0*+(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5]|)(?![0-9])"
        return value.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        n = F.length(digits)
        doubled = F.aggregate(
            F.sequence(F.lit(1), n), F.lit(0), lambda acc, i: acc + F.when(
                i % 2 == 1, F.substring(digits, n - i + 1, F.lit(1)).cast("int")).otherwise(
                (F.substring(digits, n - i + 1, F.lit(1)).cast("int") * 2) % 10
                + F.floor(F.substring(digits, n - i + 1, F.lit(1)).cast("int") / 5).cast("int")))
        return F.when(n.between(16, 19), doubled % 10 == 0).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(8, 15)
    if kind == FOUND:
        return F.length(digits) >= DIGITS
    return F.lit(True)


def _finds(table: DataFrame, kind: str, pattern: str) -> DataFrame:
    """Add column ``kind``: all valid finds as (kind, start, end, value, context)."""
    values = table.withColumn(
        "_values", F.regexp_extract_all(F.col("text"), F.lit(f"({pattern})"), F.lit(1)))
    some = F.size("_values") > 0
    cut = values.withColumn("_pieces", F.when(some, F.split("text", pattern, -1)))
    lengths = cut.withColumn("_starts", F.when(some, running(F.transform(
        "_pieces", lambda p, i: F.length(p).cast("bigint")
        + F.coalesce(F.length(F.get("_values", i)), F.lit(0))))))

    def find(z: Column) -> Column:
        v, piece = z["v"], z["p"]
        start = z["s"] + F.length(piece)
        near = F.regexp_extract(F.substring(piece, -REACH, REACH), r"\s" + CONTEXT, 1)
        context = F.lower(F.when(near != "", near).otherwise(
            F.regexp_extract(piece, r"(?<!\S)" + CONTEXT, 1)))
        return F.struct(
            F.lit(kind).alias("kind"), start.alias("start"),
            (start + F.length(v)).alias("end"), F.xxhash64(F.lower(v)).alias("value"),
            F.when(context != "", F.xxhash64(F.split(context, r"\s+"))).alias("context"),
            _valid(kind, v).alias("valid"))

    empty = F.expr("CAST(array() AS array<struct<kind:string,start:bigint,end:bigint,"
                   "value:bigint,context:bigint,valid:boolean>>)")
    count = F.size("_values")
    places = F.arrays_zip(F.col("_values").alias("v"), F.slice("_pieces", F.lit(1), count).alias("p"),
                          F.slice("_starts", F.lit(1), count).alias("s"))
    return lengths.withColumn(kind, F.when(some, F.filter(
        F.transform(places, find), lambda s: s["valid"])).otherwise(empty)).drop(
        "_values", "_pieces", "_starts")


def located(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``print`` (hash of the text), ``base`` finds by kind and start, ``others``."""
    table = docs.select(docs["doc_id"], docs["text"], F.xxhash64(docs["text"]).alias("print"))
    for kind, pattern in PATTERNS.items():
        table = _finds(table, kind, pattern)
    table = _finds(table, FOUND, CANDIDATE)
    # Finds of a kind come in order of their start.
    based = table.select("doc_id", "print", F.concat(*KINDS).alias("base"), F.col(FOUND))
    both = (F.size("base") > 0) & (F.size(FOUND) > 0)
    return based.select("doc_id", "print", "base", F.when(both, _clear(
        F.col("base"), F.col(FOUND))).otherwise(F.col(FOUND)).alias("others"))


def _clear(base: Column, others: Column) -> Column:
    """The other finds that overlap no base find: a sorted list of both is passed over twice."""
    def placed(finds: Column, rank: int) -> Column:
        return F.transform(finds, lambda f: F.struct(
            f["start"].alias("start"), F.lit(rank).alias("rank"), f["end"].alias("end"), f.alias("find")))

    merged = F.array_sort(F.concat(placed(base, 0), placed(others, 1)))
    ends = F.transform(merged, lambda m: F.when(m["rank"] == 0, m["end"]).otherwise(_zero()))
    starts = F.transform(F.reverse(merged), lambda m: F.when(m["rank"] == 0, m["start"]).otherwise(
        F.lit(_FAR)))
    # Of each entry the last end before it, and the first start after it, among base finds.
    before = scanned(ends, _zero(), F.greatest)
    after = F.reverse(scanned(starts, F.lit(_FAR), F.least))
    told = F.arrays_zip(merged.alias("m"), before.alias("b"), F.slice(
        after, F.lit(2), F.size(merged)).alias("a"))
    kept = F.filter(told, lambda z: (z["m"]["rank"] == 1) & (z["b"] <= z["m"]["start"])
                    & (z["a"] >= z["m"]["end"]))
    return F.transform(kept, lambda z: z["m"]["find"])


def context_counts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """How often each wanted pair of words (``context``) stands in the texts: ``places``."""
    words = docs.select(F.split(F.lower(docs["text"]), r"\s+").alias("w")).where(F.size("w") > 1)
    pairs = words.select("w", F.explode(F.sequence(F.lit(0), F.size("w") - 2)).alias("i"))
    hashed = pairs.select(F.xxhash64(F.array(
        F.col("w")[F.col("i")], F.col("w")[F.col("i") + 1])).alias("context"))
    return hashed.join(wanted, "context").groupBy("context").agg(F.count("*").alias("places"))


def confident(docs: DataFrame, finds: DataFrame, rounds: int = ROUNDS, support: int = SUPPORT,
              least: float = CONFIDENT) -> DataFrame:
    """The contexts (``context``, ``confidence``) that lead to identifiers."""
    def edges(column: str, seed: bool) -> DataFrame:
        return finds.select("doc_id", "print", F.explode(column).alias("f")).select(
            "f.context", "f.value", F.lit(seed).alias("seed")).where("context IS NOT NULL")

    # Repeated copies of a find are combined before anything is joined.
    graph = (edges("base", True).union(edges("others", False)).groupBy("context", "value")
             .agg(F.count("*").alias("n"), F.max("seed").alias("seed")))
    heard = stage_table(graph.groupBy("context").agg(
        F.count("*").alias("values"), F.sum("n").alias("led")).where(F.col("values") >= support), "pii-heard")
    # Most contexts are common words. Their places in the few texts that hold identifiers tell
    # already that they cannot be confident; only the rest is counted in all texts.
    some = docs.where(docs["text"].rlike("[0-9]{4}|@"))
    there = context_counts(some, small(heard).select("context"))
    open_ = heard.join(there, "context", "left").where(
        F.col("led") >= least * F.coalesce("places", F.lit(0)))
    wanted = stage_table(open_.select("context", "led"), "pii-contexts")
    totals = stage_table(
        context_counts(docs, small(wanted).select("context")).join(wanted, "context")
        .where(F.col("led") >= least * F.col("places")).select("context", "places"), "pii-totals")
    all_of = graph.groupBy("value").agg(F.sum("n").alias("total"))
    known = stage_table(graph.join(totals, "context").join(all_of, "value"), "pii-graph")
    score = F.when(F.col("seed"), 1.0).otherwise(0.0)
    scored = known.withColumn("score", score)
    for turn in range(rounds):
        # A find may be cut out of longer words, so that its context is counted less often.
        trust = scored.groupBy("context").agg(
            (F.sum(F.col("n") * F.col("score")) / F.greatest(F.max("places"), F.sum("n"))).alias("confidence"))
        if turn == rounds - 1:
            return trust.where(F.col("confidence") >= least)
        means = known.join(trust, "context").groupBy("value").agg(
            (F.sum(F.col("n") * F.col("confidence")) / F.max("total")).alias("mean"))
        scored = stage_table(known.join(means, "value").select(
            "context", "n", "places",
            F.when(F.col("seed"), 1.0).otherwise(F.col("mean")).alias("score")), "pii-scores")
    raise ValueError("rounds must be at least 1")


def spans(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``print``, ``base`` and ``found`` of every row: arrays of (kind, start, end)."""
    finds = stage_table(located(docs), "pii-finds")
    trusted = small(stage_table(confident(docs, finds), "pii-trusted"))
    others = finds.select("doc_id", "print", F.explode("others").alias("f")).select(
        "doc_id", "print", "f.kind", "f.start", "f.end", "f.context")
    found = others.join(trusted, "context").groupBy("doc_id", "print").agg(
        F.sort_array(F.collect_set(F.struct("kind", "start", "end"))).alias("found")
    ).withColumnsRenamed({"doc_id": "id", "print": "of"})
    same = F.col("doc_id").eqNullSafe(F.col("id")) & F.col("print").eqNullSafe(F.col("of"))
    plain = F.transform("base", lambda s: F.struct(s["kind"], s["start"], s["end"]))
    none = F.expr(f"CAST(array() AS array<{SPAN}>)")
    return finds.join(found, same, "left").select(
        "doc_id", "print", plain.cast(f"array<{SPAN}>").alias("base"),
        F.coalesce("found", none).alias("found"))


def _listed(items: Column) -> Column:
    return F.array_join(F.transform(items, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame) -> DataFrame:
    """Counts per kind, digest of the base spans and all spans as text, one row per document."""
    table = spans(docs)

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return table.select(
        "doc_id", *map(count, KINDS), F.sha2(_listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _listed(F.concat("base", "found")).alias("spans"), F.size("found").cast("bigint").alias("n_id"))


def _merged(spans_: Column) -> Column:
    """Spans sorted by start, overlapping ones made one under the kind of the first."""
    ends = scanned(F.transform(spans_, lambda s: s["end"]), _zero(), F.greatest)
    count = F.size(spans_)
    told = F.arrays_zip(spans_.alias("s"), F.slice(ends, F.lit(1), count).alias("before"),
                        F.slice(ends, F.lit(2), count).alias("upto"),
                        F.slice(F.concat(F.transform(spans_, lambda s: s["start"]), F.array(F.lit(_FAR))),
                                F.lit(2), count).alias("next"))
    firsts = F.filter(told, lambda z: z["s"]["start"] >= z["before"])
    lasts = F.filter(told, lambda z: z["next"] >= z["upto"])
    return F.transform(F.arrays_zip(firsts.alias("f"), lasts.alias("l")), lambda z: F.struct(
        z["f"]["s"]["kind"].alias("kind"), z["f"]["s"]["start"].alias("start"), z["l"]["upto"].alias("end")))


def _replaced(text: Column, spans_: Column) -> Column:
    """The text up to the end of the last span, every span replaced by its kind.

    Finding a place takes time in its distance from the start, so the text is cut into the parts
    of ``BLOCK`` spans first and these into pieces.
    """
    def part(at: Column) -> Column:
        own = F.slice(spans_, at + 1, BLOCK)
        first = F.when(at == 0, _zero()).otherwise(F.get(spans_, at - 1)["end"])
        return F.struct(first.alias("first"), own.alias("own"), text.substr(
            (first + 1).cast("int"), (_last(own)["end"] - first).cast("int")).alias("text"))

    def piece(p: Column, s: Column, i: Column) -> Column:
        begin = F.when(i == 0, p["first"]).otherwise(F.get(p["own"], i - 1)["end"])
        return F.concat(
            p["text"].substr((begin - p["first"] + 1).cast("int"), (s["start"] - begin).cast("int")),
            F.lit("<"), F.upper(s["kind"]), F.lit(">"))

    parts = F.transform(F.sequence(F.lit(0), F.size(spans_) - 1, F.lit(BLOCK)), part)
    return F.array_join(F.transform(parts, lambda p: F.array_join(
        F.transform(p["own"], lambda s, i: piece(p, s, i)), "")), "")


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns of ``docs``; every span of the text replaced by its kind in angle brackets.

    Overlapping spans are replaced as one, under the kind of the first. A column ``n_chars``
    follows the text where that has changed.
    """
    table = spans(docs).select("doc_id", "print", F.array_sort(
        F.concat("base", "found"), lambda a, b: F.when(a["start"] < b["start"], -1).when(
            a["start"] > b["start"], 1).when(a["end"] > b["end"], -1).when(
            a["end"] < b["end"], 1).otherwise(0)).alias("_spans")).where(F.size("_spans") > 0).distinct()
    merged = _merged(F.col("_spans"))
    table = table.withColumn("_spans", merged).withColumnsRenamed(
        {"doc_id": "_id", "print": "_print"})
    joined = docs.join(table, docs["doc_id"].eqNullSafe(F.col("_id"))
                       & F.xxhash64(docs[text]).eqNullSafe(F.col("_print")), "left")

    clean_part = _replaced(docs[text], F.col("_spans"))
    rest = docs[text].substr((_last(F.col("_spans"))["end"] + 1).cast("int"), F.length(docs[text]))
    clean = F.when(F.col("_spans").isNull(), docs[text]).otherwise(
        F.concat(clean_part, rest))
    changed = {text: clean}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col("_spans").isNull(), docs["n_chars"]).otherwise(
            F.length(clean).cast(docs.schema["n_chars"].dataType))
    return joined.select(*[changed[c].alias(c) if c in changed else docs[c] for c in docs.columns])
