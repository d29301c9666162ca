"""Sentiment: the rule-based scorer and the label rules.

The scorer follows Hutto and Gilbert, "VADER: A Parsimonious Rule-based Model for Sentiment
Analysis of Social Media Text" (2014): word valences, changed by capitals, degree adverbs,
negation, "least" and "never so", phrases with a valence of their own, a contrasting "but" and
punctuation, summed and normalised.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.lexicon import Lexicon, one_of, quoted
from tidewatch.functions.numbers import round_even
from tidewatch.functions.words import seen_words

# Constants of the published method.
NORMALISER = 15.0
CAPITALS = 0.733
NEGATION = -0.74
DISTANCE = (1.0, 0.95, 0.9)
BEFORE_BUT, AFTER_BUT = 0.5, 1.5
EXCLAMATION, MOST_EXCLAMATIONS = 0.292, 4
QUESTION, MANY_QUESTIONS, SOME_QUESTIONS = 0.18, 0.96, 3

# Label cut points, for scoring and for weak labels.
SCORING_CUT = 0.05
WEAK_CUT = 0.3
LABELS = ("neg", "neu", "pos")

_MARK = """.!?,;:-'\""""
_RUN = r"""(?:[.!?,;:\-'"]|!!|!!!|\?\?|\?\?\?|\?!\?|!\?!|\?!\?!|!\?!\?)"""
_PLAIN = r"([^!-/:-@\[-`{-~]{2,})"
_MARKED = quoted(f"^(?:{_RUN}{_PLAIN}|{_PLAIN}{_RUN})$")
# The words that contrast, as bare() would find them.
_RUNS = (*_MARK, "!!", "!!!", "??", "???", "?!?", "!?!", "?!?!", "!?!?")
_TURNS = frozenset(["but", *[f"{run}but" for run in _RUNS], *[f"but{run}" for run in _RUNS]])


def bare(word: str) -> str:
    """A word without the run of marks at one of its ends, if it holds no other punctuation."""
    return f"regexp_replace({word}, {_MARKED}, '$1$2')"


def _loud(word: str) -> str:
    return f"({word} = upper({word}) AND {word} <> lower({word}))"


def _count(text: str, sign: str) -> str:
    return f"(length({text}) - length(replace({text}, '{sign}', '')))"


def with_polarity(df: DataFrame, text: str, lexicon: Lexicon, into: str = "polarity") -> DataFrame:
    """Add a struct of ``compound`` (-1 to 1) and the ``neg``, ``neu``, ``pos`` shares.

    Words are split and looked up in Arrow (``functions.words``); only those found in the lexicon are
    looked at with their context. Each stage is a column of its own: Spark then computes it once per
    row and not once per use.
    """
    columns = df.columns
    source = f"coalesce(`{text}`, '')"

    # Words of two characters or more, punctuation included. Trimming marks is cheap and lets every
    # word through that bare() might turn into a scored one; the exact check then runs on those few
    # only. A "but" may stand in a run of marks.
    marked = [w for w in lexicon.scored if w.strip(_MARK) != w]
    seen = seen_words(source, lexicon.scored, marked, _TURNS, _MARK)
    found = f"""
        filter(
          transform(_seen.found, h -> named_struct('at', h.at, 'word', {bare('h.word')},
            'r1', h.r1, 'r2', h.r2, 'r3', h.r3, 's1', h.s1, 's2', h.s2)),
          h -> {lexicon.scores('lower(h.word)')})"""

    # Capitals stand out only where some words, but not all, are in capitals. They matter for
    # a found word and the three before it, which are null outside the text.
    loud_near = " OR ".join(_loud(f"h.{w}") for w in ("word", "r1", "r2", "r3"))
    stands_out = f"""
        CASE WHEN exists(_found, h -> {loud_near})
        THEN _seen.loud BETWEEN 1 AND _seen.words - 1 ELSE false END"""

    # Position of the first "but", one-based; zero if there is none.
    turn = "IF(size(_found) > 0, _seen.turn, 0)"

    # The three words before a found one, bare, and all of them and the two after it in lower case.
    near = f"""
        transform(
          transform(_found, h -> named_struct('at', h.at, 'word', h.word,
            'b1', {bare('h.r1')}, 'b2', {bare('h.r2')}, 'b3', {bare('h.r3')},
            'n1', lower({bare('h.s1')}), 'n2', lower({bare('h.s2')}))),
          h -> named_struct('at', h.at, 'word', h.word, 'b1', h.b1, 'b2', h.b2, 'b3', h.b3, 'n1', h.n1, 'n2', h.n2,
            'w0', lower(h.word), 'w1', lower(h.b1), 'w2', lower(h.b2), 'w3', lower(h.b3)))"""
    turns = lexicon.turns
    w0, w1, w2, w3 = (f"h.w{d}" for d in range(4))
    never, doubt = quoted(turns.never), tuple(map(quoted, turns.without))

    def negated(word: str, kept: str, strong: str) -> str:
        return (f"CASE WHEN {strong} THEN {turns.stronger}D WHEN {kept} THEN 1D "
                f"WHEN {lexicon.negates(word)} THEN {NEGATION}D ELSE 1D END")

    # What a word before does to the valence: "never so good" is stronger, "without doubt" stays.
    factors = (
        f"IF({lexicon.negates(w1)}, {NEGATION}D, 1D)",
        negated(w2, f"{w2} = {doubt[0]} AND {w1} = {doubt[1]}", f"{w2} = {never} AND {one_of(w1, turns.so)}"),
        negated(w3, f"{w3} = {doubt[0]} AND ({w2} = {doubt[1]} OR {w1} = {doubt[1]})",
                f"({w3} = {never} AND {one_of(w2, turns.so)}) OR {one_of(w1, turns.so)}"),
    )
    start = (f"{lexicon.valence(w0)} + IF(_stands_out AND {_loud('h.word')}, "
             f"signum({lexicon.valence(w0)}) * {CAPITALS}D, 0D)")

    def let(value: str, name: str, body: str) -> str:
        return f"element_at(transform(array({value}), {name} -> {body}), 1)"

    def after(v: str, d: int) -> str:
        own, low = f"h.b{d + 1}", f"h.w{d + 1}"
        shift = (f"{DISTANCE[d]}D * ({lexicon.degree(low)} * IF({v} < 0, -1, 1) "
                 f"+ IF(_stands_out AND {_loud(own)}, IF({v} > 0, {CAPITALS}D, -{CAPITALS}D), 0D))")
        moved = f"({v} + coalesce({shift}, 0D)) * {factors[d]}"
        if d == 2:
            moved = let(moved, "u", _in_phrases("u"))
        return f"CASE WHEN {own} IS NULL OR {lexicon.contains(low)} THEN {v} ELSE {moved} END"

    def _in_phrases(v: str) -> str:
        """The valence of a phrase the word belongs to, or that stands right before it."""
        def joined(*words: str) -> str:
            return f"concat_ws(' ', {', '.join(words)})"

        before = [joined(w1, w0), joined(w2, w1, w0), joined(w2, w1), joined(w3, w2, w1), joined(w3, w2)]
        fore = f"coalesce({', '.join(map(lexicon.phrase, before))}, {v})"
        # A phrase that begins with the word comes last and counts.
        own = (f"coalesce(IF(h.n2 IS NOT NULL, {lexicon.phrase(joined(w0, 'h.n1', 'h.n2'))}, NULL), "
               f"IF(h.n1 IS NOT NULL, {lexicon.phrase(joined(w0, 'h.n1'))}, NULL), {fore})")
        extra = [f"coalesce({lexicon.phrase_degree(p)}, 0D)" for p in (before[3], before[4], before[2])]
        return f"({own} + {' + '.join(extra)})"

    # "least good" is turned round, "at least good" is not.
    least = f"""
        IF({w1} = {quoted(turns.least)} AND NOT {lexicon.contains(w1)}
           AND NOT coalesce({one_of(w2, turns.not_least)}, false), {NEGATION}D, 1D)"""
    chain = let(start, "v0", let(after("v0", 0), "v1", let(after("v1", 1), "v2", after("v2", 2))))
    valences = f"""
        transform(_near, h -> {chain} * coalesce({least}, 1D)
          * CASE WHEN _turn = 0 OR h.at + 1 = _turn THEN 1D
            WHEN h.at + 1 < _turn THEN {BEFORE_BUT}D ELSE {AFTER_BUT}D END)"""

    questions = _count(source, "?")
    emphasis = f"""
        least({_count(source, '!')}, {MOST_EXCLAMATIONS}) * {EXCLAMATION}D
        + CASE WHEN {questions} > {SOME_QUESTIONS} THEN {MANY_QUESTIONS}D
          WHEN {questions} > 1 THEN {questions} * {QUESTION}D ELSE 0D END"""

    def share(part: str) -> Column:
        return F.when(F.expr("_words > 0"), round_even(
            f"{part} / (_rise + _fall + _flat)", 3)).otherwise(0.0)

    return (
        df.withColumn("_seen", seen)
        .transform(_with, _words="_seen.words", _found=found)
        .transform(_with, _stands_out=stands_out, _turn=turn, _near=near)
        .transform(_with, _valences=valences)
        .transform(
            _with,
            _sum="aggregate(_valences, 0D, (t, v) -> t + v)",
            _up="aggregate(_valences, 0D, (t, v) -> t + IF(v > 0, v + 1, 0D))",
            _down="aggregate(_valences, 0D, (t, v) -> t + IF(v < 0, 1 - v, 0D))",
            _flat="_words - size(filter(_valences, v -> v <> 0))",
            _push=emphasis)
        .transform(
            _with,
            _total="_sum + signum(_sum) * _push",
            _rise="_up + IF(_up > _down, _push, 0D)",
            _fall="_down + IF(_up < _down, _push, 0D)")
        .transform(_with, _compound=f"_total / sqrt(_total * _total + {NORMALISER}D)")
        .select(*columns, F.struct(
            F.when(F.expr("_words > 0"), round_even("_compound", 4)).otherwise(0.0)
            .alias("compound"),
            share("_fall").alias("neg"), share("_flat").alias("neu"), share("_rise").alias("pos"),
        ).alias(into))
    )


def _with(df: DataFrame, **expressions: str) -> DataFrame:
    return df.withColumns({name: F.expr(sql) for name, sql in expressions.items()})


def label_of(compound: Column, cut: float = SCORING_CUT) -> Column:
    return F.when(compound <= -cut, "neg").when(compound >= cut, "pos").otherwise("neu")


def weak_label(compound: Column) -> Column:
    return label_of(compound, WEAK_CUT)


def negative_probability(compound: Column, neg: Column) -> Column:
    return F.when(compound < 0, neg).otherwise(neg * 0.3)


def confidence(compound: Column) -> Column:
    return F.when(compound == 0, 1.0).otherwise(F.abs(compound))


def softmax(logits: Column) -> Column:
    """Class probabilities from an array of logits, shifted by the largest for stability."""
    powers = F.transform(logits, lambda x: F.exp(x - F.array_max(logits)))
    total = F.aggregate(powers, F.lit(0.0), lambda acc, x: acc + x)
    return F.transform(powers, lambda p: p / total)


def class_scores(probabilities: Column) -> tuple[Column, Column, Column]:
    """Label, negative probability and confidence from the class probabilities."""
    best = F.array_max(probabilities)
    at = F.array_position(probabilities, best).cast("int")
    return F.get(F.array(*map(F.lit, LABELS)), at - 1), F.get(probabilities, 0), best


def severity(z: Column) -> Column:
    # Severity steps of the z-score.
    return (
        F.when(z >= 6.0, "critical").when(z >= 4.5, "high").when(z >= 3.0, "medium")
        .otherwise("low")
    )
