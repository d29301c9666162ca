"""Scorers: functions that add ``label``, ``neg_prob`` and ``confidence`` to a table of texts."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.lexicon import Lexicon
from tidewatch.functions.numbers import round_even
from tidewatch.functions.sentiment import (
    LABELS,
    confidence,
    label_of,
    negative_probability,
    with_polarity,
)

Scorer = Callable[[DataFrame, str], DataFrame]

# Most tokens of a text the model sees, threads per model session.
MAX_TOKENS = 128
THREADS = 1
_BATCH = 128


def lexicon_scorer(lexicon: Lexicon | None = None) -> Scorer:
    """The rule-based scorer; a null text scores like an empty one."""
    lexicon = lexicon or Lexicon()

    def score(df: DataFrame, text: str = "text") -> DataFrame:
        compound, neg = F.col("_polarity.compound"), F.col("_polarity.neg")
        return with_polarity(df, text, lexicon, "_polarity").withColumns({
            "label": label_of(compound),
            "neg_prob": negative_probability(compound, neg),
            "confidence": confidence(compound),
        }).drop("_polarity")

    return score


def neutral_scorer() -> Scorer:
    """What is used when a scorer cannot start and the job should go on regardless."""

    def score(df: DataFrame, text: str = "text") -> DataFrame:
        return df.withColumns({
            "label": F.lit("neu"), "neg_prob": F.lit(0.0), "confidence": F.lit(1.0)})

    return score


def _local(path: str) -> str:
    """A path every executor sees, or a file shipped with ``SparkContext.addFile``."""
    return path if os.path.exists(path) else SparkFiles.get(os.path.basename(path))


def _load_model(model_path: str, tokenizer_path: str, max_tokens: int, threads: int):
    import onnxruntime
    from tokenizers import Tokenizer

    options = onnxruntime.SessionOptions()
    options.intra_op_num_threads = threads
    session = onnxruntime.InferenceSession(
        _local(model_path), sess_options=options, providers=["CPUExecutionProvider"])
    tokenizer = Tokenizer.from_file(_local(tokenizer_path))
    tokenizer.enable_truncation(max_tokens)
    if tokenizer.padding is None:
        pad = next((t for t in ("<pad>", "[PAD]") if tokenizer.token_to_id(t) is not None), None)
        tokenizer.enable_padding(
            **({"pad_id": tokenizer.token_to_id(pad), "pad_token": pad} if pad else {}))
    return session, tokenizer


def model_scorer(
    model_path: str, tokenizer_path: str, max_tokens: int = MAX_TOKENS, threads: int = THREADS
) -> Scorer:
    """A three-class ONNX model, loaded once per task; Arrow batches are cut into model batches."""

    @F.pandas_udf("label string, neg_prob double, confidence double")
    def classify(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        session, tokenizer = _load_model(model_path, tokenizer_path, max_tokens, threads)
        wanted = [i.name for i in session.get_inputs()]
        for series in texts:
            rows = [np.empty((0, len(LABELS)))]
            values = series.fillna("").tolist()
            for start in range(0, len(values), _BATCH):
                encoded = tokenizer.encode_batch(values[start:start + _BATCH])
                feeds = {
                    "input_ids": [e.ids for e in encoded],
                    "attention_mask": [e.attention_mask for e in encoded],
                    "token_type_ids": [e.type_ids for e in encoded],
                }
                logits = session.run(
                    None, {n: np.array(feeds[n], dtype=np.int64) for n in wanted})[0]
                powers = np.exp(logits - logits.max(axis=1, keepdims=True))
                rows.append(powers / powers.sum(axis=1, keepdims=True))
            classes = np.concatenate(rows)
            best = classes.argmax(axis=1)
            yield pd.DataFrame({
                "label": np.array(LABELS)[best],
                "neg_prob": classes[:, 0].astype(float),
                "confidence": classes[np.arange(len(best)), best].astype(float),
            })

    def score(df: DataFrame, text: str = "text") -> DataFrame:
        columns = df.columns
        return df.withColumn("_class", classify(F.col(text))).select(*columns, "_class.*")

    return score


def make_scorer(name: str | None = None, strict: bool = True, **options) -> Scorer:
    """The scorer called ``name``: ``vader`` (word list and rules), ``onnx`` or ``neutral``.

    Without a name the environment variable ``SENTIMENT_BACKEND`` decides. A scorer that
    cannot be set up raises, or gives the neutral one if not ``strict``.
    """
    name = (name or os.environ.get("SENTIMENT_BACKEND", "vader")).lower()
    try:
        if name == "onnx":
            for path in (options["model_path"], options["tokenizer_path"]):
                if not os.path.exists(path):
                    raise FileNotFoundError(path)
            return model_scorer(**options)
        return neutral_scorer() if name == "neutral" else lexicon_scorer(**options)
    except Exception:
        if strict:
            raise
        return neutral_scorer()


def score_messages(df: DataFrame, scorer: Scorer | None = None) -> DataFrame:
    """The scored-message record: label and negative probability to four places."""
    scored = (scorer or lexicon_scorer())(df, "text")
    return scored.withColumn("neg_prob", round_even("neg_prob", 4)).drop("confidence")
