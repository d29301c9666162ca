"""The model scorer, with a tiny model written out by hand."""

import math
import struct

import pytest

from tidewatch.operators.scoring import make_scorer, score_messages

tokenizers = pytest.importorskip("tokenizers")
pytest.importorskip("onnxruntime")


def varint(n):
    out = b""
    while True:
        n, low = n >> 7, n & 127
        out += bytes([low | (128 if n else 0)])
        if not n:
            return out


def field(number, value):
    """One field of the model file: a number, a float, or anything with a length."""
    if isinstance(value, int):
        return varint(number << 3) + varint(value)
    data = value.encode() if isinstance(value, str) else value
    return varint(number << 3 | 2) + varint(len(data)) + data


def tensor(name, dims, values):
    return (b"".join(field(1, d) for d in dims) + field(2, 1) + field(8, name)
            + field(9, struct.pack(f"<{len(values)}f", *values)))


def node(op, inputs, output, **attributes):
    """``axes`` is a list of numbers, other attributes are single numbers."""
    out = b"".join(field(1, i) for i in inputs) + field(2, output) + field(4, op)
    for name, value in attributes.items():
        many = isinstance(value, list)
        body = field(1, name) + (b"".join(field(8, v) for v in value) if many else field(3, value))
        out += field(5, body + field(20, 7 if many else 2))
    return out


def value_info(name, kind, dims):
    shape = b"".join(field(1, field(2, d) if isinstance(d, str) else field(1, d)) for d in dims)
    return field(1, name) + field(2, field(1, field(1, kind) + field(2, shape)))


def model(table):
    """Logits are the sum of a row of ``table`` per token that the mask lets through."""
    nodes = [
        node("Gather", ["table", "input_ids"], "rows", axis=0),
        node("Cast", ["attention_mask"], "mask", to=1),
        node("Unsqueeze", ["mask"], "wide", axes=[2]),
        node("Mul", ["rows", "wide"], "kept"),
        node("ReduceSum", ["kept"], "logits", axes=[1], keepdims=0),
    ]
    graph = (b"".join(field(1, n) for n in nodes) + field(2, "g")
             + field(5, tensor("table", [len(table), 3], [x for row in table for x in row]))
             + field(11, value_info("input_ids", 7, ["n", "t"])) + field(11, value_info("attention_mask", 7, ["n", "t"]))
             + field(12, value_info("logits", 1, ["n", 3])))
    return field(1, 6) + field(7, graph) + field(8, field(1, "") + field(2, 11))


@pytest.fixture
def files(tmp_path):
    vocabulary = {"<pad>": 0, "<unk>": 1, "bad": 2, "good": 3, "day": 4}
    tokenizer = tokenizers.Tokenizer(tokenizers.models.WordLevel(vocabulary, unk_token="<unk>"))
    tokenizer.pre_tokenizer = tokenizers.pre_tokenizers.Whitespace()
    tokenizer.save(str(tmp_path / "tokenizer.json"))
    (tmp_path / "model.onnx").write_bytes(model([(9, 9, 9), (0, 1, 0), (2, 0, 0), (0, 0, 3), (0, 0.5, 0)]))
    return {"model_path": str(tmp_path / "model.onnx"), "tokenizer_path": str(tmp_path / "tokenizer.json")}


def probabilities(*logits):
    powers = [math.exp(x) for x in logits]
    return [p / sum(powers) for p in powers]


def test_model_scorer(spark, files):
    texts = ["bad bad day", "good", "day", None, "bad " * 500, "unheard word"] * 60
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string").repartition(3)
    got = {r["i"]: r for r in make_scorer("onnx", **files)(df, "text").collect()}
    want = [probabilities(4, 0.5, 0), probabilities(0, 0, 3), probabilities(0, 0.5, 0), probabilities(0, 0, 0),
            probabilities(256, 0, 0), probabilities(0, 2, 0)]
    for i, row in got.items():
        p = want[i % 6]
        assert row["neg_prob"] == pytest.approx(p[0], abs=1e-6) and row["confidence"] == pytest.approx(max(p), abs=1e-6)
        assert row["label"] == ("neg", "neu", "pos")[p.index(max(p))]
    scored = score_messages(df, make_scorer("onnx", **files))
    assert scored.where("i = 2").first()["neg_prob"] == round(want[2][0], 4)


def test_choice_of_scorer(spark, monkeypatch, files):
    df = spark.createDataFrame([("a terrible scam",)], "text string")
    assert make_scorer()(df, "text").first()["label"] == "neg"
    monkeypatch.setenv("SENTIMENT_BACKEND", "neutral")
    assert make_scorer()(df, "text").first()["label"] == "neu"
    missing = {**files, "model_path": "/nowhere"}
    with pytest.raises(FileNotFoundError):
        make_scorer("onnx", **missing)
    row = make_scorer("onnx", strict=False, **missing)(df, "text").first()
    assert (row["label"], row["neg_prob"]) == ("neu", 0.0)
