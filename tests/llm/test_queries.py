"""All registered queries and the pipeline on the smallest tables."""

import os

import pytest

import corpus_pipeline
from compare import connect, difference
from tidewatch.llm import decontam, pii, quality, queries, simhash
from tidewatch.llm.common import drop_stage_tables, read, stage_table

TABLES = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(TABLES), reason="no test tables")

COLUMNS = {
    1: "doc_id item_id matched windows coverage reparameterised",
    2: "doc_id start n_tokens ids_crc32", 3: "query_id rank vec_id score",
    4: "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars",
    5: "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    6: "doc_id n_email n_ip n_card n_phone base_sha256 spans n_id",
    7: "doc_id held_out score predicted", 8: "doc_id held_out score predicted",
    9: "doc_id held_out lang_pred score ambiguous", 10: "doc_id fingerprint component_id copies",
    11: "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley",
    12: "item_id rank doc_id score", 13: "doc_id n_lines n_dropped kept_sha256",
}


def test_names():
    assert [int(n[2:].split("_")[0]) for n in queries.queries()] == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality", "near_duplicates", "decontamination", "personal_data", "packing"]


@pytest.mark.parametrize("name", list(queries.queries()))
def test_query(spark, name):
    df = queries.queries()[name](spark, TABLES)
    number = int(name[2:].split("_")[0])
    assert df.columns == COLUMNS[number].split(" ")
    rows = df.count()
    if number in (2, 6, 7, 8, 9, 10, 13):
        assert rows == read(spark, TABLES, "documents").count()
    else:
        assert rows > 0


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    connection = connect(TABLES)
    assert not difference(queries.queries()[name](spark, TABLES), connection, queries.oracle_sql()[name])


def test_pipeline_matches_the_operators_by_hand(spark):
    """Every stage against its operator's plain result on the stage's own input."""
    docs = read(spark, TABLES, "documents")
    labels, items = read(spark, TABLES, "labels"), read(spark, TABLES, "benchmark")
    for name, stage in corpus_pipeline.STAGES:
        out = stage_table(stage(spark, docs, TABLES), f"test-{name}")
        before = {r["doc_id"]: r for r in docs.collect()}
        rows = out.collect()
        if name != "packing":
            assert out.columns == docs.columns
        got = {r["doc_id"]: r for r in rows}
        if name == "quality":
            want = {r["doc_id"] for r in quality.predictions(docs, labels).collect() if r["predicted"]}
        elif name == "near_duplicates":
            want = {r["component_id"] for r in simhash.near_duplicates(docs).collect()}
        elif name == "decontamination":
            want = set(before) - {r["doc_id"] for r in decontam.contaminated(docs, items).collect()}
        else:
            want = set(before)
        assert set(got) == want
        if name == "personal_data":
            spans = {r["doc_id"]: r["spans"] for r in pii.report(docs).collect()}
            for i, row in got.items():
                text, at = "", 0
                for kind, a, b in sorted((s.split(":") for s in spans[i].split(",") if s),
                                         key=lambda s: int(s[1])):
                    text += before[i]["text"][at:int(a)] + f"<{kind.upper()}>"
                    at = int(b)
                assert row["text"] == text + before[i]["text"][at:]
                assert row["n_chars"] == len(row["text"])
        elif name == "packing":
            tokens = {}
            for r in rows:
                tokens[r["doc_id"]] = tokens.get(r["doc_id"], 0) + r["length"]
                assert r["offset"] + r["length"] <= 2048
            assert all(tokens[r["doc_id"]] == r["doc_tokens"] for r in rows)
        else:
            assert all(got[i] == before[i] for i in got)
        docs = out
    assert corpus_pipeline.run(spark, TABLES).count() == len(rows)


def test_stage_tables_are_removed(spark):
    other = stage_table(spark.range(5), "test-other")
    table = stage_table(spark.range(3), "test")
    drop_stage_tables(spark, keep=table)
    assert table.count() == 3
    assert not os.path.isdir(other._jdf.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file:"))
    folder = table.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://").removeprefix("file:")
    assert os.path.isdir(folder)
    drop_stage_tables(spark)
    assert not os.path.isdir(folder)
