"""Every query of the catalog against its SQL on the smallest tables, and the shape of plans."""

import os

import pytest
from compare import connect, difference

import __spark_entry__ as entry
from tidewatch.catalog import oracle, queries

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def database():
    return connect(FOLDER)


def test_every_query_has_its_sql():
    assert set(queries.queries()) == set(oracle.oracle_sql())
    assert set(entry.queries()) >= set(queries.queries())
    assert set(entry.queries()) >= set(entry.oracle_sql()) >= set(oracle.oracle_sql())


@pytest.mark.parametrize("name", list(queries.queries()))
def test_query(spark, database, name):
    assert difference(entry.queries()[name](spark, FOLDER), database, entry.oracle_sql()[name]) == ""


def test_entry(spark):
    assert entry.entry(spark).count() > 0


STREAMS = {"stream_aggregates", "stream_alerts"}
WRITERS = {"upsert_aggregates", "append_alerts", "dump_folder_scan", "stored_aggregates", "brand_counters"}


def test_plans_hold_no_cross_join_and_scan_few_columns(spark):
    for name, query in queries.queries().items():
        if name in STREAMS | WRITERS:
            continue
        plan = query(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
    plan = entry.queries()["sliding_aggregates"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "props" not in plan and "n_chars" not in plan and "lang" not in plan.replace("language", "")
