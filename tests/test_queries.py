import pytest

import __spark_entry__ as entry
from granulake.checks.oracles import oracle_sql
from granulake.checks.queries import _ingest, queries
from oracle_check import difference

SF_DIR = "/root/testdata/sf0.001"


def test_every_query_has_an_oracle():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", queries())
def test_query_equals_its_sql(spark, name):
    assert difference(spark, SF_DIR, name, queries()[name], oracle_sql()[name]) is None


def test_entry(spark):
    assert len(entry.entry(spark).columns) == 25


@pytest.mark.parametrize("name", ["config_metadata", "metadata_csv_line"])
def test_header_texts_are_not_broadcast(spark, name):
    frame = queries()[name](spark, SF_DIR)
    frame.toArrow()
    assert "Broadcast" not in frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["message_granule_join", "granule_csv"])
def test_headers_are_not_broadcast_to_messages(spark, name):
    frame = queries()[name](spark, SF_DIR)
    frame.toArrow()
    assert "Broadcast" not in frame._jdf.queryExecution().executedPlan().toString()


def test_a_batch_broadcasts_no_headers(spark):
    batch = _ingest(spark, SF_DIR)
    batch.persist()
    try:
        assert batch.typed.count()
        plan = batch.typed._jdf.queryExecution().executedPlan().toString()
    finally:
        batch.unpersist()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
