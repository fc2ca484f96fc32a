import pytest
from pyspark.sql import functions as F

from granulake.operators import ordering
from granulake.operators.joins import join_unique


@pytest.fixture(scope="module")
def tied(spark):
    """A third of the rows share one time."""
    rows = spark.range(0, 3000, 1, 7).select(
        F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 11).alias("t"),
        F.md5(F.col("id").cast("string")).alias("path"),
    )
    return rows, sorted((r.t, r.path) for r in rows.collect())


def test_positions_follow_the_global_order(tied):
    rows, expected = tied
    placed = ordering.with_position(rows, ["t", "path"]).collect()
    assert [(r.t, r.path) for r in sorted(placed, key=lambda r: r.position)] == expected
    assert sorted(r.position for r in placed) == list(range(1, 3001))


@pytest.mark.parametrize(("offset", "n"), [(0, 10), (995, 20), (0, 1500), (2990, 50), (4000, 5)])
def test_pages_of_any_size(tied, offset, n):
    rows, expected = tied
    page = ordering.page(rows, ["t", "path"], offset, n).collect()
    assert sorted((r.t, r.path) for r in page) == expected[offset : offset + n]


def test_no_limit_means_no_sort(tied):
    rows, _ = tied
    assert ordering.first_rows(rows, ["t"], None) is rows


@pytest.mark.parametrize("how", ["left", "left_anti", "left_semi"])
def test_hot_keys_are_split_against_an_aggregated_side(spark, how):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        left = spark.range(0, 300000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"),
            F.md5(F.col("id").cast("string")).alias("v"),
        )
        right = spark.range(0, 300000, 1, 8).groupBy((F.col("id") % 1000).alias("k")).count()
        joined = join_unique(left, right, ["k"], how)
        found = joined.toArrow().num_rows
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    hits = left.filter("k < 1000").count()
    assert found == {"left": 300000, "left_semi": hits, "left_anti": 300000 - hits}[how]
    assert "skew=true" in plan


def test_null_keys_match_nothing(spark):
    left = spark.createDataFrame([(None, 1), (2, 2)], "k int, a int")
    right = spark.createDataFrame([(None, 10), (2, 20)], "k int, b int")
    rows = join_unique(left, right, ["k"], "left").collect()
    assert {(r.a, r.b) for r in rows} == {(1, None), (2, 20)}
