import pytest
from pyspark.sql import functions as F

from clientele.functions import joins


@pytest.fixture
def tables(spark):
    """A third of the rows share one key; some keys have no partner; some are null."""
    fact = spark.range(9000).select(
        F.col("id").alias("row"),
        F.when(F.col("id") % 3 == 0, 5)
        .when(F.col("id") % 50 == 1, None)
        .otherwise(F.col("id") % 900)
        .cast("long")
        .alias("k"),
    )
    dimension = spark.range(800).select(
        F.col("id").alias("k"), F.concat(F.lit("n"), F.col("id")).alias("name"), (F.col("id") * 2).alias("x")
    )
    return fact, dimension


@pytest.mark.parametrize("hot_keys", [1, 3, 1000])
def test_hot_keys_do_not_change_the_result(spark, tables, monkeypatch, hot_keys):
    fact, dimension = tables
    expected = sorted(map(tuple, fact.join(dimension, "k").select("row", "k", "name", "x").collect()))
    monkeypatch.setattr(joins, "broadcast_limit", lambda df: -1)
    monkeypatch.setattr(joins, "HOT_KEYS", hot_keys)
    split = joins.lookup_join(fact, dimension, "k", "row").select("row", "k", "name", "x")
    assert sorted(map(tuple, split.collect())) == expected


def test_small_dimension_is_left_to_the_planner(spark, tables):
    fact, dimension = tables
    text = joins.lookup_join(fact, dimension, "k", "row")._jdf.queryExecution().toString()
    assert "approx_top_k" not in text and "BroadcastHashJoin" in text


@pytest.mark.parametrize(
    "text,limit", [("-1", -1), ("10485760", 10485760), ("10MB", 10 << 20), ("2g", 2 << 30), ("64k", 64 << 10), ("77b", 77)]
)
def test_limit_units(spark, text, limit):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", text)
        assert joins.broadcast_limit(spark.range(1)) == limit
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
