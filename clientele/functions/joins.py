"""Joining a large fact table to a dimension when a few keys hold very many rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_KEYS = 1_000
TRACKED = 20_000


def estimated_bytes(df: DataFrame) -> int:
    """The planner's size estimate of a table, from file sizes; no job runs."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_limit(df: DataFrame) -> int:
    """The session's limit for broadcasting a join side, in bytes; -1 for never."""
    text = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")
    digits = text.lower().rstrip("b")
    units = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}
    if digits[-1:] in units:
        return int(float(digits[:-1]) * units[digits[-1]])
    return int(digits)


def lookup_join(fact: DataFrame, dimension: DataFrame, key: str, spread: str) -> DataFrame:
    """Inner join to a dimension that holds each key once.

    A dimension within the broadcast limit is left to the planner, which
    broadcasts it. A larger one is shuffled, and then a hot key would send its
    rows to one task. So the most frequent keys, at most ``HOT_KEYS`` of them by
    a frequency sketch, are looked up in a broadcast of just their rows. Their
    fact rows take part in the shuffled join under keys that match nothing,
    spread by the hash of the column ``spread``. Which keys the sketch names
    has no influence on the result.
    """
    if estimated_bytes(dimension) <= broadcast_limit(dimension):
        return fact.join(dimension, key)
    payload = [c for c in dimension.columns if c != key]
    frequent = fact.agg(
        F.expr(f"approx_top_k({key}, {HOT_KEYS}, {TRACKED})").alias("top")
    ).select(F.inline("top"))
    hot = (
        frequent.select(F.col("item").alias(key))
        .join(dimension, key)
        .select(key, F.struct(*payload).alias("_hot"))
    )
    marked = fact.where(F.col(key).isNotNull()).join(F.broadcast(hot), key, "left")
    cold_key = F.when(F.col("_hot").isNull(), F.struct(F.col(key), F.lit(0).alias("salt")))
    spread_key = F.struct(
        F.lit(None).cast(dimension.schema[key].dataType).alias(key),
        (F.pmod(F.xxhash64(spread, key), F.lit(1_000_000)) + 1).cast("int").alias("salt"),
    )
    keyed = marked.withColumn("_key", F.coalesce(cold_key, spread_key))
    cold = dimension.select(
        F.struct(F.col(key), F.lit(0).alias("salt")).alias("_key"),
        F.struct(*payload).alias("_cold"),
    )
    found = F.coalesce("_hot", "_cold")
    return (
        keyed.join(cold, "_key", "left")
        .withColumn("_found", found)
        .where(F.col("_found").isNotNull())
        .select(*fact.columns, *[F.col("_found")[c].alias(c) for c in payload])
    )
