"""Connected components by alternating large and small stars.

A large star hangs every larger neighbour of a node on the node's smallest
neighbour, a small star does so with the smaller ones. Each is one grouped
minimum and one join, and they end in one star per component, its smallest node
in the centre. Every round is checkpointed; only a count and a check sum come to
the driver. A node with a third of all edges is a skewed join, which the
adaptive planner splits.

Before every round a task joins up what it has: a batch of edges becomes stars
of its own, so that a long chain takes few rounds. Every task of a shuffle
leaves files of its own, and edges are two numbers each: a round has as many
tasks as there are edges for, however many partitions the session gives a
shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.llm.common import giving_back
from clientele.llm.groups import local_roots
from clientele.sources.scratch import materialise

#: Edges of a task.
PARTITION = 8_192


def connected_components(edges: DataFrame) -> DataFrame:
    """``node``, ``component`` (its smallest node) for all nodes of ``edges`` (two columns of longs)."""
    a, b = edges.columns
    stars = materialise(
        _joined_up(
            edges.where(F.col(a) != F.col(b))
            .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
            .distinct()
        )
    )
    seen = _state(stars)
    while True:
        # no round has more edges than the one before
        tasks = max(1, -(-seen[0] // PARTITION))
        large = _large_star(stars.coalesce(tasks)).coalesce(tasks)
        stars = materialise(_joined_up(_small_star(large).coalesce(tasks)))
        now = _state(stars)
        if now == seen:
            break
        seen = now
    leaves = stars.select(F.col("u").alias("node"), F.col("v").alias("component"))
    centres = stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return leaves.unionByName(centres)


def _state(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))"), F.expr("bit_xor(xxhash64(v, u, 1))")).first()
    )


def _joined_up(edges: DataFrame) -> DataFrame:
    """Stars that connect what each batch of ``edges`` connects; stars stay as they are."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            u, v = batch["u"].to_numpy(np.int64), batch["v"].to_numpy(np.int64)
            nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
            root = local_roots(len(nodes), at[: len(u)], at[len(u) :])
            hung = np.flatnonzero(root != np.arange(len(nodes)))
            yield pd.DataFrame({"u": nodes[hung], "v": nodes[root[hung]]})

    return edges.mapInPandas(giving_back(run), "u long, v long")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return (
        both.join(least, "u")
        .where(F.col("v") > F.col("u"))
        .select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    hung = edges.join(least, "u").where(F.col("v") != F.col("m"))
    return (
        hung.select(F.col("v").alias("u"), F.col("m").alias("v"))
        .unionByName(least.select("u", F.col("m").alias("v")))
        .distinct()
    )
