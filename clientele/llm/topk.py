"""Exact top-k inner products by the three-phase uniform threshold algorithm.

The components of all vectors are cut into a few slices. Within a slice the
vectors have, for each query, a list of partial scores; a score is the sum of
its partial scores. No task sees more than one list until the last phase.

1. Each list hands out its best entries, whose scores are computed. The k-th
   best of them is a score that the k-th best of all cannot fall below.
2. A vector that reaches it has a partial score of at least that score divided
   by the number of lists in one list or another. This cutoff goes out with the
   queries, and each list hands out every entry that reaches it.
3. What a vector can score at most follows from the entries that came in, and
   from the cutoff where one did not. Vectors that cannot reach the k-th best
   of the sums known whole are dropped; the scores of the others are computed.

Components are whole numbers, so scores are exact. Partial scores are doubles;
where they may be rounded, cutoffs and bounds give way by more than the rounding
can come to.

Lists are worked through in groups of a block of queries and a chunk of rows:
queries come first and are held, rows pass by in batches. Queries (a share of
the rows) are shuffled once per chunk and rows once per block of queries.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clientele.sources.scratch import materialise

K = 5
LISTS = 2
SCALE = 256
#: Rows of a chunk and queries of a block.
CHUNK = 32_768
BLOCK = 2_048
#: Groups of a list at least, so that small tables are spread too.
CHUNKS = 12
#: Best entries of a list whose scores are computed for the cutoff, as a multiple of k + 1.
HEADS = 4
#: Queries that a product is computed for at a time.
SLICE = 128
#: A sum of squares below this keeps every score within a long.
LARGEST = float(1 << 62)

GROUP = ["dimension", "list", "chunk", "block"]


def whole_components(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))


def takes_part(vector: Column, scale: int = SCALE) -> Column:
    """Not null, all components there and finite, and scores that fit into a long."""
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    squares = F.aggregate(
        vector,
        F.lit(0.0),
        lambda s, x: s + F.pow(F.floor(x.cast("double") * F.lit(float(scale))).cast("double"), F.lit(2.0)),
    )
    usable = F.when(vector.isNull() | ~F.forall(vector, number), F.lit(False)).otherwise(squares < LARGEST)
    return F.coalesce(usable, F.lit(False))


def product(left: Column, right: Column) -> Column:
    """Inner product of two arrays of longs."""
    return F.aggregate(F.zip_with(left, right, lambda a, b: a * b), F.lit(0).cast("long"), lambda s, x: s + x)


def slices(vector: Column, lists: int) -> Column:
    """The components in ``lists`` slices of the same length, as doubles; the last may be shorter or empty."""
    width = F.ceil(F.size(vector) / F.lit(lists)).cast("int")
    return F.transform(
        F.sequence(F.lit(0), F.lit(lists - 1)),
        lambda j: F.slice(vector, j * width + 1, width).cast("array<double>"),
    )


def matrix(frame: pd.DataFrame) -> np.ndarray:
    return np.stack(frame["part"].to_numpy())


def rounding(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """What a partial score of each query may be off by; 0 where it is exact."""
    most = np.linalg.norm(queries, axis=1) * np.linalg.norm(rows, axis=1).max(initial=0)
    return np.where(most < 2.0**52, 0.0, most * (rows.shape[1] + 2) * 2.0**-51)


class Best:
    """The best entries of every query of a group so far."""

    def __init__(self, size: int, keep: int):
        self.keep = keep
        self.scores = np.empty((size, 0))
        self.entries = np.empty((size, 0), np.int64)

    def add(self, at: slice, scores: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        scores = np.concatenate([self.scores[at], scores], axis=1)
        entries = np.concatenate([self.entries[at], np.broadcast_to(entries, (len(scores), len(entries)))], axis=1)
        if scores.shape[1] > self.keep:
            top = np.argpartition(-scores, self.keep - 1, axis=1)[:, : self.keep]
            scores, entries = np.take_along_axis(scores, top, 1), np.take_along_axis(entries, top, 1)
        return scores, entries

    def take(self, batch: list[tuple[np.ndarray, np.ndarray]]) -> None:
        self.scores = np.concatenate([s for s, _ in batch])
        self.entries = np.concatenate([e for _, e in batch])

    def frame(self, queries: np.ndarray, number: int) -> pd.DataFrame:
        width = self.scores.shape[1]
        return pd.DataFrame(
            {
                "query": np.repeat(queries, width),
                "entry": self.entries.ravel(),
                "list": number,
                "partial": self.scores.ravel(),
            }
        )


def _runs(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[tuple, bool, pd.DataFrame]]:
    """Stretches of one group and one kind (queries or rows) from sorted batches."""
    for batch in batches:
        if not batch.empty:
            yield from ((key[:-1], key[-1], part) for key, part in batch.groupby([*GROUP, "is_row"], sort=True))


def _held(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[tuple, pd.DataFrame, Iterator[pd.DataFrame]]]:
    """For every group its queries, whole, and its rows, batch by batch."""
    runs, ahead = _runs(batches), None

    def rows(of: tuple) -> Iterator[pd.DataFrame]:
        nonlocal ahead
        while ahead is not None and ahead[0] == of and ahead[1]:
            yield ahead[2]
            ahead = next(runs, None)

    ahead = next(runs, None)
    while ahead is not None:
        of, asked = ahead[0], []
        while ahead is not None and ahead[0] == of and not ahead[1]:
            asked.append(ahead[2])
            ahead = next(runs, None)
        passing = rows(of)
        if asked:
            yield of, pd.concat(asked, ignore_index=True), passing
        for _ in passing:
            pass


def top_k(vectors: DataFrame, asks: Column, k: int = K, lists: int = LISTS, scale: int = SCALE) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the ``k`` best of all other rows where ``asks`` holds.

    Only ``vec_id`` and ``embedding`` are read. A component x counts as
    floor(scale * x). Vectors that are null or have a null or non-finite
    component take no part, nor do those whose squares of whole components add
    up to 2^62 or more, as their scores need not fit into a long; rows without an
    id take no part either. Zero vectors and empty ones score 0. Vectors of
    different length are not compared. Rows equal in id and vector are one row;
    rows of one id with different vectors are rows of their own, and each asks
    where ``asks``, an expression over ``vec_id``, holds. Ties go to the smaller
    id. Where there are fewer than ``k`` others, all are returned. An empty table
    gives no rows.

    Equal vectors are one entry with their ``k + 1`` smallest ids, as no result
    can need more, and are asked once.
    """
    spark = vectors.sparkSession
    kept = materialise(
        vectors.where(takes_part(F.col("embedding"), scale) & F.col("vec_id").isNotNull())
        .select(F.col("vec_id").cast("long").alias("vec_id"), whole_components(F.col("embedding"), scale).alias("x"))
        .distinct()
    )
    copy = F.row_number().over(W.partitionBy("x").orderBy("vec_id"))
    entries = materialise(
        kept.withColumn("copy", copy)
        .where(F.col("copy") <= k + 1)
        .groupBy("x")
        .agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
        .withColumn("entry", F.monotonically_increasing_id())
    )
    # a query id per row of the table that asks, an entry once
    asked = materialise(
        kept.where(asks).withColumnRenamed("vec_id", "query_id").join(entries.select("x", "entry"), "x").drop("x")
    )
    unlike = entries.join(asked.select("entry").distinct(), "entry", "left_semi").select("entry", "x")
    n, m = entries.count(), unlike.count()
    if m == 0:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    chunks, blocks = max(CHUNKS, math.ceil(n / CHUNK)), math.ceil(m / BLOCK)
    place = lambda parts: F.pmod(F.xxhash64("entry"), F.lit(parts)).cast("int")
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    sliced = F.posexplode(slices(F.col("x"), lists)).alias("list", "part")
    rows = entries.select("entry", F.size("x").alias("dimension"), "x", place(chunks).alias("chunk")).select(
        "entry", "dimension", "chunk", sliced
    )
    rows = rows.select(
        *GROUP[:3], every(blocks).alias("block"), F.lit(True).alias("is_row"), "entry", "part",
        F.lit(None).cast("double").alias("cutoff"),
    )

    def met(cutoffs: DataFrame | None) -> DataFrame:
        """All groups, sorted so that a group's queries come before its rows."""
        ask = unlike.withColumn("cutoff", F.lit(None).cast("double")) if cutoffs is None else unlike.join(cutoffs, "entry")
        ask = ask.select(
            "entry", F.size("x").alias("dimension"), "cutoff", place(blocks).alias("block"), sliced
        ).select(
            "dimension", "list", every(chunks).alias("chunk"), "block", F.lit(False).alias("is_row"), "entry", "part", "cutoff"
        )
        parts = max(lists * chunks * blocks, spark.sparkContext.defaultParallelism)
        return ask.unionByName(rows).repartition(parts, *GROUP).sortWithinPartitions(*GROUP, "is_row")

    def heads(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for (_, number, _, _), asking, passing in _held(batches):
            q, best = matrix(asking), Best(len(asking), k + 1)
            for frame in passing:
                r, ids = matrix(frame), frame["entry"].to_numpy()
                best.take([best.add(slice(a, a + SLICE), q[a : a + SLICE] @ r.T, ids) for a in range(0, len(q), SLICE)])
            yield best.frame(asking["entry"].to_numpy(), number)

    def reaching(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for (_, number, _, _), asking, passing in _held(batches):
            q, ask, cutoff = matrix(asking), asking["entry"].to_numpy(), asking["cutoff"].to_numpy()
            cutoff = np.where(np.isnan(cutoff), -np.inf, cutoff)
            for frame in passing:
                r, ids = matrix(frame), frame["entry"].to_numpy()
                off = rounding(q, r)
                for a in range(0, len(q), SLICE):
                    partial = q[a : a + SLICE] @ r.T
                    at, found = np.nonzero(partial >= (cutoff - off)[a : a + SLICE, None])
                    value, slack = partial[at, found], off[a + at]
                    yield pd.DataFrame(
                        {"query": ask[a + at], "entry": ids[found], "most": value + slack, "least": value - slack}
                    )

    def scored(pairs: DataFrame) -> DataFrame:
        """Exact scores of pairs of ``query`` and ``entry``."""
        left = unlike.select(F.col("entry").alias("query"), F.col("x").alias("_left"))
        right = entries.select("entry", F.col("x").alias("_right"))
        return pairs.join(left, "query").join(right, "entry").select(
            "query", "entry", product(F.col("_left"), F.col("_right")).alias("score")
        )

    # 1: the best of every list, and a score that the k-th best reaches
    first = W.partitionBy("query", "list").orderBy(F.desc("partial"), "entry")
    found = (
        met(None)
        .mapInPandas(heads, "query long, entry long, list int, partial double")
        .withColumn("at", F.row_number().over(first))
        .where(F.col("at") <= HEADS * (k + 1))
        .select("query", "entry")
        .distinct()
    )
    reached = F.try_element_at(F.sort_array(F.collect_list("score"), asc=False), F.lit(k + 1))
    floors = materialise(scored(found).groupBy("query").agg(reached.alias("floor")))
    # a little less than the share of a list, so that rounding takes none out
    share = F.col("floor").cast("double") / lists
    cutoff = share - F.abs(share) * 2.0**-50

    # 2: every entry at or above the cutoff
    seen = materialise(
        met(floors.select(F.col("query").alias("entry"), cutoff.alias("cutoff")))
        .mapInPandas(reaching, "query long, entry long, most double, least double")
        .groupBy("query", "entry")
        .agg(F.count(F.lit(1)).cast("int").alias("lists"), F.sum("most").alias("most"), F.sum("least").alias("least"))
    )

    # 3: what may still be among the best, scored exactly
    whole = W.partitionBy("query").orderBy(F.desc("least"), "entry")
    sums = (
        seen.where(F.col("lists") == lists)
        .withColumn("at", F.row_number().over(whole))
        .where(F.col("at") <= k + 1)
        .groupBy("query")
        .agg(F.max(F.when(F.col("at") == k + 1, F.col("least"))).alias("known"))
    )
    missing = F.when(F.col("lists") == lists, F.lit(0.0)).otherwise((lists - F.col("lists")) * F.col("cutoff"))
    ceiling = F.col("most") + missing
    ceiling = ceiling + F.abs(ceiling) * 2.0**-50
    needed = F.greatest(F.col("floor").cast("double"), F.col("known"))
    needed = needed - F.abs(needed) * 2.0**-50
    left = (
        seen.join(floors.withColumn("cutoff", cutoff), "query")
        .join(sums, "query", "left")
        .where(F.col("floor").isNull() | (ceiling >= needed))
        .select("query", "entry")
    )
    order = W.partitionBy("query").orderBy(F.desc("score"), "vec_id", "entry")
    nearest = (
        scored(left)
        .join(entries.select("entry", F.explode("ids").alias("vec_id")), "entry")
        .withColumn("at", F.row_number().over(order))
        .where(F.col("at") <= k + 1)
    )
    own = W.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id", "entry")
    others = (F.col("vec_id") != F.col("query_id")) | (F.col("entry") != F.col("query"))
    return (
        asked.withColumnRenamed("entry", "query")
        .join(nearest, "query")
        .where(others)
        .withColumn("rank", F.row_number().over(own))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
