"""Approximate nearest neighbours on shifted space-filling curves.

Each curve projects the vectors onto a few random directions, shifts them and
orders them by Hilbert index. Spark range-partitions every ordering; a query is
compared with the window of partitions around its own place on every curve, the
windows' finds are merged and reranked by the exact inner product.

Inner products become distances by one more coordinate: a vector over the
largest length gets the root of what its square misses to 1, a query gets 0.
Lengths are cut into bands of powers of two with curves and a largest length of
their own, so that a few long vectors do not push the others together; a query
is compared with its windows in every band. A band that its window holds whole
is laid out once.

A window is a share of all rows, the same at every size, because that is what
recall costs where vectors have no structure: neighbours at a cosine of 0.35
share a curve's tenth hardly more often than chance. On such vectors the windows
of all curves together hold more rows than an exact search compares, and the
README says what they find.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clientele.llm.common import finite_vector
from clientele.sources.scratch import materialise

K = 20
CURVES = 8
#: Share of a curve that a query's window has besides the query's own part.
WINDOW = 0.2
#: Rows of a partition of one curve, and partitions of one curve at least.
ROWS = 20_000
PARTS = 64
#: Queries of a part that are compared in one group.
BLOCK = 2_048
DIMENSIONS = 6
#: Bands of length are powers of two up to this exponent.
EXPONENT = 2000
BITS = 10
SEED = 9


@lru_cache(maxsize=64)
def curve(number: int, dimension: int) -> tuple[np.ndarray, np.ndarray]:
    """The directions and the shift of a curve, the same in every run."""
    rng = np.random.default_rng([SEED, number, dimension])
    q, _ = np.linalg.qr(rng.normal(size=(dimension, min(DIMENSIONS, dimension))))
    return q, rng.uniform(0, 1, q.shape[1])


def hilbert(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Hilbert index of rows of grid cells, by the published transposition algorithm."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    for level in range(bits - 1, 0, -1):  # undo the rotations, from the top
        bit, lower = 1 << level, (1 << level) - 1
        for i in range(n):
            set_ = (x[i] & bit) != 0
            swap = np.where(set_, 0, (x[0] ^ x[i]) & lower)
            x[0] ^= np.where(set_, lower, swap)
            x[i] ^= swap
    for i in range(1, n):  # Gray code
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flip ^= np.where((x[n - 1] >> level) & 1, (1 << level) - 1, 0)
    x ^= flip
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> level) & 1)
    return key


def keys(points: np.ndarray, number: int) -> np.ndarray:
    """Place of unit vectors on a curve. Coordinates run from -4 to 4 deviations, shifted by up to one."""
    directions, shift = curve(number, points.shape[1])
    at = (points @ directions * math.sqrt(points.shape[1]) + 4 + shift) / 9
    return hilbert((at * (1 << BITS)).clip(0, (1 << BITS) - 1))


def lifted(vectors: np.ndarray, longest: float, query: bool) -> np.ndarray:
    """Unit vectors with one more coordinate, whose distances order like inner products."""
    _, exponent = np.frexp(longest)
    scaled, most = np.ldexp(vectors, -exponent), math.ldexp(longest, -int(exponent))
    square = np.einsum("ij,ij->i", scaled, scaled)
    if query:
        return np.column_stack([scaled / np.sqrt(square)[:, None].clip(1e-300), np.zeros(len(scaled))])
    return np.column_stack([scaled / most, np.sqrt((1 - square / most**2).clip(0))])


def best(
    queries: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int
) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For each query the places and inner products of its ``k`` nearest, ties to smaller ids."""
    found, scores = [], []
    for at in range(0, len(queries), 256):
        products = queries[at : at + 256] @ vectors.T
        k_here = min(k, len(ids))
        least = -np.partition(-products, k_here - 1, axis=1)[:, k_here - 1]
        slack = 1e-12 * (1 + np.abs(least))  # the rerank may order rounding otherwise
        for q, row, low in zip(queries[at : at + 256], products, least - slack):
            near = np.flatnonzero(row >= low)
            exact = np.einsum("ij,j->i", vectors[near], q)
            order = np.lexsort((ids[near], -exact))[:k]
            found.append(near[order])
            scores.append(exact[order])
    return found, scores


def windows(counts: list[int], need: float) -> tuple[np.ndarray, np.ndarray]:
    """First and last part of the window around every part, of ``need`` rows besides its own part at least.

    Half of them lie to either side; what one side lacks the other has.
    """
    upto = np.append(0, np.cumsum(counts))
    before, after = upto[:-1], upto[-1] - upto[1:]
    left = np.minimum(before, np.maximum(need / 2, need - after))
    right = np.minimum(after, np.maximum(need / 2, need - before))
    first = np.searchsorted(upto, before - left, "right") - 1
    last = np.searchsorted(upto, upto[1:] + right, "left") - 1
    return first, last


def nearest(
    vectors: DataFrame,
    asks: Column,
    k: int = K,
    curves: int = CURVES,
    window: float = WINDOW,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the nearest found for rows where ``asks`` holds.

    Only ``vec_id`` and ``embedding`` are read. Vectors that are null, empty,
    zero or have a null or non-finite component, and rows without an id, take
    no part. Rows equal in id and vector are one row; rows of one id with
    different vectors are rows of their own, and each asks where ``asks`` holds.
    Vectors of different length are not compared. Of equal vectors the ``k + 1``
    smallest ids are searched, as no result can need more. Ties go to the
    smaller id. A window holds ``k + 1`` rows at least, so that where there are
    fewer than ``k`` others, all are returned. ``asks`` is an expression over
    ``vec_id``.
    """
    base = materialise(
        vectors.where(finite_vector(F.col("embedding")) & F.col("vec_id").isNotNull())
        .select("vec_id", "embedding")
        .distinct()
        .withColumn("row", F.monotonically_increasing_id())
    )
    square = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    power = F.coalesce(F.floor(F.log2("length")), F.lit(-EXPONENT))
    base = base.withColumns({"dimension": F.size("embedding"), "length": F.sqrt(square)}).withColumn(
        "band", F.least(F.greatest(power, F.lit(-EXPONENT)), F.lit(EXPONENT)).cast("int")
    )
    copy = F.row_number().over(W.partitionBy("embedding").orderBy("vec_id"))
    pool = base.withColumn("copy", copy).where(F.col("copy") <= k + 1).drop("copy")
    asked = base.where(asks).select("vec_id", "row", "embedding")
    # equal queries are asked once
    unlike = base.where(asks).groupBy("dimension", "band", "embedding").agg(F.min("row").alias("row"))
    kind = base.schema["embedding"].dataType.simpleString()
    # one row per dimension and band
    sizes = pool.groupBy("dimension", "band").agg(F.count(F.lit(1)), F.max("length")).collect()
    longest = {(d, band): top or 1.0 for d, band, _, top in sizes}
    need = {(d, band): max(window * n, min(k + 1, n)) for d, band, n, _ in sizes}
    curves_of = {(d, band): curves if need[d, band] < n else 1 for d, band, n, _ in sizes}
    size = sum(n for _, _, n, _ in sizes)
    # about this share of all queries has a given part in its window
    blocks = max(1, math.ceil(unlike.count() * (window + 2 / PARTS) / BLOCK))

    def lengthened(frame: pd.DataFrame, of: tuple[int, int], ask: bool) -> np.ndarray:
        return lifted(np.stack(frame["embedding"].to_numpy()).astype(np.float64), longest.get(of, 1.0), ask)

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for of, frame in batch.groupby(["dimension", "band"]):
                points = lengthened(frame, of, False)
                for number in range(curves_of[of]):
                    yield frame.assign(curve=number, key=keys(points, number))

    place = ["dimension", "band", "curve", "part"]
    there = materialise(
        pool.select("vec_id", "row", "embedding", "dimension", "band")
        .mapInPandas(placed, f"vec_id long, row long, embedding {kind}, dimension int, band int, curve int, key long")
        .repartitionByRange(curves * max(PARTS, math.ceil(size / ROWS)), "dimension", "band", "curve", "key", "row")
        .withColumn("part", F.spark_partition_id())
    )
    # one row per part of a curve
    laid = there.groupBy(*place).agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("low")).orderBy(*place).collect()
    lines: dict[tuple[int, int], dict[tuple[int, int], list[tuple[int, int, int]]]] = {}
    for d, band, number, part, n, low in laid:
        lines.setdefault((d, number), {}).setdefault((d, band), []).append((part, n, low))
    ranges = {
        at: [
            (of, np.array([low for _, _, low in parts]), windows([n for _, n, _ in parts], need[of]), np.array([p for p, _, _ in parts]))
            for of, parts in bands.items()
        ]
        for at, bands in lines.items()
    }

    def asking(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for of, frame in batch.groupby(["dimension", "band"]):
                points = lengthened(frame, of, True)
                for number in range(curves):
                    own = keys(points, number)
                    for (_, band), lows, (first, last), parts in ranges.get((of[0], number), []):
                        at = (np.searchsorted(lows, own, "right") - 1).clip(0)
                        yield frame.assign(band=band, curve=number, start=parts[first[at]], stop=parts[last[at]])

    sought = (
        unlike.mapInPandas(
            asking, f"dimension int, band int, curve int, start int, stop int, row long, embedding {kind}"
        )
        .withColumn("part", F.explode(F.sequence("start", "stop")))
        .select(*place, F.col("row").alias("query"), "embedding")
        .withColumn("block", F.pmod(F.xxhash64("query"), F.lit(blocks)).cast("int"))
    )
    there = (
        there.select(*place, "vec_id", "row", "embedding")
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    )

    def compare(pool: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if pool.empty or asked.empty:
            nothing = pd.DataFrame({"query": [], "rows": [], "ids": [], "scores": []}, dtype=object)
            return nothing.astype({"query": "int64"})
        matrix = lambda f: np.stack(f["embedding"].to_numpy()).astype(np.float64)
        ids, rows = pool["vec_id"].to_numpy(), pool["row"].to_numpy()
        found, scores = best(matrix(asked), matrix(pool), ids, k + 1)
        return pd.DataFrame(
            {"query": asked["query"], "rows": [rows[f] for f in found], "ids": [ids[f] for f in found], "scores": scores}
        )

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out: dict[str, list] = {"rows": [], "ids": [], "scores": []}
            for lists_of in zip(*[batch[c] for c in out]):
                row, one, value = (np.concatenate(list(many)) for many in lists_of)
                _, first = np.unique(row, return_index=True)
                ranked = first[np.lexsort((one[first], -value[first]))[: k + 1]]
                for name, values in zip(out, (row, one, value)):
                    out[name].append(values[ranked])
            yield pd.DataFrame({"query": batch["query"], **out})

    lists = "query long, rows array<long>, ids array<long>, scores array<double>"
    merged = (
        there.groupBy(*place, "block")
        .cogroup(sought.groupBy(*place, "block"))
        .applyInPandas(compare, lists)
        .groupBy("query")
        .agg(*[F.collect_list(c).alias(c) for c in ("rows", "ids", "scores")])
        .mapInPandas(merge, lists)
        .select("query", F.arrays_zip("rows", "ids", "scores").alias("near"))
    )
    others = F.filter("near", lambda x: x["rows"] != F.col("own"))
    return (
        asked.withColumnRenamed("vec_id", "query_id").withColumnRenamed("row", "own")
        .join(unlike.select("embedding", F.col("row").alias("query")), "embedding")
        .join(merged, "query")
        .select("query_id", F.posexplode(F.slice(others, 1, k)).alias("at", "near"))
        .select(
            "query_id",
            (F.col("at") + 1).cast("int").alias("rank"),
            F.col("near.ids").alias("vec_id"),
            F.col("near.scores").alias("score"),
        )
    )
