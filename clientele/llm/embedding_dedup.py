"""Embedding near-duplicates by randomised-rotation binary codes.

Vectors are turned by random rotations and kept as the signs of the turned
coordinates. With the stored correction factor, the inner product of a code
with its own vector, the code gives an unbiased estimate of any inner product
and a confidence bound. Where the bound leaves the threshold in reach the
cosine is computed exactly in double precision; only that links a pair.

Pairs are looked up by the codes, too: several tables each take a stretch of
code bits as bucket number, as many tables as find a pair at the threshold with
probability ``recall``. Equal vectors are one node, large buckets are cut into
pairs of blocks, and a link is counted in the first table that shows it, so
tasks give counts and spanning stars, never the pairs of a group.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.llm.common import finite_vector
from clientele.llm.components import connected_components
from clientele.llm.groups import BLOCKS, blocked, group_starts, local_roots, whole_groups
from clientele.sources.scratch import materialise

THRESHOLD = 0.9
RECALL = 0.998
#: Vectors that a bucket should have.
BUCKET = 256
BLOCK = 1024
#: Rotations at least, and standard deviations of the estimate that a bound spans.
ROTATIONS = 4
DEVIATIONS = 4.0
SEED = 20


@dataclass(frozen=True)
class Coding:
    """How many bits number a bucket, how many tables there are, how many rotations code a vector."""

    bits: int
    tables: int
    threshold: float = THRESHOLD

    @staticmethod
    def of(vectors: int, threshold: float = THRESHOLD, recall: float = RECALL) -> Coding:
        """For so many vectors: a pair at the threshold agrees on a bit with probability ``1 - angle / pi``."""
        bits = max(2, round(math.log2(max(1, vectors / BUCKET))) if vectors else 2)
        agree = (1 - math.acos(threshold) / math.pi) ** bits
        return Coding(bits, math.ceil(math.log(1 - recall) / math.log(1 - agree)), threshold)

    def rotations(self, dimension: int) -> int:
        return max(ROTATIONS, -(-self.bits * self.tables // dimension))

    def turns(self, dimension: int) -> np.ndarray:
        """The rotations side by side, the same in every run."""
        rng = np.random.default_rng([SEED, dimension])
        made = []
        for _ in range(self.rotations(dimension)):
            q, r = np.linalg.qr(rng.normal(size=(dimension, dimension)))
            made.append(q * np.sign(np.diag(r)))
        return np.concatenate(made, axis=1)


def unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length 1; powers of two taken out first keep squares in range."""
    _, exponent = np.frexp(np.abs(vectors).max(axis=1, keepdims=True))
    scaled = np.ldexp(vectors, -exponent)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def encode(vectors: np.ndarray, coding: Coding) -> tuple[np.ndarray, np.ndarray]:
    """Packed signs, and a correction factor per rotation."""
    d = vectors.shape[1]
    turned = unit(vectors) @ coding.turns(d)
    factors = np.abs(turned).reshape(len(vectors), -1, d).sum(axis=2) / math.sqrt(d)
    return np.packbits(turned >= 0, axis=1), factors


def signs(codes: np.ndarray, count: int) -> np.ndarray:
    return np.unpackbits(codes, axis=1, count=count).astype(np.float32) * 2 - 1


def bucket_numbers(codes: np.ndarray, coding: Coding) -> np.ndarray:
    """The bucket of each code in each table."""
    bits = np.unpackbits(codes, axis=1)[:, : coding.bits * coding.tables].astype(np.int64)
    weights = 1 << np.arange(coding.bits, dtype=np.int64)
    return bits.reshape(len(codes), coding.tables, coding.bits) @ weights


def estimates(
    codes: np.ndarray, factors: np.ndarray, vectors: np.ndarray, coding: Coding
) -> tuple[np.ndarray, np.ndarray]:
    """Unbiased cosines of each code (rows) with each vector (columns), and each row's bound."""
    d = vectors.shape[1]
    turned = (unit(vectors) @ coding.turns(d)).astype(np.float32)
    rotations = factors.shape[1]
    scale = np.repeat(1 / (factors * math.sqrt(d) * rotations), d, axis=1).astype(np.float32)
    spread = np.sqrt(((1 - factors**2).clip(0) / factors**2).sum(axis=1)) / rotations
    return (signs(codes, rotations * d) * scale) @ turned.T, DEVIATIONS * spread / math.sqrt(max(d - 1, 1))


def cosines(vectors: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact cosines of pairs, in double precision."""
    _, exponent = np.frexp(np.abs(vectors).max(axis=1, keepdims=True))
    scaled = np.ldexp(vectors, -exponent)
    length = np.sqrt(np.einsum("ij,ij->i", scaled, scaled))
    out = np.empty(len(left))
    for at in range(0, len(left), 1 << 16):
        i, j = left[at : at + (1 << 16)], right[at : at + (1 << 16)]
        out[at : at + len(i)] = np.einsum("ij,ij->i", scaled[i], scaled[j]) / (length[i] * length[j])
    return out


def linked_vectors(nodes: DataFrame, coding: Coding, block: int = BLOCK) -> DataFrame:
    """``node``, ``links`` (weighted by copies) and ``root``, by table and bucket, for nodes with links.

    ``nodes`` has ``node``, ``copies`` and ``embedding``, all vectors different and finite.
    """
    keys = ["dimension", "table", "bucket", *BLOCKS]
    kind = nodes.schema["embedding"].dataType.simpleString()

    def coded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for d, frame in batch.groupby(batch["embedding"].map(len)):
                vectors = np.stack(frame["embedding"].to_numpy()).astype(np.float64)
                codes, factors = encode(vectors, coding)
                yield frame.assign(
                    dimension=d,
                    code=[c.tobytes() for c in codes],
                    factors=list(factors),
                    buckets=list(bucket_numbers(codes, coding)),
                )

    rows = nodes.mapInPandas(
        coded,
        f"node long, copies long, embedding {kind}, dimension int, code binary, factors array<double>, buckets array<long>",
    ).select("*", F.posexplode("buckets").alias("table", "bucket")).drop("buckets")
    dealt = (
        blocked(rows, ["dimension", "table", "bucket"], "node", block)
        .repartition(*keys)
        .sortWithinPartitions(*keys)
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_groups(batches, keys):
            starts = group_starts(frame, keys)
            for a, b in zip(starts, [*starts[1:], len(frame)]):
                if b - a > 1 and (found := _links(frame.iloc[a:b], coding)) is not None:
                    yield found

    return dealt.mapInPandas(run, "node long, links long, root long")


def _links(group: pd.DataFrame, coding: Coding) -> pd.DataFrame | None:
    vectors = np.stack(group["embedding"].to_numpy()).astype(np.float64)
    codes = np.frombuffer(b"".join(group["code"]), np.uint8).reshape(len(group), -1)
    factors = np.stack(group["factors"].to_numpy())
    block, table = group["block"].to_numpy(), int(group["table"].iloc[0])
    estimate, bound = estimates(codes, factors, vectors, coding)
    near = np.triu(estimate + bound[:, None] >= coding.threshold, 1)
    if group["low"].iloc[0] != group["high"].iloc[0]:
        near &= block[:, None] != block[None]
    left, right = np.nonzero(near)
    if not len(left):
        return None
    buckets = bucket_numbers(codes, coding)[:, :table]
    links = np.zeros(len(group), np.int64)
    copies = group["copies"].to_numpy(np.int64)
    exact = cosines(vectors, left, right) >= coding.threshold
    left, right = left[exact], right[exact]
    for at in range(0, len(left), 1 << 16):  # links that an earlier table has shown go
        part = slice(at, at + (1 << 16))
        again = (buckets[left[part]] == buckets[right[part]]).any(axis=1)
        left[part], right[part] = np.where(again, -1, left[part]), np.where(again, -1, right[part])
    left, right = left[left >= 0], right[right >= 0]
    if not len(left):
        return None
    np.add.at(links, left, copies[right])
    np.add.at(links, right, copies[left])
    root = local_roots(len(group), left, right)
    at = np.flatnonzero(links)
    node = group["node"].to_numpy(np.int64)
    return pd.DataFrame({"node": node[at], "links": links[at], "root": node[root[at]]})


def embedding_duplicates(
    vectors: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, block: int = BLOCK
) -> DataFrame:
    """One row per row of ``vectors``: ``vec_id``, ``n_links``, ``component_id``, ``kept``.

    Only ``vec_id`` and ``embedding`` are read. Vectors that are null, empty,
    zero or have a null or non-finite component link with nothing, vectors of
    different length do not link. Equal vectors are linked copies, and so are
    repeated rows. ``component_id`` is the smallest id reachable; null ids count
    as the last. An empty table gives no rows.
    """
    base = vectors.select("vec_id", "embedding")
    nodes = materialise(
        base.where(finite_vector(F.col("embedding")))
        .groupBy("embedding")
        .agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    coding = Coding.of(nodes.count(), threshold, recall)
    found = materialise(linked_vectors(nodes.select("node", "copies", "embedding"), coding, block))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    parts = connected_components(found.select("node", "root")).withColumnRenamed("node", "_node")
    named = materialise(
        nodes.join(links, "node", "left")
        .join(parts, F.col("node") == F.col("_node"), "left")
        .select(
            "embedding",
            "least",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "node").alias("component"),
        )
    )
    ids = named.groupBy("component").agg(F.min("least").alias("component_id"))
    classes = named.join(ids, "component").select("embedding", "n_links", "component_id")
    component = F.coalesce("component_id", "vec_id")
    return base.join(classes, "embedding", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
