"""Near-duplicates by resemblance, on top of the SimHash operator.

Two documents link if their sets of word shingles have a Jaccard similarity of
at least ``SIMILARITY``. At that threshold 64-bit fingerprints lie about ten
bits apart, too far to be looked up by bands of bits, so pairs are formed among
documents that share an anchor (a hash of several minima of the shingle hashes).
Fingerprints and their pivot tables then discard, as in ``simhash``, and every
link left is checked exactly on whole shingle sets.

Documents of equal shingle sets are one node. A group leaves its task as a
spanning forest of real pairs, nearest fingerprints first, so a group of many
copies costs its size in rows. The forest's links are checked in two rounds: the
nearest of every node first, then those between what is still apart. A forest
that left pairs out spans a family with others like it; families that are still
in several parts have all their pairs checked, each where its two sets are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.llm.common import giving_back, packed, unpacked
from clientele.llm.components import connected_components
from clientele.llm.groups import BLOCKS, blocked, group_starts, local_roots, whole_groups
from clientele.llm.simhash import BLOCK, SEED, links_within, pivot_table, shingle_hashes
from clientele.sources.scratch import materialise

WIDTH = 5
SIMILARITY = 0.8
#: A pair of similarity 0.8 shares one of 24 anchors of 6 minima with probability 0.9993.
ANCHORS = 24
MINIMA = 6
#: Bits that fingerprints of an anchor may differ in: four standard deviations above the mean at 0.8.
REACH = 22
#: Shingles that are multiplied out at a time.
STEP = 4096
#: Pairs that are compared at a time.
PAIRS = 1 << 17
#: Nodes of a block of a family, and shingles that are counted at a time there.
FAMILY = 250
COLUMNS = 4096
#: Documents that are sketched at a time.
ROWS = 256


def _factors() -> np.ndarray:
    rng = np.random.default_rng(SEED)
    return rng.integers(0, 1 << 63, ANCHORS * MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


FACTORS = _factors()


def shingle_set(text: bytes | None, width: int = WIDTH) -> np.ndarray:
    """The distinct shingle hashes of a whole text in ascending order; none without words."""
    parts = [np.unique(h) for h in shingle_hashes(text or b"", width)]
    return np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)


def set_fingerprint(hashes: np.ndarray) -> int:
    """The majority of each bit over the distinct shingles, as a signed number."""
    ones = np.zeros(64, np.int64)
    for part in np.array_split(hashes.astype("<u8"), len(hashes) // 8192 + 1):
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def anchors(hashes: np.ndarray) -> list[int]:
    """``ANCHORS`` signed numbers; none for an empty set."""
    if not len(hashes):
        return []
    least = np.full(len(FACTORS), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), STEP):
        np.minimum(least, (hashes[at : at + STEP, None] * FACTORS).min(axis=0), out=least)
    digest = xxhash.xxh64_intdigest
    rows = least.astype("<u8").reshape(ANCHORS, MINIMA)
    return np.array([digest(r.tobytes(), i) for i, r in enumerate(rows)], np.uint64).view(np.int64).tolist()


def identity(hashes: np.ndarray) -> int:
    """A signed number that names a shingle set; 0 for the empty one."""
    return int(np.uint64(xxhash.xxh64_intdigest(hashes.tobytes(), SEED) if len(hashes) else 0).view(np.int64))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def sketches(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """The columns of ``docs`` but ``text``, and ``node``, ``size``, ``fingerprint``, ``anchors``."""
    kept = [c for c in docs.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            nodes, sizes, prints, keys = [], [], [], []
            for text in batch.column("text"):
                hashes = shingle_set(text.as_py(), width)
                nodes.append(identity(hashes))
                sizes.append(len(hashes))
                prints.append(set_fingerprint(hashes))
                keys.append(anchors(hashes))
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in kept],
                    pa.array(nodes, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(prints, pa.int64()),
                    pa.array(keys, pa.list_(pa.int64())),
                ],
                names=[*kept, "node", "size", "fingerprint", "anchors"],
            )

    number = F.lit(0).cast("long")
    schema = docs.select(
        *kept,
        number.alias("node"),
        number.alias("size"),
        number.alias("fingerprint"),
        F.array(number).alias("anchors"),
    ).schema
    return docs.withColumn("text", F.col("text").cast("binary")).mapInArrow(giving_back(run), schema)


def forest(size: int, left: np.ndarray, right: np.ndarray, cost: np.ndarray) -> np.ndarray:
    """Positions of the pairs of a minimum spanning forest of ``size`` items."""
    order = np.argsort(cost, kind="stable")
    left, right = left[order], right[order]
    at, root, taken = np.arange(len(order)), np.arange(size), []
    while True:
        apart = root[left[at]] != root[right[at]]
        at = at[apart]
        if not len(at):
            break
        best = np.full(size, len(order))
        np.minimum.at(best, root[left[at]], at)
        np.minimum.at(best, root[right[at]], at)
        chosen = np.unique(best[best < len(order)])
        taken.append(chosen)
        held = np.flatnonzero(root != np.arange(size))
        root = local_roots(
            size,
            np.concatenate([left[chosen], held]),
            np.concatenate([right[chosen], root[held]]),
        )
    return order[np.concatenate(taken)] if taken else np.zeros(0, np.int64)


def candidate_links(nodes: DataFrame, similarity: float = SIMILARITY, block: int = BLOCK) -> DataFrame:
    """``a``, ``b``, ``bits``: forests of near pairs of every anchor of ``nodes``.

    ``cut`` tells whether a forest with the pair left other pairs out.
    """
    keys = ["anchor", *BLOCKS]
    rows = nodes.select("node", "size", "fingerprint", F.explode("anchors").alias("anchor"))
    dealt = (
        blocked(rows, ["anchor"], "node", block).repartition(*keys).sortWithinPartitions(*keys)
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_groups(batches, keys):
            starts = group_starts(frame, keys)
            for start, stop in zip(starts, np.append(starts[1:], len(frame))):
                if stop - start > 1:
                    links = _group_forest(frame.iloc[start:stop], similarity)
                    if len(links):
                        yield links

    found = dealt.mapInPandas(giving_back(run), "a long, b long, bits int, cut boolean")
    return found.groupBy("a", "b", "bits").agg(F.max("cut").alias("cut"))


def _group_forest(group: pd.DataFrame, similarity: float) -> pd.DataFrame:
    names = group["node"].to_numpy(np.int64)
    sizes = group["size"].to_numpy(np.int64)
    values = group["fingerprint"].to_numpy(np.int64).view(np.uint64)
    block = group["block"].to_numpy()
    across = group["low"].iloc[0] != group["high"].iloc[0]
    tables = pivot_table(values)
    n = len(group)
    step = max(1, PAIRS // n)
    kept, seen = np.zeros((0, 2), np.int64), 0
    for at in range(0, n, step):
        i, j = np.meshgrid(np.arange(at, min(at + step, n)), np.arange(n), indexing="ij")
        may = j > i
        if across:
            may &= block[i] != block[j]
        may &= np.minimum(sizes[i], sizes[j]) >= similarity * np.maximum(sizes[i], sizes[j])
        left, right = i[may], j[may]
        near = links_within(values, tables, left, right, REACH)
        seen += int(near.sum())
        pairs = np.concatenate([kept, np.stack([left[near], right[near]], axis=1)])
        bits = np.bitwise_count(values[pairs[:, 0]] ^ values[pairs[:, 1]])
        kept = pairs[forest(n, pairs[:, 0], pairs[:, 1], bits)]
    a, b = names[kept[:, 0]], names[kept[:, 1]]
    bits = np.bitwise_count(values[kept[:, 0]] ^ values[kept[:, 1]]).astype(np.int32)
    cut = seen > len(kept)
    return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b), "bits": bits, "cut": cut})


def family_links(members: DataFrame, similarity: float = SIMILARITY, block: int = FAMILY) -> DataFrame:
    """``a``, ``b``: stars of what links of all pairs join in each ``family`` of ``members``.

    ``members`` has ``family``, ``node`` and ``hashes``.
    """
    keys = ["family", *BLOCKS]
    dealt = blocked(members, ["family"], "node", block).repartition(*keys).sortWithinPartitions(*keys)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_groups(batches, keys):
            starts = group_starts(frame, keys)
            for start, stop in zip(starts, np.append(starts[1:], len(frame))):
                group = frame.iloc[start:stop]
                across = group["block"].to_numpy() if group["low"].iloc[0] != group["high"].iloc[0] else None
                names = group["node"].to_numpy(np.int64)
                left, right = similar_pairs(list(group["hashes"]), similarity, across)
                root = local_roots(len(names), left, right)
                hung = np.flatnonzero(root != np.arange(len(names)))
                if len(hung):
                    yield pd.DataFrame({"a": names[root[hung]], "b": names[hung]})

    return dealt.mapInPandas(giving_back(run), "a long, b long")


def similar_pairs(
    sets: list[np.ndarray], similarity: float, block: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all pairs of ``sets`` that are as similar as asked; of different blocks where given."""
    n, sizes = len(sets), np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(n), sizes)
    hashes = np.concatenate(sets) if n else np.zeros(0, np.int64)
    order = np.argsort(hashes, kind="stable")
    owner, hashes = owner[order], hashes[order]
    new = np.append(True, hashes[1:] != hashes[:-1])[: len(hashes)]
    count = np.diff(np.append(np.flatnonzero(new), len(hashes)))
    several = np.repeat(count > 1, count)  # a shingle of one set is in no intersection
    owner = owner[several]
    column = np.cumsum(new[several]) - 1
    both = np.zeros((n, n), np.float32)
    width = int(column[-1]) + 1 if len(column) else 0
    for at in range(0, width, COLUMNS):
        a, b = np.searchsorted(column, [at, at + COLUMNS])
        has = np.zeros((n, COLUMNS), np.float32)
        has[owner[a:b], column[a:b] - at] = 1
        both += has @ has.T
    either = sizes[:, None] + sizes[None] - both.astype(np.float64)
    link = np.triu(both >= similarity * either, 1)
    if block is not None:
        link &= block[:, None] != block[None]
    return np.nonzero(link)


def exact_links(pairs: DataFrame, sets: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Those of ``pairs`` (``a``, ``b``) whose sets (``node``, ``hashes``) are as similar as asked."""

    first = sets.select(F.col("node").alias("a"), F.col("hashes").alias("one"))
    second = sets.select(F.col("node").alias("b"), F.col("hashes").alias("other"))
    both = F.size(F.array_intersect("one", "other"))
    either = F.size("one") + F.size("other") - both
    joined = pairs.select("a", "b").join(first, "a").join(second, "b")
    return joined.where(both >= similarity * either).select("a", "b")


def _mark() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("\0")))


def _sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """``node``, ``hashes`` of the documents named in ``wanted`` (``node``, ``best``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            hashes = [shingle_set(t.as_py(), width).view(np.int64) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array(hashes, pa.list_(pa.int64()))],
                names=["node", "hashes"],
            )

    named = wanted.select(
        "node", F.col("best.doc_id").alias("_id"), F.col("best.mark").alias("_of")
    )
    texts = docs.select("doc_id", "text", _mark().alias("mark")).join(
        named, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_of"))
    )
    made = texts.select("node", F.col("text").cast("binary").alias("text")).mapInArrow(
        giving_back(run), "node long, hashes array<long>"
    )
    return made.dropDuplicates(["node"])


def resembling(
    docs: DataFrame, width: int = WIDTH, similarity: float = SIMILARITY, block: int = BLOCK
) -> DataFrame:
    """``node``, ``best`` (its first document: ``last``, ``doc_id``, ``mark``), ``component``."""
    drawn = materialise(sketches(docs.select("doc_id", _mark().alias("mark"), "text"), width))
    entry = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "mark")
    nodes = materialise(
        drawn.groupBy("node").agg(
            F.min(entry).alias("best"),
            F.first("size").alias("size"),
            F.first("fingerprint").alias("fingerprint"),
            F.first("anchors").alias("anchors"),
        )
    )
    pairs = materialise(candidate_links(nodes, similarity, block))
    ends = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    sets = materialise(_sets(docs, nodes.join(ends, "node", "left_semi"), width))
    both = pairs.select("a", "b", "bits", F.col("a").alias("node")).union(
        pairs.select("a", "b", "bits", F.col("b"))
    )
    best = both.groupBy("node").agg(F.min(F.struct("bits", "a", "b")).alias("link"))
    first = materialise(exact_links(best.select("link.a", "link.b").distinct(), sets, similarity))
    parts = connected_components(first)
    of = lambda end: parts.select(F.col("node").alias(end), F.col("component").alias(f"of_{end}"))
    apart = (
        pairs.join(of("a"), "a", "left")
        .join(of("b"), "b", "left")
        .where(F.coalesce("of_a", "a") != F.coalesce("of_b", "b"))
        .select("a", "b")
    )
    links = materialise(first.union(exact_links(apart, sets, similarity)))
    parts = connected_components(links)
    members = _open_families(pairs, parts)
    more = materialise(family_links(members.join(sets, "node"), similarity, min(block, FAMILY)))
    if not more.isEmpty():
        parts = connected_components(links.union(more))
    return nodes.select("node", "best").join(parts, "node", "left").select(
        "node", "best", F.coalesce("component", "node").alias("component")
    )


def _open_families(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """``node``, ``family`` of families in several parts: nodes that forests with pairs left out connect."""
    families = connected_components(pairs.where("cut").select("a", "b")).withColumnRenamed("component", "family")
    placed = materialise(
        families.join(parts, "node", "left").select("node", "family", F.coalesce("component", "node").alias("part"))
    )
    several = placed.groupBy("family").agg(F.min("part").alias("low"), F.max("part").alias("high"))
    return placed.join(several.where("low != high").select("family"), "family", "left_semi").select("node", "family")


def one_of_each(
    docs: DataFrame, width: int = WIDTH, similarity: float = SIMILARITY, block: int = BLOCK
) -> DataFrame:
    """The rows of ``docs`` with one document of every component: the smallest id's, once.

    Texts without words (null, empty, white space) are one component; shorter
    texts than a shingle are their whole word sequence. Documents with a null id
    come last. Documents of one id with different texts are told apart by their
    texts. Repeated rows are kept once. An empty table gives no rows. Other
    columns are carried along.
    """
    kept = (
        resembling(docs, width, similarity, block)
        .groupBy("component")
        .agg(F.min("best").alias("best"))
        .select(F.col("best.doc_id").alias("kept_id"), F.col("best.mark").alias("kept_mark"))
        .distinct()
    )
    rows = docs.select(packed(docs).alias("row"), F.col("doc_id").alias("id"), _mark().alias("mark"))
    first = rows.join(
        kept,
        F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("mark") == F.col("kept_mark")),
        "left_semi",
    ).dropDuplicates(["id", "mark"])
    return unpacked(first, "row", docs.columns)
