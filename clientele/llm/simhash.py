"""SimHash near-duplicates with pivot distance tables.

A fingerprint has the majority of each bit of its shingles' hashes. Every
distinct fingerprint stores its Hamming distances to many reference
fingerprints (pivots). By the triangle inequality two fingerprints that differ
in at most ``reach`` bits have distances to each pivot that differ by at most
``reach``: pairs whose tables differ by more in any coordinate are discarded,
the rest are verified bit by bit.

Pairs are looked up among fingerprints that agree on one of ``reach + 1`` bands
of bits, as any pair within reach must, so none is lost. Equal fingerprints are
one node; a band value that many share is cut into pairs of blocks; what leaves
a task is its links, or for large groups a spanning star of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.llm.components import connected_components
from clientele.llm.groups import BLOCKS, blocked, group_starts, local_roots, whole_groups
from clientele.sources.scratch import materialise

BITS = 64
WIDTH = 4
SEED = 42
REACH = 4
PIVOTS = 24
#: Words of a text that are held at a time.
CHUNK = 1 << 18
#: Rows of a block of a band value that many fingerprints share.
BLOCK = 2000
#: Groups of up to so many rows are compared by shifting, larger ones as matrices.
SMALL = 48


def shingle_hashes(text: bytes, width: int = WIDTH) -> Iterator[np.ndarray]:
    """The hashes of all shingles of a text, piece by piece; nothing for a text without words."""
    digest = xxhash.xxh64_intdigest
    rest, kept, whole = text.lower(), [], True
    while rest:
        words = rest.split(None, CHUNK)
        rest = words.pop() if len(words) > CHUNK else b""
        words = kept + words
        n = len(words) - width + 1
        if n > 0:
            joined = b" ".join(words)
            ends = list(accumulate(map(len, words), lambda a, b: a + b + 1))
            starts = [0, *(e + 1 for e in ends[: n - 1])]
            yield np.fromiter(
                (digest(joined[a:b], SEED) for a, b in zip(starts, ends[width - 1 :])), "<u8", n
            )
            whole = False
        kept = words[-(width - 1) :] if width > 1 else []
    if whole and kept:
        yield np.array([digest(b" ".join(kept), SEED)], "<u8")


def fingerprint(text: bytes | None, width: int = WIDTH) -> int:
    """The fingerprint as a signed 64-bit number; 0 for a text without words."""
    ones, total = np.zeros(BITS, np.int64), 0
    for hashes in shingle_hashes(text or b"", width):
        for part in np.array_split(hashes, len(hashes) // 8192 + 1):
            bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += bits.sum(axis=0, dtype=np.int64)
        total += len(hashes)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, text: str = "text", width: int = WIDTH) -> DataFrame:
    """The columns of ``docs`` but the text, and ``fingerprint`` (long)."""
    kept = [c for c in docs.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c) for c in kept]
            made = [fingerprint(t.as_py(), width) for t in batch.column(text)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(made, pa.int64())], names=[*kept, "fingerprint"]
            )

    source = docs.withColumn(text, F.col(text).cast("binary"))
    schema = docs.select(*kept, F.lit(0).cast("long").alias("fingerprint")).schema
    return source.mapInArrow(run, schema)


def pivots(count: int = PIVOTS) -> np.ndarray:
    """Reference fingerprints, the same in every run."""
    return np.random.default_rng(SEED).integers(0, 1 << 63, count, dtype=np.uint64) * np.uint64(2) + (
        np.arange(count, dtype=np.uint64) & np.uint64(1)
    )


def pivot_table(values: np.ndarray, count: int = PIVOTS) -> np.ndarray:
    """Hamming distances of each value to each pivot."""
    return np.bitwise_count(values.astype(np.uint64)[:, None] ^ pivots(count)[None]).astype(np.int8)


def links_within(
    values: np.ndarray, tables: np.ndarray, left: np.ndarray, right: np.ndarray, reach: int
) -> np.ndarray:
    """Which of the given pairs link: the pivots discard, the bits decide."""
    may = np.abs(tables[left] - tables[right]).max(axis=1) <= reach
    at = np.flatnonzero(may)
    near = np.bitwise_count(values[left[at]] ^ values[right[at]]) <= reach
    may[at[~near]] = False
    return may


def _band(value: Column, band: int, bands: int) -> Column:
    start, stop = BITS * band // bands, BITS * (band + 1) // bands
    return F.shiftrightunsigned(value, start).bitwiseAND(F.lit((1 << (stop - start)) - 1))


def fingerprint_links(distinct: DataFrame, reach: int = REACH, block: int = BLOCK) -> DataFrame:
    """Pairs ``a``, ``b`` whose components are those of all links of ``distinct`` (``fingerprint``)."""
    keys = ["band", "value", *BLOCKS]
    bands = F.array(
        *[
            F.struct(F.lit(i).alias("band"), _band(F.col("fingerprint"), i, reach + 1).alias("value"))
            for i in range(reach + 1)
        ]
    )

    def tabled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            tables = pivot_table(batch["fingerprint"].to_numpy(np.int64).view(np.uint64))
            yield batch.assign(distances=[t.tobytes() for t in tables])

    rows = (
        distinct.select("fingerprint")
        .mapInPandas(tabled, "fingerprint long, distances binary")
        .select("fingerprint", "distances", F.inline(bands))
    )
    dealt = (
        blocked(rows, ["band", "value"], "fingerprint", block)
        .repartition(*keys)
        .sortWithinPartitions(*keys)
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_groups(batches, keys):
            yield from _linked(frame, keys, reach)

    return dealt.mapInPandas(run, "a long, b long")


def _linked(frame: pd.DataFrame, keys: list[str], reach: int) -> Iterator[pd.DataFrame]:
    signed = frame["fingerprint"].to_numpy(np.int64)
    values = signed.view(np.uint64)
    tables = np.frombuffer(b"".join(frame["distances"]), np.int8).reshape(len(frame), -1)
    block = frame["block"].to_numpy()
    across = frame["low"].to_numpy() != frame["high"].to_numpy()
    starts = group_starts(frame, keys)
    sizes = np.diff(np.append(starts, len(frame)))
    group = np.repeat(np.arange(len(starts)), sizes)
    small = np.flatnonzero((sizes <= SMALL)[group])

    def pairs(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        meet = ~across[left] | (block[left] != block[right])
        left, right = left[meet], right[meet]
        found = links_within(values, tables, left, right, reach)
        return left[found], right[found]

    for shift in range(1, min(SMALL, len(small))):
        left, right = small[:-shift], small[shift:]
        same = group[left] == group[right]
        if not same.any():
            break
        left, right = pairs(left[same], right[same])
        if len(left):
            yield pd.DataFrame({"a": signed[left], "b": signed[right]})
    for g in np.flatnonzero(sizes > SMALL):
        rows = np.arange(starts[g], starts[g] + sizes[g])
        root = np.arange(len(rows))
        step = max(1, (1 << 17) // len(rows))
        for at in range(0, len(rows), step):
            i, j = np.meshgrid(np.arange(at, min(at + step, len(rows))), np.arange(len(rows)), indexing="ij")
            later = j > i
            left, right = pairs(rows[i[later]], rows[j[later]])
            root = local_roots(
                len(rows),
                np.concatenate([np.arange(len(rows)), left - rows[0]]),
                np.concatenate([root, right - rows[0]]),
            )
        hung = np.flatnonzero(root != np.arange(len(rows)))
        if len(hung):
            yield pd.DataFrame({"a": signed[rows[hung]], "b": signed[rows[root[hung]]]})


def fingerprint_components(prints: DataFrame, reach: int = REACH, block: int = BLOCK) -> DataFrame:
    """``fingerprint``, ``component`` for every distinct fingerprint."""
    distinct = materialise(prints.select("fingerprint").distinct())
    parts = connected_components(fingerprint_links(distinct, reach, block))
    return distinct.join(parts, distinct["fingerprint"] == parts["node"], "left").select(
        "fingerprint", F.coalesce("component", "fingerprint").alias("component")
    )


def near_duplicates(
    docs: DataFrame, width: int = WIDTH, reach: int = REACH, block: int = BLOCK
) -> DataFrame:
    """One row per document: ``doc_id``, ``fingerprint`` (long), ``component_id``.

    ``component_id`` is the smallest ``doc_id`` reachable over links. Texts
    without words (null, empty, white space) have fingerprint 0 and link like
    others. Repeated rows are rows with equal fingerprints. Documents with a
    null id count as the last; a component of these alone has a null id. An
    empty table gives no rows. Other columns do not matter.
    """
    prints = materialise(fingerprints(docs.select("doc_id", "text"), "text", width))
    parts = fingerprint_components(prints, reach, block)
    least = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
    named = materialise(parts.join(least, "fingerprint"))
    ids = named.groupBy("component").agg(F.min("least").alias("component_id"))
    classes = named.join(ids, "component").select("fingerprint", "component_id")
    return prints.join(classes, "fingerprint", "left").select("doc_id", "fingerprint", "component_id")


def one_of_each(
    docs: DataFrame, width: int = WIDTH, reach: int = REACH, block: int = BLOCK
) -> DataFrame:
    """The rows of ``docs`` with one document of every component: the smallest id's, once.

    Documents of one id with different texts are told apart by their texts.
    """
    mark = lambda: F.xxhash64(F.coalesce("text", F.lit("\0")))
    prints = materialise(
        fingerprints(docs.select("doc_id", mark().alias("mark"), "text"), "text", width)
    )
    parts = fingerprint_components(prints, reach, block)
    entry = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "mark")
    kept = (
        prints.groupBy("fingerprint")
        .agg(F.min(entry).alias("best"))
        .join(parts, "fingerprint")
        .groupBy("component")
        .agg(F.min("best").alias("best"))
        .select(F.col("best.doc_id").alias("_kept"), F.col("best.mark").alias("_kept_mark"))
        .distinct()
    )
    marked = docs.withColumn("_mark", mark())
    return (
        marked.join(
            kept,
            F.col("doc_id").eqNullSafe(F.col("_kept")) & (F.col("_mark") == F.col("_kept_mark")),
            "left_semi",
        )
        .dropDuplicates(["doc_id", "_mark"])
        .drop("_mark")
    )
