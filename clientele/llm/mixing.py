"""Mixing sources to target weights by systematic sampling.

Every source has a target number of words. A document's expected number of
copies is its source's target over its source's size; the prefix sums of these
within the source start from one random offset, and a document is taken once
per whole number its interval crosses. Documents are taken in descending order
of size, so that picks stand for neighbours of about their own size: what is
taken from a source differs from its target by no more than about its longest
document.

The order is made by a range partitioning, never by a window over a source: a
source with a third of all rows, or all rows of one size, is cut like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clientele.llm.common import packed, unpacked, word_count
from clientele.sources.scratch import materialise

WEIGHTS = (1, 2, 3)
CEILING = 3
#: Offsets are multiples of 2^-20, so sums with whole numbers are exact.
STEPS = 1 << 20
ROWS = (1 << 33) - 1


def offset(source: Column, seed: int) -> Column:
    """The random offset of a source in [0, 1), the same in every run."""
    digest = F.md5(F.concat(F.coalesce(source, F.lit("\0")), F.lit(f"|{seed}")).cast("binary"))
    return F.conv(F.substring(digest, 1, 5), 16, 10).cast("double") / F.lit(float(STEPS))


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, ceiling: int = CEILING
) -> DataFrame:
    """One row per source: ``source``, ``source_size``, ``documents``, ``earlier``, ``target``.

    ``sizes`` has ``source`` and ``size``. Sources in code point order, null
    last, have the weights in turn; ``earlier`` counts the documents of sources
    before this one. No target exceeds ``ceiling`` times its source's size; the
    excess is shared out again by weight until none does. In ascending order of
    ceiling over weight a source is at its ceiling if its share of what the
    sources before it leave exceeds it, which is the same. Comparisons are of
    whole numbers. The windows run over one row per source.
    """
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    whole = "decimal(38,0)"
    named = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("documents"))
        .withColumn("turn", F.row_number().over(by_name) - 1)
        .withColumn(
            "weight",
            F.element_at(
                F.array(*[F.lit(int(w)) for w in weights]),
                (F.col("turn") % len(weights) + 1).cast("int"),
            ).cast("long"),
        )
        .withColumn(
            "earlier",
            F.coalesce(
                F.sum("documents").over(by_name.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
            ),
        )
        .withColumn("most", F.lit(ceiling) * F.col("source_size"))
        .withColumn("words", F.sum("source_size").over(everything))
        .withColumn("weights", F.sum("weight").over(everything))
    )
    by_room = W.orderBy(F.col("most") / F.col("weight"), "turn").rowsBetween(
        W.unboundedPreceding, -1
    )
    left = F.col("words") - F.coalesce(F.sum("most").over(by_room), F.lit(0))
    sharing = F.col("weights") - F.coalesce(F.sum("weight").over(by_room), F.lit(0))
    full = named.withColumn(
        "full",
        left.cast(whole) * F.col("weight").cast("decimal(9,0)")
        > F.col("most").cast(whole) * sharing.cast("decimal(9,0)"),
    )
    spent = F.sum(F.when(F.col("full"), F.col("most")).otherwise(0)).over(everything)
    gone = F.sum(F.when(F.col("full"), F.col("weight")).otherwise(0)).over(everything)
    share = ((F.col("words") - spent) * F.col("weight")).cast("double") / (
        F.col("weights") - gone
    ).cast("double")
    return full.select(
        "source",
        "source_size",
        "documents",
        "earlier",
        F.when(F.col("full"), F.col("most").cast("double")).otherwise(share).alias("target"),
    )


def systematic_copies(
    rows: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    ceiling: int = CEILING,
    seed: int = 0,
) -> DataFrame:
    """Add ``source_size``, ``target`` and ``copies`` to rows with ``doc_id``, ``source``, ``size``.

    ``copies`` is how often the mix takes the row, at most ``ceiling`` rounded
    up. A null source is a source of its own, null ids come first among equal
    sizes, repeated rows are rows like others, sources without words get no
    copies, an empty table gives no rows. The rows must be the same whenever
    they are read (a scan or a checkpoint).
    """
    order = [F.col("source").asc_nulls_last(), F.col("size").desc(), F.col("doc_id").asc()]
    placed = materialise(
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    part = F.shiftright("_at", 33)
    starts = (
        placed.groupBy(part.alias("_part"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(
            "_part",
            F.coalesce(
                F.sum("_rows").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)),
                F.lit(0),
            ).alias("_start"),
        )
    )
    targets = source_targets(placed.select("source", "size"), weights, ceiling)
    targets = targets.withColumnRenamed("source", "_source")
    rate = F.when(
        F.col("source_size") > 0, F.col("target") / F.col("source_size").cast("double")
    ).otherwise(0.0)
    rank = F.col("_start") + F.col("_at").bitwiseAND(F.lit(ROWS)) - F.col("earlier")
    reached = lambda n: F.floor(n.cast("double") * rate + offset(F.col("source"), seed))
    return (
        # one row per partition at most
        placed.join(F.broadcast(starts), part == F.col("_part"))
        .join(targets, F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("copies", reached(rank + 1) - reached(rank))
        .drop("_at", "_part", "_start", "_source", "documents", "earlier")
    )


def mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    ceiling: int = CEILING,
    seed: int = 0,
) -> DataFrame:
    """The mixed documents: every row of ``docs`` as often as the mix takes it, columns as they were."""
    rows = docs.select(
        "doc_id", "source", word_count(F.col("text")).alias("size"), packed(docs).alias("_row")
    )
    taken = (
        systematic_copies(rows, weights, ceiling, seed)
        .where(F.col("copies") > 0)
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    )
    return unpacked(taken, "_row", docs.columns)
