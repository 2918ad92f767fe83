"""Exact global ranks and quantiles without sorting everything in one task.

``ntile``, ``row_number`` and ``percentile`` over a whole table put every row,
or a map of every distinct value, into a single task. What they need, though,
is a handful of order statistics: the value standing at a given rank. Those are
found by counting in ever narrower bins:

1. one aggregate counts the rows in bins that are the same for any data, a few
   to each doubling of the value, with the least and the greatest value of each;
2. only the bins that hold a wanted rank are looked into: their rows are counted
   in a thousand steps between their own least and greatest value, again and
   again, until a bin has one value or so few rows that its values are listed.

Counts add up, so every step is an aggregate with map-side partials whose result
is bounded by the number of bins, at any number of rows and however many of them
share a value. Ties of a value are resolved by the same search over the tie-break
column. The answers are literals, so that tiles and bins become CASE ladders
evaluated where the rows are, with no shuffle of the rows at all.

The functions here run jobs; pass them a table that is cheap to read again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientele.sources.scratch import materialise

#: Bins to a doubling of the value in the first count, and steps of a bin that is looked into.
OCTAVE, STEPS = 16, 1024
#: Rows of a bin whose values are listed.
LISTED = 8192
#: Where values that are no numbers stand: after all others.
LAST = 1 << 40


@dataclass(frozen=True)
class Sample:
    """A numeric column of the rows that satisfy ``where``."""

    value: Column
    where: Column | None = None

    def kept(self) -> Column:
        if self.where is None:
            return self.value
        return F.when(self.where, self.value)


@dataclass(frozen=True)
class Standing:
    """The value at a rank, how many rows precede that value, and its ties."""

    value: object
    below: int
    ties: int


Bin = tuple  # least value, greatest value, rows


class Survey(list):
    """The number of non-null values of every sample, and the first count in ``bins``."""

    bins: list[list[Bin]]


@dataclass
class _Gap:
    """A part of a sample's order that holds wanted ranks; without edges it is all of it."""

    sample: Sample
    at: int
    low: object
    high: object
    below: int
    rows: int
    ranks: list[int]

    def inside(self) -> Column:
        kept = self.sample.kept()
        if self.low is None:
            return kept.isNotNull()
        return (kept >= F.lit(self.low)) & (kept <= F.lit(self.high))

    def settled(self) -> bool:
        return self.low is not None and _place(self.low) == _place(self.high)

    def split(self, bins: list[Bin]) -> list[_Gap]:
        """The bins that hold the ranks."""
        out, below = [], self.below
        for low, high, rows in bins:
            ranks = [k for k in self.ranks if below < k <= below + rows]
            if ranks:
                out.append(_Gap(self.sample, self.at, low, high, below, rows, ranks))
            below += rows
        return out


def _place(value) -> tuple:
    """Sorts like the engine does, what is no number after all others."""
    return (1, 0) if value != value else (0, value)


def _carrier(dtype: T.DataType) -> T.DataType:
    """A type that holds whole and decimal numbers alike; others keep their own."""
    if isinstance(dtype, T.IntegralType) or (
        isinstance(dtype, T.DecimalType) and dtype.scale <= 6
    ):
        return T.DecimalType(38, 6)
    return dtype


def _restored(value, dtype: T.DataType):
    return int(value) if isinstance(dtype, T.IntegralType) else value


def _counted(df: DataFrame, samples: Sequence[Sample], cells) -> list[list[Bin]]:
    """The bins of every sample in order; ``cells`` gives the condition, bin and listed value of one.

    Samples of one kind of number share a job.
    """
    out: list[list[Bin]] = [[] for _ in samples]
    if not samples:
        return out
    probe = df.select(*[s.value.alias(f"v{i}") for i, s in enumerate(samples)]).schema
    by_type: dict[T.DataType, list[int]] = {}
    for i in range(len(samples)):
        by_type.setdefault(_carrier(probe[f"v{i}"].dataType), []).append(i)
    for carrier, indexes in by_type.items():
        parts = []
        for i in indexes:
            inside, number, listed = cells(i, carrier)
            value = samples[i].kept().cast(carrier)
            cell = F.struct(
                F.lit(i).alias("i"), number.cast("long").alias("bin"),
                (value if listed else F.lit(None).cast(carrier)).alias("listed"), value.alias("value"),
            )
            parts.append(F.when(inside, cell))
        rows = (
            df.select(F.explode(F.array_compact(F.array(*parts))).alias("p"))
            .select("p.*")
            .groupBy("i", "bin", "listed")
            .agg(F.min("value").alias("low"), F.max("value").alias("high"), F.count(F.lit(1)).alias("rows"))
            .collect()
        )
        for row in rows:
            dtype = probe[f"v{row['i']}"].dataType
            out[row["i"]].append((_restored(row["low"], dtype), _restored(row["high"], dtype), row["rows"]))
    return [sorted(bins, key=lambda b: _place(b[0])) for bins in out]


def counts(df: DataFrame, samples: Sequence[Sample]) -> Survey:
    """The number of non-null values of every sample, with a first count in bins."""

    def cells(i: int, carrier: T.DataType):
        kept = samples[i].kept()
        value = kept.cast("double")
        size = F.floor(F.log2(F.abs(value) + 1) * OCTAVE)
        number = F.when(F.isnan(value), F.lit(LAST)).when(value < 0, -size - 1).otherwise(size)
        return kept.isNotNull(), number, False

    bins = _counted(df, samples, cells)
    found = Survey(sum(rows for _, _, rows in one) for one in bins)
    found.bins = bins
    return found


def _steps(gap: _Gap, carrier: T.DataType) -> Column:
    """The step of a value between the gap's least and greatest."""
    kept, low, high = gap.sample.kept(), gap.low, gap.high
    if isinstance(carrier, (T.FloatType, T.DoubleType)):
        value = kept.cast("double")
        if not (abs(low) < float("inf") and abs(high) < float("inf")):
            return F.when(kept == F.lit(high), F.lit(2)).when(kept == F.lit(low), F.lit(0)).otherwise(F.lit(1))
        # halves, as the whole span may be too large
        share = (value / 2 - F.lit(low / 2)) / F.lit(high / 2 - low / 2)
    else:
        share = (kept.cast(carrier) - F.lit(low).cast(carrier)).cast("double") / F.lit(float(high - low))
    return F.least(F.floor(share * STEPS), F.lit(STEPS - 1))


def _narrowed(df: DataFrame, gaps: list[_Gap]) -> list[_Gap]:
    """The bins within the gaps that hold their ranks."""

    def cells(i: int, carrier: T.DataType):
        listed = gaps[i].rows <= LISTED
        return gaps[i].inside(), F.lit(0) if listed else _steps(gaps[i], carrier), listed

    found = _counted(df, [g.sample for g in gaps], cells)
    return [one for gap, bins in zip(gaps, found) for one in gap.split(bins)]


def standings(
    df: DataFrame, requests: Sequence[tuple[Sample, Sequence[int]]], sizes: Sequence[int]
) -> list[dict[int, Standing]]:
    """For each sample, the value standing at each of the 1-based ``ranks``.

    ``sizes`` are the samples' numbers of values, best as ``counts`` gives them.
    """
    out: list[dict[int, Standing]] = [dict() for _ in requests]
    gaps: list[_Gap] = []
    for at, ((sample, ranks), size) in enumerate(zip(requests, sizes)):
        wanted = sorted({k for k in ranks if 1 <= k <= size})
        if wanted:
            gaps.append(_Gap(sample, at, None, None, 0, size, wanted))
    if isinstance(sizes, Survey):
        gaps = [one for gap in gaps for one in gap.split(sizes.bins[gap.at])]
    else:
        large = [g for g in gaps if g.rows > LISTED]
        gaps = [g for g in gaps if g.rows <= LISTED]
        for gap, bins in zip(large, counts(df, [g.sample for g in large]).bins):
            gaps += gap.split(bins)
    while gaps:
        for gap in gaps:
            if gap.settled():
                out[gap.at].update({k: Standing(gap.low, gap.below, gap.rows) for k in gap.ranks})
        open_ = [g for g in gaps if not g.settled()]
        gaps = _narrowed(df, open_) if open_ else []
    return out


@dataclass(frozen=True)
class Cut:
    """A place in the order (value, tie-break): everything up to and including it."""

    value: object
    tie: object | None

    def covers(self, value: Column, tie: Column) -> Column:
        if self.tie is None:
            return value <= F.lit(self.value)
        return (value < F.lit(self.value)) | (
            (value == F.lit(self.value)) & (tie <= F.lit(self.tie))
        )


def cuts(
    df: DataFrame, tie: str, requests: Sequence[tuple[Sample, Sequence[int]]], sizes: Sequence[int]
) -> list[dict[int, Cut]]:
    """The cut after each rank, ties being ordered by the column ``tie``."""
    stood = standings(df, requests, sizes)
    split, out = [], [dict() for _ in requests]
    for i, ((sample, _), ranks) in enumerate(zip(requests, stood)):
        for rank, s in ranks.items():
            if rank == s.below + s.ties:
                out[i][rank] = Cut(s.value, None)
            else:
                split.append((i, rank, s))
    groups: dict[tuple, list] = {}
    for i, rank, s in split:
        groups.setdefault((i, s.value), []).append((rank, s))
    tied = []
    for (i, value), members in groups.items():
        sample = requests[i][0]
        same = sample.value == F.lit(value)
        where = same if sample.where is None else sample.where & same
        tied.append((Sample(F.col(tie), where), [rank - s.below for rank, s in members]))
    resolved = standings(df, tied, [members[0][1].ties for members in groups.values()])
    for ((i, value), members), ties in zip(groups.items(), resolved):
        for rank, s in members:
            out[i][rank] = Cut(value, ties[rank - s.below].value)
    return out


def ntile_ends(size: int, tiles: int) -> list[int]:
    """The last rank of each tile but the final one, as SQL NTILE sizes them."""
    return [k * (size // tiles) + min(k, size % tiles) for k in range(1, tiles)]


def rank_quantile_ends(size: int, bins: int) -> list[int]:
    """The last rank of each equal-frequency bin over the ranks 1..size.

    Bin edges are the interpolated quantiles ``1 + (size - 1) k / bins`` of the
    ranks, closed on the right; exact in integers.
    """
    return [1 + ((size - 1) * k) // bins for k in range(1, bins)] if size else []


@dataclass(frozen=True)
class Tiling:
    """A score column to add: tiles of ``column`` ascending, ties by the tie column."""

    column: str
    output: str
    tiles: int = 5
    descending_label: bool = False
    ends: object = ntile_ends


def add_tiles(df: DataFrame, tie: str, tilings: Sequence[Tiling]) -> DataFrame:
    """Add several global tile columns; the rows stay in their partitions."""
    samples = [Sample(F.col(t.column)) for t in tilings]
    sizes = counts(df, samples)
    ends = [t.ends(size, t.tiles) for t, size in zip(tilings, sizes)]
    placed = cuts(df, tie, list(zip(samples, ends)), sizes)
    columns = {}
    for tiling, sample, after, found in zip(tilings, samples, ends, placed):
        ladder = F.when(sample.value.isNull(), F.lit(None).cast("int"))
        for tile, rank in enumerate(after, start=1):
            label = tiling.tiles + 1 - tile if tiling.descending_label else tile
            if rank in found:
                ladder = ladder.when(
                    found[rank].covers(sample.value, F.col(tie)), F.lit(label)
                )
        last = 1 if tiling.descending_label else tiling.tiles
        columns[tiling.output] = ladder.otherwise(F.lit(last))
    return df.withColumns(columns)


def percentiles(
    df: DataFrame, requests: Sequence[tuple[Sample, Sequence[float]]]
) -> list[list[float | None]]:
    """Exact linearly interpolated quantiles of several samples."""
    sizes = counts(df, [s for s, _ in requests])
    needed = []
    for (sample, probabilities), size in zip(requests, sizes):
        at = [(size - 1) * p for p in probabilities]
        needed.append((sample, [k for h in at for k in (int(h) + 1, int(h) + 2)]))
    stood = standings(df, needed, sizes)
    out = []
    for (sample, probabilities), size, ranks in zip(requests, sizes, stood):
        values: list[float | None] = []
        for p in probabilities:
            if size == 0:
                values.append(None)
                continue
            h = (size - 1) * p
            low = float(ranks[int(h) + 1].value)
            share = h - int(h)
            high = float(ranks[int(h) + 2].value) if share > 0 else low
            values.append(low + (high - low) * share)
        out.append(values)
    return out


def prefix_sums(
    df: DataFrame, order: Sequence[str], measures: Sequence[str], keys: Sequence[str] = ()
) -> DataFrame:
    """Add ``upto_<measure>``: its sum over the rows of the same ``keys`` up to this one in ``order``.

    Rows are range-partitioned by keys and order, into as many parts as the data
    have; each part runs up its own sums and starts from those of the parts before
    it, one row per part and key. Rows equal in keys and order are cut like
    others. Keys must not be null.
    """
    placed = materialise(
        df.withColumn("_row", F.monotonically_increasing_id())
        .repartitionByRange(*keys, *order, "_row")
        .withColumn("_part", F.spark_partition_id())
    )
    before = W.partitionBy(*keys).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        placed.groupBy(*keys, "_part")
        .agg(*[F.sum(m).alias(m) for m in measures])
        .select(
            *keys,
            "_part",
            *[F.coalesce(F.sum(m).over(before), F.lit(0)).alias(f"_before_{m}") for m in measures],
        )
    )
    inside = W.partitionBy(*keys, "_part").orderBy(*order, "_row").rowsBetween(W.unboundedPreceding, 0)
    return (
        placed.withColumns({f"upto_{m}": F.sum(m).over(inside) for m in measures})
        .join(starts, [*keys, "_part"])
        .withColumns({f"upto_{m}": F.col(f"upto_{m}") + F.col(f"_before_{m}") for m in measures})
        .drop("_row", "_part", *[f"_before_{m}" for m in measures])
    )


def add_row_number(df: DataFrame, value: str, tie: str, output: str) -> DataFrame:
    """The global row number by (value, tie); rows without a value are left out."""
    counted = df.where(F.col(value).isNotNull()).withColumn("_one", F.lit(1).cast("long"))
    return (
        prefix_sums(counted, [value, tie], ["_one"])
        .withColumn(output, F.col("upto__one"))
        .drop("_one", "upto__one")
    )


def running_totals(
    df: DataFrame, key: str, measures: Sequence[str], groups: Sequence[str] = ()
) -> DataFrame:
    """Add ``upto_<measure>``: its sum over all rows of the group with a key not above this one's.

    One row per group and key.
    """
    return prefix_sums(df, [key], measures, groups)
