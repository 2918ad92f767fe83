"""Describe, percentile and outlier operators built on exact distributed quantiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.functions.numeric import rounded
from clientele.functions.ordering import Cut, Sample, counts, cuts, percentiles

QUARTILES = (0.25, 0.5, 0.75)


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, deviation, minimum, quartiles and maximum, one row per column."""
    found = percentiles(df, [(Sample(F.col(c)), QUARTILES) for c in columns])
    cells = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.count(c).alias("n"),
            rounded(F.avg(F.col(c).cast("double")), 4).alias("mean"),
            rounded(F.stddev_samp(F.col(c).cast("double")), 4).alias("std"),
            F.min(F.col(c).cast("double")).alias("min"),
            *[
                rounded(F.lit(q), 4).alias(name)
                for name, q in zip(("p25", "p50", "p75"), quartiles)
            ],
            F.max(F.col(c).cast("double")).alias("max"),
        )
        for c, quartiles in zip(columns, found)
    ]
    return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def grouped_percentiles(
    df: DataFrame, by: str, groups: Sequence[str], value: str, probabilities: Sequence[float]
) -> dict[str, list[float | None]]:
    """Exact quantiles of ``value`` within each of a known, short list of groups.

    A group may hold any share of the rows; it is never gathered in one task.
    """
    found = percentiles(
        df, [(Sample(F.col(value), F.col(by) == g), probabilities) for g in groups]
    )
    return dict(zip(groups, found))


def flag_top_share(df: DataFrame, flags: dict[str, str], quantile: float = 0.99) -> DataFrame:
    """Add a flag per column: the value reaches the given quantile of its column."""
    columns = list(flags)
    found = percentiles(df, [(Sample(F.col(c)), [quantile]) for c in columns])
    return df.withColumns(
        {
            flags[c]: F.coalesce(F.col(c).cast("double") >= F.lit(edge), F.lit(False))
            for c, (edge,) in zip(columns, found)
        }
    )


def clip_at_quantile(df: DataFrame, column: str, quantile: float, output: str) -> DataFrame:
    """The column bounded above by its own quantile."""
    ((edge,),) = percentiles(df, [(Sample(F.col(column)), [quantile])])
    value = F.col(column).cast("double")
    return df.withColumn(output, F.when(value.isNotNull(), F.least(value, F.lit(edge))))


def top_share_of_total(df: DataFrame, value: str, tie: str, share: float = 0.10) -> DataFrame:
    """What percentage of the total the top ``share`` of the rows holds."""
    sample = Sample(F.col(value))
    (size,) = counts(df, [sample])
    top = int(size * share + 1e-9)
    if top == 0:
        inside = F.lit(False)
    elif top == size:
        inside = F.lit(True)
    else:
        # Ties on the boundary have equal values, so which of them counts is no matter.
        (found,) = cuts(df, tie, [(sample, [size - top])], [size])
        cut: Cut = found[size - top]
        inside = ~cut.covers(F.col(value), F.col(tie))
    held = F.sum(F.when(inside, F.col(value))).cast("double")
    whole = F.sum(value).cast("double")
    return df.agg(
        F.count_if(inside).alias("top_rows"),
        rounded(held / F.nullif(whole, F.lit(0.0)) * 100, 4).alias("top_share_pct"),
    )


def box_statistics(
    df: DataFrame, by: str, groups: Sequence[str], value: str
) -> DataFrame:
    """Quartiles, whisker ends and number of outliers of ``value`` per group.

    Whiskers end at the outermost values within 1.5 times the quartile range.
    """
    found = grouped_percentiles(df, by, groups, value, QUARTILES)
    number = F.col(value).cast("double")

    def pick(which: int):
        ladder = F.when(F.lit(False), F.lit(None).cast("double"))
        for group, quartiles in found.items():
            ladder = ladder.when(F.col(by) == group, F.lit(quartiles[which]))
        return ladder

    low, middle, high = pick(0), pick(1), pick(2)
    reach = (high - low) * 1.5
    inside = (number >= low - reach) & (number <= high + reach)
    return (
        df.where(number.isNotNull() & F.col(by).isin(list(groups)))
        .groupBy(by)
        .agg(
            F.count(F.lit(1)).alias("n"),
            rounded(F.max(low), 4).alias("q1"),
            rounded(F.max(middle), 4).alias("median"),
            rounded(F.max(high), 4).alias("q3"),
            F.min(F.when(inside, number)).alias("lower_whisker"),
            F.max(F.when(inside, number)).alias("upper_whisker"),
            F.count_if(~inside).alias("outliers"),
        )
    )
