"""Rounding, safe division, clipping and binning as column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

CENT = Decimal("0.01")


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rounded(c: Column | str, digits: int) -> Column:
    """Round half up on the decimal reading of the number, back to double.

    Rounding the binary value would send 1.005 to 1.00 in one engine and to
    1.01 in another; through a decimal all agree.
    """
    return F.round(col(c).try_cast("decimal(38,6)"), digits).cast("double")


def ratio(top: Column | str, bottom: Column | str) -> Column:
    """``top / bottom`` as double, null where ``bottom`` is zero or null."""
    below = col(bottom).cast("double")
    return col(top).cast("double") / F.nullif(below, F.lit(0.0))


def percent(top: Column | str, bottom: Column | str, digits: int = 2) -> Column:
    return rounded(ratio(top, bottom) * 100, digits)


def clipped(
    c: Column | str, low: Column | float | None = None, high: Column | float | None = None
) -> Column:
    """Bound a column; nulls stay null."""
    out = source = col(c)
    if low is not None:
        out = F.greatest(out, low if isinstance(low, Column) else F.lit(low))
    if high is not None:
        out = F.least(out, high if isinstance(high, Column) else F.lit(high))
    return F.when(source.isNotNull(), out)


def money_sum(amount: Column | str) -> Column:
    """Exact sum of a two-digit decimal, added up as whole cents in a long.

    A decimal sum keeps an object per group; a long stays in the aggregation
    buffer itself. Good for amounts below 9e13 and groups below 9e16; beyond
    that the sum fails instead of wrapping.
    """
    cents = F.rint(col(amount).cast("double") * 100).cast("long")
    return (F.sum(cents).cast("decimal(20,0)") * F.lit(CENT)).cast("decimal(28,2)")


def upper_edge_label(c: Column | str, edges: Sequence[float], labels: Sequence) -> Column:
    """Label by the first upper edge not exceeded; past the last one, the last label.

    Equal edges leave the labels between them unused. Nulls have no label.
    """
    value = col(c)
    if len(labels) != len(edges) + 1:
        raise ValueError("one label more than inner edges is needed")
    ladder = F.when(value.isNull(), F.lit(None))
    for edge, label in zip(edges, labels):
        ladder = ladder.when(value <= F.lit(edge), F.lit(label))
    return ladder.otherwise(F.lit(labels[-1]))


def fixed_bins(c: Column | str, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed bins ``(edges[i], edges[i+1]]``; outside of them, null.

    The lowest edge itself is outside, as the first bin is open on the left.
    """
    value = col(c)
    if len(edges) != len(labels) + 1:
        raise ValueError("one edge more than labels is needed")
    ladder = F.when(value.isNull() | (value <= edges[0]) | (value > edges[-1]), F.lit(None))
    for edge, label in zip(edges[1:], labels):
        ladder = ladder.when(value <= edge, F.lit(label))
    return ladder


def first_match(rules: Sequence[tuple[Column, str]], default: str) -> Column:
    """A CASE ladder: the label of the first rule that holds."""
    ladder = F.when(F.lit(False), F.lit(None).cast("string"))
    for condition, label in rules:
        ladder = ladder.when(condition, F.lit(label))
    return ladder.otherwise(F.lit(default))
