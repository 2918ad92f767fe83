"""Labels and message texts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from clientele.functions.numeric import col


def score_cell(*scores: Column | str) -> Column:
    """Scores side by side, such as ``543``."""
    return F.concat(*[col(s).cast("string") for s in scores])


def dollars(amount: Column | str, digits: int = 0) -> Column:
    return F.concat(F.lit("$"), F.format_number(col(amount), digits))


def percentage(value: Column | str, digits: int = 1) -> Column:
    return F.concat(F.format_number(col(value), digits), F.lit("%"))


def lookup(key: Column | str, table: Mapping) -> Column:
    """Constant mapping of labels; a key that is not listed gives null."""
    pairs = [F.lit(part) for pair in table.items() for part in pair]
    return F.try_element_at(F.create_map(*pairs), col(key))


def month_text(date: Column | str) -> Column:
    return F.date_format(col(date), "yyyy-MM")
