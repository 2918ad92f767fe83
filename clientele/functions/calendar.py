"""Month, week and tenure arithmetic on dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clientele.functions.numeric import col


def month_of(date: Column | str) -> Column:
    return F.trunc(col(date), "MM")


def month_index(date: Column | str) -> Column:
    """Months since year zero, so that differences count month boundaries."""
    d = col(date)
    return F.year(d) * 12 + F.month(d)


def months_between_starts(start: Column | str, end: Column | str) -> Column:
    return month_index(end) - month_index(start)


def week_closing_monday(date: Column | str) -> Column:
    """The Monday that closes the week of ``date``; a Monday closes its own week."""
    return F.next_day(F.date_sub(col(date), 1), "MON")


def week_of_month(date: Column | str) -> Column:
    return F.floor((F.dayofmonth(col(date)) - 1) / 7).cast("int") + 1


def tenure_months(start: Column | str, snapshot: Column | str) -> Column:
    """Whole blocks of 30 days from ``start`` to the snapshot."""
    return F.floor(F.datediff(col(snapshot), col(start)) / 30).cast("int")


def epoch_micros(ts: Column | str) -> Column:
    """Microseconds of a timestamp without time zone, in any session time zone."""
    t = col(ts)
    day = F.unix_date(t.cast("date")).cast("long") * 86_400_000_000
    clock = F.hour(t).cast("long") * 3_600_000_000 + F.minute(t).cast("long") * 60_000_000
    return day + clock + (F.extract(F.lit("SECOND"), t) * 1_000_000).cast("long")
