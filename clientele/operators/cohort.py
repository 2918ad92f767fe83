"""Monthly cohorts: activity, retention, revenue retention and summaries.

Purchases are reduced to one row per customer and month before anything else.
From there on a customer counts at most once per period, and no customer has
more rows than there are months.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clientele.functions.calendar import month_of, months_between_starts
from clientele.functions.numeric import money_sum, percent, ratio, rounded
from clientele.sources.schemas import require_columns
from clientele.sources.scratch import materialise


def active_months(purchases: DataFrame) -> DataFrame:
    return purchases.groupBy("customer_id", month_of("order_date").alias("order_month")).agg(
        money_sum("order_amount").alias("amount"), F.count(F.lit(1)).alias("orders")
    )


def signup_activity(
    customers: DataFrame,
    purchases: DataFrame,
    customer_id: str = "customer_id",
    signup_date: str = "signup_date",
    order_date: str = "order_date",
    order_amount: str = "order_amount",
) -> DataFrame:
    """Activity per customer and month since signup.

    Purchases without a customer, or before the month of signup, are left out.
    """
    require_columns(customers, [customer_id, signup_date])
    require_columns(purchases, [customer_id, order_date, order_amount])
    cohorts = customers.where(F.col(signup_date).isNotNull()).select(
        F.col(customer_id).alias("customer_id"), month_of(signup_date).alias("cohort_month")
    )
    months = active_months(
        purchases.select(
            F.col(customer_id).alias("customer_id"),
            F.col(order_date).alias("order_date"),
            F.col(order_amount).alias("order_amount"),
        )
    )
    return (
        months.join(cohorts, "customer_id")
        .withColumn("period_number", months_between_starts("cohort_month", "order_month"))
        .where(F.col("period_number") >= 0)
    )


def first_purchase_activity(purchases: DataFrame, max_period: int | None = 12) -> DataFrame:
    """Activity per customer and month since the month of the first purchase.

    The first month is a minimum over the few month rows of a customer, in
    place of a join of all purchases with each customer's first.
    """
    per_customer = W.partitionBy("customer_id")
    activity = active_months(purchases).withColumn(
        "cohort_month", F.min("order_month").over(per_customer)
    )
    activity = activity.withColumn(
        "period_number", months_between_starts("cohort_month", "order_month")
    )
    if max_period is not None:
        activity = activity.where(F.col("period_number").between(0, max_period))
    return activity


def cohort_totals(activity: DataFrame) -> DataFrame:
    """Active customers and revenue per cohort and period."""
    return activity.groupBy("cohort_month", "period_number").agg(
        F.count(F.lit(1)).alias("active_customers"), F.sum("amount").alias("amount")
    )


def retention(totals: DataFrame, digits: int = 4) -> DataFrame:
    """Active customers relative to those of period zero; null where it has none.

    One row per cohort and period: the size of a cohort is a window over its
    own periods.
    """
    own = W.partitionBy("cohort_month")
    size = F.max(F.when(F.col("period_number") == 0, F.col("active_customers"))).over(own)
    return totals.withColumn("cohort_size", size).select(
        "cohort_month",
        "period_number",
        "cohort_size",
        "active_customers",
        rounded(ratio("active_customers", "cohort_size"), digits).alias("retention_rate"),
    )


def retention_percent(totals: DataFrame) -> DataFrame:
    return retention(totals).select(
        "cohort_month",
        "cohort_size",
        "period_number",
        "active_customers",
        percent("active_customers", "cohort_size").alias("retention_rate_pct"),
    )


def cohort_sizes(totals: DataFrame) -> DataFrame:
    return totals.where(F.col("period_number") == 0).select(
        "cohort_month", F.col("active_customers").alias("cohort_size")
    )


def revenue_retention(totals: DataFrame, digits: int = 4) -> DataFrame:
    """Revenue relative to that of period zero."""
    own = W.partitionBy("cohort_month")
    start = F.max(F.when(F.col("period_number") == 0, F.col("amount"))).over(own)
    return totals.withColumn("start", start).select(
        "cohort_month",
        "period_number",
        F.col("amount").cast("double").alias("revenue"),
        rounded(ratio("amount", "start"), digits).alias("revenue_retention"),
    )


def matrix(rates: DataFrame, value: str) -> DataFrame:
    """One row per cohort, one column per period that occurs; null where there is no data.

    The periods are read from the data; the calendar bounds their number.
    """
    return rates.groupBy("cohort_month").pivot("period_number").agg(F.first(value))


def matrix_rows(rates: DataFrame, value: str, digits: int = 4) -> DataFrame:
    """The matrix with one text per cohort: the values by period from 0 on, comma-separated, empty where none.

    A cohort's text ends with its last period. Columns do not hang on the data,
    so that the table can be a view or be appended to.
    """
    known = F.collect_list(F.struct("period_number", F.col(value).cast(f"decimal(18,{digits})").cast("string").alias("v")))
    of = lambda p: F.filter("known", lambda k: k["period_number"] == p)
    last = F.array_max(F.transform("known", lambda k: k["period_number"]))
    cells = F.transform(F.sequence(F.lit(0), last.cast("int")), lambda p: F.coalesce(F.get(of(p), 0)["v"], F.lit("")))
    return (
        rates.where(F.col("period_number") >= 0)
        .groupBy("cohort_month")
        .agg(known.alias("known"))
        .select("cohort_month", F.array_join(cells, ",").alias("rates"))
    )


def evaluated_period(rates: DataFrame, at_period: int = 3) -> DataFrame:
    """The rates of one period, or of the last one there is when it is absent."""
    periods = rates.agg(
        F.max(F.when(F.col("period_number") == at_period, F.col("period_number"))).alias("wanted"),
        F.max("period_number").alias("last"),
    )
    chosen = periods.select(F.coalesce("wanted", "last")).scalar()
    return rates.where((F.col("period_number") == chosen) & F.col("retention_rate").isNotNull())


def top_and_bottom(rates: DataFrame, n: int = 3, at_period: int = 3) -> DataFrame:
    """The best and worst cohorts at a period, with the mean over all cohorts.

    The rates, one row per cohort and period, are read several times and so
    computed once.
    """
    rates = materialise(rates)
    at = evaluated_period(rates, at_period).select(
        "cohort_month",
        "period_number",
        "retention_rate",
        rounded(F.avg("retention_rate").over(W.partitionBy()), 4).alias("mean_rate"),
    )
    best = at.orderBy(F.desc("retention_rate"), "cohort_month").limit(n)
    worst = at.orderBy("retention_rate", F.desc("cohort_month")).limit(n)
    return best.withColumn("side", F.lit("top")).unionByName(
        worst.withColumn("side", F.lit("bottom"))
    )


def checkpoints(rates: DataFrame, periods: Sequence[int] = (1, 3, 6, 12)) -> DataFrame:
    """Size and rates at fixed periods per cohort; mean of the rates at 1, 3 and 6."""
    at = {
        p: F.max(F.when(F.col("period_number") == p, F.col("retention_rate"))) for p in periods
    }
    columns = {p: f"retention_m{p}" for p in periods}
    averaged = [c for p, c in columns.items() if p in (1, 3, 6)]
    present = [F.when(F.col(c).isNotNull(), F.lit(1)).otherwise(F.lit(0)) for c in averaged]
    total = sum((F.coalesce(c, F.lit(0.0)) for c in averaged), F.lit(0.0))
    return (
        rates.groupBy("cohort_month")
        .agg(
            F.max("cohort_size").alias("cohort_size"),
            *[at[p].alias(columns[p]) for p in periods],
        )
        .where(F.col("cohort_size").isNotNull())
        .withColumn("avg_retention_m1_m6", rounded(ratio(total, sum(present, F.lit(0))), 4))
    )


def cohort_means(percentages: DataFrame) -> DataFrame:
    """Size, rates at months 1, 3 and 6, and mean over all periods after the first."""
    def at(p: int):
        return F.max(F.when(F.col("period_number") == p, F.col("retention_rate_pct")))

    return percentages.groupBy("cohort_month").agg(
        F.max("cohort_size").alias("cohort_size"),
        at(1).alias("month_1_retention"),
        at(3).alias("month_3_retention"),
        at(6).alias("month_6_retention"),
        rounded(
            F.avg(F.when(F.col("period_number") >= 1, F.col("retention_rate_pct"))), 4
        ).alias("avg_retention"),
    )


def ranked_cohorts(means: DataFrame, n: int = 5) -> DataFrame:
    """Top and bottom cohorts by mean retention and the gap between the extremes."""
    usable = materialise(means.where(F.col("avg_retention").isNotNull()))
    whole = W.partitionBy()
    gap = rounded(F.max("avg_retention").over(whole) - F.min("avg_retention").over(whole), 4)
    measured = usable.select("cohort_month", "cohort_size", "avg_retention", gap.alias("gap"))
    best = measured.orderBy(F.desc("avg_retention"), "cohort_month").limit(n)
    worst = measured.orderBy("avg_retention", "cohort_month").limit(n)
    return best.withColumn("side", F.lit("top")).unionByName(
        worst.withColumn("side", F.lit("bottom"))
    )


def signup_retention(
    customers: DataFrame, activity: DataFrame, cohorts: int = 18, last_period: int = 12
) -> DataFrame:
    """Retention against all signups of a cohort, for the latest cohorts with activity."""
    signed = customers.groupBy(month_of("signup_date").alias("cohort_month")).agg(
        F.count(F.lit(1)).alias("signups")
    )
    active = cohort_totals(activity)
    latest = F.dense_rank().over(W.orderBy(F.desc("cohort_month")))
    return (
        active.withColumn("age", latest)
        .where((F.col("age") <= cohorts) & (F.col("period_number") <= last_period))
        .join(signed, "cohort_month")
        .select(
            "cohort_month",
            "period_number",
            "signups",
            "active_customers",
            rounded(ratio("active_customers", "signups"), 3).alias("retention_rate"),
        )
    )


def milestone_means(rates: DataFrame) -> DataFrame:
    """Mean rates at months 1, 3 and 6 in percent and the drop from 1 to 3."""
    def mean(p: int):
        return F.avg(F.when(F.col("period_number") == p, F.col("retention_rate"))) * 100

    return rates.agg(
        rounded(mean(1), 1).alias("month_1"),
        rounded(mean(3), 1).alias("month_3"),
        rounded(mean(6), 1).alias("month_6"),
        rounded(mean(1) - mean(3), 1).alias("drop_1_to_3"),
    )


def winback_sizing(
    means: DataFrame,
    cost: float = 3.0,
    winback_rate: float = 0.15,
    conversion: float = 0.05,
    recovered_value: float = 50.0,
) -> DataFrame:
    """Customers lost by month one and what winning some of them back would bring."""
    lost = F.col("lost")
    return (
        means.agg(
            F.avg("month_1_retention").alias("m1"),
            F.avg("month_6_retention").alias("m6"),
            F.sum("cohort_size").alias("customers"),
        )
        .withColumn("lost", (100 - F.col("m1")) / 100 * F.col("customers"))
        .select(
            rounded("m1", 2).alias("month_1_mean"),
            rounded("m6", 2).alias("month_6_mean"),
            rounded(F.col("m1") - F.col("m6"), 2).alias("drop_1_to_6"),
            "customers",
            rounded(lost, 0).alias("customers_lost"),
            rounded(lost * conversion * recovered_value, 0).alias("conversion_value"),
            rounded(lost * cost, 0).alias("campaign_cost"),
            rounded(lost * winback_rate, 0).alias("customers_recovered"),
            rounded(lost * winback_rate * recovered_value, 0).alias("recovered_revenue"),
            rounded(lost * winback_rate * recovered_value - lost * cost, 0).alias("net_impact"),
        )
    )


def last_cohorts(rates: DataFrame, n: int = 6) -> DataFrame:
    """The rows of the latest ``n`` cohorts."""
    place = F.dense_rank().over(W.orderBy(F.desc("cohort_month")))
    return rates.withColumn("_place", place).where(F.col("_place") <= n).drop("_place")
