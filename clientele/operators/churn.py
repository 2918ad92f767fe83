"""Churn by tier, activity windows, churn labels and the rule-based churn score."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clientele.functions.numeric import clipped, first_match, fixed_bins, percent, ratio, rounded

RISK_LABELS = ("Low Risk", "Medium Risk", "High Risk")
RISK_EDGES = (0.0, 0.35, 0.6, 1.0)


def tier_churn(customers: DataFrame) -> DataFrame:
    """Size, churn rate, mean value and value at risk per tier, with its share."""
    per_tier = customers.groupBy("customer_tier").agg(
        F.count(F.lit(1)).alias("total_customers"),
        F.count_if("churned").alias("churned_customers"),
        F.count_if(~F.col("churned")).alias("active_customers"),
        F.sum("clv").alias("clv"),
        F.coalesce(F.sum(F.when(F.col("churned"), F.col("clv"))), F.lit(0)).alias("at_risk"),
    )
    return per_tier.select(
        "customer_tier",
        "total_customers",
        "churned_customers",
        "active_customers",
        percent("churned_customers", "total_customers").alias("churn_rate_pct"),
        rounded(ratio("clv", "total_customers"), 2).alias("avg_clv"),
        F.col("at_risk").cast("double").alias("clv_at_risk"),
        percent("at_risk", F.sum("at_risk").over(W.partitionBy())).alias(
            "pct_of_total_clv_at_risk"
        ),
    )


def behavioural_churn(
    customers: DataFrame, purchases: DataFrame, snapshot: Column, days: int = 90
) -> DataFrame:
    """Label every customer: no purchase in the ``days`` before the snapshot, or none at all."""
    activity = purchases.groupBy("customer_id").agg(
        F.max("order_date").alias("last_purchase_date"), F.count(F.lit(1)).alias("total_purchases")
    )
    last = F.col("last_purchase_date")
    return customers.join(activity, "customer_id", "left").select(
        "customer_id",
        F.coalesce("customer_tier", F.lit("Unknown")).alias("customer_tier"),
        last,
        F.coalesce("total_purchases", F.lit(0)).alias("total_purchases"),
        (last.isNull() | (last < F.date_sub(snapshot, days))).cast("int").alias("is_churned"),
    )


def behavioural_churn_by_tier(labelled: DataFrame) -> DataFrame:
    return (
        labelled.groupBy("customer_tier")
        .agg(
            F.count(F.lit(1)).alias("total_customers"),
            F.sum("is_churned").alias("churned_customers"),
            F.sum("total_purchases").alias("purchases"),
        )
        .select(
            "customer_tier",
            "total_customers",
            "churned_customers",
            (F.col("total_customers") - F.col("churned_customers")).alias("active_customers"),
            percent("churned_customers", "total_customers").alias("churn_rate_pct"),
            rounded(ratio("purchases", "total_customers"), 2).alias("avg_purchases"),
        )
    )


def last_purchase(purchases: DataFrame) -> DataFrame:
    return purchases.groupBy("customer_id").agg(F.max("order_date").alias("last_order_date"))


def recency_flags(last: DataFrame, windows: Sequence[int] = (30, 60, 90)) -> DataFrame:
    """Days since the last purchase and one flag per window, the limit day included.

    The snapshot is the latest last purchase; both sides read one aggregate, so
    the purchases are scanned and shuffled once.
    """
    snapshot = last.agg(F.max("last_order_date")).scalar()
    gap = F.datediff(snapshot, F.col("last_order_date"))
    return last.select(
        "*",
        snapshot.alias("snapshot_date"),
        gap.alias("days_since_purchase"),
        *[(gap <= n).cast("int").alias(f"active_{n}d") for n in windows],
    )


def active_users(flags: DataFrame, windows: Sequence[int] = (30, 60, 90)) -> DataFrame:
    """Customers active within each window, absolute and in percent."""
    sums = [F.sum(f"active_{n}d").alias(f"users_active_{n}d") for n in windows]
    shares = [
        percent(f"users_active_{n}d", "total_customers").alias(f"pct_active_{n}d") for n in windows
    ]
    return flags.agg(*sums, F.count(F.lit(1)).alias("total_customers")).select("*", *shares)


def active_users_distinct(flags: DataFrame, windows: Sequence[int] = (30, 60, 90)) -> DataFrame:
    """The same counts over rows that may repeat a customer.

    Customers are reduced to one row first, which turns the conditional
    distinct counts into plain ones.
    """
    gap = F.col("days_since_purchase")
    one_row = flags.groupBy("customer_id").agg(
        F.min("days_since_purchase").alias("days_since_purchase"),
        F.max("snapshot_date").alias("snapshot_date"),
    )
    counts = [F.count_if(gap <= n).alias(f"active_{n}d") for n in windows]
    shares = [percent(f"active_{n}d", "total_customers").alias(f"pct_active_{n}d") for n in windows]
    return one_row.agg(
        F.count(F.lit(1)).alias("total_customers"),
        *counts,
        F.max("snapshot_date").alias("reference_date"),
    ).select("*", *shares)


def rule_score(
    visits: Column,
    minutes: Column,
    responses: Column,
    spent: Column,
    months: Column,
    low_spend: float = 300.0,
    long_tenure: int = 36,
) -> Column:
    """Churn score from five rules, kept between 0.05 and 0.95, three digits.

    A missing measurement counts as no activity.
    """

    def share(c: Column, full: float) -> Column:
        return F.least(F.coalesce(c.cast("double"), F.lit(0.0)) / full, F.lit(1.0))

    def when(rule: Column) -> Column:
        return F.when(rule, F.lit(0.15)).otherwise(F.lit(0.0))

    score = (
        F.lit(0.3) * (1 - share(visits, 10.0))
        + F.lit(0.2) * (1 - share(minutes, 30.0))
        + F.lit(0.2) * (1 - share(responses, 5.0))
        + when(spent < low_spend)
        + when(months > long_tenure)
    )
    return rounded(clipped(score, 0.05, 0.95), 3)


def risk_level(probability: Column, medium: float = 0.35, high: float = 0.6) -> Column:
    """Level with inclusive lower limits."""
    return first_match([(probability >= high, "high"), (probability >= medium, "medium")], "low")


def risk_segment(probability: Column, edges: Sequence[float] = RISK_EDGES) -> Column:
    """Right-closed bins; a probability of exactly zero has no segment."""
    return fixed_bins(probability, edges, RISK_LABELS)


def add_rule_score(base: DataFrame) -> DataFrame:
    """Score the analytic base table: churn probability, level and risk segment."""
    scored = base.withColumn(
        "churn_prob",
        rule_score(
            F.col("weekly_visits"),
            F.col("session_time_minutes"),
            F.col("num_promotions_responded"),
            F.col("total_spent"),
            F.col("months_since_signup"),
        ),
    )
    return scored.withColumns(
        {
            "risk_level": risk_level(F.col("churn_prob")),
            "risk_segment": risk_segment(F.col("churn_prob")),
        }
    )
