"""Campaign response, return and response by tier."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clientele.functions.numeric import percent, ratio, rounded


def campaign_stats(promotions: DataFrame) -> DataFrame:
    """Exposure, conversion and revenue per campaign and discount, with both ranks."""
    responder = F.col("responded") == 1
    stats = (
        promotions.groupBy("campaign_name", "discount")
        .agg(
            F.count(F.lit(1)).alias("total_exposed"),
            F.count_if(responder).alias("total_responded"),
            F.sum("additional_revenue").alias("amount"),
            F.sum(F.when(responder, F.col("additional_revenue"))).alias("responder_amount"),
        )
        .select(
            "campaign_name",
            "discount",
            "total_exposed",
            "total_responded",
            percent("total_responded", "total_exposed").alias("conversion_rate_pct"),
            F.col("amount").cast("double").alias("total_additional_revenue"),
            rounded(ratio("responder_amount", "total_responded"), 2).alias(
                "avg_revenue_per_respondent"
            ),
            rounded(ratio("amount", "total_responded"), 2).alias("revenue_per_conversion"),
        )
    )
    return stats.withColumns(
        {
            "revenue_rank": F.rank()
            .over(W.orderBy(F.desc("total_additional_revenue")))
            .cast("long"),
            "conversion_rank": F.rank()
            .over(W.orderBy(F.desc("conversion_rate_pct")))
            .cast("long"),
        }
    )


def campaign_roi(promotions: DataFrame) -> DataFrame:
    """Spend, revenue, net and return per campaign; campaigns without spend are left out.

    A customer's spend is the discount granted on the revenue the customer brought.
    """
    granted = (F.col("additional_revenue") * F.col("discount").cast("decimal(4,2)")).cast(
        "decimal(18,4)"
    )
    return (
        promotions.groupBy("campaign_name")
        .agg(
            F.count(F.lit(1)).alias("customers_targeted"),
            F.sum(granted).alias("granted"),
            F.sum("additional_revenue").alias("amount"),
        )
        .where(F.col("granted") > 0)
        .select(
            "campaign_name",
            "customers_targeted",
            rounded("granted", 2).alias("spend"),
            F.col("amount").cast("double").alias("revenue"),
            rounded(F.col("amount") - F.col("granted"), 2).alias("net_profit"),
            percent(F.col("amount") - F.col("granted"), "granted").alias("roi_pct"),
            rounded(ratio("amount", "customers_targeted"), 2).alias("revenue_per_customer"),
        )
    )


def campaign_fraction_roi(stats: DataFrame) -> DataFrame:
    """Return per campaign and discount with the discount fraction standing in for spend."""
    net = F.col("total_additional_revenue") - F.col("discount")
    return stats.select(
        "campaign_name",
        F.lit("All").alias("channel"),
        F.col("discount").alias("spend"),
        F.col("total_additional_revenue").alias("revenue"),
        rounded(net, 2).alias("net_profit"),
        rounded(ratio(net, "discount") * 100, 2).alias("roi_pct"),
    )


def campaign_performance(promotions: DataFrame) -> DataFrame:
    """Response rate in percent, revenue and customers targeted per campaign."""
    return (
        promotions.groupBy("campaign_name")
        .agg(
            F.sum("responded").alias("responded"),
            F.sum("additional_revenue").cast("double").alias("total_revenue"),
            F.count(F.lit(1)).alias("n_targeted"),
        )
        .select(
            "campaign_name",
            percent("responded", "n_targeted", 4).alias("response_rate"),
            "total_revenue",
            "n_targeted",
        )
    )


def response_by_tier(promotions: DataFrame, customers: DataFrame) -> DataFrame:
    """Response rate per tier; promotions hold one row per customer."""
    return (
        promotions.select("customer_id", "responded")
        .join(customers.select("customer_id", "customer_tier"), "customer_id", "left")
        .groupBy("customer_tier")
        .agg(F.sum("responded").alias("responded"), F.count(F.lit(1)).alias("n"))
        .select("customer_tier", "n", rounded(ratio("responded", "n"), 4).alias("response_rate"))
    )
