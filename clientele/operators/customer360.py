"""The analytic base table and the tables read from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.functions.numeric import percent, ratio, rounded
from clientele.functions.ordering import Sample, percentiles
from clientele.sources.scratch import materialise

ENGAGEMENT = ("weekly_visits", "session_time_minutes", "page_views", "app_opens")


def joined_base(customers: DataFrame, engagement: DataFrame, promotions: DataFrame) -> DataFrame:
    """Customers with engagement and number of promotions answered.

    All three sides hold one row per customer, so no join can multiply or skew;
    the planner broadcasts a side only when its size allows.
    """
    answered = promotions.groupBy("customer_id").agg(
        F.sum("responded").alias("num_promotions_responded")
    )
    return (
        customers.join(engagement, "customer_id", "left")
        .join(answered, "customer_id", "left")
        .withColumn(
            "num_promotions_responded", F.coalesce("num_promotions_responded", F.lit(0))
        )
    )


def with_behaviour(customers: DataFrame, behaviour: DataFrame) -> DataFrame:
    """The same table where engagement and response come as one row per customer."""
    columns = behaviour.select(
        "customer_id", *ENGAGEMENT, F.col("responded").alias("num_promotions_responded")
    )
    return customers.join(columns, "customer_id", "left").withColumn(
        "num_promotions_responded",
        F.coalesce(F.col("num_promotions_responded").cast("long"), F.lit(0)),
    )


def analytic_base(joined: DataFrame, outlier_quantile: float = 0.99) -> DataFrame:
    """The joined table with medians for missing measurements and outlier flags.

    All four quantiles are found together.
    """
    base = materialise(joined)
    filled = ("session_time_minutes", "page_views")
    flags = {"total_spent": "high_spender", "weekly_visits": "high_engagement"}
    found = percentiles(
        base,
        [(Sample(F.col(c)), [0.5]) for c in filled]
        + [(Sample(F.col(c)), [outlier_quantile]) for c in flags],
    )
    edges = {c: edge for c, (edge,) in zip([*filled, *flags], found)}
    return base.withColumns(
        {
            **{c: F.coalesce(F.col(c).cast("double"), F.lit(edges[c])) for c in filled},
            **{
                flag: F.coalesce(F.col(c).cast("double") >= F.lit(edges[c]), F.lit(False))
                for c, flag in flags.items()
            },
        }
    )


def apply_filters(
    customers: DataFrame,
    tier: str | None = None,
    country: str | None = None,
    status: str | None = None,
) -> DataFrame:
    """Optional equality filters; a missing value or "All" leaves a column alone."""
    wanted: list[Column] = []
    if tier not in (None, "All"):
        wanted.append(F.col("customer_tier") == tier)
    if country not in (None, "All"):
        wanted.append(F.col("country") == country)
    if status == "Active":
        wanted.append(~F.col("churned"))
    elif status == "Churned":
        wanted.append(F.col("churned"))
    out = customers
    for condition in wanted:
        out = out.where(condition)
    return out


def within_dates(purchases: DataFrame, start: str, end: str) -> DataFrame:
    """Orders from ``start`` to ``end``, both days included."""
    day = F.col("order_date")
    return purchases.where(day.between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def fixed_sample(df: DataFrame, key: str, n: int) -> DataFrame:
    """``n`` rows picked by the hash of their key: the same rows on every run.

    The sampling operator itself; a top-n by hash, merged from per-task top-n.
    """
    return df.orderBy(F.md5(F.col(key).cast("string")), key).limit(n)


def tiers_of(base: DataFrame) -> list[str | None]:
    """The tiers that occur, null as one of them; a handful of names."""
    return [row[0] for row in base.select("customer_tier").distinct().orderBy("customer_tier").collect()]


def tier_statistics(base: DataFrame) -> DataFrame:
    """Mean, median, extremes and sums of three measures for every tier that occurs."""
    tiers = tiers_of(base)
    wanted = [(c, tier) for c in ("total_spent", "weekly_visits") for tier in tiers]
    found = percentiles(
        base, [(Sample(F.col(c), F.col("customer_tier").eqNullSafe(tier)), [0.5]) for c, tier in wanted]
    )
    medians = dict(zip(wanted, found))

    def median(column: str) -> Column:
        ladder = F.when(F.lit(False), F.lit(None).cast("double"))
        for tier in tiers:
            (value,) = medians[column, tier]
            ladder = ladder.when(F.col("customer_tier").eqNullSafe(tier), F.lit(value))
        return rounded(ladder, 2).alias(f"{column}_median")

    def mean(column: str) -> Column:
        return rounded(F.avg(F.col(column).cast("double")), 2).alias(f"{column}_mean")

    return (
        base.groupBy("customer_tier")
        .agg(
            mean("total_spent"),
            F.max("total_spent").cast("double").alias("total_spent_max"),
            F.min("total_spent").cast("double").alias("total_spent_min"),
            mean("weekly_visits"),
            F.max("weekly_visits").alias("weekly_visits_max"),
            mean("num_promotions_responded"),
            F.sum("num_promotions_responded").alias("num_promotions_responded_sum"),
        )
        .select("*", median("total_spent"), median("weekly_visits"))
    )


def country_value(customers: DataFrame, n: int = 10) -> DataFrame:
    """The countries with the highest mean lifetime value."""
    return (
        customers.groupBy("country")
        .agg(F.sum("clv").alias("clv"), F.count(F.lit(1)).alias("customers"))
        .select("country", rounded(ratio("clv", "customers"), 2).alias("avg_clv"), "customers")
        .orderBy(F.desc("avg_clv"), "country")
        .limit(n)
    )


def engagement_by_tier(base: DataFrame) -> DataFrame:
    """Mean engagement per tier, one row per measure and one column per tier that occurs."""
    means = materialise(
        base.groupBy("customer_tier").agg(
            *[rounded(F.avg(F.col(c).cast("double")), 1).alias(c) for c in ENGAGEMENT]
        )
    )
    return (
        means.unpivot("customer_tier", list(ENGAGEMENT), "metric", "value")
        .groupBy("metric")
        .pivot("customer_tier", tiers_of(means))
        .agg(F.first("value"))
    )


def executive_kpis(
    customers: DataFrame, purchases: DataFrame, promotions: DataFrame, high_value: float = 200.0
) -> DataFrame:
    """One row of headline figures; the two other tables come in as scalar subqueries."""
    sales = purchases.agg(
        F.struct(F.sum("order_amount").alias("amount"), F.count(F.lit(1)).alias("n"))
    ).scalar()
    campaigns = promotions.agg(
        F.struct(
            F.sum(F.when(F.col("responded") == 1, F.col("additional_revenue"))).alias("amount"),
            F.sum("responded").alias("responded"),
            F.count(F.lit(1)).alias("n"),
        )
    ).scalar()
    people = customers.agg(
        F.count(F.lit(1)).alias("total_customers"),
        F.sum("clv").alias("clv"),
        F.count_if("churned").alias("churned"),
        F.avg("next_purchase_prob").alias("prob"),
        F.count_if(F.col("clv") >= high_value).alias("high"),
    )
    total = F.col("total_customers")
    return people.select(
        "total_customers",
        rounded(ratio("clv", total), 2).alias("avg_clv"),
        percent("churned", total).alias("churn_rate_pct"),
        rounded(F.col("prob") * 100, 2).alias("avg_purchase_prob_pct"),
        sales.amount.cast("double").alias("total_revenue"),
        rounded(ratio(sales.amount, sales.n), 2).alias("avg_order_value"),
        percent("high", total).alias("high_value_pct"),
        percent(campaigns.responded, campaigns.n).alias("response_rate_pct"),
        F.coalesce(campaigns.amount, F.lit(0)).cast("double").alias("campaign_revenue"),
        rounded(ratio("churned", total) * F.col("clv").cast("double"), 0).alias("clv_at_risk"),
    )


def executive_summary(customers: DataFrame, high_value: float = 1000.0) -> DataFrame:
    """Customers, churn rate and number of high-value customers."""
    return customers.agg(
        F.count(F.lit(1)).alias("total_customers"),
        rounded(F.avg(F.col("churned").cast("int")), 4).alias("churn_rate"),
        F.count_if(F.col("clv") > high_value).alias("high_value_customers"),
    )


def high_value_at_risk(
    scored: DataFrame, probability: float = 0.6, value_quantile: float = 0.75, n: int = 20
) -> DataFrame:
    """The likeliest to churn among the customers in the top share by value."""
    ((edge,),) = percentiles(scored, [(Sample(F.col("clv")), [value_quantile])])
    return (
        scored.where(
            (F.col("churn_prob") >= probability) & (F.col("clv").cast("double") >= F.lit(edge))
        )
        .orderBy(F.desc("churn_prob"), F.desc("clv"), "customer_id")
        .limit(n)
        .select(
            "customer_id",
            "name",
            "customer_tier",
            F.col("clv").cast("double").alias("clv"),
            "churn_prob",
            "risk_segment",
        )
    )
