"""Revenue trends, spend profiles, category shares and top lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clientele.functions.calendar import month_of, months_between_starts
from clientele.functions.numeric import money_sum, percent, ratio, rounded

MARGIN = 0.30


def monthly_revenue(purchases: DataFrame) -> DataFrame:
    """Revenue, orders, buyers and mean order per month.

    An order is one ``order_id``, however many rows it has; the mean is over
    rows. Rows are summed per order, then per month and customer, so both are
    counted as rows instead of by a distinct aggregate.
    """
    month = month_of("order_date").alias("month")
    per_order = purchases.groupBy(month, "customer_id", "order_id").agg(
        money_sum("order_amount").alias("amount"), F.count(F.lit(1)).alias("rows")
    )
    per_buyer = per_order.groupBy("month", "customer_id").agg(
        F.sum("amount").alias("amount"),
        F.sum("rows").alias("rows"),
        F.count("order_id").alias("orders"),
    )
    return (
        per_buyer.groupBy("month")
        .agg(
            F.sum("amount").alias("amount"),
            F.sum("rows").alias("rows"),
            F.sum("orders").alias("total_orders"),
            F.count(F.lit(1)).alias("unique_buyers"),
        )
        .select(
            "month",
            F.col("amount").cast("double").alias("total_revenue"),
            "total_orders",
            "unique_buyers",
            rounded(ratio("amount", "rows"), 2).alias("avg_order_value"),
        )
    )


def monthly_totals(purchases: DataFrame) -> DataFrame:
    """Revenue, order rows and mean order per month; one shuffle of one row per month."""
    return (
        purchases.groupBy(month_of("order_date").alias("month"))
        .agg(money_sum("order_amount").alias("amount"), F.count(F.lit(1)).alias("orders"))
        .select(
            "month",
            F.col("amount").cast("double").alias("revenue"),
            "orders",
            rounded(ratio("amount", "orders"), 2).alias("avg_order"),
        )
    )


def month_over_month(monthly: DataFrame, value: str = "total_revenue") -> DataFrame:
    """The previous month's value and the change in percent. One row per month."""
    return (
        monthly.withColumn("prev_month_revenue", F.lag(value).over(W.orderBy("month")))
        .withColumn(
            "mom_growth_pct",
            percent(F.col(value) - F.col("prev_month_revenue"), "prev_month_revenue"),
        )
    )


def moving_average(series: DataFrame, order: str, value: str, width: int, output: str) -> DataFrame:
    """Mean over the last ``width`` rows of an already aggregated series."""
    frame = W.orderBy(order).rowsBetween(1 - width, 0)
    return series.withColumn(output, rounded(F.avg(value).over(frame), 4))


def extreme_rows(table: DataFrame, label: str, value: str) -> DataFrame:
    """The labels with the highest and the lowest value, and the mean of the values.

    Equal values: the smallest label.
    """
    key = F.struct(F.col(value), F.col(label))
    low = F.min(F.when(F.col(value).isNotNull(), key))
    top = table.agg(F.max(value)).scalar()
    return table.agg(
        F.min(F.when(F.col(value) == top, F.col(label))).alias("best"),
        F.max(value).alias("best_value"),
        low.getField(label).alias("worst"),
        low.getField(value).alias("worst_value"),
        rounded(F.avg(value), 4).alias("mean_value"),
    )


def customer_spend(purchases: DataFrame) -> DataFrame:
    """Spend, distinct orders, mean order row, first and last purchase per customer."""
    return (
        purchases.groupBy("customer_id", "order_id")
        .agg(
            money_sum("order_amount").alias("amount"),
            F.count(F.lit(1)).alias("rows"),
            F.min("order_date").alias("first_purchase"),
            F.max("order_date").alias("last_purchase"),
        )
        .groupBy("customer_id")
        .agg(
            F.sum("amount").alias("amount"),
            F.sum("rows").alias("rows"),
            F.count("order_id").alias("total_orders"),
            F.min("first_purchase").alias("first_purchase"),
            F.max("last_purchase").alias("last_purchase"),
        )
        .select(
            "customer_id",
            F.col("amount").cast("double").alias("total_spent"),
            "total_orders",
            rounded(ratio("amount", "rows"), 2).alias("avg_order_value"),
            "first_purchase",
            "last_purchase",
        )
    )


def categories_per_customer(category_orders: DataFrame) -> DataFrame:
    """Number of different categories each customer bought from."""
    return (
        category_orders.groupBy("customer_id", "product_category")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("customer_id")
        .agg(F.count("product_category").alias("categories_purchased"))
    )


def monthly_spend_rate(spent: Column | str, months: Column | str) -> Column:
    """Spend per month of tenure; null when the tenure is zero."""
    return rounded(ratio(spent, months), 2)


def top_spenders(spend: DataFrame, customers: DataFrame, n: int = 10) -> DataFrame:
    """The customers with the highest spend, with their profile; what ``spend`` has is not read again."""
    wanted = ("customer_tier", "age", "country", "churned", "months_since_signup")
    profile = customers.select("customer_id", *[c for c in wanted if c not in spend.columns])
    return (
        spend.join(profile, "customer_id")
        .withColumn("monthly_revenue_rate", monthly_spend_rate("total_spent", "months_since_signup"))
        .orderBy(F.desc("total_spent"), "customer_id")
        .limit(n)
    )


def year_value(spend: DataFrame, margin: float = MARGIN) -> DataFrame:
    """Twelve-month value: mean order x orders per active month x margin x 12."""
    active = F.greatest(months_between_starts("first_purchase", "last_purchase"), F.lit(1))
    return spend.withColumn(
        "clv_12m",
        rounded(
            F.col("total_spent")
            / F.col("total_orders")
            * (F.col("total_orders") / active.cast("double"))
            * margin
            * 12,
            2,
        ),
    )


def top_year_value(spend: DataFrame, customers: DataFrame, n: int = 10) -> DataFrame:
    """Top customers by twelve-month value, ranked; equal values share a rank.

    The list is cut before it is ranked: ranks of the first ``n`` rows depend
    on no later row.
    """
    profile = customers.select("customer_id", "name", "customer_tier", "country")
    top = (
        year_value(spend)
        .join(profile, "customer_id", "left")
        .orderBy(F.desc("clv_12m"), "customer_id")
        .limit(n)
    )
    return top.withColumn("clv_rank", F.rank().over(W.orderBy(F.desc("clv_12m"))).cast("long"))


def category_stats(category_orders: DataFrame) -> DataFrame:
    """Orders, buyers, revenue, mean, smallest and largest line per category.

    From one row per order and category to one per buyer and category to one
    per category: every distinct count is a count of rows.
    """
    per_buyer = category_orders.groupBy("product_category", "customer_id").agg(
        F.sum("amount").alias("amount"),
        F.sum("rows").alias("rows"),
        F.count(F.lit(1)).alias("orders"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
    )
    return (
        per_buyer.groupBy("product_category")
        .agg(
            F.sum("orders").alias("total_orders"),
            F.count(F.lit(1)).alias("unique_buyers"),
            F.sum("amount").alias("amount"),
            F.sum("rows").alias("rows"),
            F.min("low").cast("double").alias("min_order_value"),
            F.max("high").cast("double").alias("max_order_value"),
        )
        .select(
            "product_category",
            "total_orders",
            "unique_buyers",
            F.col("amount").cast("double").alias("total_revenue"),
            rounded(ratio("amount", "rows"), 2).alias("avg_order_value"),
            "min_order_value",
            "max_order_value",
        )
    )


def category_shares(stats: DataFrame) -> DataFrame:
    """Shares, running revenue and rank. One row per category, so one task suffices."""
    descending = W.orderBy(F.desc("total_revenue"), "product_category")
    everything = W.partitionBy()
    money = F.col("total_revenue").cast("decimal(28,2)")
    return stats.select(
        "*",
        percent("total_revenue", F.sum("total_revenue").over(everything)).alias(
            "revenue_share_pct"
        ),
        percent("total_orders", F.sum("total_orders").over(everything)).alias("order_share_pct"),
        F.sum(money)
        .over(descending.rowsBetween(W.unboundedPreceding, 0))
        .cast("double")
        .alias("cumulative_revenue"),
        F.rank().over(W.orderBy(F.desc("total_revenue"))).cast("long").alias("revenue_rank"),
    )


def leading_categories(shares: DataFrame, share: float = 0.80) -> DataFrame:
    """Categories, largest first, until the given share of revenue is reached."""
    total = F.sum("total_revenue").over(W.partitionBy())
    before = F.col("cumulative_revenue") - F.col("total_revenue")
    return (
        shares.withColumn("before_pct", percent(before, total))
        .withColumn("cumulative_pct", percent("cumulative_revenue", total))
        .where(F.col("before_pct") < share * 100)
        .select(
            "product_category", "total_revenue", "cumulative_revenue", "cumulative_pct"
        )
    )


def category_rollup(totals: DataFrame) -> DataFrame:
    """Revenue and lines per category with a grand-total row."""
    return (
        totals.rollup("product_category")
        .agg(
            F.sum("amount").cast("double").alias("total_revenue"),
            F.sum("rows").alias("line_count"),
            F.grouping_id().cast("int").alias("is_total"),
        )
        .withColumn(
            "product_category",
            F.when(F.col("is_total") == 1, F.lit("GRAND TOTAL")).otherwise(
                F.col("product_category")
            ),
        )
    )


def revenue_by(totals: DataFrame, key: str) -> DataFrame:
    """Revenue, lines and mean line by one column of already summed lines."""
    return (
        totals.groupBy(key)
        .agg(F.sum("amount").alias("amount"), F.sum("rows").alias("orders"))
        .select(
            key,
            F.col("amount").cast("double").alias("revenue"),
            "orders",
            rounded(ratio("amount", "orders"), 2).alias("avg_order"),
        )
    )


def top_category_trend(category_orders: DataFrame, n: int = 3) -> DataFrame:
    """Monthly revenue of the ``n`` categories with the highest revenue.

    Summed to month and category first; the top categories are picked from and
    joined to that small table, so the lines are read once.
    """
    by_month = category_orders.groupBy(
        month_of("order_date").alias("month"), "product_category"
    ).agg(F.sum("amount").cast("double").alias("revenue"))
    totals = F.sum(F.col("revenue").cast("decimal(28,2)")).over(W.partitionBy("product_category"))
    place = F.dense_rank().over(W.orderBy(F.desc("_total"), "product_category"))
    return (
        by_month.withColumn("_total", totals)
        .withColumn("_place", place)
        .where(F.col("_place") <= n)
        .drop("_total", "_place")
    )


def value_counts(df: DataFrame, key: str) -> DataFrame:
    """Rows per value and their share of all rows, in percent."""
    return (
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("share_pct", percent("n", F.sum("n").over(W.partitionBy())))
    )


def correlations(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    """Pearson correlation of every pair, in long form, from one aggregate."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    cells = [
        F.struct(
            F.lit(a).alias("left_column"),
            F.lit(b).alias("right_column"),
            rounded(F.corr(F.col(a).cast("double"), F.col(b).cast("double")), digits).alias(
                "correlation"
            ),
        )
        for a, b in pairs
    ]
    return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def histogram(
    df: DataFrame, value: str, low: float, high: float, bins: int, by: Sequence[str] = ()
) -> DataFrame:
    """Rows per equal-width bin between fixed bounds; the top edge falls in the last bin."""
    place = (F.col(value).cast("double") - low) * bins / float(high - low)
    bin_no = F.least(F.floor(place) + 1, F.lit(bins))
    return (
        df.where(F.col(value).isNotNull())
        .groupBy(*by, bin_no.cast("long").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def purchase_overview(purchases: DataFrame) -> DataFrame:
    """First and last day, buyers, orders and revenue.

    Reduced per customer first; the last step adds one row per customer.
    """
    per_customer = purchases.groupBy("customer_id").agg(
        F.min("order_date").alias("first"),
        F.max("order_date").alias("last"),
        F.count(F.lit(1)).alias("orders"),
        money_sum("order_amount").alias("amount"),
    )
    return per_customer.agg(
        F.min("first").alias("first_date"),
        F.max("last").alias("last_date"),
        F.count("customer_id").alias("customers"),
        F.sum("orders").alias("orders"),
        F.sum("amount").cast("double").alias("total_revenue"),
    )


def quality_counts(
    df: DataFrame, keys: Sequence[str], dates: Sequence[str], amounts: Sequence[str]
) -> DataFrame:
    """Null keys and dates, null and negative amounts, in one pass."""
    checks = [F.count(F.lit(1)).alias("rows")]
    checks += [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in (*keys, *dates, *amounts)]
    checks += [F.count_if(F.col(c) < 0).alias(f"negative_{c}") for c in amounts]
    return df.agg(*checks)
