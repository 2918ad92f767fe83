"""Revenue, category and top-list queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from clientele.functions.numeric import rounded
from clientele.operators import descriptive, revenue
from clientele.plans.reference_sql import d, define, r, with_tables
from clientele.plans.registry import query
from clientele.sources.adapter import CHURN_DAYS
from clientele.sources.scratch import materialise

define(
    "monthly",
    "purchases",
    f"""
    SELECT CAST(date_trunc('month', order_date) AS DATE) AS month,
           {d('sum(order_amount)')} AS total_revenue, count(DISTINCT order_id) AS total_orders,
           count(DISTINCT customer_id) AS unique_buyers,
           {r(f"{d('sum(order_amount)')} / count(*)", 2)} AS avg_order_value
    FROM purchases GROUP BY 1""",
)
define(
    "monthly_growth",
    "monthly",
    f"""
    SELECT *, lag(total_revenue) OVER (ORDER BY month) AS prev_month_revenue,
           {r('''(total_revenue - lag(total_revenue) OVER (ORDER BY month))
              / nullif(lag(total_revenue) OVER (ORDER BY month), 0) * 100''', 2)}
              AS mom_growth_pct
    FROM monthly""",
)
define(
    "buyer_spend",
    "purchases",
    f"""
    SELECT customer_id, {d('sum(order_amount)')} AS total_spent, count(DISTINCT order_id) AS total_orders,
           {r(f"{d('sum(order_amount)')} / count(*)", 2)} AS avg_order_value,
           min(order_date) AS first_purchase, max(order_date) AS last_purchase
    FROM purchases GROUP BY customer_id""",
)
define(
    "category_stats",
    "lines",
    f"""
    SELECT product_category, count(DISTINCT order_id) AS total_orders,
           count(DISTINCT customer_id) AS unique_buyers,
           {d('sum(order_amount)')} AS total_revenue,
           {r(f"{d('sum(order_amount)')} / count(*)", 2)} AS avg_order_value,
           {d('min(order_amount)')} AS min_order_value,
           {d('max(order_amount)')} AS max_order_value
    FROM lines GROUP BY product_category""",
)
define(
    "category_shares",
    "category_stats",
    f"""
    SELECT *, {r('total_revenue / sum(total_revenue) OVER () * 100', 2)} AS revenue_share_pct,
           {r(d('total_orders') + ' / sum(total_orders) OVER () * 100', 2)} AS order_share_pct,
           {d('''sum(CAST(total_revenue AS DECIMAL(28,2))) OVER (
                ORDER BY total_revenue DESC, product_category
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)''')} AS cumulative_revenue,
           rank() OVER (ORDER BY total_revenue DESC) AS revenue_rank
    FROM category_stats""",
)


@query("A1_monthly_revenue", with_tables("monthly", "SELECT * FROM monthly"))
def _(t):
    return revenue.monthly_revenue(t.purchases)


@query("W1_month_over_month", with_tables("monthly_growth", "SELECT * FROM monthly_growth"))
def _(t):
    return revenue.month_over_month(revenue.monthly_revenue(t.purchases))


@query(
    "W7_three_month_average",
    with_tables(
        "monthly",
        f"""SELECT month, total_revenue AS revenue, total_orders AS orders,
            avg_order_value AS avg_order,
            {r('''avg(total_revenue) OVER (ORDER BY month
                  ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)''', 4)} AS ma3
            FROM monthly""",
    ),
)
def _(t):
    return revenue.moving_average(
        revenue.monthly_totals(t.purchases), "month", "revenue", 3, "ma3"
    )


@query(
    "L4_best_and_worst_month",
    with_tables(
        "monthly_growth",
        f"""SELECT (SELECT strftime(min(month), '%Y-%m') FROM monthly_growth WHERE total_revenue =
                     (SELECT max(total_revenue) FROM monthly_growth)) AS best,
            max(total_revenue) AS best_value,
            (SELECT strftime(min(month), '%Y-%m') FROM monthly_growth WHERE total_revenue =
                     (SELECT min(total_revenue) FROM monthly_growth)) AS worst,
            min(total_revenue) AS worst_value,
            {r('avg(total_revenue)', 2)} AS mean_value FROM monthly_growth""",
    ),
)
def _(t):
    monthly = revenue.monthly_totals(t.purchases)
    found = revenue.extreme_rows(
        monthly.select(F.date_format("month", "yyyy-MM").alias("month"), "revenue"),
        "month",
        "revenue",
    )
    return found.withColumn("mean_value", rounded("mean_value", 2))


@query("A2_customer_spend", with_tables("buyer_spend", "SELECT * FROM buyer_spend"))
def _(t):
    return revenue.customer_spend(t.purchases)


@query(
    "A2_categories_per_customer",
    with_tables(
        "lines",
        """SELECT customer_id, count(DISTINCT product_category) AS categories_purchased
           FROM lines GROUP BY customer_id""",
    ),
)
def _(t):
    return revenue.categories_per_customer(t.category_orders)


@query(
    "A3_spend_per_tenure_month",
    with_tables(
        "customers",
        f"""SELECT customer_id, months_since_signup,
            {r(d('total_spent') + ' / nullif(months_since_signup, 0)', 2)}
            AS monthly_revenue_rate FROM customers""",
    ),
)
def _(t):
    return t.customers.select(
        "customer_id",
        "months_since_signup",
        revenue.monthly_spend_rate("total_spent", "months_since_signup").alias(
            "monthly_revenue_rate"
        ),
    )


_TOP_SPENDERS = with_tables(
    "buyer_spend customers",
    f"""SELECT s.*, c.customer_tier, c.age, c.country, c.churned, c.months_since_signup,
        {r('s.total_spent / nullif(c.months_since_signup, 0)', 2)} AS monthly_revenue_rate
        FROM buyer_spend s JOIN customers c USING (customer_id)
        ORDER BY s.total_spent DESC, s.customer_id LIMIT 10""",
)


@query("L1_top_spenders", _TOP_SPENDERS)
def _(t):
    # a buyer's last order is in the spend; the profile needs no orders
    spend = revenue.customer_spend(t.purchases)
    gone = F.col("last_purchase") < F.date_sub(t.snapshot(), CHURN_DAYS)
    return revenue.top_spenders(spend.withColumn("churned", gone), t.demographics)


@query(
    "J1_spend_with_profile",
    with_tables(
        "buyer_spend customers",
        """SELECT customer_id, s.total_spent, c.customer_tier, c.country
           FROM buyer_spend s JOIN customers c USING (customer_id)""",
    ),
)
def _(t):
    spend = revenue.customer_spend(t.purchases).select("customer_id", "total_spent")
    profile = t.demographics.select("customer_id", "customer_tier", "country")
    return spend.join(profile, "customer_id", "inner")


define(
    "year_value",
    "buyer_spend customers",
    f"""
    SELECT s.*, c.name, c.customer_tier, c.country,
           {r('''s.total_spent / s.total_orders * (s.total_orders / CAST(greatest(1,
              (year(last_purchase) * 12 + month(last_purchase))
              - (year(first_purchase) * 12 + month(first_purchase))) AS DOUBLE)) * 0.3::DOUBLE * 12''', 2)}
              AS clv_12m
    FROM buyer_spend s LEFT JOIN customers c USING (customer_id)""",
)
define(
    "top_value",
    "year_value",
    """
    SELECT *, rank() OVER (ORDER BY clv_12m DESC) AS clv_rank FROM year_value
    ORDER BY clv_12m DESC, customer_id LIMIT 10""",
)


@query("L2_top_year_value", with_tables("top_value", "SELECT * FROM top_value"))
def _(t):
    return revenue.top_year_value(revenue.customer_spend(t.purchases), t.demographics)


@query(
    "W4_value_rank",
    with_tables("top_value", "SELECT customer_id, clv_12m, clv_rank FROM top_value"),
)
def _(t):
    top = revenue.top_year_value(revenue.customer_spend(t.purchases), t.demographics)
    return top.select("customer_id", "clv_12m", "clv_rank")


@query(
    "L2_monthly_rate_proxy",
    with_tables(
        "buyer_spend customers",
        f"""SELECT customer_id,
            {r('s.total_spent / nullif(c.months_since_signup, 0) * 12', 2)} AS clv_12m,
            {r(d('s.total_orders') + ' / nullif(c.months_since_signup, 0)', 4)}
            AS purchase_frequency
            FROM buyer_spend s JOIN customers c USING (customer_id)
            ORDER BY clv_12m DESC NULLS LAST, customer_id LIMIT 10""",
    ),
)
def _(t):
    spend = revenue.customer_spend(t.purchases)
    tenure = t.demographics.select("customer_id", "months_since_signup")
    months = F.nullif(F.col("months_since_signup"), F.lit(0))
    return (
        spend.join(tenure, "customer_id")
        .select(
            "customer_id",
            rounded(F.col("total_spent") / months * 12, 2).alias("clv_12m"),
            rounded(F.col("total_orders") / months, 4).alias("purchase_frequency"),
        )
        .orderBy(F.desc_nulls_last("clv_12m"), "customer_id")
        .limit(10)
    )


@query(
    "A31_top_list_totals",
    with_tables(
        "top_value customers",
        f"""SELECT {d('count(*)')} AS listed, max(clv_12m) AS best_clv,
            {r('sum(clv_12m)', 2)} AS combined_clv, {r('sum(total_spent)', 2)} AS combined_spent,
            (SELECT {r(f"0.3::DOUBLE * {d('sum(clv)')} / count(*)", 2)} FROM customers
             WHERE customer_tier = 'Silver') AS silver_upsell,
            (SELECT {r('avg(x)', 4)} FROM (SELECT count(*) FILTER (churned) * 100.0::DOUBLE / count(*) AS x
             FROM customers GROUP BY customer_tier)) AS mean_tier_churn_pct
            FROM top_value""",
    ),
)
def _(t):
    top = revenue.top_year_value(revenue.customer_spend(t.purchases), t.demographics)
    tiers = (
        t.customers.groupBy("customer_tier")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if("churned").alias("churned"),
            F.sum("clv").alias("clv"),
        )
        .agg(
            rounded(
                F.sum(F.when(F.col("customer_tier") == "Silver", F.col("clv"))).cast("double")
                * 0.3
                / F.sum(F.when(F.col("customer_tier") == "Silver", F.col("n"))),
                2,
            ).alias("silver_upsell"),
            rounded(F.avg(F.col("churned") * F.lit(100.0) / F.col("n")), 4).alias(
                "mean_tier_churn_pct"
            ),
        )
        .select(F.struct("silver_upsell", "mean_tier_churn_pct"))
        .scalar()
    )
    return top.agg(
        F.count(F.lit(1)).cast("double").alias("listed"),
        F.max("clv_12m").alias("best_clv"),
        rounded(F.sum("clv_12m"), 2).alias("combined_clv"),
        rounded(F.sum("total_spent"), 2).alias("combined_spent"),
    ).select("*", tiers.silver_upsell.alias("silver_upsell"), tiers.mean_tier_churn_pct.alias("mean_tier_churn_pct"))


@query("A7_category_stats", with_tables("category_stats", "SELECT * FROM category_stats"))
def _(t):
    return revenue.category_stats(t.category_orders)


@query(
    "W3_category_running_total",
    with_tables("category_shares", "SELECT * FROM category_shares"),
)
def _(t):
    return revenue.category_shares(revenue.category_stats(t.category_orders))


@query(
    "W2_category_share",
    with_tables(
        "category_shares",
        "SELECT product_category, revenue_share_pct, order_share_pct FROM category_shares",
    ),
)
def _(t):
    shares = revenue.category_shares(revenue.category_stats(t.category_orders))
    return shares.select("product_category", "revenue_share_pct", "order_share_pct")


@query(
    "W14_leading_categories",
    with_tables(
        "category_shares",
        f"""SELECT product_category, total_revenue, cumulative_revenue,
            {r('cumulative_revenue / total * 100', 2)} AS cumulative_pct
            FROM (SELECT *, sum(total_revenue) OVER () AS total FROM category_shares)
            WHERE {r('(cumulative_revenue - total_revenue) / total * 100', 2)} < 80""",
    ),
)
def _(t):
    return revenue.leading_categories(revenue.category_shares(revenue.category_stats(t.category_orders)))


@query(
    "A10_category_rollup",
    with_tables(
        "lines",
        f"""SELECT CASE WHEN grouping(product_category) = 1 THEN 'GRAND TOTAL'
            ELSE product_category END AS product_category,
            {d('sum(order_amount)')} AS total_revenue, count(*) AS line_count,
            CAST(grouping(product_category) AS INTEGER) AS is_total
            FROM lines GROUP BY ROLLUP (product_category)""",
    ),
)
def _(t):
    return revenue.category_rollup(t.item_totals)


def _revenue_by(key: str) -> str:
    return with_tables(
        "lines",
        f"""SELECT {key}, {d('sum(order_amount)')} AS revenue, count(*) AS orders,
            {r(f"{d('sum(order_amount)')} / count(*)", 2)} AS avg_order
            FROM lines GROUP BY {key}""",
    )


@query("A18_revenue_by_category", _revenue_by("product_category"))
def _(t):
    return revenue.revenue_by(t.item_totals, "product_category").orderBy(
        F.desc("revenue"), "product_category"
    )


@query("A20_discount_impact", _revenue_by("discount_used"))
def _(t):
    return revenue.revenue_by(t.item_totals, "discount_used")


define(
    "top3",
    "lines",
    """
    SELECT product_category FROM lines GROUP BY 1
    ORDER BY sum(order_amount) DESC, product_category LIMIT 3""",
)


@query(
    "A19_top_category_trend",
    with_tables(
        "lines top3",
        f"""SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, product_category,
            {d('sum(order_amount)')} AS revenue FROM lines
            WHERE product_category IN (SELECT product_category FROM top3) GROUP BY 1, 2""",
    ),
)
def _(t):
    return revenue.top_category_trend(t.category_orders)


@query(
    "P6_lines_of_top_categories",
    with_tables(
        "lines top3",
        """SELECT product_category, discount_used, count(*) AS n FROM lines
           WHERE product_category IN (SELECT product_category FROM top3) GROUP BY 1, 2""",
    ),
)
def _(t):
    top = (
        revenue.revenue_by(t.item_totals, "product_category")
        .orderBy(F.desc("revenue"), "product_category")
        .limit(3)
        .select("product_category")
    )
    kept = t.item_totals.join(F.broadcast(top), "product_category", "left_semi")
    return kept.groupBy("product_category", "discount_used").agg(F.sum("rows").alias("n"))


@query(
    "A12_tier_counts",
    with_tables(
        "customers",
        f"""SELECT customer_tier, count(*) AS n,
            {r(f"{d('count(*)')} / sum(count(*)) OVER () * 100", 2)} AS share_pct
            FROM customers GROUP BY 1""",
    ),
)
def _(t):
    return revenue.value_counts(t.demographics, "customer_tier")


_CORRELATED = ("age", "months_since_signup", "clv", "total_orders")


@query(
    "A14_correlations",
    with_tables(
        "customers",
        " UNION ALL ".join(
            f"""SELECT '{a}' AS left_column, '{b}' AS right_column,
                {r(f"corr({d(a)}, {d(b)})", 6)} AS correlation FROM customers"""
            for i, a in enumerate(_CORRELATED)
            for b in _CORRELATED[i:]
        ),
    ),
)
def _(t):
    return revenue.correlations(t.customers, _CORRELATED)


@query(
    "A15_age_histogram",
    with_tables(
        "customers",
        """SELECT churned, CAST(least(floor((age - 18) * 30 / 62.0) + 1, 30) AS BIGINT) AS bin,
           count(*) AS n FROM customers GROUP BY 1, 2""",
    ),
)
def _(t):
    return revenue.histogram(t.customers, "age", 18, 80, 30, by=["churned"])


@query(
    "S7_purchase_overview",
    with_tables(
        "purchases",
        f"""SELECT min(order_date) AS first_date, max(order_date) AS last_date,
            count(DISTINCT customer_id) AS customers, count(*) AS orders,
            {d('sum(order_amount)')} AS total_revenue FROM purchases""",
    ),
)
def _(t):
    return revenue.purchase_overview(t.purchases)


@query(
    "S5_purchase_quality",
    with_tables(
        "purchases",
        """SELECT count(*) AS rows, count(*) FILTER (customer_id IS NULL) AS null_customer_id,
           count(*) FILTER (order_date IS NULL) AS null_order_date,
           count(*) FILTER (order_amount IS NULL) AS null_order_amount,
           count(*) FILTER (order_amount < 0) AS negative_order_amount FROM purchases""",
    ),
)
def _(t):
    return revenue.quality_counts(
        t.purchases, ["customer_id"], ["order_date"], ["order_amount"]
    )


def _describe_sql(table: str, column: str) -> str:
    x = d(column)
    return f"""SELECT '{column}' AS column_name, count({column}) AS n, {r(f'avg({x})', 4)} AS mean,
        {r(f'stddev_samp({x})', 4)} AS std, min({x}) AS min,
        {r(f'quantile_cont({x}, 0.25)', 4)} AS p25, {r(f'quantile_cont({x}, 0.5)', 4)} AS p50,
        {r(f'quantile_cont({x}, 0.75)', 4)} AS p75, max({x}) AS max FROM {table}"""


@query(
    "S8_describe_spend",
    with_tables(
        "customers",
        " UNION ALL ".join(
            _describe_sql("customers", c) for c in ("age", "clv", "total_spent", "total_orders")
        ),
    ),
)
def _(t):
    columns = ["age", "clv", "total_spent", "total_orders"]
    return descriptive.describe(materialise(t.customers.select(*columns)), columns)


@query(
    "A28_top_decile_share",
    with_tables(
        "buyer_spend",
        f"""SELECT count(*) AS top_rows, {r('sum(total_spent) / max(whole) * 100', 4)} AS top_share_pct
            FROM (SELECT total_spent, row_number() OVER (ORDER BY total_spent DESC, customer_id DESC)
                  AS place, count(*) OVER () AS size, sum(total_spent) OVER () AS whole
                  FROM buyer_spend) WHERE place <= floor(size * 0.1)""",
    ),
)
def _(t):
    spend = materialise(
        revenue.customer_spend(t.purchases).select("customer_id", "total_spent")
    )
    return descriptive.top_share_of_total(spend, "total_spent", "customer_id")


@query(
    "W15_spend_clipped_at_p99",
    with_tables(
        "buyer_spend",
        f"""SELECT customer_id, {r('''least(total_spent, (SELECT quantile_cont(total_spent, 0.99)
            FROM buyer_spend))''', 4)} AS clipped FROM buyer_spend""",
    ),
)
def _(t):
    spend = materialise(
        revenue.customer_spend(t.purchases).select("customer_id", "total_spent")
    )
    clipped = descriptive.clip_at_quantile(spend, "total_spent", 0.99, "clipped")
    return clipped.select("customer_id", rounded("clipped", 4).alias("clipped"))
