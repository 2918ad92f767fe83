"""Churn, activity, campaign, filter, join and base-table queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from clientele.functions.numeric import clipped
from clientele.operators import campaign, churn, customer360, descriptive, revenue
from clientele.plans.reference_sql import d, define, r, with_tables
from clientele.plans.registry import query
from clientele.sources.adapter import Tables
from clientele.sources.scratch import materialise


def joined(t: Tables):
    return customer360.with_behaviour(t.customers, t.behaviour)


def scored(t: Tables):
    return churn.add_rule_score(joined(t))


define(
    "base",
    "customers engagement promotions",
    """
    SELECT c.*, e.weekly_visits, e.session_time_minutes, e.page_views, e.app_opens,
           coalesce(p.responded, 0) AS num_promotions_responded
    FROM customers c
    LEFT JOIN engagement e USING (customer_id)
    LEFT JOIN promotions p USING (customer_id)""",
)
define(
    "scored",
    "base",
    f"""
    SELECT *, CASE WHEN churn_prob >= 0.6 THEN 'high' WHEN churn_prob >= 0.35 THEN 'medium'
                   ELSE 'low' END AS risk_level,
           CASE WHEN churn_prob <= 0 OR churn_prob > 1 THEN NULL
                WHEN churn_prob <= 0.35 THEN 'Low Risk' WHEN churn_prob <= 0.6 THEN 'Medium Risk'
                ELSE 'High Risk' END AS risk_segment
    FROM (SELECT *, {r('''greatest(least(
            0.3::DOUBLE * (1 - least(coalesce(weekly_visits, 0) / 10.0::DOUBLE, 1))
            + 0.2::DOUBLE * (1 - least(coalesce(session_time_minutes, 0) / 30.0::DOUBLE, 1))
            + 0.2::DOUBLE * (1 - least(num_promotions_responded / 5.0::DOUBLE, 1))
            + CASE WHEN total_spent < 300 THEN 0.15::DOUBLE ELSE 0 END
            + CASE WHEN months_since_signup > 36 THEN 0.15::DOUBLE ELSE 0 END,
            0.95::DOUBLE), 0.05::DOUBLE)''', 3)} AS churn_prob FROM base)""",
)
define(
    "last_order",
    "purchases",
    "SELECT customer_id, max(order_date) AS last_order_date FROM purchases GROUP BY 1",
)
define(
    "flags",
    "last_order",
    """
    SELECT *, (SELECT max(last_order_date) FROM last_order) AS snapshot_date,
           CAST((SELECT max(last_order_date) FROM last_order) - last_order_date AS INTEGER)
               AS days_since_purchase
    FROM last_order""",
)


@query(
    "A4_tier_churn",
    with_tables(
        "customers",
        f"""SELECT customer_tier, count(*) AS total_customers,
            count(*) FILTER (churned) AS churned_customers,
            count(*) FILTER (NOT churned) AS active_customers,
            {r(f"{d('count(*) FILTER (churned)')} / count(*) * 100", 2)} AS churn_rate_pct,
            {r(f"{d('sum(clv)')} / count(*)", 2)} AS avg_clv,
            {d('coalesce(sum(clv) FILTER (churned), 0)')} AS clv_at_risk,
            {r(f"{d('sum(clv) FILTER (churned)')} / sum(sum(clv) FILTER (churned)) OVER () * 100", 2)}
            AS pct_of_total_clv_at_risk FROM customers GROUP BY customer_tier""",
    ),
)
def _(t):
    return churn.tier_churn(t.customers)


_LABELLED = """SELECT c.customer_id, c.customer_tier, max(p.order_date) AS last_purchase_date,
    count(p.order_id) AS total_purchases,
    CAST(max(p.order_date) IS NULL OR max(p.order_date) < (SELECT day FROM snapshot) - 90
         AS INTEGER) AS is_churned
    FROM customers c LEFT JOIN purchases p USING (customer_id) GROUP BY 1, 2"""
define("labelled", "customers purchases snapshot", _LABELLED)


@query("M26_behavioural_churn_label", with_tables("labelled", "SELECT * FROM labelled"))
def _(t):
    return churn.behavioural_churn(
        t.demographics.select("customer_id", "customer_tier"), t.purchases, t.snapshot()
    )


@query(
    "J7_churn_with_inactive_customers",
    with_tables(
        "labelled",
        f"""SELECT customer_tier, count(*) AS total_customers,
            CAST(sum(is_churned) AS BIGINT) AS churned_customers,
            CAST(count(*) - sum(is_churned) AS BIGINT) AS active_customers,
            {r(f"{d('sum(is_churned)')} / count(*) * 100", 2)} AS churn_rate_pct,
            {r(f"{d('sum(total_purchases)')} / count(*)", 2)} AS avg_purchases
            FROM labelled GROUP BY 1""",
    ),
)
def _(t):
    return churn.behavioural_churn_by_tier(
        churn.behavioural_churn(
            t.demographics.select("customer_id", "customer_tier"), t.purchases, t.snapshot()
        )
    )


def _active_sql(prefix: str, tail: str) -> str:
    counts = ", ".join(
        f"count(*) FILTER (days_since_purchase <= {k}) AS {prefix}active_{k}d, "
        + r(f"{d(f'count(*) FILTER (days_since_purchase <= {k})')} / count(*) * 100", 2)
        + f" AS pct_active_{k}d"
        for k in (30, 60, 90)
    )
    return with_tables("flags", f"SELECT count(*) AS total_customers, {counts}{tail} FROM flags")


@query("A8_active_users", _active_sql("users_", ""))
def _(t):
    return churn.active_users(churn.recency_flags(churn.last_purchase(t.purchases)))


@query("A9_active_users_distinct", _active_sql("", ", max(snapshot_date) AS reference_date"))
def _(t):
    return churn.active_users_distinct(churn.recency_flags(churn.last_purchase(t.purchases)))


@query(
    "J3_snapshot_on_every_row",
    with_tables(
        "flags",
        "SELECT *, " + ", ".join(
            f"CAST(days_since_purchase <= {k} AS INTEGER) AS active_{k}d" for k in (30, 60, 90)
        ) + " FROM flags",
    ),
)
def _(t):
    return churn.recency_flags(churn.last_purchase(t.purchases))


define(
    "campaign_stats",
    "promotions",
    f"""
    SELECT *, rank() OVER (ORDER BY total_additional_revenue DESC) AS revenue_rank,
           rank() OVER (ORDER BY conversion_rate_pct DESC) AS conversion_rank
    FROM (SELECT campaign_name, discount, count(*) AS total_exposed,
            count(*) FILTER (responded = 1) AS total_responded,
            {r(f"{d('count(*) FILTER (responded = 1)')} / count(*) * 100", 2)}
                AS conversion_rate_pct,
            {d('sum(additional_revenue)')} AS total_additional_revenue,
            {r(f'''{d('sum(additional_revenue) FILTER (responded = 1)')}
               / nullif(count(*) FILTER (responded = 1), 0)''', 2)} AS avg_revenue_per_respondent,
            {r(f'''{d('sum(additional_revenue)')}
               / nullif(count(*) FILTER (responded = 1), 0)''', 2)} AS revenue_per_conversion
          FROM promotions GROUP BY campaign_name, discount)""",
)


@query("A5_campaign_stats", with_tables("campaign_stats", "SELECT * FROM campaign_stats"))
def _(t):
    return campaign.campaign_stats(t.promotions)


@query(
    "W4_campaign_ranks",
    with_tables(
        "campaign_stats",
        "SELECT campaign_name, discount, revenue_rank, conversion_rank FROM campaign_stats",
    ),
)
def _(t):
    return campaign.campaign_stats(t.promotions).select(
        "campaign_name", "discount", "revenue_rank", "conversion_rank"
    )


define(
    "granted",
    "promotions",
    """
    SELECT *, CAST(additional_revenue * CAST(discount AS DECIMAL(4,2)) AS DECIMAL(18,4)) AS granted
    FROM promotions""",
)
_ROI = with_tables(
    "granted",
    f"""SELECT campaign_name, count(*) AS customers_targeted, {r('sum(granted)', 2)} AS spend,
        {d('sum(additional_revenue)')} AS revenue,
        {r('sum(additional_revenue) - sum(granted)', 2)} AS net_profit,
        {r(f"{d('sum(additional_revenue) - sum(granted)')} / {d('sum(granted)')} * 100", 2)}
        AS roi_pct,
        {r(f"{d('sum(additional_revenue)')} / count(*)", 2)} AS revenue_per_customer
        FROM granted GROUP BY 1 HAVING sum(granted) > 0""",
)


@query("A6_campaign_roi", _ROI)
def _(t):
    return campaign.campaign_roi(t.promotions)


@query(
    "A6_campaign_roi_by_fraction",
    with_tables(
        "campaign_stats",
        f"""SELECT campaign_name, 'All' AS channel, discount AS spend,
            total_additional_revenue AS revenue,
            {r('total_additional_revenue - discount', 2)} AS net_profit,
            {r('(total_additional_revenue - discount) / discount * 100', 2)} AS roi_pct
            FROM campaign_stats""",
    ),
)
def _(t):
    return campaign.campaign_fraction_roi(campaign.campaign_stats(t.promotions))


@query(
    "P10_campaigns_with_spend",
    with_tables(
        "granted",
        """SELECT campaign_name FROM granted GROUP BY 1 HAVING sum(granted) > 0""",
    ),
)
def _(t):
    return campaign.campaign_roi(t.promotions).select("campaign_name")


@query(
    "A21_campaign_performance",
    with_tables(
        "promotions",
        f"""SELECT campaign_name,
            {r(f"{d('sum(responded)')} / count(*) * 100", 4)} AS response_rate,
            {d('sum(additional_revenue)')} AS total_revenue, count(*) AS n_targeted
            FROM promotions GROUP BY 1""",
    ),
)
def _(t):
    return campaign.campaign_performance(t.promotions)


@query(
    "A22_response_by_tier",
    with_tables(
        "promotions customers",
        f"""SELECT customer_tier, count(*) AS n,
            {r(f"{d('sum(responded)')} / count(*)", 4)} AS response_rate
            FROM promotions LEFT JOIN customers USING (customer_id) GROUP BY 1""",
    ),
)
def _(t):
    return campaign.response_by_tier(t.promotions, t.demographics)


@query(
    "A11_spend_and_responses",
    with_tables(
        "purchases promotions",
        f"""SELECT customer_id, total_spent,
            coalesce(num_promotions_responded, 0) AS num_promotions_responded
            FROM (SELECT customer_id, {d('sum(order_amount)')} AS total_spent
                  FROM purchases GROUP BY 1)
            LEFT JOIN (SELECT customer_id, CAST(sum(responded) AS BIGINT)
                  AS num_promotions_responded FROM promotions GROUP BY 1) USING (customer_id)""",
    ),
)
def _(t):
    spent = t.purchases.groupBy("customer_id").agg(
        F.sum("order_amount").cast("double").alias("total_spent")
    )
    answered = t.promotions.groupBy("customer_id").agg(
        F.sum("responded").alias("num_promotions_responded")
    )
    return spent.join(answered, "customer_id", "left").withColumn(
        "num_promotions_responded", F.coalesce("num_promotions_responded", F.lit(0))
    )


_BASE_COLUMNS = (
    "customer_id customer_tier country weekly_visits session_time_minutes page_views app_opens "
    "num_promotions_responded"
).split()


@query(
    "J2_four_table_left_join",
    with_tables(
        "base",
        f"SELECT {', '.join(_BASE_COLUMNS)}, {d('total_spent')} AS total_spent FROM base",
    ).replace("num_promotions_responded,", "CAST(num_promotions_responded AS BIGINT) AS num_promotions_responded,"),
)
def _(t):
    chained = customer360.joined_base(t.customers, t.engagement, t.promotions)
    return chained.select(*_BASE_COLUMNS, F.col("total_spent").cast("double").alias("total_spent"))


_S12 = with_tables(
    "base",
    f"""SELECT customer_id, customer_tier, {d('total_spent')} AS total_spent, weekly_visits,
        coalesce(session_time_minutes, (SELECT median(session_time_minutes) FROM base))
            AS session_time_minutes,
        coalesce({d('page_views')}, (SELECT median(page_views) FROM base)) AS page_views,
        CAST(num_promotions_responded AS BIGINT) AS num_promotions_responded,
        coalesce({d('total_spent')} >= (SELECT quantile_cont({d('total_spent')}, 0.99) FROM base),
                 false) AS high_spender,
        coalesce(weekly_visits >= (SELECT quantile_cont({d('weekly_visits')}, 0.99) FROM base),
                 false) AS high_engagement FROM base""",
)


@query("S12_analytic_base", _S12)
def _(t):
    wanted = "customer_id customer_tier total_spent num_promotions_responded".split()
    base = customer360.analytic_base(joined(t).select(*wanted, *customer360.ENGAGEMENT))
    return base.select(
        "customer_id",
        "customer_tier",
        F.col("total_spent").cast("double").alias("total_spent"),
        "weekly_visits",
        "session_time_minutes",
        "page_views",
        "num_promotions_responded",
        "high_spender",
        "high_engagement",
    )


@query(
    "W11_top_percent_flags",
    with_tables(
        "base",
        f"""SELECT customer_id,
        coalesce({d('total_spent')} >= (SELECT quantile_cont({d('total_spent')}, 0.99) FROM base),
                 false) AS high_spender,
        coalesce(weekly_visits >= (SELECT quantile_cont({d('weekly_visits')}, 0.99) FROM base),
                 false) AS high_engagement FROM base""",
    ),
)
def _(t):
    base = materialise(joined(t).select("customer_id", "total_spent", "weekly_visits"))
    flagged = descriptive.flag_top_share(
        base, {"total_spent": "high_spender", "weekly_visits": "high_engagement"}
    )
    return flagged.select("customer_id", "high_spender", "high_engagement")


@query(
    "A13_tier_statistics",
    with_tables(
        "base",
        f"""SELECT customer_tier, {r(f"avg({d('total_spent')})", 2)} AS total_spent_mean,
            {d('max(total_spent)')} AS total_spent_max, {d('min(total_spent)')} AS total_spent_min,
            {r('avg(weekly_visits)', 2)} AS weekly_visits_mean,
            max(weekly_visits) AS weekly_visits_max,
            {r('avg(num_promotions_responded)', 2)} AS num_promotions_responded_mean,
            CAST(sum(num_promotions_responded) AS BIGINT) AS num_promotions_responded_sum,
            {r(f"median({d('total_spent')})", 2)} AS total_spent_median,
            {r(f"median({d('weekly_visits')})", 2)} AS weekly_visits_median
            FROM base GROUP BY 1""",
    ),
)
def _(t):
    return customer360.tier_statistics(materialise(joined(t)))


@query(
    "P1_customer_filters",
    with_tables(
        "customers",
        """SELECT customer_id, customer_tier, country, churned FROM customers
           WHERE customer_tier = 'Gold' AND churned""",
    ),
)
def _(t):
    kept = customer360.apply_filters(t.customers, tier="Gold", country="All", status="Churned")
    return kept.select("customer_id", "customer_tier", "country", "churned")


@query(
    "P2_order_date_range",
    with_tables(
        "purchases",
        f"""SELECT order_id, customer_id, order_date, {d('order_amount')} AS order_amount
            FROM purchases WHERE order_date BETWEEN '1997-01-01' AND '1997-12-31'""",
    ),
)
def _(t):
    return customer360.within_dates(t.purchases, "1997-01-01", "1997-12-31").withColumn(
        "order_amount", F.col("order_amount").cast("double")
    )


@query(
    "P4_without_missing_engagement",
    with_tables(
        "base",
        """SELECT customer_id, weekly_visits, session_time_minutes FROM base
           WHERE weekly_visits IS NOT NULL AND session_time_minutes IS NOT NULL""",
    ),
)
def _(t):
    return (
        joined(t)
        .select("customer_id", "weekly_visits", "session_time_minutes")
        .dropna(subset=["weekly_visits", "session_time_minutes"])
    )


@query(
    "P5_customer_lookup",
    with_tables(
        "scored",
        f"""SELECT customer_id, name, customer_tier, {d('clv')} AS clv, churn_prob, risk_level,
            risk_segment FROM scored WHERE customer_id = 42""",
    ),
)
def _(t):
    return (
        scored(t)
        .where(F.col("customer_id") == 42)
        .select(
            "customer_id",
            "name",
            "customer_tier",
            F.col("clv").cast("double").alias("clv"),
            "churn_prob",
            "risk_level",
            "risk_segment",
        )
    )


@query(
    "P7_casts_and_bounds",
    with_tables(
        "customers",
        """SELECT customer_id, CAST(churned AS INTEGER) AS churned,
           greatest(months_since_signup, 1) AS months_at_least_one,
           least(months_since_signup, 60) AS months_at_most_60 FROM customers""",
    ),
)
def _(t):
    return t.customers.select(
        "customer_id",
        F.col("churned").cast("int").alias("churned"),
        clipped("months_since_signup", low=1).alias("months_at_least_one"),
        clipped("months_since_signup", high=60).alias("months_at_most_60"),
    )


@query(
    "P9_fixed_sample",
    with_tables(
        "scored",
        f"""SELECT customer_id, customer_tier, {d('clv')} AS clv, churn_prob FROM scored
            ORDER BY md5(CAST(customer_id AS VARCHAR)), customer_id LIMIT 500""",
    ),
)
def _(t):
    rows = scored(t).select(
        "customer_id", "customer_tier", F.col("clv").cast("double").alias("clv"), "churn_prob"
    )
    return customer360.fixed_sample(rows, "customer_id", 500)


@query(
    "J8_join_with_suffixed_names",
    with_tables(
        "customers engagement",
        """SELECT c.customer_id, c.months_since_signup, e.page_views AS page_views_eng,
           e.app_opens AS app_opens_eng
           FROM customers c LEFT JOIN engagement e USING (customer_id)""",
    ),
)
def _(t):
    right = t.engagement.select(
        "customer_id",
        F.col("page_views").alias("page_views_eng"),
        F.col("app_opens").alias("app_opens_eng"),
    )
    return t.demographics.select("customer_id", "months_since_signup").join(
        right, "customer_id", "left"
    )


@query(
    "A23_country_value",
    with_tables(
        "customers",
        f"""SELECT country, {r(f"{d('sum(clv)')} / count(*)", 2)} AS avg_clv,
            count(*) AS customers FROM customers GROUP BY 1
            ORDER BY avg_clv DESC, country LIMIT 10""",
    ),
)
def _(t):
    return customer360.country_value(t.customers)


@query(
    "A24_engagement_by_tier",
    with_tables(
        "base",
        " UNION ALL ".join(
            f"SELECT '{c}' AS metric, "
            + ", ".join(
                r(f"avg({d(c)}) FILTER (customer_tier = '{tier}')", 1) + f' AS "{tier}"'
                for tier in ("Bronze", "Silver", "Gold", "Platinum")
            )
            + " FROM base"
            for c in customer360.ENGAGEMENT
        ),
    ),
)
def _(t):
    return customer360.engagement_by_tier(joined(t))


@query(
    "A25_executive_kpis",
    with_tables(
        "customers purchases promotions",
        f"""SELECT count(*) AS total_customers, {r(f"{d('sum(clv)')} / count(*)", 2)} AS avg_clv,
            {r(f"{d('count(*) FILTER (churned)')} / count(*) * 100", 2)} AS churn_rate_pct,
            {r('avg(next_purchase_prob) * 100', 2)} AS avg_purchase_prob_pct,
            (SELECT {d('sum(order_amount)')} FROM purchases) AS total_revenue,
            (SELECT {r(f"{d('sum(order_amount)')} / count(*)", 2)} FROM purchases)
                AS avg_order_value,
            {r(f"{d('count(*) FILTER (clv >= 200)')} / count(*) * 100", 2)} AS high_value_pct,
            (SELECT {r(f"{d('sum(responded)')} / count(*) * 100", 2)} FROM promotions)
                AS response_rate_pct,
            (SELECT {d('coalesce(sum(additional_revenue) FILTER (responded = 1), 0)')}
             FROM promotions) AS campaign_revenue,
            {r(f"{d('count(*) FILTER (churned)')} / count(*) * {d('sum(clv)')}", 0)}
                AS clv_at_risk FROM customers""",
    ),
)
def _(t):
    return customer360.executive_kpis(t.customers, t.purchases, t.promotions)


@query(
    "A26_executive_summary",
    with_tables(
        "customers",
        f"""SELECT count(*) AS total_customers, {r('avg(CAST(churned AS INTEGER))', 4)} AS churn_rate,
            count(*) FILTER (clv > 1000) AS high_value_customers FROM customers""",
    ),
)
def _(t):
    return customer360.executive_summary(t.customers)


@query(
    "M25_rule_based_churn_score",
    with_tables("scored", "SELECT customer_id, churn_prob, risk_level FROM scored"),
)
def _(t):
    return scored(t).select("customer_id", "churn_prob", "risk_level")


@query(
    "A15_churn_probability_histogram",
    with_tables(
        "scored",
        """SELECT CAST(least(floor(churn_prob * 40 / 1.0::DOUBLE) + 1, 40) AS BIGINT) AS bin,
           count(*) AS n FROM scored GROUP BY 1""",
    ),
)
def _(t):
    return revenue.histogram(scored(t), "churn_prob", 0, 1, 40)


@query(
    "A30_risk_distribution",
    with_tables(
        "scored",
        f"""SELECT risk_segment, count(*) AS n,
            {r(f"{d('count(*)')} / sum(count(*)) OVER () * 100", 2)} AS share_pct
            FROM scored GROUP BY 1""",
    ),
)
def _(t):
    return revenue.value_counts(scored(t), "risk_segment")


@query(
    "W12_fixed_edge_bins",
    with_tables(
        "customers",
        """SELECT customer_id, CASE WHEN next_purchase_prob <= 0 OR next_purchase_prob > 1 THEN NULL
           WHEN next_purchase_prob <= 0.3 THEN 'Low Risk'
           WHEN next_purchase_prob <= 0.6 THEN 'Medium Risk' ELSE 'High Risk' END AS segment
           FROM customers""",
    ),
)
def _(t):
    segment = churn.risk_segment(F.col("next_purchase_prob"), (0.0, 0.3, 0.6, 1.0))
    return t.customers.select("customer_id", segment.alias("segment"))


@query(
    "L5_high_value_at_risk",
    with_tables(
        "scored",
        f"""SELECT customer_id, name, customer_tier, {d('clv')} AS clv, churn_prob, risk_segment
            FROM scored WHERE churn_prob >= 0.6
            AND {d('clv')} >= (SELECT quantile_cont({d('clv')}, 0.75) FROM scored)
            ORDER BY churn_prob DESC, clv DESC, customer_id LIMIT 20""",
    ),
)
def _(t):
    columns = ["customer_id", "name", "customer_tier", "clv", "churn_prob", "risk_segment"]
    return customer360.high_value_at_risk(materialise(scored(t).select(*columns)))
