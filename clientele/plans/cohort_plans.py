"""Cohort retention queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from clientele.operators import cohort
from clientele.plans.reference_sql import d, define, r, with_tables
from clientele.plans.registry import query
from clientele.sources.adapter import Tables

_PERIOD = """(year({m}) * 12 + month({m})) - (year({c}) * 12 + month({c}))"""
define(
    "signup_activity",
    "purchases customers",
    f"""
    SELECT * FROM (
      SELECT p.customer_id, CAST(date_trunc('month', c.signup_date) AS DATE) AS cohort_month,
             CAST(date_trunc('month', p.order_date) AS DATE) AS order_month,
             CAST({_PERIOD.format(m='p.order_date', c='c.signup_date')} AS INTEGER)
                 AS period_number,
             p.order_amount
      FROM purchases p JOIN customers c USING (customer_id))
    WHERE period_number >= 0""",
)
define(
    "signup_totals",
    "signup_activity",
    """
    SELECT cohort_month, period_number, count(DISTINCT customer_id) AS active_customers,
           sum(order_amount) AS amount
    FROM signup_activity GROUP BY 1, 2""",
)
define(
    "signup_rates",
    "signup_totals",
    f"""
    SELECT t.cohort_month, t.period_number, s.active_customers AS cohort_size,
           t.active_customers,
           {r(d('t.active_customers') + ' / s.active_customers', 4)} AS retention_rate,
           {d('t.amount')} AS revenue,
           {r(d('t.amount') + ' / ' + d('s.amount'), 4)} AS revenue_retention
    FROM signup_totals t
    LEFT JOIN signup_totals s ON s.cohort_month = t.cohort_month AND s.period_number = 0""",
)
define(
    "first_month",
    "purchases",
    """
    SELECT customer_id, CAST(date_trunc('month', min(order_date)) AS DATE) AS cohort_month
    FROM purchases GROUP BY 1""",
)
define(
    "first_rates",
    "first_month",
    f"""
    SELECT a.*, s.cohort_size,
           {r(d('a.active_customers') + ' / s.cohort_size * 100', 2)} AS retention_rate_pct
    FROM (SELECT cohort_month,
                 CAST({_PERIOD.format(m='order_date', c='cohort_month')} AS INTEGER)
                     AS period_number,
                 count(DISTINCT customer_id) AS active_customers
          FROM purchases JOIN first_month USING (customer_id) GROUP BY 1, 2) a
    JOIN (SELECT cohort_month, count(*) AS cohort_size FROM first_month GROUP BY 1) s
         USING (cohort_month)""",
)
define(
    "first_means",
    "first_rates",
    f"""
    SELECT cohort_month, max(cohort_size) AS cohort_size,
           max(retention_rate_pct) FILTER (period_number = 1) AS month_1_retention,
           max(retention_rate_pct) FILTER (period_number = 3) AS month_3_retention,
           max(retention_rate_pct) FILTER (period_number = 6) AS month_6_retention,
           {r('avg(retention_rate_pct) FILTER (period_number >= 1)', 4)} AS avg_retention
    FROM first_rates GROUP BY 1""",
)


def signup_totals(t: Tables):
    customers = t.demographics.select("customer_id", "signup_date")
    return cohort.cohort_totals(cohort.signup_activity(customers, t.purchases))


def first_means(t: Tables):
    totals = cohort.cohort_totals(cohort.first_purchase_activity(t.purchases, None))
    return cohort.cohort_means(cohort.retention_percent(totals))


@query(
    "C1_signup_activity",
    with_tables(
        "signup_activity",
        f"""SELECT customer_id, cohort_month, order_month, period_number,
            {d('sum(order_amount)')} AS amount, count(*) AS orders
            FROM signup_activity GROUP BY 1, 2, 3, 4""",
    ),
)
def _(t):
    customers = t.demographics.select("customer_id", "signup_date")
    return cohort.signup_activity(customers, t.purchases).withColumn(
        "amount", F.col("amount").cast("double")
    )


@query(
    "J6_purchases_of_known_customers",
    with_tables(
        "signup_activity",
        """SELECT cohort_month, count(*) AS orders, count(DISTINCT customer_id) AS customers
           FROM signup_activity GROUP BY 1""",
    ),
)
def _(t):
    customers = t.demographics.select("customer_id", "signup_date")
    return (
        cohort.signup_activity(customers, t.purchases)
        .groupBy("cohort_month", "customer_id")
        .agg(F.sum("orders").alias("orders"))
        .groupBy("cohort_month")
        .agg(F.sum("orders").alias("orders"), F.count(F.lit(1)).alias("customers"))
    )


@query(
    "P8_periods_zero_to_twelve",
    with_tables(
        "signup_totals",
        """SELECT cohort_month, period_number, active_customers FROM signup_totals
           WHERE period_number BETWEEN 0 AND 12""",
    ),
)
def _(t):
    return (
        signup_totals(t)
        .where(F.col("period_number").between(0, 12))
        .select("cohort_month", "period_number", "active_customers")
    )


_RATES = "cohort_month, period_number, cohort_size, active_customers, retention_rate"


@query("C2_retention_rates", with_tables("signup_rates", f"SELECT {_RATES} FROM signup_rates"))
def _(t):
    return cohort.retention(signup_totals(t))


@query(
    "J5_counts_with_cohort_sizes",
    with_tables(
        "signup_totals",
        """SELECT t.cohort_month, t.period_number, t.active_customers,
           s.active_customers AS cohort_size
           FROM signup_totals t JOIN signup_totals s USING (cohort_month)
           WHERE s.period_number = 0""",
    ),
)
def _(t):
    totals = signup_totals(t).select("cohort_month", "period_number", "active_customers")
    # One row per calendar month of signup: a size the calendar bounds.
    return totals.join(F.broadcast(cohort.cohort_sizes(totals)), "cohort_month")


@query(
    "C3_retention_matrix",
    with_tables(
        "signup_rates",
        """SELECT p.cohort_month, string_agg(
               coalesce(CAST(CAST(s.retention_rate AS DECIMAL(18,4)) AS VARCHAR), ''), ',' ORDER BY p.period) AS rates
           FROM (SELECT cohort_month, unnest(range(0, last + 1)) AS period FROM (
                   SELECT cohort_month, max(period_number) AS last FROM signup_rates
                   WHERE period_number >= 0 GROUP BY 1)) p
           LEFT JOIN signup_rates s ON s.cohort_month = p.cohort_month AND s.period_number = p.period
           GROUP BY 1""",
    ),
)
def _(t):
    return cohort.matrix_rows(cohort.retention(signup_totals(t)), "retention_rate")


@query(
    "C4_revenue_retention",
    with_tables(
        "signup_rates",
        "SELECT cohort_month, period_number, revenue, revenue_retention FROM signup_rates",
    ),
)
def _(t):
    return cohort.revenue_retention(signup_totals(t))


def _top_bottom_sql(period: int) -> str:
    at = f"""(SELECT cohort_month, period_number, retention_rate,
              {r('avg(retention_rate) OVER ()', 4)} AS mean_rate FROM signup_rates
              WHERE retention_rate IS NOT NULL AND period_number = coalesce(
                (SELECT max(period_number) FROM signup_rates WHERE period_number = {period}),
                (SELECT max(period_number) FROM signup_rates)))"""
    return with_tables(
        "signup_rates",
        f"""(SELECT *, 'top' AS side FROM {at} ORDER BY retention_rate DESC, cohort_month LIMIT 3)
            UNION ALL
            (SELECT *, 'bottom' AS side FROM {at}
             ORDER BY retention_rate, cohort_month DESC LIMIT 3)""",
    )


@query("C5_top_and_bottom_cohorts", _top_bottom_sql(3))
def _(t):
    return cohort.top_and_bottom(cohort.retention(signup_totals(t)))


@query("L3_cohorts_at_absent_period", _top_bottom_sql(500))
def _(t):
    return cohort.top_and_bottom(cohort.retention(signup_totals(t)), at_period=500)


_AT = {p: f"max(retention_rate) FILTER (period_number = {p})" for p in (1, 3, 6, 12)}
_MEAN = (
    "(" + " + ".join(f"coalesce({_AT[p]}, 0)" for p in (1, 3, 6)) + ") / nullif("
    + " + ".join(f"({_AT[p]} IS NOT NULL)::INT" for p in (1, 3, 6)) + ", 0)"
)


@query(
    "C6_cohort_summary",
    with_tables(
        "signup_rates",
        f"""SELECT cohort_month, max(cohort_size) AS cohort_size,
            {', '.join(f'{sql} AS retention_m{p}' for p, sql in _AT.items())},
            {r(_MEAN, 4)} AS avg_retention_m1_m6
            FROM signup_rates GROUP BY 1 HAVING max(cohort_size) IS NOT NULL""",
    ),
)
def _(t):
    return cohort.checkpoints(cohort.retention(signup_totals(t)))


@query(
    "C7_first_purchase_retention",
    with_tables(
        "first_rates",
        """SELECT cohort_month, cohort_size, period_number, active_customers, retention_rate_pct
           FROM first_rates WHERE period_number BETWEEN 0 AND 12""",
    ),
)
def _(t):
    return cohort.retention_percent(
        cohort.cohort_totals(cohort.first_purchase_activity(t.purchases))
    )


@query(
    "J4_purchases_since_first",
    with_tables(
        "first_month",
        """SELECT customer_id, cohort_month,
           CAST(date_trunc('month', order_date) AS DATE) AS order_month, count(*) AS orders
           FROM purchases JOIN first_month USING (customer_id)
           WHERE order_date >= cohort_month GROUP BY 1, 2, 3""",
    ),
)
def _(t):
    return cohort.first_purchase_activity(t.purchases, None).select(
        "customer_id", "cohort_month", "order_month", "orders"
    )


@query("C8_cohort_means", with_tables("first_means", "SELECT * FROM first_means"))
def _(t):
    return first_means(t)


@query(
    "C8_ranked_cohorts",
    with_tables(
        "first_means",
        f"""(SELECT cohort_month, cohort_size, avg_retention,
             {r('(SELECT max(avg_retention) - min(avg_retention) FROM first_means)', 4)} AS gap,
             'top' AS side FROM first_means WHERE avg_retention IS NOT NULL
             ORDER BY avg_retention DESC, cohort_month LIMIT 5)
            UNION ALL
            (SELECT cohort_month, cohort_size, avg_retention,
             {r('(SELECT max(avg_retention) - min(avg_retention) FROM first_means)', 4)} AS gap,
             'bottom' AS side FROM first_means WHERE avg_retention IS NOT NULL
             ORDER BY avg_retention, cohort_month LIMIT 5)""",
    ),
)
def _(t):
    return cohort.ranked_cohorts(first_means(t))


define(
    "latest_rates",
    "signup_totals customers",
    f"""
    SELECT cohort_month, period_number, signups, active_customers,
           {r(d('active_customers') + ' / signups', 3)} AS retention_rate
    FROM signup_totals
    JOIN (SELECT CAST(date_trunc('month', signup_date) AS DATE) AS cohort_month,
                 count(*) AS signups FROM customers GROUP BY 1) USING (cohort_month)
    WHERE period_number <= 12 AND cohort_month IN
      (SELECT DISTINCT cohort_month FROM signup_totals ORDER BY 1 DESC LIMIT 18)""",
)


def latest_rates(t: Tables):
    customers = t.demographics.select("customer_id", "signup_date")
    return cohort.signup_retention(customers, cohort.signup_activity(customers, t.purchases))


@query("C9_retention_of_all_signups", with_tables("latest_rates", "SELECT * FROM latest_rates"))
def _(t):
    return latest_rates(t)


@query(
    "C9_milestone_means",
    with_tables(
        "latest_rates",
        "SELECT "
        + ", ".join(
            r(f"avg(retention_rate) FILTER (period_number = {p}) * 100", 1) + f" AS month_{p}"
            for p in (1, 3, 6)
        )
        + ", "
        + r(
            """avg(retention_rate) FILTER (period_number = 1) * 100
            - avg(retention_rate) FILTER (period_number = 3) * 100""",
            1,
        )
        + " AS drop_1_to_3 FROM latest_rates",
    ),
)
def _(t):
    return cohort.milestone_means(latest_rates(t))


@query(
    "L7_last_six_cohorts",
    with_tables(
        "latest_rates",
        """SELECT * FROM latest_rates WHERE cohort_month IN
           (SELECT DISTINCT cohort_month FROM latest_rates ORDER BY 1 DESC LIMIT 6)""",
    ),
)
def _(t):
    return cohort.last_cohorts(latest_rates(t), 6)


@query(
    "C10_winback_sizing",
    with_tables(
        "first_means",
        f"""SELECT {r('m1', 2)} AS month_1_mean, {r('m6', 2)} AS month_6_mean,
            {r('m1 - m6', 2)} AS drop_1_to_6, customers, {r('lost', 0)} AS customers_lost,
            {r('lost * 0.05::DOUBLE * 50', 0)} AS conversion_value,
            {r('lost * 3', 0)} AS campaign_cost,
            {r('lost * 0.15::DOUBLE', 0)} AS customers_recovered,
            {r('lost * 0.15::DOUBLE * 50', 0)} AS recovered_revenue,
            {r('lost * 0.15::DOUBLE * 50 - lost * 3', 0)} AS net_impact
            FROM (SELECT *, (100 - m1) / 100 * customers AS lost FROM (
              SELECT avg(month_1_retention) AS m1, avg(month_6_retention) AS m6,
                     CAST(sum(cohort_size) AS BIGINT) AS customers FROM first_means))""",
    ),
)
def _(t):
    return cohort.winback_sizing(first_means(t))
