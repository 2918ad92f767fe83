"""Weekly series and forecast queries, for all lines and for every category."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.functions.numeric import rounded
from clientele.operators import forecast, revenue
from clientele.plans.reference_sql import d, define, r, with_tables
from clientele.plans.registry import query
from clientele.sources.adapter import Tables
from clientele.sources.scratch import materialise

define(
    "weekly_sums",
    "lines",
    """
    SELECT series_key, CAST(order_date + CAST((8 - isodow(order_date)) % 7 AS INTEGER) AS DATE)
               AS week_end,
           sum(order_amount) AS amount, count(*) AS n_orders
    FROM (SELECT product_category AS series_key, order_date, order_amount FROM lines
          UNION ALL SELECT 'all', order_date, order_amount FROM lines)
    GROUP BY 1, 2""",
)
define(
    "weekly",
    "weekly_sums",
    f"""
    SELECT k.series_key, k.week_end, {d('coalesce(amount, 0)')} AS revenue,
           coalesce(n_orders, 0) AS n_orders,
           {r(d('amount') + ' / n_orders', 4)} AS avg_order_value
    FROM (SELECT series_key, CAST(unnest(generate_series(min(week_end), max(week_end),
                 INTERVAL 7 DAY)) AS DATE) AS week_end FROM weekly_sums GROUP BY 1) k
    LEFT JOIN weekly_sums s USING (series_key, week_end)""",
)


def _ma(width: int) -> str:
    return r(
        f"""avg(revenue) OVER (PARTITION BY series_key ORDER BY week_end
            ROWS BETWEEN {width - 1} PRECEDING AND CURRENT ROW)""",
        4,
    )


define(
    "averaged",
    "weekly",
    f"SELECT *, {_ma(1)} AS ma_1w, {_ma(4)} AS ma_4w, {_ma(12)} AS ma_12w FROM weekly",
)
_BY = "PARTITION BY series_key ORDER BY week_end"
define(
    "trended",
    "weekly",
    f"""
    SELECT *, (row_number() OVER ({_BY}) - 1) AS index,
           CASE WHEN count(*) OVER ({_BY} ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) = 5 THEN
             (sum(revenue) OVER ({_BY} ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)
              - (lag(revenue, 2) OVER ({_BY}) + lead(revenue, 2) OVER ({_BY})) / 2) / 4 END
             AS trend
    FROM weekly""",
)
define(
    "parts",
    "trended",
    """
    SELECT *, revenue - trend - seasonal AS residual FROM (
      SELECT t.*, m - avg(m_first) OVER (PARTITION BY series_key) AS seasonal FROM (
        SELECT *, CASE WHEN row_number() OVER (PARTITION BY series_key, index % 4
                       ORDER BY week_end) = 1 THEN m END AS m_first
        FROM (SELECT *, avg(revenue - trend) OVER (PARTITION BY series_key, index % 4) AS m
              FROM trended)) t)""",
)
define(
    "lagged",
    "weekly",
    f"""
    SELECT *, lag(y, 1) OVER ({_BY}) AS y1, lag(y, 2) OVER ({_BY}) AS y2
    FROM (SELECT *, revenue - lag(revenue) OVER ({_BY}) AS y FROM weekly)""",
)
define(
    "fitted",
    "lagged",
    """
    SELECT *, sqrt(greatest(yy - a * s1y - b * s2y, 0) / greatest(n - 2, 1)) AS sigma FROM (
      SELECT *, (s1y * s22 - s2y * s12) / det AS a, (s2y * s11 - s1y * s12) / det AS b FROM (
        SELECT *, s11 * s22 - s12 * s12 AS det FROM (
          SELECT series_key, max(week_end) AS last_week, arg_max(revenue, week_end) AS last_revenue,
            arg_max(y, week_end) AS last_y, arg_max(y1, week_end) AS last_y1,
            count(*) FILTER (y2 IS NOT NULL) AS n,
            sum(y * y) FILTER (y2 IS NOT NULL) AS yy, sum(y1 * y1) FILTER (y2 IS NOT NULL) AS s11,
            sum(y2 * y2) AS s22, sum(y1 * y2) AS s12, sum(y * y1) FILTER (y2 IS NOT NULL) AS s1y,
            sum(y * y2) AS s2y
          FROM lagged GROUP BY 1)))""",
)
define(
    "path",
    "fitted",
    """
    SELECT series_key, last_week, sigma, a, b, 0 AS step, last_revenue AS level, last_y AS y,
           last_y1 AS y1, 0.0::DOUBLE AS psi, 0.0::DOUBLE AS psi1, 0.0::DOUBLE AS weight,
           0.0::DOUBLE AS variance FROM fitted
    UNION ALL
    SELECT series_key, last_week, sigma, a, b, step + 1, level + a * y + b * y1, a * y + b * y1, y,
           CASE WHEN step = 0 THEN 1 ELSE a * psi + b * psi1 END, psi,
           weight + CASE WHEN step = 0 THEN 1 ELSE a * psi + b * psi1 END,
           variance + pow(weight + CASE WHEN step = 0 THEN 1 ELSE a * psi + b * psi1 END, 2)
    FROM path WHERE step < 13""",
)
_REACH = "1.959963984540054::DOUBLE * sigma * sqrt(variance)"
define(
    "predicted",
    "path",
    f"""
    SELECT series_key, CAST(last_week + step * 7 AS DATE) AS week_end,
           {r('greatest(level, 0)', 2)} AS yhat,
           {r(f'greatest(level - {_REACH}, 0)', 2)} AS yhat_lower,
           {r(f'level + {_REACH}', 2)} AS yhat_upper, 'ARI(2,1)' AS model_used
    FROM path WHERE step > 0""",
)


def weekly(t: Tables) -> DataFrame:
    """All lines as one series next to one series per category.

    The category sums are added up for the whole: the lines are read once.
    """
    per_category = t.category_orders.groupBy("product_category", "order_date").agg(
        F.sum("amount").alias("order_amount"), F.sum("rows").alias("rows")
    )
    stacked = per_category.select(
        F.explode(F.array("product_category", F.lit(forecast.ALL))).alias("series"),
        "order_date",
        "order_amount",
        "rows",
    )
    return forecast.weekly_series(stacked, "series", rows="rows")


def averaged(t: Tables) -> DataFrame:
    return forecast.moving_averages(weekly(t))


@query("T1_weekly_series", with_tables("weekly", "SELECT * FROM weekly"))
def _(t):
    return weekly(t)


@query(
    "T2_series_long_enough",
    with_tables(
        "weekly",
        """SELECT series_key, count(*) AS weeks FROM weekly GROUP BY 1 HAVING count(*) >= 8""",
    ),
)
def _(t):
    return (
        forecast.long_enough(weekly(t))
        .groupBy("series_key")
        .agg(F.count(F.lit(1)).alias("weeks"))
    )


_AVERAGES = "SELECT series_key, week_end, ma_1w, ma_4w, ma_12w FROM averaged"


@query("T3_moving_averages", with_tables("averaged", "SELECT * FROM averaged"))
def _(t):
    return averaged(t)


@query("W6_rolling_means", with_tables("averaged", _AVERAGES))
def _(t):
    return averaged(t).select("series_key", "week_end", "ma_1w", "ma_4w", "ma_12w")


@query(
    "W9_last_weeks_mean",
    with_tables(
        "weekly",
        f"""SELECT series_key, {r('avg(revenue)', 2)} AS last_weeks_mean, count(*) AS weeks
            FROM (SELECT *, row_number() OVER (PARTITION BY series_key ORDER BY week_end DESC) AS k
                  FROM weekly) WHERE k <= 13 GROUP BY 1""",
    ),
)
def _(t):
    return forecast.last_weeks_mean(weekly(t))


@query(
    "W13_first_to_last_average",
    with_tables(
        "averaged",
        f"""SELECT series_key, arg_min(ma_12w, week_end) AS first_value,
            arg_max(ma_12w, week_end) AS last_value,
            {r('''(arg_max(ma_12w, week_end) - arg_min(ma_12w, week_end))
               / arg_min(ma_12w, week_end) * 100''', 2)} AS change_pct
            FROM averaged GROUP BY 1""",
    ),
)
def _(t):
    return forecast.average_change(averaged(t))


@query(
    "L7_last_eighteen_weeks",
    with_tables(
        "weekly",
        """SELECT series_key, week_end, revenue FROM
           (SELECT *, row_number() OVER (PARTITION BY series_key ORDER BY week_end DESC) AS k
            FROM weekly) WHERE k <= 18""",
    ),
)
def _(t):
    return forecast.last_weeks(weekly(t), 18).select("series_key", "week_end", "revenue")


@query(
    "T4_decomposition",
    with_tables(
        "parts",
        f"""SELECT series_key, week_end, revenue, {r('trend', 2)} AS trend,
            {r('seasonal', 2)} AS seasonal, {r('residual', 2)} AS residual FROM parts""",
    ),
)
def _(t):
    return forecast.decompose(weekly(t)).select(
        "series_key",
        "week_end",
        "revenue",
        *[rounded(c, 2).alias(c) for c in ("trend", "seasonal", "residual")],
    )


@query(
    "T5_season_and_trend",
    with_tables(
        "parts",
        f"""SELECT series_key, {r('strength', 4)} AS seasonality_strength,
            CASE WHEN strength > 0.4 THEN 'strong' WHEN strength > 0.2 THEN 'moderate'
                 ELSE 'weak' END AS seasonality,
            CASE WHEN slope > 0 THEN 'upward' ELSE 'downward' END AS trend_direction,
            {r('slope / level * 100', 3)} AS trend_pct_per_week,
            {r('slope / level * 100 * 52', 2)} AS trend_pct_per_year
            FROM (SELECT series_key, greatest(0, 1 - var_pop(residual)
                  / nullif(var_pop(seasonal + residual), 0)) AS strength,
                  regr_slope(trend, CAST(index AS DOUBLE)) AS slope, avg(trend) AS level
                  FROM parts GROUP BY 1)""",
    ),
)
def _(t):
    return forecast.decomposition_summary(forecast.decompose(weekly(t)))


@query("T6_weekly_forecast", with_tables("predicted", "SELECT * FROM predicted"))
def _(t):
    return forecast.forecast(weekly(t))


@query(
    "T7_monthly_trend_forecast",
    with_tables(
        "monthly",
        f"""SELECT CAST(last_month + to_months(CAST(step AS INTEGER)) AS DATE) AS month,
            {r('value', 2)} AS forecast, {r('value * (1 - 0.15::DOUBLE)', 2)} AS lower,
            {r('value * (1 + 0.15::DOUBLE)', 2)} AS upper,
            {r('sum(value) OVER ()', 2)} AS forecast_total,
            {r('sum(value) OVER () / recent * 100 - 100', 1)} AS change_pct
            FROM (SELECT *, intercept + slope * (n - 1 + step) AS value FROM (
              SELECT regr_slope(total_revenue, t) AS slope,
                     regr_intercept(total_revenue, t) AS intercept, count(*) AS n,
                     max(month) AS last_month, sum(total_revenue) FILTER (back <= 3) AS recent
              FROM (SELECT *, row_number() OVER (ORDER BY month) - 1.0::DOUBLE AS t,
                           row_number() OVER (ORDER BY month DESC) AS back FROM monthly)),
              (SELECT unnest([1, 2, 3]) AS step) WHERE n >= 12)""",
    ),
)
def _(t):
    return forecast.monthly_trend_forecast(revenue.monthly_totals(t.purchases))


@query(
    "T8_forecast_summary",
    with_tables(
        "predicted weekly",
        f"""SELECT series_key, model_used, forecast_weeks, {r('mean', 2)} AS historical_avg_weekly,
            {r('recent', 2)} AS last_13w_avg_weekly, {r('future', 2)} AS forecast_avg_weekly,
            {r('total', 2)} AS projected_total_revenue, {r('low', 2)} AS projected_lower_bound,
            {r('high', 2)} AS projected_upper_bound,
            {r('(future - recent) / recent * 100', 2)} AS growth_vs_last_quarter_pct,
            CASE WHEN (future - recent) / recent * 100 > 5 THEN 'grow'
                 WHEN (future - recent) / recent * 100 < -5 THEN 'decline' ELSE 'stable' END
                 AS outlook
            FROM (SELECT series_key, avg(revenue) AS mean, avg(revenue) FILTER (k <= 13) AS recent
                  FROM (SELECT *, row_number() OVER (PARTITION BY series_key
                        ORDER BY week_end DESC) AS k FROM weekly) GROUP BY 1)
            JOIN (SELECT series_key, min(model_used) AS model_used, count(*) AS forecast_weeks,
                  avg(yhat) AS future, sum(yhat) AS total, sum(yhat_lower) AS low,
                  sum(yhat_upper) AS high FROM predicted GROUP BY 1) USING (series_key)""",
    ),
)
def _(t):
    series = materialise(weekly(t))
    return forecast.forecast_summary(series, forecast.forecast(series)).drop("business_insight")


@query(
    "T9_week_of_month_profile",
    with_tables(
        "weekly",
        f"""SELECT series_key, week_of_month, {r('m', 2)} AS mean_revenue,
            {r('(m - avg(m) OVER w) / avg(m) OVER w * 100', 2)} AS vs_avg_pct,
            row_number() OVER (PARTITION BY series_key ORDER BY m DESC, week_of_month) = 1
                AS is_best,
            row_number() OVER (PARTITION BY series_key ORDER BY m, week_of_month) = 1 AS is_worst
            FROM (SELECT series_key, CAST((day(week_end) - 1) // 7 + 1 AS INTEGER)
                  AS week_of_month, avg(revenue) AS m FROM weekly GROUP BY 1, 2)
            WINDOW w AS (PARTITION BY series_key)""",
    ),
)
def _(t):
    return forecast.week_of_month_profile(weekly(t))


_COMBINED = with_tables(
    "averaged predicted",
    """SELECT series_key, week_end AS ds, revenue AS yhat, n_orders, avg_order_value, ma_4w,
       ma_12w, 'historical' AS data_type, NULL::DOUBLE AS yhat_lower, NULL::DOUBLE AS yhat_upper,
       NULL::VARCHAR AS model_used FROM averaged
       UNION ALL
       SELECT series_key, week_end, yhat, NULL, NULL, NULL, NULL, 'forecast', yhat_lower,
       yhat_upper, model_used FROM predicted""",
)


@query("T10_history_and_forecast", _COMBINED)
def _(t):
    series = materialise(averaged(t))
    return forecast.history_and_forecast(series, forecast.forecast(series))


@query(
    "U1_union_with_missing_columns",
    with_tables(
        "averaged predicted",
        f"""SELECT data_type, count(*) AS n, count(yhat_lower) AS bounds, count(ma_4w) AS averages,
            {r('sum(yhat)', 0)} AS total FROM (
            SELECT 'historical' AS data_type, revenue AS yhat, NULL::DOUBLE AS yhat_lower, ma_4w
            FROM averaged UNION ALL
            SELECT 'forecast', yhat, yhat_lower, NULL FROM predicted) GROUP BY 1""",
    ),
)
def _(t):
    series = materialise(averaged(t))
    combined = forecast.history_and_forecast(series, forecast.forecast(series))
    return combined.groupBy("data_type").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("yhat_lower").alias("bounds"),
        F.count("ma_4w").alias("averages"),
        rounded(F.sum("yhat"), 0).alias("total"),
    )
