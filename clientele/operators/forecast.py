"""Weekly series, decomposition and forecasts, for any number of series at once.

Orders are summed to series and week before anything else. From there on a
series has one row per week, and all windows run within one series.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clientele.functions.calendar import week_closing_monday, week_of_month
from clientele.functions.numeric import first_match, ratio, rounded
from clientele.functions.stats import normal_quantile
from clientele.functions.text import dollars, percentage

ALL = "all"


def _by_week():
    return W.partitionBy("series_key").orderBy("week_end")


def weekly_series(
    orders: DataFrame,
    key: str | None = None,
    date: str = "order_date",
    amount: str = "order_amount",
    rows: str | None = None,
    drop_partial_last: bool = False,
) -> DataFrame:
    """Revenue, rows and mean per series and week; weeks without rows are zero.

    Input that is already summed names its column of row counts in ``rows``.

    A week ends on the Monday it is labelled with. A week is followed by the
    empty ones up to the next, so no second pass makes a calendar. ``drop_partial_last`` leaves
    out a last week that the data does not cover to its Monday.
    """
    name = F.lit(ALL) if key is None else F.col(key)
    sums = orders.groupBy(
        name.alias("series_key"), week_closing_monday(date).alias("week_end")
    ).agg(
        F.sum(amount).alias("amount"),
        (F.count(amount) if rows is None else F.sum(rows)).alias("n_orders"),
        F.max(date).alias("last_day"),
    )
    if drop_partial_last:
        newest = F.max("last_day").over(W.partitionBy("series_key"))
        sums = sums.withColumn("_newest", newest).where(F.col("week_end") <= F.col("_newest"))
    following = F.lead("week_end").over(_by_week())
    until = F.coalesce(F.date_sub("_next", 7), F.col("week_end"))
    filled = sums.withColumn("_next", following).withColumn(
        "_week", F.explode(F.sequence("week_end", until, F.expr("INTERVAL 7 DAYS")))
    )
    own = F.col("_week") == F.col("week_end")
    return filled.select(
        "series_key",
        F.col("_week").alias("week_end"),
        F.coalesce(F.when(own, F.col("amount").cast("double")), F.lit(0.0)).alias("revenue"),
        F.coalesce(F.when(own, F.col("n_orders")), F.lit(0)).alias("n_orders"),
        F.when(own, rounded(ratio("amount", "n_orders"), 4)).alias("avg_order_value"),
    )


def long_enough(weekly: DataFrame, min_weeks: int = 8) -> DataFrame:
    """Only the series with at least ``min_weeks`` weeks."""
    weeks = F.count(F.lit(1)).over(W.partitionBy("series_key"))
    return weekly.withColumn("_weeks", weeks).where(F.col("_weeks") >= min_weeks).drop("_weeks")


def require_weeks(weekly: DataFrame, min_weeks: int = 8) -> DataFrame:
    """The series unchanged, or a ValueError when the longest one is too short."""
    row = weekly.groupBy("series_key").count().agg(F.max("count")).first()
    weeks = row[0] or 0
    if weeks < min_weeks:
        raise ValueError(f"{weeks} weeks of data, at least {min_weeks} are needed")
    return weekly


def moving_averages(weekly: DataFrame, widths: tuple[int, ...] = (1, 4, 12)) -> DataFrame:
    """Means over the last weeks; shorter at the start of a series."""
    return weekly.withColumns(
        {
            f"ma_{k}w": rounded(F.avg("revenue").over(_by_week().rowsBetween(1 - k, 0)), 4)
            for k in widths
        }
    )


def average_change(averaged: DataFrame, column: str = "ma_12w") -> DataFrame:
    """First and last value of a moving average and the change in percent."""
    return (
        averaged.where(F.col(column).isNotNull())
        .groupBy("series_key")
        .agg(
            F.min_by(column, "week_end").alias("first_value"),
            F.max_by(column, "week_end").alias("last_value"),
        )
        .withColumn(
            "change_pct",
            rounded(ratio(F.col("last_value") - F.col("first_value"), "first_value") * 100, 2),
        )
    )


def last_weeks(weekly: DataFrame, weeks: int) -> DataFrame:
    """The last weeks of each series."""
    back = F.row_number().over(W.partitionBy("series_key").orderBy(F.desc("week_end")))
    return weekly.withColumn("_back", back).where(F.col("_back") <= weeks).drop("_back")


def last_weeks_mean(weekly: DataFrame, weeks: int = 13) -> DataFrame:
    """Mean revenue of the last weeks of each series."""
    return (
        last_weeks(weekly, weeks)
        .groupBy("series_key")
        .agg(
            rounded(F.avg("revenue"), 2).alias("last_weeks_mean"),
            F.count(F.lit(1)).alias("weeks"),
        )
    )


def decompose(weekly: DataFrame, period: int = 4) -> DataFrame:
    """Trend, seasonal and residual part of each week.

    The trend is the centred moving average over one period (the two outermost
    weeks at half weight when the period is even); the seasonal part is the
    mean distance from the trend at the same phase, centred over the phases.
    Half a period at either end has no trend and no residual.
    """
    order = _by_week()
    half = period // 2
    full = F.count("revenue").over(order.rowsBetween(-half, half)) == 2 * half + 1
    inner = F.sum("revenue").over(order.rowsBetween(-half, half))
    if period % 2 == 0:
        ends = F.lag("revenue", half).over(order) + F.lead("revenue", half).over(order)
        trend = (inner - ends / 2) / period
    else:
        trend = inner / period
    with_trend = weekly.withColumns(
        {"index": F.row_number().over(order) - 1, "trend": F.when(full, trend)}
    ).withColumn("phase", F.col("index") % period)
    phase = W.partitionBy("series_key", "phase")
    series = W.partitionBy("series_key")
    phased = with_trend.withColumn(
        "phase_mean", F.avg(F.col("revenue") - F.col("trend")).over(phase)
    ).withColumn("phase_rank", F.row_number().over(phase.orderBy("week_end")))
    centre = F.avg(F.when(F.col("phase_rank") == 1, F.col("phase_mean"))).over(series)
    return (
        phased.withColumn("seasonal", F.col("phase_mean") - centre)
        .withColumn("residual", F.col("revenue") - F.col("trend") - F.col("seasonal"))
        .select("series_key", "week_end", "index", "revenue", "trend", "seasonal", "residual")
    )


def decomposition_summary(parts: DataFrame) -> DataFrame:
    """Strength of the season, slope of the trend and their labels per series."""
    covered = F.col("residual").isNotNull()
    noise = F.var_pop("residual")
    moving = F.var_pop(F.when(covered, F.col("seasonal") + F.col("residual")))
    strength = F.when(
        moving > 0, F.greatest(F.lit(0.0), 1 - noise / F.nullif(moving, F.lit(0.0)))
    ).otherwise(F.lit(0.0))
    slope = F.regr_slope(F.col("trend"), F.col("index").cast("double"))
    grouped = parts.groupBy("series_key").agg(
        strength.alias("strength"), slope.alias("slope"), F.avg("trend").alias("level")
    )
    weekly_pct = F.coalesce(ratio("slope", "level") * 100, F.lit(0.0))
    return grouped.select(
        "series_key",
        rounded("strength", 4).alias("seasonality_strength"),
        first_match(
            [(F.col("strength") > 0.4, "strong"), (F.col("strength") > 0.2, "moderate")], "weak"
        ).alias("seasonality"),
        F.when(F.col("slope") > 0, F.lit("upward")).otherwise(F.lit("downward")).alias(
            "trend_direction"
        ),
        rounded(weekly_pct, 3).alias("trend_pct_per_week"),
        rounded(weekly_pct * 52, 2).alias("trend_pct_per_year"),
    )


def _difference_model(weekly: DataFrame) -> DataFrame:
    """Least squares of each weekly change on the two changes before it, per series."""
    order = _by_week()
    changes = weekly.withColumn("y", F.col("revenue") - F.lag("revenue").over(order))
    lagged = changes.withColumns(
        {"y1": F.lag("y", 1).over(order), "y2": F.lag("y", 2).over(order)}
    )
    used = F.col("y2").isNotNull()
    y, y1, y2 = (F.when(used, F.col(c)) for c in ("y", "y1", "y2"))
    sums = lagged.groupBy("series_key").agg(
        F.max("week_end").alias("last_week"),
        F.max_by("revenue", "week_end").alias("last_revenue"),
        F.max_by("y", "week_end").alias("last_y"),
        F.max_by("y1", "week_end").alias("last_y1"),
        F.count(y).alias("n"),
        F.sum(y * y).alias("yy"),
        F.sum(y1 * y1).alias("s11"),
        F.sum(y2 * y2).alias("s22"),
        F.sum(y1 * y2).alias("s12"),
        F.sum(y * y1).alias("s1y"),
        F.sum(y * y2).alias("s2y"),
    )
    determinant = F.col("s11") * F.col("s22") - F.col("s12") * F.col("s12")
    solvable = (F.col("n") > 2) & (determinant > F.col("s11") * F.col("s22") * 1e-9)
    below = F.nullif(determinant, F.lit(0.0))
    a = (F.col("s1y") * F.col("s22") - F.col("s2y") * F.col("s12")) / below
    b = (F.col("s2y") * F.col("s11") - F.col("s1y") * F.col("s12")) / below
    fitted = sums.withColumn("solved", F.coalesce(solvable, F.lit(False))).withColumns(
        {
            "a": F.when(F.col("solved"), a).otherwise(F.lit(0.0)),
            "b": F.when(F.col("solved"), b).otherwise(F.lit(0.0)),
        }
    )
    explained = F.col("a") * F.col("s1y") + F.col("b") * F.col("s2y")
    squares = F.greatest(F.coalesce(F.col("yy") - explained, F.lit(0.0)), F.lit(0.0))
    return fitted.withColumn(
        "sigma", F.sqrt(squares / F.greatest(F.col("n") - 2, F.lit(1)))
    )


def forecast(weekly: DataFrame, weeks: int = 13, confidence: float = 0.95) -> DataFrame:
    """Weekly forecast with a band, never below zero.

    The changes from week to week follow a second-order autoregression; a
    series without usable changes keeps its last value. The band widens with
    the accumulated weights of the past shocks.
    """
    z = normal_quantile(0.5 + confidence / 2)
    zero, one = F.lit(0.0), F.lit(1.0)
    start = F.struct(
        F.col("last_revenue").alias("level"),
        F.coalesce("last_y", zero).alias("y"),
        F.coalesce("last_y1", zero).alias("y1"),
        zero.alias("psi"),
        zero.alias("psi1"),
        zero.alias("weight"),
        zero.alias("variance"),
        F.expr("CAST(array() AS array<struct<step:int,level:double,variance:double>>)").alias(
            "path"
        ),
    )

    def step(state: Column, k: Column) -> Column:
        y = F.col("a") * state["y"] + F.col("b") * state["y1"]
        psi = F.when(k == 1, one).otherwise(
            F.col("a") * state["psi"] + F.col("b") * state["psi1"]
        )
        weight = state["weight"] + psi
        level = state["level"] + y
        variance = state["variance"] + weight * weight
        point = F.struct(k.alias("step"), level.alias("level"), variance.alias("variance"))
        return F.struct(
            level.alias("level"),
            y.alias("y"),
            state["y"].alias("y1"),
            psi.alias("psi"),
            state["psi"].alias("psi1"),
            weight.alias("weight"),
            variance.alias("variance"),
            F.concat(state["path"], F.array(point)).alias("path"),
        )

    path = F.aggregate(F.sequence(F.lit(1), F.lit(weeks)), start, step, lambda s: s["path"])
    reach = F.lit(z) * F.col("sigma") * F.sqrt("variance")
    return (
        _difference_model(weekly)
        .withColumn("path", path)
        .select("series_key", "last_week", "sigma", "solved", F.inline("path"))
        .select(
            "series_key",
            F.date_add("last_week", F.col("step") * 7).alias("week_end"),
            rounded(F.greatest(F.col("level"), zero), 2).alias("yhat"),
            rounded(F.greatest(F.col("level") - reach, zero), 2).alias("yhat_lower"),
            rounded(F.col("level") + reach, 2).alias("yhat_upper"),
            F.when(F.col("solved"), F.lit("ARI(2,1)")).otherwise(F.lit("naive")).alias(
                "model_used"
            ),
        )
    )


def forecast_summary(weekly: DataFrame, predicted: DataFrame, recent: int = 13) -> DataFrame:
    """History and forecast side by side with the projected growth."""
    back = F.row_number().over(W.partitionBy("series_key").orderBy(F.desc("week_end")))
    history = (
        weekly.withColumn("_back", back)
        .groupBy("series_key")
        .agg(
            F.avg("revenue").alias("mean"),
            F.avg(F.when(F.col("_back") <= recent, F.col("revenue"))).alias("recent"),
        )
    )
    future = predicted.groupBy("series_key").agg(
        F.min("model_used").alias("model_used"),
        F.count(F.lit(1)).alias("forecast_weeks"),
        F.avg("yhat").alias("future"),
        F.sum("yhat").alias("total"),
        F.sum("yhat_lower").alias("low"),
        F.sum("yhat_upper").alias("high"),
    )
    growth = F.coalesce(
        F.when(
            F.col("recent") > 0,
            (F.col("future") - F.col("recent")) / F.nullif(F.col("recent"), F.lit(0.0)) * 100,
        ),
        F.lit(0.0),
    )
    weeks = F.col("forecast_weeks").cast("string")
    insight = (
        F.when(
            F.col("growth") > 5,
            F.concat(F.lit("grow "), percentage("growth"), F.lit(" over "), weeks,
                     F.lit(" weeks to "), dollars("total")),
        )
        .when(
            F.col("growth") < -5,
            F.concat(F.lit("decline "), percentage(F.abs("growth")), F.lit(" over "), weeks,
                     F.lit(" weeks")),
        )
        .otherwise(F.concat(F.lit("stable over "), weeks, F.lit(" weeks at "), dollars("total")))
    )
    return (
        history.join(future, "series_key")
        .withColumn("growth", growth)
        .select(
            "series_key",
            "model_used",
            "forecast_weeks",
            rounded("mean", 2).alias("historical_avg_weekly"),
            rounded("recent", 2).alias("last_13w_avg_weekly"),
            rounded("future", 2).alias("forecast_avg_weekly"),
            rounded("total", 2).alias("projected_total_revenue"),
            rounded("low", 2).alias("projected_lower_bound"),
            rounded("high", 2).alias("projected_upper_bound"),
            rounded("growth", 2).alias("growth_vs_last_quarter_pct"),
            first_match(
                [(F.col("growth") > 5, "grow"), (F.col("growth") < -5, "decline")], "stable"
            ).alias("outlook"),
            insight.alias("business_insight"),
        )
    )


def monthly_trend_forecast(
    monthly: DataFrame, months: int = 3, band: float = 0.15, min_months: int = 12
) -> DataFrame:
    """Straight-line forecast of monthly revenue; none with too few months.

    ``monthly`` holds one row per month. The change compares the forecast total
    with that of as many months before it.
    """
    everything = W.orderBy("month")
    numbered = monthly.withColumns(
        {
            "t": (F.row_number().over(everything) - 1).cast("double"),
            "back": F.row_number().over(W.orderBy(F.desc("month"))),
        }
    )
    fitted = numbered.agg(
        F.regr_slope("revenue", "t").alias("slope"),
        F.regr_intercept("revenue", "t").alias("intercept"),
        F.count(F.lit(1)).alias("n"),
        F.max("month").alias("last_month"),
        F.sum(F.when(F.col("back") <= months, F.col("revenue"))).alias("recent"),
    ).where(F.col("n") >= min_months)
    value = F.col("intercept") + F.col("slope") * (F.col("n") - 1 + F.col("step"))
    return (
        fitted.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(months))))
        .withColumn("value", value)
        .withColumn("total", F.sum("value").over(W.partitionBy()))
        .select(
            F.add_months("last_month", F.col("step")).alias("month"),
            rounded("value", 2).alias("forecast"),
            rounded(F.col("value") * (1 - band), 2).alias("lower"),
            rounded(F.col("value") * (1 + band), 2).alias("upper"),
            rounded("total", 2).alias("forecast_total"),
            rounded(ratio("total", "recent") * 100 - 100, 1).alias("change_pct"),
        )
    )


def week_of_month_profile(weekly: DataFrame) -> DataFrame:
    """Mean revenue by week of the month against the mean of these means."""
    series = W.partitionBy("series_key")
    means = weekly.groupBy(
        "series_key", week_of_month("week_end").alias("week_of_month")
    ).agg(F.avg("revenue").alias("mean"))
    overall = F.avg("mean").over(series)
    place = W.partitionBy("series_key").orderBy
    return means.select(
        "series_key",
        "week_of_month",
        rounded("mean", 2).alias("mean_revenue"),
        rounded(ratio(F.col("mean") - overall, overall) * 100, 2).alias("vs_avg_pct"),
        (F.row_number().over(place(F.desc("mean"), "week_of_month")) == 1).alias("is_best"),
        (F.row_number().over(place("mean", "week_of_month")) == 1).alias("is_worst"),
    )


def history_and_forecast(averaged: DataFrame, predicted: DataFrame) -> DataFrame:
    """Both in one table; columns only one side has are null on the other."""
    history = averaged.select(
        "series_key",
        F.col("week_end").alias("ds"),
        F.col("revenue").alias("yhat"),
        "n_orders",
        "avg_order_value",
        "ma_4w",
        "ma_12w",
        F.lit("historical").alias("data_type"),
    )
    future = predicted.withColumnRenamed("week_end", "ds").withColumn(
        "data_type", F.lit("forecast")
    )
    return history.unionByName(future, allowMissingColumns=True)
