import datetime
import math

import pytest

from clientele.operators import forecast

D = datetime.date


def orders(spark, rows):
    return spark.createDataFrame(
        rows, "k string, order_date date, order_amount double"
    ).selectExpr("k", "order_date", "CAST(order_amount AS DECIMAL(18,2)) order_amount")


def series(spark, values, key="all", start=D(2023, 1, 2)):
    rows = [(key, start + datetime.timedelta(weeks=i), float(v), 1) for i, v in enumerate(values)]
    return spark.createDataFrame(
        rows, "series_key string, week_end date, revenue double, n_orders long"
    )


def test_week_closes_on_monday_and_gaps_are_zero(spark):
    rows = [
        ("a", D(2023, 1, 2), 5.0),
        ("a", D(2023, 1, 3), 7.0),
        ("a", D(2023, 1, 9), 1.0),
        ("a", D(2023, 1, 24), 2.0),
    ]
    got = [(r.week_end, r.revenue, r.n_orders, r.avg_order_value)
           for r in forecast.weekly_series(orders(spark, rows)).orderBy("week_end").collect()]
    assert got == [
        (D(2023, 1, 2), 5.0, 1, 5.0),
        (D(2023, 1, 9), 8.0, 2, 4.0),
        (D(2023, 1, 16), 0.0, 0, None),
        (D(2023, 1, 23), 0.0, 0, None),
        (D(2023, 1, 30), 2.0, 1, 2.0),
    ]
    complete = forecast.weekly_series(orders(spark, rows), drop_partial_last=True)
    assert complete.agg({"week_end": "max"}).first()[0] == D(2023, 1, 9)


def test_short_series(spark):
    weekly = series(spark, range(5)).unionByName(series(spark, range(9), "long"))
    assert {r.series_key for r in forecast.long_enough(weekly).collect()} == {"long"}
    assert forecast.require_weeks(weekly) is weekly
    with pytest.raises(ValueError, match="5 weeks"):
        forecast.require_weeks(weekly.where("series_key = 'all'"))


def test_moving_averages(spark):
    got = forecast.moving_averages(series(spark, [2, 4, 6, 8, 10])).orderBy("week_end").collect()
    assert [r.ma_1w for r in got] == [2, 4, 6, 8, 10]
    assert [r.ma_4w for r in got] == [2, 3, 4, 5, 7]
    assert forecast.average_change(forecast.moving_averages(series(spark, [2, 4])), "ma_1w").first()[
        "change_pct"
    ] == 100.0


def test_decomposition_recovers_trend_and_season(spark):
    season = [5.0, -1.0, -5.0, 1.0]
    values = [100 + 2 * i + season[i % 4] for i in range(40)]
    parts = forecast.decompose(series(spark, values)).orderBy("week_end").collect()
    for i, r in enumerate(parts[2:-2], start=2):
        assert r.trend == pytest.approx(100 + 2 * i)
        assert r.seasonal == pytest.approx(season[i % 4])
        assert r.residual == pytest.approx(0, abs=1e-9)
    assert parts[0].trend is None and parts[-1].residual is None
    summary = forecast.decomposition_summary(forecast.decompose(series(spark, values))).first()
    assert summary.seasonality_strength == 1.0 and summary.seasonality == "strong"
    assert summary.trend_direction == "upward"
    assert summary.trend_pct_per_week == pytest.approx(200 / 139, abs=0.001)


def brute_forecast(values, weeks):
    d = [b - a for a, b in zip(values, values[1:])]
    rows = list(zip(d[2:], d[1:], d))
    s11, s22 = sum(x * x for _, x, _ in rows), sum(z * z for _, _, z in rows)
    s12 = sum(x * z for _, x, z in rows)
    s1y, s2y = sum(y * x for y, x, _ in rows), sum(y * z for y, _, z in rows)
    det = s11 * s22 - s12 * s12
    a, b = (s1y * s22 - s2y * s12) / det, (s2y * s11 - s1y * s12) / det
    level, y, y1, out = values[-1], d[-1], d[-2], []
    for _ in range(weeks):
        y, y1 = a * y + b * y1, y
        level += y
        out.append(max(level, 0.0))
    return out


def test_forecast_equals_brute_force(spark):
    values = [100 + 10 * math.sin(i * 1.3) + 3 * math.cos(i * i) + i for i in range(60)]
    got = forecast.forecast(series(spark, values), 6).orderBy("week_end").collect()
    assert [r.yhat for r in got] == pytest.approx(brute_forecast(values, 6), abs=0.01)
    assert all(r.yhat_lower <= r.yhat <= r.yhat_upper for r in got)
    widths = [r.yhat_upper - r.yhat for r in got]
    assert widths[-1] > widths[0] and {r.model_used for r in got} == {"ARI(2,1)"}
    assert got[0].week_end == D(2023, 1, 2) + datetime.timedelta(weeks=60)


@pytest.mark.parametrize("values", [[50] * 10, [5], [5, 6, 7]])
def test_series_without_usable_changes_keeps_its_last_value(spark, values):
    got = forecast.forecast(series(spark, values), 3).collect()
    assert len(got) == 3
    assert {(r.yhat, r.model_used) for r in got} == {(float(values[-1]), "naive")}


def test_forecast_never_below_zero(spark):
    got = forecast.forecast(series(spark, [100, 90, 60, 55, 20, 11, 3, 1, 0]), 13).collect()
    assert all(r.yhat >= 0 and r.yhat_lower >= 0 for r in got)


def test_summary(spark):
    weekly = series(spark, [100 + (i * 37) % 11 for i in range(30)])
    predicted = forecast.forecast(weekly)
    row = forecast.forecast_summary(weekly, predicted).first()
    assert row.forecast_weeks == 13
    assert row.projected_total_revenue == pytest.approx(row.forecast_avg_weekly * 13, abs=0.1)
    assert row.outlook == "stable" and row.business_insight.startswith("stable")
    combined = forecast.history_and_forecast(forecast.moving_averages(
        weekly.selectExpr("*", "revenue AS avg_order_value")), predicted)
    assert combined.count() == 43


def test_monthly_trend(spark):
    rows = [(D(2022 + i // 12, i % 12 + 1, 1), 100.0 + 10 * i) for i in range(14)]
    monthly = spark.createDataFrame(rows, "month date, revenue double")
    got = forecast.monthly_trend_forecast(monthly).orderBy("month").collect()
    assert [r.forecast for r in got] == [240.0, 250.0, 260.0]
    assert got[0].month == D(2023, 3, 1)
    assert (got[0].lower, got[0].upper) == (204.0, 276.0)
    assert forecast.monthly_trend_forecast(monthly.limit(5)).count() == 0
