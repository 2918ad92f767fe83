import datetime

import pytest

from clientele.operators import cohort

D = datetime.date


@pytest.fixture(scope="module")
def customers(spark):
    return spark.createDataFrame(
        [(1, D(2023, 1, 31)), (2, D(2023, 1, 5)), (3, D(2023, 2, 1)), (4, None)],
        "customer_id long, signup_date date",
    )


@pytest.fixture(scope="module")
def purchases(spark):
    """One buys before signup, one skips a month, one never buys; one buyer is unknown."""
    rows = [
        (1, D(2022, 12, 30), 99), (1, D(2023, 1, 31), 10), (1, D(2023, 2, 1), 30),
        (1, D(2023, 2, 20), 10), (2, D(2023, 1, 9), 10), (2, D(2023, 3, 9), 5),
        (4, D(2023, 1, 9), 7), (77, D(2023, 1, 9), 7),
    ]
    return spark.createDataFrame(
        rows, "customer_id long, order_date date, order_amount int"
    ).selectExpr("customer_id", "order_date", "CAST(order_amount AS DECIMAL(18,2)) order_amount")


@pytest.fixture(scope="module")
def totals(customers, purchases):
    return cohort.cohort_totals(cohort.signup_activity(customers, purchases))


def test_signup_activity(customers, purchases):
    rows = cohort.signup_activity(customers, purchases).collect()
    assert {(r.customer_id, r.period_number, r.orders) for r in rows} == {
        (1, 0, 1), (1, 1, 2), (2, 0, 1), (2, 2, 1),
    }


def test_retention(totals):
    rows = {r.period_number: r for r in cohort.retention(totals).collect()}
    assert {p: r.retention_rate for p, r in rows.items()} == {0: 1.0, 1: 0.5, 2: 0.5}
    assert all(r.cohort_size == 2 for r in rows.values())


def test_revenue_retention(totals):
    rows = {r.period_number: r.revenue_retention for r in cohort.revenue_retention(totals).collect()}
    assert rows == {0: 1.0, 1: 2.0, 2: 0.25}


def test_matrix_has_every_period_and_holes(spark):
    rates = spark.createDataFrame(
        [(D(2023, 1, 1), 0, 1.0), (D(2023, 1, 1), 97, 0.5), (D(2023, 2, 1), 0, 1.0), (D(2023, 2, 1), 3, 0.25)],
        "cohort_month date, period_number int, retention_rate double",
    )
    out = cohort.matrix(rates, "retention_rate")
    assert out.columns == ["cohort_month", "0", "3", "97"]
    rows = {r.cohort_month.month: tuple(r)[1:] for r in out.collect()}
    assert rows == {1: (1.0, None, 0.5), 2: (1.0, 0.25, None)}


def test_no_rate_without_period_zero(spark):
    totals = spark.createDataFrame(
        [(D(2023, 1, 1), 1, 3, 5)], "cohort_month date, period_number int, active_customers long, amount int"
    )
    assert cohort.retention(totals).first().retention_rate is None
    assert cohort.checkpoints(cohort.retention(totals)).count() == 0


def test_top_and_bottom_falls_back_to_last_period(totals):
    rates = cohort.retention(totals)
    at = cohort.top_and_bottom(rates, n=1, at_period=1).collect()
    assert {(r.side, r.retention_rate, r.mean_rate) for r in at} == {
        ("top", 0.5, 0.5), ("bottom", 0.5, 0.5),
    }
    assert {r.period_number for r in cohort.top_and_bottom(rates, at_period=9).collect()} == {2}


def test_checkpoints_average_skips_missing(totals):
    row = cohort.checkpoints(cohort.retention(totals)).first()
    assert (row.retention_m1, row.retention_m3, row.avg_retention_m1_m6) == (0.5, None, 0.5)


def test_first_purchase_cohorts(purchases):
    activity = cohort.first_purchase_activity(purchases)
    rows = {
        (r.cohort_month, r.period_number): r.retention_rate_pct
        for r in cohort.retention_percent(cohort.cohort_totals(activity)).collect()
    }
    assert rows[D(2022, 12, 1), 0] == 100.0
    assert rows[D(2022, 12, 1), 2] == 100.0
    assert rows[D(2023, 1, 1), 2] == pytest.approx(33.33)


def test_signups_as_denominator(customers, purchases):
    activity = cohort.signup_activity(customers, purchases)
    rows = cohort.signup_retention(customers.where("signup_date IS NOT NULL"), activity).collect()
    assert {(r.period_number, r.signups, r.retention_rate) for r in rows} == {
        (0, 2, 1.0), (1, 2, 0.5), (2, 2, 0.5),
    }
    (means,) = cohort.milestone_means(
        cohort.signup_retention(customers, activity)
    ).collect()
    assert means.month_1 == 50.0 and means.month_3 is None


def test_missing_columns(customers, purchases):
    with pytest.raises(ValueError, match="signup_date"):
        cohort.signup_activity(customers.drop("signup_date"), purchases)
    with pytest.raises(ValueError, match="order_date"):
        cohort.signup_activity(customers, purchases.drop("order_date"))
