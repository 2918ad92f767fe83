import datetime
import random

import pytest

from clientele.operators import rfm


@pytest.fixture(scope="module")
def purchases(spark):
    rng = random.Random(42)
    rows = [
        (i, 1 + rng.randrange(60), datetime.date(2023, 1, 1) + datetime.timedelta(days=3 * (i % 120)),
         round(rng.uniform(10, 500), 2))
        for i in range(400)
    ]
    return spark.createDataFrame(
        rows, "order_id long, customer_id long, order_date date, order_amount double"
    ).selectExpr("order_id", "customer_id", "order_date", "CAST(order_amount AS DECIMAL(18,2)) order_amount")


@pytest.fixture(scope="module")
def segmented(purchases):
    return rfm.segments(purchases).cache()


def test_values(purchases):
    rows = rfm.rfm_values(purchases).collect()
    assert len(rows) == purchases.select("customer_id").distinct().count()
    assert all(r.recency_days >= 1 and r.frequency >= 1 and r.monetary > 0 for r in rows)
    assert min(r.recency_days for r in rows) == 1
    assert sum(r.frequency for r in rows) == 400


def test_given_snapshot(purchases):
    rows = rfm.rfm_values(purchases, "2024-12-31").collect()
    for r in rows:
        assert r.recency_days == (datetime.date(2024, 12, 31) - r.last_purchase).days


def test_missing_column(purchases):
    with pytest.raises(ValueError, match="order_amount"):
        rfm.rfm_values(purchases.drop("order_amount"))


def test_other_column_names(purchases):
    renamed = purchases.selectExpr("customer_id who", "order_date day", "order_amount paid")
    got = rfm.rfm_values(renamed, customer_id="who", date="day", amount="paid")
    assert got.count() == rfm.rfm_values(purchases).count()


def test_scores_in_range_and_composite(segmented):
    for r in segmented.collect():
        for s in (r.r_score, r.f_score, r.m_score):
            assert 1 <= s <= 5
        weighted = 0.35 * r.r_score + 0.25 * r.f_score + 0.40 * r.m_score
        assert r.rfm_score == pytest.approx(weighted, abs=0.006)
    recent = [r.r_score for r in segmented.collect() if r.recency_days == 1]
    assert all(s == 5 for s in recent)


def test_all_segments_are_known(segmented):
    assert {r.segment for r in segmented.collect()} <= set(rfm.SEGMENTS)


@pytest.mark.parametrize(
    "scores,box,compact,fine",
    [
        ((5, 5, 5), "Champions", "Champions", "Champions"),
        ((4, 3, 3), "Loyal Customers", "Loyal Customers", "Loyal Customers"),
        ((5, 1, 1), "Potential Loyalists", "Potential Loyalists", "Recent Customers"),
        ((2, 2, 4), "At Risk", "At Risk", "Needs Attention"),
        ((1, 1, 1), "Lost", "Lost", "Lost"),
        ((1, 5, 5), "Others", "At Risk", "At-Risk"),
        ((2, 3, 2), "At Risk", "Others", "Cannot Lose Them"),
        ((3, 2, 4), "At Risk", "Potential Loyalists", "Potential Loyalists"),
    ],
)
def test_rule_sets(spark, scores, box, compact, fine):
    row = (
        spark.createDataFrame([scores], "r_score int, f_score int, m_score int")
        .select(
            rfm.box_segment().alias("box"),
            rfm.compact_segment().alias("compact"),
            rfm.fine_segment().alias("fine"),
        )
        .first()
    )
    assert tuple(row) == (box, compact, fine)


def test_impact_adds_up(segmented):
    rows = rfm.segment_impact(segmented).collect()
    assert sum(r.n_customers for r in rows) == segmented.count()
    assert abs(sum(r.pct_customers for r in rows) - 100) <= 0.5
    assert abs(sum(r.pct_revenue for r in rows) - 100) <= 0.5
    assert all(r.description and r.recommended_action for r in rows)
    given = rfm.segment_impact(segmented, 10.0).collect()
    assert all(r.estimated_clv_at_risk == r.n_customers * 10 for r in given)


def test_economics(segmented):
    rows = {r.segment: r for r in rfm.action_economics(segmented).collect()}
    total = rows.pop("Campaign total")
    assert total.cost == pytest.approx(
        sum(rows[s].cost for s in rfm.CAMPAIGN_SEGMENTS if s in rows)
    )
    for r in rows.values():
        assert r.cost == pytest.approx(3.5 * r.n_customers)


def test_clusters(segmented):
    clustered = rfm.kmeans_clusters(segmented, restarts=3)
    rows = clustered.collect()
    assert len(rows) == segmented.count()
    assert {r.kmeans_label for r in rows} == set(rfm.CLUSTER_LABELS)
    means = {}
    for r in rows:
        means.setdefault(r.kmeans_label, []).append(r.rfm_score)
    levels = [sum(means[name]) / len(means[name]) for name in rfm.CLUSTER_LABELS]
    assert levels == sorted(levels)
    for r in rfm.cluster_agreement(clustered).collect():
        assert abs(sum(r[name] for name in rfm.CLUSTER_LABELS) - 100) <= 0.3
    with pytest.raises(ValueError):
        rfm.kmeans_clusters(segmented, k=9)
