"""Scoring, segment and cluster queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from clientele.functions.numeric import upper_edge_label
from clientele.functions.ordering import (
    Sample,
    Tiling,
    add_row_number,
    add_tiles,
    percentiles,
)
from clientele.operators import descriptive, rfm, scoring
from clientele.plans.customer_plans import scored
from clientele.plans.reference_sql import d, define, r, with_tables
from clientele.plans.registry import query
from clientele.sources.adapter import Tables
from clientele.sources.scratch import materialise


def _values_sql(offset: int, frequency: str = "count(*)") -> str:
    return f"""
    SELECT customer_id,
           CAST((SELECT max(order_date) FROM purchases) + {offset} - max(order_date) AS INTEGER)
               AS recency_days,
           {frequency} AS frequency, sum(order_amount) AS monetary,
           min(order_date) AS first_purchase, max(order_date) AS last_purchase,
           {r(f"{d('sum(order_amount)')} / count(*)", 2)} AS avg_order_value
    FROM purchases GROUP BY customer_id"""


define("rfm_raw", "purchases", _values_sql(1))
define("rfm_raw_same_day", "purchases", _values_sql(0, "count(DISTINCT order_id)"))
_COMPOSITE = r("r_score * 0.35::DOUBLE + f_score * 0.25::DOUBLE + m_score * 0.40::DOUBLE", 2)
define(
    "quantile_scores",
    "rfm_raw",
    f"""
    SELECT *, {_COMPOSITE} AS rfm_score FROM (
      SELECT v.customer_id, recency_days, frequency, monetary,
        CAST(CASE WHEN recency_days <= q[1] THEN 5 WHEN recency_days <= q[2] THEN 4
             WHEN recency_days <= q[3] THEN 3 WHEN recency_days <= q[4] THEN 2 ELSE 1 END
             AS INTEGER) AS r_score,
        CAST(1 + (f > 1 + (n - 1) // 5)::INT + (f > 1 + (n - 1) * 2 // 5)::INT
             + (f > 1 + (n - 1) * 3 // 5)::INT + (f > 1 + (n - 1) * 4 // 5)::INT AS INTEGER)
             AS f_score,
        CAST(1 + (m > 1 + (n - 1) // 5)::INT + (m > 1 + (n - 1) * 2 // 5)::INT
             + (m > 1 + (n - 1) * 3 // 5)::INT + (m > 1 + (n - 1) * 4 // 5)::INT AS INTEGER)
             AS m_score
      FROM (SELECT *, row_number() OVER (ORDER BY frequency, customer_id) AS f,
                   row_number() OVER (ORDER BY monetary, customer_id) AS m,
                   count(*) OVER () AS n FROM rfm_raw) v,
           (SELECT quantile_cont(CAST(recency_days AS DOUBLE), [0.2, 0.4, 0.6, 0.8]) AS q
            FROM rfm_raw))""",
)
define(
    "tile_scores",
    "rfm_raw_same_day",
    f"""
    SELECT *, {_COMPOSITE} AS rfm_score FROM (
      SELECT customer_id, last_purchase AS last_purchase_date, recency_days, frequency, monetary,
             CAST(6 - ntile(5) OVER (ORDER BY recency_days, customer_id) AS INTEGER) AS r_score,
             CAST(ntile(5) OVER (ORDER BY frequency, customer_id) AS INTEGER) AS f_score,
             CAST(ntile(5) OVER (ORDER BY monetary, customer_id) AS INTEGER) AS m_score
      FROM rfm_raw_same_day)""",
)
define(
    "segmented",
    "quantile_scores",
    """
    SELECT *, CASE
        WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'Champions'
        WHEN r_score >= 2 AND f_score >= 3 AND m_score >= 3 THEN 'Loyal Customers'
        WHEN r_score >= 3 AND f_score <= 3 AND m_score <= 3 THEN 'Potential Loyalists'
        WHEN r_score BETWEEN 2 AND 3 AND f_score >= 2 AND m_score >= 2 THEN 'At Risk'
        WHEN r_score <= 2 AND f_score <= 2 AND m_score <= 2 THEN 'Lost'
        ELSE 'Others' END AS segment
    FROM quantile_scores""",
)
_TILE_SEGMENT = """CASE
        WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'Champions'
        WHEN r_score >= 4 AND m_score >= 3 THEN 'Loyal Customers'
        WHEN r_score >= 3 AND f_score <= 2 THEN 'Potential Loyalists'
        WHEN r_score <= 2 AND m_score >= 3 THEN 'At Risk'
        WHEN r_score <= 2 AND f_score <= 2 AND m_score <= 2 THEN 'Lost'
        ELSE 'Others' END"""
_PRIORITY = """CASE WHEN r_score <= 2 AND m_score >= 3 THEN 'HIGH'
        WHEN r_score >= 4 AND f_score <= 2 THEN 'MEDIUM' ELSE 'STANDARD' END"""
define(
    "fine",
    "tile_scores",
    f"""
    SELECT *, {r('(r_score + f_score + m_score) / 3.0::DOUBLE', 2)} AS rfm_avg_score,
           CAST(r_score AS VARCHAR) || CAST(f_score AS VARCHAR) || CAST(m_score AS VARCHAR)
               AS rfm_cell,
           CASE WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'Champions'
                WHEN r_score >= 3 AND f_score >= 3 THEN 'Loyal Customers'
                WHEN r_score >= 4 AND f_score <= 2 THEN 'Recent Customers'
                WHEN r_score >= 3 AND f_score <= 2 AND m_score >= 3 THEN 'Potential Loyalists'
                WHEN r_score <= 2 AND f_score >= 4 THEN 'At-Risk'
                WHEN r_score <= 2 AND f_score >= 3 THEN 'Cannot Lose Them'
                WHEN r_score <= 2 AND f_score <= 2 AND m_score <= 2 THEN 'Lost'
                ELSE 'Needs Attention' END AS rfm_segment
    FROM tile_scores""",
)


def _money(df):
    return df.withColumn("monetary", F.col("monetary").cast("double"))


def tiled(t: Tables):
    return rfm.score_by_tiles(rfm.rfm_values(t.purchases, snapshot_offset=0, order_id="order_id"))


@query(
    "R1_rfm_values",
    with_tables("rfm_raw", f"SELECT * REPLACE ({d('monetary')} AS monetary) FROM rfm_raw"),
)
def _(t):
    return _money(rfm.rfm_values(t.purchases))


@query(
    "R2_rfm_values_same_day",
    with_tables(
        "rfm_raw_same_day",
        f"""SELECT customer_id, last_purchase AS last_purchase_date, recency_days, frequency,
            {d('monetary')} AS monetary FROM rfm_raw_same_day""",
    ),
)
def _(t):
    return _money(rfm.rfm_values(t.purchases, snapshot_offset=0, order_id="order_id")).select(
        "customer_id",
        F.col("last_purchase").alias("last_purchase_date"),
        "recency_days",
        "frequency",
        "monetary",
    )


@query(
    "R3_scores_by_quantile",
    with_tables(
        "quantile_scores",
        "SELECT customer_id, r_score, f_score, m_score, rfm_score FROM quantile_scores",
    ),
)
def _(t):
    return rfm.score_by_quantiles(rfm.rfm_values(t.purchases)).select(
        "customer_id", "r_score", "f_score", "m_score", "rfm_score"
    )


@query(
    "R4_scores_by_tile",
    with_tables("tile_scores", "SELECT customer_id, r_score, f_score, m_score FROM tile_scores"),
)
def _(t):
    return tiled(t).select("customer_id", "r_score", "f_score", "m_score")


@query(
    "W5_global_ntile",
    with_tables(
        "rfm_raw",
        """SELECT customer_id, CAST(ntile(10) OVER (ORDER BY monetary, customer_id) AS INTEGER)
           AS decile FROM rfm_raw""",
    ),
)
def _(t):
    base = materialise(rfm.rfm_values(t.purchases).select("customer_id", "monetary"))
    return add_tiles(base, "customer_id", [Tiling("monetary", "decile", 10)]).drop("monetary")


@query(
    "W8_first_come_rank",
    with_tables(
        "rfm_raw",
        """SELECT customer_id, frequency,
           row_number() OVER (ORDER BY frequency, customer_id) AS frequency_rank FROM rfm_raw""",
    ),
)
def _(t):
    base = materialise(rfm.rfm_values(t.purchases).select("customer_id", "frequency"))
    return add_row_number(base, "frequency", "customer_id", "frequency_rank")


@query(
    "W10_equal_frequency_bins",
    with_tables(
        "rfm_raw",
        f"""SELECT customer_id, CASE WHEN {d('monetary')} <= q[1] THEN 'Low'
            WHEN {d('monetary')} <= q[2] THEN 'Medium' ELSE 'High' END AS value_segment
            FROM rfm_raw, (SELECT quantile_cont({d('monetary')}, [1/3::DOUBLE, 2/3::DOUBLE]) AS q
                           FROM rfm_raw)""",
    ),
)
def _(t):
    base = materialise(
        _money(rfm.rfm_values(t.purchases)).select("customer_id", "monetary")
    )
    (edges,) = percentiles(base, [(Sample(F.col("monetary")), [1 / 3, 2 / 3])])
    label = upper_edge_label("monetary", edges, ["Low", "Medium", "High"])
    return base.select("customer_id", label.alias("value_segment"))


@query(
    "R5_composite_score",
    with_tables("tile_scores", "SELECT customer_id, rfm_score FROM tile_scores"),
)
def _(t):
    return tiled(t).select("customer_id", "rfm_score")


@query(
    "R6_box_segments",
    with_tables(
        "segmented",
        f"""SELECT customer_id, recency_days, frequency, {d('monetary')} AS monetary, r_score,
            f_score, m_score, rfm_score, segment FROM segmented""",
    ),
)
def _(t):
    return _money(rfm.segments(t.purchases)).select(
        "customer_id",
        "recency_days",
        "frequency",
        "monetary",
        "r_score",
        "f_score",
        "m_score",
        "rfm_score",
        "segment",
    )


@query(
    "R7_compact_segments",
    with_tables(
        "tile_scores",
        f"""SELECT * REPLACE ({d('monetary')} AS monetary), {_TILE_SEGMENT} AS segment,
            {_PRIORITY} AS retention_priority FROM tile_scores""",
    ),
)
def _(t):
    return _money(tiled(t)).select(
        "customer_id",
        F.col("last_purchase").alias("last_purchase_date"),
        "recency_days",
        "frequency",
        "monetary",
        "r_score",
        "f_score",
        "m_score",
        "rfm_score",
        rfm.compact_segment().alias("segment"),
        rfm.retention_priority().alias("retention_priority"),
    )


@query(
    "R8_fine_segment_summary",
    with_tables(
        "fine",
        f"""SELECT rfm_segment, count(*) AS customer_count,
            {r('avg(recency_days)', 1)} AS avg_recency_days, {r('avg(frequency)', 1)} AS avg_frequency,
            {r(f"{d('sum(monetary)')} / count(*)", 2)} AS avg_monetary,
            {d('sum(monetary)')} AS segment_revenue, {r('avg(rfm_avg_score)', 2)} AS avg_rfm_score
            FROM fine GROUP BY 1""",
    ),
)
def _(t):
    return rfm.fine_segment_summary(tiled(t))


@query(
    "R8_fine_segments",
    with_tables("fine", "SELECT customer_id, rfm_cell, rfm_avg_score, rfm_segment FROM fine"),
)
def _(t):
    return rfm.with_cell(tiled(t)).select(
        "customer_id", "rfm_cell", "rfm_avg_score", rfm.fine_segment().alias("rfm_segment")
    )


@query(
    "R9_retention_priority",
    with_tables(
        "tile_scores",
        f"""SELECT {_PRIORITY} AS retention_priority, count(*) AS customers,
            {d('sum(monetary)')} AS revenue FROM tile_scores GROUP BY 1""",
    ),
)
def _(t):
    return (
        tiled(t)
        .groupBy(rfm.retention_priority().alias("retention_priority"))
        .agg(
            F.count(F.lit(1)).alias("customers"),
            F.sum("monetary").cast("double").alias("revenue"),
        )
    )


def _text_case(column: str, pick) -> str:
    whens = " ".join(f"WHEN '{b.name}' THEN '{pick(b)}'" for b in rfm.BOXES)
    return f"CASE {column} {whens} END"


define(
    "impact",
    "segmented",
    f"""
    SELECT segment, count(*) AS n_customers, {d('sum(monetary)')} AS total_revenue,
           {r(f"{d('sum(monetary)')} / count(*)", 2)} AS avg_monetary,
           {r('avg(rfm_score)', 4)} AS avg_rfm_score, {r('avg(recency_days)', 2)} AS avg_recency,
           {r('avg(frequency)', 2)} AS avg_frequency,
           {r(f"{d('count(*)')} / sum(count(*)) OVER () * 100", 1)} AS pct_customers,
           {r(f"{d('sum(monetary)')} / {d('sum(sum(monetary)) OVER ()')} * 100", 1)} AS pct_revenue,
           {r(f"count(*) * (SELECT median({d('monetary')}) FROM segmented)", 0)}
               AS estimated_clv_at_risk,
           {_text_case('segment', lambda b: b.description)} AS description,
           {_text_case('segment', lambda b: b.action)} AS recommended_action
    FROM segmented GROUP BY segment""",
)


@query("R10_segment_impact", with_tables("impact", "SELECT * FROM impact"))
def _(t):
    return rfm.segment_impact(rfm.segments(t.purchases)).orderBy(F.desc("avg_rfm_score"))


@query(
    "R15_segment_loss_effect",
    with_tables(
        "impact",
        f"""SELECT segment, pct_revenue, {r('pct_revenue * 0.2::DOUBLE', 2)} AS revenue_lost_pct,
            {r('total_revenue * 0.2::DOUBLE', 2)} AS revenue_lost FROM impact""",
    ),
)
def _(t):
    return rfm.loss_effect(rfm.segment_impact(rfm.segments(t.purchases)))


@query(
    "R11_segment_scorecard",
    with_tables(
        "segmented customers",
        f"""SELECT segment, count(*) AS customers, {d('sum(monetary)')} AS revenue,
            {r('avg(rfm_score)', 4)} AS avg_rfm,
            {r(f"{d('sum(monetary)')} / count(*)", 2)} AS avg_monetary,
            {r(f"{d('count(*)')} / sum(count(*)) OVER () * 100", 1)} AS pct_customers,
            {r(f"{d('sum(monetary)')} / {d('sum(sum(monetary)) OVER ()')} * 100", 1)} AS pct_revenue
            FROM segmented LEFT JOIN customers USING (customer_id)
            WHERE customer_tier = 'Gold' GROUP BY segment""",
    ),
)
def _(t):
    return rfm.segment_scorecard(rfm.segments(t.purchases), t.demographics, tier="Gold")


@query(
    "P3_segment_filter",
    with_tables(
        "segmented",
        f"""SELECT customer_id, segment, {d('monetary')} AS monetary FROM segmented
            WHERE segment IN ('Champions', 'At Risk')""",
    ),
)
def _(t):
    kept = rfm.filtered_segments(rfm.segments(t.purchases), ["Champions", "At Risk"])
    return _money(kept).select("customer_id", "segment", "monetary")


@query(
    "J9_segments_with_profile",
    with_tables(
        "segmented customers engagement",
        f"""SELECT customer_id, segment, customer_tier, {d('clv')} AS clv, churned, weekly_visits
            FROM segmented LEFT JOIN customers USING (customer_id)
            LEFT JOIN engagement USING (customer_id)""",
    ),
)
def _(t):
    profile = t.customers.select(
        "customer_id", "customer_tier", F.col("clv").cast("double").alias("clv"), "churned"
    )
    visits = t.engagement.select("customer_id", "weekly_visits")
    return (
        rfm.segments(t.purchases)
        .select("customer_id", "segment")
        .join(profile, "customer_id", "left")
        .join(visits, "customer_id", "left")
    )


define(
    "economics",
    "segmented",
    f"""
    SELECT segment, count(*) AS n_customers, {d('sum(monetary)')} AS revenue,
           count(*) * 3.5::DOUBLE AS cost,
           {d('sum(monetary)')} * CAST({_text_case('segment', lambda b: b.retention_rate)} AS DOUBLE)
               AS protected
    FROM segmented GROUP BY 1""",
)


@query(
    "R12_action_economics",
    with_tables(
        "economics",
        f"""SELECT segment, CAST(n_customers AS BIGINT) AS n_customers, {r('revenue', 2)} AS revenue,
            {r('cost', 2)} AS cost, {r('protected', 2)} AS revenue_protected,
            {r('protected - cost', 2)} AS net_impact, {r('(protected - cost) / cost', 4)} AS roi
            FROM (SELECT * FROM economics UNION ALL
                  SELECT 'Campaign total', sum(n_customers), sum(revenue), sum(cost), sum(protected)
                  FROM economics
                  WHERE segment IN ('Champions', 'Loyal Customers', 'At Risk', 'Lost'))""",
    ),
)
def _(t):
    return rfm.action_economics(rfm.segments(t.purchases))


@query(
    "A16_score_matrix_customers",
    with_tables(
        "segmented",
        "SELECT r_score, "
        + ", ".join(f'count(*) FILTER (f_score = {k}) AS "{k}"' for k in range(1, 6))
        + " FROM segmented GROUP BY 1",
    ),
)
def _(t):
    return rfm.score_matrix(rfm.segments(t.purchases), "f_score", F.count(F.lit(1)))


@query(
    "A16_score_matrix_revenue",
    with_tables(
        "segmented",
        "SELECT r_score, "
        + ", ".join(
            f'{d(f"coalesce(sum(monetary) FILTER (m_score = {k}), 0)")} AS "{k}"'
            for k in range(1, 6)
        )
        + " FROM segmented GROUP BY 1",
    ),
)
def _(t):
    return rfm.score_matrix(
        rfm.segments(t.purchases), "m_score", F.sum("monetary").cast("double")
    )


define(
    "boxes",
    "segmented customers",
    f"""
    SELECT segment, {d('clv')} AS clv,
           quantile_cont({d('clv')}, 0.25) OVER (PARTITION BY segment) AS q1,
           quantile_cont({d('clv')}, 0.5) OVER (PARTITION BY segment) AS q2,
           quantile_cont({d('clv')}, 0.75) OVER (PARTITION BY segment) AS q3
    FROM segmented JOIN customers USING (customer_id)""",
)
_INSIDE = "clv BETWEEN q1 - (q3 - q1) * 1.5 AND q3 + (q3 - q1) * 1.5"


@query(
    "A27_value_box_by_segment",
    with_tables(
        "boxes",
        f"""SELECT segment, count(*) AS n, {r('max(q1)', 4)} AS q1, {r('max(q2)', 4)} AS median,
            {r('max(q3)', 4)} AS q3, min(clv) FILTER ({_INSIDE}) AS lower_whisker,
            max(clv) FILTER ({_INSIDE}) AS upper_whisker, count(*) FILTER (NOT ({_INSIDE})) AS outliers
            FROM boxes GROUP BY 1""",
    ),
)
def _(t):
    values = t.customers.select("customer_id", F.col("clv").cast("double").alias("clv"))
    enriched = materialise(
        rfm.segments(t.purchases).select("customer_id", "segment").join(values, "customer_id")
    )
    return descriptive.box_statistics(enriched, "segment", rfm.SEGMENTS, "clv")


@query(
    "M27_risk_value_quadrants",
    with_tables(
        "scored",
        f"""SELECT CASE WHEN churn_prob >= 0.5 THEN 'high risk' ELSE 'low risk' END AS risk_side,
            CASE WHEN clv >= (SELECT median({d('clv')}) FROM scored) THEN 'high value'
                 ELSE 'low value' END AS value_side,
            count(*) AS n, {d('sum(clv)')} AS clv FROM scored GROUP BY 1, 2""",
    ),
)
def _(t):
    return scoring.quadrants(materialise(scored(t).select("customer_id", "churn_prob", "clv")))


@query(
    "M24_value_by_risk",
    with_tables(
        "scored",
        f"""SELECT value_segment, risk_segment, count(*) AS customers,
            {r(f"{d('sum(clv)')} / count(*)", 2)} AS avg_clv,
            {r('avg(churn_prob)', 4)} AS avg_churn_prob,
            CASE WHEN risk_segment = 'High Risk' AND value_segment = 'High' THEN 'Call now'
                 WHEN risk_segment = 'High Risk' THEN 'Cheap win-back mail'
                 WHEN risk_segment = 'Medium Risk' AND value_segment = 'High' THEN 'Loyalty reward'
                 ELSE 'No action' END AS recommended_action
            FROM (SELECT *, CASE WHEN {d('clv')} <= q[1] THEN 'Low' WHEN {d('clv')} <= q[2]
                  THEN 'Medium' ELSE 'High' END AS value_segment
                  FROM scored, (SELECT quantile_cont({d('clv')}, [1/3::DOUBLE, 2/3::DOUBLE]) AS q
                                FROM scored))
            GROUP BY 1, 2""",
    ),
)
def _(t):
    return scoring.value_by_risk(
        materialise(scored(t).select("customer_id", "churn_prob", "risk_segment", "clv"))
    )


@query(
    "A16_value_risk_crosstab",
    with_tables(
        "scored",
        f"""SELECT customer_tier, {', '.join(
            f"count(*) FILTER (risk_segment = '{label}') AS " + '"' + label + '"'
            for label in ('Low Risk', 'Medium Risk', 'High Risk'))} FROM scored GROUP BY 1""",
    ),
)
def _(t):
    return (
        scored(t)
        .groupBy("customer_tier")
        .pivot("risk_segment", ["Low Risk", "Medium Risk", "High Risk"])
        .agg(F.count(F.lit(1)))
        .na.fill(0)
    )


@query("R13_kmeans_clusters")
def _(t):
    return rfm.kmeans_clusters(rfm.segments(t.purchases)).select(
        "customer_id", "segment", "kmeans_cluster", "kmeans_label"
    )


@query("R14_cluster_agreement")
def _(t):
    return rfm.cluster_agreement(rfm.kmeans_clusters(rfm.segments(t.purchases)))


_TIERS = ("Bronze", "Silver", "Gold", "Platinum")


@query(
    "A17_row_normalised_crosstab",
    with_tables(
        "segmented customers",
        "SELECT segment, "
        + ", ".join(
            r(d(f"count(*) FILTER (customer_tier = '{tier}')") + " / count(*) * 100", 1) + f' AS "{tier}"'
            for tier in _TIERS
        )
        + " FROM segmented JOIN customers USING (customer_id) GROUP BY 1",
    ),
)
def _(t):
    tiers = t.demographics.select("customer_id", "customer_tier")
    return rfm.row_shares(rfm.segments(t.purchases).join(tiers, "customer_id"), "segment", "customer_tier", _TIERS)
