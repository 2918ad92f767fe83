"""Recency, frequency and monetary scoring, segments and their impact."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clientele.functions.numeric import (
    first_match,
    money_sum,
    percent,
    ratio,
    rounded,
    upper_edge_label,
)
from clientele.functions.ordering import (
    Sample,
    Tiling,
    add_tiles,
    percentiles,
    rank_quantile_ends,
)
from clientele.functions.text import score_cell
from clientele.sources.scratch import materialise
from clientele.sources.schemas import require_columns

WEIGHTS = (("r_score", 0.35), ("f_score", 0.25), ("m_score", 0.40))


@dataclass(frozen=True)
class Box:
    """A segment as ranges of the three scores, with its texts."""

    name: str
    recency: tuple[int, int]
    frequency: tuple[int, int]
    monetary: tuple[int, int]
    description: str
    action: str
    retention_rate: float

    def rule(self) -> Column:
        r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
        return (
            r.between(*self.recency) & f.between(*self.frequency) & m.between(*self.monetary)
        )


# The score ranges, names and retention rates decide the results.
BOXES = (
    Box("Champions", (4, 5), (4, 5), (4, 5), "High on all three scores", "Give early access", 0.95),
    Box("Loyal Customers", (2, 5), (3, 5), (3, 5), "Frequent and well spending", "Upsell", 0.88),
    Box("Potential Loyalists", (3, 5), (1, 3), (1, 3), "Recent, still small", "Invite to the club", 0.60),
    Box("At Risk", (2, 3), (2, 5), (2, 5), "Bought well, going quiet", "Win back with an offer", 0.30),
    Box("Lost", (1, 2), (1, 2), (1, 2), "Low on all three scores", "One last cheap offer", 0.12),
    Box("Others", (1, 5), (1, 5), (1, 5), "No clear pattern", "Keep informed", 0.40),
)
SEGMENTS = tuple(box.name for box in BOXES)
CAMPAIGN_COST = 3.50
CAMPAIGN_SEGMENTS = ("Champions", "Loyal Customers", "At Risk", "Lost")
CLUSTER_LABELS = ("Low Value", "Mid Value", "High Value", "Premium")


def rfm_values(
    purchases: DataFrame,
    snapshot: Column | str | None = None,
    snapshot_offset: int = 1,
    customer_id: str = "customer_id",
    date: str = "order_date",
    amount: str = "order_amount",
    order_id: str | None = None,
) -> DataFrame:
    """Recency, frequency, monetary, first and last purchase per customer.

    Frequency counts rows, or distinct orders where ``order_id`` names a column.
    The snapshot defaults to the last order date plus ``snapshot_offset`` days.
    """
    require_columns(purchases, [customer_id, date, amount])
    if snapshot is None:
        day = F.date_add(purchases.agg(F.max(date)).scalar(), snapshot_offset)
    else:
        day = F.lit(snapshot).cast("date") if isinstance(snapshot, str) else snapshot
    keys = [F.col(customer_id).alias("customer_id")]
    counted = F.lit(1).alias("order") if order_id is None else F.col(order_id).alias("order")
    per_customer = (
        purchases.groupBy(*keys, counted)
        .agg(
            F.count(F.lit(1)).alias("rows"),
            money_sum(amount).alias("monetary"),
            F.min(date).alias("first_purchase"),
            F.max(date).alias("last_purchase"),
        )
        .groupBy("customer_id")
        .agg(
            F.sum("rows").alias("rows"),
            F.count("order").alias("orders"),
            F.sum("monetary").alias("monetary"),
            F.min("first_purchase").alias("first_purchase"),
            F.max("last_purchase").alias("last_purchase"),
        )
        .withColumn("frequency", F.col("rows" if order_id is None else "orders"))
    )
    return per_customer.select(
        "customer_id",
        F.datediff(day, F.col("last_purchase")).alias("recency_days"),
        "frequency",
        "monetary",
        "first_purchase",
        "last_purchase",
        rounded(ratio("monetary", "rows"), 2).alias("avg_order_value"),
    )


def composite(digits: int = 2) -> Column:
    weighted = sum((F.col(c) * F.lit(w) for c, w in WEIGHTS), F.lit(0.0))
    return rounded(weighted, digits)


def score_by_quantiles(rfm: DataFrame, bins: int = 5) -> DataFrame:
    """Scores from quantile edges: recency by value, the others by first-come rank.

    Recency keeps equal values together; frequency and monetary break ties by
    customer, so their bins have equal size.
    """
    base = materialise(rfm)
    probabilities = [k / bins for k in range(1, bins)]
    (edges,) = percentiles(base, [(Sample(F.col("recency_days")), probabilities)])
    labels = list(range(bins, 0, -1))
    scored = base.withColumn("r_score", upper_edge_label("recency_days", edges, labels))
    tiled = add_tiles(
        scored,
        "customer_id",
        [
            Tiling("frequency", "f_score", bins, ends=rank_quantile_ends),
            Tiling("monetary", "m_score", bins, ends=rank_quantile_ends),
        ],
    )
    return tiled.withColumn("rfm_score", composite())


def score_by_tiles(rfm: DataFrame, tiles: int = 5) -> DataFrame:
    """Scores from equal-size tiles of all three values; small recency scores high."""
    tiled = add_tiles(
        materialise(rfm),
        "customer_id",
        [
            Tiling("recency_days", "r_score", tiles, descending_label=True),
            Tiling("frequency", "f_score", tiles),
            Tiling("monetary", "m_score", tiles),
        ],
    )
    return tiled.withColumn("rfm_score", composite())


def box_segment() -> Column:
    """The first box that holds the three scores."""
    return first_match([(b.rule(), b.name) for b in BOXES[:-1]], BOXES[-1].name)


def compact_segment() -> Column:
    """Six segments that look at recency first."""
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    return first_match(
        [
            ((r >= 4) & (f >= 4) & (m >= 4), "Champions"),
            ((r >= 4) & (m >= 3), "Loyal Customers"),
            ((r >= 3) & (f <= 2), "Potential Loyalists"),
            ((r <= 2) & (m >= 3), "At Risk"),
            ((r <= 2) & (f <= 2) & (m <= 2), "Lost"),
        ],
        "Others",
    )


def fine_segment() -> Column:
    """Eight segments."""
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    return first_match(
        [
            ((r >= 4) & (f >= 4) & (m >= 4), "Champions"),
            ((r >= 3) & (f >= 3), "Loyal Customers"),
            ((r >= 4) & (f <= 2), "Recent Customers"),
            ((r >= 3) & (f <= 2) & (m >= 3), "Potential Loyalists"),
            ((r <= 2) & (f >= 4), "At-Risk"),
            ((r <= 2) & (f >= 3), "Cannot Lose Them"),
            ((r <= 2) & (f <= 2) & (m <= 2), "Lost"),
        ],
        "Needs Attention",
    )


def retention_priority() -> Column:
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    return first_match(
        [((r <= 2) & (m >= 3), "HIGH"), ((r >= 4) & (f <= 2), "MEDIUM")], "STANDARD"
    )


def fine_segment_summary(scored: DataFrame) -> DataFrame:
    """Size, means and revenue of the eight segments."""
    mean_score = rounded((F.col("r_score") + F.col("f_score") + F.col("m_score")) / 3.0, 2)
    return (
        scored.withColumns({"rfm_segment": fine_segment(), "score": mean_score})
        .groupBy("rfm_segment")
        .agg(
            F.count(F.lit(1)).alias("customer_count"),
            rounded(F.avg("recency_days"), 1).alias("avg_recency_days"),
            rounded(F.avg("frequency"), 1).alias("avg_frequency"),
            rounded(ratio(F.sum("monetary"), F.count(F.lit(1))), 2).alias("avg_monetary"),
            F.sum("monetary").cast("double").alias("segment_revenue"),
            rounded(F.avg("score"), 2).alias("avg_rfm_score"),
        )
    )


def with_cell(scored: DataFrame) -> DataFrame:
    """The three scores as one text and their plain mean."""
    return scored.withColumns(
        {
            "rfm_cell": score_cell("r_score", "f_score", "m_score"),
            "rfm_avg_score": rounded(
                (F.col("r_score") + F.col("f_score") + F.col("m_score")) / 3.0, 2
            ),
        }
    )


def segment_texts() -> Column:
    """Description, action and retention rate of a segment, as a constant map."""
    entries = []
    for box in BOXES:
        entries += [
            F.lit(box.name),
            F.struct(
                F.lit(box.description).alias("description"),
                F.lit(box.action).alias("action"),
                F.lit(box.retention_rate).alias("rate"),
            ),
        ]
    return F.create_map(*entries)


def segment_impact(segmented: DataFrame, value_per_customer: float | None = None) -> DataFrame:
    """Customers, revenue, shares and value at risk per segment.

    Without a value per customer the exact median of monetary is used. One row
    per segment is left when the totals are formed.
    """
    if value_per_customer is None:
        segmented = materialise(segmented)
        ((value_per_customer,),) = percentiles(segmented, [(Sample(F.col("monetary")), [0.5])])
    everything = W.partitionBy()
    texts = F.try_element_at(segment_texts(), F.col("segment"))
    grouped = segmented.groupBy("segment").agg(
        F.count(F.lit(1)).alias("n_customers"),
        F.sum("monetary").alias("amount"),
        F.avg("rfm_score").alias("score"),
        F.avg("recency_days").alias("recency"),
        F.avg("frequency").alias("freq"),
    )
    return grouped.select(
        "segment",
        "n_customers",
        F.col("amount").cast("double").alias("total_revenue"),
        rounded(ratio("amount", "n_customers"), 2).alias("avg_monetary"),
        rounded("score", 4).alias("avg_rfm_score"),
        rounded("recency", 2).alias("avg_recency"),
        rounded("freq", 2).alias("avg_frequency"),
        percent("n_customers", F.sum("n_customers").over(everything), 1).alias("pct_customers"),
        percent("amount", F.sum("amount").over(everything), 1).alias("pct_revenue"),
        rounded(F.col("n_customers") * F.lit(value_per_customer), 0).alias(
            "estimated_clv_at_risk"
        ),
        texts.description.alias("description"),
        texts.action.alias("recommended_action"),
    )


def segment_scorecard(
    segmented: DataFrame, customers: DataFrame, segment: str = "All", tier: str = "All"
) -> DataFrame:
    """Size, revenue and shares after an optional segment and tier filter."""
    enriched = segmented.join(
        customers.select("customer_id", "customer_tier"), "customer_id", "left"
    )
    if segment != "All":
        enriched = enriched.where(F.col("segment") == segment)
    if tier != "All":
        enriched = enriched.where(F.col("customer_tier") == tier)
    everything = W.partitionBy()
    return (
        enriched.groupBy("segment")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            F.sum("monetary").alias("amount"),
            rounded(F.avg("rfm_score"), 4).alias("avg_rfm"),
        )
        .select(
            "segment",
            "customers",
            F.col("amount").cast("double").alias("revenue"),
            "avg_rfm",
            rounded(ratio("amount", "customers"), 2).alias("avg_monetary"),
            percent("customers", F.sum("customers").over(everything), 1).alias("pct_customers"),
            percent("amount", F.sum("amount").over(everything), 1).alias("pct_revenue"),
        )
    )


def action_economics(segmented: DataFrame, cost_per_customer: float = CAMPAIGN_COST) -> DataFrame:
    """Campaign cost, revenue protected and return per segment, and for the campaign set."""
    rate = F.try_element_at(segment_texts(), F.col("segment")).rate
    per_segment = (
        segmented.groupBy("segment")
        .agg(F.count(F.lit(1)).alias("n_customers"), F.sum("monetary").alias("amount"))
        .select(
            "segment",
            "n_customers",
            F.col("amount").cast("double").alias("revenue"),
            (F.col("n_customers") * F.lit(cost_per_customer)).alias("cost"),
            (rate * F.col("amount").cast("double")).alias("protected"),
        )
    )
    total = (
        per_segment.where(F.col("segment").isin(list(CAMPAIGN_SEGMENTS)))
        .agg(
            F.sum("n_customers").alias("n_customers"),
            F.sum("revenue").alias("revenue"),
            F.sum("cost").alias("cost"),
            F.sum("protected").alias("protected"),
        )
        .select(F.lit("Campaign total").alias("segment"), "*")
    )
    return per_segment.unionByName(total).select(
        "segment",
        "n_customers",
        rounded("revenue", 2).alias("revenue"),
        rounded("cost", 2).alias("cost"),
        rounded("protected", 2).alias("revenue_protected"),
        rounded(F.col("protected") - F.col("cost"), 2).alias("net_impact"),
        rounded(ratio(F.col("protected") - F.col("cost"), "cost"), 4).alias("roi"),
    )


def loss_effect(impact: DataFrame, lost_share: float = 0.20) -> DataFrame:
    """Percentage points of all revenue gone when a share of a segment leaves."""
    return impact.select(
        "segment",
        "pct_revenue",
        rounded(F.col("pct_revenue") * lost_share, 2).alias("revenue_lost_pct"),
        rounded(F.col("total_revenue") * lost_share, 2).alias("revenue_lost"),
    )


def score_matrix(segmented: DataFrame, columns: str, aggregate: Column, scores: int = 5) -> DataFrame:
    """Recency score against another score; combinations without customers are zero."""
    return (
        segmented.groupBy("r_score")
        .pivot(columns, list(range(1, scores + 1)))
        .agg(aggregate)
        .na.fill(0)
    )


def kmeans_clusters(
    scored: DataFrame, k: int = 4, seed: int = 42, restarts: int = 10
) -> DataFrame:
    """K-means on the standardised scores; clusters are labelled by mean composite.

    With five scores a side there are at most 125 different points. They are
    clustered with their customer counts as weights, so a restart costs the
    same for any number of customers; the label comes back by a join on the
    three scores.
    """
    if k > len(CLUSTER_LABELS):
        raise ValueError(f"at most {len(CLUSTER_LABELS)} clusters have labels")
    scores = ["r_score", "f_score", "m_score"]
    spread = scored.select(
        *[F.avg(c).alias(f"{c}_mean") for c in scores],
        *[F.stddev_pop(c).alias(f"{c}_std") for c in scores],
    ).first()
    points = materialise(
        scored.groupBy(*scores)
        .agg(F.count(F.lit(1)).cast("double").alias("weight"), F.avg("rfm_score").alias("level"))
        .select(
            *scores,
            "weight",
            "level",
            *[
                ((F.col(c) - spread[f"{c}_mean"]) / (spread[f"{c}_std"] or 1.0)).alias(f"{c}_z")
                for c in scores
            ],
        )
        .coalesce(1)
        .sortWithinPartitions(*scores)
    )
    vectors = VectorAssembler(inputCols=[f"{c}_z" for c in scores], outputCol="features").transform(
        points
    )
    best = None
    for attempt in range(restarts):
        model = KMeans(k=k, seed=seed + attempt, weightCol="weight", maxIter=100).fit(vectors)
        if best is None or model.summary.trainingCost < best.summary.trainingCost:
            best = model
    placed = best.transform(vectors)
    order = W.orderBy("mean_level", "prediction")
    labels = F.array(*[F.lit(name) for name in CLUSTER_LABELS[:k]])
    named = (
        placed.groupBy("prediction")
        .agg((F.sum(F.col("level") * F.col("weight")) / F.sum("weight")).alias("mean_level"))
        .withColumn("kmeans_label", F.get(labels, F.row_number().over(order) - 1))
        .select("prediction", "kmeans_label")
    )
    lookup = placed.join(F.broadcast(named), "prediction").select(
        *scores, F.col("prediction").alias("kmeans_cluster"), "kmeans_label"
    )
    return scored.join(F.broadcast(lookup), scores)


def row_shares(df: DataFrame, rows: str, columns: str, labels: Sequence[str]) -> DataFrame:
    """Share of each value of ``rows`` that falls on each label of ``columns``, in percent."""
    counts = df.groupBy(rows).pivot(columns, list(labels)).agg(F.count(F.lit(1))).na.fill(0)
    whole = sum((F.col(name) for name in labels[1:]), F.col(labels[0]))
    return counts.select(rows, *[percent(F.col(name), whole, 1).alias(name) for name in labels])


def cluster_agreement(clustered: DataFrame, k: int = 4) -> DataFrame:
    """Share of each rule segment that falls in each cluster, in percent."""
    return row_shares(clustered, "segment", "kmeans_label", CLUSTER_LABELS[:k])


def segments(purchases: DataFrame) -> DataFrame:
    """The whole chain: values, quantile scores and box segments."""
    return score_by_quantiles(rfm_values(purchases)).withColumn("segment", box_segment())


def filtered_segments(segmented: DataFrame, wanted: Sequence[str]) -> DataFrame:
    return segmented.where(F.col("segment").isin(list(wanted)))
