"""Exact model metrics and tables over any scored set, as relational operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.functions.numeric import first_match, ratio, rounded, upper_edge_label
from clientele.functions.ordering import Sample, percentiles, running_totals
from clientele.sources.scratch import materialise


def score_groups(scored: DataFrame, score: str, label: str, keys: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives per distinct score, of every one of ``keys`` by itself."""
    positive = F.col(label).cast("int") == 1
    return (
        scored.where(F.col(score).isNotNull())
        .groupBy(*keys, F.col(score).cast("double").alias("score"))
        .agg(
            F.count_if(positive).cast("long").alias("pos"),
            F.count_if(~positive).cast("long").alias("neg"),
        )
    )


def roc_areas(scored: DataFrame, score: str, label: str, keys: Sequence[str] = ()) -> DataFrame:
    """``positives``, ``negatives`` and the exact ``area`` under the ROC curve, one row per ``keys``.

    A positive outranks the negatives below its score and half of those at it.
    All groups are ranked in the same job. Keys must not be null.
    """
    # a range partitioning reads its input twice
    groups = materialise(score_groups(scored, score, label, keys))
    upto = running_totals(groups, "score", ["pos", "neg"], keys)
    won = F.col("pos").cast("decimal(20,0)") * (
        F.col("upto_neg") * 2 - F.col("neg")
    ).cast("decimal(20,0)")
    pairs = F.col("positives").cast("double") * F.col("negatives").cast("double") * 2
    return (
        upto.groupBy(*keys)
        .agg(
            F.sum("pos").alias("positives"),
            F.sum("neg").alias("negatives"),
            F.sum(won).alias("won"),
        )
        .select(*keys, "positives", "negatives", ratio(F.col("won"), pairs).alias("area"))
    )


def roc_auc(scored: DataFrame, score: str, label: str, digits: int = 6) -> DataFrame:
    """Exact area under the ROC curve; equal scores count one half."""
    return roc_areas(scored, score, label).select(
        "positives", "negatives", rounded("area", digits).alias("roc_auc")
    )


def confusion_metrics(
    scored: DataFrame,
    score: str,
    label: str,
    threshold: float = 0.5,
    digits: int = 4,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Accuracy, precision, recall, F1 and the confusion matrix, in one aggregate, one row per ``keys``."""
    positive = F.col(label).cast("int") == 1
    predicted = F.col(score) >= threshold
    counted = scored.where(F.col(score).isNotNull()).groupBy(*keys).agg(
        F.count_if(positive & predicted).alias("tp"),
        F.count_if(~positive & predicted).alias("fp"),
        F.count_if(positive & ~predicted).alias("fn"),
        F.count_if(~positive & ~predicted).alias("tn"),
    )
    return counted.select(
        *keys,
        F.lit(float(threshold)).alias("threshold"),
        "tn",
        "fp",
        "fn",
        "tp",
        rounded(
            ratio(F.col("tp") + F.col("tn"), F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn")),
            digits,
        ).alias("accuracy"),
        zero_if_undefined(ratio("tp", F.col("tp") + F.col("fp")), digits).alias("precision"),
        zero_if_undefined(ratio("tp", F.col("tp") + F.col("fn")), digits).alias("recall"),
        zero_if_undefined(
            ratio(F.col("tp") * 2, F.col("tp") * 2 + F.col("fp") + F.col("fn")), digits
        ).alias("f1"),
    )


def zero_if_undefined(value: Column, digits: int) -> Column:
    return F.coalesce(rounded(value, digits), F.lit(0.0))


def confusion_matrix(metrics: DataFrame) -> DataFrame:
    """The four counts as one nested list: rows are true classes, columns predictions."""
    return metrics.withColumn(
        "confusion_matrix", F.array(F.array("tn", "fp"), F.array("fn", "tp"))
    )


def best_threshold(scored: DataFrame, score: str, label: str) -> DataFrame:
    """The score that maximises F1 when everything at or above it is positive.

    Equal F1: the smallest threshold, as the curve is read from low to high.
    """
    groups = materialise(score_groups(scored, score, label))
    totals = groups.agg(F.struct(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))).scalar()
    tp = totals.pos - F.col("upto_pos") + F.col("pos")
    fp = totals.neg - F.col("upto_neg") + F.col("neg")
    precision, recall = ratio(tp, tp + fp), ratio(tp, totals.pos)
    f1 = precision * 2 * recall / (precision + recall + 1e-9)
    return (
        running_totals(groups, "score", ["pos", "neg"])
        .select("score", rounded(f1, 6).alias("f1"))
        .agg(F.max(F.struct("f1", (-F.col("score")).alias("minus"))).alias("best"))
        .select((-F.col("best.minus")).alias("threshold"), F.col("best.f1").alias("f1"))
    )


def quadrants(
    scored: DataFrame, probability: float = 0.5, value: str = "clv"
) -> DataFrame:
    """Customers by churn risk against value, split at the exact median of value."""
    ((median,),) = percentiles(scored, [(Sample(F.col(value)), [0.5])])
    risk = F.when(F.col("churn_prob") >= probability, "high risk").otherwise("low risk")
    worth = F.when(F.col(value).cast("double") >= F.lit(median), "high value").otherwise(
        "low value"
    )
    return scored.groupBy(risk.alias("risk_side"), worth.alias("value_side")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(value).cast("double").alias(value)
    )


def value_by_risk(scored: DataFrame, value: str = "clv") -> DataFrame:
    """Customers, mean value and mean churn probability per value third and risk segment."""
    (edges,) = percentiles(scored, [(Sample(F.col(value)), [1 / 3, 2 / 3])])
    third = upper_edge_label(F.col(value).cast("double"), edges, ["Low", "Medium", "High"])
    high_risk = F.col("risk_segment") == "High Risk"
    high_value = F.col("value_segment") == "High"
    action = first_match(
        [
            (high_risk & high_value, "Call now"),
            (high_risk, "Cheap win-back mail"),
            ((F.col("risk_segment") == "Medium Risk") & high_value, "Loyalty reward"),
        ],
        "No action",
    )
    return (
        scored.withColumn("value_segment", third)
        .groupBy("value_segment", "risk_segment")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            rounded(ratio(F.sum(value), F.count(F.lit(1))), 2).alias("avg_clv"),
            rounded(F.avg("churn_prob"), 4).alias("avg_churn_prob"),
        )
        .withColumn("recommended_action", action)
    )
