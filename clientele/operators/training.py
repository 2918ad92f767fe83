"""The training table and the whole chain from tables to saved models."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.operators import customer360, features, models
from clientele.sources.scratch import materialise
from clientele.sources.sinks import (
    model_summary,
    save_model,
    write_json_summary,
    write_report,
)


def training_table(joined: DataFrame) -> DataFrame:
    """Base table with features, numeric inputs, label and class weights.

    Customers without any event count as having no visits and no app opens.
    """
    base = customer360.analytic_base(joined)
    filled = base.na.fill(0, ["weekly_visits", "app_opens"])
    return materialise(models.labelled(features.training_features(filled)))


def with_activity(joined: DataFrame, snapshot: Column | None = None) -> DataFrame:
    """Orders, mean order value and days since the last order, as the business features take them.

    ``snapshot`` is the day the days count to, by default the last order date.
    """
    day = joined.agg(F.max("last_order_date")).scalar() if snapshot is None else snapshot
    spent, orders = F.col("total_spent").cast("double"), F.col("total_orders").cast("double")
    return joined.withColumns(
        {
            "total_purchase": orders,
            "avg_purchase_value": spent / F.nullif(orders, F.lit(0.0)),
            "last_purchase_days": F.datediff(day, "last_order_date").cast("double"),
        }
    )


def with_business_features(filled: DataFrame) -> DataFrame:
    """Lifetime value (in place of the given one), orders a year, decayed engagement, days, flag and quartile."""
    score = (F.col("page_views") + F.col("app_opens")).cast("double")
    valued = features.business_features(filled.withColumn("engagement_score", score))
    return valued.withColumnRenamed("CLV", "clv")


def imputed(joined: DataFrame) -> DataFrame:
    """The joined table without gaps: none for activity, median or commonest value for the rest.

    Customers without any event count as having no visits and no app opens.
    """
    filled = joined.na.fill(0, ["weekly_visits", "app_opens"])
    return features.impute(filled, untouched=("customer_id", models.LABEL))


def standard_split(table: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stratified 80/20."""
    split = materialise(features.stratified_split(table, models.LABEL))
    return split.where(F.col("split") == "train"), split.where(F.col("split") == "test")


def signup_split(table: DataFrame, train_years, test_years) -> tuple[DataFrame, DataFrame]:
    """Older signups against a later year."""
    split = features.split_by_signup_year(table, train_years, test_years)
    return split.where(F.col("split") == "train"), split.where(F.col("split") == "test")


@dataclass(frozen=True)
class Outcome:
    comparison: models.Comparison
    importances: DataFrame
    attribution: DataFrame
    summary: DataFrame
    executive: DataFrame
    scored: DataFrame

    @property
    def report(self) -> DataFrame:
        """The comparison's rows, the summary's one and the executive summary, told apart by ``step``."""
        rows = self.comparison.table.withColumn("step", F.lit("comparison"))
        for step, table in (("summary", self.summary), ("executive summary", self.executive)):
            rows = rows.unionByName(table.withColumn("step", F.lit(step)), allowMissingColumns=True)
        return rows


#: What the business features add to a model's inputs.
BUSINESS_MEASURES = ("is_high_value",)


def executive_summary(table: DataFrame, comparison: DataFrame) -> DataFrame:
    """Customers, churn rate, customers above 1,000 and the forest's metrics on the standard split, one row."""
    forest = comparison.where((F.col("model") == models.FOREST) & (F.col("split") == "standard"))
    metrics = forest.agg(
        F.first(F.struct(*[c for c in comparison.columns if c not in ("model", "split")])).alias("m")
    ).select(F.lit(models.FOREST).alias("model"), F.lit("standard").alias("split"), "m.*")
    # one row each
    return customer360.executive_summary(table).join(F.broadcast(metrics), F.lit(True))


def run(
    joined: DataFrame,
    train_years,
    test_years,
    settings: models.Settings = models.Settings(),
    output: str | None = None,
    cross_validation: bool = True,
    snapshot: Column | None = None,
) -> Outcome:
    """Impute, prepare, split, fit, compare, explain, score everyone, and save when told where.

    The label is a cut of the days since the last order. The business features
    that follow from those days (and the quartile, which follows from the value)
    are in the table but not among the inputs.
    """
    settings = replace(settings, measures=(*settings.measures, *BUSINESS_MEASURES))
    table = training_table(with_business_features(imputed(with_activity(joined, snapshot))))
    standard = standard_split(table)
    comparison = models.compare(
        {
            "standard": standard,
            "out of time": signup_split(table, train_years, test_years),
        },
        settings,
        cross_validation=cross_validation,
    )
    boosted = comparison.models[models.BOOSTED, "standard"]
    linear = comparison.models[models.LOGISTIC, "standard"]
    importances = models.feature_importance(boosted, table)
    outcome = Outcome(
        comparison,
        importances,
        models.linear_attribution(linear, standard[1]),
        model_summary(comparison.table, importances),
        executive_summary(table, comparison.table),
        models.score(boosted, table),
    )
    if output is not None:
        for (name, split), model in comparison.models.items():
            folder = f"{name}-{split}".lower().replace(" ", "-")
            if isinstance(model, models.Fitted):
                model.save(table.sparkSession, f"{output}/models/{folder}")
            else:
                save_model(model, f"{output}/models/{folder}")
        write_report(comparison.table, f"{output}/model_comparison")
        write_report(importances, f"{output}/feature_importance")
        write_report(
            outcome.scored.select("customer_id", "churn_prob", "risk_segment"),
            f"{output}/predictions",
            "parquet",
        )
        write_json_summary(outcome.summary, f"{output}/model_summary")
        write_report(outcome.executive, f"{output}/executive_summary")
    return outcome
