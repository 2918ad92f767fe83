"""Writing report tables, summaries and fitted models."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_report(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Write a report as a folder of part files; CSV parts carry a header."""
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).csv(path)
    elif fmt == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"unknown report format: {fmt}")


def model_summary(comparison: DataFrame, importances: DataFrame, top: int = 5) -> DataFrame:
    """One nested row: the best model of each split and the leading features.

    ``comparison`` holds one row per model and split, ``importances`` one row
    per feature; both are as small as the list of models and features.
    """
    best = (
        comparison.groupBy("split")
        .agg(F.max_by(F.struct("model", "roc_auc", "f1", "accuracy"), "roc_auc").alias("best"))
        .agg(F.map_from_entries(F.collect_list(F.struct("split", "best"))).alias("best_models"))
    )
    leading = (
        importances.orderBy(F.desc("importance"), "feature")
        .limit(top)
        .agg(
            F.sort_array(F.collect_list(F.struct("importance", "feature")), asc=False).alias(
                "top_features"
            )
        )
    )
    return best.select(
        "best_models", leading.select("top_features").scalar().alias("top_features")
    )


def write_json_summary(summary: DataFrame, path: str) -> None:
    summary.coalesce(1).write.mode("overwrite").json(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
