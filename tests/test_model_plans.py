"""Named model queries: their sizes, with estimators replaced so that nothing is fitted, and what they return."""

import pytest
from pyspark.sql import functions as F

from clientele.operators import models, training
from clientele.plans import model_plans
from clientele.plans.registry import QUERIES
from clientele.sources import schemas
from clientele.sources.adapter import Tables

FOLDER = "/root/testdata/sf0.001"


class Reached(Exception):
    pass


@pytest.mark.parametrize(
    "name",
    ["M13_gradient_boosting", "M19_model_comparison", "U2_stacked_evaluations", "L6_best_model_per_split"]
    + ["M20_feature_importance", "M22_batch_scoring", "M23_value_regression", "S10_json_summary", "M28_end_to_end"],
)
def test_fits_at_full_size(monkeypatch, name):
    seen = {}

    def stop(*args, **kwargs):
        seen.update(kwargs, settings=next((a for a in args if isinstance(a, models.Settings)), None))
        raise Reached

    monkeypatch.setattr(model_plans, "joined", lambda t: None)
    monkeypatch.setattr(model_plans, "table", lambda t: None)
    monkeypatch.setattr(model_plans, "scratch_path", lambda *a: "x")
    for split in ("standard_split", "signup_split"):
        monkeypatch.setattr(training, split, lambda *a: (None, None))
    for fit in ("compare", "value_models", "forest"):
        monkeypatch.setattr(models, fit, stop)
    monkeypatch.setattr(model_plans, "_compared", lambda rows: models.compare({}, model_plans.FULL))
    monkeypatch.setitem(models.ESTIMATORS, models.BOOSTED, stop)
    monkeypatch.setattr(training, "run", stop)
    monkeypatch.setattr(model_plans, "Tables", None)

    class Stub:
        spark = None
        snapshot = staticmethod(lambda: None)

    build = QUERIES[name].__closure__[0].cell_contents
    with pytest.raises(Reached):
        build(Stub())
    full, settings = models.Settings(), seen["settings"]
    assert (settings.trees, settings.tree_depth, settings.boosting_rounds, settings.folds) == (
        full.trees, full.tree_depth, full.boosting_rounds, full.folds
    )
    assert seen.get("cross_validation", True) and "names" not in seen


def test_stacked_rows_and_auc_drop(spark, monkeypatch):
    rows = spark.createDataFrame(
        [("a", "standard", 0.9), ("a", "out of time", 0.7), ("b", "standard", 0.8), ("b", "out of time", 0.75)],
        "model string, split string, roc_auc double",
    )
    monkeypatch.setattr(model_plans, "table", lambda t: None)
    monkeypatch.setattr(model_plans, "_compared", lambda t: models.Comparison(rows, {}))
    of = lambda name: QUERIES[name].__closure__[0].cell_contents(None)
    assert sorted(of("U2_stacked_evaluations").collect()) == sorted(rows.collect())
    drops = {(r.model, r.split): r.auc_drop for r in of("M19_model_comparison").collect()}
    assert drops == {(m, s): d for m, d in (("a", 0.2), ("b", 0.05)) for s in ("standard", "out of time")}


def test_end_to_end_imputes_and_sums_up(spark, tmp_path):
    t = Tables(spark, FOLDER)
    rows = model_plans.joined(t)
    gaps = rows.withColumn("gender", F.when(F.col("customer_id") % 7 != 0, F.col("gender")))
    filled = training.imputed(gaps)
    assert filled.count() == rows.count() and filled.where("gender IS NULL OR page_views IS NULL").count() == 0
    small = models.Settings(trees=2, tree_depth=2, boosting_rounds=1, logistic_iterations=5)
    outcome = training.run(gaps, (1995, 1996), (1997,), small, str(tmp_path), cross_validation=False)
    out = outcome.report.collect()
    assert sorted(r.step for r in out) == ["comparison"] * 6 + ["executive summary", "summary"]
    (row,) = [r for r in out if r.step == "executive summary"]
    (forest,) = [r for r in out if r.step == "comparison" and (r.model, r.split) == ("Random Forest", "standard")]
    assert row.total_customers == rows.count() and 0 < row.churn_rate < 1 and row.high_value_customers > 0
    assert (row.model, row.roc_auc, row.f1, row.test_rows) == ("Random Forest", forest.roc_auc, forest.f1, forest.test_rows)
    made = {"clv", "purchase_frequency", "engagement_decay", "days_since_purchase", "is_high_value", "churn_risk_segment"}
    assert made <= set(outcome.scored.columns)
    saved = models.Fitted.load(spark, f"{tmp_path}/models/gradient-boosting-standard")
    again = models.score(saved, outcome.scored.drop("churn_prob", "risk_segment")).select("customer_id", "churn_prob")
    assert sorted(again.collect()) == sorted(outcome.scored.select("customer_id", "churn_prob").collect())
    (last,) = [r for r in out if r.step == "summary"]
    assert set(last.best_models) == {"standard", "out of time"} and len(last.top_features) == 5


def test_required_columns_of_the_files(spark, tmp_path):
    query = QUERIES["S4_required_columns"]
    whole = query(spark, FOLDER).collect()
    assert len(whole) == sum(map(len, schemas.SOURCE_COLUMNS.values())) and all(r.present for r in whole)
    for name in schemas.SOURCE_COLUMNS:
        rows = spark.read.parquet(f"{FOLDER}/{name}.parquet")
        rows = rows.drop("c_acctbal", "l_discount") if name in ("customer", "lineitem") else rows
        rows.write.parquet(f"{tmp_path}/{name}.parquet")
    lacking = {(r.table_name, r.column_name) for r in query(spark, str(tmp_path)).collect() if not r.present}
    assert lacking == {("customer", "c_acctbal"), ("lineitem", "l_discount")}
