import math
import random

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from clientele.functions import stats
from clientele.operators import customer360, descriptive, features, models, scoring
from clientele.sources.schemas import CHURN_FEATURES


@pytest.fixture(scope="module")
def frame(spark):
    rng = random.Random(7)
    rows = []
    for i in range(200):
        days = float(rng.randint(1, 364))
        rows.append(
            (i, float(rng.randint(1, 40)), None if i % 20 == 3 else round(rng.uniform(10, 300), 2),
             round(rng.uniform(0, 100), 1), None if i % 20 == 7 else days, float(rng.randint(0, 9)),
             int(rng.random() < 0.35))
        )
    return spark.createDataFrame(rows, CHURN_FEATURES)


@pytest.fixture(scope="module")
def filled(frame):
    return features.impute(frame)


def test_imputation(frame, filled):
    assert filled.count() == 200
    assert all(r.nulls == 0 for r in features.remaining_nulls(filled).collect())
    values = [r[0] for r in frame.select("avg_purchase_value").dropna().collect()]
    got = {r.customer_id: r.avg_purchase_value for r in filled.collect()}
    assert got[3] == pytest.approx(np.median(values))
    before = {r.customer_id: r.churn for r in frame.collect()}
    assert {r.customer_id: r.churn for r in filled.collect()} == before


def test_modes_prefer_the_smallest_of_equals(spark):
    df = spark.createDataFrame(
        [(1, "b", 1), (2, "a", 0), (3, None, None), (4, "b", 1), (5, "a", 1)],
        "customer_id long, word string, flag int",
    )
    row = features.impute(df).where("customer_id = 3").first()
    assert (row.word, row.flag) == ("a", 1)


def test_a_column_without_values_stays_empty(spark):
    df = spark.createDataFrame([(1, None, 2.0), (2, None, 3.5)], "customer_id long, x double, y double")
    assert features.impute(df).where("x IS NOT NULL").count() == 0


def test_business_features(filled):
    rows = features.business_features(filled).collect()
    assert len(rows) == 200
    labels = set()
    for r in rows:
        assert r.CLV >= 0
        assert r.CLV == pytest.approx(r.avg_purchase_value * r.total_purchase * 0.3, abs=0.006)
        decay = math.exp(-r.last_purchase_days / 30) * r.engagement_score
        assert r.engagement_decay == pytest.approx(decay, abs=1e-4)
        assert r.is_high_value == int(r.CLV >= 1000)
        assert r.purchase_frequency > 0
        labels.add(r.churn_risk_segment)
    assert labels == set(features.VALUE_LABELS)


def test_given_life_span_sets_the_frequency(filled):
    df = filled.withColumn("customer_lifespan_years", F.lit(0.1))
    r = features.lifetime_value(df).first()
    assert r.purchase_frequency == pytest.approx(r.total_purchase / 0.5)


def test_split_is_stratified_and_stable(filled):
    split = features.stratified_split(filled, "churn")
    counts = {(r.split, r.churn): r["count"] for r in split.groupBy("split", "churn").count().collect()}
    for c in (0, 1):
        size = counts["train", c] + counts["test", c]
        assert counts["test", c] == math.ceil(size * 0.2)
    again = features.stratified_split(filled.repartition(7), "churn")
    picked = lambda df: {r.customer_id for r in df.where("split = 'test'").collect()}
    assert picked(split) == picked(again)


def test_folds_are_even(filled):
    folded = features.add_folds(filled, "churn", folds=5)
    sizes = folded.groupBy("churn", "fold").count().collect()
    for c in (0, 1):
        per = [r["count"] for r in sizes if r.churn == c]
        assert len(per) == 5 and max(per) - min(per) <= 1


def test_class_weights(spark):
    df = spark.createDataFrame([(0,)] * 3 + [(1,)] * 1, "y int")
    rows = {r.label: r for r in features.class_weights(df, "y").collect()}
    assert rows[0].weight == pytest.approx(4 / 6, abs=1e-6) and rows[1].weight == 2.0
    assert rows[1].positive_weight == 3.0
    attached = {r.y: r.weight for r in features.with_class_weight(df, "y").collect()}
    assert attached == pytest.approx({0: 4 / 6, 1: 2.0})


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(2)
    rows = []
    for i in range(700):
        y = int(rng.random() < 0.4)
        p = 0.5 if i % 3 == 0 else round(min(max(rng.gauss(0.4 + 0.2 * y, 0.2), 0.0), 1.0), 2)
        rows.append((i, p, y))
    return spark.createDataFrame(rows, "id long, p double, y int")


def test_auc_equals_pair_counting(scored):
    rows = scored.collect()
    pos, neg = [r.p for r in rows if r.y], [r.p for r in rows if not r.y]
    won = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg)
    got = scoring.roc_auc(scored, "p", "y").first()
    assert got.roc_auc == pytest.approx(won / (len(pos) * len(neg)), abs=1e-6)


def test_confusion_and_threshold(scored):
    rows = scored.collect()

    def f1(t):
        tp = sum(r.y and r.p >= t for r in rows)
        fp = sum((not r.y) and r.p >= t for r in rows)
        fn = sum(r.y and r.p < t for r in rows)
        return 2 * tp / (2 * tp + fp + fn)

    got = scoring.confusion_metrics(scored, "p", "y", 0.5).first()
    assert got.f1 == pytest.approx(f1(0.5), abs=1e-4)
    assert got.tn + got.fp + got.fn + got.tp == 700
    best = scoring.best_threshold(scored, "p", "y").first()
    assert best.f1 == pytest.approx(max(f1(r.p) for r in rows), abs=1e-5)
    assert f1(best.threshold) == pytest.approx(best.f1, abs=1e-5)


def test_nothing_predicted_scores_zero(scored):
    got = scoring.confusion_metrics(scored, "p", "y", 2.0).first()
    assert (got.precision, got.recall, got.f1) == (0.0, 0.0, 0.0)


def test_top_share_and_describe(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(1, 101)], "id long, v double")
    got = descriptive.top_share_of_total(df, "v", "id").first()
    assert got.top_rows == 10
    assert got.top_share_pct == pytest.approx(sum(range(91, 101)) / 5050 * 100, abs=1e-3)
    row = descriptive.describe(df, ["v"]).first()
    assert (row.n, row.p25, row.p50, row.p75, row.min, row.max) == (100, 25.75, 50.5, 75.25, 1, 100)


SETTINGS = models.Settings(
    trees=10, tree_depth=4, boosting_rounds=5, folds=3, categorical=("tier",),
    measures=("a", "b", "noise"),
)


@pytest.fixture(scope="module")
def training(spark):
    rng = random.Random(11)
    rows = []
    for i in range(400):
        a, b = rng.gauss(0, 1), rng.gauss(0, 1)
        y = rng.random() < 1 / (1 + math.exp(-(2 * a - b)))
        rows.append((i, a, b, rng.gauss(0, 1), ("x", "y", "z")[i % 3], y))
    df = spark.createDataFrame(
        rows, "customer_id long, a double, b double, noise double, tier string, churned boolean"
    )
    return models.labelled(df).cache()


@pytest.mark.parametrize("name", list(models.ESTIMATORS))
def test_models_beat_chance(training, name):
    model = models.ESTIMATORS[name](SETTINGS).fit(training)
    row = models.evaluate(model, training).first()
    assert row.roc_auc > 0.6 and 0 < row.f1 <= 1
    assert sum(map(sum, row.confusion_matrix)) == 400


def test_comparison_and_explanations(training):
    comparison = models.compare(
        {"s": (training, training), "o": (training, training)},
        SETTINGS, names=(models.LOGISTIC, models.FOREST), cross_validation=False,
    )
    assert comparison.table.count() == 4
    assert models.best_models(comparison.table).count() == 2
    assert all(r.auc_drop == 0 for r in models.auc_drop(comparison.table, "s", "o").collect())
    linear = comparison.models[models.LOGISTIC, "s"]
    shares = {r.feature: r.importance for r in models.linear_attribution(linear, training).collect()}
    assert max(shares, key=shares.get) == "a"
    weights = {r.feature: r.coefficient for r in models.coefficients(linear, training).collect()}
    assert weights["a"] > 0 > weights["b"]
    losses = {
        r.feature: r.auc_loss
        for r in models.permutation_importance(linear, training, ["a", "b", "noise"]).collect()
    }
    assert losses["a"] > losses["noise"]
    trees = comparison.models[models.FOREST, "s"]
    total = sum(r.importance for r in models.feature_importance(trees, training).collect())
    assert total == pytest.approx(1.0)


def test_cross_validation(training):
    row = models.cross_validate(models.LOGISTIC, training, SETTINGS).first()
    assert row.cv_auc_mean > 0.6 and 0 <= row.cv_auc_std < 0.2
    assert 0 < row.cv_f1_mean <= 1


def test_shuffled_donors_are_a_permutation(training):
    rows = models._shuffled_donors(training, ["a"]).collect()
    assert sorted(r.a for r in rows) == sorted(r._donor.a for r in rows)
    assert any(r.a != r._donor.a for r in rows)


def test_weights_come_from_the_training_rows(spark):
    seen = []

    class Recorder:
        def fit(self, train):
            seen.append({r.label: r.weight for r in train.select("label", "weight").collect()})

    rows = [(i, float(i), i < 5) for i in range(10)]
    table = models.labelled(spark.createDataFrame(rows, "customer_id long, a double, churned boolean"))
    models.fit(Recorder(), table.where("customer_id < 6"))
    assert seen == [{1.0: 6 / 10, 0.0: 6 / 2}]


def test_one_hot_drops_one_level_and_takes_unseen_labels(spark, training):
    counts = models.label_counts(training, SETTINGS.categorical)
    model = models.fit(models.logistic(SETTINGS, counts), training)
    names = models.feature_names(model, training)
    assert len(names) == 3 + 2 and not any(n.endswith("_x") for n in names)
    other = training.limit(2).withColumn("tier", F.when(F.col("customer_id") == 0, "new"))
    for fitted in (model, models.fit(models.forest(SETTINGS), training)):
        assert models.score(fitted, other).where("churn_prob IS NOT NULL").count() == 2


def test_metrics_take_unrounded_probabilities(spark):
    class Close:
        def transform(self, df):
            likely = F.when(F.col("label") == 1, 0.500002).otherwise(0.500001)
            return df.withColumn("probability", array_to_vector(F.array(1 - likely, likely)))

    rows = spark.createDataFrame([(float(i % 2),) for i in range(8)], "label double")
    assert models.evaluate(Close(), rows).first().roc_auc == 1.0


def test_tiers_come_from_the_data(spark):
    base = spark.createDataFrame(
        [("Odd", 1.0, 2, 3.0, 4, 5, 1), ("Gold", 2.0, 4, 3.0, 4, 5, 1), (None, 3.0, 1, 3.0, 4, 5, 1)],
        "customer_tier string, total_spent double, weekly_visits int, session_time_minutes double,"
        " page_views int, app_opens int, num_promotions_responded int",
    )
    medians = {r.customer_tier: r.total_spent_median for r in customer360.tier_statistics(base).collect()}
    assert medians == {"Odd": 1.0, "Gold": 2.0, None: 3.0}
    row = customer360.engagement_by_tier(base).where("metric = 'weekly_visits'").first()
    assert (row["Odd"], row["Gold"], row["null"]) == (2.0, 4.0, 1.0)
    empty = base.where("false")
    assert customer360.tier_statistics(empty).count() == 0
    assert customer360.engagement_by_tier(empty).count() == 0


def test_tails_of_many_degrees_of_freedom():
    for dof in (1e6, 9.9e6, 1.1e7, 1e12):
        assert stats.t_two_sided(1.96, dof) == pytest.approx(math.erfc(1.96 / math.sqrt(2)), abs=1e-6)
