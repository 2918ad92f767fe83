"""Models that grow in tasks of their own: boosted ones as level by level, forests against plain numpy and the library's."""

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from clientele.functions import sums
from clientele.operators import forests, many_models, models, scoring
from clientele.operators.forests import Growing
from clientele.operators.many_models import TEST, TRAIN, Boosting, Key

INPUTS = ["a", "b", "c", "tier"]
KEYS = [Key(0), Key(1), Key(0, 0), Key(0, 1), Key(1, 2)]
SCHEMA = "customer_id long, a double, b double, c double, tier double, label double, split int, role int, fold int"


def table(n=900, seed=4):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        a, b, c, tier = rng.normal(5, 2), rng.normal(), float(rng.integers(0, 4)), float(rng.integers(0, 6))
        y = float(rng.random() < 1 / (1 + np.exp(-(0.6 * (a - 5) - b + 2 * (tier in (1.0, 4.0)) - 1))))
        out.append((i, float(a), float(b), c, tier, y, 0, TEST if i % 6 == 0 else TRAIN, i % 3))
        if i % 2:
            out.append((i, float(a), float(b), c, tier, y, 1, TEST if i % 5 == 0 else TRAIN, i % 3))
    return out


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(table(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def layout(rows):
    return many_models.lay_out(rows, INPUTS, KEYS)


def alike(a, b):
    return all(np.array_equal(getattr(a, k), getattr(b, k)) for k in ("feature", "bin", "value", "gain") if hasattr(a, k))


@pytest.mark.parametrize("loss", ["logistic", "squared"])
def test_boosted_models_apart_equal_those_of_levels_to_the_bit(rows, monkeypatch, loss):
    monkeypatch.setattr(many_models, "PARTITION", 40)
    monkeypatch.setattr(many_models, "BLOCK", 16)
    monkeypatch.setattr(many_models, "WRITTEN", 2)
    layout = many_models.lay_out(rows, INPUTS, KEYS)
    settings, jobs, chosen = Boosting(rounds=5, depth=3, rate=0.3, loss=loss), [], sums.Blocks.chosen

    def noted(self, *args):
        jobs.append(1)
        return chosen(self, *args)

    monkeypatch.setattr(sums.Blocks, "chosen", noted)
    want = many_models.boost(layout, settings)
    assert len(jobs) == 15
    assert all(map(alike, many_models.boost_apart(layout, settings), want)) and len(jobs) == 15
    # those of more rows grow by levels
    some = int(np.sort(many_models.class_sizes(layout)[:, 0])[2])
    monkeypatch.setattr(many_models, "WHOLE", some)
    assert all(map(alike, many_models.boost_apart(layout, settings), want)) and len(jobs) == 30


def test_blocks_brought_together_hold_the_same_rows(rows, layout, monkeypatch):
    monkeypatch.setattr(many_models, "BLOCK", 16)
    small, large = (many_models.lay_out(rows, INPUTS, KEYS, joined=j) for j in (0, 100))
    held = lambda of: [r.rows for r in of.blocks.select("rows").collect()]
    assert max(held(small)) == 16 < max(held(large)) <= 100 and sum(held(small)) == sum(held(large)) == rows.count()
    for name in ("key", "x", "bins", "label", "role", "fold"):
        found = [b"".join(bytes(r[0]) for r in of.blocks.select(name).collect()) for of in (small, large, layout)]
        assert found[0] == found[1] == found[2]
    settings = Boosting(rounds=3, depth=3)
    assert all(map(alike, many_models.boost_apart(large, settings), many_models.boost(large, settings)))


def test_models_without_rows_or_with_one_class(spark):
    data = [(i, float(i), 1.0, 0.0, 0.0, 1.0, 0, TRAIN, 0) for i in range(20)]
    layout = many_models.lay_out(spark.createDataFrame(data, SCHEMA), INPUTS, [Key(0), Key(1), Key(0, 0)])
    x = np.array([[1.0, 1.0, 0.0, 0.0]])
    settings = Boosting(rounds=2, depth=2)
    assert [m.predict(x)[0] for m in many_models.boost_apart(layout, settings)] == [
        m.predict(x)[0] for m in many_models.boost(layout, settings)
    ]
    assert [f.predict(x)[0] for f in forests.forests(layout, Growing(3, 2), {})] == [1.0, 0.5, 0.5]
    empty = many_models.lay_out(spark.createDataFrame(data, SCHEMA).limit(0), INPUTS, [Key(0)])
    assert many_models.boost_apart(empty, settings)[0].predict(x)[0] == forests.forests(empty, Growing(3, 2), {})[0].predict(x)[0] == 0.5
    assert forests.forests(many_models.lay_out(spark.createDataFrame(data, SCHEMA), INPUTS, []), Growing(3, 2), {}) == []


def plain_tree(bins, y, times, weight, labels, sizes, tree):
    """What a tree says of every row, one node after the other."""
    said, width = np.full(len(y), np.nan), bins.shape[1]

    def impurity(inside):
        p, q = weight[0] * times[inside & ~y].sum(), weight[1] * times[inside & y].sum()
        return p + q, 0.0 if p + q == 0 else 2 * p * q / (p + q) ** 2

    def leaf(inside):
        p, q = weight[0] * times[inside & ~y].sum(), weight[1] * times[inside & y].sum()
        return [(inside, q / (p + q))]

    def node(inside, heap, level):
        best, (total, own) = (1e-12, None), impurity(inside)
        if level < sizes.depth:
            for f in forests.inputs_of(np.array([heap]), width, tree, sizes.seed)[0]:
                found = [b for b in range(32) if times[inside & (bins[:, f] == b)].sum()]
                if labels[f]:
                    found.sort(key=lambda b: times[inside & y & (bins[:, f] == b)].sum())
                for k in range(1, len(found)):
                    left = inside & np.isin(bins[:, f], found[:k])
                    right = inside & ~left
                    if min(times[left].sum(), times[right].sum()) < sizes.leaf_size:
                        continue
                    (wl, il), (wr, ir) = impurity(left), impurity(right)
                    gain = own - (wl * il + wr * ir) / total
                    if gain > best[0] + 1e-12:
                        best = gain, (left, right)
        if best[1] is None:
            return leaf(inside)
        parts = [node(part, 2 * heap + side, level + 1) for side, part in enumerate(best[1])]
        # leaves that say the same class are one
        if all(len(p) == 1 for p in parts) and (parts[0][0][1] > 0.5) == (parts[1][0][1] > 0.5):
            return leaf(inside)
        return parts[0] + parts[1]

    for inside, value in node(times > 0, 1, 0):
        said[inside] = value
    return said


@pytest.mark.parametrize("labelled", [False, True])
def test_trees_equal_plain_ones(labelled):
    rng = np.random.default_rng(8)
    n, sizes = 700, Growing(trees=1, depth=5, leaf_size=4, seed=6)
    bins = np.stack([rng.integers(0, 32, n), rng.integers(0, 9, n), rng.integers(0, 6, n), rng.integers(0, 2, n)], 1).astype(np.uint8)
    y = rng.random(n) < 0.2 + 0.4 * np.isin(bins[:, 2], (1, 4)) + 0.01 * bins[:, 0]
    weight, labels = n / (2 * np.bincount(y, minlength=2)), np.array([False, False, labelled, False])
    for tree in range(5):
        times = forests.poisson(np.arange(n).astype(np.uint64), tree, 6)
        grown = forests.grow(bins, y, times, weight, labels, sizes, tree)
        forest = forests._joined(list("abcd"), [np.arange(31.0)] * 4, sizes.depth, [grown])
        want = plain_tree(bins, y, times.astype(float), weight, labels, sizes, tree)
        drawn = times > 0
        assert np.allclose(forest.predict(bins.astype(float))[drawn], want[drawn], atol=1e-12), tree
        assert sum(v for _, v in forest.importances()) == pytest.approx(1.0)


def test_rows_are_drawn_about_once_and_each_by_itself():
    keys = np.arange(200_000).astype(np.uint64)
    times = forests.poisson(keys, 3, 42)
    shares = np.bincount(times, minlength=6)[:6] / len(times)
    assert np.allclose(shares, [np.exp(-1) / d for d in (1, 1, 2, 6, 24, 120)], atol=0.004)
    assert abs(np.corrcoef(times, forests.poisson(keys, 4, 42))[0, 1]) < 0.01
    # rows of one id are drawn apart, others by their id
    same = forests.apart(np.array([3, 7, 7, 7, 9]))
    assert len(set(same.tolist())) == 5 and same[[0, 1, 4]].tolist() == [3, 7, 9]


def test_forests_do_not_depend_on_how_rows_and_trees_are_dealt(rows, layout, monkeypatch):
    sizes, labels = Growing(trees=7, depth=4, leaf_size=2), {"tier": 6}
    want = forests.forests(layout, sizes, labels)
    monkeypatch.setattr(many_models, "PARTITION", 40)
    monkeypatch.setattr(many_models, "BLOCK", 16)
    monkeypatch.setattr(forests, "TREES_A_TASK", 2)
    got = forests.forests(many_models.lay_out(rows.repartition(5), INPUTS, KEYS), sizes, labels)
    for a, b in zip(got, want):
        assert len(a.roots) == 7 and all(np.array_equal(getattr(a, k), getattr(b, k)) for k in forests.ARRAYS)


def test_rows_held_out_do_not_change_a_forest(rows, layout):
    sizes = Growing(trees=3, depth=3)
    other = rows.withColumn("label", F.when((F.col("split") == 0) & (F.col("fold") == 1), 1 - F.col("label")).otherwise(F.col("label")))
    changed = forests.forests(many_models.lay_out(other, INPUTS, KEYS), sizes, {})
    same = [all(np.array_equal(getattr(a, k), getattr(b, k)) for k in forests.ARRAYS) for a, b in zip(changed, forests.forests(layout, sizes, {}))]
    assert same == [key.split == 1 or key.fold == 1 for key in KEYS]


@pytest.mark.parametrize("at", [0, 4])
def test_area_is_near_that_of_the_library(rows, layout, at):
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    key = KEYS[at]
    mine = rows.where(F.col("split") == key.split)
    train, test = mine.where(F.col("role") == TRAIN), mine.where(F.col("role") == TEST)
    if key.fold is not None:
        train, test = train.where(F.col("fold") != key.fold), train.where(F.col("fold") == key.fold)
    train, test = (VectorAssembler(inputCols=INPUTS, outputCol="features").transform(d) for d in (train, test))
    library = RandomForestClassifier(labelCol="label", numTrees=60, maxDepth=6, minInstancesPerNode=5, seed=1).fit(train)
    theirs = BinaryClassificationEvaluator(labelCol="label").evaluate(library.transform(test))
    grown = forests.forests(layout, Growing(60, 6, 5), {"tier": 6})
    said = many_models.held_out_scores(layout, grown, "x").where(F.col("split") == key.split)
    said = said.where(F.col("fold").isNull() if key.fold is None else F.col("fold") == key.fold)
    assert said.count() == test.count()
    assert scoring.roc_areas(said, "score", "label").first().area >= theirs - 0.02


def test_forests_come_back_from_storage(spark, layout, tmp_path):
    (forest, *_) = forests.forests(layout, Growing(3, 4), {"tier": 6})
    many_models.save_fitted(spark, forest, f"{tmp_path}/forest")
    x = np.array([[4.0, 0.3, 2.0, 1.0], [6.0, -0.3, 1.0, 4.0], [np.nan, 9.0, 9.0, 9.0]])
    again = many_models.load_fitted(spark, f"{tmp_path}/forest")
    assert (again.predict(x) == forest.predict(x)).all() and again.importances() == forest.importances()


def ready(spark, n=300):
    data = [(r[0], r[1], r[2], "abcdef"[int(r[4])], r[5] == 1) for r in table(n) if r[6] == 0]
    return models.labelled(spark.createDataFrame(data, "customer_id long, a double, b double, tier string, churned boolean"))


SETTINGS = models.Settings(trees=4, tree_depth=3, boosting_rounds=3, boosting_depth=2, folds=3, measures=("a", "b"), categorical=("tier",))


def test_a_comparison_takes_no_job_a_level(spark, monkeypatch):
    def refused(*args):
        raise AssertionError("a job for one level")

    monkeypatch.setattr(sums.Blocks, "chosen", refused)
    monkeypatch.setattr(models, "forest", refused)
    rows = ready(spark)
    out = models.compare({"x": (rows.where("customer_id % 4 > 0"), rows.where("customer_id % 4 = 0"))}, SETTINGS)
    found = {r.model: r for r in out.table.collect()}
    assert set(found) == {models.LOGISTIC, models.FOREST, models.BOOSTED} and all(r.cv_auc_mean > 0.5 for r in found.values())
    trees = out.models[models.FOREST, "x"]
    assert {f for f, _ in trees.model.importances()} == {"a", "b", "tier_index"}
    unseen = rows.limit(3).withColumn("tier", F.lit("new"))
    assert models.score(trees, unseen).where("churn_prob BETWEEN 0 AND 1").count() == 3


def test_models_of_more_rows_than_a_task_holds_grow_over_all_blocks(spark, monkeypatch):
    rows = ready(spark)
    train, test = rows.where("customer_id % 4 > 0"), rows.where("customer_id % 4 = 0")
    want = {r.model: r for r in models.compare({"x": (train, test)}, SETTINGS).table.collect()}
    # the folds' models are held, that of all training rows is not
    monkeypatch.setattr(many_models, "WHOLE", train.count() - 1)
    out = models.compare({"x": (train, test)}, SETTINGS)
    got = {r.model: r for r in out.table.collect()}
    assert isinstance(out.models[models.BOOSTED, "x"], models.Fitted)
    assert not isinstance(out.models[models.FOREST, "x"], models.Fitted)
    for name in (models.LOGISTIC, models.BOOSTED):
        assert got[name] == want[name]
    assert got[models.FOREST].cv_auc_mean == want[models.FOREST].cv_auc_mean
    assert got[models.FOREST].roc_auc == pytest.approx(want[models.FOREST].roc_auc, abs=0.15)
