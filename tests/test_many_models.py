"""Models grown together against models grown alone, and against plain numpy."""

import math
import os
import pickle
import random
import socket
import stat
import threading
import time

import numpy as np
import pytest
from pyspark import RDD
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from clientele.functions import sums
from clientele.operators import many_models, models, scoring
from clientele.operators.many_models import TEST, TRAIN, Boosting, Key

INPUTS = ["a", "b", "c"]


def table(n=600, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        a, b, c = rng.gauss(5, 2), rng.gauss(0, 1), float(rng.randrange(4))
        y = float(rng.random() < 1 / (1 + math.exp(-(0.9 * (a - 5) - 1.5 * b + (c == 2)))))
        rows.append((i, a, b, c, y, 0, TEST if i % 6 == 0 else TRAIN, i % 3))
        if i % 2:
            rows.append((i, a, b, c, y, 1, TEST if i % 5 == 0 else TRAIN, i % 3))
    return rows


@pytest.fixture(scope="module")
def rows(spark):
    schema = "customer_id long, a double, b double, c double, label double, split int, role int, fold int"
    return spark.createDataFrame(table(), schema).repartition(3).cache()


KEYS = [Key(0), Key(1), *[Key(s, k) for s in (0, 1) for k in range(3)]]


@pytest.fixture(scope="module")
def layout(rows):
    return many_models.lay_out(rows, INPUTS, KEYS)


def own(rows, key):
    """Training and held-out rows of a model, plainly."""
    mine = rows.where(F.col("split") == key.split)
    train = mine.where(F.col("role") == TRAIN)
    if key.fold is None:
        return train, mine.where(F.col("role") == TEST)
    return train.where(F.col("fold") != key.fold), train.where(F.col("fold") == key.fold)


def arrays(df):
    found = df.orderBy("customer_id").select("customer_id", *INPUTS, "label").collect()
    return np.array([r.customer_id for r in found]), np.array([list(r)[1:4] for r in found]), np.array([r.label for r in found])


def test_sizes_count_every_models_own_rows(rows, layout):
    sizes = many_models.class_sizes(layout)
    for key, (n, positive, unseen) in zip(KEYS, sizes):
        train, rest = own(rows, key)
        assert (n, positive, unseen) == (train.count(), train.where("label = 1").count(), rest.count())


def plain_boosting(keys, x, y, edges, s):
    """One model alone, with loops."""
    bins = np.stack([np.searchsorted(e, x[:, i], "left") for i, e in enumerate(edges)], axis=1)
    width, most = x.shape[1], max(len(e) for e in edges) + 1
    rng = np.random.default_rng(s.seed)
    weight = np.where(y > 0, (y == 0).sum() / (y > 0).sum(), 1.0)
    margin = np.zeros(len(y))
    for t in range(s.rounds):
        allowed = set(rng.permutation(width)[: max(1, round(s.columns * width))])
        drawn = many_models.sampled(keys, t, s.subsample, s.seed)
        p = 1 / (1 + np.exp(-margin))
        g, h = (p - y) * weight, p * (1 - p) * weight
        node = np.zeros(len(y), int)
        for _ in range(s.depth):
            after = 2 * node
            for at in set(node):
                inside = (node == at) & drawn
                best = (0.0, None)
                G, H = g[inside].sum(), h[inside].sum()
                for f in range(width):
                    if f not in allowed:
                        continue
                    for b in range(most):
                        left = inside & (bins[:, f] <= b)
                        gl, hl = g[left].sum(), h[left].sum()
                        if min(hl, H - hl) < s.least_weight:
                            continue
                        gain = (gl**2 / (hl + s.ridge) + (G - gl) ** 2 / (H - hl + s.ridge) - G**2 / (H + s.ridge)) / 2 - s.least_gain
                        if gain > best[0] + 1e-9:
                            best = (gain, (f, b))
                if best[1]:
                    f, b = best[1]
                    after[node == at] += bins[node == at, f] > b
            node = after
        for at in set(node):
            inside = (node == at) & drawn
            margin[node == at] += -s.rate * g[inside].sum() / (h[inside].sum() + s.ridge)
    return margin


def test_trees_grown_together_equal_trees_grown_alone(rows, layout, monkeypatch):
    monkeypatch.setattr(many_models, "WRITTEN", 2)
    settings = Boosting(rounds=5, depth=3, rate=0.3, columns=0.7)
    grown = many_models.boost(layout, settings)
    for key, trees in zip(KEYS, grown):
        ids, x, y = arrays(own(rows, key)[0])
        want = plain_boosting(ids, x, y, layout.edges, settings)
        assert np.allclose(trees.margin(x), want, atol=1e-9), key


def test_sums_in_a_tree_are_the_same(layout, monkeypatch):
    settings = Boosting(rounds=2, depth=2)
    before = many_models.boost(layout, settings)
    monkeypatch.setattr(sums, "FAN_IN", 0)
    monkeypatch.setattr(many_models, "PARTITION", 100)
    count = layout.values.summed(lambda row: np.array([row["rows"]]))
    monkeypatch.setattr(sums, "FAN_IN", 2)
    spread = sums.Blocks(layout.blocks.repartition(5), 5)
    assert spread.summed(lambda row: np.array([row["rows"]])) == count if count is not None else True
    after = many_models.boost(layout, settings)
    assert all((a.feature == b.feature).all() and np.allclose(a.value, b.value) for a, b in zip(before, after))


def returned(monkeypatch):
    """What collected jobs bring to the driver, in pickled bytes."""
    sizes, collect = [], RDD.collect

    def counted(self):
        found = collect(self)
        sizes.append(len(pickle.dumps(found)))
        return found

    monkeypatch.setattr(RDD, "collect", counted)
    return sizes


@pytest.mark.parametrize("loss", ["logistic", "squared"])
def test_what_reaches_the_driver_does_not_grow_with_the_partitions(rows, monkeypatch, loss):
    settings, got, grown = Boosting(rounds=3, depth=4, loss=loss), [], []
    sizes = returned(monkeypatch)
    for partition in (1000, 40):
        monkeypatch.setattr(many_models, "PARTITION", partition)
        layout = many_models.lay_out(rows, INPUTS, KEYS)
        sizes.clear()
        grown.append(many_models.boost(layout, settings))
        got.append(sum(sizes))
    assert layout.tasks == 23
    # the class sizes are summed as before
    assert got[1] < got[0] + 23 * 2_000
    assert got[0] < 3 * 4 * len(KEYS) * 3_000
    for a, b in zip(*grown):
        assert (a.feature == b.feature).all() and np.allclose(a.value, b.value)


def test_partitions_grow_in_number_and_then_in_size():
    counts = [many_models.partitions(n) for n in (0, 16_384, 16_385, 10**6, 10**7, 10**9)]
    assert counts == [1, 1, 2, 62, 77, 7630]


def test_chosen_sums_are_added_in_the_order_of_the_tasks(layout):
    blocks = sums.Blocks(layout.blocks.repartition(7), 7, held=True)
    parts = blocks.partitions.mapPartitionsWithIndex(
        lambda at, found: [(at, sum((np.frombuffer(r["label"]).sum() / 3 for r in found), 0.0))]
    ).collect()
    for reducers in (1, 3):
        found = blocks.chosen(
            lambda r: {k: np.array([np.frombuffer(r["label"]).sum() / 3]) for k in (4, 9)}, lambda k, a: (k, a[0]), reducers
        )
        assert found == {k: (k, sum(p for _, p in sorted(parts))) for k in (4, 9)}
    blocks.release()


@pytest.mark.parametrize("key", [Key(0), Key(1, 2)])
def test_area_is_near_that_of_the_library(rows, layout, key):
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    train, test = (VectorAssembler(inputCols=INPUTS, outputCol="features").transform(d) for d in own(rows, key))
    library = GBTClassifier(labelCol="label", maxIter=40, maxDepth=3, stepSize=0.1, seed=1).fit(train).transform(test)
    theirs = BinaryClassificationEvaluator(labelCol="label").evaluate(library)
    only = many_models.lay_out(rows, INPUTS, [key])
    (trees,) = many_models.boost(only, Boosting(rounds=40, depth=3, rate=0.1))
    said = many_models.held_out_scores(only, [trees], "x")
    assert scoring.roc_areas(said, "score", "label").first().area >= theirs - 0.02


def test_squared_loss_follows_the_values(spark):
    rng = np.random.default_rng(1)
    x = rng.uniform(-2, 2, (400, 3))
    y = np.where(x[:, 0] > 0.5, 10.0, -3.0) + x[:, 1]
    data = [(i, *map(float, v), float(t), 0, TRAIN, -1) for i, (v, t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(data, "customer_id long, a double, b double, c double, label double, split int, role int, fold int")
    layout = many_models.lay_out(df, INPUTS, [Key(0)])
    (trees,) = many_models.boost(layout, Boosting(rounds=40, depth=3, rate=0.2, subsample=1, columns=1, least_weight=1, least_gain=0, loss="squared"))
    assert np.sqrt(np.mean((trees.predict(x) - y) ** 2)) < 0.3
    assert sum(v for _, v in trees.importances()) == pytest.approx(1)


def test_newton_steps_reach_the_librarys_coefficients(rows, layout):
    ridge = 1e-3
    for key, model in zip(KEYS, many_models.logistic(layout, ridge)):
        train = own(rows, key)[0]
        assembled = models.Pipeline(
            stages=[
                models.VectorAssembler(inputCols=INPUTS, outputCol="raw"),
                models.StandardScaler(inputCol="raw", outputCol="features", withMean=True),
                LogisticRegression(labelCol="label", weightCol="weight", regParam=ridge, maxIter=1000, tol=1e-14),
            ]
        )
        library = assembled.fit(models.with_class_weight(train, "label")).stages[-1]
        assert np.allclose(model.weights, library.coefficients.toArray(), atol=1e-6), key
        assert model.intercept == pytest.approx(library.intercept, abs=1e-6)


def test_models_without_rows_or_with_one_class(spark):
    data = [(i, float(i), 1.0, 0.0, 1.0, 0, TRAIN, 0) for i in range(20)]
    df = spark.createDataFrame(data, "customer_id long, a double, b double, c double, label double, split int, role int, fold int")
    layout = many_models.lay_out(df, INPUTS, [Key(0), Key(1), Key(0, 0)])
    trees = many_models.boost(layout, Boosting(rounds=2, depth=2))
    linear = many_models.logistic(layout, 1e-3, steps=30)
    x = np.array([[1.0, 1.0, 0.0]])
    for model in [*trees, *linear]:
        assert 0 <= model.predict(x)[0] <= 1
    empty = many_models.lay_out(df.limit(0), INPUTS, [Key(0)])
    (model,) = many_models.boost(empty, Boosting(rounds=1, depth=1))
    assert model.predict(x)[0] == 0.5


def test_models_come_back_from_storage(spark, layout, tmp_path):
    x = np.array([[4.0, 0.3, 2.0], [6.0, -0.3, 1.0]])
    for at, model in enumerate([many_models.boost(layout, Boosting(rounds=2, depth=2))[0], many_models.logistic(layout, 1e-3)[0]]):
        many_models.save_fitted(spark, model, f"{tmp_path}/{at}")
        assert (many_models.load_fitted(spark, f"{tmp_path}/{at}").predict(x) == model.predict(x)).all()


def test_areas_of_many_groups_at_once(spark):
    rng = np.random.default_rng(2)
    data = [(f"g{g}", float(rng.integers(0, 30)) / 10, int(rng.integers(0, 2))) for g in range(4) for _ in range(200 * g + 5)]
    df = spark.createDataFrame(data, "g string, s double, y int").repartition(5)
    got = {r.g: r.area for r in scoring.roc_areas(df, "s", "y", ["g"]).collect()}
    for g in got:
        pos = [s for n, s, y in data if n == g and y]
        neg = [s for n, s, y in data if n == g and not y]
        won = sum((p > n) + (p == n) / 2 for p in pos for n in neg)
        assert got[g] == pytest.approx(won / (len(pos) * len(neg)), abs=1e-12)


def test_permutation_losses_equal_one_input_at_a_time(spark):
    rng = random.Random(5)
    data = [(i, rng.gauss(0, 1), rng.gauss(0, 1), rng.random() < 0.5) for i in range(300)]
    data = [(i, a, b, (a + 0.5 * rng.gauss(0, 1)) > 0) for i, a, b, _ in data]
    df = models.labelled(spark.createDataFrame(data, "customer_id long, a double, b double, churned boolean"))
    settings = models.Settings(measures=("a", "b"), categorical=())
    model = models.fit(models.logistic(settings), df)
    got = {r.feature: r.auc_loss for r in models.permutation_importance(model, df, ["a", "b"]).collect()}
    paired = models._shuffled_donors(df, ["a", "b"])
    area = lambda d: BinaryClassificationEvaluator(labelCol="label", numBins=0).evaluate(model.transform(d))
    for c in ("a", "b"):
        want = area(paired) - area(paired.withColumn(c, F.col(f"_donor.{c}")))
        assert got[c] == pytest.approx(want, abs=1e-9)


def test_comparison_measures_every_fold_and_split(spark, rows):
    customers = rows.where("split = 0").withColumn("churned", F.col("label") == 1).drop("split", "role", "fold", "label")
    ready = models.labelled(customers)
    settings = models.Settings(
        trees=3, tree_depth=3, boosting_rounds=3, boosting_depth=2, folds=3, measures=tuple(INPUTS), categorical=()
    )
    splits = {
        "x": (ready.where("customer_id % 4 > 0"), ready.where("customer_id % 4 = 0")),
        "y": (ready.where("customer_id < 400"), ready.where("customer_id >= 400")),
    }
    out = models.compare(splits, settings)
    found = {(r.model, r.split): r for r in out.table.collect()}
    assert set(found) == {(m, s) for m in (models.LOGISTIC, models.FOREST, models.BOOSTED) for s in splits}
    for (name, split), r in found.items():
        train, test = splits[split]
        assert (r.train_rows, r.test_rows) == (train.count(), test.count())
        alone = models.evaluate(out.models[name, split], test).first()
        assert (r.roc_auc, r.f1, r.accuracy) == (alone.roc_auc, alone.f1, alone.accuracy)
        assert 0.5 < r.cv_auc_mean < 1 and r.cv_auc_std >= 0


def test_a_round_prepares_its_blocks_once_for_all_levels(spark, layout):
    calls = spark.sparkContext.accumulator(0)

    def of(row):
        calls.add(1)
        return {**row, "ones": np.ones(row["rows"])}

    blocks = sums.Blocks(layout.bins, layout.tasks).mapped(of)
    rows = [blocks.summed(lambda row: np.array([row["ones"].sum()]))[0] for _ in range(3)]
    blocks.release()
    assert rows == [layout.blocks.agg({"rows": "sum"}).first()[0]] * 3
    assert calls.value == layout.blocks.count()


def test_tasks_hand_on_no_cells_that_an_input_has_no_bins_for(layout, monkeypatch):
    seen, chosen = [], sums.Blocks.chosen

    def noted(self, of, choose, reducers):
        row = self.partitions.first()
        seen.append((of(row), len(row["drawn"])))
        return chosen(self, of, choose, reducers)

    monkeypatch.setattr(sums.Blocks, "chosen", noted)
    many_models.boost(layout, Boosting(rounds=1, depth=2, columns=1.0))
    cells = sum(len(e) + 1 for e in layout.edges)
    assert [{a.shape for a in out.values()} for out, _ in seen] == [{(2, 1, cells)}, {(2, 2, cells)}]
    assert all(len(out) == models for out, models in seen)


def test_levels_read_few_partitions_in_the_same_order(rows, monkeypatch):
    monkeypatch.setattr(many_models, "PARTITION", 40)
    settings = Boosting(rounds=2, depth=2)
    layout = many_models.lay_out(rows, INPUTS, KEYS)
    before = many_models.boost(layout, settings)
    tasks, chosen = [], sums.Blocks.chosen

    def noted(self, of, choose, reducers):
        tasks.append((self.tasks, self.partitions.getNumPartitions()))
        return chosen(self, of, choose, reducers)

    monkeypatch.setattr(sums.Blocks, "chosen", noted)
    monkeypatch.setattr(many_models, "LEVEL_TASKS", 5, raising=False)
    after = many_models.boost(layout, settings)
    assert (layout.tasks, set(tasks)) == (23, {(5, 5)})
    assert all((a.feature == b.feature).all() and np.allclose(a.value, b.value) for a, b in zip(before, after))
    keys = lambda df: [bytes(r.key) for r in df.select("key").collect()]
    assert keys(layout.gathered()) == keys(layout.blocks)
    monkeypatch.setattr(many_models, "LARGEST", 100)
    assert layout.level_tasks == 9


def test_every_step_acknowledges_its_input_at_once(spark):
    def quick():
        found = []
        for name in os.listdir("/proc/self/fd"):
            try:
                if stat.S_ISSOCK(os.fstat(int(name)).st_mode):
                    with socket.socket(fileno=os.dup(int(name))) as connection:
                        found.append(connection.getsockopt(socket.IPPROTO_TCP, socket.TCP_QUICKACK))
            except OSError:
                continue
        return float(bool(found) and all(found))

    blocks = sums.Blocks(spark.sparkContext.parallelize([{"n": i} for i in range(12)], 4), 4)
    for _ in range(3):  # workers are used again
        assert blocks.summed(lambda row: np.array([quick()])) == [12]
        chosen = blocks.chosen(lambda row: {0: np.array([quick()]), 1: np.array([quick()])}, lambda key, sum_: (sum_[0], quick()), 2)
        assert chosen == {0: (12, 1), 1: (12, 1)}
        held = blocks.mapped(lambda row: row | {"quick": quick()})
        assert held.summed(lambda row: np.array([row["quick"]])) == [12]
        held.release()


def test_sums_are_dealt_once_and_added_in_the_order_of_the_tasks(spark):
    blocks = sums.Blocks(spark.sparkContext.parallelize([{"n": i} for i in range(40)], 8), 8)
    parts = [np.array([0.1 * i, 1e16, -1e16 + i]) for i in range(40)]
    expected = None
    for task in range(8):
        own = sum(parts[task * 5 + 1 : task * 5 + 5], parts[task * 5])
        expected = own if expected is None else expected + own
    for _ in range(2):
        found = blocks.chosen(lambda row: {k: parts[row["n"]] for k in range(5)}, lambda key, sum_: sum_, 2)
        assert sorted(found) == list(range(5))
        assert all((v == expected).all() for v in found.values())


def test_forests_leave_cores_to_the_levels_beside_them(rows, monkeypatch):
    now, peak, lock = [0], [0], threading.Lock()

    class Half:
        def transform(self, df):
            return df.withColumn("probability", array_to_vector(F.array(F.lit(0.5), F.lit(0.5))))

    def fit(estimator, train):
        with lock:
            now[0] += 1
            peak[0] = max(peak[0], now[0])
        time.sleep(0.3)
        with lock:
            now[0] -= 1
        return Half()

    monkeypatch.setattr(models, "fit", fit)
    settings, cores = models.Settings(), rows.sparkSession.sparkContext.defaultParallelism
    tasks = models._seen(rows, KEYS[0]).checkpoint().rdd.getNumPartitions()
    few = models._beside(rows, KEYS, settings)
    assert 1 <= few <= settings.parallelism and (few == 1 or few * tasks <= cores // 2 + tasks // 2)
    found, said = models._fit_forests(rows, KEYS, settings, threading.Semaphore(1))
    assert peak == [1] and list(found) == KEYS
    for key in KEYS:
        train, unseen = own(rows, key)
        seen = models._seen(rows, key)
        assert sorted(r.customer_id for r in seen.collect()) == sorted(r.customer_id for r in train.collect())
        fold = F.col("fold").isNull() if key.fold is None else F.col("fold") == key.fold
        assert said.where((F.col("split") == key.split) & fold).count() == unseen.count()
