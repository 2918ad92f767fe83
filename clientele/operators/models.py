"""Churn and value models: fitting, comparing, explaining and scoring."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from functools import reduce
from threading import Semaphore

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.feature import (
    OneHotEncoder,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
    VectorSlicer,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.functions.numeric import rounded
from clientele.functions.ordering import add_row_number
from clientele.operators import forests, many_models
from clientele.operators.churn import risk_segment
from clientele.operators.features import add_folds, with_class_weight
from clientele.operators.forests import Forest, Growing
from clientele.operators.many_models import TEST, TRAIN, Boosting, Key, Linear, Trees
from clientele.operators.scoring import confusion_metrics, roc_areas, roc_auc
from clientele.sources.scratch import materialise

SEED = 42
LABEL = "churned"
CATEGORICAL = ("gender", "country", "customer_tier")
MEASURES = (
    "age",
    "months_since_signup",
    "clv",
    "next_purchase_prob",
    "total_spent",
    "weekly_visits",
    "session_time_minutes",
    "page_views",
    "app_opens",
    "num_promotions_responded",
    "high_spender",
    "high_engagement",
    "tenure_years",
    "spend_per_month",
    "engagement_score",
)
LOGISTIC, FOREST, BOOSTED = "Logistic Regression", "Random Forest", "Gradient Boosting"


@dataclass(frozen=True)
class Settings:
    """Sizes of the models; the defaults are those of the full training run."""

    logistic_iterations: int = 1000
    ridge: float = 1.25e-4  # a unit penalty over some 8,000 rows
    trees: int = 200
    tree_depth: int = 12
    leaf_size: int = 5
    boosting_rounds: int = 300
    boosting_depth: int = 5
    learning_rate: float = 0.05
    subsample: float = 0.8
    folds: int = 5
    #: Forests that are fitted at the same time.
    parallelism: int = 4
    measures: Sequence[str] = field(default=MEASURES)
    categorical: Sequence[str] = field(default=CATEGORICAL)


def label_counts(df: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    """How many labels each column of few labels has; one aggregate."""
    if not columns:
        return {}
    return df.agg(*[F.size(F.collect_set(c)).alias(c) for c in columns]).first().asDict()


def encoder(
    settings: Settings, one_hot: Mapping[str, int] | None = None, scaled: bool = False
) -> list:
    """Stages from raw columns to ``features``: alphabetic indices or one-hot columns.

    ``one_hot`` has the ``label_counts`` of the rows that the stages are fitted
    on. The first label of each column has no slot of its own. A label that the
    fitted rows lack, or a null, is an index of its own after the known ones,
    and no slot when one-hot. Scaling is a stage of the pipeline, so every split
    is scaled by its own training rows.
    """
    indices = [f"{c}_index" for c in settings.categorical]
    stages: list = [
        StringIndexer(
            inputCols=list(settings.categorical),
            outputCols=indices,
            stringOrderType="alphabetAsc",
            handleInvalid="keep",
        )
    ] if settings.categorical else []
    encoded = indices
    if one_hot is not None and indices:
        levels = [f"{c}_levels" for c in settings.categorical]
        # The slot that dropLast leaves out is that of unknown labels.
        stages.append(OneHotEncoder(inputCols=indices, outputCols=levels, dropLast=True))
        several = [c for c in settings.categorical if one_hot[c] > 1]
        encoded = [f"{c}_code" for c in several]
        stages += [
            VectorSlicer(
                inputCol=f"{c}_levels", outputCol=f"{c}_code", indices=list(range(1, one_hot[c]))
            )
            for c in several
        ]
    raw = "raw_features" if scaled else "features"
    stages.append(VectorAssembler(inputCols=[*settings.measures, *encoded], outputCol=raw))
    if scaled:
        stages.append(StandardScaler(inputCol=raw, outputCol="features", withMean=True))
    return stages


def logistic(
    settings: Settings = Settings(), one_hot: Mapping[str, int] | None = None
) -> Pipeline:
    model = LogisticRegression(
        labelCol="label",
        weightCol="weight",
        maxIter=settings.logistic_iterations,
        regParam=settings.ridge,
    )
    return Pipeline(stages=[*encoder(settings, one_hot, scaled=True), model])


def forest(settings: Settings = Settings()) -> Pipeline:
    model = RandomForestClassifier(
        labelCol="label",
        weightCol="weight",
        numTrees=settings.trees,
        maxDepth=settings.tree_depth,
        minInstancesPerNode=settings.leaf_size,
        seed=SEED,
        cacheNodeIds=True,
    )
    return Pipeline(stages=[*encoder(settings), model])


@dataclass(frozen=True)
class Boosted:
    """Second-order boosting on binned inputs, by ``many_models``, with the interface of an estimator."""

    settings: Settings

    def sizes(self) -> Boosting:
        s = self.settings
        return Boosting(
            rounds=s.boosting_rounds,
            depth=s.boosting_depth,
            rate=s.learning_rate,
            subsample=s.subsample,
            columns=s.subsample,
        )

    def fit(self, train: DataFrame) -> Fitted:
        indexed = indexer(self.settings, train)
        rows = indexed.transform(train).withColumns(
            {"split": F.lit(0), "role": F.lit(TRAIN), "fold": F.lit(-1)}
        )
        layout = many_models.lay_out(rows, input_names(self.settings), [Key(0)])
        (trees,) = many_models.boost(layout, self.sizes())
        return Fitted(indexed, trees)


def boosted(settings: Settings = Settings()) -> Boosted:
    return Boosted(settings)


ESTIMATORS: Mapping[str, Callable[[Settings], Estimator]] = {
    LOGISTIC: logistic,
    FOREST: forest,
    BOOSTED: boosted,
}


def input_names(settings: Settings) -> list[str]:
    """The inputs of a model without one-hot columns, in order."""
    return [*settings.measures, *[f"{c}_index" for c in settings.categorical]]


def indexer(settings: Settings, rows: DataFrame) -> PipelineModel:
    """The alphabetical label indices of the categorical inputs."""
    stages = [s for s in encoder(settings) if isinstance(s, StringIndexer)]
    return Pipeline(stages=stages).fit(rows)


def label_bins(indices: PipelineModel) -> dict[str, int]:
    """The inputs that are label indices, with how many values each has, unknown labels' among them."""
    return {
        column: len(labels) + 1
        for stage in indices.stages
        for column, labels in zip(stage.getOutputCols(), stage.labelsArray)
    }


def forest_sizes(settings: Settings) -> Growing:
    return Growing(settings.trees, settings.tree_depth, settings.leaf_size, SEED)


@dataclass(frozen=True)
class Fitted:
    """A model of ``many_models`` or ``forests`` with the label indices it was fitted on."""

    indices: PipelineModel
    model: Trees | Linear | Forest

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``probability`` as a vector of both classes."""
        p = F.col("_p")
        indices = [c for stage in self.indices.stages for c in stage.getOutputCols()]
        scored = self.indices.transform(df).withColumn("_p", self.model.column())
        return scored.withColumn("probability", array_to_vector(F.array(1 - p, p))).drop("_p", *indices)

    def save(self, spark, path: str) -> None:
        self.indices.write().overwrite().save(f"{path}/indices")
        many_models.save_fitted(spark, self.model, f"{path}/model")

    @classmethod
    def load(cls, spark, path: str) -> Fitted:
        return cls(PipelineModel.load(f"{path}/indices"), many_models.load_fitted(spark, f"{path}/model"))


def labelled(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Numeric inputs, a double label and the class weights of the whole table.

    ``fit`` replaces the weights by those of the rows it is given.
    """
    casts = {
        f.name: F.col(f.name).cast("double")
        for f in df.schema
        if f.name not in ("customer_id", label) and f.dataType.typeName() in ("boolean", "decimal")
    }
    typed = df.withColumns({**casts, "label": F.col(label).cast("double")})
    return with_class_weight(typed, "label")


def fit(estimator: Estimator | Boosted, train: DataFrame) -> PipelineModel | Fitted:
    """Fit with classes balanced by the training rows alone."""
    return estimator.fit(with_class_weight(train, "label"))


def _probability() -> Column:
    return vector_to_array("probability")[1]


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add the churn probability, rounded for output, and its risk segment."""
    return (
        model.transform(df)
        .withColumn("churn_prob", rounded(_probability(), 4))
        .withColumn("risk_segment", risk_segment(F.col("churn_prob")))
        .drop("rawPrediction", "probability", "prediction", "features", "raw_features")
    )


def _tagged(splits: Sequence[tuple[DataFrame, DataFrame | None]], settings: Settings, folds: bool) -> DataFrame:
    """The rows of all splits with their number, ``role`` and ``fold``; a row is there once per split."""
    parts = []
    for number, (train, test) in enumerate(splits):
        own = add_folds(train, "label", folds=settings.folds) if folds else train.withColumn("fold", F.lit(-1))
        parts.append(own.withColumns({"split": F.lit(number), "role": F.lit(TRAIN)}))
        if test is not None:
            marks = {"fold": F.lit(-1), "split": F.lit(number), "role": F.lit(TEST)}
            parts.append(test.withColumns(marks))
    columns = ["customer_id", "label", "split", "role", "fold", *settings.measures, *settings.categorical]
    return materialise(reduce(DataFrame.unionByName, [p.select(*columns) for p in parts]))


def _seen(rows: DataFrame, key: Key) -> DataFrame:
    """The rows that a forest is fitted on; trees draw them by partition and place, and both follow from the ids alone."""
    own = rows.where((F.col("split") == key.split) & (F.col("role") == TRAIN))
    seen = own if key.fold is None else own.where(F.col("fold") != key.fold)
    return seen.repartition("customer_id").sortWithinPartitions("customer_id")


def _beside(rows: DataFrame, keys: Sequence[Key], settings: Settings) -> int:
    """How many forests leave about half of the cores to the short jobs of other models.

    A forest's tasks take seconds, and a job that comes later waits for one of them to end.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, materialise(_seen(rows, keys[0])).rdd.getNumPartitions())
    return max(1, min(settings.parallelism, (cores // 2 + tasks // 2) // tasks))


def _fit_forests(
    rows: DataFrame, keys: Sequence[Key], settings: Settings, gate: Semaphore
) -> tuple[dict[Key, PipelineModel], DataFrame]:
    """One forest per key, as many at a time as ``gate`` lets in, and what each says of the rows it did not see."""

    def one(key: Key) -> tuple[PipelineModel, DataFrame]:
        own = rows.where(F.col("split") == key.split)
        if key.fold is None:
            unseen = own.where(F.col("role") == TEST)
        else:
            unseen = own.where((F.col("role") == TRAIN) & (F.col("fold") == key.fold))
        with gate:
            model = fit(forest(settings), _seen(rows, key))
        return model, model.transform(unseen).select(
            F.lit(FOREST).alias("model"),
            "split",
            F.lit(key.fold).cast("int").alias("fold"),
            "label",
            _probability().alias("score"),
        )

    with ThreadPoolExecutor(settings.parallelism) as pool:
        found = list(pool.map(inheritable_thread_target(rows.sparkSession)(one), keys))
    return {k: m for k, (m, _) in zip(keys, found)}, reduce(DataFrame.unionByName, [s for _, s in found])


@dataclass(frozen=True)
class Measured:
    """All models of several splits: ``table`` has one row per model, split and fold (-1: the whole split)."""

    table: DataFrame
    models: dict[tuple[str, Key], PipelineModel | Fitted]
    sizes: dict[Key, tuple[int, int]]


def _measure(
    splits: Sequence[tuple[DataFrame, DataFrame | None]],
    settings: Settings,
    names: Sequence[str],
    keys: Sequence[Key],
) -> Measured:
    """Fit ``names`` for all keys together and measure each on the rows that it did not see.

    Inputs are encoded once. The linear models of all keys grow in the same jobs. A boosted
    model, or some trees of a forest, grow in a task that holds the model's rows, all beside
    each other. For models of more rows than that, boosted ones grow in the same jobs
    and Spark's forests beside them on the cores that these leave. All
    areas and confusion metrics are one grouped aggregate each.
    """
    rows = _tagged(splits, settings, any(k.fold is not None for k in keys))
    indexed = indexer(settings, rows)
    layout = many_models.lay_out(indexed.transform(rows), input_names(settings), keys, joined=many_models.JOINED)
    sizes = many_models.class_sizes(layout)
    large = [k for k, s in zip(keys, sizes) if s[0] > many_models.WHOLE]

    def stepwise(name: str) -> tuple[dict[Key, Fitted], DataFrame]:
        if name == LOGISTIC:
            fitted = many_models.logistic(layout, settings.ridge, settings.logistic_iterations)
        else:
            fitted = many_models.boost_apart(layout, boosted(settings).sizes())
        own = {k: Fitted(indexed, m) for k, m in zip(keys, fitted)}
        return own, many_models.held_out_scores(layout, fitted, name)

    def trees_of() -> tuple[dict[Key, PipelineModel | Fitted], DataFrame]:
        small = replace(layout, keys=[k for k in keys if k not in large])
        grown = forests.forests(small, forest_sizes(settings), label_bins(indexed))
        own = {k: Fitted(indexed, m) for k, m in zip(small.keys, grown)}
        said = many_models.held_out_scores(small, grown, FOREST)
        if large:
            more, also = _fit_forests(rows, large, settings, gate)
            own, said = own | more, said.unionByName(also)
        return own, said

    # its jobs are short, and would wait for the tasks of the others
    found = {name: stepwise(name) for name in names if name == LOGISTIC}
    with ThreadPoolExecutor(1) as beside:
        few = _beside(rows, keys, settings) if large and FOREST in names else settings.parallelism
        gate, trees = Semaphore(few), None
        if FOREST in names:
            trees = beside.submit(inheritable_thread_target(rows.sparkSession)(trees_of))
        try:
            found |= {name: stepwise(name) for name in names if name not in (LOGISTIC, FOREST)}
        finally:
            if few < settings.parallelism:
                gate.release(settings.parallelism - few)
        if trees is not None:
            found[FOREST] = trees.result()
    models = {(name, k): m for name, (own, _) in found.items() for k, m in own.items()}
    scores = [said for _, said in found.values()]
    by = ["model", "split", "fold"]
    scored = materialise(
        reduce(DataFrame.unionByName, scores).withColumn("fold", F.coalesce("fold", F.lit(-1)))
    )
    table = roc_areas(scored, "score", "label", by).join(
        confusion_metrics(scored, "score", "label", 0.5, 4, by), by
    )
    return Measured(materialise(table), models, {k: (int(s[0]), int(s[2])) for k, s in zip(keys, sizes)})


def _over_folds(table: DataFrame, by: Sequence[str]) -> DataFrame:
    return (
        table.where(F.col("fold") >= 0)
        .groupBy(*by)
        .agg(
            rounded(F.avg("area"), 4).alias("cv_auc_mean"),
            rounded(F.stddev_pop("area"), 4).alias("cv_auc_std"),
            rounded(F.avg("f1"), 4).alias("cv_f1_mean"),
            rounded(F.stddev_pop("f1"), 4).alias("cv_f1_std"),
        )
    )


def cross_validate(name: str, train: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Mean and deviation of AUC and F1 over stratified folds, one row.

    The fits of all folds share their jobs.
    """
    keys = [Key(0, k) for k in range(settings.folds)]
    measured = _measure([(materialise(train), None)], settings, [name], keys)
    return _over_folds(measured.table, [])


def evaluate(
    model: PipelineModel, test: DataFrame, threshold: float = 0.5, digits: int = 4
) -> DataFrame:
    """Exact AUC and the confusion metrics of a model on a test set, one row.

    Both take the probability as the model gives it, not rounded.
    """
    scored = materialise(
        model.transform(test).select("label", _probability().alias("churn_prob"))
    )
    area = roc_auc(scored, "churn_prob", "label", digits).select("roc_auc").scalar()
    return confusion_metrics(scored, "churn_prob", "label", threshold, digits).select(
        area.alias("roc_auc"),
        "f1",
        "accuracy",
        "precision",
        "recall",
        "threshold",
        F.array(F.array("tn", "fp"), F.array("fn", "tp")).alias("confusion_matrix"),
    )


@dataclass(frozen=True)
class Comparison:
    """One row per model and split, with the models themselves."""

    table: DataFrame
    models: dict[tuple[str, str], PipelineModel | Fitted]


def compare(
    splits: Mapping[str, tuple[DataFrame, DataFrame]],
    settings: Settings = Settings(),
    names: Sequence[str] = (LOGISTIC, FOREST, BOOSTED),
    cross_validation: bool = True,
) -> Comparison:
    """Fit every model on every split and measure it on that split's test rows.

    All splits and folds are fitted together. The threshold is the usual one
    half: tuning it on the test rows would overstate F1.
    """
    numbers = list(splits)
    keys = [Key(i) for i in range(len(numbers))]
    if cross_validation:
        keys += [Key(i, k) for i in range(len(numbers)) for k in range(settings.folds)]
    parts = [(materialise(train), materialise(test)) for train, test in splits.values()]
    measured = _measure(parts, settings, names, keys)
    # one row per split
    sizes = measured.table.sparkSession.createDataFrame(
        [(i, name, *measured.sizes[Key(i)]) for i, name in enumerate(numbers)],
        "split int, name string, train_rows int, test_rows int",
    )
    found = measured.table.where(F.col("fold") < 0).join(F.broadcast(sizes), "split").select(
        "model",
        F.col("name").alias("split"),
        rounded("area", 4).alias("roc_auc"),
        "f1",
        "accuracy",
        "precision",
        "recall",
        "train_rows",
        "test_rows",
        F.col("split").alias("_split"),
    )
    if cross_validation:
        cv = _over_folds(measured.table, ["model", "split"]).select(
            "model", F.col("split").alias("_split"), "cv_auc_mean", "cv_auc_std"
        )
        found = found.join(cv, ["model", "_split"])
    models = {(name, numbers[k.split]): m for (name, k), m in measured.models.items() if k.fold is None}
    return Comparison(materialise(found.drop("_split")), models)


def auc_drop(table: DataFrame, reference: str, other: str) -> DataFrame:
    """How much AUC each model loses from one split to the other."""
    def at(split: str):
        return F.max(F.when(F.col("split") == split, F.col("roc_auc")))

    return (
        table.groupBy("model")
        .agg(at(reference).alias("auc_reference"), at(other).alias("auc_other"))
        .withColumn("auc_drop", rounded(F.col("auc_reference") - F.col("auc_other"), 4))
    )


def best_models(table: DataFrame) -> DataFrame:
    """The model with the highest AUC on each split."""
    return table.groupBy("split").agg(
        F.max_by("model", "roc_auc").alias("model"), F.max("roc_auc").alias("roc_auc")
    )


def feature_names(model: PipelineModel | Fitted, df: DataFrame) -> list[str]:
    """Names of the vector slots, read from the metadata of the assembled column."""
    if isinstance(model, Fitted):
        return list(model.model.inputs)
    (assembler,) = [stage for stage in model.stages if isinstance(stage, VectorAssembler)]
    column = assembler.getOutputCol()
    # A fitted pipeline's own encoders describe the slots; no row is read.
    attributes = model.transform(df.limit(0)).schema[column].metadata["ml_attr"]["attrs"]
    slots = sorted(
        (attr["idx"], attr["name"]) for group in attributes.values() for attr in group
    )
    return [name for _, name in slots]


def slot_statistics(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Mean and deviation of every slot of the final vector, from one aggregate."""
    values = vector_to_array("features")
    cells = [
        F.struct(
            F.lit(name).alias("feature"),
            # a rounded zero may be negative
            (F.round(F.avg(values[i]), 6) + F.lit(0.0)).alias("mean"),
            F.round(F.stddev_samp(values[i]), 6).alias("std"),
        )
        for i, name in enumerate(feature_names(model, df))
    ]
    return model.transform(df).agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def _importance_table(df: DataFrame, pairs: Sequence[tuple[str, float]], value: str) -> DataFrame:
    return df.sparkSession.createDataFrame(
        [(name, float(v)) for name, v in pairs], f"feature string, {value} double"
    )


def feature_importance(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Importances of a tree model, one row per feature."""
    if isinstance(model, Fitted):
        return _importance_table(df, model.model.importances(), "importance")
    pairs = zip(feature_names(model, df), model.stages[-1].featureImportances.toArray())
    return _importance_table(df, list(pairs), "importance")


def coefficients(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Coefficients of a linear model on standardised inputs, one row per feature."""
    if isinstance(model, Fitted):
        return _importance_table(df, list(zip(model.model.inputs, model.model.weights)), "coefficient")
    pairs = zip(feature_names(model, df), model.stages[-1].coefficients.toArray())
    return _importance_table(df, list(pairs), "coefficient")


def linear_attribution(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Mean absolute contribution of each feature to the linear score, over all rows.

    Inputs are standardised inside the model, so a contribution is coefficient
    times standardised value.
    """
    names = feature_names(model, df)
    if isinstance(model, Fitted):
        m = model.model
        weights, rows = m.weights, model.indices.transform(df)
        values = [
            (F.col(c).cast("double") - F.lit(float(a))) / F.lit(float(d) or 1.0)
            for c, a, d in zip(m.inputs, m.mean, m.deviation)
        ]
    else:
        weights, rows = model.stages[-1].coefficients.toArray(), model.transform(df)
        values = [vector_to_array("features")[i] for i in range(len(names))]
    cells = [
        F.struct(
            F.lit(name).alias("feature"),
            rounded(F.avg(F.abs(value * F.lit(float(w)))), 6).alias("importance"),
        )
        for name, value, w in zip(names, values, weights)
    ]
    return rows.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def _shuffled_donors(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Every row with the inputs of one other row, the pairing being a random permutation.

    Rows are numbered twice by different hashes of their key; equal numbers pair up.
    """
    def place(salt: str):
        digest = F.md5(F.concat(F.lit(salt), F.col("customer_id").cast("string")))
        return F.conv(F.substring(digest, 1, 12), 16, 10).cast("long")

    placed = materialise(df.withColumns({"_here": place("here"), "_there": place("there")}))
    receivers = add_row_number(placed, "_here", "customer_id", "_number")
    donors = add_row_number(
        placed.select("customer_id", "_there", F.struct(*columns).alias("_donor")),
        "_there",
        "customer_id",
        "_number",
    ).select("_number", "_donor")
    return receivers.join(donors, "_number").drop("_number", "_here", "_there")


def permutation_importance(
    model: PipelineModel | Fitted, df: DataFrame, columns: Sequence[str]
) -> DataFrame:
    """Loss of AUC when one input is shuffled among the rows, one row per input.

    Every row is scored once as it is and once per input with the other row's
    value there, all in one pass; areas are ranked by (input, score) together.
    """
    paired = _shuffled_donors(df, columns)
    variants = F.array(
        *[
            F.struct(
                F.lit(shuffled).alias("_input"),
                *[F.col(f"_donor.{c}" if c == shuffled else c).alias(c) for c in columns],
            )
            for shuffled in ["", *columns]
        ]
    )
    rest = [c for c in df.columns if c not in columns]
    said = model.transform(paired.select(*rest, F.inline(variants)))
    score = vector_to_array("rawPrediction" if "rawPrediction" in said.columns else "probability")[1]
    areas = roc_areas(said.select("_input", "label", score.alias("score")), "score", "label", ["_input"])
    found = {r["_input"]: r["area"] for r in areas.collect()}
    losses = [(c, found.get("", 0.0) - found[c]) for c in columns if c in found]
    return _importance_table(df, losses, "auc_loss")


def value_models(
    train: DataFrame, test: DataFrame, target: str, settings: Settings = Settings()
) -> DataFrame:
    """Lifetime-value regressions: root mean square and mean absolute error per model."""
    forest_model = Pipeline(
        stages=[
            *encoder(settings),
            RandomForestRegressor(labelCol=target, numTrees=settings.trees, maxDepth=10, seed=SEED),
        ]
    ).fit(train)
    said = forest_model.transform(test).select(
        F.lit("Random Forest").alias("model"), F.col(target).cast("double").alias("label"), F.col("prediction").alias("score")
    )
    both = train.withColumn("role", F.lit(TRAIN)).unionByName(test.withColumn("role", F.lit(TEST)))
    rows = both.withColumns({"split": F.lit(0), "fold": F.lit(-1), "label": F.col(target).cast("double")})
    layout = many_models.lay_out(indexer(settings, rows).transform(rows), input_names(settings), [Key(0)])
    sizes = Boosting(
        rounds=settings.boosting_rounds, depth=3, rate=0.1, subsample=1.0, columns=1.0, least_weight=1.0,
        least_gain=0.0, loss="squared",
    )
    boosted_said = many_models.held_out_scores(layout, many_models.boost(layout, sizes), "Gradient Boosting")
    error = F.col("score") - F.col("label")
    return (
        said.unionByName(boosted_said.select("model", "label", "score"))
        .groupBy("model")
        .agg(
            rounded(F.sqrt(F.avg(error * error)), 2).alias("rmse"),
            rounded(F.avg(F.abs(error)), 2).alias("mae"),
        )
    )
