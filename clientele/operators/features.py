"""Imputation, business features, training features, splits and class weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import StringIndexer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientele.functions.numeric import clipped, ratio, rounded, upper_edge_label
from clientele.functions.ordering import Sample, counts, cuts, percentiles
from clientele.sources.scratch import materialise

VALUE_LABELS = ("Low", "Medium", "High", "Very High")


def _kinds(df: DataFrame, untouched: Sequence[str]) -> tuple[list[str], list[str], list[str]]:
    """Columns by treatment: binary, other numeric, text. One aggregate decides."""
    candidates = [f for f in df.schema if f.name not in untouched]
    numeric = [f.name for f in candidates if isinstance(f.dataType, T.NumericType)]
    text = [f.name for f in candidates if isinstance(f.dataType, T.StringType)]
    flags = [f.name for f in candidates if isinstance(f.dataType, T.BooleanType)]
    if not numeric:
        return flags, [], text
    row = df.agg(
        *[
            F.count_if(F.col(c).isNotNull() & ~F.col(c).cast("double").isin(0.0, 1.0)).alias(c)
            for c in numeric
        ]
    ).first()
    binary = [c for c in numeric if row[c] == 0]
    return flags + binary, [c for c in numeric if c not in binary], text


def _modes(df: DataFrame, columns: Sequence[str]) -> dict[str, object]:
    """The commonest value of each column; of equally common ones the smallest.

    Values are counted in one grouped aggregate over all columns; only the
    winner of each column reaches the driver.
    """
    if not columns:
        return {}
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("text"))
            for c in columns
        ]
    )
    counted = (
        df.select(F.inline(cells))
        .where(F.col("text").isNotNull())
        .groupBy("name", "text")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    winners = counted.groupBy("name").agg(
        F.min(F.struct((-F.col("n")).alias("minus"), "text")).getField("text").alias("text")
    )
    return {row["name"]: row["text"] for row in winners.collect()}


def impute(df: DataFrame, untouched: Sequence[str] = ("customer_id", "churn")) -> DataFrame:
    """Fill missing values: median for measures, commonest value for flags and texts.

    Identifier and target are left alone; no row is dropped. A column without
    any value stays empty.
    """
    base = materialise(df)
    binary, measures, text = _kinds(base, untouched)
    medians = percentiles(base, [(Sample(F.col(c)), [0.5]) for c in measures])
    modes = _modes(base, binary + text)
    filled: dict[str, Column] = {}
    for c, (median,) in zip(measures, medians):
        if median is not None:
            value = F.col(c).cast("double")
            filled[c] = F.coalesce(value, F.lit(median))
    for c in binary + text:
        if c in modes:
            filled[c] = F.coalesce(F.col(c), F.lit(modes[c]).cast(base.schema[c].dataType))
    if "churn" in base.columns:
        filled["churn"] = F.col("churn").cast("int")
    return base.withColumns(filled)


def remaining_nulls(df: DataFrame) -> DataFrame:
    """Null values left per column, one row per column."""
    cells = [
        F.struct(F.lit(c).alias("column_name"), F.count_if(F.col(c).isNull()).alias("nulls"))
        for c in df.columns
    ]
    return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def lifetime_value(df: DataFrame, margin: float = 0.30) -> DataFrame:
    """Lifetime value and yearly order frequency.

    The life span is a given column, or the days since the last purchase plus
    180, in years, at least half a year. It cancels out of the value.
    """
    if "customer_lifespan_years" in df.columns:
        span = F.greatest(F.col("customer_lifespan_years"), F.lit(0.5))
    else:
        span = F.greatest((F.col("last_purchase_days") + 180) / F.lit(365.0), F.lit(0.5))
    yearly = F.col("total_purchase") / span
    value = F.col("avg_purchase_value") * F.col("total_purchase") * margin
    return df.withColumns(
        {
            "CLV": F.greatest(rounded(value, 2), F.lit(0.0)),
            "purchase_frequency": rounded(yearly, 4),
        }
    )


def activity_features(df: DataFrame, high_value: float = 1000.0) -> DataFrame:
    """Decayed engagement, days since purchase and the high-value flag."""
    decay = F.exp(-F.col("last_purchase_days") / F.lit(30.0)) * F.col("engagement_score")
    return df.withColumns(
        {
            "engagement_decay": rounded(decay, 4),
            "days_since_purchase": F.col("last_purchase_days"),
            "is_high_value": (F.col("CLV") >= high_value).cast("int"),
        }
    )


def value_quartile(df: DataFrame, value: str = "CLV") -> DataFrame:
    """Quartile label of the lifetime value."""
    (edges,) = percentiles(df, [(Sample(F.col(value)), [0.25, 0.5, 0.75])])
    if edges[0] is None:
        return df.withColumn("churn_risk_segment", F.lit(None).cast("string"))
    return df.withColumn(
        "churn_risk_segment",
        upper_edge_label(F.col(value).cast("double"), edges, VALUE_LABELS),
    )


def business_features(df: DataFrame, margin: float = 0.30) -> DataFrame:
    """All six business features."""
    return value_quartile(materialise(activity_features(lifetime_value(df, margin))))


def training_features(base: DataFrame) -> DataFrame:
    """Tenure in years, spend per month and weighted engagement."""
    months = F.col("months_since_signup")
    score = (
        F.col("weekly_visits") * F.lit(0.3)
        + F.col("session_time_minutes") * F.lit(0.2)
        + F.col("page_views") * F.lit(0.25)
        + F.col("app_opens") * F.lit(0.25)
    )
    return base.withColumns(
        {
            "tenure_years": rounded(months / F.lit(12.0), 2),
            "spend_per_month": rounded(ratio("total_spent", clipped(months, low=1)), 2),
            "engagement_score": rounded(score, 3),
        }
    )


def stratified_split(
    df: DataFrame, label: str, key: str = "customer_id", test_share: float = 0.2
) -> DataFrame:
    """Add ``split``: a fixed share of every class, picked by the hash of the key.

    The share of each class is exact. Which hash ends a class's test share is an
    order statistic, so no class is ever sorted in one task.
    """
    hashed = materialise(df.withColumn("_place", _hash_place(key)))
    edge = _class_ladder(
        hashed, label, key, lambda size: [-(-size * round(test_share * 1000) // 1000)]
    )
    in_test = edge(0)
    return hashed.withColumn(
        "split", F.when(in_test, F.lit("test")).otherwise(F.lit("train"))
    ).drop("_place")


def _hash_place(key: str) -> Column:
    """A whole number from the key's md5: the same in every engine and session."""
    digest = F.substring(F.md5(F.col(key).cast("string")), 1, 12)
    return F.conv(digest, 16, 10).cast("long")


def _class_ladder(hashed: DataFrame, label: str, key: str, ranks):
    """For both classes of a 0/1 label: conditions "among the first rank rows by hash"."""
    place = F.col("_place")
    classes = [0, 1]
    samples = [Sample(place, F.col(label).cast("int") == c) for c in classes]
    sizes = counts(hashed, samples)
    wanted = [ranks(size) for size in sizes]
    requests = [(s, [k for k in w if 1 <= k <= n]) for s, w, n in zip(samples, wanted, sizes)]
    found = cuts(hashed, key, requests, sizes)

    def condition(i: int) -> Column:
        inside = F.lit(False)
        for c, w, cut in zip(classes, wanted, found):
            if w[i] in cut:
                inside = inside | (
                    (F.col(label).cast("int") == c)
                    & cut[w[i]].covers(place, F.col(key))
                )
        return inside

    return condition


def add_folds(df: DataFrame, label: str, key: str = "customer_id", folds: int = 5) -> DataFrame:
    """Add ``fold``: every class cut into equal slices along the hash of the key."""
    hashed = materialise(df.withColumn("_place", _hash_place(key)))
    ends = _class_ladder(hashed, label, key, lambda size: [size * k // folds for k in range(1, folds)])
    ladder = F.when(F.lit(False), F.lit(None).cast("int"))
    for k in range(folds - 1):
        ladder = ladder.when(ends(k), F.lit(k))
    return hashed.withColumn("fold", ladder.otherwise(F.lit(folds - 1))).drop("_place")


def split_by_signup_year(
    df: DataFrame, train_years: Sequence[int], test_years: Sequence[int]
) -> DataFrame:
    """Add ``split`` by year of signup; customers of other years are left out."""
    year = F.year("signup_date")
    return df.withColumn(
        "split",
        F.when(year.isin(list(train_years)), "train").when(year.isin(list(test_years)), "test"),
    ).where(F.col("split").isNotNull())


def label_rates(split: DataFrame, label: str) -> DataFrame:
    """Rows and share of positives per split and over both."""
    positive = F.col(label).cast("int")
    return (
        split.rollup("split")
        .agg(
            F.count(F.lit(1)).alias("n"),
            rounded(F.avg(positive), 4).alias("label_rate"),
            F.grouping_id().alias("_all"),
        )
        .select(
            F.when(F.col("_all") == 1, F.lit("overall")).otherwise(F.col("split")).alias("split"),
            "n",
            "label_rate",
        )
    )


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weights n / (k n_c) and negatives per positive, one row per class."""
    everything = W.partitionBy()
    n = F.sum("n").over(everything)
    negatives = F.sum(F.when(F.col("label") == 0, F.col("n"))).over(everything)
    positives = F.sum(F.when(F.col("label") == 1, F.col("n"))).over(everything)
    return (
        df.groupBy(F.col(label).cast("int").alias("label"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            "label",
            "n",
            rounded(n / (F.count("label").over(everything) * F.col("n")), 6).alias("weight"),
            rounded(ratio(negatives, positives), 6).alias("positive_weight"),
        )
    )


def with_class_weight(df: DataFrame, label: str, output: str = "weight") -> DataFrame:
    """Attach the balanced weight of a 0/1 label; both come from one scalar."""
    positive = F.col(label).cast("int") == 1
    sizes = df.agg(
        F.struct(F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg"))
    ).scalar()
    total = (sizes.pos + sizes.neg).cast("double")
    own = F.when(positive, sizes.pos).otherwise(sizes.neg)
    return df.withColumn(output, total / (F.lit(2) * own))


def label_indices(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Alphabetical index of each label, for columns with few labels."""
    indexer = StringIndexer(
        inputCols=list(columns),
        outputCols=[f"{c}_index" for c in columns],
        stringOrderType="alphabetAsc",
    )
    return indexer.fit(df).transform(df)
