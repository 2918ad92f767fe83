"""Feature, split, metric and model queries."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.operators import features, models, scoring, training
from clientele.operators.churn import risk_segment
from clientele.plans.customer_plans import joined, scored
from clientele.plans.reference_sql import d, define, r, with_tables
from clientele.plans.registry import query
from clientele.sources.adapter import Tables
from clientele.sources.scratch import materialise, scratch_path
from clientele.sources.sinks import (
    load_model,
    model_summary,
    save_model,
    write_json_summary,
)

TRAIN_YEARS, TEST_YEARS = (1995, 1996), (1997,)
FULL = models.Settings()


def partly_missing(t: Tables) -> DataFrame:
    """A table with gaps of every kind: measures, a flag and texts."""
    people = t.customers.select(
        "customer_id", "country", "age", F.col("churned").cast("int").alias("churn")
    )
    seen = t.behaviour.drop("discount", "variant", "additional_revenue")
    return people.join(seen, "customer_id", "left")


define(
    "partly_missing",
    "customers engagement promotions",
    """
    SELECT customer_id, country, age, CAST(churned AS INTEGER) AS churn, weekly_visits,
           session_time_minutes, page_views, app_opens, responded, campaign_name
    FROM customers LEFT JOIN engagement USING (customer_id)
    LEFT JOIN promotions USING (customer_id)""",
)


def _mode(column: str) -> str:
    return f"""(SELECT {column} FROM partly_missing WHERE {column} IS NOT NULL GROUP BY 1
                ORDER BY count(*) DESC, {column} LIMIT 1)"""


define(
    "imputed",
    "partly_missing",
    f"""
    SELECT customer_id, country, churn, {', '.join(
        f"coalesce({d(c)}, (SELECT median({d(c)}) FROM partly_missing)) AS {c}"
        for c in ('age', 'weekly_visits', 'session_time_minutes', 'page_views', 'app_opens'))},
        coalesce(responded, {_mode('responded')}) AS responded,
        coalesce(campaign_name, {_mode('campaign_name')}) AS campaign_name
    FROM partly_missing""",
)


@query("M1_imputation", with_tables("imputed", "SELECT * FROM imputed"))
def _(t):
    return features.impute(partly_missing(t))


@query(
    "M1_remaining_nulls",
    with_tables(
        "imputed",
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS nulls FROM imputed"
            for c in (
                "customer_id country age churn weekly_visits session_time_minutes page_views "
                "app_opens responded campaign_name"
            ).split()
        ),
    ),
)
def _(t):
    return features.remaining_nulls(features.impute(partly_missing(t)))


def churn_features(t: Tables) -> DataFrame:
    spent, orders = F.col("total_spent").cast("double"), F.col("total_orders").cast("double")
    return t.customers.join(t.engagement, "customer_id", "left").select(
        "customer_id",
        orders.alias("total_purchase"),
        (spent / F.nullif(orders, F.lit(0.0))).alias("avg_purchase_value"),
        (F.coalesce("page_views", F.lit(0)) + F.coalesce("app_opens", F.lit(0)))
        .cast("double")
        .alias("engagement_score"),
        F.datediff(t.snapshot(), "last_order_date").cast("double").alias("last_purchase_days"),
        F.col("churned").cast("int").alias("churn"),
    )


define(
    "churn_features",
    "customers engagement snapshot",
    f"""
    SELECT customer_id, {d('total_orders')} AS total_purchase,
           {d('total_spent')} / nullif({d('total_orders')}, 0) AS avg_purchase_value,
           {d('coalesce(page_views, 0) + coalesce(app_opens, 0)')} AS engagement_score,
           {d('(SELECT day FROM snapshot) - last_order_date')} AS last_purchase_days
    FROM customers LEFT JOIN engagement USING (customer_id)""",
)
define(
    "valued",
    "churn_features",
    f"""
    SELECT *, greatest({r('avg_purchase_value * total_purchase * 0.30::DOUBLE', 2)}, 0) AS "CLV",
           {r('''total_purchase / greatest((last_purchase_days + 180) / 365.0::DOUBLE, 0.5)''', 4)}
               AS purchase_frequency
    FROM churn_features""",
)


@query(
    "M2_lifetime_value",
    with_tables("valued", 'SELECT customer_id, "CLV", purchase_frequency FROM valued'),
)
def _(t):
    return features.lifetime_value(churn_features(t)).select(
        "customer_id", "CLV", "purchase_frequency"
    )


@query(
    "M3_activity_features",
    with_tables(
        "valued",
        f"""SELECT customer_id,
            {r('exp(-last_purchase_days / 30.0::DOUBLE) * engagement_score', 4)} AS engagement_decay,
            last_purchase_days AS days_since_purchase,
            CAST("CLV" >= 1000 AS INTEGER) AS is_high_value FROM valued""",
    ),
)
def _(t):
    return features.activity_features(features.lifetime_value(churn_features(t))).select(
        "customer_id", "engagement_decay", "days_since_purchase", "is_high_value"
    )


@query(
    "M4_value_quartile",
    with_tables(
        "valued",
        """SELECT customer_id, CASE WHEN "CLV" <= q[1] THEN 'Low' WHEN "CLV" <= q[2] THEN 'Medium'
           WHEN "CLV" <= q[3] THEN 'High' ELSE 'Very High' END AS churn_risk_segment
           FROM valued, (SELECT quantile_cont("CLV", [0.25, 0.5, 0.75]) AS q FROM valued)""",
    ),
)
def _(t):
    return features.business_features(churn_features(t)).select(
        "customer_id", "churn_risk_segment"
    )


@query(
    "M5_training_features",
    with_tables(
        "base",
        f"""SELECT customer_id, {r('months_since_signup / 12.0::DOUBLE', 2)} AS tenure_years,
            {r(d('total_spent') + ' / greatest(months_since_signup, 1)', 2)} AS spend_per_month,
            {r('''weekly_visits * 0.3::DOUBLE + session_time_minutes * 0.2::DOUBLE
                + page_views * 0.25::DOUBLE + app_opens * 0.25::DOUBLE''', 3)} AS engagement_score
            FROM base""",
    ),
)
def _(t):
    return features.training_features(joined(t)).select(
        "customer_id", "tenure_years", "spend_per_month", "engagement_score"
    )


@query(
    "M6_label_index",
    with_tables(
        "customers",
        f"""SELECT customer_id, {', '.join(
            f"{d(f'dense_rank() OVER (ORDER BY {c}) - 1')} AS {c}_index"
            for c in ('gender', 'customer_tier', 'country'))} FROM customers""",
    ),
)
def _(t):
    columns = ["gender", "customer_tier", "country"]
    rows = materialise(t.demographics.select("customer_id", *columns))
    return features.label_indices(rows, columns).select(
        "customer_id", *[f"{c}_index" for c in columns]
    )


@query("M6_one_hot_regression")
def _(t):
    table = training.training_table(joined(t))
    model = models.fit(models.logistic(FULL, models.label_counts(table, FULL.categorical)), table)
    return models.coefficients(model, table).orderBy(F.desc("coefficient"))


define(
    "placed",
    "customers",
    """
    SELECT customer_id, signup_date, CAST(churned AS INTEGER) AS churned,
           row_number() OVER (PARTITION BY churned
               ORDER BY substr(md5(CAST(customer_id AS VARCHAR)), 1, 12), customer_id) AS place,
           count(*) OVER (PARTITION BY churned) AS size
    FROM customers""",
)


@query(
    "M7_stratified_split",
    with_tables(
        "placed",
        """SELECT customer_id, churned, CASE WHEN place <= ceil(size * 200 / 1000.0) THEN 'test'
           ELSE 'train' END AS split FROM placed""",
    ),
)
def _(t):
    rows = t.customers.select("customer_id", F.col("churned").cast("int").alias("churned"))
    return features.stratified_split(rows, "churned")


@query(
    "M15_stratified_folds",
    with_tables(
        "placed",
        """SELECT customer_id, CAST((place > size // 5)::INT + (place > size * 2 // 5)::INT
           + (place > size * 3 // 5)::INT + (place > size * 4 // 5)::INT AS INTEGER) AS fold
           FROM placed""",
    ),
)
def _(t):
    rows = t.customers.select("customer_id", F.col("churned").cast("int").alias("churned"))
    return features.add_folds(rows, "churned").drop("churned")


define(
    "by_year",
    "customers",
    """
    SELECT *, CASE WHEN year(signup_date) IN (1995, 1996) THEN 'train' ELSE 'test' END AS split
    FROM customers WHERE year(signup_date) IN (1995, 1996, 1997)""",
)


@query(
    "M8_out_of_time_split",
    with_tables("by_year", "SELECT customer_id, signup_date, split FROM by_year"),
)
def _(t):
    return features.split_by_signup_year(t.demographics, TRAIN_YEARS, TEST_YEARS).select(
        "customer_id", "signup_date", "split"
    )


@query(
    "M9_label_shift",
    with_tables(
        "by_year",
        f"""SELECT CASE WHEN grouping(split) = 1 THEN 'overall' ELSE split END AS split,
            count(*) AS n, {r('avg(CAST(churned AS INTEGER))', 4)} AS label_rate
            FROM by_year GROUP BY ROLLUP (split)""",
    ),
)
def _(t):
    return features.label_rates(
        features.split_by_signup_year(t.customers, TRAIN_YEARS, TEST_YEARS), "churned"
    )


@query(
    "M14_class_weights",
    with_tables(
        "customers",
        f"""SELECT CAST(churned AS INTEGER) AS label, count(*) AS n,
            {r(f"sum(count(*)) OVER () / (count(*) OVER () * {d('count(*)')})", 6)} AS weight,
            {r('''(SELECT CAST(count(*) FILTER (NOT churned) AS DOUBLE) / count(*) FILTER (churned)
                   FROM customers)''', 6)} AS positive_weight
            FROM customers GROUP BY 1""",
    ),
)
def _(t):
    return features.class_weights(t.customers, "churned")


@query(
    "M16_roc_auc",
    with_tables(
        "scored",
        f"""SELECT pos AS positives, neg AS negatives,
            {r(d('won') + ' / (CAST(pos AS DOUBLE) * neg * 2)', 6)} AS roc_auc
            FROM (SELECT CAST(sum(p) AS BIGINT) AS pos, CAST(sum(n) AS BIGINT) AS neg,
                  sum(p * (2 * below + n)) AS won FROM (
                    SELECT *, coalesce(sum(n) OVER (ORDER BY churn_prob
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
                    FROM (SELECT churn_prob, count(*) FILTER (churned) AS p,
                          count(*) FILTER (NOT churned) AS n FROM scored GROUP BY 1)))""",
    ),
)
def _(t):
    return scoring.roc_auc(scored(t), "churn_prob", "churned")


@query(
    "M17_confusion_metrics",
    with_tables(
        "scored",
        f"""SELECT 0.8::DOUBLE AS threshold, tn, fp, fn, tp,
            {r(d('tp + tn') + ' / (tp + tn + fp + fn)', 4)} AS accuracy,
            coalesce({r(d('tp') + ' / nullif(tp + fp, 0)', 4)}, 0) AS precision,
            coalesce({r(d('tp') + ' / nullif(tp + fn, 0)', 4)}, 0) AS recall,
            coalesce({r(d('2 * tp') + ' / nullif(2 * tp + fp + fn, 0)', 4)}, 0) AS f1
            FROM (SELECT count(*) FILTER (churned AND churn_prob >= 0.8) AS tp,
                  count(*) FILTER (NOT churned AND churn_prob >= 0.8) AS fp,
                  count(*) FILTER (churned AND churn_prob < 0.8) AS fn,
                  count(*) FILTER (NOT churned AND churn_prob < 0.8) AS tn FROM scored)""",
    ),
)
def _(t):
    return scoring.confusion_metrics(scored(t), "churn_prob", "churned", 0.8)


@query(
    "M18_best_threshold",
    with_tables(
        "scored",
        f"""SELECT churn_prob AS threshold, f1 FROM (
              SELECT churn_prob, {r('''2 * tp / (tp + fp) * (tp / pos)
                  / (tp / (tp + fp) + tp / pos + 1e-9::DOUBLE)''', 6)} AS f1
              FROM (SELECT churn_prob, {d('sum(p) OVER w')} AS tp, {d('sum(n) OVER w')} AS fp,
                           {d('sum(p) OVER ()')} AS pos
                    FROM (SELECT churn_prob, count(*) FILTER (churned) AS p,
                          count(*) FILTER (NOT churned) AS n FROM scored GROUP BY 1)
                    WINDOW w AS (ORDER BY churn_prob DESC)))
            ORDER BY f1 DESC, churn_prob LIMIT 1""",
    ),
)
def _(t):
    return scoring.best_threshold(scored(t), "churn_prob", "churned")


@query(
    "M22_risk_bins",
    with_tables(
        "scored",
        """SELECT customer_id, churn_prob, risk_segment,
           CASE WHEN churn_prob <= 0.3 THEN 'Low Risk' WHEN churn_prob <= 0.6 THEN 'Medium Risk'
                ELSE 'High Risk' END AS risk_even,
           CASE WHEN churn_prob <= 0.33 THEN 'Low Risk' WHEN churn_prob <= 0.66 THEN 'Medium Risk'
                ELSE 'High Risk' END AS risk_thirds FROM scored""",
    ),
)
def _(t):
    p = F.col("churn_prob")
    return scored(t).select(
        "customer_id",
        "churn_prob",
        "risk_segment",
        risk_segment(p, (0.0, 0.3, 0.6, 1.0)).alias("risk_even"),
        risk_segment(p, (0.0, 0.33, 0.66, 1.0)).alias("risk_thirds"),
    )


def table(t: Tables) -> DataFrame:
    return training.training_table(joined(t))


_CODES = "gender country customer_tier".split()
_CAST = {c: d(c) for c in "age months_since_signup clv total_spent weekly_visits app_opens num_promotions_responded".split()}
_FLAG = {c: d(f"CAST({c} AS INTEGER)") for c in ("high_spender", "high_engagement")}
_MADE = {
    "tenure_years": r("months_since_signup / 12.0::DOUBLE", 2),
    "spend_per_month": r(d("total_spent") + " / greatest(months_since_signup, 1)", 2),
    "engagement_score": r(
        "weekly_visits * 0.3::DOUBLE + session_time_minutes * 0.2::DOUBLE"
        " + page_views * 0.25::DOUBLE + app_opens * 0.25::DOUBLE",
        3,
    ),
} | {f"{c}_index": d(f"dense_rank() OVER (ORDER BY {c}) - 1") for c in _CODES}
define(
    "training",
    "base",
    f"""
    SELECT next_purchase_prob, session_time_minutes, page_views,
        {', '.join(f'{sql} AS {c}' for c, sql in (_CAST | _FLAG | _MADE).items())}
    FROM (
      SELECT * EXCLUDE (weekly_visits, app_opens, session_time_minutes, page_views),
        coalesce(weekly_visits, 0) AS weekly_visits, coalesce(app_opens, 0) AS app_opens,
        coalesce(session_time_minutes, (SELECT median(session_time_minutes) FROM base)) AS session_time_minutes,
        coalesce({d('page_views')}, (SELECT median(page_views) FROM base)) AS page_views,
        coalesce({d('total_spent')} >= (SELECT quantile_cont({d('total_spent')}, 0.99) FROM base), false)
            AS high_spender,
        coalesce(weekly_visits >= (SELECT quantile_cont({d('weekly_visits')}, 0.99) FROM base), false)
            AS high_engagement
      FROM base)""",
)


def _standardised_sql(name: str) -> str:
    z = f"({name} - (SELECT avg({name}) FROM training)) / (SELECT nullif(stddev_samp({name}), 0) FROM training)"
    return f"""SELECT '{name}' AS feature, round(coalesce(avg({z}), 0), 6) + 0.0::DOUBLE AS mean,
               round(coalesce(stddev_samp({z}), 0), 6) AS std FROM training"""


@query(
    "M10_standardised_features",
    with_tables(
        "training",
        " UNION ALL ".join(_standardised_sql(c) for c in [*models.MEASURES, *[f"{c}_index" for c in _CODES]]),
    ),
)
def _(t):
    rows = table(t)
    scaler = Pipeline(stages=models.encoder(FULL, scaled=True)).fit(rows)
    return models.slot_statistics(scaler, rows)


def _fit_and_evaluate(t: Tables, name: str, settings: models.Settings) -> DataFrame:
    train, test = training.standard_split(table(t))
    model = models.fit(models.ESTIMATORS[name](settings), train)
    return models.evaluate(model, test)


@query("M11_logistic_regression")
def _(t):
    return _fit_and_evaluate(t, models.LOGISTIC, models.Settings())


@query("M12_random_forest")
def _(t):
    return _fit_and_evaluate(t, models.FOREST, models.Settings())


@query("M13_gradient_boosting")
def _(t):
    return _fit_and_evaluate(t, models.BOOSTED, FULL)


@query("M15_cross_validation")
def _(t):
    train, _ = training.standard_split(table(t))
    return models.cross_validate(models.LOGISTIC, train, FULL)


#: The last comparison of this process, by application and content of the training table.
_STORED: dict[tuple, models.Comparison] = {}


def _compared(rows: DataFrame) -> models.Comparison:
    """The comparison on ``rows``, fitted once per application and content of the table.

    Its table is written to the shared folder, and what is asked later reads that.
    """
    content = rows.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(*))")).first()
    key = (rows.sparkSession.sparkContext.applicationId, *content, FULL)
    if key not in _STORED:
        found = models.compare(
            {
                "standard": training.standard_split(rows),
                "out of time": training.signup_split(rows, TRAIN_YEARS, TEST_YEARS),
            },
            FULL,
        )
        path = scratch_path(rows.sparkSession, "comparison")
        found.table.write.parquet(path)
        _STORED.clear()
        _STORED[key] = models.Comparison(rows.sparkSession.read.parquet(path), found.models)
    return _STORED[key]


@query("M19_model_comparison")
def _(t):
    rows = _compared(table(t)).table
    drop = models.auc_drop(rows, "standard", "out of time").select("model", "auc_drop")
    return rows.join(drop, "model").orderBy(F.desc("roc_auc"))


@query("U2_stacked_evaluations")
def _(t):
    return _compared(table(t)).table


@query("L6_best_model_per_split")
def _(t):
    return models.best_models(_compared(table(t)).table)


@query("M20_feature_importance")
def _(t):
    rows = table(t)
    model = models.forest(FULL).fit(rows)
    return models.feature_importance(model, rows).orderBy(F.desc("importance")).limit(10)


@query("M20_coefficients")
def _(t):
    rows = table(t)
    model = models.logistic(FULL).fit(rows)
    return models.coefficients(model, rows).orderBy(F.desc("coefficient"))


@query("M21_linear_attribution")
def _(t):
    rows = table(t)
    return models.linear_attribution(models.logistic(FULL).fit(rows), rows).orderBy(
        F.desc("importance")
    )


@query("M21_permutation_importance")
def _(t):
    rows = table(t)
    return models.permutation_importance(
        models.logistic(FULL).fit(rows), rows, models.MEASURES
    ).orderBy(F.desc("auc_loss"))


@query("M22_batch_scoring")
def _(t):
    rows = table(t)
    return models.score(models.forest(FULL).fit(rows), rows).select(
        "customer_id", "churn_prob", "risk_segment"
    )


@query("M23_value_regression")
def _(t):
    measures = [m for m in models.MEASURES if m not in ("clv", "total_spent", "spend_per_month")]
    settings = models.Settings(measures=measures)
    train, test = training.standard_split(table(t))
    return models.value_models(train, test, "clv", settings)


@query("S11_saved_model_scores")
def _(t):
    rows = table(t)
    path = scratch_path(t.spark, "model")
    save_model(models.logistic(FULL).fit(rows), path)
    return models.score(load_model(path), rows).select("customer_id", "churn_prob", "risk_segment")


@query("S10_json_summary")
def _(t):
    rows = table(t)
    path = scratch_path(t.spark, "summary")
    comparison = _compared(rows)
    weights = models.linear_attribution(comparison.models[models.LOGISTIC, "standard"], rows)
    write_json_summary(model_summary(comparison.table, weights), path)
    return t.spark.read.json(path)


@query("M28_end_to_end")
def _(t):
    outcome = training.run(
        joined(t),
        TRAIN_YEARS,
        TEST_YEARS,
        FULL,
        output=scratch_path(t.spark, "run"),
        snapshot=t.snapshot(),
    )
    return outcome.report
