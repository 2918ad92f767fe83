"""A/B statistics for any number of experiments in one job.

The observations are reduced to moments per experiment in one aggregate with
map-side partials; every test is a column expression on that one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.functions.numeric import clipped, first_match, ratio, rounded
from clientele.functions.stats import (
    chi_square_tail_udf,
    normal_quantile,
    t_cdf_udf,
    t_quantile_udf,
    t_two_sided_udf,
)
from clientele.functions.text import dollars, percentage
from clientele.sources.scratch import materialise

ALL = "all"


def moments(
    df: DataFrame,
    experiment: str,
    variant: str,
    metric: str,
    binary: str | None = None,
    with_total: bool = True,
) -> DataFrame:
    """Rows, values, means and variances of both arms per experiment.

    ``variant`` is 0 for control and 1 for treatment and must not depend on the
    outcome. With ``with_total``, one more row pools all experiments.
    """
    control, treatment = F.col(variant) == 0, F.col(variant) == 1
    value = F.col(metric).cast("double")
    aggregates = []
    for arm, inside in (("control", control), ("treatment", treatment)):
        kept = F.when(inside, value)
        aggregates += [
            F.count_if(inside).alias(f"{arm}_rows"),
            F.count(kept).alias(f"{arm}_n"),
            F.sum(F.when(inside, F.col(metric))).cast("double").alias(f"{arm}_sum"),
            F.var_samp(kept).alias(f"{arm}_var"),
        ]
        if binary is not None:
            hit = F.when(inside, F.col(binary).cast("int"))
            aggregates += [
                F.count(hit).alias(f"{arm}_trials"),
                F.coalesce(F.sum(hit), F.lit(0)).alias(f"{arm}_hits"),
            ]
    if with_total:
        grouped = df.rollup(experiment).agg(*aggregates, F.grouping_id().alias("_pooled"))
        name = F.when(F.col("_pooled") == 1, F.lit(ALL)).otherwise(F.col(experiment))
    else:
        grouped = df.groupBy(experiment).agg(*aggregates)
        name = F.col(experiment)
    return grouped.withColumns(
        {
            "experiment": name,
            "control_mean": ratio("control_sum", "control_n"),
            "treatment_mean": ratio("treatment_sum", "treatment_n"),
        }
    ).drop("_pooled", *([experiment] if experiment != "experiment" else []))


def split_check(m: DataFrame, expected: float = 0.5, alpha: float = 0.01) -> DataFrame:
    """Chi-square of the observed split against the intended one."""
    nc, nt = F.col("control_rows").cast("double"), F.col("treatment_rows").cast("double")
    total = nc + nt
    chi2 = F.pow(nc - total * expected, 2) / (total * expected) + F.pow(
        nt - total * (1 - expected), 2
    ) / (total * (1 - expected))
    return m.withColumn("_chi2", chi2).select(
        "experiment",
        F.col("control_rows").alias("n_control"),
        F.col("treatment_rows").alias("n_treatment"),
        rounded("_chi2", 4).alias("chi2"),
        rounded(chi_square_tail_udf("_chi2"), 6).alias("p_value"),
        rounded(nc / total, 4).alias("actual_split"),
        F.lit(expected).alias("expected_split"),
        (F.col("_chi2") > F.lit(normal_quantile(1 - alpha / 2) ** 2)).alias("srm_detected"),
    )


def _error(arm: str) -> Column:
    return F.col(f"{arm}_var") / F.col(f"{arm}_n")


def welch_dof() -> Column:
    """Welch-Satterthwaite degrees of freedom; the pooled ones without any variance."""
    a, b = _error("control"), _error("treatment")
    below = F.pow(a, 2) / (F.col("control_n") - 1) + F.pow(b, 2) / (F.col("treatment_n") - 1)
    pooled = (F.col("control_n") + F.col("treatment_n") - 2).cast("double")
    return F.when(below > 0, F.pow(a + b, 2) / below).when(below == 0, pooled)


def welch_test(m: DataFrame, alpha: float = 0.05, alternative: str = "two-sided") -> DataFrame:
    """Welch's t with p, lift and confidence interval.

    t is control minus treatment, so its sign is opposite to the lift; the
    interval is two-sided whatever the alternative. Without any variance t is
    null, and different means are significant.
    """
    if alternative not in ("two-sided", "less", "greater"):
        raise ValueError(f"unknown alternative: {alternative}")
    difference = F.col("treatment_mean") - F.col("control_mean")
    prepared = m.withColumns(
        {
            "lift": difference,
            "error": F.sqrt(_error("control") + _error("treatment")),
            "dof": F.when(
                (F.col("control_n") > 1) & (F.col("treatment_n") > 1), welch_dof()
            ),
        }
    ).withColumn("t", -F.col("lift") / F.nullif(F.col("error"), F.lit(0.0)))
    if alternative == "two-sided":
        p = t_two_sided_udf("t", "dof")
        certain = F.col("lift") != 0
    else:
        below = t_cdf_udf("t", "dof")
        p = below if alternative == "less" else 1 - below
        certain = F.col("lift") > 0 if alternative == "less" else F.col("lift") < 0
    flat = F.col("error") == 0
    tested = prepared.withColumns(
        {
            "critical": t_quantile_udf(F.lit(1 - alpha / 2), "dof"),
            "p": F.when(flat & certain, F.lit(0.0)).when(~flat, p),
        }
    )
    reach = F.col("critical") * F.col("error")
    return tested.select(
        "experiment",
        rounded("t", 4).alias("t_statistic"),
        rounded("dof", 4).alias("degrees_of_freedom"),
        rounded("p", 6).alias("p_value"),
        F.coalesce(F.col("p") < alpha, F.lit(False)).alias("significant"),
        rounded("control_mean", 4).alias("control_mean"),
        rounded("treatment_mean", 4).alias("treatment_mean"),
        rounded("lift", 4).alias("absolute_lift"),
        rounded(ratio("lift", "control_mean") * 100, 2).alias("relative_lift_pct"),
        rounded(F.col("lift") - reach, 4).alias("ci_lower"),
        rounded(F.col("lift") + reach, 4).alias("ci_upper"),
        "control_n",
        "treatment_n",
        F.lit(alpha).alias("alpha"),
        F.lit(alternative).alias("alternative"),
    )


def chi_square_test(m: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Chi-square of the 2x2 table of conversions, without continuity correction."""
    a = F.col("control_hits").cast("double")
    b = F.col("control_trials").cast("double") - a
    c = F.col("treatment_hits").cast("double")
    d = F.col("treatment_trials").cast("double") - c
    chi2 = (a + b + c + d) * F.pow(a * d - b * c, 2) / F.nullif(
        (a + b) * (c + d) * (a + c) * (b + d), F.lit(0.0)
    )
    control, treatment = ratio("control_hits", "control_trials"), ratio(
        "treatment_hits", "treatment_trials"
    )
    counts = [
        F.array(F.col(f"{arm}_hits"), F.col(f"{arm}_trials") - F.col(f"{arm}_hits"))
        for arm in ("control", "treatment")
    ]
    return m.withColumn("_chi2", chi2).select(
        "experiment",
        rounded("_chi2", 4).alias("chi2_statistic"),
        rounded(chi_square_tail_udf("_chi2"), 6).alias("p_value"),
        F.lit(1).alias("degrees_of_freedom"),
        F.coalesce(
            F.col("_chi2") > F.lit(normal_quantile(1 - alpha / 2) ** 2), F.lit(False)
        ).alias("significant"),
        rounded(control, 4).alias("control_conversion_rate"),
        rounded(treatment, 4).alias("treatment_conversion_rate"),
        rounded((treatment - control) * 100, 2).alias("absolute_lift_pct"),
        rounded(ratio(treatment - control, control) * 100, 2).alias("relative_lift_pct"),
        F.col("control_trials").alias("control_n"),
        F.col("treatment_trials").alias("treatment_n"),
        F.array(*counts).alias("contingency_table"),
    )


def effect_size(m: DataFrame) -> DataFrame:
    """Cohen's d with the pooled deviation; zero when there is none or it is undefined."""
    nc, nt = F.col("control_n"), F.col("treatment_n")
    pooled = F.sqrt(
        ((nc - 1) * F.col("control_var") + (nt - 1) * F.col("treatment_var"))
        / F.nullif((nc + nt - 2).cast("double"), F.lit(0.0))
    )
    difference = F.col("treatment_mean") - F.col("control_mean")
    d = F.when(F.col("_pooled") > 0, difference / F.nullif(F.col("_pooled"), F.lit(0.0))).otherwise(
        F.lit(0.0)
    )
    size = F.abs(F.col("_d"))
    magnitude = first_match(
        [(size < 0.2, "negligible"), (size < 0.5, "small"), (size < 0.8, "medium")], "large"
    )
    return (
        m.withColumn("_pooled", pooled)
        .withColumn("_d", d)
        .select(
            "experiment",
            rounded("_d", 4).alias("cohens_d"),
            magnitude.alias("magnitude"),
            rounded("_pooled", 4).alias("pooled_std"),
        )
    )


def minimum_sample(
    baseline: Column, effect: float = 0.10, alpha: float = 0.05, power: float = 0.80
) -> Column:
    """Customers needed per arm to see a relative lift of ``effect``; two proportions."""
    z_alpha, z_beta = normal_quantile(1 - alpha / 2), normal_quantile(power)
    target = baseline * (1 + effect)
    mean = (baseline + target) / 2
    spread = F.lit(z_alpha) * F.sqrt(mean * 2 * (1 - mean)) + F.lit(z_beta) * F.sqrt(
        baseline * (1 - baseline) + target * (1 - target)
    )
    return F.ceil(F.pow(spread, 2) / F.pow(target - baseline, 2)).cast("long")


def observed_baseline() -> Column:
    """The overall conversion rate, kept between one and 99 percent."""
    hits = F.col("control_hits") + F.col("treatment_hits")
    return clipped(ratio(hits, F.col("control_trials") + F.col("treatment_trials")), 0.01, 0.99)


def sample_requirement(
    m: DataFrame,
    baseline: Column | None = None,
    effect: float = 0.10,
    alpha: float = 0.05,
    power: float = 0.80,
) -> DataFrame:
    """The sample needed for each experiment's baseline and whether both arms have it."""
    prepared = m.withColumn("_base", observed_baseline() if baseline is None else baseline)
    base = F.col("_base")
    sized = prepared.withColumn("n_per_group", minimum_sample(base, effect, alpha, power))
    return sized.select(
        "experiment",
        "n_per_group",
        (F.col("n_per_group") * 2).alias("total_n"),
        rounded(base, 4).alias("baseline_rate"),
        rounded(base * (1 + effect), 4).alias("target_rate"),
        rounded(base * effect, 4).alias("mde_absolute"),
        rounded(F.lit(effect * 100), 1).alias("mde_relative_pct"),
        F.lit(alpha).alias("alpha"),
        F.lit(power).alias("power"),
        F.lit(round(normal_quantile(1 - alpha / 2), 4)).alias("z_alpha"),
        F.lit(round(normal_quantile(power), 4)).alias("z_beta"),
        (
            (F.col("control_n") >= F.col("n_per_group"))
            & (F.col("treatment_n") >= F.col("n_per_group"))
        ).alias("adequately_powered"),
    )


def revenue_impact(tested: DataFrame, annual_users: int = 10_000) -> DataFrame:
    """The lift scaled to a year of users, its bounds, and what to do about it."""
    projected = F.col("absolute_lift") * annual_users
    low, high = F.col("ci_lower") * annual_users, F.col("ci_upper") * annual_users
    relative = F.coalesce(percentage("relative_lift_pct"), F.lit("not defined"))
    ship = F.concat(
        F.lit("SHIP: about "), dollars(projected), F.lit(" a year, between "), dollars(low),
        F.lit(" and "), dollars(high), F.lit("; relative lift "), relative,
    )
    stop = F.concat(
        F.lit("DO NOT SHIP: costs about "), dollars(F.abs(projected)), F.lit(" a year")
    )
    unclear = F.concat(
        F.lit("INCONCLUSIVE: about "), dollars(projected), F.lit(" a year, p = "),
        F.coalesce(F.format_number("p_value", 3), F.lit("not defined")),
    )
    lift = F.col("absolute_lift")
    return tested.select(
        "experiment",
        rounded(projected, 0).alias("projected_annual_lift"),
        rounded(low, 0).alias("lift_lower_bound"),
        rounded(high, 0).alias("lift_upper_bound"),
        F.when(F.col("significant") & (lift > 0), ship)
        .when(F.col("significant") & (lift < 0), stop)
        .otherwise(unclear)
        .alias("recommendation"),
        F.lit(annual_users).alias("annual_users_assumed"),
    )


def arm_guard(m: DataFrame, minimum: int = 30) -> DataFrame:
    """Whether both arms have more values than the minimum."""
    return m.select(
        "experiment",
        "control_n",
        "treatment_n",
        ((F.col("control_n") > minimum) & (F.col("treatment_n") > minimum)).alias("valid"),
    )


def variant_statistics(df: DataFrame, variant: str, metric: str) -> DataFrame:
    """Count, mean, deviation, extremes and standard error per arm."""
    value = F.col(metric).cast("double")
    return df.groupBy(variant).agg(
        F.count(value).alias("n"),
        rounded(F.avg(value), 4).alias("mean"),
        rounded(F.stddev_samp(value), 4).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        rounded(F.stddev_samp(value) / F.sqrt(F.count(value)), 6).alias("standard_error"),
    )


def full_report(
    df: DataFrame,
    experiment: str,
    variant: str,
    metric: str,
    binary: str | None = None,
    alpha: float = 0.05,
    annual_users: int = 10_000,
) -> DataFrame:
    """One row per experiment with every test as a struct.

    The baseline of the sample size is the control's share of the two means.
    The observations are read once: all parts share the materialised moments.
    """
    m = materialise(moments(df, experiment, variant, metric, binary))
    share = ratio("control_mean", F.col("control_mean") + F.col("treatment_mean"))
    baseline = F.greatest(F.coalesce(share, F.lit(0.01)), F.lit(0.01))
    tested = welch_test(m, alpha)
    parts = {
        "srm_check": split_check(m),
        "ttest": tested,
        "effect_size": effect_size(m),
        "sample_size_required": sample_requirement(m, baseline, 0.10, alpha),
        "revenue_impact": revenue_impact(tested, annual_users),
    }
    if binary is not None:
        parts["chi_square"] = chi_square_test(m, alpha)
    report = None
    for name, part in parts.items():
        cells = [c for c in part.columns if c != "experiment"]
        nested = part.select("experiment", F.struct(*cells).alias(name))
        report = nested if report is None else report.join(nested, "experiment")
    return report


def flat_result(report: DataFrame) -> DataFrame:
    """The headline columns of a report, one flat row per experiment."""
    t, i = "ttest", "revenue_impact"
    return report.select(
        "experiment",
        F.lit("Welch's t-test").alias("test"),
        *[
            F.col(f"{t}.{c}")
            for c in (
                "control_n treatment_n control_mean treatment_mean absolute_lift "
                "relative_lift_pct ci_lower ci_upper t_statistic p_value significant"
            ).split()
        ],
        F.col("effect_size.cohens_d"),
        F.col("effect_size.magnitude").alias("effect_magnitude"),
        *[
            F.col(f"{i}.{c}")
            for c in (
                "projected_annual_lift lift_lower_bound lift_upper_bound recommendation"
            ).split()
        ],
    )
