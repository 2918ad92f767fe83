"""A/B queries: every campaign is an experiment, and all of them pooled one more."""

from __future__ import annotations

from pyspark.sql import functions as F

from clientele.operators import descriptive, experiment
from clientele.plans.reference_sql import d, define, r, with_tables
from clientele.plans.registry import query
from clientele.sources.adapter import Tables
from clientele.sources.scratch import materialise

# Fixed values of the normal distribution: quantiles at 0.975 and 0.8, and the
# squared quantiles at 0.995 and 0.975.
_Z_ALPHA, _Z_BETA = "1.959963984540054::DOUBLE", "0.8416212335729143::DOUBLE"
_CHI2_01, _CHI2_05 = "6.634896601021213::DOUBLE", "3.841458820694124::DOUBLE"


def _arm(arm: str, v: int) -> str:
    x = d("additional_revenue")
    return f"""count(*) FILTER (variant = {v}) AS {arm}_rows,
        count(additional_revenue) FILTER (variant = {v}) AS {arm}_n,
        {d(f'sum(additional_revenue) FILTER (variant = {v})')}
            / count(additional_revenue) FILTER (variant = {v}) AS {arm}_mean,
        var_samp({x}) FILTER (variant = {v}) AS {arm}_var,
        count(responded) FILTER (variant = {v}) AS {arm}_trials,
        CAST(coalesce(sum(responded) FILTER (variant = {v}), 0) AS BIGINT) AS {arm}_hits"""


define(
    "arms",
    "promotions",
    f"""
    SELECT CASE WHEN grouping(campaign_name) = 1 THEN 'all' ELSE campaign_name END AS experiment,
        {_arm('control', 0)}, {_arm('treatment', 1)}
    FROM promotions GROUP BY ROLLUP (campaign_name)""",
)


def moments(t: Tables):
    return experiment.moments(
        t.promotions, "campaign_name", "variant", "additional_revenue", "responded"
    )


@query(
    "X1_split_check",
    with_tables(
        "arms",
        f"""SELECT experiment, control_rows AS n_control, treatment_rows AS n_treatment,
            {r('chi2', 4)} AS chi2,
            {r(d('control_rows') + ' / (control_rows + treatment_rows)', 4)} AS actual_split,
            chi2 > {_CHI2_01} AS srm_detected
            FROM (SELECT *, pow(control_rows - treatment_rows, 2)
                  / {d('control_rows + treatment_rows')} AS chi2 FROM arms)""",
    ),
)
def _(t):
    return experiment.split_check(moments(t)).drop("p_value", "expected_split")


define(
    "welch",
    "arms",
    """
    SELECT *, treatment_mean - control_mean AS lift,
           control_var / control_n AS ec, treatment_var / treatment_n AS et FROM arms""",
)


@query(
    "X2_welch_test",
    with_tables(
        "welch",
        f"""SELECT experiment, {r('-lift / sqrt(ec + et)', 4)} AS t_statistic,
            {r('control_mean', 4)} AS control_mean, {r('treatment_mean', 4)} AS treatment_mean,
            {r('lift', 4)} AS absolute_lift,
            {r('lift / nullif(control_mean, 0) * 100', 2)} AS relative_lift_pct,
            control_n, treatment_n FROM welch""",
    ),
)
def _(t):
    return experiment.welch_test(moments(t)).select(
        "experiment",
        "t_statistic",
        "control_mean",
        "treatment_mean",
        "absolute_lift",
        "relative_lift_pct",
        "control_n",
        "treatment_n",
    )


@query("X2_welch_test_with_p")
def _(t):
    return experiment.welch_test(moments(t))


@query(
    "X3_welch_degrees_of_freedom",
    with_tables(
        "welch",
        f"""SELECT experiment, {r('''pow(ec + et, 2)
            / (pow(ec, 2) / (control_n - 1) + pow(et, 2) / (treatment_n - 1))''', 4)}
            AS degrees_of_freedom FROM welch""",
    ),
)
def _(t):
    return moments(t).select(
        "experiment",
        F.round(experiment.welch_dof().try_cast("decimal(38,6)"), 4)
        .cast("double")
        .alias("degrees_of_freedom"),
    )


define(
    "rates",
    "arms",
    """
    SELECT *, control_hits / CAST(control_trials AS DOUBLE) AS pc,
        treatment_hits / CAST(treatment_trials AS DOUBLE) AS pt,
        CAST(control_hits AS DOUBLE) AS a, CAST(control_trials - control_hits AS DOUBLE) AS b,
        CAST(treatment_hits AS DOUBLE) AS c,
        CAST(treatment_trials - treatment_hits AS DOUBLE) AS e FROM arms""",
)


@query(
    "X4_chi_square_test",
    with_tables(
        "rates",
        f"""SELECT experiment, {r('chi2', 4)} AS chi2_statistic, 1 AS degrees_of_freedom,
            coalesce(chi2 > {_CHI2_05}, false) AS significant,
            {r('pc', 4)} AS control_conversion_rate, {r('pt', 4)} AS treatment_conversion_rate,
            {r('(pt - pc) * 100', 2)} AS absolute_lift_pct,
            {r('(pt - pc) / nullif(pc, 0) * 100', 2)} AS relative_lift_pct,
            control_trials AS control_n, treatment_trials AS treatment_n
            FROM (SELECT *, (a + b + c + e) * pow(a * e - b * c, 2)
                  / nullif((a + b) * (c + e) * (a + c) * (b + e), 0) AS chi2 FROM rates)""",
    ),
)
def _(t):
    return experiment.chi_square_test(moments(t)).drop("p_value", "contingency_table")


@query(
    "X5_effect_size",
    with_tables(
        "arms",
        f"""SELECT experiment, {r('x', 4)} AS cohens_d, CASE WHEN abs(x) < 0.2 THEN 'negligible'
            WHEN abs(x) < 0.5 THEN 'small' WHEN abs(x) < 0.8 THEN 'medium' ELSE 'large' END
            AS magnitude, {r('pooled', 4)} AS pooled_std
            FROM (SELECT *, CASE WHEN pooled > 0 THEN (treatment_mean - control_mean) / pooled
                            ELSE 0 END AS x
              FROM (SELECT *, sqrt(((control_n - 1) * control_var
                    + (treatment_n - 1) * treatment_var) / (control_n + treatment_n - 2))
                    AS pooled FROM arms))""",
    ),
)
def _(t):
    return experiment.effect_size(moments(t))


define(
    "sized",
    "arms",
    f"""
    SELECT *, CAST(ceil(pow({_Z_ALPHA} * sqrt((p + q) / 2 * 2 * (1 - (p + q) / 2))
            + {_Z_BETA} * sqrt(p * (1 - p) + q * (1 - q)), 2) / pow(q - p, 2)) AS BIGINT)
            AS n_per_group
    FROM (SELECT *, p * (1 + 0.1::DOUBLE) AS q FROM (
      SELECT *, greatest(least((control_hits + treatment_hits)
             / CAST(control_trials + treatment_trials AS DOUBLE), 0.99::DOUBLE), 0.01::DOUBLE)
             AS p FROM arms))""",
)


@query(
    "X6_minimum_sample",
    with_tables(
        "sized",
        f"""SELECT experiment, n_per_group, n_per_group * 2 AS total_n,
            {r('p', 4)} AS baseline_rate, {r('q', 4)} AS target_rate,
            {r('p * 0.1::DOUBLE', 4)} AS mde_absolute FROM sized""",
    ),
)
def _(t):
    return experiment.sample_requirement(moments(t)).select(
        "experiment", "n_per_group", "total_n", "baseline_rate", "target_rate", "mde_absolute"
    )


@query(
    "X7_adequately_powered",
    with_tables(
        "sized",
        """SELECT experiment, n_per_group, control_n >= n_per_group AND treatment_n >= n_per_group
           AS adequately_powered FROM sized""",
    ),
)
def _(t):
    return experiment.sample_requirement(moments(t)).select(
        "experiment", "n_per_group", "adequately_powered"
    )


@query(
    "X8_annual_impact",
    with_tables(
        "welch",
        f"""SELECT experiment, {r(f"{r('lift', 4)} * 10000", 0)} AS projected_annual_lift,
            10000 AS annual_users_assumed FROM welch""",
    ),
)
def _(t):
    return experiment.revenue_impact(experiment.welch_test(moments(t))).select(
        "experiment", "projected_annual_lift", "annual_users_assumed"
    )


@query("X8_recommendation")
def _(t):
    return experiment.revenue_impact(experiment.welch_test(moments(t)))


@query("X9_full_report")
def _(t):
    return experiment.full_report(
        t.promotions, "campaign_name", "variant", "additional_revenue", "responded"
    )


@query(
    "X10_arm_guard",
    with_tables(
        "arms",
        """SELECT experiment, control_n, treatment_n, control_n > 30 AND treatment_n > 30 AS valid
           FROM arms""",
    ),
)
def _(t):
    return experiment.arm_guard(moments(t))


@query("X11_flat_result")
def _(t):
    return experiment.flat_result(
        experiment.full_report(
            t.promotions, "campaign_name", "variant", "additional_revenue", "responded"
        )
    )


_X = d("additional_revenue")


@query(
    "A29_variant_statistics",
    with_tables(
        "promotions",
        f"""SELECT variant, count(additional_revenue) AS n, {r(f'avg({_X})', 4)} AS mean,
            {r(f'stddev_samp({_X})', 4)} AS std, min({_X}) AS min, max({_X}) AS max,
            {r(f'stddev_samp({_X}) / sqrt(count(additional_revenue))', 6)} AS standard_error
            FROM promotions GROUP BY 1""",
    ),
)
def _(t):
    return experiment.variant_statistics(t.promotions, "variant", "additional_revenue")


@query(
    "W15_revenue_clipped_at_p98",
    with_tables(
        "promotions",
        f"""SELECT customer_id, variant, {r(f'''least({_X}, (SELECT quantile_cont({_X}, 0.98)
            FROM promotions))''', 4)} AS clipped FROM promotions""",
    ),
)
def _(t):
    base = materialise(t.promotions.select("customer_id", "variant", "additional_revenue"))
    out = descriptive.clip_at_quantile(base, "additional_revenue", 0.98, "clipped")
    return out.select(
        "customer_id",
        "variant",
        F.round(F.col("clipped").try_cast("decimal(38,6)"), 4).cast("double").alias("clipped"),
    )
