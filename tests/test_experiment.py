import random

import pytest
from pyspark.sql import functions as F

from clientele.functions import stats
from clientele.operators import experiment


def frame(spark, rows):
    return spark.createDataFrame(rows, "exp string, arm int, x double, hit int")


@pytest.fixture(scope="module")
def trials(spark):
    rng = random.Random(1)
    rows = []
    for name, shift, rates in (("clear", 15, (0.2, 0.3)), ("none", 0, (0.25, 0.25))):
        for arm in (0, 1):
            for _ in range(1000):
                rows.append(
                    (name, arm, rng.gauss(50 + shift * arm, 10), int(rng.random() < rates[arm]))
                )
    return frame(spark, rows)


@pytest.fixture(scope="module")
def moments(trials):
    return experiment.moments(trials, "exp", "arm", "x", "hit")


def by_name(df):
    return {r.experiment: r for r in df.collect()}


def test_t_distribution_table_values():
    assert stats.t_two_sided(2.228, 10) == pytest.approx(0.05, abs=1e-4)
    assert stats.t_two_sided(12.706, 1) == pytest.approx(0.05, abs=1e-4)
    assert stats.t_quantile(0.975, 10) == pytest.approx(2.2281389, abs=1e-6)
    assert stats.t_quantile(0.975, 1e6) == pytest.approx(stats.normal_quantile(0.975), abs=1e-5)
    assert stats.t_quantile(0.025, 5) == pytest.approx(-2.5705818, abs=1e-6)
    assert stats.t_cdf(0.0, 7) == pytest.approx(0.5)
    assert stats.chi_square_tail(3.841458820694124) == pytest.approx(0.05)


def test_split_check_values(spark):
    counts = [("a", 5202, 4798), ("b", 9000, 1000), ("c", 5000, 5000), ("d", 3000, 7000)]
    m = spark.createDataFrame(counts, "experiment string, control_rows long, treatment_rows long")
    got = by_name(experiment.split_check(m))
    assert (got["a"].chi2, got["a"].p_value, got["a"].srm_detected) == (16.3216, 0.000053, True)
    assert got["b"].chi2 == 6400.0 and got["b"].actual_split == 0.9
    assert got["c"].p_value == 1.0 and not got["c"].srm_detected
    skewed = by_name(experiment.split_check(m.where("experiment = 'd'"), expected=0.3))
    assert not skewed["d"].srm_detected


def test_minimum_sample_values(spark):
    df = spark.createDataFrame([(0.25,), (0.05,)], "p double")
    got = [r[0] for r in df.select(experiment.minimum_sample(F.col("p"))).collect()]
    assert got == [4862, 31234]


def test_minimum_sample_is_monotone(spark):
    row = spark.range(1).select(
        experiment.minimum_sample(F.lit(0.25), power=0.8).alias("base"),
        experiment.minimum_sample(F.lit(0.25), power=0.9).alias("power"),
        experiment.minimum_sample(F.lit(0.25), effect=0.2).alias("effect"),
    ).first()
    assert row.power > row.base > row.effect


def test_clear_difference(moments):
    got = by_name(experiment.welch_test(moments))["clear"]
    assert got.significant and got.p_value < 0.001
    assert got.ci_lower < 15 < got.ci_upper
    assert got.t_statistic < 0 < got.absolute_lift
    assert got.degrees_of_freedom == pytest.approx(1998, abs=10)


def test_no_difference(moments):
    got = by_name(experiment.welch_test(moments))["none"]
    assert not got.significant and got.ci_lower < 0 < got.ci_upper


def test_one_sided_tails_add_up(moments):
    less = by_name(experiment.welch_test(moments, alternative="less"))
    greater = by_name(experiment.welch_test(moments, alternative="greater"))
    both = by_name(experiment.welch_test(moments))
    for name in ("clear", "none"):
        assert less[name].p_value + greater[name].p_value == pytest.approx(1, abs=1e-5)
        assert 2 * min(less[name].p_value, greater[name].p_value) == pytest.approx(
            both[name].p_value, abs=1e-5
        )
    with pytest.raises(ValueError):
        experiment.welch_test(moments, alternative="sideways")


def test_pooled_row(moments, trials):
    assert set(by_name(moments)) == {"clear", "none", "all"}
    assert by_name(moments)["all"].control_n == trials.where("arm = 0").count()


def test_chi_square(moments):
    got = by_name(experiment.chi_square_test(moments))
    assert got["clear"].significant and not got["none"].significant
    (a, b), (c, d) = got["clear"].contingency_table
    n = a + b + c + d
    expected = n * (a * d - b * c) ** 2 / ((a + b) * (c + d) * (a + c) * (b + d))
    assert got["clear"].chi2_statistic == pytest.approx(expected, abs=1e-4)


def test_effect_size(moments):
    got = by_name(experiment.effect_size(moments))
    assert got["clear"].magnitude == "large"
    assert got["clear"].cohens_d == pytest.approx(1.5, abs=0.15)
    assert got["none"].magnitude == "negligible"


def test_degenerate_experiments(spark):
    rows = [("flat", 0, 5.0, 0)] * 4 + [("flat", 1, 5.0, 0)] * 4
    rows += [("step", 0, 5.0, 0)] * 4 + [("step", 1, 6.0, 0)] * 4
    rows += [("empty arm", 0, 1.0, 1), ("empty arm", 0, 2.0, 0)]
    rows += [("half zero", 0, 0.0, 0)] * 3 + [("half zero", 1, float(i), 1) for i in range(3)]
    m = experiment.moments(frame(spark, rows), "exp", "arm", "x", "hit", with_total=False)
    tested = by_name(experiment.welch_test(m))
    assert tested["flat"].t_statistic is None and not tested["flat"].significant
    assert tested["flat"].degrees_of_freedom == 6.0
    assert tested["step"].significant and tested["step"].p_value == 0.0
    assert tested["empty arm"].p_value is None and not tested["empty arm"].significant
    assert tested["half zero"].relative_lift_pct is None
    assert by_name(experiment.effect_size(m))["flat"].cohens_d == 0.0
    assert by_name(experiment.chi_square_test(m))["flat"].chi2_statistic is None
    texts = by_name(experiment.revenue_impact(experiment.welch_test(m)))
    assert texts["flat"].recommendation.startswith("INCONCLUSIVE")


def test_report_is_one_row_per_experiment(trials):
    report = experiment.full_report(trials, "exp", "arm", "x", "hit", annual_users=1000)
    rows = by_name(report)
    assert set(rows) == {"clear", "none", "all"}
    clear = rows["clear"]
    assert clear.revenue_impact.recommendation.startswith("SHIP")
    assert clear.revenue_impact.projected_annual_lift == pytest.approx(
        clear.ttest.absolute_lift * 1000, abs=1
    )
    flat = by_name(experiment.flat_result(report))["clear"]
    assert flat.cohens_d == clear.effect_size.cohens_d
    assert len(flat.asDict()) == 19
    without = experiment.full_report(trials.drop("hit"), "exp", "arm", "x")
    assert "chi_square" not in without.columns


def test_losing_variant(spark):
    rng = random.Random(4)
    rows = [("e", arm, rng.gauss(50 - 9 * arm, 5), 0) for arm in (0, 1) for _ in range(200)]
    m = experiment.moments(frame(spark, rows), "exp", "arm", "x", with_total=False)
    (row,) = experiment.revenue_impact(experiment.welch_test(m)).collect()
    assert row.recommendation.startswith("DO NOT SHIP")


def test_guards(moments):
    assert all(r.valid for r in experiment.arm_guard(moments).collect())
    assert not any(r.valid for r in experiment.arm_guard(moments, 10_000).collect())
    sized = by_name(experiment.sample_requirement(moments))
    assert not sized["clear"].adequately_powered
