from __future__ import annotations

import hashlib
import math
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from liftline.functions.numeric import with_erfc
from liftline.functions.resampling import poisson_cut_points
from liftline.operators import ab_tests, cuped, moments, multiple_testing, power
from liftline.operators.bootstrap import bootstrap_difference
from liftline.params import Bootstrap, Experiment, Power


def outcomes(spark, control, treatment, extra=()):
    data = [(i, "control", float(y)) for i, y in enumerate(control)]
    data += [(len(control) + i, "treatment", float(y)) for i, y in enumerate(treatment)]
    return spark.createDataFrame([*data, *extra], "user_id long, assigned_variant string, y double")


def test_erfc_matches_the_standard_library(spark):
    xs = [0.0, 1e-9, 0.1, 0.46875, 0.4687500001, 0.5, 1.0, 1.96, 3.999, 4.0, 4.001, 8.0, 20.0, 26.0]
    df = with_erfc(spark.createDataFrame([(x,) for x in xs], "x double"), F.col("x"), "e")
    for r in df.collect():
        assert r["e"] == pytest.approx(math.erfc(r["x"]), rel=1e-12)


def test_moments_of_small_arms(spark, rows):
    df = outcomes(spark, [1, 2, 3, 4], [7], [(90, "control", None)])
    got = rows(moments.arm_moments(df, ["y"]), "assigned_variant")
    assert (got["control"]["n"], got["control"]["mean"]) == (4, 2.5)
    assert got["control"]["variance"] == pytest.approx(5 / 3)
    assert (got["treatment"]["n"], got["treatment"]["variance"]) == (1, 0.0)


def test_bucket_moments_equal_direct_moments(spark, rows):
    rng = np.random.default_rng(1)
    df = outcomes(spark, 1e6 + rng.normal(size=3000), 1e6 + 2 * rng.normal(size=3500))
    boot = Bootstrap(buckets=50)
    direct = rows(moments.arm_moments(df, ["y"]), "assigned_variant")
    parts = moments.arm_parts(df, moments.bucket_cells(df, ["y"], boot), ["y"], boot)
    merged = rows(moments.moments_from_parts(parts), "assigned_variant")
    for arm, r in direct.items():
        assert merged[arm]["n"] == r["n"]
        assert merged[arm]["mean"] == pytest.approx(r["mean"], rel=1e-13)
        assert merged[arm]["variance"] == pytest.approx(r["variance"], rel=1e-9)


def test_difference_test(spark):
    r = ab_tests.difference_tests(moments.arm_moments(outcomes(spark, [1, 2, 3, 4], [2, 3, 4, 5]), ["y"])).collect()[0]
    assert (r["effect_abs"], r["n_control"], r["n_treatment"]) == (1.0, 4, 4)
    assert r["effect_rel"] == pytest.approx(0.4)
    assert r["p_value"] == pytest.approx(math.erfc(1 / math.sqrt(2 * 5 / 3 / 4) / math.sqrt(2)), rel=1e-12)


def test_no_variation_gives_p_one_and_zero_base_gives_no_relative_effect(spark):
    r = ab_tests.difference_tests(moments.arm_moments(outcomes(spark, [0, 0], [1, 1]), ["y"])).collect()[0]
    assert r["p_value"] == 1.0 and r["effect_abs"] == 1.0 and r["effect_rel"] is None


def test_interval_brackets_the_observed_difference(spark):
    df = outcomes(spark, [0, 0, 1, 1, 0, 1, 0, 1], [1, 1, 1, 1, 0, 1, 1, 1])
    for buckets in (None, 1000):
        r = bootstrap_difference(df, ["y"], Bootstrap(buckets=buckets)).collect()[0]
        assert r["ci_low"] <= 0.375 <= r["ci_high"]


def _weight(seed, arm, unit, replicate):
    digest = hashlib.md5(f"{seed}:{arm}:{unit}:{replicate // 4}".encode()).hexdigest()
    draw = int(digest[8 * (replicate % 4) : 8 * (replicate % 4) + 8], 16)
    return sum(draw >= int(c, 16) for c in poisson_cut_points())


def test_replicates_match_brute_force(spark):
    rng = np.random.default_rng(3)
    arms = {"control": rng.normal(size=40), "treatment": rng.normal(1, 2, size=50)}
    df = outcomes(spark, arms["control"], arms["treatment"])
    first = {"control": 0, "treatment": 40}
    for buckets in (None, 16):
        boot = Bootstrap(replicates=203, seed=7, buckets=buckets)
        differences = []
        for b in range(203):
            means = {}
            for arm, ys in arms.items():
                users = range(first[arm], first[arm] + len(ys))
                units = users if buckets is None else [
                    int(hashlib.md5(f"7:{u}".encode()).hexdigest()[:8], 16) % buckets for u in users
                ]
                w = np.array([_weight(7, arm, u, b) for u in units])
                means[arm] = (w * ys).sum() / w.sum()
            differences.append(means["treatment"] - means["control"])
        r = bootstrap_difference(df, ["y"], boot).collect()[0]
        assert r["ci_low"] == pytest.approx(np.percentile(differences, 2.5), rel=1e-9)
        assert r["ci_high"] == pytest.approx(np.percentile(differences, 97.5), rel=1e-9)


def test_replicates_do_not_depend_on_partitioning(spark):
    rng = np.random.default_rng(5)
    df = outcomes(spark, rng.integers(0, 2, 500), rng.integers(0, 2, 500))
    one = bootstrap_difference(df.coalesce(1), ["y"]).collect()
    many = bootstrap_difference(df.repartition(13), ["y"]).collect()
    assert one == many


def test_interval_width_agrees_with_the_standard_error(spark):
    rng = np.random.default_rng(9)
    c, t = rng.exponential(10, 6000), rng.exponential(12, 6000)
    df = outcomes(spark, c, t)
    expected = 2 * 1.959964 * math.sqrt(c.var(ddof=1) / len(c) + t.var(ddof=1) / len(t))
    r = bootstrap_difference(df, ["y"], Bootstrap()).collect()[0]
    assert r["ci_high"] - r["ci_low"] == pytest.approx(expected, rel=0.12)


def test_poisson_weights_have_mean_and_variance_one():
    p = np.diff([0.0, *[int(c, 16) / 2**32 for c in poisson_cut_points()], 1.0])
    k = np.arange(len(p))
    assert (p * k).sum() == pytest.approx(1, abs=1e-7)
    assert (p * k * k).sum() - 1 == pytest.approx(1, abs=1e-6)


# The small vectors below are those of known worked examples.
def test_benjamini_hochberg(spark, rows):
    p = [0.04, 0.002, 0.3, 0.01, 0.2]
    df = spark.createDataFrame([("f", f"m{i}", x) for i, x in enumerate(p)], "family string, metric string, p_value double")
    got = rows(multiple_testing.benjamini_hochberg(df, ["metric"], ["family"]), "metric")
    expected = [0.0666666667, 0.01, 0.3, 0.025, 0.25]
    assert [got[f"m{i}"]["p_value_fdr"] for i in range(5)] == pytest.approx(expected)


def test_equal_p_values_get_equal_q_values(spark):
    df = spark.createDataFrame(
        [("f", "a", 0.5), ("f", "b", 0.5), ("f", "c", 0.9), ("g", "a", 1.0)], "family string, metric string, p_value double"
    )
    got = multiple_testing.benjamini_hochberg(df, ["metric"], ["family"]).orderBy("family", "metric").collect()
    assert [r["p_value_fdr"] for r in got] == [0.75, 0.75, 0.9, 1.0]


def test_primary_metric_is_not_adjusted(spark, rows):
    df = spark.createDataFrame(
        [("activated_within_7d", 0.04), ("retained_d7", 0.04), ("retained_d30", 0.9)], "metric string, p_value double"
    )
    got = rows(multiple_testing.with_metric_fdr(df), "metric")
    assert got["activated_within_7d"]["p_value_fdr"] == 0.04 and got["activated_within_7d"]["significant_fdr_05"]
    assert got["retained_d7"]["p_value_fdr"] == 0.08 and not got["retained_d7"]["significant_fdr_05"]


def test_power_numbers(spark):
    df = spark.createDataFrame([(0.30, 0.01), (0.30, 0.03), (0.0, 0.01)], "p double, lift double")
    n = [r[0] for r in df.select(power.required_n(F.col("p"), F.col("lift"))).collect()]
    assert n[0] == 33275 and n[1] < n[0] and n[2] > 0
    arms = spark.createDataFrame([(0.30, 1000, 1000), (0.30, 20000, 10000), (0.3, 0, 9)], "p double, c long, t long")
    mde = [r[0] for r in arms.select(power.detectable_lift(F.col("p"), F.col("c"), F.col("t"))).collect()]
    assert mde[:2] == pytest.approx([0.058852537, 0.018309292], abs=1e-9)
    assert mde[2] == pytest.approx(0.5)
    strict = [r[0] for r in arms.select(power.detectable_lift(F.col("p"), F.col("c"), F.col("t"), Power(0.01, 0.9))).collect()]
    assert strict[0] > mde[0]


@pytest.fixture(scope="module")
def covariate_data(spark):
    rng = np.random.default_rng(123)
    x = rng.normal(50, 10, 4000)
    y = 0.6 * x + rng.normal(0, 5, 4000)
    arm = np.where(rng.random(4000) < 0.5, "control", "treatment")
    data = [(i, str(a), float(b), float(c)) for i, (a, b, c) in enumerate(zip(arm, x, y))]
    data += [(4000, "control", None, 1.0), (4001, "treatment", 1.0, None)]
    df = spark.createDataFrame(data, "user_id long, assigned_variant string, x double, y double")
    return df, x, y, arm


def test_cuped_table_matches_numpy(covariate_data):
    df, x, y, arm = covariate_data
    for buckets in (1000, None):
        r = cuped.cuped_table(df, "x", ["y"], Bootstrap(replicates=200, buckets=buckets)).collect()[0]
        theta = np.cov(y, x, ddof=1)[0, 1] / x.var(ddof=1)
        adjusted = y - theta * (x - x.mean())
        t, c = adjusted[arm == "treatment"], adjusted[arm == "control"]
        se = math.sqrt(t.var(ddof=1) / len(t) + c.var(ddof=1) / len(c))
        assert r["theta"] == pytest.approx(theta, rel=1e-10)
        assert r["raw_variance"] == pytest.approx(y.var(ddof=1), rel=1e-10)
        assert r["cuped_variance"] == pytest.approx(adjusted.var(ddof=1), rel=1e-9)
        assert r["cuped_variance"] < r["raw_variance"]
        assert r["variance_reduction_pct"] == pytest.approx(100 * (1 - adjusted.var(ddof=1) / y.var(ddof=1)), rel=1e-9)
        assert r["cuped_effect_abs"] == pytest.approx(t.mean() - c.mean(), rel=1e-8)
        assert r["cuped_p_value"] == pytest.approx(math.erfc(abs(t.mean() - c.mean()) / se / math.sqrt(2)), rel=1e-8)
        assert r["cuped_ci_low"] < r["cuped_effect_abs"] < r["cuped_ci_high"]


def test_cuped_rows_match_the_table(covariate_data):
    df, x, y, arm = covariate_data
    rows = cuped.cuped_adjusted(df, "y", "x")
    assert rows.count() == 4000
    variance = rows.agg(F.var_samp("cuped_outcome")).collect()[0][0]
    table = cuped.cuped_table(df, "x", ["y"], Bootstrap(replicates=8)).collect()[0]
    assert variance == pytest.approx(table["cuped_variance"], rel=1e-9)


def test_constant_covariate_leaves_the_outcome_alone(spark):
    df = outcomes(spark, [1, 2, 3], [2, 3, 7]).withColumn("x", F.lit(0.1))
    r = cuped.cuped_table(df, "x", ["y"], Bootstrap(replicates=8)).collect()[0]
    y = np.array([1, 2, 3, 2, 3, 7.0])
    assert r["theta"] == 0.0 and r["variance_reduction_pct"] == 0.0
    assert r["raw_variance"] == pytest.approx(y.var()) and r["cuped_variance"] == pytest.approx(y.var())
    adjusted = cuped.cuped_adjusted(df, "y", "x").select("y", "cuped_outcome").collect()
    assert all(a == b for a, b in adjusted)


def test_segment_gate_counts_200_in_199_out(spark, rows):
    df = spark.range(799).select(
        F.col("id").alias("user_id"),
        F.when(F.col("id") % 2 == 0, "control").otherwise("treatment").alias("assigned_variant"),
        (F.col("id") % 3 == 0).cast("int").alias("activated_within_7d"),
        F.when(F.col("id") < 400, "full").otherwise("short").alias("device"),
    )
    exp = Experiment(segment_bootstrap=Bootstrap(replicates=40))
    got = rows(ab_tests.segment_tests(df, ["device"], exp=exp), "segment_value")
    assert set(got) == {"full"} and got["full"]["n_control"] == got["full"]["n_treatment"] == 200
    assert len(ab_tests.segment_tests(df, ["device"], exp=exp).columns) == 13
    none = ab_tests.segment_tests(df, ["device"], exp=replace(exp, min_segment_arm=300))
    assert none.count() == 0 and len(none.columns) == 13
