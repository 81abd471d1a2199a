from __future__ import annotations

import pytest

from liftline.operators import decisions as de


def results(spark, primary=(0.02, 0.01), cancelled=(0.0001, 0.6), hours=(-0.1, 0.3), tickets=(-0.01, 0.2)):
    values = [
        ("activated_within_7d", *primary),
        ("cancelled_30d", *cancelled),
        ("time_to_first_match_hours", *hours),
        ("support_tickets_30d", *tickets),
    ]
    return spark.createDataFrame(values, "metric string, effect_abs double, p_value double")


@pytest.mark.parametrize(
    "changes, decision, issues",
    [
        ({}, de.PVALUE_ROLLOUT, 0),
        ({"cancelled": (0.01, 0.049)}, de.PVALUE_MITIGATE, 1),
        ({"cancelled": (0.01, 0.05)}, de.PVALUE_ROLLOUT, 0),
        ({"primary": (0.02, 0.05)}, de.PVALUE_STOP, 0),
        ({"primary": (-0.02, 0.001)}, de.PVALUE_STOP, 0),
    ],
)
def test_decision_by_pvalue(spark, changes, decision, issues):
    df = results(spark, **changes)
    r = de.decision_by_pvalue(df).collect()[0]
    assert (r["decision"], r["guardrail_issues"]) == (decision, issues)
    assert de.guardrail_regressions(df).count() == issues


def test_regression_text(spark):
    r = de.guardrail_regressions(results(spark, tickets=(0.01234, 0.0012))).collect()[0]
    assert r["issue"] == "support_tickets_30d worsened (effect=0.0123, p=0.0012)"


def summary(spark, **treatment):
    base = {"activation_rate_7d": 0.5, "cancellation_rate_30d": 0.25, "avg_match_latency_hours": 5.0,
            "support_tickets_per_user": 0.5}
    rows = [("control", *base.values()), ("treatment", *{**base, **treatment}.values())]
    return spark.createDataFrame(rows, "assigned_variant string, " + ", ".join(f"{c} double" for c in base))


@pytest.mark.parametrize(
    "treatment, outcome",
    [
        ({"activation_rate_7d": 0.6}, de.TOLERANCE_ROLLOUT),
        ({"activation_rate_7d": 0.6, "avg_match_latency_hours": 6.0}, de.TOLERANCE_ROLLOUT),
        ({"activation_rate_7d": 0.6, "avg_match_latency_hours": 6.01}, de.TOLERANCE_HOLD),
        ({"activation_rate_7d": 0.6, "cancellation_rate_30d": 0.2531}, de.TOLERANCE_HOLD),
        ({"activation_rate_7d": 0.6, "support_tickets_per_user": 0.52}, de.TOLERANCE_HOLD),
        ({}, de.TOLERANCE_STOP),
    ],
)
def test_decision_by_tolerance(spark, treatment, outcome):
    r = de.decision_by_tolerance(summary(spark, **treatment)).collect()[0]
    assert (r["decision"], r["rationale"], r["action_plan"]) == outcome


def test_strongest_segment(spark):
    df = spark.createDataFrame(
        [("device", "a", 0.3, False), ("device", "b", 0.1, True), ("age", "c", 0.2, True)],
        "segment_dimension string, segment_value string, effect_abs double, significant_fdr_05 boolean",
    )
    assert de.strongest_segment(df).collect()[0]["segment_value"] == "c"
    assert de.strongest_segment(df.where("effect_abs > 0.25")).count() == 0


def test_dictionary_labels_every_metric(spark):
    dictionary = de.metric_dictionary(spark)
    assert dictionary.count() == 7 and len(dictionary.columns) == 6
    assert de.labelled(results(spark), dictionary).where("business_metric IS NULL").count() == 0
