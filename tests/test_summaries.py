from __future__ import annotations

import pytest

from liftline.operators import summaries as sm

SCHEMA = """user_id long, assigned_variant string, activated_within_7d int, retained_d7 int, retained_d30 int,
cancelled_30d int, time_to_first_match_hours double, support_tickets_30d int, noncompliance_flag int,
onboarding_started int, onboarding_completed int, session_booked int"""


@pytest.fixture(scope="module")
def dashboard(spark):
    return spark.createDataFrame(
        [
            (1, "control", 0, 0, 0, 0, 5.0, 0, 0, 1, 0, 0),
            (2, "control", 1, 1, 0, 0, 8.0, 1, 0, 1, 1, 1),
            (3, "treatment", 1, 1, 1, 1, 4.0, 0, 1, 1, 1, 1),
            (4, "treatment", 1, 1, 1, 0, 6.0, 0, 0, 1, 1, 1),
        ],
        SCHEMA,
    )


@pytest.fixture(scope="module")
def export(spark):
    return spark.createDataFrame(
        [
            (1, "control", 1, 1, 0, 0, 10.0, 0, 0, 1, 1, 1),
            (2, "control", 0, 0, 0, 0, 20.0, 1, 0, 1, 0, 0),
            (3, "treatment", 1, 1, 1, 0, 9.0, 0, 0, 1, 1, 1),
            (4, "treatment", 0, 1, 0, 1, 8.0, 0, 0, 1, 1, 0),
        ],
        SCHEMA,
    )


def test_dashboard_summary(dashboard, rows):
    got = rows(sm.dashboard_variant_summary(dashboard), "assigned_variant")
    assert list(got) == ["control", "treatment"]
    assert (got["control"]["activation_rate_7d"], got["treatment"]["activation_rate_7d"]) == (0.5, 1.0)
    assert (got["control"]["avg_match_latency_hours"], got["treatment"]["avg_match_latency_hours"]) == (6.5, 5.0)
    assert (got["control"]["noncompliance_rate"], got["treatment"]["noncompliance_rate"]) == (0.0, 0.5)


def test_funnel_has_five_ordered_steps_per_arm(dashboard):
    got = sm.ordered_funnel(dashboard).collect()
    steps = ["signup", "onboarding_started", "onboarding_completed", "session_booked", "activated_within_7d"]
    assert [(r["assigned_variant"], r["step"]) for r in got] == [(a, s) for a in ("control", "treatment") for s in steps]
    assert [r["rate_from_signup"] for r in got[:5]] == [1.0, 1.0, 0.5, 0.5, 0.5]


def test_lift_table(export, rows):
    got = rows(sm.lift_table(sm.variant_summary(export)), "metric")
    assert len(got) == 6
    assert got["avg_time_to_first_match_hours"]["absolute_lift"] == 8.5 - 15.0
    assert got["cancellation_rate_30d"]["absolute_lift"] == 0.5
    assert got["cancellation_rate_30d"]["relative_lift"] is None


def test_segments_count_every_user_once_per_dimension(spark, rows):
    df = spark.createDataFrame(
        [(1, "control", "a", "x", 1), (2, "control", "b", "x", 0), (3, "treatment", "a", None, 1)],
        "user_id long, assigned_variant string, d1 string, d2 string, activated_within_7d int",
    )
    got = rows(sm.segment_activation(df, ["d1", "d2"]), "segment_dimension", "segment_value", "assigned_variant")
    assert got["d1", "a", "control"]["users"] == 1 and got["d2", "x", "control"]["users"] == 2
    assert got["d2", "x", "control"]["activation_rate_7d"] == 0.5
    assert len(got) == 4  # a missing value is no segment


def test_filters_are_inclusive(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (DATE'2024-01-01', 'ios'), (DATE'2024-01-02', 'web'), (DATE'2024-01-03', 'ios') "
        "AS t(signup_date, device)"
    )
    assert sm.filtered(df, "2024-01-01", "2024-01-02").count() == 2
    assert sm.filtered(df, device=["ios"]).count() == 2
    assert sm.filtered(df, signup_from="2024-01-02", device=["ios"]).count() == 1


def test_relabelled_keeps_unknown_values(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("users",), ("other",)], "c string")
    assert [r[0] for r in df.select(sm.relabelled(F.col("c"), {"users": "Users"})).collect()] == ["Users", "other"]
