from __future__ import annotations

from decimal import Decimal

import pytest
from conftest import DAY, SIGNUP

from liftline.operators import quality as q


@pytest.fixture(scope="module")
def tables(table):
    return {
        "dim_users": table(
            "dim_users",
            {"user_id": 1},
            {"user_id": 1, "device": None},
            {"user_id": 2, "acquisition_channel": "tv", "assigned_variant": None},
            {"user_id": 3, "assigned_variant": "treatment"},
        ),
        "fact_events": table(
            "fact_events",
            *[
                {"event_id": f"e{i}", "user_id": u, "event_ts": SIGNUP, "event_name": "app_open"}
                for i, u in enumerate([1, 1, 2, 9, 9])
            ],
        ),
        "fact_subscriptions": table(
            "fact_subscriptions", {"user_id": 1, "subscribed_ts": SIGNUP, "price_monthly": None},
            {"user_id": 2, "subscribed_ts": SIGNUP, "price_monthly": Decimal(0)},
        ),
        "fact_cancellations": table("fact_cancellations", {"user_id": 3, "cancelled_ts": SIGNUP + DAY}),
    }


def test_violations(tables, rows):
    nulls = rows(q.null_violations(tables).where("violations > 0"), "table_name", "column_name")
    assert set(nulls) == {("dim_users", "device"), ("dim_users", "assigned_variant"), ("fact_subscriptions", "price_monthly")}
    keys = rows(q.primary_key_violations(tables), "table_name")
    assert (keys["dim_users"]["repeated_keys"], keys["dim_users"]["surplus_rows"]) == (1, 1)
    assert keys["fact_events"]["repeated_keys"] == 0
    refs = rows(q.foreign_key_violations(tables), "table_name")
    assert (refs["fact_events"]["unknown_keys"], refs["fact_events"]["orphan_rows"]) == (1, 2)
    assert refs["fact_cancellations"]["orphan_rows"] == 1 and refs["fact_subscriptions"]["orphan_rows"] == 0
    rules = rows(q.domain_violations(tables), "rule")
    assert rules["acquisition_channel_domain"]["violations"] == 1
    assert rules["assigned_variant_domain"]["violations"] == 0  # NULL passes a CHECK
    assert rules["price_monthly_positive"]["violations"] == 1


def test_gates(tables, rows):
    got = rows(q.quality_gates(tables["dim_users"], tables["fact_events"]), "check")
    assert {c: r["passed"] for c, r in got.items()} == {
        "min_users": False, "min_events": False, "null_assigned_variant": False,
        "treatment_share": False, "activation_rate": False,
    }
    with pytest.raises(q.QualityError, match="min_users=4.0"):
        q.require_quality(tables["dim_users"], tables["fact_events"])


def test_duplicates_count_every_copy(tables):
    r = q.duplicate_event_rate(tables["fact_events"]).collect()[0]
    assert (r["events_raw"], r["duplicate_event_rate"]) == (5, 0.8)
