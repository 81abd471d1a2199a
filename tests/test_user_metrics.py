from __future__ import annotations

import pytest
from conftest import DAY, SIGNUP, TICK

from liftline.operators import events as ev, user_metrics as um
from liftline.params import EventNames, Experiment, Windows


def event(i, user, name, ts, session=None):
    return {"event_id": i, "user_id": user, "event_name": name, "event_ts": ts, "session_id": session}


@pytest.fixture(scope="module")
def facts(table):
    users = table("dim_users", *[{"user_id": u} for u in range(1, 8)])
    limit7, limit30 = SIGNUP + 7 * DAY, SIGNUP + 30 * DAY
    events = table(
        "fact_events",
        # 1: both steps exactly at the limit; app open exactly at +7 d
        event("a1", 1, "onboarding_completed", limit7),
        event("a2", 1, "session_booked", limit7),
        event("a3", 1, "app_open", limit7),
        # 2: booking one microsecond late; app open one microsecond early
        event("b1", 2, "onboarding_completed", SIGNUP),
        event("b2", 2, "session_booked", limit7 + TICK),
        event("b3", 2, "app_open", limit7 - TICK),
        # 3: completed only; app open exactly at +30 d, so both retention flags hold
        event("c1", 3, "onboarding_started", SIGNUP),
        event("c2", 3, "onboarding_completed", SIGNUP + DAY),
        event("c3", 3, "app_open", limit30),
        # 4: steps before signup count
        event("d1", 4, "onboarding_completed", SIGNUP - DAY),
        event("d2", 4, "session_booked", SIGNUP - DAY),
        # 5: copies of one logical event
        event("evt_9", 5, "app_open", SIGNUP + 8 * DAY, 50),
        event("dup_evt_1", 5, "app_open", SIGNUP + 8 * DAY, 51),
        # 7: unknown event name only
        event("g1", 7, "other", SIGNUP + DAY, 70),
        event("g2", 7, "other", SIGNUP + 2 * DAY, 70),
    )
    tickets = table(
        "fact_support_tickets",
        {"ticket_id": 1, "user_id": 1, "created_ts": SIGNUP},
        {"ticket_id": 2, "user_id": 1, "created_ts": limit30 - TICK},
        {"ticket_id": 3, "user_id": 1, "created_ts": limit30},
        {"ticket_id": 4, "user_id": 2, "created_ts": SIGNUP - TICK},
    )
    cancellations = table(
        "fact_cancellations",
        {"user_id": 1, "cancelled_ts": limit30},
        {"user_id": 2, "cancelled_ts": limit30 - TICK},
        {"user_id": 3, "cancelled_ts": SIGNUP - DAY},
    )
    matches = table(
        "fact_matches",
        {"user_id": 1, "matched_ts": SIGNUP + DAY / 48},
        {"user_id": 2, "matched_ts": SIGNUP - DAY / 24},
    )
    return users, events, tickets, cancellations, matches


def test_boundaries(facts, rows):
    got = rows(um.experiment_user_metrics(*facts), "user_id")
    column = lambda name: [got[u][name] for u in range(1, 8)]
    assert column("activated_within_7d") == [1, 0, 0, 1, 0, 0, 0]
    assert column("retained_d7") == [1, 0, 1, 0, 1, 0, 0]
    assert column("retained_d30") == [0, 0, 1, 0, 0, 0, 0]
    assert column("cancelled_30d") == [0, 1, 1, 0, 0, 0, 0]
    assert column("support_tickets_30d") == [2, 0, 0, 0, 0, 0, 0]
    assert column("time_to_first_match_hours") == [0.5, -1.0, None, None, None, None, None]


def test_each_metric_alone_agrees_with_the_combined_table(facts, rows):
    users, events, tickets, cancellations, matches = facts
    whole = rows(um.experiment_user_metrics(*facts), "user_id")
    parts = [
        um.activation_user_level(users, events),
        um.retention_user_level(users, events),
        um.support_user_level(users, tickets),
        um.cancellation_user_level(users, cancellations),
        um.match_latency_user_level(users, matches),
        um.guardrails_user_level(users, tickets, cancellations, matches),
    ]
    for part in parts:
        got = rows(part, "user_id")
        assert set(got) == set(whole)
        for name in set(part.columns) & set(um.OUTCOME_COLUMNS):
            assert {u: r[name] for u, r in got.items()} == {u: r[name] for u, r in whole.items()}


def test_raw_and_deduplicated_events_give_the_same_metrics(facts):
    users, events, *rest = facts
    raw = um.experiment_user_metrics(users, events, *rest)
    clean = um.experiment_user_metrics(users, ev.deduped_events(events), *rest)
    assert sorted(raw.collect()) == sorted(clean.collect())


def test_dedup_keeps_lowest_id_as_text(facts, rows):
    kept = rows(ev.deduped_events(facts[1]).where("user_id = 5"), "event_id")
    assert list(kept) == ["dup_evt_1"] and kept["dup_evt_1"]["session_id"] == 51
    assert ev.distinct_event_keys(facts[1]).where("user_id = 5").count() == 1


def test_pivot_and_conditional_first_times_agree(facts, rows):
    plain = rows(ev.first_times(facts[1]), "user_id")
    pivot = rows(ev.first_times_pivot(facts[1]), "user_id")
    assert set(pivot) == {1, 2, 3, 4} and set(plain) == {1, 2, 3, 4, 5, 7}
    for u, r in pivot.items():
        assert r["session_booked_ts"] == plain[u]["first_booking_ts"]
        assert r["onboarding_started_ts"] == plain[u]["onboarding_started_ts"]


def test_sessions_skip_null_and_take_the_users_device(facts, rows):
    got = rows(ev.sessions_from_events(facts[1], facts[0]), "session_id")
    assert set(got) == {50, 51, 70}
    assert (got[70]["session_start_ts"], got[70]["session_end_ts"]) == (SIGNUP + DAY, SIGNUP + 2 * DAY)
    assert got[70]["device"] == "ios"


def test_windows_and_event_names_are_parameters(facts, rows):
    exp = Experiment(names=EventNames(opened="other"), windows=Windows(retention_short=2, retention_long=3))
    got = rows(um.retention_user_level(facts[0], facts[1], exp), "user_id")
    assert (got[7]["retained_d7"], got[7]["retained_d30"]) == (1, 0)
    assert got[3]["retained_d7"] == 0


def test_extra_columns_of_the_two_wide_tables(table, facts):
    users = table(
        "dim_users",
        {"user_id": 1, "signup_ts": SIGNUP.replace(year=2024, month=12, day=31), "actually_exposed_variant": "treatment"},
    )
    dash = um.dashboard_user_level(users, *facts[1:]).collect()[0]
    bi = um.bi_user_level(users, *facts[1:]).collect()[0]
    assert len(dash) == 21 and len(bi) == 22
    assert dash["noncompliance_flag"] == 1 and bi["saw_treatment"] == 1
    assert bi["signup_week"] == "2024-12-30/2025-01-05"
    assert str(dash["signup_date"]) == "2024-12-31"


def test_seven_days_are_168_hours_in_a_zone_with_daylight_saving(spark, table):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        signup = SIGNUP.replace(month=3, day=8)
        users = table("dim_users", {"user_id": 1, "signup_ts": signup})
        late = signup + 7 * DAY - TICK
        events = table("fact_events", event("a", 1, "app_open", late))
        assert um.retention_user_level(users, events).collect()[0]["retained_d7"] == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
