from __future__ import annotations

from decimal import Decimal

import pytest
from conftest import DAY, SIGNUP, TICK

from liftline.sources import files, upsert as up, views


def test_csv_and_parquet_keep_every_value(spark, table, tmp_path):
    events = table(
        "fact_events",
        {"event_id": "e,1", "user_id": 1, "event_ts": SIGNUP + TICK, "event_name": "a", "properties_json": '{"k": "x, \\"y\\""}'},
        {"event_id": "e2", "user_id": 2, "event_ts": SIGNUP, "event_name": "b", "session_id": 4, "properties_json": "null"},
    )
    prices = table("fact_subscriptions", {"user_id": 1, "subscribed_ts": SIGNUP, "price_monthly": Decimal("12.30")})
    for fmt in ("csv", "parquet"):
        for name, df in (("fact_events", events), ("fact_subscriptions", prices)):
            files.write_table(df, files.table_path(str(tmp_path), name, fmt), fmt)
            back = files.read_table(spark, str(tmp_path), name, fmt)
            assert sorted(back.collect(), key=str) == sorted(df.collect(), key=str)
            assert back.dtypes == df.dtypes


def test_hand_written_csv_and_default_column(spark, tmp_path):
    path = tmp_path / "dim_users.csv"
    path.write_text(
        "user_id,signup_ts,country,device,acquisition_channel,age_bucket,baseline_score,assigned_variant,"
        "actually_exposed_variant,pre_treatment_sessions_30d\n"
        "1,2024-01-01 12:00:00,US,ios,paid,18-24,0.25,control,control,3\n"
    )
    r = files.read_table(spark, str(tmp_path), "dim_users", "csv").collect()[0]
    assert r["signup_ts"] == SIGNUP and r["pre_treatment_sessions_30d"] == 3 and r["created_at"] is not None


def test_bad_csv_fails(spark, tmp_path):
    path = tmp_path / "fact_matches.csv"
    path.write_text("user_id,matched_ts,therapist_id\nx,2024-01-01 00:00:00,1\n")
    with pytest.raises(Exception, match="MALFORMED|CAST_INVALID|FAILED_READ_FILE"):
        files.read_table(spark, str(tmp_path), "fact_matches", "csv").collect()


def test_all_missing_inputs_are_named(spark, table, tmp_path):
    root = str(tmp_path)
    files.write_table(table("fact_matches", {"user_id": 1, "matched_ts": SIGNUP}), files.table_path(root, "fact_matches", "parquet"))
    assert files.missing_inputs(spark, root, ["fact_matches", "dim_users", "fact_events"]) == ["dim_users", "fact_events"]
    with pytest.raises(FileNotFoundError, match="dim_users, fact_events"):
        files.read_tables(spark, root, ["dim_users", "fact_matches", "fact_events"])


def test_upsert_forms(spark, rows):
    target = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "k long, v string, w long")
    incoming = spark.createDataFrame([(2, "B", None), (3, "C", 30)], "k long, v string, w long")
    got = {r["k"]: (r["v"], r["w"]) for r in up.upsert(target, incoming, ["k"]).collect()}
    assert got == {1: ("a", 10), 2: ("B", None), 3: ("C", 30)}
    got = {r["k"]: (r["v"], r["w"]) for r in up.upsert(target, incoming.drop("w"), ["k"]).collect()}
    assert got == {1: ("a", 10), 2: ("B", 20), 3: ("C", None)}
    got = {r["k"]: (r["v"], r["w"]) for r in up.upsert(target, incoming.select("k"), ["k"]).collect()}
    assert got == {1: ("a", 10), 2: ("b", 20), 3: (None, None)}


def test_stored_tables_are_upserted_together(spark, table, tmp_path):
    root = str(tmp_path)
    first = {
        "dim_users": table("dim_users", {"user_id": 1, "device": "ios"}, {"user_id": 2, "device": "web"}),
        "fact_matches": table("fact_matches", {"user_id": 1, "matched_ts": SIGNUP}),
    }
    up.upsert_tables(spark, root, first)
    second = {
        "dim_users": table("dim_users", {"user_id": 2, "device": "android"}, {"user_id": 3}).drop("created_at"),
        "fact_matches": table("fact_matches", {"user_id": 1, "matched_ts": SIGNUP + DAY}),
    }
    up.upsert_tables(spark, root, second)
    users = {r["user_id"]: r for r in files.read_table(spark, root, "dim_users").collect()}
    assert {u: r["device"] for u, r in users.items()} == {1: "ios", 2: "android", 3: "ios"}
    assert users[2]["created_at"] == SIGNUP and users[3]["created_at"] > SIGNUP
    assert files.read_table(spark, root, "fact_matches").collect()[0]["matched_ts"] == SIGNUP + DAY


def test_repeated_incoming_keys_change_nothing(spark, table, tmp_path):
    root = str(tmp_path)
    up.upsert_tables(spark, root, {"fact_matches": table("fact_matches", {"user_id": 1, "matched_ts": SIGNUP})})
    twice = table("fact_matches", {"user_id": 2, "matched_ts": SIGNUP}, {"user_id": 2, "matched_ts": SIGNUP + DAY})
    with pytest.raises(ValueError, match="fact_matches"):
        up.upsert_tables(spark, root, {"fact_matches": twice})
    assert files.read_table(spark, root, "fact_matches").count() == 1


def test_a_failed_write_leaves_the_stored_tables(spark, table, tmp_path):
    from pyspark.sql import functions as F

    root = str(tmp_path)
    up.upsert_tables(spark, root, {"fact_matches": table("fact_matches", {"user_id": 1, "matched_ts": SIGNUP})})
    good = table("fact_matches", {"user_id": 2, "matched_ts": SIGNUP})
    bad = table("fact_support_tickets", {"ticket_id": 1, "user_id": 1, "created_ts": SIGNUP}).withColumn(
        "category", F.raise_error(F.lit("broken source"))
    )
    with pytest.raises(Exception, match="broken source"):
        up.upsert_tables(spark, root, {"fact_matches": good, "fact_support_tickets": bad})
    assert files.read_table(spark, root, "fact_matches").count() == 1
    assert files.missing_inputs(spark, root, ["fact_support_tickets"]) == ["fact_support_tickets"]


def test_ten_views(spark, table):
    tables = {
        "dim_users": table("dim_users", {"user_id": 1}, {"user_id": 2, "assigned_variant": "other"}),
        "fact_events": table("fact_events", {"event_id": "e", "user_id": 1, "event_ts": SIGNUP, "event_name": "app_open"}),
        "fact_support_tickets": table("fact_support_tickets"),
        "fact_cancellations": table("fact_cancellations"),
        "fact_matches": table("fact_matches"),
    }
    assert len(views.register_views(tables)) == 10
    assert spark.table("vw_experiment_user_metrics").count() == 2
    got = views.analysis_input_from_view(spark)
    assert got.count() == 1 and got.columns == views.ANALYSIS_COLUMNS
