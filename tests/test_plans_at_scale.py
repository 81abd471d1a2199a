"""What the physical plans must look like, whatever the size of the data."""

from __future__ import annotations

import re

import pytest
from conftest import SIGNUP

from liftline.operators import ab_tests, bootstrap, cuped, events as ev, moments, user_metrics as um
from liftline.params import Bootstrap, Experiment
from liftline.sources import files

FAR_FROM_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1"}


@pytest.fixture
def settings(spark):
    changed = {}

    def apply(values):
        for k, v in values.items():
            changed[k] = spark.conf.get(k, None)
            spark.conf.set(k, v)

    yield apply
    for k, v in changed.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored_events(spark, table, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("events"))
    events = table("fact_events", {"event_id": "e", "user_id": 1, "event_ts": SIGNUP, "event_name": "app_open"})
    files.write_table(events, files.table_path(root, "fact_events", "parquet"))
    return files.read_table(spark, root, "fact_events")


def test_milestones_read_three_columns_filter_at_the_scan_and_shuffle_once(stored_events):
    text = plan(ev.milestones(stored_events))
    assert "PushedFilters: [In(event_name" in text
    assert re.search(r"ReadSchema: struct<user_id:bigint,event_ts:timestamp_ntz,event_name:string>", text)
    assert text.count("Exchange hashpartitioning") == 1 and "partial_min" in text


def test_dedup_limits_groups_before_the_shuffle_and_lets_filters_through(stored_events):
    text = plan(ev.deduped_events(stored_events).where("event_name = 'app_open'"))
    assert re.search(r"WindowGroupLimit.*Partial", text) and "EqualTo(event_name,app_open)" in text


def test_a_user_owning_most_tickets_is_split(spark, settings):
    settings(
        {
            **FAR_FROM_BROADCAST,
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
        }
    )
    users = spark.range(2000).selectExpr(
        "id AS user_id", "timestampadd(SECOND, -(id % 60), TIMESTAMP_NTZ'2024-01-01 00:00:00') AS signup_ts"
    )
    # A third of all tickets belongs to user 7.
    tickets = spark.range(0, 90000, 1, 16).selectExpr(
        "id AS ticket_id",
        "CASE WHEN id % 3 = 0 THEN 7 ELSE id % 2000 END AS user_id",
        "timestampadd(SECOND, id, TIMESTAMP_NTZ'2024-01-01 00:00:00') AS created_ts",
    )
    counted = um.count_after_signup(users, tickets, "created_ts", 30, "n")
    got = {r["user_id"]: r["n"] for r in counted.collect()}
    text = plan(counted)
    assert "SortMergeJoin(skew=true)" in text.split("Initial Plan")[0]
    assert sum(got.values()) == 90000 and got[7] >= 30000


@pytest.mark.parametrize("kind", ["results", "segments", "cuped"])
def test_everything_estimated_from_users_takes_one_pass(spark, settings, kind):
    settings(FAR_FROM_BROADCAST)
    df = spark.range(500).selectExpr(
        "id AS user_id",
        "CASE WHEN id % 2 = 0 THEN 'control' ELSE 'treatment' END AS assigned_variant",
        "CAST(id % 3 AS INT) AS activated_within_7d",
        "CAST(id % 5 AS STRING) AS device",
        "CAST(id % 7 AS STRING) AS age_bucket",
        "CAST(id % 11 AS DOUBLE) AS baseline_score",
    )
    boot, metrics = Bootstrap(replicates=8), ["activated_within_7d"]
    if kind == "results":
        result = ab_tests.ab_result_table(df, metrics, boot)
    elif kind == "segments":
        exp = Experiment(min_segment_arm=10, segment_bootstrap=boot)
        result = ab_tests.segment_tests(df, ["device", "age_bucket"], exp=exp)
    else:
        result = cuped.cuped_table(df, metrics=metrics, boot=boot)
    assert result.collect()
    final = plan(result).split("Initial Plan")[0]
    assert "ReusedExchange" in final and final.count("Range (0, 500") == 1


def test_user_metrics_shuffle_each_input_once(table, settings, tmp_path, spark):
    """Users, events, cancellations, matches by user; tickets and signup times by the join id; and the
    partial ticket counts. Every later join reuses the partitioning by user."""
    settings(FAR_FROM_BROADCAST)
    root = str(tmp_path)
    rows = {
        "dim_users": {"user_id": 1},
        "fact_events": {"event_id": "e", "user_id": 1, "event_ts": SIGNUP, "event_name": "app_open"},
        "fact_support_tickets": {"ticket_id": 1, "user_id": 1, "created_ts": SIGNUP},
        "fact_cancellations": {"user_id": 1, "cancelled_ts": SIGNUP},
        "fact_matches": {"user_id": 1, "matched_ts": SIGNUP},
    }
    for name, row in rows.items():
        files.write_table(table(name, row), files.table_path(root, name, "parquet"))
    t = files.read_tables(spark, root, list(rows))
    text = plan(um.experiment_user_metrics(*t.values()))
    assert text.count("Exchange hashpartitioning") == 7
    assert re.search(r"FileScan parquet \[user_id#\d+L,event_ts#\d+,event_name#\d+\]", text)


def test_hot_users_events_are_split_when_joined_to_users(spark, settings):
    settings(
        {
            **FAR_FROM_BROADCAST,
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
        }
    )
    users = spark.range(2000).selectExpr(
        "id AS user_id", "timestampadd(SECOND, id, TIMESTAMP_NTZ'2024-01-01 00:00:00') AS signup_ts", "'ios' AS device",
        "'control' AS assigned_variant",
    )
    events = spark.range(0, 90000, 1, 16).selectExpr(
        "CAST(id AS STRING) AS event_id",
        "CASE WHEN id % 3 = 0 THEN 7 ELSE id % 2000 END AS user_id",
        "'app_open' AS event_name",
        "timestampadd(SECOND, id, TIMESTAMP_NTZ'2024-01-01 00:00:00') AS event_ts",
    )
    joined = ev.events_with_signup(events, users)
    assert len(joined.collect()) == 90000
    assert "SortMergeJoin(skew=true)" in plan(joined).split("Initial Plan")[0]


def test_segment_replicates_use_all_tasks_of_a_shuffle(spark):
    users = spark.range(4_000).selectExpr(
        "id AS user_id", "IF(id % 2 = 0, 'control', 'treatment') AS assigned_variant", "CAST(id % 3 = 0 AS INT) AS y",
        "CAST(id % 2000 AS STRING) AS segment_value",
    )
    boot = Bootstrap(replicates=8, buckets=4)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    try:
        cells = moments.bucket_cells(users, ["y"], boot, ["segment_value"])
        plan = bootstrap.replicate_sums(cells, ["n_y", "sy_y"], boot, ["segment_value"])._jdf.queryExecution().toString()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert "RepartitionByExpression" in plan and ", 37" in plan
