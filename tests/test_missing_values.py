"""Rows that the clean test data never hold: missing p-values, baselines, covariates and keys, repeated facts."""

from __future__ import annotations

import pytest
from conftest import DAY, SIGNUP
from pyspark.sql import functions as F

from liftline.functions.numeric import clamp_probability, number_text, percent_text
from liftline.operators import cuped, power, quality, user_metrics as um
from liftline.operators.moments import arm_moments
from liftline.operators.multiple_testing import benjamini_hochberg, with_metric_fdr
from liftline.params import Bootstrap
from liftline.session import scratch_path
from liftline.sources import files, upsert as up


def test_a_missing_p_value_ranks_last(spark):
    tests = spark.createDataFrame([("a", None), ("b", 0.01), ("c", 0.02), ("d", 0.3)], "metric string, p_value double")
    got = {r["metric"]: r["q"] for r in benjamini_hochberg(tests, ["metric"], [], out="q").collect()}
    assert got == {"a": 1.0, "b": pytest.approx(0.04), "c": pytest.approx(0.04), "d": pytest.approx(0.4)}


def test_a_missing_p_value_is_never_significant(spark):
    rows = [("activated_within_7d", None), ("retained_d7", None), ("retained_d30", 0.001)]
    got = with_metric_fdr(spark.createDataFrame(rows, "metric string, p_value double"))
    assert {r["metric"]: r["significant_fdr_05"] for r in got.collect()} == {
        "activated_within_7d": False, "retained_d7": False, "retained_d30": True
    }


def test_no_baseline_no_sample_size(spark):
    rows = spark.createDataFrame([(None, 100, 100), (0.3, None, 100), (0.3, 100, 100)], "b double, c long, t long")
    got = rows.select(
        power.required_n(F.col("b"), F.lit(0.01)).alias("n"),
        power.detectable_lift(F.col("b"), F.col("c"), F.col("t")).alias("lift"),
        clamp_probability(F.col("b")).alias("p"),
    ).collect()
    assert (got[0]["n"], got[0]["lift"], got[0]["p"]) == (None, None, None)
    assert got[1]["n"] == 33275 and got[1]["lift"] is None and got[2]["lift"] is not None


def test_missing_rates_have_no_text(spark):
    got = spark.createDataFrame([(None,), (0.1234,)], "x double").select(percent_text(F.col("x")), number_text(F.col("x")))
    assert [tuple(r) for r in got.collect()] == [(None, None), ("12.34%", "0.1234")]


@pytest.mark.parametrize("buckets", [20, None])
def test_the_raw_effect_counts_users_without_a_covariate(spark, buckets):
    rows = [(i, ("control", "treatment")[i % 2], int(i % 3 == 0 or (i % 2 == 1 and i % 5 < 2)), None if i % 4 == 1 else float(i % 7))
            for i in range(400)]
    df = spark.createDataFrame(rows, "user_id long, assigned_variant string, y int, x double")
    table = cuped.cuped_table(df, "x", ["y"], Bootstrap(replicates=20, buckets=buckets)).first()
    arms = {r["assigned_variant"]: r["mean"] for r in arm_moments(df, ["y"]).collect()}
    assert table["raw_effect_abs"] == pytest.approx(arms["treatment"] - arms["control"])
    some = {r["assigned_variant"]: r["mean"] for r in arm_moments(df.where("x IS NOT NULL"), ["y"]).collect()}
    assert abs(table["raw_effect_abs"] - (some["treatment"] - some["control"])) > 1e-3


def test_a_reference_to_an_absent_table_is_an_error(table):
    tables = {"fact_cancellations": table("fact_cancellations", {"user_id": 1, "cancelled_ts": SIGNUP})}
    with pytest.raises(ValueError, match="fact_subscriptions"):
        quality.foreign_key_violations(tables)


def test_repeated_facts_leave_one_row_per_user(table):
    users = table("dim_users", {"user_id": 1}, {"user_id": 2})
    events = table("fact_events", {"event_id": "e", "user_id": 1, "event_ts": SIGNUP, "event_name": "app_open"})
    tickets = table("fact_support_tickets", {"ticket_id": 1, "user_id": 1, "created_ts": SIGNUP + DAY})
    cancelled = table("fact_cancellations", {"user_id": 1, "cancelled_ts": SIGNUP + 40 * DAY}, {"user_id": 1, "cancelled_ts": SIGNUP + DAY})
    matches = table("fact_matches", {"user_id": 1, "matched_ts": SIGNUP + 3 * DAY}, {"user_id": 1, "matched_ts": SIGNUP + DAY})
    got = {r["user_id"]: r for r in um.experiment_user_metrics(users, events, tickets, cancelled, matches).collect()}
    assert len(got) == 2 and got[1]["cancelled_30d"] == 1 and got[1]["time_to_first_match_hours"] == 24
    for frame in (
        um.cancellation_user_level(users, cancelled), um.match_latency_user_level(users, matches),
        um.guardrails_user_level(users, tickets, cancelled, matches),
    ):
        assert frame.count() == 2


def test_an_upsert_refuses_missing_keys_and_leaves_nothing_behind(spark, table, tmp_path):
    root = str(tmp_path)
    files.write_table(table("fact_matches", {"user_id": 1, "matched_ts": SIGNUP}), files.table_path(root, "fact_matches", "parquet"))
    with pytest.raises(ValueError, match="no user_id"):
        up.upsert_tables(spark, root, {"fact_matches": table("fact_matches", {"user_id": None, "matched_ts": SIGNUP})})
    broken = table("fact_matches", {"user_id": 2, "matched_ts": SIGNUP}).withColumn("therapist_id", F.raise_error(F.lit("no")).cast("long"))
    with pytest.raises(Exception):
        up.upsert_tables(spark, root, {"fact_matches": broken})
    assert not any(tmp_path.glob("_staged/*")) and files.read_table(spark, root, "fact_matches").count() == 1


def test_stored_creation_times_survive_csv(spark, table, tmp_path):
    users = table("dim_users", {"user_id": 1, "created_at": SIGNUP - DAY})
    files.write_table(users, files.table_path(str(tmp_path), "dim_users", "csv"), "csv")
    assert files.read_table(spark, str(tmp_path), "dim_users", "csv").collect() == users.collect()


def test_scratch_space_is_never_local_on_a_cluster():
    class Conf(dict):
        def get(self, key, default=None):
            return dict.get(self, key, default)

    class Session:
        pass

    for master, allowed in (("local", True), ("local[8]", True), ("local-cluster[2,1,512]", False), ("yarn", False), (None, False)):
        session = Session()
        session.conf = Conf({"spark.master": master} if master else {})
        if allowed:
            assert scratch_path(session, "x")
        else:
            with pytest.raises(RuntimeError):
                scratch_path(session, "x")
    session.conf = Conf({"spark.checkpoint.dir": "hdfs://shared/"})
    assert scratch_path(session, "x").startswith("hdfs://shared/x-")
