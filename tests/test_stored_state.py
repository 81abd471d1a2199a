"""State kept per user, tables laid out for their queries, and statistics over large inputs."""

from __future__ import annotations

import numpy as np
import pytest
from conftest import DAY, SIGNUP
from pyspark.sql import functions as F

from liftline.catalog.queries import _third
from liftline.operators import exact_bootstrap as eb, multiple_testing as mt, user_metrics as um
from liftline.params import Bootstrap
from liftline.sources import user_level
from liftline.sources.star import MERGES, Star
from liftline.sources.testbeds import PRODUCT, product_tables

SF = "/root/testdata/sf0.001"
FACTS = ("fact_support_tickets", "fact_cancellations", "fact_matches")


@pytest.fixture(scope="module")
def tables(spark):
    return dict(product_tables(spark, SF).items())


def same(a, b) -> bool:
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_three_batches_equal_a_full_rebuild(spark, tables, tmp_path):
    star = Star(spark, str(tmp_path), "three", buckets=4, exp=PRODUCT)
    star.build(_third(tables, 0))
    star.refresh(_third(tables, 1))
    star.refresh(_third(tables, 2))
    whole = um.experiment_user_metrics(tables["dim_users"], tables["fact_events"], *[tables[n] for n in FACTS], PRODUCT)
    assert same(star.experiment_user_metrics(), whole)
    # the last two generations stay; another session finds the tables by their files
    assert sorted(p.name for p in (tmp_path / "users").iterdir()) == ["2", "3"]
    assert same(Star(spark, str(tmp_path), "again", buckets=4, exp=PRODUCT).experiment_user_metrics(), whole)
    # an unnamed generation, left by a dead driver, is written over
    spark.range(3).write.parquet(str(tmp_path / "users" / "4"))
    star.refresh({"fact_events": tables["fact_events"]})
    assert same(star.experiment_user_metrics(), whole)


def test_stored_state_is_joined_without_a_shuffle(spark, tables, tmp_path):
    star = Star(spark, str(tmp_path), "joined", buckets=4, exp=PRODUCT)
    star.build(tables)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = star.experiment_user_metrics()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("SortMergeJoin") == len(MERGES) and "Exchange" not in plan


def test_a_moved_signup_is_refused(spark, table, tmp_path):
    star = Star(spark, str(tmp_path), "moved", buckets=2)
    none = {n: table(n) for n in ("fact_events", *FACTS)}
    star.build({"dim_users": table("dim_users", {"user_id": 1}), **none})
    star.refresh({"dim_users": table("dim_users", {"user_id": 1, "country": "FR"}, {"user_id": 2})})
    assert {r["user_id"]: r["country"] for r in star.experiment_user_metrics().collect()} == {1: "FR", 2: "US"}
    with pytest.raises(ValueError, match="1 users signed up at another time"):
        star.refresh({"dim_users": table("dim_users", {"user_id": 1, "signup_ts": SIGNUP + DAY})})
    tickets = table("fact_support_tickets", *({"ticket_id": i, "user_id": 2, "created_ts": SIGNUP + i * DAY} for i in (0, 29, 30)))
    star.refresh({"fact_support_tickets": tickets})
    assert {r["user_id"]: r["support_tickets_30d"] for r in star.experiment_user_metrics().collect()} == {1: 0, 2: 2}


def test_a_date_filter_reads_the_folders_of_its_days(spark, tables, tmp_path):
    users = um.bi_user_level(tables["dim_users"], tables["fact_events"], *[tables[n] for n in FACTS], PRODUCT)
    many = users.withColumn("signup_date", F.expr("date_add(signup_date, cast(user_id % 20 as int))"))
    user_level.write_user_level(many, str(tmp_path))
    stored = user_level.read_user_level(spark, str(tmp_path), many.columns)
    assert same(stored, many)
    day = many.agg(F.min("signup_date")).first()[0]
    kept = stored.where(F.col("signup_date") == F.lit(day))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(signup_date" in plan
    assert kept.count() == many.where(F.col("signup_date") == F.lit(day)).count()


# --- resampling with exactly n draws ---


def arms(spark, n: int, seed: int = 4):
    rng = np.random.default_rng(seed)
    rows = [(i, "treatment" if i % 3 else "control", float(rng.normal(i % 3, 2)), float(rng.random() < 0.3) if i % 7 else None) for i in range(n)]
    return spark.createDataFrame(rows, "user_id long, assigned_variant string, y double, z double")


def test_every_replicate_has_exactly_n_draws(spark, monkeypatch):
    monkeypatch.setattr(eb, "LEAF_USERS", 16)  # a tree of several levels
    df, boot = arms(spark, 1_000), Bootstrap(replicates=300)
    wanted = {("y", "control"): 334, ("y", "treatment"): 666, ("z", "control"): 286, ("z", "treatment"): 571}
    one = {tuple(r) for r in eb.exact_sums(df.coalesce(1), ["y", "z"], boot).collect()}
    assert len(one) == 4 * 300 and all(n == wanted[metric, arm] for metric, arm, _, n, _ in one)
    many = {tuple(r) for r in eb.exact_sums(df.repartition(13), ["y", "z"], boot).collect()}
    rounded = lambda rows: {(*r[:4], round(r[4], 6)) for r in rows}
    assert rounded(one) == rounded(many)


def test_exact_intervals_agree_with_plain_resampling(spark, monkeypatch):
    monkeypatch.setattr(eb, "LEAF_USERS", 64)
    df = arms(spark, 2_000)
    got = {r["metric"]: (r["ci_low"], r["ci_high"]) for r in eb.exact_intervals(df, ["y", "z"], Bootstrap(replicates=2_000)).collect()}
    rows = df.toPandas()
    rng = np.random.default_rng(1)
    for metric in ("y", "z"):
        t, c = (rows.loc[(rows["assigned_variant"] == arm) & rows[metric].notna(), metric].to_numpy() for arm in ("treatment", "control"))
        plain = [rng.choice(t, len(t)).mean() - rng.choice(c, len(c)).mean() for _ in range(2_000)]
        low, high = np.percentile(plain, [2.5, 97.5])
        width = high - low
        assert abs(got[metric][1] - got[metric][0] - width) < 0.08 * width
        assert abs(got[metric][0] - low) < 0.08 * width and abs(got[metric][1] - high) < 0.08 * width


def test_exact_resampling_of_nothing(spark):
    df = arms(spark, 10)
    assert eb.exact_intervals(df.where("false"), ["y"]).count() == 0
    single = eb.exact_sums(df.where("user_id = 0"), ["y", "z"], Bootstrap(replicates=5)).collect()
    assert {(r["metric"], r["n"]) for r in single} == {("y", 1)}


# --- q-values of large families ---


def test_q_values_over_ranges_equal_those_in_one_window(spark):
    rng = np.random.default_rng(2)
    rows = [(i, ("a", "b", None)[i % 3], None if i % 50 == 0 else float(np.round(rng.random() ** 3, 2))) for i in range(3_000)]
    rows += [(3_000, "only missing", None), (3_001, "one", 0.2)]
    df = spark.createDataFrame(rows, "i long, family string, p_value double")
    one = mt.benjamini_hochberg(df, ["i"], ["family"])
    assert same(mt.benjamini_hochberg_large(df, ["i"], ["family"]), one)
    alone = mt.benjamini_hochberg_large(df, ["i"])
    assert same(alone, mt.benjamini_hochberg(df.withColumn("all", F.lit(0)), ["i"], ["all"]).drop("all"))
    plan = alone._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "CartesianProduct" not in plan
    assert mt.benjamini_hochberg_large(df.where("false"), ["i"]).count() == 0
