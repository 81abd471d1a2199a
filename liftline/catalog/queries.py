"""Named queries over the supplied tables, one per operator.

Every query takes a session and a data folder and reads whole tables. ``product`` queries run on the
click log, ``commerce`` queries on customers and orders (see ``liftline.sources.testbeds``). Doubles
that depend on summation order are rounded so that results can be compared by value.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from liftline.functions.numeric import number_text, percent_text
from liftline.operators import (
    ab_tests,
    bootstrap,
    cuped,
    decisions,
    events as ev,
    exact_bootstrap,
    moments,
    multiple_testing,
    power,
    quality,
    summaries as sm,
    user_metrics as um,
)
from liftline.params import CUPED_METRICS, METRICS
from liftline.schemas import READOUT_INPUTS, TABLES
from liftline.session import scratch_path
from liftline.sources import files, upsert as up, user_level, views
from liftline.sources.spoiled import spoiled_tables
from liftline.sources.star import Star
from liftline.sources.testbeds import COMMERCE, PRODUCT, commerce_tables, product_tables, raw_table

# Arms by outcome: the primary metric wins without and with worsened guardrails.
WINNING_ARM = "activated_within_7d = 1 AND cancelled_30d = 0 AND support_tickets_30d = 0 OR user_id % 4 = 0"
COSTLY_ARM = "activated_within_7d = 1 OR cancelled_30d = 1 OR support_tickets_30d > 0 OR user_id % 4 = 0"
HARMLESS_ARM = WINNING_ARM + " OR time_to_first_match_hours < 500 AND cancelled_30d = 0 AND support_tickets_30d = 0"

Query = Callable[[SparkSession, str], DataFrame]


def rounded(df: DataFrame, columns: Iterable[str], digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) + F.lit(0.0) for c in columns})


# --- inputs shared by the queries below ---------------------------------------------------------


def _facts(tables: dict[str, DataFrame]) -> tuple[DataFrame, ...]:
    return tables["fact_support_tickets"], tables["fact_cancellations"], tables["fact_matches"]


def _build(tables: dict[str, DataFrame], builder, exp) -> DataFrame:
    return builder(tables["dim_users"], tables["fact_events"], *_facts(tables), exp)


def _product_metrics(spark, sf):
    return _build(product_tables(spark, sf), um.experiment_user_metrics, PRODUCT)


def _product_dashboard(spark, sf):
    return _build(product_tables(spark, sf), um.dashboard_user_level, PRODUCT)


def _product_bi(spark, sf):
    return _build(product_tables(spark, sf), um.bi_user_level, PRODUCT)


def _commerce_dashboard(spark, sf):
    return _build(commerce_tables(spark, sf), um.dashboard_user_level, COMMERCE)


def _commerce_bi(spark, sf):
    return _build(commerce_tables(spark, sf), um.bi_user_level, COMMERCE)


def _commerce_metrics(spark, sf):
    return views.analysis_input(_build(commerce_tables(spark, sf), um.experiment_user_metrics, COMMERCE))


def _commerce_sessions_metrics(spark, sf):
    return _build(commerce_tables(spark, sf), um.experiment_user_metrics, COMMERCE)


# --- sources and sinks --------------------------------------------------------------------------


def users_through_csv(spark, sf):
    """Users written as CSV and read back with the declared schema, stored creation times included."""
    root = scratch_path(spark, "users-csv")
    users = product_tables(spark, sf)["dim_users"]
    files.write_table(users, files.table_path(root, "dim_users", "csv"), "csv")
    return files.read_tables(spark, root, ["dim_users"], "csv")["dim_users"]


def events_through_parquet(spark, sf):
    """Events written as Parquet and read back through the table reader."""
    root = scratch_path(spark, "events-parquet")
    files.write_table(product_tables(spark, sf)["fact_events"], files.table_path(root, "fact_events", "parquet"))
    return files.read_tables(spark, root, ["fact_events"])["fact_events"]


def users_through_stored_upsert(spark, sf):
    """Half of the users stored with another country, then all of them upserted and read back."""
    root = scratch_path(spark, "warehouse")
    users = product_tables(spark, sf)["dim_users"]
    up.upsert_tables(spark, root, {"dim_users": users.where("user_id % 2 = 0").withColumn("country", F.lit("XX"))})
    up.upsert_tables(spark, root, {"dim_users": users}, check=quality.require_constraints)
    return files.read_tables(spark, root, ["dim_users"])["dim_users"]


def one_row_batch_folders(spark, sf):
    """A batch of one user against users stored in folders: how many folders it replaces, and how many other files change."""
    root = scratch_path(spark, "warehouse-parts")
    users = product_tables(spark, sf)["dim_users"]
    up.upsert_tables(spark, root, {"dim_users": users})
    listed = lambda: set(files.read_table(spark, root, "dim_users").inputFiles())
    before = listed()
    last = users.orderBy(F.desc("user_id")).limit(1).withColumn("country", F.lit("XX"))
    folders = up.upsert_tables(spark, root, {"dim_users": last}, constraints=True)["dim_users"]
    others = {f for f in before ^ listed() if not any(folder in f for folder in folders)}
    stored = files.read_table(spark, root, "dim_users")
    return stored.agg(F.count(F.lit(1)).alias("users"), F.count_if(F.col("country") == "XX").alias("changed_users")).select(
        "*", F.lit(len(folders)).cast("long").alias("replaced_folders"), F.lit(len(others)).cast("long").alias("other_files_changed")
    )


def batch_constraint_violations(spark, sf):
    """Rules a spoiled batch would break: users of even id are stored, facts and users of odd id come in. Only the batch and the stored
    keys it refers to are looked at."""
    tables, root = commerce_tables(spark, sf), scratch_path(spark, "warehouse-checked")
    even, odd = "user_id % 2 = 0", "user_id % 2 = 1"
    up.upsert_tables(spark, root, {n: tables[n].where(even) for n in ("dim_users", "fact_subscriptions")})
    spoiled = _spoiled(spark, sf)
    batch = {n: spoiled[n].where(odd if n in ("dim_users", "fact_subscriptions") else "true") for n in ("dim_users", "fact_subscriptions", "fact_cancellations", "fact_matches")}
    batch = {n: df.dropDuplicates([TABLES[n].key]) for n, df in batch.items()}
    store = up.Store(spark, root)
    return quality.batch_violations(batch, lambda parent, keys, column: store.known(parent, keys, column, batch))


def _third(tables: dict[str, DataFrame], k: int) -> dict[str, DataFrame]:
    """A third of all facts, by a hash; users of ids that 5 divides come with the second third, their facts not before them."""
    late = F.col("user_id") % 5 == 0
    out = {"dim_users": tables["dim_users"].where((~late, late, F.lit(False))[k])}
    for name in ("fact_events", "fact_cancellations", "fact_matches", "fact_support_tickets"):
        deal = F.pmod(F.hash(TABLES[name].key), F.lit(3))
        out[name] = tables[name].where(F.when(late, F.greatest(deal, F.lit(1))).otherwise(deal) == k)
    return out


def metrics_after_three_batches(spark, sf):
    """The user-level table from stored state that three batches were merged into, joined bucket by bucket."""
    tables = product_tables(spark, sf)
    root = scratch_path(spark, "star")
    star = Star(spark, root, f"star_{root[-32:]}", exp=PRODUCT, buckets=8)
    star.build(_third(tables, 0))
    star.refresh(_third(tables, 1))
    star.refresh(_third(tables, 2))
    return rounded(star.experiment_user_metrics(), ["time_to_first_match_hours"])


def required_inputs(spark, sf):
    """Which inputs of a readout a folder lacks that holds users and matches only."""
    root = scratch_path(spark, "inputs")
    tables = product_tables(spark, sf)
    for name in ("dim_users", "fact_matches"):
        files.write_table(tables[name], files.table_path(root, name, "parquet"))
    missing = files.missing_inputs(spark, root, READOUT_INPUTS)
    counts = files.row_counts({n: files.read_table(spark, root, n) for n in READOUT_INPUTS if n not in missing})
    lacking = spark.createDataFrame([(n,) for n in missing], "table_name string")
    return counts.unionByName(lacking, allowMissingColumns=True)


def input_row_counts(spark, sf):
    return files.row_counts(product_tables(spark, sf))


def analysis_input(spark, sf):
    return rounded(views.analysis_input(_product_metrics(spark, sf)), ["time_to_first_match_hours"])


def view_layer_segment_summary(spark, sf):
    views.register_views(product_tables(spark, sf, hourly=True), PRODUCT)
    return spark.sql("SELECT * FROM vw_experiment_segment_summary")


def view_layer_row_counts(spark, sf):
    tables = product_tables(spark, sf, hourly=True)
    names = views.register_views(tables, PRODUCT)
    return files.row_counts({name: spark.table(name) for name in names})


def _latest_orders(orders: DataFrame) -> DataFrame:
    return orders.groupBy("o_custkey").agg(
        F.max("o_orderdate").alias("last_order_ts"), F.count(F.lit(1)).alias("orders")
    )


def upsert_latest_orders(spark, sf):
    """Customers known up to the end of 1997, updated with everything ordered since."""
    orders = raw_table(spark, sf, "orders")
    split = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    return up.upsert(_latest_orders(orders.where(split)), _latest_orders(orders.where(~split)), ["o_custkey"])


def upsert_keeps_absent_columns(spark, sf):
    """The same with incoming rows that do not carry the order count: stored counts stay."""
    orders = raw_table(spark, sf, "orders")
    split = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    incoming = _latest_orders(orders.where(~split)).drop("orders")
    default = {"orders": F.lit(0).cast("long")}
    return up.upsert(_latest_orders(orders.where(split)), incoming, ["o_custkey"], default)


# --- data quality -------------------------------------------------------------------------------


def null_violations(spark, sf):
    return quality.null_violations(product_tables(spark, sf))


def primary_key_violations(spark, sf):
    return quality.primary_key_violations(product_tables(spark, sf))


def foreign_key_violations(spark, sf):
    return quality.foreign_key_violations(commerce_tables(spark, sf))


def domain_violations(spark, sf):
    return quality.domain_violations(commerce_tables(spark, sf))


def _spoiled(spark, sf):
    return spoiled_tables(commerce_tables(spark, sf))


def spoiled_null_violations(spark, sf):
    return quality.null_violations(_spoiled(spark, sf))


def spoiled_primary_key_violations(spark, sf):
    return quality.primary_key_violations(_spoiled(spark, sf))


def spoiled_foreign_key_violations(spark, sf):
    return quality.foreign_key_violations(_spoiled(spark, sf))


def spoiled_domain_violations(spark, sf):
    return quality.domain_violations(_spoiled(spark, sf))


def spoiled_gates(spark, sf):
    users = _spoiled(spark, sf)["dim_users"]
    return quality.null_assignment_gate(users).unionByName(quality.allocation_gate(users, COMMERCE))


def spoiled_cancellation_user_level(spark, sf):
    """Repeated cancellations leave one row per user."""
    tables = commerce_tables(spark, sf)
    return um.cancellation_user_level(tables["dim_users"], _spoiled(spark, sf)["fact_cancellations"], COMMERCE)


def volume_gates(spark, sf):
    t = product_tables(spark, sf)
    return quality.volume_gates(t["dim_users"], t["fact_events"], PRODUCT)


def null_assignment_gate(spark, sf):
    return quality.null_assignment_gate(product_tables(spark, sf)["dim_users"])


def allocation_gate(spark, sf):
    return quality.allocation_gate(product_tables(spark, sf)["dim_users"], PRODUCT)


def activation_gate(spark, sf):
    t = product_tables(spark, sf, hourly=True)
    return quality.activation_gate(t["dim_users"], t["fact_events"], PRODUCT)


def quality_gates(spark, sf):
    t = commerce_tables(spark, sf)
    return quality.quality_gates(t["dim_users"], t["fact_events"], COMMERCE)


def _hourly_quality_summary(spark, sf):
    t = product_tables(spark, sf, hourly=True)
    return quality.quality_summary(_build(t, um.dashboard_user_level, PRODUCT), t["fact_events"])


def quality_summary(spark, sf):
    return _hourly_quality_summary(spark, sf)


def labelled_quality_summary(spark, sf):
    return _hourly_quality_summary(spark, sf).select(
        sm.relabelled(F.col("check"), sm.QUALITY_LABELS).alias("Check"), F.col("value").alias("Value")
    )


def duplicate_event_rate(spark, sf):
    return quality.duplicate_event_rate(product_tables(spark, sf, hourly=True)["fact_events"])


# --- events -------------------------------------------------------------------------------------


def events_deduped(spark, sf):
    return ev.deduped_events(product_tables(spark, sf, hourly=True)["fact_events"])


def distinct_event_keys(spark, sf):
    return ev.distinct_event_keys(product_tables(spark, sf, hourly=True)["fact_events"])


def first_times(spark, sf):
    return ev.first_times(product_tables(spark, sf)["fact_events"])


def first_times_pivot(spark, sf):
    return ev.first_times_pivot(commerce_tables(spark, sf)["fact_events"])


def sessions_from_events(spark, sf):
    t = product_tables(spark, sf)
    return ev.sessions_from_events(t["fact_events"], t["dim_users"])


def events_with_signup(spark, sf):
    t = product_tables(spark, sf)
    return ev.events_with_signup(t["fact_events"], t["dim_users"])


def json_properties(spark, sf):
    """Per event name: missing properties, the JSON value null, and the sum of one property."""
    properties = F.col("properties_json")
    return (
        product_tables(spark, sf)["fact_events"]
        .groupBy("event_name")
        .agg(
            F.count_if(properties.isNull()).alias("missing"),
            F.count_if(properties == "null").alias("json_null"),
            F.sum(F.get_json_object(properties, "$.k").cast("long")).alias("k_total"),
        )
    )


# --- user-level metrics -------------------------------------------------------------------------


def activation_user_level(spark, sf):
    t = product_tables(spark, sf, hourly=True)
    # a first time is the same whether an event stands once or twice
    return um.activation_user_level(t["dim_users"], t["fact_events"], PRODUCT)


def retention_user_level(spark, sf):
    t = product_tables(spark, sf)
    return um.retention_user_level(t["dim_users"], t["fact_events"], PRODUCT)


def support_user_level(spark, sf):
    t = product_tables(spark, sf)
    return um.support_user_level(t["dim_users"], t["fact_support_tickets"], PRODUCT)


def cancellation_user_level(spark, sf):
    t = product_tables(spark, sf)
    return um.cancellation_user_level(t["dim_users"], t["fact_cancellations"], PRODUCT)


def match_latency_user_level(spark, sf):
    t = product_tables(spark, sf)
    return rounded(
        um.match_latency_user_level(t["dim_users"], t["fact_matches"]), ["time_to_first_match_hours"]
    )


def guardrails_user_level(spark, sf):
    t = commerce_tables(spark, sf)
    return rounded(
        um.guardrails_user_level(t["dim_users"], *_facts(t), COMMERCE), ["time_to_first_match_hours"]
    )


def experiment_user_metrics(spark, sf):
    return rounded(_product_metrics(spark, sf), ["time_to_first_match_hours"])


def experiment_user_metrics_commerce(spark, sf):
    return rounded(_commerce_sessions_metrics(spark, sf), ["time_to_first_match_hours"])


def dashboard_user_level(spark, sf):
    return rounded(_product_dashboard(spark, sf), ["time_to_first_match_hours"])


def bi_user_level(spark, sf):
    return rounded(_product_bi(spark, sf), ["time_to_first_match_hours"])


# --- summaries ----------------------------------------------------------------------------------

_LATENCY = ["avg_time_to_first_match_hours"]


def funnel_step_rates(spark, sf):
    t = product_tables(spark, sf)
    return sm.funnel_step_rates(um.activation_user_level(t["dim_users"], t["fact_events"], PRODUCT))


def retention_rates(spark, sf):
    t = product_tables(spark, sf)
    return sm.retention_rates(um.retention_user_level(t["dim_users"], t["fact_events"], PRODUCT))


def guardrail_rates(spark, sf):
    t = product_tables(spark, sf)
    return rounded(sm.guardrail_rates(um.guardrails_user_level(t["dim_users"], *_facts(t), PRODUCT)), _LATENCY)


def variant_summary(spark, sf):
    return rounded(sm.variant_summary(_product_metrics(spark, sf)), _LATENCY)


def variant_summary_commerce(spark, sf):
    return rounded(sm.variant_summary(_commerce_metrics(spark, sf)), _LATENCY)


def segment_summary(spark, sf):
    return sm.segment_summary(_product_metrics(spark, sf))


def dashboard_variant_summary(spark, sf):
    return rounded(sm.dashboard_variant_summary(_product_dashboard(spark, sf)), ["avg_match_latency_hours"])


def labelled_variant_summary(spark, sf):
    return dashboard_variant_summary(spark, sf).withColumnsRenamed(sm.SUMMARY_LABELS)


def variant_rate_texts(spark, sf):
    """Rates as the readout prints them."""
    summary = sm.dashboard_variant_summary(_product_dashboard(spark, sf))
    return summary.select(
        "assigned_variant",
        percent_text(F.col("activation_rate_7d")).alias("activation"),
        percent_text(F.col("cancellation_rate_30d")).alias("cancellation"),
        number_text(F.col("support_tickets_per_user")).alias("tickets"),
    )


def lift_table(spark, sf):
    return rounded(
        sm.lift_table(sm.variant_summary(_product_metrics(spark, sf))),
        ["control_value", "treatment_value", "absolute_lift", "relative_lift"],
    )


def funnel_long(spark, sf):
    return sm.funnel_long(_product_bi(spark, sf))


def ordered_funnel(spark, sf):
    return sm.ordered_funnel(_commerce_dashboard(spark, sf))


def daily_metrics(spark, sf):
    return rounded(sm.daily_metrics(_commerce_bi(spark, sf)), _LATENCY)


def daily_activation(spark, sf):
    return sm.daily_activation(_product_dashboard(spark, sf)).orderBy("signup_date", "assigned_variant")


def segment_metrics(spark, sf):
    return rounded(sm.segment_metrics(_product_bi(spark, sf)), ["time_to_first_match_hours"])


def segment_activation(spark, sf):
    return sm.segment_activation(_product_dashboard(spark, sf))


def labelled_segments(spark, sf):
    return segment_activation(spark, sf).withColumnsRenamed(sm.SEGMENT_LABELS)


def funnel_by_arm(spark, sf):
    funnel = sm.by_arm(sm.ordered_funnel(_product_dashboard(spark, sf)), ["step"], "rate_from_signup")
    return funnel.withColumn("step", sm.relabelled(F.col("step"), sm.FUNNEL_STEPS))


def daily_activation_by_arm(spark, sf):
    return sm.by_arm(sm.daily_activation(_commerce_dashboard(spark, sf)), ["signup_date"], "activation_rate_7d")


def segment_activation_by_arm(spark, sf):
    return sm.by_arm(
        sm.segment_activation(_product_dashboard(spark, sf)),
        ["segment_dimension", "segment_value"],
        "activation_rate_7d",
    )


def calculated_fields(spark, sf):
    return sm.calculated_fields(_product_bi(spark, sf))


def calculated_fields_by_week(spark, sf):
    return sm.calculated_fields(_commerce_bi(spark, sf), ["signup_week"])


def headline(spark, sf):
    return rounded(sm.headline(sm.dashboard_variant_summary(_product_dashboard(spark, sf))), ["activation_lift_pp"])


def filtered_variant_summary(spark, sf):
    """The variant summary behind the dashboard's date, device and country filters."""
    kept = sm.filtered(
        _product_bi(spark, sf),
        signup_from="2024-01-01",
        signup_to="2024-01-03",
        device=["ios", "web"],
        country=["US", "CA", "GB"],
    )
    return rounded(sm.variant_summary(kept), _LATENCY)


def filtered_variant_summary_stored(spark, sf):
    """The same filters over the user-level table stored by signup day: only the folders of three days are read."""
    path = scratch_path(spark, "user-level")
    user_level.write_user_level(_product_bi(spark, sf), path)
    kept = sm.filtered(
        user_level.read_user_level(spark, path),
        signup_from="2024-01-01",
        signup_to="2024-01-03",
        device=["ios", "web"],
        country=["US", "CA", "GB"],
    )
    return rounded(sm.variant_summary(kept), _LATENCY)


# --- statistics ---------------------------------------------------------------------------------

_TEST_DOUBLES = ["control_mean", "treatment_mean", "effect_abs", "effect_rel", "p_value"]


def arm_moments(spark, sf):
    return rounded(moments.arm_moments(_commerce_metrics(spark, sf)), ["mean", "variance"], 4)


def arm_moments_from_buckets(spark, sf):
    """The same moments merged from the bucket cells the bootstrap uses."""
    df, boot = _commerce_metrics(spark, sf), COMMERCE.bootstrap
    parts = moments.arm_parts(df, moments.bucket_cells(df, METRICS, boot), METRICS, boot)
    return rounded(moments.moments_from_parts(parts), ["mean", "variance"], 4)


def difference_tests(spark, sf):
    tests = ab_tests.difference_tests(moments.arm_moments(_commerce_metrics(spark, sf)))
    return rounded(tests, [*_TEST_DOUBLES, "standard_error"])


def bootstrap_intervals(spark, sf):
    return rounded(
        bootstrap.bootstrap_difference(_commerce_metrics(spark, sf), boot=COMMERCE.bootstrap), ["ci_low", "ci_high"]
    )


def bootstrap_intervals_per_user(spark, sf):
    """Every user is its own resampling unit: exact, and the work grows with users x replicates."""
    boot = replace(COMMERCE.bootstrap, buckets=None)
    return rounded(bootstrap.bootstrap_difference(_commerce_metrics(spark, sf), boot=boot), ["ci_low", "ci_high"])


def exact_resample_totals(spark, sf):
    """Draws per metric and arm when each replicate draws as many users as there are: the least and the most of all replicates."""
    sums = exact_bootstrap.exact_sums(_commerce_metrics(spark, sf), boot=COMMERCE.bootstrap)
    return sums.groupBy("metric", "assigned_variant").agg(
        F.count(F.lit(1)).alias("replicates"), F.min("n").alias("least_draws"), F.max("n").alias("most_draws")
    )


def bootstrap_intervals_exact(spark, sf):
    """Intervals from n draws with replacement per arm. Its random numbers have no SQL; the tests compare it with plain resampling."""
    return rounded(exact_bootstrap.exact_intervals(_commerce_metrics(spark, sf), boot=COMMERCE.bootstrap), ["ci_low", "ci_high"])


def order_q_values(spark, sf):
    """One family of as many tests as there are orders: an order's p-value is its price as a share of a million."""
    tests = raw_table(spark, sf, "orders").select("o_orderkey", F.round(F.col("o_totalprice") / 1e6, 9).alias("p_value"))
    return rounded(multiple_testing.benjamini_hochberg_large(tests, ["o_orderkey"]), ["p_value_fdr"], 9)


def _results(spark, sf):
    return ab_tests.ab_result_table(_commerce_metrics(spark, sf), boot=COMMERCE.bootstrap)


def ab_results(spark, sf):
    return rounded(_results(spark, sf), [*_TEST_DOUBLES, "ci_low", "ci_high"])


def ab_results_with_fdr(spark, sf):
    tests = ab_tests.difference_tests(moments.arm_moments(_commerce_metrics(spark, sf)))
    return rounded(
        multiple_testing.with_metric_fdr(tests).select(
            "metric", "effect_abs", "p_value", "p_value_fdr", "significant_fdr_05"
        ),
        ["effect_abs", "p_value", "p_value_fdr"],
    )


def segment_q_values(spark, sf):
    """Benjamini-Hochberg within each dimension, over every segment and metric."""
    df = _commerce_metrics(spark, sf)
    groups = ["segment_dimension", "segment_value"]
    dimensions = ["acquisition_channel", "device", "age_bucket"]
    long = df.select(
        "user_id", "assigned_variant", *[F.col(m).cast("double").alias(m) for m in METRICS], *dimensions
    ).unpivot(["user_id", "assigned_variant", *METRICS], dimensions, *groups)
    tests = ab_tests.difference_tests(moments.arm_moments(long, METRICS, groups), groups)
    adjusted = multiple_testing.benjamini_hochberg(tests, ["segment_value", "metric"], ["segment_dimension"])
    return rounded(adjusted.select(*groups, "metric", "p_value", "p_value_fdr"), ["p_value", "p_value_fdr"])


_SEGMENT_DOUBLES = ["control_mean", "treatment_mean", "effect_abs", "ci_low", "ci_high", "p_value", "p_value_fdr"]


def segment_tests(spark, sf):
    return rounded(ab_tests.segment_tests(_commerce_metrics(spark, sf), exp=COMMERCE), _SEGMENT_DOUBLES)


def segment_tests_high_gate(spark, sf):
    """The standard gate of 200 users per arm."""
    exp = replace(COMMERCE, min_segment_arm=200)
    return rounded(ab_tests.segment_tests(_commerce_metrics(spark, sf), exp=exp), _SEGMENT_DOUBLES)


def cuped_adjusted(spark, sf):
    """Row level: each user's adjusted activation with early orders as the covariate."""
    users = _commerce_sessions_metrics(spark, sf).select(
        "user_id", "assigned_variant", "activated_within_7d", "pre_treatment_sessions_30d"
    )
    return rounded(
        cuped.cuped_adjusted(users, "activated_within_7d", "pre_treatment_sessions_30d"), ["cuped_outcome"]
    )


def _cuped_rounded(df):
    df = rounded(df, [c for c in df.columns if c not in ("metric", "theta")])
    return rounded(df, ["theta"], 12)


def cuped_results(spark, sf):
    return _cuped_rounded(
        cuped.cuped_table(_commerce_metrics(spark, sf), COMMERCE.covariate, boot=COMMERCE.bootstrap)
    )


def cuped_results_sessions(spark, sf):
    return _cuped_rounded(
        cuped.cuped_table(
            _commerce_sessions_metrics(spark, sf),
            "pre_treatment_sessions_30d",
            CUPED_METRICS,
            COMMERCE.bootstrap,
        )
    )


def _segment_rates(spark, sf):
    rates = sm.segment_activation(_commerce_dashboard(spark, sf))
    return rates.groupBy("segment_dimension", "segment_value").agg(
        F.max(F.when(F.col("assigned_variant") == "control", F.col("activation_rate_7d"))).alias("control_mean"),
        F.coalesce(F.max(F.when(F.col("assigned_variant") == "control", F.col("users"))), F.lit(0)).alias("n_control"),
        F.coalesce(F.max(F.when(F.col("assigned_variant") == "treatment", F.col("users"))), F.lit(0)).alias(
            "n_treatment"
        ),
    )


def required_sample_sizes(spark, sf):
    """Users per arm to detect lifts of 1 and 3 points over each segment's baseline."""
    return _segment_rates(spark, sf).select(
        "segment_dimension",
        "segment_value",
        power.required_n(F.col("control_mean"), F.lit(0.01)).alias("n_for_1pp"),
        power.required_n(F.col("control_mean"), F.lit(0.03)).alias("n_for_3pp"),
    )


def detectable_lifts(spark, sf):
    """Smallest detectable lift per segment, from its baseline and its smaller arm."""
    lift = power.detectable_lift(F.col("control_mean"), F.col("n_control"), F.col("n_treatment"))
    return rounded(
        _segment_rates(spark, sf).select("segment_dimension", "segment_value", lift.alias("observed_mde_abs")),
        ["observed_mde_abs"],
        9,
    )


def power_table(spark, sf):
    tests = ab_tests.difference_tests(moments.arm_moments(_commerce_metrics(spark, sf)))
    return rounded(power.power_table(tests, power=COMMERCE.power), ["baseline_rate_control", "observed_mde_abs"], 9)


# --- decisions ----------------------------------------------------------------------------------


def _tests(spark, sf):
    return ab_tests.difference_tests(moments.arm_moments(_commerce_metrics(spark, sf)))


def guardrail_regressions(spark, sf):
    return rounded(decisions.guardrail_regressions(_tests(spark, sf)), ["effect_abs", "p_value"])


def decision_by_pvalue(spark, sf):
    return decisions.decision_by_pvalue(_tests(spark, sf))


def _by_outcome(spark, sf, rule: str) -> DataFrame:
    """Users whose arm follows from their outcomes, so that effects are there to find."""
    return _commerce_metrics(spark, sf).withColumn("assigned_variant", F.expr(f"IF({rule}, 'treatment', 'control')"))


def _tests_by_outcome(spark, sf, rule: str) -> DataFrame:
    return ab_tests.difference_tests(moments.arm_moments(_by_outcome(spark, sf, rule)))


def guardrail_regressions_found(spark, sf):
    found = decisions.guardrail_regressions(_tests_by_outcome(spark, sf, COSTLY_ARM))
    return rounded(found, ["effect_abs", "p_value"])


def decision_by_pvalue_costly(spark, sf):
    return decisions.decision_by_pvalue(_tests_by_outcome(spark, sf, COSTLY_ARM))


def decision_by_pvalue_winning(spark, sf):
    return decisions.decision_by_pvalue(_tests_by_outcome(spark, sf, WINNING_ARM))


def strongest_segment_found(spark, sf):
    """The strongest segment under the rule of the experiment, on arms that differ."""
    segments = ab_tests.segment_tests(_by_outcome(spark, sf, WINNING_ARM), exp=COMMERCE)
    return rounded(decisions.strongest_segment(segments), _SEGMENT_DOUBLES)


def decision_by_tolerance(spark, sf):
    decision = decisions.decision_by_tolerance(sm.dashboard_variant_summary(_product_dashboard(spark, sf)))
    return rounded(
        decision,
        ["activation_lift_pp", "cancellation_delta_pp", "match_latency_delta_hours", "support_ticket_delta"],
    )


def _tolerance_by_outcome(spark, sf, rule: str) -> DataFrame:
    users = _commerce_dashboard(spark, sf).withColumn("assigned_variant", F.expr(f"IF({rule}, 'treatment', 'control')"))
    decision = decisions.decision_by_tolerance(sm.dashboard_variant_summary(users))
    return rounded(
        decision,
        ["activation_lift_pp", "cancellation_delta_pp", "match_latency_delta_hours", "support_ticket_delta"],
    )


def decision_by_tolerance_costly(spark, sf):
    """Arms by outcome, so that activation improves and guardrails suffer."""
    return _tolerance_by_outcome(spark, sf, COSTLY_ARM)


def decision_by_tolerance_winning(spark, sf):
    """Arms by outcome, so that activation improves and no guardrail suffers."""
    return _tolerance_by_outcome(spark, sf, HARMLESS_ARM)


def kpi_snapshot(spark, sf):
    results = _results(spark, sf)
    table = cuped.cuped_table(_commerce_metrics(spark, sf), COMMERCE.covariate, boot=COMMERCE.bootstrap)
    snapshot = decisions.kpi_snapshot(results, power.power_table(_tests(spark, sf), power=COMMERCE.power), table)
    return rounded(snapshot, [c for c in snapshot.columns if c != "primary_metric"])


def strongest_segment(spark, sf):
    """Among significant segments; a level of 1 keeps the top segment visible on data without effects."""
    exp = replace(COMMERCE, significance=1.0)
    return rounded(
        decisions.strongest_segment(ab_tests.segment_tests(_commerce_metrics(spark, sf), exp=exp)), _SEGMENT_DOUBLES
    )


def labelled_results(spark, sf):
    labelled = decisions.labelled(_tests(spark, sf), decisions.metric_dictionary(spark))
    return rounded(
        labelled.select("metric", "business_metric", "category", "desired_direction", "effect_abs", "p_value"),
        ["effect_abs", "p_value"],
    )


QUERIES: list[Query] = [
    users_through_csv,
    users_through_stored_upsert,
    one_row_batch_folders,
    batch_constraint_violations,
    metrics_after_three_batches,
    required_inputs,
    events_through_parquet,
    input_row_counts,
    analysis_input,
    view_layer_segment_summary,
    view_layer_row_counts,
    upsert_latest_orders,
    upsert_keeps_absent_columns,
    null_violations,
    primary_key_violations,
    foreign_key_violations,
    domain_violations,
    volume_gates,
    null_assignment_gate,
    allocation_gate,
    activation_gate,
    quality_gates,
    quality_summary,
    labelled_quality_summary,
    duplicate_event_rate,
    events_deduped,
    distinct_event_keys,
    first_times,
    first_times_pivot,
    sessions_from_events,
    events_with_signup,
    json_properties,
    activation_user_level,
    retention_user_level,
    support_user_level,
    cancellation_user_level,
    match_latency_user_level,
    guardrails_user_level,
    experiment_user_metrics,
    experiment_user_metrics_commerce,
    dashboard_user_level,
    bi_user_level,
    funnel_step_rates,
    retention_rates,
    guardrail_rates,
    variant_summary,
    variant_summary_commerce,
    segment_summary,
    dashboard_variant_summary,
    labelled_variant_summary,
    variant_rate_texts,
    lift_table,
    funnel_long,
    ordered_funnel,
    daily_metrics,
    daily_activation,
    segment_metrics,
    segment_activation,
    labelled_segments,
    funnel_by_arm,
    daily_activation_by_arm,
    segment_activation_by_arm,
    calculated_fields,
    calculated_fields_by_week,
    headline,
    filtered_variant_summary,
    filtered_variant_summary_stored,
    arm_moments,
    arm_moments_from_buckets,
    difference_tests,
    bootstrap_intervals,
    bootstrap_intervals_per_user,
    exact_resample_totals,
    bootstrap_intervals_exact,
    order_q_values,
    spoiled_null_violations,
    spoiled_primary_key_violations,
    spoiled_foreign_key_violations,
    spoiled_domain_violations,
    spoiled_gates,
    spoiled_cancellation_user_level,
    guardrail_regressions_found,
    decision_by_pvalue_costly,
    decision_by_pvalue_winning,
    strongest_segment_found,
    ab_results,
    ab_results_with_fdr,
    segment_q_values,
    segment_tests,
    segment_tests_high_gate,
    cuped_adjusted,
    cuped_results,
    cuped_results_sessions,
    required_sample_sizes,
    detectable_lifts,
    power_table,
    guardrail_regressions,
    decision_by_pvalue,
    decision_by_tolerance,
    decision_by_tolerance_costly,
    decision_by_tolerance_winning,
    kpi_snapshot,
    strongest_segment,
    labelled_results,
]


def queries() -> dict[str, Query]:
    return {q.__name__: q for q in QUERIES}


def activation_by_arm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship question: what share of each arm activated?"""
    t = product_tables(spark, sf_dir)
    users = um.activation_user_level(t["dim_users"], t["fact_events"], PRODUCT)
    return sm.funnel_step_rates(users).select("assigned_variant", "users", "activation_rate_7d")
