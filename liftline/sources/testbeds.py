"""Warehouse-shaped tables derived with Spark from two raw sources.

``product_tables`` reads a click log (``events``); ``commerce_tables`` reads customers and their
orders. Both give the seven warehouse tables, so every operator can run on data it did not choose.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from liftline.operators.events import sessions_from_events
from liftline.operators.user_metrics import count_after_signup
from liftline.params import CONTROL, TREATMENT, Experiment, Windows

# Columns read from the raw sources.
RAW_SCHEMAS = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "customer": "c_custkey BIGINT, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "nation": "n_nationkey INT, n_name STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
}


def raw_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(RAW_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


class LazyTables(Mapping):
    """Tables by name, each planned when it is first asked for."""

    def __init__(self, builders: dict[str, Callable[[], DataFrame]]):
        self._builders, self._built = builders, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self):
        return iter(self._builders)

    def __len__(self):
        return len(self._builders)


# Outcome windows that give neither 0 nor 1 on the two sources.
PRODUCT = Experiment(
    windows=Windows(activation=2, retention_short=28, retention_long=29, tickets=10, cancellation=10)
)
COMMERCE = Experiment(
    windows=Windows(activation=730, retention_short=1460, retention_long=1825, tickets=365, cancellation=365),
    min_segment_arm=140,
)


def _pick(number: Column, labels: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in labels]), (number % len(labels) + 1).cast("int"))


def _arms(user_id: Column) -> tuple[Column, Column]:
    assigned = F.when(user_id % 2 == 0, CONTROL).otherwise(TREATMENT)
    other = F.when(user_id % 2 == 0, TREATMENT).otherwise(CONTROL)
    return assigned, F.when(user_id % 11 == 0, other).otherwise(assigned)


def _half(user_id: Column) -> Column:
    return F.floor(user_id / 2)


def _sessions(events: DataFrame, users: DataFrame) -> DataFrame:
    """Sessions of known users, with their device."""
    return sessions_from_events(events, users).where("device IS NOT NULL")


def _tables(users, sessions, events, subscriptions, cancellations, tickets, matches) -> LazyTables:
    return LazyTables(
        {
            "dim_users": users,
            "fact_sessions": sessions,
            "fact_events": events,
            "fact_subscriptions": subscriptions,
            "fact_cancellations": cancellations,
            "fact_support_tickets": tickets,
            "fact_matches": matches,
        }
    )


def product_tables(spark: SparkSession, sf_dir: str, hourly: bool = False) -> Mapping[str, DataFrame]:
    """Tables from the click log. ``hourly`` cuts event times to the hour, which creates duplicates."""
    raw = raw_table(spark, sf_dir, "events")
    uid, kind = F.col("user_id"), F.col("event_type")

    @cache
    def users() -> DataFrame:
        assigned, exposed = _arms(uid)
        profile = raw.groupBy("user_id").agg(
            F.min("ts").alias("signup_ts"),
            F.expr("CAST(count_if(event_type = 'signup') AS DOUBLE) AS baseline_score"),
            F.expr("count_if(event_type = 'signup' AND value < 50) AS pre_treatment_sessions_30d"),
        )
        return profile.select(
            "user_id",
            "signup_ts",
            _pick(_half(uid), ["US", "CA", "GB", "IN", "AU"]).alias("country"),
            _pick(uid, ["ios", "ios", "android", "android", "web"]).alias("device"),
            _pick(uid, ["organic", "paid", "referral"]).alias("acquisition_channel"),
            _pick(_half(uid), ["18-24", "25-34", "35-44", "45+"]).alias("age_bucket"),
            "baseline_score",
            assigned.alias("assigned_variant"),
            exposed.alias("actually_exposed_variant"),
            "pre_treatment_sessions_30d",
            F.col("signup_ts").alias("created_at"),
        )

    @cache
    def events() -> DataFrame:
        names = (
            F.when(kind == "view", F.array(F.lit("app_open"), F.lit("onboarding_started")))
            .when(kind == "click", F.array(F.lit("onboarding_completed")))
            .when(kind == "purchase", F.array(F.lit("session_booked")))
            .otherwise(F.array(kind))
        )
        time = "ts - make_dt_interval(0, 0, minute(ts), extract(second FROM ts))" if hourly else "ts"
        return raw.select("*", F.posexplode(names).alias("_copy", "event_name")).select(
            F.expr("concat_ws('_', 'evt', event_id, _copy) AS event_id"),
            "user_id",
            F.expr(f"{time} AS event_ts"),
            "event_name",
            F.expr(
                "CASE WHEN event_id % 97 <> 0 THEN user_id * 1000 + datediff(ts, DATE'2024-01-01') END AS session_id"
            ),
            F.expr("CASE WHEN event_id % 50 = 0 THEN 'null' ELSE props END AS properties_json"),
        )

    def sessions() -> DataFrame:
        return _sessions(events(), users())

    def subscriptions() -> DataFrame:
        return (
            raw.where(kind == "purchase")
            .groupBy("user_id")
            .agg(
                F.min("ts").alias("subscribed_ts"),
                F.expr("CASE WHEN count(*) >= 12 THEN 'annual' ELSE 'monthly' END AS plan_type"),
                F.expr("CAST(min(value) AS DECIMAL(10, 2)) AS price_monthly"),
            )
        )

    def cancellations() -> DataFrame:
        return (
            raw.where("event_type = 'error' AND value >= 100")
            .groupBy("user_id")
            .agg(F.min("ts").alias("cancelled_ts"), F.lit("price").alias("reason"))
        )

    def tickets() -> DataFrame:
        return raw.where(kind == "error").select(
            F.col("event_id").alias("ticket_id"),
            "user_id",
            F.col("ts").alias("created_ts"),
            F.expr("CASE WHEN value >= 50 THEN 'billing' ELSE 'technical' END AS category"),
        )

    def matches() -> DataFrame:
        firsts = raw.where(kind == "click").groupBy("user_id").agg(F.min("ts").alias("matched_ts"))
        return firsts.withColumn("therapist_id", uid % 50)

    return _tables(users, sessions, events, subscriptions, cancellations, tickets, matches)


def commerce_tables(spark: SparkSession, sf_dir: str) -> Mapping[str, DataFrame]:
    """Tables from customers with orders; a customer without orders never signed up."""
    orders = raw_table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderdate").alias("ts"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_totalprice").alias("price"),
    )
    uid = F.col("user_id")

    @cache
    def users() -> DataFrame:
        assigned, exposed = _arms(uid)
        signups = orders.groupBy("user_id").agg(F.min("ts").alias("signup_ts"))
        early = count_after_signup(signups, orders, "ts", 365, "pre_treatment_sessions_30d")
        return (
            raw_table(spark, sf_dir, "customer")
            .withColumnRenamed("c_custkey", "user_id")
            .join(signups, "user_id")
            .join(early, "user_id", "left")
            .join(raw_table(spark, sf_dir, "nation"), F.expr("c_nationkey = n_nationkey"))
            .select(
                "user_id",
                "signup_ts",
                F.col("n_name").alias("country"),
                _pick(uid, ["ios", "ios", "android", "android", "web"]).alias("device"),
                F.col("c_mktsegment").alias("acquisition_channel"),
                _pick(_half(uid), ["18-24", "25-34", "35-44", "45+"]).alias("age_bucket"),
                F.expr("round(c_acctbal * 100) AS baseline_score"),
                assigned.alias("assigned_variant"),
                exposed.alias("actually_exposed_variant"),
                "pre_treatment_sessions_30d",
                F.col("signup_ts").alias("created_at"),
            )
        )

    @cache
    def events() -> DataFrame:
        return orders.select(
            F.expr("concat_ws('_', 'ord', order_id) AS event_id"),
            "user_id",
            F.col("ts").alias("event_ts"),
            F.expr(
                "CASE status WHEN 'P' THEN 'onboarding_completed' WHEN 'F' THEN 'session_booked' "
                "WHEN 'O' THEN 'app_open' ELSE status END AS event_name"
            ),
            F.expr("user_id * 10000 + year(ts) AS session_id"),
            F.lit(None).cast("string").alias("properties_json"),
        )

    def sessions() -> DataFrame:
        return _sessions(events(), users())

    def subscriptions() -> DataFrame:
        return orders.groupBy("user_id").agg(
            F.min("ts").alias("subscribed_ts"),
            F.expr("CASE WHEN count(*) >= 10 THEN 'annual' ELSE 'monthly' END AS plan_type"),
            F.expr("CAST(min(price) AS DECIMAL(10, 2)) AS price_monthly"),
        )

    def first_order(rank: str, name: str) -> DataFrame:
        return orders.where(F.col("priority") == rank).groupBy("user_id").agg(F.min("ts").alias(name))

    def cancellations() -> DataFrame:
        return first_order("5-LOW", "cancelled_ts").withColumn("reason", F.lit("price"))

    def tickets() -> DataFrame:
        return orders.where(F.col("priority") == "1-URGENT").select(
            F.col("order_id").alias("ticket_id"),
            "user_id",
            F.col("ts").alias("created_ts"),
            F.lit("order").alias("category"),
        )

    def matches() -> DataFrame:
        return first_order("2-HIGH", "matched_ts").withColumn("therapist_id", uid % 50)

    return _tables(users, sessions, events, subscriptions, cancellations, tickets, matches)
