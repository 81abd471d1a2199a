"""Event shaping: deduplication, first times, sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from liftline.params import EventNames

EVENT_KEY = ["user_id", "event_name", "event_ts"]


def deduped_events(events: DataFrame) -> DataFrame:
    """One row per (user, name, time): the one with the lowest event id as text.

    Spark keeps only the first row of each group on the map side as well, so a group that holds a
    large share of the table is cut down before the shuffle.
    """
    first = Window.partitionBy(*EVENT_KEY).orderBy("event_id")
    return (
        events.withColumn("_rank", F.row_number().over(first))
        .where(F.col("_rank") == 1)
        .select("event_id", "user_id", "event_ts", "event_name", "session_id", "properties_json")
    )


def distinct_event_keys(events: DataFrame) -> DataFrame:
    """The logical events alone, when it does not matter which copy survives."""
    return events.select(*EVENT_KEY).dropDuplicates(EVENT_KEY)


def first_times(events: DataFrame, names: EventNames = EventNames()) -> DataFrame:
    """First time of each funnel event, one row per user with any event."""

    def first(name: str, alias: str):
        return F.min(F.when(F.col("event_name") == name, F.col("event_ts"))).alias(alias)

    return events.groupBy("user_id").agg(
        first(names.started, "onboarding_started_ts"),
        first(names.completed, "onboarding_completed_ts"),
        first(names.booked, "first_booking_ts"),
    )


def first_times_pivot(events: DataFrame, names: EventNames = EventNames()) -> DataFrame:
    """The same by pivot, one row per user with a funnel event; absent names give NULL columns."""
    steps = [names.started, names.completed, names.booked]
    wide = (
        events.where(F.col("event_name").isin(*steps))
        .groupBy("user_id")
        .pivot("event_name", steps)
        .agg(F.min("event_ts"))
    )
    return wide.select(
        "user_id",
        F.col(names.started).alias("onboarding_started_ts"),
        F.col(names.completed).alias("onboarding_completed_ts"),
        F.col(names.booked).alias("session_booked_ts"),
    )


def milestones(events: DataFrame, names: EventNames = EventNames()) -> DataFrame:
    """All a user's outcomes need from the event log, in one partial-and-final aggregate.

    First times and the last app open do not change when an event is repeated, so the raw log
    serves as well as the deduplicated one.
    """

    def at(name: str):
        return F.when(F.col("event_name") == name, F.col("event_ts"))

    return (
        events.where(F.col("event_name").isin(*names.all))
        .groupBy("user_id")
        .agg(
            F.min(at(names.started)).alias("onboarding_started_ts"),
            F.min(at(names.completed)).alias("onboarding_completed_ts"),
            F.min(at(names.booked)).alias("first_booking_ts"),
            F.max(at(names.opened)).alias("last_open_ts"),
        )
    )


def sessions_from_events(events: DataFrame, users: DataFrame) -> DataFrame:
    """Sessions as the span of their events, with the user's device."""
    spans = (
        events.where(F.col("session_id").isNotNull())
        .groupBy("session_id", "user_id")
        .agg(F.min("event_ts").alias("session_start_ts"), F.max("event_ts").alias("session_end_ts"))
    )
    return spans.join(users.select("user_id", "device"), "user_id", "left").select(
        "session_id", "user_id", "session_start_ts", "session_end_ts", "device"
    )


def events_with_signup(events: DataFrame, users: DataFrame) -> DataFrame:
    """Events of known users next to their signup time and arm."""
    return events.join(
        users.select("user_id", "signup_ts", "assigned_variant"), "user_id", "inner"
    ).select("event_id", "user_id", "event_name", "event_ts", "signup_ts", "assigned_variant")
