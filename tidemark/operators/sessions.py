"""Sessions: a user's events with no gap above the rule's."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import model as M

#: Microseconds in a stretch of time: a user's events are first grouped within stretches, in parallel.
STRETCH = 86_400_000_000


def _numbered(rows: DataFrame, keys: list[str], start: str, end: str, tie: str, gap: int) -> DataFrame:
    """Adds _session: counts the gaps above `gap` microseconds, in order of `start` and `tie`."""
    order = Window.partitionBy(*keys).orderBy(start, tie)
    before = F.lag(end).over(order)
    opens = F.when(before.isNull() | (F.unix_micros(start) - F.unix_micros(before) > gap), 1).otherwise(0)
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn("_opens", opens).withColumn("_session", F.sum("_opens").over(running))


def _id() -> Column:
    return F.sha2(F.concat_ws(":", "user_token", F.col("started_at").cast("string"), "first_event_id"), 256)


def _named(sessions: DataFrame) -> DataFrame:
    return sessions.select(
        _id().alias("session_id"), "user_token", "started_at", "ended_at", "event_count", "first_event_id", "last_event_id"
    )


def sessionize(events: DataFrame, rules: M.Rules = M.Rules(), stretch: int = STRETCH) -> DataFrame:
    """Sessions of the events with consent, ordered by (event_time, event_id); a gap of exactly the rule's joins.

    First within each user's stretches of time, then over the stretches' sessions: a user with a large share of
    the events doesn't end up in one task, and the second step has a row per session, not per event.
    """
    gap = rules.session_gap_minutes * 60_000_000
    eligible = events.where("consent_state = 'analytics_allowed'").select("user_token", "event_time", "event_id")
    eligible = eligible.withColumn("_stretch", F.floor(F.unix_micros("event_time") / stretch))
    keys = ["user_token", "_stretch"]
    at = F.struct("event_time", "event_id")
    local = (
        _numbered(eligible, keys, "event_time", "event_time", "event_id", gap)
        .groupBy(*keys, "_session")
        .agg(
            F.min("event_time").alias("started_at"),
            F.max("event_time").alias("ended_at"),
            F.count(F.lit(1)).alias("event_count"),
            F.min_by("event_id", at).alias("first_event_id"),
            F.max_by("event_id", at).alias("last_event_id"),
        )
        .drop("_session")
    )
    joined = (
        _numbered(local, ["user_token"], "started_at", "ended_at", "first_event_id", gap)
        .groupBy("user_token", "_session")
        .agg(
            F.min("started_at").alias("_start"),
            F.max("ended_at").alias("_end"),
            F.sum("event_count").alias("event_count"),
            F.min_by("first_event_id", F.struct("started_at", "first_event_id")).alias("_first"),
            F.max_by("last_event_id", F.struct("ended_at", "last_event_id")).alias("_last"),
        )
        .select(
            "user_token", F.col("_start").alias("started_at"), F.col("_end").alias("ended_at"), "event_count",
            F.col("_first").alias("first_event_id"), F.col("_last").alias("last_event_id"),
        )
    )
    return _named(joined)


def sessionize_by_window(events: DataFrame, rules: M.Rules = M.Rules()) -> DataFrame:
    """The same by Spark's session_window; the form that a stream can use."""
    at = F.struct("event_time", "event_id")
    found = (
        events.where("consent_state = 'analytics_allowed'")
        .groupBy("user_token", F.session_window("event_time", f"{rules.session_gap_minutes} minutes"))
        .agg(
            F.min("event_time").alias("started_at"),
            F.max("event_time").alias("ended_at"),
            F.count(F.lit(1)).alias("event_count"),
            F.min_by("event_id", at).alias("first_event_id"),
            F.max_by("event_id", at).alias("last_event_id"),
        )
    )
    return _named(found)
