"""Daily engagement, marts and data tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def sessions_per_day(sessions: DataFrame) -> DataFrame:
    return sessions.groupBy(F.to_date("started_at").alias("event_date")).agg(
        F.count(F.lit(1)).alias("sessions_started_on_date")
    )


def daily_engagement(events: DataFrame, sessions: DataFrame) -> DataFrame:
    """Events, exact users and sessions started per (date, type), of the events with consent.

    The session counts have a row per day, so they are broadcast.
    """
    daily = (
        events.where("consent_state = 'analytics_allowed'")
        .groupBy(F.to_date("event_time").alias("event_date"), "event_type")
        .agg(F.count("event_id").alias("event_count"), F.count_distinct("user_token").alias("unique_users"))
    )
    return (
        daily.join(F.broadcast(sessions_per_day(sessions)), "event_date", "left")
        .withColumn("sessions_started_on_date", F.coalesce("sessions_started_on_date", F.lit(0).cast("long")))
    )


STAGED = (
    "event_id", "source_id", "user_token", "event_type", "event_time", "arrival_time", "consent_state", "page_id",
    "campaign_id",
)


def staged(curated: DataFrame) -> DataFrame:
    """The curated events with consent, as the mart reads them."""
    return curated.where("consent_state = 'analytics_allowed'").select(*STAGED)


def mart_daily(staging: DataFrame) -> DataFrame:
    return staging.groupBy(F.to_date("event_time").alias("event_date"), "event_type").agg(
        F.count(F.lit(1)).alias("event_count"),
        F.count_distinct("user_token").alias("unique_users"),
        F.max("arrival_time").alias("data_fresh_through"),
    )


def mart_incremental(staging: DataFrame, existing: DataFrame, lookback_days: int = 3) -> DataFrame:
    """The mart after a run that reads the events since lookback_days before its last date.

    Dates and types that the run touches are replaced, others stay. The last date is read first, as one value, so
    that the filter reaches the scan.
    """
    last = existing.agg(F.coalesce(F.max("event_date"), F.lit("1900-01-01").cast("date"))).first()[0]
    since = F.date_sub(F.lit(last), lookback_days).cast("timestamp")
    fresh = mart_daily(staging.where(F.col("event_time") >= since))
    return existing.join(fresh.select("event_date", "event_type"), ["event_date", "event_type"], "left_anti").unionByName(fresh)


def windowed_counts(events: DataFrame, size: str, slide: str | None = None) -> DataFrame:
    """Events per type and window of time: tumbling ones, or sliding ones that overlap."""
    window = F.window("event_time", size, slide or size)
    counted = events.groupBy("event_type", window.alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return counted.select("event_type", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def places(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Adds place, from 1 on: each row's place within its key, in order. A key with many rows spreads over many tasks.

    The rows are cut by ranges of (key, order); a row's place is the one within its range and the rows of its
    key in the ranges before. Rows alike in all of these share a range and get places one after the other.
    """
    cut = rows.repartitionByRange(key, *order).withColumn("_range", F.spark_partition_id())
    sizes = cut.groupBy(key, "_range").agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.partitionBy(key).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(F.col(key).alias("_key"), F.col("_range").alias("_at"), F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"))
    within = Window.partitionBy(key, "_range").orderBy(*order)
    met = cut.join(F.broadcast(starts), cut[key].eqNullSafe(F.col("_key")) & (cut["_range"] == F.col("_at")))
    return met.withColumn("place", F.col("_before") + F.row_number().over(within)).select(*rows.columns, "place")


def dq_not_null(table: DataFrame, columns: list[str]) -> DataFrame:
    """Per column the rows without a value, in one pass."""
    counted = table.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.unpivot([], columns, "column_name", "null_rows")


def dq_unique(table: DataFrame, column: str) -> DataFrame:
    """Values of the column that occur more than once."""
    return table.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n")).where("n > 1 and value is not null")
