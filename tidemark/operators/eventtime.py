"""Lateness against a running maximum per partition, frontiers and gaps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark import model as M

#: Offsets in a bucket: a partition's running maximum is worked out bucket by bucket, in parallel.
BUCKET = 1 << 20


def watermarks(events: DataFrame) -> DataFrame:
    """The largest event time of each partition, as prior_max_event_time."""
    return events.groupBy("kafka_partition").agg(F.max("event_time").alias("prior_max_event_time"))


def classify_lateness(
    events: DataFrame,
    rules: M.Rules = M.Rules(),
    prior: DataFrame | None = None,
    per_source: DataFrame | None = None,
    bucket: int = BUCKET,
) -> DataFrame:
    """Adds beyond_watermark: the event lies more than the watermark before an earlier offset's largest time.

    Two levels: the largest time of each bucket of offsets, running over the buckets of a partition, and
    then row by row within the bucket. So one partition's rows spread over many tasks. `prior` (watermarks()
    of what came before) and `per_source` (source_id, lateness_minutes) are small.
    """
    rows = events.withColumn("_bucket", F.floor(F.col("kafka_offset") / bucket))
    by_partition = Window.partitionBy("kafka_partition").orderBy("_bucket")
    before = Window.unboundedPreceding, -1
    buckets = (
        rows.groupBy("kafka_partition", "_bucket")
        .agg(F.max("event_time").alias("_top"))
        .withColumn("_before", F.max("_top").over(by_partition.rowsBetween(*before)))
        .select("kafka_partition", "_bucket", "_before")
    )
    within = Window.partitionBy("kafka_partition", "_bucket").orderBy("kafka_offset").rowsBetween(*before)
    found = rows.join(buckets, ["kafka_partition", "_bucket"]).withColumn(
        "_seen", F.greatest(F.max("event_time").over(within), "_before")
    )
    if prior is not None:
        found = found.join(F.broadcast(prior), "kafka_partition", "left")
        found = found.withColumn("_seen", F.greatest("_seen", "prior_max_event_time"))
    minutes = F.lit(rules.live_watermark_minutes)
    if per_source is not None:
        limits = per_source.select("source_id", F.col("lateness_minutes").alias("_minutes"))
        found = found.join(F.broadcast(limits), "source_id", "left")
        minutes = F.coalesce("_minutes", minutes)
    allowed = minutes.cast("long") * 60_000_000
    late = F.unix_micros("event_time") < F.unix_micros("_seen") - allowed
    return found.withColumn("beyond_watermark", F.coalesce(late, F.lit(False))).select(
        *events.columns, "beyond_watermark"
    )


def frontier(events: DataFrame) -> DataFrame:
    """First and last offset, rows and largest time of each partition."""
    return events.groupBy("kafka_partition").agg(
        F.min("kafka_offset").alias("start_offset"),
        F.max("kafka_offset").alias("end_offset"),
        F.count(F.lit(1)).alias("row_count"),
        F.max("event_time").alias("max_event_time"),
    )


def offset_gaps(events: DataFrame) -> DataFrame:
    """Per partition the offsets missing between its first and last, and the offsets that repeat."""
    known = events.groupBy("kafka_partition").agg(
        F.min("kafka_offset").alias("first"),
        F.max("kafka_offset").alias("last"),
        F.count_distinct("kafka_offset").alias("different"),
        F.count(F.lit(1)).alias("n"),
    )
    return known.select(
        "kafka_partition",
        (F.col("last") - F.col("first") + 1 - F.col("different")).alias("missing"),
        (F.col("n") - F.col("different")).alias("repeated"),
    )
