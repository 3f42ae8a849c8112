"""Identity: the first arrival of an event id is the event; others are duplicates or conflicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fields that make an event what it is; its arrival doesn't.
FIELDS = (
    "schema_version", "event_id", "source_id", "user_token", "event_type", "event_time", "consent_state", "page_id",
    "campaign_id",
)


def fingerprint() -> Column:
    """SHA-256 over the fields, times as microseconds; an absent field is the same as a null one.

    Each value comes after its number of bytes, a null one is a dash: no two lists of values read alike.
    """
    parts = []
    for f in FIELDS:
        value = (F.unix_micros(f) if f == "event_time" else F.col(f)).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat_ws(",", *parts), 256)


def identity_outcomes(events: DataFrame) -> DataFrame:
    """Adds identity_sha256 and outcome (ACCEPTED, DUPLICATE or CONFLICT) in one pass over each event id.

    A copy repeats a stretch of its first arrival's row; only the three columns that decide are windowed
    beside the row, in one shuffle by event_id.
    """
    order = Window.partitionBy("event_id").orderBy("kafka_partition", "kafka_offset")
    first = F.first("identity_sha256").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (
        events.withColumn("identity_sha256", fingerprint())
        .withColumn("_first", first)
        .withColumn("_number", F.row_number().over(order))
        .withColumn(
            "outcome",
            F.when(F.col("_number") == 1, "ACCEPTED")
            .when(F.col("identity_sha256") == F.col("_first"), "DUPLICATE")
            .otherwise("CONFLICT"),
        )
        .drop("_first", "_number")
    )


def against_parent(classified: DataFrame, parent: DataFrame | None) -> DataFrame:
    """Rows accepted in the batch that the parent knows become DUPLICATE or CONFLICT.

    `parent` has event_id, identity_sha256 and rank: of several identities the one of least rank holds.
    """
    if parent is None:
        return classified
    known = parent.groupBy("event_id").agg(F.min_by("identity_sha256", "rank").alias("_known"))
    accepted = F.col("outcome") == "ACCEPTED"
    return (
        classified.join(known, "event_id", "left")
        .withColumn(
            "outcome",
            F.when(accepted & F.col("_known").isNotNull() & (F.col("_known") == F.col("identity_sha256")), "DUPLICATE")
            .when(accepted & F.col("_known").isNotNull(), "CONFLICT")
            .otherwise(F.col("outcome")),
        )
        .select(*classified.columns)
    )


def ingestion_outcome() -> Column:
    """What becomes of a classified row."""
    return (
        F.when((F.col("outcome") == "ACCEPTED") & F.col("beyond_watermark"), "ACCEPTED_LATE")
        .when(F.col("outcome") == "ACCEPTED", "ACCEPTED_LIVE")
        .when(F.col("outcome") == "DUPLICATE", "DUPLICATE")
        .otherwise("QUARANTINED")
    )
