"""Streaming ingestion: valid events to bronze, the rest to quarantine, once each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.contract import decode_gateway, gateway_invalid, parse_times


def file_source(spark: SparkSession, path: str, files_per_trigger: int = 100) -> DataFrame:
    """A stream of JSONL envelopes {partition, offset, payload}."""
    schema = "partition int, offset long, payload string"
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).json(path)
    return rows.select(
        F.col("partition").alias("kafka_partition"), F.col("offset").alias("kafka_offset"), F.col("payload").alias("raw_json")
    )


def kafka_source(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """The same of a Kafka topic; needs Spark's Kafka package."""
    rows = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "latest")
        .option("failOnDataLoss", "true")
        .load()
    )
    return rows.select(
        F.col("topic").alias("kafka_topic"), F.col("partition").alias("kafka_partition"), F.col("offset").alias("kafka_offset"),
        F.col("value").cast("string").alias("raw_json"), F.col("timestamp").alias("kafka_timestamp"),
    )


def write_batch(batch: DataFrame, batch_id: int, bronze: str, quarantine: str) -> None:
    """Write one micro-batch to folders of its own number, so that a repeated batch replaces itself."""
    checked = decode_gateway(batch).withColumn("_invalid", gateway_invalid()).persist()
    try:
        known = [c for c in ("kafka_topic", "kafka_partition", "kafka_offset", "kafka_timestamp") if c in batch.columns]
        good = parse_times(checked.where(~F.col("_invalid")).drop("_invalid", "raw_json"))
        good.write.mode("overwrite").parquet(f"{bronze}/batch_id={batch_id}")
        bad = checked.where("_invalid").select(
            *known, F.sha2("raw_json", 256).alias("payload_sha256"),
            F.lit("gateway_contract_invalid").alias("reason"),
        )
        bad.write.mode("overwrite").parquet(f"{quarantine}/batch_id={batch_id}")
    finally:
        checked.unpersist()


def start(
    source: DataFrame, bronze: str, quarantine: str, checkpoint: str, available_now: bool = False, trigger: str = "30 seconds"
) -> StreamingQuery:
    """Start the named query; with available_now it ends when the source is read."""
    writer = (
        source.writeStream.queryName("tidemark_ingest")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(lambda batch, batch_id: write_batch(batch, batch_id, bronze, quarantine))
    )
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=trigger)).start()
