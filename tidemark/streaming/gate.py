"""The gate as a stream: lateness and identity of each micro-batch against all that the stream has taken in before.

What a batch adds to the state is written under the batch's own number, and a batch reads only lower numbers;
so a batch that is run again after a crash finds the same state and replaces what it wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark import model as M
from tidemark.functions.contract import decode_gateway, gateway_invalid, parse_times
from tidemark.operators.eventtime import classify_lateness, watermarks
from tidemark.operators.identity import against_parent, identity_outcomes

WATERMARKS = "kafka_partition int, prior_max_event_time timestamp"
IDENTITIES = "event_id string, identity_sha256 string"


def _before(batch: DataFrame, root: str, name: str, columns: str, batch_id: int) -> DataFrame:
    """What the batches before wrote of a table; an empty frame for the first one."""
    spark = batch.sparkSession
    schema = f"{columns}, batch_id long"
    if batch_id == 0:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("basePath", f"{root}/{name}").parquet(f"{root}/{name}")
    return rows.where(F.col("batch_id") < batch_id)


def gate_batch(batch: DataFrame, batch_id: int, root: str, rules: M.Rules = M.Rules()) -> None:
    """Classify the valid events of a micro-batch and add to the state: a row a partition, and the new identities."""
    prior = _before(batch, root, "watermarks", WATERMARKS, batch_id)
    prior = prior.groupBy("kafka_partition").agg(F.max("prior_max_event_time").alias("prior_max_event_time"))
    known = _before(batch, root, "identities", IDENTITIES, batch_id).withColumn("rank", F.lit(0)).drop("batch_id")
    decoded = decode_gateway(batch).where(~gateway_invalid())
    events = parse_times(decoded).drop("raw_json").persist()
    try:
        found = against_parent(identity_outcomes(classify_lateness(events, rules, prior)), known).persist()
        try:
            put = lambda rows, name: rows.write.mode("overwrite").parquet(f"{root}/{name}/batch_id={batch_id}")
            put(found, "classified")
            put(watermarks(events), "watermarks")
            put(found.where("outcome = 'ACCEPTED'").select("event_id", "identity_sha256"), "identities")
        finally:
            found.unpersist()
    finally:
        events.unpersist()


def start_gate(source: DataFrame, root: str, checkpoint: str, rules: M.Rules = M.Rules(), trigger: str | None = None) -> StreamingQuery:
    """Start the gate over a stream of envelopes; without a trigger it ends when the source is read."""
    writer = (
        source.writeStream.queryName("tidemark_gate")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(lambda batch, batch_id: gate_batch(batch, batch_id, root, rules))
    )
    return (writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)).start()
