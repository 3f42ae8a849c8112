"""Checksummed JSONL segments, generated events, offset ranges and snapshots."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark import model as M
from tidemark.shapes import text

#: The column that snapshots are partitioned by.
PART = "_part"
#: Ranges up to this number become one OR filter that the scan can push down.
INLINE_RANGES = 64


def select_ranges(bronze: DataFrame, ranges: list[dict[str, int]]) -> DataFrame:
    """Rows within inclusive [partition, start_offset, end_offset] ranges."""
    if len(ranges) <= INLINE_RANGES:
        wanted = F.lit(False)
        for r in ranges:
            inside = F.col("kafka_offset").between(r["start_offset"], r["end_offset"])
            wanted = wanted | ((F.col("kafka_partition") == r["partition"]) & inside)
        return bronze.where(wanted)
    rows = [(r["partition"], r["start_offset"], r["end_offset"]) for r in ranges]
    table = bronze.sparkSession.createDataFrame(rows, "_partition int, _start long, _end long")
    match = (F.col("kafka_partition") == F.col("_partition")) & F.col("kafka_offset").between(F.col("_start"), F.col("_end"))
    return bronze.join(F.broadcast(table), match, "left_semi")


def snapshot(spark: SparkSession, root: str, table: str, snapshot_id: str, since: str | None = None) -> DataFrame:
    """An immutable snapshot of a table, by its id (a digest, or up to 20 digits).

    With `since`, a date, only the partitions from then on are read; rows of the first one's month or day may be earlier.
    """
    from tidemark.plans.manifests import SNAPSHOT_ID

    if not text(SNAPSHOT_ID)(snapshot_id) or table not in (*M.SNAPSHOT_TABLES, "bronze_event", "contract_quarantine"):
        raise ValueError("invalid snapshot")
    path = f"{root}/{table}/{snapshot_id}"
    if table not in M.TABLES:
        return spark.read.parquet(path)
    rows = spark.read.schema(f"{M.TABLES[table]}, {PART} string").parquet(path)
    column, cut, _ = M.LAYOUT[table]
    if since is not None:
        rows = rows.where(F.col(PART) >= since[: len("yyyy-MM-dd" if cut == "day" else "yyyy-MM")]) if cut else rows
        rows = rows.where(F.col(column) >= F.lit(since).cast("date"))
    return rows.drop(PART)


def write_laid_out(rows: DataFrame, table: str, path: str, per_file: int, buckets: int = 32) -> None:
    """Write a table partitioned by day, month or value, its rows dealt by bucket: few files a partition, none too large."""
    column, cut, spread = M.LAYOUT[table]
    part = F.date_format(column, {"day": "yyyy-MM-dd", "month": "yyyy-MM"}[cut]) if cut else F.col(column)
    typed = rows.select(*[F.col(c.name).cast(c.dataType) for c in StructType.fromDDL(M.TABLES[table])], part.alias(PART))
    dealt = [F.col(PART)] + ([F.pmod(F.xxhash64(spread), F.lit(buckets))] if spread else [])
    typed.repartition(*dealt).write.mode("overwrite").partitionBy(PART).option("maxRecordsPerFile", per_file).parquet(path)


def generated(spark: SparkSession, n: int) -> DataFrame:
    """n regular producer events and six faults as (partition, offset, payload); deterministic."""
    i = F.col("n")
    base = F.lit("2026-06-01 00:00:00").cast("timestamp_ntz")

    def iso(seconds):
        return F.concat(F.date_format(base + F.make_dt_interval(secs=seconds), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))

    sources = F.array(*[F.lit(s) for s in sorted(M.source_ids())])
    kinds = F.array(*[F.lit(k) for k in M.EVENT_TYPES])
    fields = {
        "schema_version": F.lit(M.SCHEMA_VERSION),
        "event_id": F.concat(F.lit("event-"), F.lpad(i.cast("string"), 10, "0")),
        "source_id": F.element_at(sources, (i % 50 + 1).cast("int")),
        "user_id": F.concat(F.lit("user-"), (i % 2000).cast("string")),
        "event_type": F.element_at(kinds, (i % 5 + 1).cast("int")),
        "event_time": iso((i * 7).cast("decimal(18,6)")),
        "arrival_time": iso((i * 7 + 2).cast("decimal(18,6)")),
        "consent_state": F.when(i % 37 == 0, "essential_only").otherwise("analytics_allowed"),
        "page_id": F.concat(F.lit("page-"), (i % 200).cast("string")),
        "campaign_id": F.when(i % 5 == 0, F.concat(F.lit("campaign-"), (i % 40).cast("string"))),
    }

    def payload(**changed):
        return F.to_json(F.struct(*[v.alias(k) for k, v in (fields | changed).items() if v is not None]))

    regular = spark.range(n).select(F.col("id").alias("n"), F.lit(0).alias("fault"))
    one = spark.range(1)
    faults = [
        (17, 17, {}),
        (23, 23, {"page_id": F.lit("conflicting-page")}),
        (31, 7, {"event_type": None}),
        (41, 17, {"context": F.struct(F.lit("secret").alias("cookie"))}),
        (51, 3, {"source_id": F.lit("unknown-99")}),
        (n + 1, 0, {"event_id": F.lit("late-event-0001"), "event_time": F.lit("2026-05-30T00:00:00+00:00"),
                    "arrival_time": F.lit("2026-06-02T00:00:00+00:00")}),
    ]
    rows = regular.select((i % 24).cast("int").alias("partition"), i.alias("_rank"), payload().alias("payload"))
    for k, (number, partition, changed) in enumerate(faults):
        fault = one.select(F.lit(number).cast("long").alias("n"))
        rows = rows.unionByName(
            fault.select(F.lit(partition).alias("partition"), F.lit(n + k).cast("long").alias("_rank"), payload(**changed).alias("payload"))
        )
    # A regular event's offset follows from its number; a fault's from how many of its partition come before.
    before = [sum(1 for j, (_, p, _) in enumerate(faults) if p == faults[k][1] and j < k) for k in range(len(faults))]
    regular_in = [len(range(p, n, 24)) for _, p, _ in faults]
    offset = F.floor(F.col("_rank") / 24)
    for k, (b, r) in enumerate(zip(before, regular_in, strict=True)):
        offset = F.when(F.col("_rank") == n + k, b + r).otherwise(offset)
    return rows.select("partition", offset.cast("long").alias("offset"), "payload")


def write_segments(envelopes: DataFrame, root: str, segments: int = 24) -> dict:
    """Write envelopes as JSONL segments by partition, and a manifest with a SHA-256 per file."""
    spark = envelopes.sparkSession
    line = F.concat(
        F.lit('{"offset":'), F.col("offset").cast("string"), F.lit(',"partition":'), F.col("partition").cast("string"),
        F.lit(',"payload":'), F.col("payload"), F.lit("}"),
    )
    body = envelopes.repartitionByRange(segments, "partition", "offset").sortWithinPartitions("partition", "offset")
    body.select(line.alias("value")).write.text(root)
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(root)
        .select(F.element_at(F.split("path", "/"), -1).alias("path"), F.sha2("content", 256).alias("sha256"))
        .orderBy("path").collect()
    )
    manifest = {"files": [{"path": f.path, "sha256": f.sha256} for f in files]}
    manifest["sha256"] = hashlib.sha256((M.canonical_json(manifest) + "\n").encode()).hexdigest()
    return manifest


def read_segments(spark: SparkSession, root: str, manifest: dict) -> DataFrame:
    """The envelopes of the segments (kafka_partition, kafka_offset, raw_json), once every checksum fits."""
    want = {f["path"]: f["sha256"] for f in manifest["files"]}
    have = {
        r.path.rsplit("/", 1)[1]: r.sha256
        for r in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(root)
        .select("path", F.sha2("content", 256).alias("sha256")).collect()
    }
    if want != have:
        raise ValueError("segment checksum mismatch")
    lines = spark.read.option("pathGlobFilter", "part-*").text(root)
    parsed = F.from_json("value", "partition int, offset long, payload string")
    return lines.select(
        parsed["partition"].alias("kafka_partition"), parsed["offset"].alias("kafka_offset"), parsed["payload"].alias("raw_json")
    )
