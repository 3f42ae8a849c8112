"""Building a generation: new input against a published parent, as LIVE or REPLAY."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import model as M
from tidemark.operators.eventtime import classify_lateness, watermarks
from tidemark.operators.identity import against_parent, identity_outcomes
from tidemark.operators.metrics import daily_engagement
from tidemark.operators.sessions import sessionize
from tidemark.plans.manifests import Manifest, advance_frontier, candidate_branch, check_source_manifest, source_manifest_sha256
from tidemark.sources.segments import PART
from tidemark.sources.storage import Storage

CURATED = (
    "kafka_partition", "kafka_offset", "schema_version", "event_id", "source_id", "user_token", "event_type", "event_time",
    "arrival_time", "consent_state", "page_id", "campaign_id", "beyond_watermark", "identity_sha256",
)
CORRECTION = ("event_id", "identity_sha256", "reason", "generation_mode", "status", "kafka_partition", "kafka_offset")


@dataclass
class Generation:
    """The classified input and the four tables."""

    classified: DataFrame
    curated: DataFrame
    sessions: DataFrame
    aggregates: DataFrame
    corrections: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return dict(zip(M.SNAPSHOT_TABLES, (self.curated, self.sessions, self.aggregates, self.corrections), strict=True))


def parent_identities(curated: DataFrame, corrections: DataFrame, mode: str) -> DataFrame:
    """Identities that the parent knows: curated events first, then late ones; a conflict's is none.

    A REPLAY is to accept the open late events, so it doesn't count them as known.
    """
    late = corrections.where(F.col("reason") == M.LATE)
    if mode == "REPLAY":
        late = late.where("status <> 'OPEN'")
    return curated.select("event_id", "identity_sha256", F.lit(0).alias("rank")).unionByName(
        late.select("event_id", "identity_sha256", F.lit(1).alias("rank"))
    )


def new_corrections(classified: DataFrame, mode: str) -> DataFrame:
    """A row for each accepted late event and each conflict."""
    late = (F.col("outcome") == "ACCEPTED") & F.col("beyond_watermark")
    conflict = F.col("outcome") == "CONFLICT"
    return classified.where(late | conflict).select(
        "event_id",
        "identity_sha256",
        F.when(conflict, M.CONFLICT).otherwise(M.LATE).alias("reason"),
        F.lit(mode).alias("generation_mode"),
        F.when(conflict | F.lit(mode == "LIVE"), "OPEN").otherwise("RESOLVED").alias("status"),
        "kafka_partition",
        "kafka_offset",
    )


def build(
    events: DataFrame,
    mode: str,
    rules: M.Rules = M.Rules(),
    parent_curated: DataFrame | None = None,
    parent_corrections: DataFrame | None = None,
    prior_bronze: DataFrame | None = None,
) -> Generation:
    """The tables of a generation from valid bronze events.

    LIVE leaves late events out and opens corrections; REPLAY takes them in and resolves those of its parent.
    LIVE watermarks go on from all valid bronze before (prior_bronze, the parent's curated events if not given).
    """
    if mode not in ("LIVE", "REPLAY") or (mode == "REPLAY" and parent_curated is None):
        raise ValueError("REPLAY needs a published parent")
    prior = None
    if mode == "LIVE" and parent_curated is not None:
        prior = watermarks(prior_bronze if prior_bronze is not None else parent_curated)
    classified = identity_outcomes(classify_lateness(events, rules, prior))
    if parent_curated is not None:
        classified = against_parent(classified, parent_identities(parent_curated, parent_corrections, mode))
        if mode == "REPLAY":  # late stays late, whatever watermark the replayed range gives
            was_late = parent_corrections.where(F.col("reason") == M.LATE).select("event_id").distinct()
            was_late = was_late.withColumn("_late", F.lit(True))
            classified = classified.join(was_late, "event_id", "left").withColumn(
                "beyond_watermark", F.col("beyond_watermark") | F.coalesce("_late", F.lit(False))
            ).drop("_late")
    accepted = classified.where("outcome = 'ACCEPTED'")
    fresh = (accepted if mode == "REPLAY" else accepted.where("not beyond_watermark")).select(*CURATED)
    curated = fresh if parent_curated is None else parent_curated.select(*CURATED).unionByName(fresh)
    corrections = new_corrections(classified, mode).select(*CORRECTION)
    if parent_corrections is not None:
        before = parent_corrections.select(*CORRECTION)
        # Late events by id, conflicts by where they arrived: a replay doesn't list them again.
        late = F.col("reason") == M.LATE
        corrections = (
            corrections.where(late).join(before.select("event_id").distinct(), "event_id", "left_anti").select(*CORRECTION)
            .unionByName(
                corrections.where(~late)
                .join(before.where(~late), ["event_id", "kafka_partition", "kafka_offset"], "left_anti").select(*CORRECTION)
            )
        )
        if mode == "REPLAY":
            taken = accepted.select("event_id").distinct().withColumn("_taken", F.lit(True))
            resolves = late & (F.col("status") == "OPEN") & F.coalesce("_taken", F.lit(False))
            before = before.join(taken, "event_id", "left").withColumn(
                "status", F.when(resolves, "RESOLVED").otherwise(F.col("status"))
            ).select(*CORRECTION)
        corrections = before.unionByName(corrections)
    sessions = sessionize(curated, rules)
    return Generation(classified, curated, sessions, daily_engagement(curated, sessions), corrections)


def content_id(table: DataFrame) -> tuple[str, int]:
    """A digest of a table's rows in any order, and their number, in one pass."""
    row = F.xxhash64(*[F.col(c) for c in sorted(table.columns)])
    n, total, parity = table.agg(
        F.count(F.lit(1)), F.sum(row.cast("decimal(38,0)")), F.bit_xor(row)
    ).first()
    return M.sha256_of({"columns": sorted(table.columns), "n": n, "sum": str(total), "xor": parity}), n


def write_generation(
    spark: SparkSession,
    root: str,
    generation_id: str,
    source_manifest: dict,
    mode: str,
    bronze: DataFrame,
    quarantine: DataFrame | None = None,
    parent: Manifest | None = None,
    rules: M.Rules = M.Rules(),
    implementation_sha256: str | None = None,
    contract_sha256: str | None = None,
) -> Manifest:
    """Write the tables of a generation as immutable snapshots under `root`; the manifest names them.

    Each table is written once to the folder of the candidate's branch, measured there and moved to the name of its content.
    LIVE ranges must have every offset, in the bronze table or in quarantine. The hashes are those of this engine
    if none are given.
    """
    from tidemark.sources.segments import select_ranges, snapshot, write_laid_out

    files = Storage(root)
    source = check_source_manifest(source_manifest)
    ranges = source["ranges"]
    offsets = advance_frontier(ranges, parent.offsets if parent else [], mode)
    events = select_ranges(bronze, ranges)
    if mode == "LIVE":
        found = events.select("kafka_partition", "kafka_offset")
        if quarantine is not None:
            found = found.unionByName(select_ranges(quarantine, ranges).select("kafka_partition", "kafka_offset"))
        whole = sum(r["end_offset"] - r["start_offset"] + 1 for r in ranges)
        if found.distinct().count() != whole:
            raise ValueError("offsets are missing in a source range")
    before = {t: snapshot(spark, root, t, parent.snapshots[t]) for t in M.SNAPSHOT_TABLES} if parent else {}
    prior = select_ranges(bronze, parent.offsets) if parent else None
    made = build(events, mode, rules, before.get("curated_event"), before.get("correction_exception"), prior)
    made.classified = made.classified.persist()
    snapshots, counts = {}, {}
    names = dict(zip(M.SNAPSHOT_TABLES, ("curated_events", "sessions", "aggregates", "corrections"), strict=True))
    try:
        for table, frame in made.tables().items():
            candidate, per_file = f"_candidates/{candidate_branch(generation_id)}/{table}", rules.target_file_size_mib << 12
            write_laid_out(frame, table, files.url(candidate), per_file)
            kind = f"{M.TABLES[table]}, {PART} string"
            snapshots[table], counts[names[table]] = content_id(spark.read.schema(kind).parquet(files.url(candidate)).drop(PART))
            final = f"{table}/{snapshots[table]}"
            if files.exists(final):
                files.remove(candidate)
            else:
                files.move(candidate, final)
        by_outcome = {r.outcome: r["count"] for r in made.classified.groupBy("outcome").count().collect()}
    finally:
        made.classified.unpersist()
    counts |= {"duplicates": by_outcome.get("DUPLICATE", 0), "conflicts": by_outcome.get("CONFLICT", 0)}
    written = snapshot(spark, root, "correction_exception", snapshots["correction_exception"])
    counts["open_corrections"] = written.where("status = 'OPEN'").count()
    return Manifest(
        generation_id, parent.generation_id if parent else None, mode,
        implementation_sha256 or M.implementation_sha256(), contract_sha256 or M.contract_sha256(),
        M.registry_sha256(), rules.sha256, source_manifest_sha256(source_manifest), source["bronze_manifest_sha256"],
        ranges, offsets, snapshots, counts,
    ).checked()
