"""A run of the whole engine on generated events, with the invariants that must hold, and its report."""

from __future__ import annotations

import html
from contextlib import contextmanager
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import model as M
from tidemark.functions.contract import producer_reason
from tidemark.functions.tokens import user_token
from tidemark.operators.eventtime import frontier
from tidemark.operators.identity import ingestion_outcome
from tidemark.plans import generation as G
from tidemark.plans.manifests import SOURCE_FORMAT, Manifest
from tidemark.plans.publish import PointerLog, PublicationConflict
from tidemark.sources.segments import generated, read_segments, snapshot, write_segments
from tidemark.sources.storage import Storage

KEY = b"a key for generated events only, not a secret"


@contextmanager
def only_run(root: str):
    """One run at a time below a root; another one gets FileExistsError."""
    files = Storage(root)
    files.create("run.lock", "")
    try:
        yield files
    finally:
        files.remove("run.lock")


def gate(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Envelopes of producers as valid events with user tokens, and the others with the reason."""
    read = rows.withColumn("reason", producer_reason(F.col("raw_json")))
    event = F.from_json("raw_json", ", ".join(f"{f} string" for f in (*M.REQUIRED, *M.OPTIONAL)))
    good = read.where("reason is null").select("kafka_partition", "kafka_offset", event.alias("e"))
    times = ("event_time", "arrival_time")
    plain = [f"e.{f}" for f in (*M.REQUIRED, *M.OPTIONAL) if f not in (*times, "user_id")]
    good = good.select(
        "kafka_partition", "kafka_offset", *plain, user_token(F.col("e.user_id"), KEY).alias("user_token"),
        *[F.try_to_timestamp(f"e.{t}").alias(t) for t in times],
    )
    return good, read.where("reason is not null").select("kafka_partition", "kafka_offset", "reason")


def source_manifest(rows: DataFrame, digest: str) -> dict:
    """All offsets of the rows, as ranges by partition."""
    found = frontier(rows.select("kafka_partition", "kafka_offset", F.lit(None).cast("timestamp").alias("event_time")))
    ranges = [{"partition": r[0], "start_offset": r[1], "end_offset": r[2]} for r in found.orderBy("kafka_partition").collect()]
    snapshots = dict.fromkeys(("bronze_event", "contract_quarantine"), digest)
    return {"format": SOURCE_FORMAT, "topic": "engagement-events", "bronze_manifest_sha256": digest, "source_snapshots": snapshots, "ranges": ranges}


def build_register_publish(spark: SparkSession, root: str, log: PointerLog, generation_id: str, *args, **named) -> Manifest:
    """The three steps of a generation, in order; a later one runs only if those before it succeeded."""
    manifest = G.write_generation(spark, f"{root}/lake", generation_id, *args, **named)
    log.register(manifest)
    log.publish(generation_id)
    return manifest


def contract_checks() -> dict[str, bool]:
    """That the registry and the rules are those that the engine is documented with."""
    return {
        "fifty_sources": len(M.source_ids()) == 50,
        "registry_document_reads_back": M.parse_registry(M.registry_document()) == M.FAMILIES,
        "rules_document_reads_back": M.Rules.parse(M.Rules().as_dict()) == M.Rules(),
        "four_snapshot_tables": set(M.Rules().required_snapshot_tables) == set(M.TABLES) == set(M.LAYOUT),
    }


def run(spark: SparkSession, root: str, n: int = 5000) -> dict[str, bool]:
    """Generate, read, gate, build LIVE and REPLAY, publish; the invariants by name."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    with only_run(root) as files:
        found = contract_checks()
        segments = write_segments(generated(spark, n), files.url("segments"))
        files.put_json("segments.json", segments)
        rows = read_segments(spark, files.url("segments"), files.read_json("segments.json")).persist()
        good, bad = (part.persist() for part in gate(rows))
        whole = source_manifest(rows, segments["sha256"])
        log = PointerLog(files.url("log"))
        live = build_register_publish(spark, files.url(""), log, "live-1", whole, "LIVE", good, bad)
        counts = {r.o: r["count"] for r in G.build(good, "LIVE").classified.groupBy(ingestion_outcome().alias("o")).count().collect()}
        found |= {
            "every_arrival_is_counted_once": sum(counts.values()) + bad.count() == rows.count() == n + 6,
            "outcomes_are_those_planted": counts == {"ACCEPTED_LIVE": n, "ACCEPTED_LATE": 1, "DUPLICATE": 1, "QUARANTINED": 1},
            "three_rows_break_the_contract": bad.count() == 3,
            "live_leaves_late_events_out": live.counts["curated_events"] == n and live.counts["open_corrections"] == 2,
            "live_is_published": log.active() == live,
        }
        again = G.write_generation(spark, files.url("lake"), "live-1", whole, "LIVE", good, bad)
        found["building_again_gives_the_same"] = again.sha256 == live.sha256
        log.register(replace(live, generation_id="stale-1"))
        try:
            log.publish("stale-1")
            found["stale_parent_is_refused"] = False
        except PublicationConflict:
            found["stale_parent_is_refused"] = log.status("stale-1") == "SUPERSEDED" and log.active() == live
        replay = build_register_publish(spark, files.url(""), log, "replay-1", whole, "REPLAY", good, bad, parent=live)
        late = snapshot(spark, files.url("lake"), "correction_exception", replay.snapshots["correction_exception"])
        found |= {
            "replay_takes_late_events_in": replay.counts["curated_events"] == n + 1,
            "replay_resolves_them": late.where(f"reason = '{M.LATE}'").select("status").distinct().collect() == [("RESOLVED",)],
            "conflicts_stay_open": replay.counts["open_corrections"] == 1,
            "replay_keeps_the_frontier": replay.offsets == live.offsets,
            "replay_is_published": log.active() == replay and log.version() == 2,
        }
        for part in (rows, good, bad):
            part.unpersist()
        write_report(files, found)
        return found


def write_report(files: Storage, found: dict[str, bool]) -> None:
    """summary.json and report.html."""
    passed = sum(found.values())
    files.put_json("summary.json", {"checks": found, "passed": passed, "total": len(found), "implementation_sha256": M.implementation_sha256()})
    lines = "".join(f"<tr><td>{html.escape(k)}<td>{'holds' if v else 'BROKEN'}" for k, v in found.items())
    files.put("report.html", f"<!doctype html><meta charset=utf-8><title>Invariants</title><p>{passed} of {len(found)} hold<table>{lines}</table>\n")
