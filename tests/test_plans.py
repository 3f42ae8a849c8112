import json
import threading
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark import model as M
from tidemark import queries
from tidemark.functions.contract import producer_reason
from tidemark.functions.tokens import user_token
from tidemark.operators.identity import ingestion_outcome
from tidemark.plans import evidence
from tidemark.plans import generation as G
from tidemark.plans.manifests import (
    SOURCE_FORMAT, Manifest, advance_frontier, candidate_branch, check_source_manifest, on_branch, source_manifest_sha256,
)
from tidemark.plans.publish import PointerLog, PublicationConflict
from tidemark.sources import storage
from tidemark.sources.segments import generated, read_segments, select_ranges, snapshot, write_laid_out, write_segments
from tidemark.sources.storage import Storage
from tidemark.streaming.gate import gate_batch
from tidemark.streaming.ingest import file_source, start


def source(ranges):
    snapshots = {"bronze_event": "1", "contract_quarantine": "2"}
    return {"format": SOURCE_FORMAT, "topic": "events", "bronze_manifest_sha256": "a" * 64, "source_snapshots": snapshots, "ranges": ranges}


def span(p, a, b):
    return {"partition": p, "start_offset": a, "end_offset": b}


@pytest.fixture(scope="module")
def bronze(spark):
    """Valid generated events, tokenized, and the others."""
    rows = generated(spark, 600).withColumn("reason", producer_reason(F.col("payload")))
    field = lambda name: F.get_json_object("payload", f"$.{name}").alias(name)
    good = rows.where("reason is null").select(
        F.col("partition").alias("kafka_partition"), F.col("offset").alias("kafka_offset"),
        user_token(F.get_json_object("payload", "$.user_id"), b"k" * 32).alias("user_token"),
        *[field(n) for n in ("schema_version", "event_id", "source_id", "event_type", "consent_state", "page_id", "campaign_id")],
        *[F.try_to_timestamp(F.get_json_object("payload", f"$.{n}")).alias(n) for n in ("event_time", "arrival_time")],
    )
    bad = rows.where("reason is not null").select(F.col("partition").alias("kafka_partition"), F.col("offset").alias("kafka_offset"), "reason")
    return good.persist(), bad.persist()


def test_generator(spark, bronze):
    good, bad = bronze
    assert {r.reason for r in bad.collect()} == {"contract_fields", "unknown_source", "prohibited_fields:cookie"}
    made = G.build(good, "LIVE")
    counts = {r.o: r["count"] for r in made.classified.groupBy(ingestion_outcome().alias("o")).count().collect()}
    assert counts == {"ACCEPTED_LIVE": 600, "ACCEPTED_LATE": 1, "DUPLICATE": 1, "QUARANTINED": 1}
    assert sum(counts.values()) + bad.count() == 606


def test_live_replay_publish(spark, bronze, tmp_path):
    good, bad = bronze
    ends = {r[0]: r[1] for r in good.select("kafka_partition", "kafka_offset").unionByName(bad.select("kafka_partition", "kafka_offset"))
            .groupBy("kafka_partition").agg(F.max("kafka_offset")).collect()}
    whole = source([span(p, 0, e) for p, e in sorted(ends.items())])
    root, log = str(tmp_path / "lake"), PointerLog(str(tmp_path / "log"))
    live = G.write_generation(spark, root, "g1", whole, "LIVE", good, bad)
    assert live.counts["curated_events"] == 600 and live.counts["open_corrections"] == 2
    again = G.write_generation(spark, root, "g1", whole, "LIVE", good, bad)
    assert again.sha256 == live.sha256
    with pytest.raises(ValueError, match="missing"):
        G.write_generation(spark, root, "gx", whole, "LIVE", good)
    log.register(live)
    stale = replace(live, generation_id="g1b")
    log.register(stale)
    assert log.publish("g1") == 1 and log.status("g1") == "PUBLISHED"
    with pytest.raises(PublicationConflict):
        log.publish("g1b")
    assert log.status("g1b") == "SUPERSEDED"
    replay = G.write_generation(spark, root, "g2", whole, "REPLAY", good, bad, parent=live)
    assert replay.counts["curated_events"] == 601 and replay.counts["open_corrections"] == 1  # the conflict stays open
    assert replay.counts["corrections"] == live.counts["corrections"]
    log.register(replay)
    assert log.publish("g2") == 2 and log.active().generation_id == "g2"
    log.rollback("g3", "g1")
    assert log.publish("g3") == 3 and log.active().snapshots == live.snapshots


def test_race(tmp_path):
    log = PointerLog(str(tmp_path))
    base = manifest()
    names = [f"c{i}" for i in range(6)]
    for n in names:
        log.register(replace(base, generation_id=n))
    won, lost = [], []

    def go(n):
        try:
            log.publish(n)
            won.append(n)
        except PublicationConflict:
            lost.append(n)

    threads = [threading.Thread(target=go, args=(n,)) for n in names]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert len(won) == 1 and len(lost) == 5 and log.active().generation_id == won[0]
    with pytest.raises(ValueError):
        log.register(replace(base, generation_id="c0", bronze_manifest_sha256="b" * 64))


def manifest():
    from tidemark import model as M

    snapshots = dict.fromkeys(M.SNAPSHOT_TABLES, "7")
    return Manifest("g", None, "LIVE", *["a" * 64] * 6, [span(0, 0, 5)], [span(0, 0, 5)], snapshots, {"n": 1})


def test_manifests():
    m = manifest()
    assert Manifest.parse(json.loads(json.dumps(m.as_dict()))).sha256 == m.sha256
    for bad in (
        {"generation_id": "a b"}, {"mode": "X"}, {"rule_sha256": "x"}, {"offsets": []}, {"counts": {"n": True}},
        {"snapshots": {}}, {"extra": 1}, {"input_offsets": [span(0, 3, 2)]}, {"offsets": [span(0, 0, 1), span(0, 2, 3)]},
    ):
        with pytest.raises(ValueError):
            Manifest.parse(m.as_dict() | bad)
    good = source([span(1, 0, 3), span(0, 0, 1)])
    assert [r["partition"] for r in check_source_manifest(good)["ranges"]] == [0, 1]
    assert source_manifest_sha256(good) == source_manifest_sha256(dict(reversed(good.items())))
    for bad in ({"topic": "a b"}, {"ranges": []}, {"ranges": [span(True, 0, 1)]}, {"source_snapshots": {}}, {"format": "x"}):
        with pytest.raises(ValueError):
            check_source_manifest(good | bad)


def test_frontier():
    parent = [span(0, 0, 5), span(1, 0, 9)]
    assert advance_frontier([span(0, 6, 7), span(1, 10, 12), span(2, 4, 4)], parent, "LIVE") == [span(0, 0, 7), span(1, 0, 12), span(2, 4, 4)]
    assert advance_frontier([span(0, 2, 3)], parent, "REPLAY") == parent
    for ranges, mode in (([span(0, 5, 7)], "LIVE"), ([span(0, 0, 6)], "REPLAY"), ([span(0, 6, 7)], "X")):
        with pytest.raises(ValueError):
            advance_frontier(ranges, parent, mode)
    with pytest.raises(ValueError):
        advance_frontier([span(0, 0, 1)], [], "REPLAY")


def test_ranges_in_both_ways(spark):
    rows = spark.range(300).select((F.col("id") % 100).cast("int").alias("kafka_partition"), F.floor(F.col("id") / 100).alias("kafka_offset"))
    few, many = [span(p, 1, 1) for p in range(3)], [span(p, 1, 2) for p in range(80)]
    assert select_ranges(rows, few).count() == 3 and select_ranges(rows, many).count() == 160


def test_segments(spark, tmp_path):
    made = generated(spark, 100)
    manifest = write_segments(made, str(tmp_path / "s"), 3)
    assert read_segments(spark, str(tmp_path / "s"), manifest).count() == 106
    path = next(Path(tmp_path / "s").glob("part-*"))
    path.write_text(path.read_text() + "x\n")
    for hidden in Path(tmp_path / "s").glob(".*.crc"):
        hidden.unlink()
    with pytest.raises(ValueError, match="checksum"):
        read_segments(spark, str(tmp_path / "s"), manifest)


def test_stream_restarts(spark, tmp_path):
    d = str(tmp_path)

    def drop(name, rows):
        Path(d, "in").mkdir(exist_ok=True)
        Path(d, "in", name).write_text("".join(json.dumps({"partition": 0, "offset": o, "payload": "{}"}) + "\n" for o in rows))

    def run():
        start(file_source(spark, f"{d}/in"), f"{d}/b", f"{d}/q", f"{d}/c", available_now=True).awaitTermination()
        return sorted(r.kafka_offset for r in spark.read.parquet(f"{d}/q").collect())

    drop("1.json", [0, 1])
    assert run() == [0, 1]
    assert run() == [0, 1]
    drop("2.json", [2])
    assert run() == [0, 1, 2]


def test_batch_is_replaced(spark, tmp_path):
    from tidemark.streaming.ingest import write_batch

    batch = spark.createDataFrame([(0, 0, "{}")], "kafka_partition int, kafka_offset long, raw_json string")
    for _ in range(2):
        write_batch(batch, 3, f"{tmp_path}/b", f"{tmp_path}/q")
    assert spark.read.parquet(f"{tmp_path}/q").count() == 1


def test_every_query_has_sql():
    assert set(queries.queries()) == set(queries.oracle_sql())


def test_names():
    assert candidate_branch("g; drop table x") == candidate_branch("g; drop table x") != candidate_branch("g")
    assert on_branch("cat.db.t", candidate_branch("g")).startswith("cat.db.t.branch_candidate_")
    for table, branch in (("db.t", "b"), ("a.b.c; --", "b"), ("a.b.c", "B"), ("a.b.c", ""), ("a.b.c", "x" * 64)):
        with pytest.raises(ValueError, match="unsafe"):
            on_branch(table, branch)


def test_documents_name_all_their_faults():
    with pytest.raises(ValueError, match="topic has a wrong value.*ranges is missing"):
        check_source_manifest({k: v for k, v in source([span(0, 0, 1)]).items() if k != "ranges"} | {"topic": ""})
    rules = M.Rules().as_dict()
    assert M.Rules.parse(rules) == M.Rules()
    for bad in ({"version": True}, {"session_gap_minutes": 0}, {"extra": 1}, {"required_snapshot_tables": ["a", "a", "b", "c"]}):
        with pytest.raises(ValueError):
            M.Rules.parse(rules | bad)
    families = M.registry_document()
    assert M.parse_registry(families) == M.FAMILIES
    for bad in ({"version": 2}, {"families": []}, {"families": families["families"] * 2}, {"families": [families["families"][0] | {"instances": 0}]}):
        with pytest.raises(ValueError):
            M.parse_registry(families | bad)


@pytest.mark.parametrize("kind", ["local", "hadoop"])
def test_storage(spark, tmp_path, kind):
    root = f"file://{tmp_path}/store"
    files = Storage(root)
    if kind == "hadoop":
        files = object.__new__(storage._Hadoop)
        files.__init__(root)
    files.create("a/x.json", "{}")
    with pytest.raises(FileExistsError):
        files.create("a/x.json", "other")
    files.put_json("a/y.json", {"b": "é"})
    files.put_json("a/y.json", {"b": 2})
    assert files.read("a/x.json") == "{}" and files.read_json("a/y.json") == {"b": 2}
    assert files.names("a") == ["x.json", "y.json"] and files.names("none") == []
    files.move("a", "b/c")
    assert files.exists("b/c/x.json") and not files.exists("a")
    files.remove("b")
    assert not files.exists("b/c")
    files.put("large", "x" * (storage.LARGEST + 1))
    with pytest.raises(ValueError, match="larger"):
        files.read("large")


def test_one_run_at_a_time(tmp_path):
    with evidence.only_run(str(tmp_path)), pytest.raises(FileExistsError), evidence.only_run(str(tmp_path)):
        pass
    with evidence.only_run(str(tmp_path)):
        pass


def test_evidence(spark, tmp_path):
    found = evidence.run(spark, str(tmp_path), 200)
    assert all(found.values()), found
    assert json.loads((tmp_path / "summary.json").read_text())["passed"] == len(found)
    assert len(M.implementation_sha256()) == 64 and "holds" in (tmp_path / "report.html").read_text()


def test_snapshot_partitions(spark, tmp_path):
    rows = spark.range(60).select(
        F.lit(0).alias("kafka_partition"), F.col("id").alias("kafka_offset"), (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(days=F.col("id").cast("int"))).alias("event_time"),
        *[F.lit("x").alias(c) for c in ("schema_version", "event_id", "source_id", "user_token", "event_type", "consent_state", "page_id", "campaign_id", "identity_sha256")],
        F.current_timestamp().alias("arrival_time"), F.lit(False).alias("beyond_watermark"),
    )
    write_laid_out(rows, "curated_event", f"{tmp_path}/curated_event/7", 1000)
    assert len(list(Path(tmp_path, "curated_event", "7").glob("_part=*"))) == 60
    found = snapshot(spark, str(tmp_path), "curated_event", "7", since="2024-02-10")
    assert found.count() == 20 and "PartitionFilters: [isnotnull(_part" in found._jdf.queryExecution().toString()
    write_laid_out(rows.limit(0), "curated_event", f"{tmp_path}/curated_event/8", 1000)
    assert snapshot(spark, str(tmp_path), "curated_event", "8").count() == 0


def test_streamed_gate_runs_a_batch_again(spark, tmp_path):
    event = {
        "schema_version": "1.0", "event_id": "e1", "source_id": "web-01", "user_token": "a" * 64, "event_type": "search",
        "event_time": "2026-06-01T12:00:00Z", "arrival_time": "2026-06-01T12:00:01Z", "consent_state": "analytics_allowed",
    }
    batches = [
        [event, event | {"event_id": "e2", "schema_version": "9"}],
        [event | {"arrival_time": "2026-06-01T13:00:00Z"}, event | {"page_id": "p"}, event | {"event_id": "e3", "event_time": "2026-06-01T10:59:59Z"}],
    ]
    offset = 0
    frames = []
    for rows in batches:
        frames.append(spark.createDataFrame([(0, offset + k, json.dumps(r)) for k, r in enumerate(rows)], "kafka_partition int, kafka_offset long, raw_json string"))
        offset += len(rows)
    for k, frame in [(0, frames[0]), (0, frames[0]), (1, frames[1]), (1, frames[1])]:
        gate_batch(frame, k, str(tmp_path))
    found = spark.read.parquet(f"{tmp_path}/classified").orderBy("kafka_offset").collect()
    assert [(r.outcome, r.beyond_watermark) for r in found] == [("ACCEPTED", False), ("DUPLICATE", False), ("CONFLICT", False), ("ACCEPTED", True)]
