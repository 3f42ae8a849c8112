"""Lateness, identity and sessions on hand rows, on their boundaries, and against a row-by-row version."""

import hashlib
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark import model as M
from tidemark.operators.eventtime import classify_lateness, frontier, offset_gaps, watermarks
from tidemark.operators.identity import against_parent, identity_outcomes
from tidemark.operators.metrics import daily_engagement, dq_not_null, dq_unique
from tidemark.operators.sessions import sessionize, sessionize_by_window

BASE = datetime(2026, 8, 11, 10)
SCHEMA = (
    "event_id string, kafka_partition int, kafka_offset long, event_type string, event_time timestamp, page_id string, "
    "campaign_id string, source_id string, user_token string, consent_state string, schema_version string"
)


def rows(spark, *found):
    """(event_id, offset, type, time, page, campaign), optionally partition and user."""
    full = []
    for event_id, offset, kind, time, page, campaign, *rest in found:
        partition, user = [*rest, *(0, "u1")[len(rest) :]]
        full.append((event_id, partition, offset, kind, time, page, campaign, "web-01", user, "analytics_allowed", "1.0"))
    return spark.createDataFrame(full, SCHEMA)


def test_hand_rows(spark):
    events = rows(
        spark,
        ("e1", 0, "page_view", BASE, "p1", "c1"),
        ("e1", 1, "page_view", BASE, "p1", "c1"),
        ("e1", 2, "page_view", BASE, "p2", "c1"),
        ("late", 3, "checkout", BASE - timedelta(hours=2), "p3", None),
        ("e2", 4, "checkout", BASE + timedelta(minutes=35), "p4", None),
    )
    found = identity_outcomes(classify_lateness(events)).persist()
    assert {r.event_id for r in found.where("beyond_watermark").collect()} == {"late"}
    counts = {r.outcome: r["count"] for r in found.groupBy("outcome").count().collect()}
    assert counts == {"ACCEPTED": 3, "DUPLICATE": 1, "CONFLICT": 1}
    parent = found.where("event_id = 'e1' and outcome = 'ACCEPTED'").select("event_id", "identity_sha256", F.lit(0).alias("rank"))
    gated = against_parent(found.where("outcome = 'ACCEPTED'"), parent)
    assert sorted(r.outcome for r in gated.collect()) == ["ACCEPTED", "ACCEPTED", "DUPLICATE"]
    on_time = found.where("outcome = 'ACCEPTED' and not beyond_watermark")
    sessions = sessionize(on_time)
    assert sessions.count() == 2
    assert daily_engagement(on_time, sessions).agg(F.sum("event_count")).first()[0] == 2


@pytest.mark.parametrize("more, sessions", [(0, 1), (1, 2)])
def test_gap_boundary(spark, more, sessions):
    events = rows(
        spark,
        ("a", 0, "search", BASE, "p", None),
        ("b", 1, "search", BASE + timedelta(minutes=30, microseconds=more), "p", None),
    )
    assert sessionize(events).count() == sessions == sessionize_by_window(events).count()


@pytest.mark.parametrize("less, late", [(0, False), (1, True)])
def test_lateness_boundary(spark, less, late):
    events = rows(
        spark,
        ("a", 0, "search", BASE, "p", None),
        ("b", 1, "search", BASE - timedelta(minutes=60, microseconds=less), "p", None),
    )
    for bucket in (1, 1 << 20):
        found = {r.event_id: r.beyond_watermark for r in classify_lateness(events, bucket=bucket).collect()}
        assert found == {"a": False, "b": late}


def test_prior_watermark_and_per_source(spark):
    before = rows(spark, ("a", 0, "search", BASE, "p", None))
    after = rows(spark, ("b", 1, "search", BASE - timedelta(hours=2), "p", None))
    assert classify_lateness(after).first().beyond_watermark is False
    assert classify_lateness(after, prior=watermarks(before)).first().beyond_watermark is True
    limits = spark.createDataFrame([("web-01", 180)], "source_id string, lateness_minutes int")
    assert classify_lateness(after, prior=watermarks(before), per_source=limits).first().beyond_watermark is False


def test_null_and_absent_page_are_alike_but_fields_dont_slide(spark):
    events = rows(
        spark,
        ("a", 0, "search", BASE, None, "x"),
        ("a", 1, "search", BASE, "x", None, 1),
        ("a", 2, "search", BASE, None, "x", 2),
    )
    found = {r.kafka_partition: r.outcome for r in identity_outcomes(events).collect()}
    assert found == {0: "ACCEPTED", 1: "CONFLICT", 2: "DUPLICATE"}


def test_random_events_against_row_by_row(spark):
    rnd = random.Random(4)
    found = []
    for i in range(400):
        time = BASE + timedelta(seconds=rnd.randint(0, 400_000), microseconds=rnd.choice([0, 1, 999_999]))
        found.append((f"e{rnd.randint(0, 300)}", i, "search", time, rnd.choice(["p", "q", None]), None, i % 3, f"u{rnd.randint(0, 5)}"))
    events = rows(spark, *found)
    got = {(r.kafka_partition, r.kafka_offset): r for r in identity_outcomes(classify_lateness(events, bucket=16)).collect()}
    top: dict = {}
    first: dict = {}
    for row in found:
        p, time = row[6], row[3]
        assert got[p, row[1]].beyond_watermark == (p in top and time < top[p] - timedelta(minutes=60))
        top[p] = max(top.get(p, time), time)
    for row in sorted(found, key=lambda r: (r[6], r[1])):
        what = (row[3], row[4], row[7])
        outcome = "ACCEPTED" if row[0] not in first else "DUPLICATE" if first[row[0]] == what else "CONFLICT"
        first.setdefault(row[0], what)
        assert got[row[6], row[1]].outcome == outcome
    by_user: dict = {}
    for row in found:
        by_user.setdefault(row[7], []).append((row[3], row[0]))
    want = set()
    for user, times in by_user.items():
        times.sort()
        start = 0
        for i in range(1, len(times) + 1):
            if i == len(times) or times[i][0] - times[i - 1][0] > timedelta(minutes=30):
                want.add((user, times[start][0], times[i - 1][0], i - start, times[start][1], times[i - 1][1]))
                start = i
    for sessions in (sessionize(events), sessionize_by_window(events)):
        have = {(r.user_token, r.started_at, r.ended_at, r.event_count, r.first_event_id, r.last_event_id) for r in sessions.collect()}
        assert have == want
    s = sessionize(events).first()
    text = s.started_at.strftime("%Y-%m-%d %H:%M:%S") + (f".{s.started_at.microsecond:06d}".rstrip("0") if s.started_at.microsecond else "")
    assert s.session_id == hashlib.sha256(f"{s.user_token}:{text}:{s.first_event_id}".encode()).hexdigest()


def test_frontier_gaps_and_data_tests(spark):
    events = rows(spark, *[(f"e{i}", i, "search", BASE, None, None) for i in (0, 1, 3, 3)])
    assert frontier(events).first()[1:4] == (0, 3, 4)
    assert offset_gaps(events).first()[1:] == (1, 1)
    assert {r.column_name: r.null_rows for r in dq_not_null(events, ["page_id", "event_id"]).collect()} == {"page_id": 4, "event_id": 0}
    assert [(r.value, r.n) for r in dq_unique(events, "event_id").collect()] == [("e3", 2)]


def test_empty(spark):
    events = rows(spark, ("a", 0, "search", BASE, None, None)).where("event_id = 'b'")
    found = identity_outcomes(classify_lateness(events))
    assert found.count() == 0 and sessionize(found).count() == 0
    assert daily_engagement(found, sessionize(found)).count() == 0


def test_model():
    assert len(M.source_ids()) == 50
    assert M.Rules().sha256 == M.Rules().sha256 != M.Rules(session_gap_minutes=31).sha256
    with pytest.raises(ValueError):
        M.Rules(live_watermark_minutes=0)
    with pytest.raises(ValueError):
        M.Rules(version=True)
