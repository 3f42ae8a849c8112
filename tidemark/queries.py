"""The engine's queries over the test tables, each with the same in SQL for another engine to check."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import model as M
from tidemark.functions.contract import decode_gateway, gateway_invalid, producer_reason, redacted, unknown_keys
from tidemark.functions.tokens import user_token
from tidemark.operators import metrics
from tidemark.operators.eventtime import classify_lateness, frontier, offset_gaps, watermarks
from tidemark.operators.identity import against_parent, identity_outcomes, ingestion_outcome
from tidemark.operators.sessions import sessionize, sessionize_by_window
from tidemark.plans import evidence
from tidemark.plans import generation as G
from tidemark.plans.evidence import build_register_publish, source_manifest
from tidemark.plans.manifests import advance_frontier
from tidemark.plans.publish import PointerLog
from tidemark.sources.envelope import ENVELOPE_SQL, envelopes
from tidemark.sources.segments import generated, read_segments, select_ranges, snapshot, write_segments

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
#: Queries whose result has an event_date.
DATED = {"daily_engagement", "sessions_per_day", "mart_daily", "mart_incremental"}

#: A fixed key, for tests.
KEY = b"tidemark-test-key-of-32-bytes-...".ljust(40, b".")
RANGES = [{"partition": p, "start_offset": 100 * p, "end_offset": 100 * p + 149} for p in range(4)]


def _times(df: DataFrame) -> DataFrame:
    """Times without a zone, and dates as text, so that both engines show them alike."""
    shown = {"timestamp": "timestamp_ntz", "date": "string"}
    return df.withColumns({c: F.col(c).cast(shown[t]) for c, t in df.dtypes if t in shown})


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = lambda spark, sf_dir: _times(f(spark, sf_dir))
        if sql:
            text = "cast(event_date as varchar) as event_date"
            SQL[f.__name__] = f"select * replace ({text}) from ({sql})" if f.__name__ in DATED else sql
        return f

    return add


# What the SQL of several queries begins with.
_LATE = f"""{ENVELOPE_SQL},
late as (
  select *, coalesce(epoch_us(event_time) < epoch_us(max(event_time) over (partition by kafka_partition order by kafka_offset
    rows between unbounded preceding and 1 preceding)) - 3600000000, false) as beyond_watermark from env)"""
_PRINTED = ("schema_version", "event_id", "source_id", "user_token", "event_type", "cast(epoch_us(event_time) as varchar)",
            "consent_state", "page_id", "campaign_id")
_PRINT = "sha256(concat_ws(',', " + ", ".join(f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in _PRINTED) + "))"
_WHOLE = "row(schema_version, event_id, source_id, user_token, event_type, event_time, consent_state, page_id, campaign_id)"
_OUTCOME = f"""case when row_number() over w = 1 then 'ACCEPTED'
    when {_WHOLE} is not distinct from first({_WHOLE}) over w then 'DUPLICATE' else 'CONFLICT' end as outcome"""
_IDENTITY = f"""{_LATE},
prints as (select *, {_PRINT} as identity_sha256 from late),
ident as (select *, {_OUTCOME} from prints window w as (partition by event_id order by kafka_partition, kafka_offset))"""
_CURATED_COLUMNS = ", ".join(G.CURATED)
_LIVE = f"""{_IDENTITY}, cur as (select {_CURATED_COLUMNS} from ident where outcome = 'ACCEPTED' and not beyond_watermark)"""
_REPLAY = f"""{_IDENTITY}, cur as (select {_CURATED_COLUMNS} from ident where outcome = 'ACCEPTED')"""
_SESSION_TAIL = """,
eligible as (select * from cur where consent_state = 'analytics_allowed'),
opened as (select *, case when epoch_us(event_time) - epoch_us(lag(event_time) over (partition by user_token order by event_time, event_id))
  <= 1800000000 then 0 else 1 end as opens from eligible),
numbered as (select *, sum(opens) over (partition by user_token order by event_time, event_id rows unbounded preceding) as k from opened),
grouped as (select user_token, min(event_time) as started_at, max(event_time) as ended_at, count(*) as event_count,
  arg_min(event_id, (event_time, event_id)) as first_event_id, arg_max(event_id, (event_time, event_id)) as last_event_id
  from numbered group by user_token, k),
ses as (select sha256(concat_ws(':', user_token, cast(started_at as varchar), first_event_id)) as session_id, * from grouped)"""
_DAILY_TAIL = f"""{_SESSION_TAIL},
per_day as (select cast(started_at as date) as event_date, count(*) as s from ses group by 1),
agg as (select cast(event_time as date) as event_date, event_type, count(event_id) as event_count, count(distinct user_token) as unique_users
  from eligible group by 1, 2),
daily as (select agg.*, coalesce(s, 0) as sessions_started_on_date from agg left join per_day using (event_date))"""
# The second generation: offsets from 900 on against a parent of offsets below 1,000.
_SPLIT = f"""{ENVELOPE_SQL},
late1 as (select *, coalesce(epoch_us(event_time) < epoch_us(max(event_time) over (partition by kafka_partition order by kafka_offset
    rows between unbounded preceding and 1 preceding)) - 3600000000, false) as beyond_watermark from env where kafka_offset < 1000),
late as (select *, coalesce(epoch_us(event_time) < epoch_us(greatest(max(event_time) over (partition by kafka_partition order by kafka_offset
    rows between unbounded preceding and 1 preceding), top)) - 3600000000, false) as beyond_watermark
  from env join (select kafka_partition, max(event_time) as top from env where kafka_offset < 1000 group by 1) using (kafka_partition)
  where kafka_offset >= 900),
p1 as (select *, {_PRINT} as identity_sha256 from late1), p2 as (select *, {_PRINT} as identity_sha256 from late),
i1 as (select *, {_OUTCOME}
  from p1 window w as (partition by event_id order by kafka_partition, kafka_offset)),
i2 as (select *, {_OUTCOME}
  from p2 window w as (partition by event_id order by kafka_partition, kafka_offset)),
known as (select event_id, identity_sha256 as k from i1 where outcome = 'ACCEPTED'),
gated as (select i2.* exclude (outcome), case when outcome <> 'ACCEPTED' or k is null then outcome when k = identity_sha256 then 'DUPLICATE' else 'CONFLICT' end as outcome
  from i2 left join known using (event_id))"""


def _classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identity_outcomes(classify_lateness(envelopes(spark, sf_dir)))


def _curated(spark: SparkSession, sf_dir: str, mode: str = "LIVE") -> DataFrame:
    accepted = _classified(spark, sf_dir).where("outcome = 'ACCEPTED'")
    return (accepted.where("not beyond_watermark") if mode == "LIVE" else accepted).select(*G.CURATED)


@query(f"with {ENVELOPE_SQL} select * from env")
def envelope(spark, sf_dir):
    return envelopes(spark, sf_dir)


@query(f"with {_LATE} select kafka_partition, kafka_offset, event_id, beyond_watermark from late")
def lateness(spark, sf_dir):
    found = classify_lateness(envelopes(spark, sf_dir), bucket=256)
    return found.select("kafka_partition", "kafka_offset", "event_id", "beyond_watermark")


_PER_SOURCE = "(" + " union all ".join(f"select '{f}' as family, {m} as m" for f, _, _, m in M.FAMILIES) + ")"


@query(
    f"""with {ENVELOPE_SQL} select kafka_partition, kafka_offset, event_id, coalesce(epoch_us(event_time) <
    epoch_us(max(event_time) over (partition by kafka_partition order by kafka_offset rows between unbounded preceding and 1 preceding))
    - cast(m as bigint) * 60000000, false) as beyond_watermark
    from env join {_PER_SOURCE} on family = split_part(source_id, '-', 1)"""
)
def lateness_per_source(spark, sf_dir):
    limits = source_registry(spark, sf_dir)
    found = classify_lateness(envelopes(spark, sf_dir), per_source=limits)
    return found.select("kafka_partition", "kafka_offset", "event_id", "beyond_watermark")


_ODD = f"""base as (select event_id as n, ts as event_time from events),
twice as (select *, unnest([0, 1]) as copy from base),
odd as (select cast(n % 3 as int) as kafka_partition, n * 2 + copy as kafka_offset, '1.0' as schema_version, concat('evt-', n) as event_id,
  'web-01' as source_id, 'u' as user_token, 'search' as event_type, event_time, 'analytics_allowed' as consent_state,
  case n % 5 when 0 then ['a|b', 'a'][copy + 1] when 1 then [chr(92) || 'N', null][copy + 1] when 2 then ['a,1:b', 'a'][copy + 1] when 3 then ['-', null][copy + 1] end as page_id,
  case n % 5 when 0 then ['c', 'b|c'][copy + 1] when 2 then ['c', '1:b,c'][copy + 1] end as campaign_id from twice)"""


@query(f"with {_ODD} select kafka_partition, kafka_offset, event_id, {_OUTCOME} from odd window w as (partition by event_id order by kafka_partition, kafka_offset)")
def identity_of_odd_values(spark, sf_dir):
    """Pairs of events whose values differ only where separators and marks for nulls might hide it, and equal ones."""
    n, copy = F.col("event_id"), F.col("copy")
    pick = lambda first, second: F.when(copy == 0, first).otherwise(second)
    case = lambda *values: F.coalesce(*[F.when(n % 5 == k, v) for k, v in values])
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", F.explode(F.array(F.lit(0), F.lit(1))).alias("copy"))
    odd = rows.select(
        (n % 3).cast("int").alias("kafka_partition"), (n * 2 + copy).alias("kafka_offset"), F.lit("1.0").alias("schema_version"),
        F.concat(F.lit("evt-"), n.cast("string")).alias("event_id"), F.lit("web-01").alias("source_id"), F.lit("u").alias("user_token"),
        F.lit("search").alias("event_type"), F.col("ts").cast("timestamp").alias("event_time"), F.lit("analytics_allowed").alias("consent_state"),
        case((0, pick("a|b", F.lit("a"))), (1, pick("\\N", F.lit(None))), (2, pick("a,1:b", F.lit("a"))), (3, pick("-", F.lit(None)))).alias("page_id"),
        case((0, pick("c", F.lit("b|c"))), (2, pick("c", F.lit("1:b,c")))).alias("campaign_id"),
    )
    return identity_outcomes(odd).select("kafka_partition", "kafka_offset", "event_id", "outcome")


@query(f"with {_IDENTITY} select kafka_partition, kafka_offset, event_id, identity_sha256, outcome from ident")
def identity_gate(spark, sf_dir):
    return _classified(spark, sf_dir).select("kafka_partition", "kafka_offset", "event_id", "identity_sha256", "outcome")


@query(
    f"""with {_IDENTITY} select case when outcome = 'ACCEPTED' and beyond_watermark then 'ACCEPTED_LATE' when outcome = 'ACCEPTED'
    then 'ACCEPTED_LIVE' when outcome = 'DUPLICATE' then 'DUPLICATE' else 'QUARANTINED' end as ingestion_outcome, count(*) as n
    from ident group by 1"""
)
def outcome_counts(spark, sf_dir):
    rows = _classified(spark, sf_dir).withColumn("ingestion_outcome", ingestion_outcome())
    return rows.groupBy("ingestion_outcome").agg(F.count(F.lit(1)).alias("n"))


@query(f"with {_LIVE} select * from cur")
def curated_live(spark, sf_dir):
    return _curated(spark, sf_dir)


@query(f"with {_REPLAY} select * from cur")
def curated_replay(spark, sf_dir):
    return _curated(spark, sf_dir, "REPLAY")


@query(f"with {_LIVE}{_SESSION_TAIL} select * from ses")
def sessions(spark, sf_dir):
    return sessionize(_curated(spark, sf_dir))


@query(f"with {_LIVE}{_SESSION_TAIL} select * from ses")
def session_window_twin(spark, sf_dir):
    return sessionize_by_window(_curated(spark, sf_dir))


@query(f"with {_LIVE}{_DAILY_TAIL} select * from daily")
def daily_engagement(spark, sf_dir):
    curated = _curated(spark, sf_dir)
    return metrics.daily_engagement(curated, sessionize(curated))


@query(f"with {_LIVE}{_SESSION_TAIL} select cast(started_at as date) as event_date, count(*) as sessions_started_on_date from ses group by 1")
def sessions_per_day(spark, sf_dir):
    return metrics.sessions_per_day(sessionize(_curated(spark, sf_dir)))


_CORRECTIONS = """select event_id, identity_sha256, case when outcome = 'CONFLICT' then 'identity_payload_conflict' else 'beyond_live_watermark' end as reason,
  '{mode}' as generation_mode, case when outcome = 'CONFLICT' or '{mode}' = 'LIVE' then 'OPEN' else 'RESOLVED' end as status, kafka_partition, kafka_offset
  from {rows} where outcome = 'CONFLICT' or (outcome = 'ACCEPTED' and beyond_watermark)"""


@query(f"with {_IDENTITY} {_CORRECTIONS.format(mode='LIVE', rows='ident')}")
def corrections_live(spark, sf_dir):
    return G.build(envelopes(spark, sf_dir), "LIVE").corrections


@query(
    f"""with {_IDENTITY}, c as ({_CORRECTIONS.format(mode='LIVE', rows='ident')})
    select * exclude (status), case when reason = 'beyond_live_watermark' then 'RESOLVED' else status end as status from c"""
)
def corrections_replay(spark, sf_dir):
    events = envelopes(spark, sf_dir).persist()  # read by both generations
    live = G.build(events, "LIVE")
    return G.build(events, "REPLAY", parent_curated=live.curated, parent_corrections=live.corrections).corrections


@query(
    f"""with {_IDENTITY}, c as ({_CORRECTIONS.format(mode='LIVE', rows='ident')})
    select reason, case when reason = 'beyond_live_watermark' then 'RESOLVED' else status end as status, count(*) as n from c group by 1, 2"""
)
def correction_status_counts(spark, sf_dir):
    return corrections_replay(spark, sf_dir).groupBy("reason", "status").agg(F.count(F.lit(1)).alias("n"))


def _split(spark: SparkSession, sf_dir: str) -> tuple[G.Generation, G.Generation]:
    events = envelopes(spark, sf_dir).persist()  # read by both generations
    before, after = events.where("kafka_offset < 1000"), events.where("kafka_offset >= 900")
    parent = G.build(before, "LIVE")
    child = G.build(after, "LIVE", parent_curated=parent.curated, parent_corrections=parent.corrections, prior_bronze=before)
    return parent, child


@query(f"with {_SPLIT} select kafka_partition, kafka_offset, event_id, beyond_watermark, outcome from gated")
def parent_gate(spark, sf_dir):
    return _split(spark, sf_dir)[1].classified.select(
        "kafka_partition", "kafka_offset", "event_id", "beyond_watermark", "outcome"
    )


@query(
    f"""with {_SPLIT} select event_id, kafka_partition, kafka_offset from gated where outcome = 'ACCEPTED' and beyond_watermark
    and event_id not in ({_CORRECTIONS.format(mode='LIVE', rows='i1').replace('select event_id, identity_sha256', 'select event_id from (select event_id, identity_sha256', 1)}))"""
)
def late_anti_join(spark, sf_dir):
    parent, child = _split(spark, sf_dir)
    late = child.classified.where("outcome = 'ACCEPTED' and beyond_watermark")
    return late.join(parent.corrections, "event_id", "left_anti").select("event_id", "kafka_partition", "kafka_offset")


@query(
    f"""with {ENVELOPE_SQL} select kafka_partition, min(kafka_offset) as start_offset, max(kafka_offset) as end_offset, count(*) as row_count,
    max(event_time) as max_event_time from env group by 1"""
)
def partition_frontier(spark, sf_dir):
    return frontier(envelopes(spark, sf_dir))


@query(f"with {ENVELOPE_SQL} select kafka_partition, max(event_time) as prior_max_event_time from env where kafka_offset < 1000 group by 1")
def prior_watermark(spark, sf_dir):
    return watermarks(envelopes(spark, sf_dir).where("kafka_offset < 1000"))


@query(f"with {ENVELOPE_SQL} select kafka_partition, kafka_offset, event_id from env where kafka_offset between 100 * kafka_partition and 100 * kafka_partition + 149")
def offset_range_scan(spark, sf_dir):
    return select_ranges(envelopes(spark, sf_dir), RANGES).select("kafka_partition", "kafka_offset", "event_id")


@query(
    f"""with {ENVELOPE_SQL} select kafka_partition, max(kafka_offset) - min(kafka_offset) + 1 - count(*) as missing, 0 as repeated
    from env where kafka_offset % 50 <> 7 group by 1"""
)
def offset_gap_check(spark, sf_dir):
    return offset_gaps(envelopes(spark, sf_dir).where("kafka_offset % 50 <> 7"))


def _pads() -> tuple[str, str]:
    padded = KEY.ljust(64, b"\0")
    return tuple(bytes(b ^ p for b in padded).hex() for p in (0x36, 0x5C))


@query(
    "select c_custkey, sha256(from_hex('{1}') || from_hex(sha256(from_hex('{0}') || encode(lower(trim(c_name)))))) as user_token from customer".format(*_pads())
)
def user_tokens(spark, sf_dir):
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet")
    return customers.select("c_custkey", user_token(F.col("c_name"), KEY).alias("user_token"))


@query(
    "select family, owner, 'engagement_event' as contract, lateness_minutes, concat(family, '-', lpad(cast(i as varchar), 2, '0')) as source_id from ("
    + " union all ".join(f"select '{f}' as family, '{o}' as owner, {m} as lateness_minutes, unnest(range(1, {n + 1})) as i" for f, n, o, m in M.FAMILIES)
    + ")"
)
def source_registry(spark, sf_dir):
    rows = spark.createDataFrame(list(M.FAMILIES), "family string, n int, owner string, lateness_minutes int")
    numbered = rows.withColumn("i", F.explode(F.sequence(F.lit(1), F.col("n"))))
    return numbered.select(
        "family", "owner", F.lit("engagement_event").alias("contract"), "lateness_minutes",
        F.concat_ws("-", "family", F.lpad(F.col("i").cast("string"), 2, "0")).alias("source_id"),
    )


#: Remainders of the event number by 29, with the fault that the payload gets and the reason that it is to give.
FAULTS = {
    1: ("not_object", "payload_not_object"), 2: ("cookie", "prohibited_fields:cookie"), 3: ("extra", "contract_fields"),
    4: ("missing", "contract_fields"), 5: ("version", "schema_version"), 6: ("event_id", "invalid_event_id"),
    7: ("unknown", "unknown_source"), 8: ("type", "invalid_enum"), 9: ("user", "invalid_user_id"),
    10: ("time", "invalid_event_time"), 11: ("naive", "timezone_required:event_time"), 12: ("arrival", "timezone_required:arrival_time"),
    13: ("number", "invalid_event_id"), 14: ("nested", "prohibited_fields:cvv,password"), 15: ("escaped", "prohibited_fields:cookie"),
}


def _payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Producer events as JSON text, with the faults of FAULTS by event number."""
    n = F.col("event_id")
    fault = n % 29
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    names = {k: v[0] for k, v in FAULTS.items()}

    def when(name: str, value: str, otherwise):
        hit = fault.isin([k for k, v in names.items() if v == name])
        return F.when(hit, value).otherwise(otherwise)

    def pair(key: str, value) -> F.Column:
        return F.concat(F.lit(f'"{key}":"'), value, F.lit('"'))

    time = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    parts = [
        pair("schema_version", when("version", "2.0", F.lit("1.0"))),
        when("number", '"event_id":5', pair("event_id", when("event_id", "a b", F.concat(F.lit("evt-"), n.cast("string"))))),
        pair("source_id", when("unknown", "web-99", F.lit("web-01"))),
        pair("user_id", when("user", "", F.concat(F.lit("user-"), F.col("user_id").cast("string")))),
        when("missing", '"page_id":"p"', pair("event_type", when("type", "click", F.lit("search")))),
        pair("event_time", F.concat(when("time", "yesterday", time), when("naive", "", F.lit("Z")))),
        pair("arrival_time", F.concat(time, when("arrival", "", F.lit("+05:30")))),
        pair("consent_state", F.lit("analytics_allowed")),
    ]
    more = (
        F.when(fault == 2, ',"context":{"Cookie":"secret"}').when(fault == 3, ',"extra":1')
        .when(fault == 14, ',"a":[{"password":1},{"b":{"CVV":"2"}}]').when(fault == 15, ',"\\u0063ookie":"x"').otherwise("")
    )
    text = F.concat(F.lit("{"), F.concat_ws(",", *parts), more, F.lit("}"))
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.select(n.alias("n"), F.when(fault == 1, F.lit("[1, 2]")).otherwise(text).alias("raw_json"))


#: The same payloads in the other engine's SQL.
_PAYLOAD_SQL = """
made as (select event_id as n, event_id % 29 as f, strftime(ts, '%Y-%m-%dT%H:%M:%S') as t, user_id from events),
payload as (select n, f, case when f = 1 then '[1, 2]' else concat('{',
  '"schema_version":"', case when f = 5 then '2.0' else '1.0' end, '",',
  case when f = 13 then '"event_id":5' else concat('"event_id":"', case when f = 6 then 'a b' else concat('evt-', n) end, '"') end,
  ',"source_id":"', case when f = 7 then 'web-99' else 'web-01' end, '","user_id":"', case when f = 9 then '' else concat('user-', user_id) end, '",',
  case when f = 4 then '"page_id":"p"' else concat('"event_type":"', case when f = 8 then 'click' else 'search' end, '"') end,
  ',"event_time":"', case when f = 10 then 'yesterday' else t end, case when f = 11 then '' else 'Z' end,
  '","arrival_time":"', t, case when f = 12 then '' else '+05:30' end, '","consent_state":"analytics_allowed"',
  case f when 2 then ',"context":{"Cookie":"secret"}' when 3 then ',"extra":1' when 14 then ',"a":[{"password":1},{"b":{"CVV":"2"}}]'
    when 15 then concat(',"', chr(92), 'u0063ookie":"x"') else '' end, '}') end as raw_json from made)"""
_KNOWN = "[" + ", ".join(f"'{k}'" for k in (*M.REQUIRED, *M.OPTIONAL)) + "]"
_NEEDED = "[" + ", ".join(f"'{k}'" for k in M.REQUIRED) + "]"
_BANNED = "[" + ", ".join(f"'{k}'" for k in M.PROHIBITED) + "]"
#: Reasons from the JSON itself: its keys at any depth, its fields and their types.
_REASON_SQL = f"""{_PAYLOAD_SQL},
tree as (select distinct n, lower(t.key) as key from payload, json_tree(raw_json) as t where t.key is not null and raw_json[1] = '{{'),
banned as (select n, string_agg(key, ',' order by key) as keys from tree where list_contains({_BANNED}, key) group by n),
read as (select payload.*, banned.keys as banned, json_keys(raw_json) as keys,
  {", ".join(f"case when json_type(raw_json, '$.{k}') = 'VARCHAR' then json_extract_string(raw_json, '$.{k}') end as {k}" for k in M.REQUIRED)}
  from payload left join banned using (n)),
reasons as (select *, case
  when json_type(raw_json) <> 'OBJECT' then 'payload_not_object'
  when banned is not null then concat('prohibited_fields:', banned)
  when len(list_filter(keys, lambda k: not list_contains({_KNOWN}, k))) > 0 or not list_has_all(keys, {_NEEDED}) then 'contract_fields'
  when schema_version is distinct from '1.0' then 'schema_version'
  when event_id is null or not regexp_full_match(event_id, '[A-Za-z0-9._:-]{{1,128}}') then 'invalid_event_id'
  when source_id is null or not regexp_full_match(source_id, '[A-Za-z0-9._:-]{{1,128}}') then 'invalid_source_id'
  when not list_contains([{", ".join(f"'{x}'" for x in M.source_ids())}], source_id) then 'unknown_source'
  when event_type is null or event_type not in {M.EVENT_TYPES} or consent_state is null or consent_state not in {M.CONSENT_STATES} then 'invalid_enum'
  when user_id is null or user_id = '' then 'invalid_user_id'
  when try_cast(event_time as timestamptz) is null then 'invalid_event_time'
  when not regexp_matches(event_time, '{M.ZONE}') then 'timezone_required:event_time'
  when try_cast(arrival_time as timestamptz) is null then 'invalid_arrival_time'
  when not regexp_matches(arrival_time, '{M.ZONE}') then 'timezone_required:arrival_time' end as reason from read)"""


@query(f"with {_REASON_SQL} select n, reason from reasons")
def contract_reasons(spark, sf_dir):
    return _payloads(spark, sf_dir).select("n", producer_reason(F.col("raw_json")).alias("reason"))


@query(
    f"""with {_PAYLOAD_SQL}, keys as (select n, list_filter(json_keys(raw_json), lambda k: not list_contains({_KNOWN}, k)) as k from payload where f <> 1)
    select n, case when len(k) > 0 then array_to_string(k, ',') end as unknown from keys"""
)
def unknown_fields(spark, sf_dir):
    found = unknown_keys(F.col("raw_json"), (*M.REQUIRED, *M.OPTIONAL))
    rows = _payloads(spark, sf_dir).where("n % 29 <> 1")
    return rows.select("n", F.when(F.size(found) > 0, F.array_join(found, ",")).alias("unknown"))


_REDACTED_SQL = """concat('{', case when f = 14 then '"a":[{"password":"<redacted>"},{"b":{"CVV":"<redacted>"}}],' else '' end,
  '"arrival_time":"', arrival_time, '","consent_state":"analytics_allowed"', case f when 2 then ',"context":{"Cookie":"<redacted>"}'
  when 15 then ',"cookie":"<redacted>"' else '' end, ',"event_id":', case when f = 13 then '5' else concat('"', event_id, '"') end,
  ',"event_time":"', event_time, '"', case when f = 4 then '' else concat(',"event_type":"', event_type, '"') end, case when f = 3 then ',"extra":1' else '' end,
  case when f = 4 then ',"page_id":"p"' else '' end, ',"schema_version":"', schema_version, '","source_id":"', source_id, '","user_id":"<redacted>"}')"""


@query(
    f"""with {_REASON_SQL} select n, reason, sha256(raw_json) as payload_sha256, case when f = 1 then '[1,2]' else {_REDACTED_SQL} end as redacted
    from reasons where reason is not null"""
)
def redacted_quarantine(spark, sf_dir):
    """Rejected producer events, redacted, with the digest of what was received."""
    rows = _payloads(spark, sf_dir).withColumn("reason", producer_reason(F.col("raw_json"))).where("reason is not null")
    return rows.select("n", "reason", F.sha2("raw_json", 256).alias("payload_sha256"), redacted("raw_json").alias("redacted"))


@query("select event_id as n, event_id % 29 between 1 and 8 as invalid from events")
def gateway_contract(spark, sf_dir):
    """The gateway's check: a user token in place of the user id, on the raw text's own time zones."""
    n = F.col("event_id")
    fault = n % 29
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    token = F.sha2(F.col("user_id").cast("string"), 256)
    time = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    text = F.format_string(
        '{"schema_version":"%s","event_id":"evt-%d","source_id":"%s","user_token":"%s","event_type":"%s","event_time":"%s%s",'
        '"arrival_time":"%s+05:30","consent_state":"%s"%s}',
        F.when(fault == 1, "2.0").otherwise("1.0"), n, F.when(fault == 2, "web-99").otherwise("web-01"),
        F.when(fault == 3, "x").otherwise(token), F.when(fault == 4, "click").otherwise("search"), time,
        F.when(fault == 5, "").otherwise("Z"), F.when(fault == 6, "soon").otherwise(time),
        F.when(fault == 7, "maybe").otherwise("essential_only"), F.when(fault == 8, ',"page_id":{"cvv":"1"}').otherwise(""),
    )
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").select(n.alias("n"), text.alias("raw_json"))
    return decode_gateway(rows).select("n", gateway_invalid().alias("invalid"))


@query(f"with {_LIVE} select {', '.join(metrics.STAGED)} from cur where consent_state = 'analytics_allowed'")
def stg_engagement_event(spark, sf_dir):
    return metrics.staged(_curated(spark, sf_dir))


_MART = """select cast(event_time as date) as event_date, event_type, count(*) as event_count, count(distinct user_token) as unique_users,
  max(arrival_time) as data_fresh_through from cur where consent_state = 'analytics_allowed' {where} group by 1, 2"""


@query(f"with {_LIVE} {_MART.format(where='')}")
def mart_daily(spark, sf_dir):
    return metrics.mart_daily(metrics.staged(_curated(spark, sf_dir)))


@query(
    f"""with {_REPLAY}, live as ({_MART.format(where="and not beyond_watermark and event_time < timestamp '2024-01-20'")}),
    fresh as ({_MART.format(where="and cast(event_time as date) >= (select max(event_date) - 3 from live)")})
    select * from fresh union all select * from live where (event_date, event_type) not in (select (event_date, event_type) from fresh)"""
)
def mart_incremental(spark, sf_dir):
    """The mart of the live events before 2024-01-20, brought up to date from all accepted events."""
    accepted = _classified(spark, sf_dir).where("outcome = 'ACCEPTED'").select(*G.CURATED).persist()  # read three times
    before = metrics.mart_daily(metrics.staged(accepted.where("not beyond_watermark and event_time < timestamp '2024-01-20'")))
    return metrics.mart_incremental(metrics.staged(accepted), before)


_DQ = ("event_id", "user_token", "event_time", "page_id", "campaign_id")


@query(f"with {_LIVE} " + " union all ".join(f"select '{c}' as column_name, count(*) - count({c}) as null_rows from cur" for c in _DQ))
def dq_not_null(spark, sf_dir):
    return metrics.dq_not_null(_curated(spark, sf_dir), list(_DQ))


@query(f"with {ENVELOPE_SQL} select event_id as value, count(*) as n from env group by 1 having count(*) > 1")
def dq_unique(spark, sf_dir):
    return metrics.dq_unique(envelopes(spark, sf_dir), "event_id")


@query(f"with {_REPLAY} select event_id, event_time from cur where beyond_watermark")
def live_vs_replay_delta(spark, sf_dir):
    replay = _curated(spark, sf_dir, "REPLAY")
    return replay.join(_curated(spark, sf_dir).select("event_id"), "event_id", "left_anti").select("event_id", "event_time")


@query(
    f"""with {_LIVE}{_DAILY_TAIL} select (select count(*) from cur) as curated_events, (select count(*) from ses) as sessions,
    (select count(*) from daily) as aggregates, (select count(*) from ident where outcome = 'CONFLICT' or (outcome = 'ACCEPTED' and beyond_watermark)) as corrections,
    (select count(*) from ident where outcome = 'DUPLICATE') as duplicates"""
)
def manifest_counts(spark, sf_dir):
    made = G.build(envelopes(spark, sf_dir), "LIVE")
    names = ("curated_events", "sessions", "aggregates", "corrections")
    counts = [t.agg(F.count(F.lit(1)).alias("n")).withColumn("k", F.lit(k)) for k, t in zip(names, made.tables().values(), strict=True)]
    counts.append(made.classified.agg(F.count_if(F.col("outcome") == "DUPLICATE").alias("n")).withColumn("k", F.lit("duplicates")))
    together = counts[0]
    for c in counts[1:]:
        together = together.unionByName(c)
    return together.agg(*[F.max(F.when(F.col("k") == k, F.col("n"))).alias(k) for k in (*names, "duplicates")])


@query(f"with {_IDENTITY} select count(*) = count_if(outcome = 'ACCEPTED' and not beyond_watermark) + count_if(outcome = 'ACCEPTED' and beyond_watermark) + count_if(outcome = 'DUPLICATE') + count_if(outcome = 'CONFLICT') as conserved, count(*) as arrivals from ident")
def conservation(spark, sf_dir):
    rows = _classified(spark, sf_dir)
    outcome = ingestion_outcome()
    kinds = ("ACCEPTED_LIVE", "ACCEPTED_LATE", "DUPLICATE", "QUARANTINED")
    total = sum((F.count_if(outcome == k) for k in kinds), F.lit(0))
    return rows.agg((F.count(F.lit(1)) == total).alias("conserved"), F.count(F.lit(1)).alias("arrivals"))


@query(
    """select i % 24 as partition, count(*) + case i % 24 when 17 then 2 when 23 then 1 when 7 then 1 when 3 then 1 when 0 then 1 else 0 end as n
    from (select unnest(range(0, 5000)) as i) group by i % 24"""
)
def generated_events(spark, sf_dir):
    """Rows by partition of the generator's 5,000 events and six faults."""
    return generated(spark, 5000).groupBy("partition").agg(F.count(F.lit(1)).alias("n"))


def _scratch(spark: SparkSession, label: str) -> str:
    """A new folder in the shared space that the session names; a temporary one where none is set, as in tests."""
    base = spark.conf.get("spark.checkpoint.dir", None) or f"file://{tempfile.mkdtemp(prefix='tidemark-')}"
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def _gateway_payload() -> F.Column:
    """The envelope's event as a gateway's JSON text."""
    shown = {c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'") for c in ("event_time", "arrival_time")}
    return F.to_json(F.struct(*[shown.get(c, F.col(c)).alias(c) for c in (*M.GATEWAY_REQUIRED, *M.OPTIONAL)]))


@query("select cast(0 as int) as kafka_partition, cast(0 as bigint) as kafka_offset, '' as event_id where false")
def stream_equals_batch(spark, sf_dir):
    """Rows in which the streamed and the batch classification of the generated events differ: none."""
    from tidemark.streaming.ingest import file_source, start

    root = _scratch(spark, "stream")
    made = generated(spark, 2000)
    token = F.sha2(F.get_json_object("payload", "$.user_id"), 256)
    gateway = F.concat(
        F.lit('{"user_token":"'), token, F.lit('",'), F.substring(F.regexp_replace("payload", '"user_id":"[^"]*",', ""), 2, 100_000)
    )
    gateway = made.withColumn("payload", gateway)
    gateway.repartition(6).write.json(f"{root}/in")
    start(file_source(spark, f"{root}/in", 2), f"{root}/bronze", f"{root}/quarantine", f"{root}/state", available_now=True).awaitTermination()
    streamed = spark.read.parquet(f"{root}/bronze").select("kafka_partition", "kafka_offset", "event_id")
    rows = gateway.select(F.col("partition").alias("kafka_partition"), F.col("offset").alias("kafka_offset"), F.col("payload").alias("raw_json"))
    batch = decode_gateway(rows).where(~gateway_invalid()).select("kafka_partition", "kafka_offset", "event_id")
    return streamed.exceptAll(batch).unionByName(batch.exceptAll(streamed))


@query(f"with {_IDENTITY} select kafka_partition, kafka_offset, event_id, beyond_watermark, outcome from ident")
def stream_gate(spark, sf_dir):
    """All envelopes through the streamed gate in three micro-batches: the same as in one batch."""
    from tidemark.streaming.gate import start_gate
    from tidemark.streaming.ingest import file_source

    root = _scratch(spark, "gate")
    rows = envelopes(spark, sf_dir).select(F.col("kafka_partition").alias("partition"), F.col("kafka_offset").alias("offset"), _gateway_payload().alias("payload"))
    rows.write.parquet(f"{root}/rows")
    rows = spark.read.parquet(f"{root}/rows")
    third = rows.agg(F.max("offset")).first()[0] // 3 + 1
    for k in range(3):
        rows.where(F.floor(F.col("offset") / third) == k).write.mode("append").json(f"{root}/in")
        start_gate(file_source(spark, f"{root}/in", 10_000), f"{root}/out", f"{root}/state").awaitTermination()
    found = spark.read.option("basePath", f"{root}/out/classified").parquet(f"{root}/out/classified")
    return found.select("kafka_partition", "kafka_offset", "event_id", "beyond_watermark", "outcome")


@query(f"with {ENVELOPE_SQL} select kafka_partition, kafka_offset, event_id, event_time, page_id, campaign_id from env where source_id <> 'ios-01'")
def stream_bronze(spark, sf_dir):
    """What the streamed ingestion takes into bronze when one source has a wrong schema version."""
    return _ingested(spark, sf_dir, "bronze").select("kafka_partition", "kafka_offset", "event_id", "event_time", "page_id", "campaign_id")


@query(f"with {ENVELOPE_SQL} select kafka_partition, kafka_offset, 'gateway_contract_invalid' as reason from env where source_id = 'ios-01'")
def stream_quarantine(spark, sf_dir):
    return _ingested(spark, sf_dir, "quarantine").select("kafka_partition", "kafka_offset", "reason")


def _ingested(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    from tidemark.streaming.ingest import file_source, start

    root = _scratch(spark, "ingest")
    rows = envelopes(spark, sf_dir).withColumn("schema_version", F.when(F.col("source_id") == "ios-01", "0.9").otherwise(F.col("schema_version")))
    rows.select(F.col("kafka_partition").alias("partition"), F.col("kafka_offset").alias("offset"), _gateway_payload().alias("payload")).write.json(f"{root}/in")
    start(file_source(spark, f"{root}/in"), f"{root}/bronze", f"{root}/quarantine", f"{root}/state", available_now=True).awaitTermination()
    return spark.read.parquet(f"{root}/{table}")


@query(f"with {ENVELOPE_SQL} select kafka_partition, kafka_offset, event_id from env")
def segments_round_trip(spark, sf_dir):
    """All envelopes written as checksummed JSONL segments and read back."""
    root = _scratch(spark, "segments")
    rows = envelopes(spark, sf_dir).select(F.col("kafka_partition").alias("partition"), F.col("kafka_offset").alias("offset"), F.to_json(F.struct(_gateway_payload().alias("p"))).alias("payload"))
    found = read_segments(spark, root, write_segments(rows, root))
    event_id = F.get_json_object(F.get_json_object("raw_json", "$.p"), "$.event_id")
    return found.select("kafka_partition", "kafka_offset", event_id.alias("event_id"))


def _published(spark: SparkSession, sf_dir: str) -> tuple[str, PointerLog]:
    """A LIVE generation of all envelopes and the REPLAY of it, both published."""
    root = _scratch(spark, "lake")
    bronze = envelopes(spark, sf_dir).persist()
    whole, log = source_manifest(bronze, "a" * 64), PointerLog(f"{root}/log")
    live = build_register_publish(spark, root, log, "live", whole, "LIVE", bronze)
    build_register_publish(spark, root, log, "replay", whole, "REPLAY", bronze, parent=live)
    bronze.unpersist()
    return f"{root}/lake", log


@query(f"with {_REPLAY} select * from cur where event_time >= timestamp '2024-01-15'")
def snapshot_scan(spark, sf_dir):
    """Curated events of the published generation from a day on; only that day's partitions and later ones are read."""
    lake, log = _published(spark, sf_dir)
    return snapshot(spark, lake, "curated_event", log.active().snapshots["curated_event"], since="2024-01-15")


@query(f"with {_LIVE}{_SESSION_TAIL} select * from ses")
def snapshot_of_parent(spark, sf_dir):
    """Sessions of the generation before the published one, by its own snapshot."""
    lake, log = _published(spark, sf_dir)
    return snapshot(spark, lake, "session_version", log.manifest(log.active().parent_generation_id).snapshots["session_version"])


@query(
    "select * from (values ('live', null, 'LIVE', 1), ('replay', 'live', 'REPLAY', 2)) as g(generation_id, parent_generation_id, mode, version), "
    f"(select 'PUBLISHED' as status), (select unnest({list(M.SNAPSHOT_TABLES)}) as \"table\")"
)
def generation_history(spark, sf_dir):
    """The publication log as a table."""
    return _published(spark, sf_dir)[1].history(spark).drop("snapshot_id")


@query("select event_type, date_trunc('hour', ts) as start, date_trunc('hour', ts) + interval 1 hour as \"end\", count(*) as n from (select case event_type when 'view' then 'page_view' else 'other' end as event_type, ts from events) group by 1, 2")
def tumbling_counts(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    rows = events.select(F.when(F.col("event_type") == "view", "page_view").otherwise("other").alias("event_type"), F.col("ts").cast("timestamp").alias("event_time"))
    return metrics.windowed_counts(rows, "1 hour")


@query(
    """select event_type, start, start + interval 1 day as "end", count(*) as n from (select case event_type when 'view' then 'page_view' else 'other' end as event_type,
    unnest([time_bucket(interval 6 hour, ts) - k * interval 6 hour for k in range(4)]) as start from events) group by 1, 2"""
)
def sliding_counts(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    rows = events.select(F.when(F.col("event_type") == "view", "page_view").otherwise("other").alias("event_type"), F.col("ts").cast("timestamp").alias("event_time"))
    return metrics.windowed_counts(rows, "1 day", "6 hours")


@query(f"with {ENVELOPE_SQL} select kafka_partition, row_number() over (partition by kafka_partition order by event_time, event_id, kafka_offset) as place, event_id, kafka_offset from env")
def ordered_events(spark, sf_dir):
    """The place of each event in its partition's order of time, by a range sort and not by one task a partition."""
    return metrics.places(envelopes(spark, sf_dir), "kafka_partition", ["event_time", "event_id", "kafka_offset"]).select("kafka_partition", "place", "event_id", "kafka_offset")


@query(
    f"""with {ENVELOPE_SQL}, p as (select kafka_partition as "partition", min(kafka_offset) as start_offset, 999 as last, max(kafka_offset) as end_offset from env group by 1)
    select "partition", start_offset, end_offset from p"""
)
def frontier_advance(spark, sf_dir):
    """The frontier of a generation from offset 1,000 on, on top of the one before."""
    events = envelopes(spark, sf_dir).persist()
    ranges = lambda rows: source_manifest(rows, "a" * 64)["ranges"]
    whole = advance_frontier(ranges(events.where("kafka_offset >= 1000")), ranges(events.where("kafka_offset < 1000")), "LIVE")
    events.unpersist()
    return spark.createDataFrame([tuple(r.values()) for r in whole], "partition int, start_offset long, end_offset long")


_INVARIANTS = (
    "fifty_sources", "registry_document_reads_back", "rules_document_reads_back", "four_snapshot_tables", "every_arrival_is_counted_once",
    "outcomes_are_those_planted", "three_rows_break_the_contract", "live_leaves_late_events_out", "live_is_published",
    "building_again_gives_the_same", "stale_parent_is_refused", "replay_takes_late_events_in", "replay_resolves_them",
    "conflicts_stay_open", "replay_keeps_the_frontier", "replay_is_published",
)


@query(f"select unnest({list(_INVARIANTS)}) as name, true as holds")
def evidence_run(spark, sf_dir):
    """The engine's invariants on 1,000 generated events and the six faults among them."""
    found = evidence.run(spark, _scratch(spark, "evidence"), 1000)
    return spark.createDataFrame(list(found.items()), "name string, holds boolean")


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
