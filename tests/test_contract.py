import hashlib
import hmac
import json

import pytest
from pyspark.sql import functions as F

from tidemark import model as M
from tidemark.functions.contract import decode_gateway, gateway_invalid, producer_reason, prohibited_keys, redacted
from tidemark.functions.tokens import user_token

GOOD = {
    "schema_version": "1.0", "event_id": "e1", "source_id": "web-01", "user_id": "User-1", "event_type": "search",
    "event_time": "2026-06-01T00:00:00+05:30", "arrival_time": "2026-06-01T00:00:01Z", "consent_state": "analytics_allowed",
}
CASES = [
    (GOOD, None),
    (GOOD | {"page_id": None}, None),
    ([1], "payload_not_object"),
    (GOOD | {"x": {"Access_Token": 1}, "cookie": 2}, "prohibited_fields:access_token,cookie"),
    (GOOD | {"x": 1}, "contract_fields"),
    ({k: v for k, v in GOOD.items() if k != "event_type"}, "contract_fields"),
    (GOOD | {"schema_version": "2.0"}, "schema_version"),
    (GOOD | {"event_id": 5}, "invalid_event_id"),
    (GOOD | {"event_id": "a b"}, "invalid_event_id"),
    (GOOD | {"source_id": ""}, "invalid_source_id"),
    (GOOD | {"source_id": "web-13"}, "unknown_source"),
    (GOOD | {"event_type": "click"}, "invalid_enum"),
    (GOOD | {"user_id": ""}, "invalid_user_id"),
    (GOOD | {"event_time": "soon"}, "invalid_event_time"),
    (GOOD | {"event_time": "2026-06-31T00:00:00Z"}, "invalid_event_time"),
    (GOOD | {"event_time": "2026-06-01T00:00:00"}, "timezone_required:event_time"),
    (GOOD | {"arrival_time": "2026-06-01"}, "timezone_required:arrival_time"),
]


def test_reasons(spark):
    texts = [json.dumps(p) for p, _ in CASES] + ["not json", None, '{"\\u0063ookie": 1}', '{"a": "\\"cookie\\": x"}']
    want = [r for _, r in CASES] + ["payload_not_object", "payload_not_object", "prohibited_fields:cookie", "contract_fields"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, raw string")
    got = [r.reason for r in df.select("i", producer_reason(F.col("raw")).alias("reason")).orderBy("i").collect()]
    assert got == want
    short = df.where("i = 0").select(producer_reason(F.col("raw"), key_bytes=31).alias("reason"))
    assert short.first().reason == "token_key_too_short"


def test_all_spellings_of_prohibited_keys(spark):
    keys = ["Cookie", "coo\u212aie", "pa\u017fsword", "PA\u00dfWORD", "cvv", "refre\u017fh_token", "cooky", "xcookie", "pan "]
    texts = [json.dumps({"a": [{k: 1}]}, ensure_ascii=e) for k in keys for e in (True, False)]
    texts += ['{"\\u0043VC" : 1}', '{"a\\"pan": 1}', '{"a": "pan\\":"}', '{"a":"\\\\","cvc":1}', '{"authorization":1,"access\\u005Ftoken":2}']
    want = [[f] if (f := k.casefold()) in M.PROHIBITED else [] for k in keys for _ in (0, 1)]
    want += [["cvc"], [], [], ["cvc"], ["access_token", "authorization"]]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, raw string")
    found = df.select("i", prohibited_keys(F.col("raw")).alias("k")).orderBy("i")
    assert [r.k for r in found.collect()] == want
    assert "Python" not in found._jdf.queryExecution().toString()


def test_gateway(spark):
    good = {k: v for k, v in GOOD.items() if k != "user_id"} | {"user_token": "a" * 64}
    cases = [
        (good, False), (good | {"event_time": "2026-06-01T00:00:00"}, True), (good | {"user_token": "A" * 64}, True),
        (good | {"x": 1}, True), (good | {"page_id": {"pan": 1}}, True), (good | {"page_id": "p" * 200}, False),
    ]
    df = spark.createDataFrame([(i, 0, json.dumps(p)) for i, (p, _) in enumerate(cases)], "kafka_offset int, kafka_partition int, raw_json string")
    decoded = decode_gateway(df)
    got = decoded.select("kafka_offset", gateway_invalid().alias("bad"), gateway_invalid(strict_lengths=True).alias("strict")).orderBy("kafka_offset").collect()
    assert [r.bad for r in got] == [bad for _, bad in cases]
    assert [r.strict for r in got][-1] is True and [r.strict for r in got][0] is False


def test_token_and_redaction(spark):
    key = b"k" * 40
    users = ["Ann", " ann\t", "ÉVA", "", "x" * 300]
    df = spark.createDataFrame(list(enumerate(users)), "i int, u string")
    got = [r.t for r in df.select("i", user_token(F.col("u"), key).alias("t")).orderBy("i").collect()]
    assert got == [hmac.new(key, u.strip().lower().encode(), hashlib.sha256).hexdigest() for u in users]
    with pytest.raises(ValueError):
        user_token(F.col("u"), b"short")
    raw = spark.createDataFrame([('{"a":[{"Cookie":1}],"user_id":"u","b":2}',), ("oops",)], "raw string")
    assert [r[0] for r in raw.select(redacted("raw")).collect()] == ['{"a":[{"Cookie":"<redacted>"}],"b":2,"user_id":"<redacted>"}', None]
