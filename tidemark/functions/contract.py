"""The contract boundary: decoding, rejection reasons, redaction."""

from __future__ import annotations

import json
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import model as M


def _spelt(name: str) -> str:
    """A pattern of all ways to write a key that folds to this name: either case, escaped, or with the letters
    beyond ASCII that fold to its own (long s, Kelvin sign, sharp s)."""
    more = {"s": ("017f",), "k": ("212a",), "ss": ("00df", "1e9e")}

    def written(codes: tuple[str, ...]) -> list[str]:
        return [x for c in codes for x in (chr(int(c, 16)), rf"\\u{c}")]

    def letter(c: str) -> str:
        codes = {c.lower(), c.upper()}
        ways = [*sorted(codes), *(rf"\\u{ord(x):04x}" for x in sorted(codes)), *written(more.get(c, ()))]
        return "(?:" + "|".join(ways) + ")"

    out = "".join(map(letter, name))
    double = letter("s") * 2
    return out.replace(double, "(?:" + "|".join([double, *written(more["ss"])]) + ")")


def _key(names: tuple[str, ...]) -> str:
    """A pattern of a key of a JSON text: an opening quote is never escaped, and a colon follows the closing one."""
    return rf'(?i)(?<!\\)"(?:{"|".join(map(_spelt, names))})"\s*:'


def _redact(text: str | None) -> str | None:
    """The JSON text with values of sensitive keys replaced; other text that may hold any is dropped."""
    if text is None:
        return None

    def clean(value: object) -> object:
        if isinstance(value, dict):
            return {k: "<redacted>" if k.casefold() in M.SENSITIVE else clean(v) for k, v in value.items()}
        return [clean(v) for v in value] if isinstance(value, list) else value

    try:
        return M.canonical_json(clean(json.loads(text)))
    except (ValueError, RecursionError):
        return None


def redacted(texts: str | Column) -> Column:
    """Redacted JSON texts, in Arrow batches; for quarantined rows only."""
    return F.arrow_udf(lambda a: pa.array([_redact(x) for x in a.to_pylist()], pa.string()), T.StringType())(texts)


def prohibited_keys(raw: Column) -> Column:
    """Prohibited keys of a JSON text at any depth, sorted. One pattern finds the few texts that have any."""
    each = [F.when(raw.rlike(_key((name,))), name) for name in sorted(M.PROHIBITED)]
    none = F.expr("cast(array() as array<string>)")
    return F.when(raw.rlike(_key(M.PROHIBITED)), F.array_compact(F.array(*each))).otherwise(none)


def unknown_keys(raw: Column, allowed: tuple[str, ...]) -> Column:
    """Top-level keys that the contract doesn't name; null for what is no object."""
    return F.array_except(F.json_object_keys(raw), F.array(*[F.lit(k) for k in allowed]))


def _once(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is worked out once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _texts(raw: Column, fields: tuple[str, ...]) -> Column:
    """A struct of the top-level fields that are JSON strings; others are null. One parse."""
    parsed = F.from_json(raw, ", ".join(f"{f} variant" for f in fields))

    def strings(v: Column) -> Column:
        return F.struct(
            *[F.when(F.schema_of_variant(v[f]) == "STRING", F.try_variant_get(v[f], "$", "string")).alias(f) for f in fields]
        )

    return _once(parsed, strings)


_ISO = r"^\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}(?::\d{2}(?:\.\d{1,6})?)?)?(?:[zZ]|[+-]\d{2}:\d{2})?$"


def _time_reason(text: Column, field: str) -> Column:
    bad = text.isNull() | ~text.rlike(_ISO) | F.try_to_timestamp(text).isNull()
    return F.when(bad, f"invalid_{field}").when(~text.rlike(M.ZONE), f"timezone_required:{field}")


def producer_reason(raw: Column, key_bytes: int = 32, sources: list[str] | None = None) -> Column:
    """Why a producer's JSON text is rejected, the first reason in the contract's order; null if it isn't."""
    facts = F.struct(
        F.json_object_keys(raw).alias("keys"), _texts(raw, M.REQUIRED).alias("f"), prohibited_keys(raw).alias("prohibited")
    )
    return _once(facts, lambda s: _reason(s["keys"], s["f"], s["prohibited"], key_bytes, sources or M.source_ids()))


def _reason(keys: Column, field: Column, prohibited: Column, key_bytes: int, sources: list[str]) -> Column:
    names = lambda values: F.array(*[F.lit(v) for v in values])
    bad_keys = F.size(F.array_except(keys, names((*M.REQUIRED, *M.OPTIONAL)))) > 0
    bad_keys = bad_keys | (F.size(F.array_except(names(M.REQUIRED), keys)) > 0)

    def broken(name: str, pattern: str) -> Column:
        return field[name].isNull() | ~field[name].rlike(pattern)

    def not_in(name: str, values) -> Column:
        return field[name].isNull() | ~field[name].isin(*values)

    enums = not_in("event_type", M.EVENT_TYPES) | not_in("consent_state", M.CONSENT_STATES)
    chain = [
        F.when(keys.isNull(), "payload_not_object"),
        F.when(F.size(prohibited) > 0, F.concat(F.lit("prohibited_fields:"), F.array_join(prohibited, ","))),
        F.when(bad_keys, "contract_fields"),
        F.when(not_in("schema_version", (M.SCHEMA_VERSION,)), "schema_version"),
        F.when(broken("event_id", M.IDENTIFIER), "invalid_event_id"),
        F.when(broken("source_id", M.IDENTIFIER), "invalid_source_id"),
        F.when(not_in("source_id", sources), "unknown_source"),
        F.when(enums, "invalid_enum"),
        F.when(field["user_id"].isNull() | (field["user_id"] == ""), "invalid_user_id"),
        F.when(F.lit(key_bytes < 32), "token_key_too_short"),
        _time_reason(field["event_time"], "event_time"),
        _time_reason(field["arrival_time"], "arrival_time"),
    ]
    return F.coalesce(*chain)


def decode_gateway(envelopes: DataFrame) -> DataFrame:
    """Envelopes (kafka_partition, kafka_offset, raw_json, ...) with the gateway event's fields as strings."""
    return envelopes.withColumn("_event", F.from_json("raw_json", M.GATEWAY_EVENT)).select(
        *envelopes.columns, "_event.*"
    )


def gateway_invalid(sources: list[str] | None = None, strict_lengths: bool = False) -> Column:
    """Whether a decoded gateway event breaks the contract. The time zone is looked for in the raw text.

    strict_lengths holds optional ids to 128 characters. Secrets at any depth count too.
    """
    raw = F.col("raw_json")
    checks = [F.json_object_keys(raw).isNull(), *(F.col(f).isNull() for f in M.GATEWAY_REQUIRED)]
    checks += [
        F.size(unknown_keys(raw, (*M.GATEWAY_REQUIRED, *M.OPTIONAL))) > 0,
        F.size(prohibited_keys(raw)) > 0,
        F.col("schema_version") != M.SCHEMA_VERSION,
        ~F.col("event_id").rlike(M.IDENTIFIER),
        ~F.col("source_id").isin(*(sources or M.source_ids())),
        ~F.col("user_token").rlike(M.TOKEN),
        ~F.col("event_type").isin(*M.EVENT_TYPES),
        ~F.col("consent_state").isin(*M.CONSENT_STATES),
    ]
    for name in ("event_time", "arrival_time"):
        checks.append(~F.col(name).rlike(M.ZONE) | F.try_to_timestamp(name).isNull())
    if strict_lengths:
        checks += [F.length(f) > 128 for f in M.OPTIONAL]
    invalid = F.lit(False)
    for check in checks:
        invalid = invalid | F.coalesce(check, F.lit(False))
    return invalid


def parse_times(events: DataFrame) -> DataFrame:
    """Times of valid events as timestamps."""
    return events.withColumns({c: F.try_to_timestamp(c) for c in ("event_time", "arrival_time")})
