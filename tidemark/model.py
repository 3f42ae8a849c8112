"""Fixed values, rules and small documents of the engagement model."""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import types as T

from tidemark.shapes import listed, one_of, require, shaped, text, whole

# Fixed values of the contract.
SCHEMA_VERSION = "1.0"
EVENT_TYPES = ("page_view", "search", "product_view", "add_to_cart", "checkout")
CONSENT_STATES = ("analytics_allowed", "essential_only")
PROHIBITED = ("password", "authorization", "access_token", "refresh_token", "cookie", "pan", "cvv", "cvc")
SENSITIVE = (*PROHIBITED, "user_id", "user_email")
REQUIRED = (
    "schema_version", "event_id", "source_id", "user_id", "event_type", "event_time", "arrival_time", "consent_state",
)
OPTIONAL = ("page_id", "campaign_id")
GATEWAY_REQUIRED = tuple("user_token" if f == "user_id" else f for f in REQUIRED)
IDENTIFIER = "^[A-Za-z0-9._:-]{1,128}$"
TOKEN = "^[a-f0-9]{64}$"
ZONE = "(?:[zZ]|[+-][0-9]{2}:[0-9]{2})$"
#: Family, instances, owner, lateness in minutes; every family has the contract engagement_event.
FAMILIES = (
    ("web", 12, "growth", 15),
    ("ios", 8, "mobile", 180),
    ("android", 8, "mobile", 180),
    ("backend", 10, "platform", 10),
    ("campaign", 6, "marketing", 60),
    ("partner", 6, "partnerships", 360),
)
SNAPSHOT_TABLES = ("curated_event", "session_version", "engagement_aggregate", "correction_exception")
LATE, CONFLICT = "beyond_live_watermark", "identity_payload_conflict"

#: Columns of the snapshot tables, and what each is partitioned by: a column, and how it is cut.
TABLES = {
    "curated_event": "kafka_partition int, kafka_offset long, schema_version string, event_id string, source_id string, "
    "user_token string, event_type string, event_time timestamp, arrival_time timestamp, consent_state string, "
    "page_id string, campaign_id string, beyond_watermark boolean, identity_sha256 string",
    "session_version": "session_id string, user_token string, started_at timestamp, ended_at timestamp, event_count long, "
    "first_event_id string, last_event_id string",
    "engagement_aggregate": "event_date date, event_type string, event_count long, unique_users long, sessions_started_on_date long",
    "correction_exception": "event_id string, identity_sha256 string, reason string, generation_mode string, status string, "
    "kafka_partition int, kafka_offset long",
}
LAYOUT = {
    "curated_event": ("event_time", "day", "source_id"),
    "session_version": ("started_at", "day", "user_token"),
    "engagement_aggregate": ("event_date", "month", None),
    "correction_exception": ("status", None, None),
}

GATEWAY_EVENT = T.StructType([T.StructField(f, T.StringType()) for f in (*GATEWAY_REQUIRED, *OPTIONAL)])


def canonical_json(value: object) -> str:
    """Sorted keys, no spaces, ASCII only: the text that is hashed."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=True)


def sha256_of(value: object) -> str:
    return hashlib.sha256(canonical_json(value).encode()).hexdigest()


RULES = {
    "version": whole(1), "session_gap_minutes": whole(1), "live_watermark_minutes": whole(1), "target_file_size_mib": whole(1),
    "required_snapshot_tables": listed(text(".+"), least=4, key=str),
}
FAMILY = {"family": text(".+"), "instances": whole(1), "owner": text(".*"), "contract": text(".*"), "lateness_minutes": whole(1)}
REGISTRY = {"version": one_of(1), "families": listed(shaped(FAMILY), key=lambda f: f["family"])}


@dataclass(frozen=True)
class Rules:
    """Session rules, version 3."""

    version: int = 3
    session_gap_minutes: int = 30
    live_watermark_minutes: int = 60
    target_file_size_mib: int = 384
    required_snapshot_tables: tuple[str, ...] = SNAPSHOT_TABLES

    def __post_init__(self):
        require(self.as_dict(), RULES, "session rules")

    @classmethod
    def parse(cls, document: object) -> Rules:
        """Rules from a document of the same fields."""
        require(document, RULES, "session rules")
        return cls(**document | {"required_snapshot_tables": tuple(document["required_snapshot_tables"])})

    def as_dict(self) -> dict:
        return {
            "version": self.version,
            "session_gap_minutes": self.session_gap_minutes,
            "live_watermark_minutes": self.live_watermark_minutes,
            "target_file_size_mib": self.target_file_size_mib,
            "required_snapshot_tables": list(self.required_snapshot_tables),
        }

    @property
    def sha256(self) -> str:
        return sha256_of(self.as_dict())


def source_ids(families: tuple = FAMILIES) -> list[str]:
    """Ids of all registered sources: the family and a two-digit number."""
    found = [f"{name}-{i:02d}" for name, n, _, _ in families for i in range(1, n + 1)]
    if not found or len(set(found)) != len(found):
        raise ValueError("sources must be registered, once each")
    return found


def registry_sha256(families: tuple = FAMILIES) -> str:
    return sha256_of({"version": 1, "families": [list(f) for f in families]})


def parse_registry(document: object) -> tuple:
    """Families (name, instances, owner, lateness in minutes) from a registry document."""
    require(document, REGISTRY, "source registry")
    families = tuple((f["family"], f["instances"], f["owner"], f["lateness_minutes"]) for f in document["families"])
    source_ids(families)
    return families


def registry_document(families: tuple = FAMILIES) -> dict:
    keys = ("family", "instances", "owner", "lateness_minutes")
    return {"version": 1, "families": [dict(zip(keys, f, strict=True)) | {"contract": "engagement_event"} for f in families]}


def contract_sha256() -> str:
    """Digest of what the contract fixes."""
    return sha256_of({
        "schema_version": SCHEMA_VERSION, "event_types": EVENT_TYPES, "consent_states": CONSENT_STATES, "prohibited": PROHIBITED,
        "required": REQUIRED, "optional": OPTIONAL, "identifier": IDENTIFIER, "token": TOKEN, "zone": ZONE,
    })


def implementation_sha256() -> str:
    """Digest of the engine's source files, by name."""
    root = Path(__file__).parent
    digest = hashlib.sha256()
    for path in sorted(root.rglob("*.py")):
        name = path.relative_to(root).as_posix()
        if not name.startswith("llm/"):
            body = path.read_bytes()
            digest.update(f"{name}:{len(body)}:".encode() + body)
    return digest.hexdigest()
