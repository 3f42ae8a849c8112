"""User tokens: HMAC-SHA256 as a SQL expression."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F


def user_token(user: Column, key: bytes) -> Column:
    """Lower-case hex HMAC-SHA256 of the user, without white space around it and in lower case."""
    if len(key) < 32:
        raise ValueError("token_key_too_short")
    if len(key) > 64:
        key = hashlib.sha256(key).digest()
    padded = key.ljust(64, b"\0")
    inner, outer = (F.lit(bytes(b ^ pad for b in padded)) for pad in (0x36, 0x5C))
    clean = F.lower(F.regexp_replace(user, r"^\s+|\s+$", ""))
    message = F.concat(inner, F.encode(clean, "UTF-8"))
    return F.sha2(F.concat(outer, F.unhex(F.sha2(message, 256))), 256)
