"""Keyed tokens built from native hashing, so no row ever leaves the JVM."""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import Column, functions as F

_BLOCK = 64


def key_from_environment(variable: str = "LEDGERSTONE_TOKEN_KEY") -> bytes:
    """The token key. It belongs in the environment, never in code or session settings."""
    value = os.environ.get(variable)
    if not value:
        raise RuntimeError(f"{variable} is not set")
    return value.encode("utf-8")


def _pad(key: bytes, byte: int) -> Column:
    block = (hashlib.sha256(key).digest() if len(key) > _BLOCK else key).ljust(_BLOCK, b"\0")
    return F.lit(bytearray(b ^ byte for b in block))


def hmac_sha256(message: Column, key: bytes) -> Column:
    """HMAC-SHA256 as lower-case hex. Plans of this expression reveal the key: do not log them."""
    inner = F.unhex(F.sha2(F.concat(_pad(key, 0x36), F.encode(message, "UTF-8")), 256))
    return F.sha2(F.concat(_pad(key, 0x5C), inner), 256)


def name_token(column: Column, key: bytes) -> Column:
    """Token of a name that ignores case and the amount of white space."""
    collapsed = F.trim(F.regexp_replace(F.lower(column.cast("string")), r"(?U)\s+", " "))
    return hmac_sha256(collapsed, key)
