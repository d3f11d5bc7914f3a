"""Hashes that stand in for identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from labmart.functions.text import _col

_NON_NEGATIVE = 0x7FFFFFFFFFFFFFFF


def _salted(text: Column, salt: str | None) -> Column:
    return text if salt is None else F.concat(F.lit(salt), text)


def person_hash64(c, salt: str | None = None) -> Column:
    """Non-negative 64-bit hash; NULL stays NULL."""
    text = _col(c)
    hashed = F.xxhash64(_salted(text, salt)).bitwiseAND(F.lit(_NON_NEGATIVE))
    return F.when(text.isNotNull(), hashed)


def sha256_prefix(c, digits: int, salt: str | None = None) -> Column:
    """First ``digits`` upper-case hex digits of SHA-256."""
    return F.upper(F.substring(F.sha2(_salted(_col(c), salt), 256), 1, digits))


def pseudonym(c, salt: str | None = None) -> Column:
    return sha256_prefix(c, 32, salt)


def audit_hash(patient, visit, salt: str | None = None) -> Column:
    """16 hex digits over patient and visit; NULL if either is NULL."""
    return sha256_prefix(F.concat(_col(patient), _col(visit).cast("string")), 16, salt)
