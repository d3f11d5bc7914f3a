"""Tolerant conversion of text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tolerant(c, type_name: str) -> Column:
    """Cast that gives NULL for a value that does not fit, whatever the ANSI setting."""
    return _col(c).try_cast(type_name)


def not_blank(c) -> Column:
    """True when the text holds something other than spaces; NULL counts as blank."""
    return F.coalesce(F.trim(_col(c)) != "", F.lit(False))


def is_blank(c) -> Column:
    return ~not_blank(c)


def yyyymmdd_or_iso_date(c) -> Column:
    """Date from ISO text or, as vocabulary exports write it, from ``yyyyMMdd``."""
    return F.coalesce(tolerant(c, "date"), F.try_to_date(_col(c), "yyyyMMdd"))
