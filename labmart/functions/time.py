"""Dates and timestamps without zone."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from labmart.functions.text import _col, tolerant

SENTINEL_YEAR = 1900
SENTINEL_MONTH = 1


def at_run(value: dt.datetime | Column | None) -> Column:
    """Load timestamp: the given instant, or the start of the query."""
    if value is None:
        return F.localtimestamp()
    if isinstance(value, Column):
        return value
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def as_of_date(value: dt.date | Column | None) -> Column:
    if value is None:
        return F.current_date()
    return value if isinstance(value, Column) else F.lit(value)


def year_or(c, default: int = SENTINEL_YEAR) -> Column:
    """Year of timestamp or date text; ``default`` when neither parses."""
    return F.coalesce(
        F.year(tolerant(c, "timestamp_ntz")), F.year(tolerant(c, "date")), F.lit(default)
    )


def month_or(c, default: int = SENTINEL_MONTH) -> Column:
    return F.coalesce(
        F.month(tolerant(c, "timestamp_ntz")), F.month(tolerant(c, "date")), F.lit(default)
    )


def first_date(sampling, result, report, as_of=None) -> Column:
    """Date of the first known time: sampling, result, report, then ``as_of``."""
    return F.coalesce(
        _col(sampling).cast("date"), _col(result).cast("date"), _col(report), as_of_date(as_of)
    )


def first_datetime(sampling, result, report, as_of=None) -> Column:
    last = F.localtimestamp() if as_of is None else as_of_date(as_of).cast("timestamp_ntz")
    return F.coalesce(_col(sampling), _col(result), _col(report).cast("timestamp_ntz"), last)
