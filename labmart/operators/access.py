"""Common ways to read bronze so that its layout pays off."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Partition columns of a table, and the columns whose year and month they hold.
PARTITIONS = {
    ("year", "month"): ("sampling_datetime_utc",),
    ("measurement_year", "measurement_month"): ("measurement_date", "measurement_datetime"),
}


def time_range(
    df: DataFrame, start: dt.date, end: dt.date | None = None, c: str = "sampling_datetime_utc"
) -> DataFrame:
    """Rows timed on or after ``start`` and, if given, up to the instant ``end`` (midnight).

    If the table is partitioned by year and month of ``c``, the matching
    partition filter is added, which Spark cannot derive from the timestamp.
    Any other time column is filtered by itself.
    """
    low = F.lit(start.isoformat()).cast("timestamp_ntz")
    rows = df.filter(F.col(c) >= low)
    if end is not None:
        rows = rows.filter(F.col(c) <= F.lit(end.isoformat()).cast("timestamp_ntz"))
    for (year, month), timed in PARTITIONS.items():
        if c in timed and {year, month} <= set(df.columns):
            month_no = F.col(year) * 12 + F.col(month)
            rows = rows.filter(F.col(year) >= start.year)
            rows = rows.filter(month_no >= start.year * 12 + start.month)
            if end is not None:
                rows = rows.filter(F.col(year) <= end.year)
                rows = rows.filter(month_no <= end.year * 12 + end.month)
    return rows


def time_range_count(df: DataFrame, start: dt.date, end: dt.date | None = None) -> DataFrame:
    return time_range(df, start, end).agg(F.count(F.lit(1)).alias("rows"))


class Bucket(NamedTuple):
    """A partition column that holds ``hash(value) mod n``, see ``with_bucket_column``.

    ``value`` computes what is hashed from the patient id, if that is not the id itself.
    """

    column: str
    n: int
    value: Callable[[Column], Column] = lambda patient: patient

    def of(self, patient: Column) -> Column:
        return F.pmod(F.hash(self.value(patient)), F.lit(self.n))


def cohort_filter(df: DataFrame, patients, bucket: Bucket | None = None) -> DataFrame:
    """Rows of the given patients: a list of ids, or a frame with a ``patient_id`` column.

    A frame is left to Spark to broadcast or shuffle, by its size at run time.
    With ``bucket``, only the partitions that the patients' buckets name are
    read: the buckets of a list are constants of the plan, those of a frame
    join as a second key, from which Spark prunes at run time.
    """
    if isinstance(patients, DataFrame):
        cohort = patients.select("patient_id").distinct()
        if bucket is None:
            return df.join(cohort, "patient_id", "left_semi")
        own = cohort.withColumn(bucket.column, bucket.of(F.col("patient_id")))
        return df.join(own, ["patient_id", bucket.column], "left_semi")
    rows = df.filter(F.col("patient_id").isin(*patients))
    if bucket is None:
        return rows
    return rows.filter(F.col(bucket.column).isin(*[bucket.of(F.lit(p)) for p in dict.fromkeys(patients)]))


def code_filter(df: DataFrame, codes=None, like: str | None = None) -> DataFrame:
    """Rows whose test code is in a list and / or matches a LIKE pattern."""
    rows = df if codes is None else df.filter(F.col("measurement_source_value").isin(*codes))
    return rows if like is None else rows.filter(F.col("measurement_source_value").like(like))
