"""Appending typed rows while keeping unreadable ones apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labmart.functions import not_blank, tolerant
from labmart.operators.bronze import bronze_typed, patient_rule
from labmart.schemas import BRONZE_CASTS, LAB_15


def reject_reason(keep_patients: str = "all") -> Column:
    """Raw columns whose text does not fit its type, and a patient_id the rule refuses; NULL when all fit."""
    failing = [
        F.when(not_blank(c) & tolerant(c, t).isNull(), F.lit(c)) for c, t in BRONZE_CASTS.items()
    ]
    failing.append(F.when(~patient_rule(keep_patients), F.lit("patient_id")))
    return F.nullif(F.concat_ws(",", *failing), F.lit(""))


def append_with_quarantine(
    raw: DataFrame, path: str, batch: str, run_ts=None, keep_patients: str = "not_nan"
) -> None:
    """Type the raw rows and append all of them in one pass.

    The table at ``path`` is partitioned by ``rejected`` (0 or 1). A rejected row keeps
    its original text as JSON with the names of the failing columns, a refused
    patient among them, so every row is in one of the two and the input is read
    once.
    """
    reason = reject_reason(keep_patients)
    texts = [c for c in LAB_15 if c in raw.columns]
    extra = (
        reason.alias("reject_reason"),
        F.when(reason.isNotNull(), F.to_json(F.struct(*texts))).alias("raw_record"),
        reason.isNotNull().cast("int").alias("rejected"),
    )
    rows = bronze_typed(raw, batch, run_ts, "all", extra=extra)
    rows.write.mode("append").partitionBy("rejected").parquet(path)


def accepted(spark: SparkSession, path: str) -> DataFrame:
    """Good rows; the filter prunes the other partition."""
    rows = spark.read.parquet(path).filter(F.col("rejected") == 0)
    return rows.drop("rejected", "reject_reason", "raw_record")


def quarantined(spark: SparkSession, path: str) -> DataFrame:
    """Rejected rows with reason and original text."""
    rows = spark.read.parquet(path).filter(F.col("rejected") == 1)
    return rows.select("reject_reason", "raw_record", "load_timestamp", "processing_batch")
