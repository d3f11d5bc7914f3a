"""Raw text to typed bronze rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labmart.functions import (
    audit_hash,
    at_run,
    month_or,
    not_blank,
    omop_target_domain,
    person_hash64,
    pseudonym,
    quality_score,
    tolerant,
    value_qualifier,
    value_source_value,
    year_or,
)
from labmart.operators.rowid import global_row_id
from labmart.schemas import BRONZE_CASTS, LAB_15

# Columns the 27-column export lacks, and what stands in for them.
_STAND_INS = {"abnormal_flag": F.lit, "provider_id": F.col}
_STAND_IN_ARGUMENT = {"abnormal_flag": "", "provider_id": "report_id"}


def patient_rule(mode: str) -> Column:
    """True for a usable patient id, false otherwise, also for NULL.

    all: everything; nonblank: not NULL or empty; trimmed: not only spaces;
    with_visit: nonblank and a visit id; not_nan: nonblank and not the text nan.
    """
    patient = F.col("patient_id")
    rules = {
        "all": F.lit(True),
        "nonblank": patient != "",
        "trimmed": not_blank("patient_id"),
        "with_visit": (patient != "") & F.col("visit_id").isNotNull(),
        "not_nan": ~patient.isin("", "nan"),
    }
    return F.coalesce(rules[mode], F.lit(False))


def patient_filter(df: DataFrame, mode: str = "all") -> DataFrame:
    """Keep rows with a usable patient id; see ``patient_rule`` for the modes."""
    return df if mode == "all" else df.filter(patient_rule(mode))


def _raw_column(df: DataFrame, name: str) -> Column:
    if name in df.columns:
        return F.col(name)
    return _STAND_INS[name](_STAND_IN_ARGUMENT[name])


def bronze_typed(
    raw: DataFrame,
    batch: str | Column,
    run_ts=None,
    keep_patients: str = "all",
    strings: bool = False,
    partition_columns: bool = False,
    extra: tuple[Column, ...] = (),
) -> DataFrame:
    """Typed bronze rows from a 15- or 27-column scan.

    Casts are tolerant: a value that does not fit becomes NULL. ``strings``
    casts the visit id only. ``partition_columns`` adds year and month of the
    sampling time, taken from the text. A ``source_file`` column is kept, and
    ``extra`` columns over the raw text are added at the end.
    """
    casts = {"visit_id": BRONZE_CASTS["visit_id"]} if strings else BRONZE_CASTS
    columns = [F.col("source_file")] if "source_file" in raw.columns else []
    for name in LAB_15:
        source = _raw_column(raw, name)
        columns.append(
            (tolerant(source, casts[name]) if name in casts else source).alias(name)
        )
    if partition_columns:
        columns += [
            year_or("sampling_datetime_utc").alias("year"),
            month_or("sampling_datetime_utc").alias("month"),
        ]
    label = batch if isinstance(batch, Column) else F.lit(batch)
    columns += [at_run(run_ts).alias("load_timestamp"), label.alias("processing_batch"), *extra]
    return patient_filter(raw.select(*columns), keep_patients)


def with_partition_columns(df: DataFrame, c: str = "sampling_datetime_utc") -> DataFrame:
    """Add year and month of a time column; 1900 and 1 where it is missing or unreadable."""
    return df.withColumns({"year": year_or(c), "month": month_or(c)})


def bronze_enhanced(
    bronze: DataFrame, version: int = 5, salt: str | None = None, row_id: str | None = "measurement_id"
) -> DataFrame:
    """Bronze plus hashes, OMOP dates, value text, quality score and (optionally) row ids.

    Version 5 expects typed bronze, version 7 text bronze whose times look like
    ``yyyy-MM-dd HH:mm:ss``. Pass ``row_id=None`` to skip the numbering, which
    is the only part that shuffles; it numbers the bronze rows, from which the
    other columns are derived afterwards.
    """
    if row_id is None:
        return enhance(enhanced_rows(bronze, version), version, salt)
    rows = enhance(numbered_rows(bronze, version, row_id), version, salt)
    return rows.select(*[c for c in rows.columns if c != row_id], row_id)


def enhanced_rows(bronze: DataFrame, version: int) -> DataFrame:
    """Bronze rows that the enhanced table keeps."""
    if version not in (5, 7):
        raise ValueError("version must be 5 or 7")
    return bronze.filter(F.col("patient_id").isNotNull()) if version == 7 else bronze


def numbered_rows(bronze: DataFrame, version: int, row_id: str = "measurement_id") -> DataFrame:
    """Rows that the enhanced table keeps, numbered by time, patient and visit."""
    return global_row_id(enhanced_rows(bronze, version), ["sampling_datetime_utc", "patient_id", "visit_id"], row_id)


def sampling_parsed() -> Column:
    """Sampling time of a text bronze row."""
    return F.try_to_timestamp("sampling_datetime_utc", F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz")


def enhance(rows: DataFrame, version: int, salt: str | None = None) -> DataFrame:
    """The derived columns of the enhanced table; each depends on its own row only."""
    if version == 5:
        sampling = F.col("sampling_datetime_utc")
        return rows.withColumns(
            {
                "patient_id_hash": person_hash64("patient_id", salt),
                "person_id_hash": pseudonym("patient_id", salt),
                "measurement_date": sampling.cast("date"),
                "measurement_datetime": sampling,
                "visit_date": sampling.cast("date"),
                "value_source_value": value_source_value("value_as_string", "value_as_number"),
                "data_quality_score": quality_score(
                    "value_as_number", "unit_source_value", "value_as_string"
                ),
                "omop_target_domain": omop_target_domain("value_as_number", "value_as_string"),
                "value_qualifier": value_qualifier("normality", "abnormal_flag"),
                "gdpr_original_hash": audit_hash("patient_id", "visit_id", salt),
            }
        )
    parsed = sampling_parsed()
    return rows.withColumns(
        {
            "person_id_hash": person_hash64("patient_id", salt),
            "person_id_anonymized": pseudonym("patient_id", salt),
            "sampling_datetime_parsed": parsed,
            "measurement_year": F.year(parsed),
            "measurement_date": parsed.cast("date"),
            "value_as_number_parsed": tolerant("value_as_number", "double"),
            "value_source_value": value_source_value("value_as_string", "value_as_number"),
            "data_quality_score": quality_score(
                "value_as_number", "unit_source_value", "value_as_string", trimmed=True
            ),
        }
    )
