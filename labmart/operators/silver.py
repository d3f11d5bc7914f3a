"""Bronze rows to OMOP CDM MEASUREMENT."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labmart import mappings
from labmart.functions import (
    categorical_flag,
    first_date,
    first_datetime,
    measurement_id,
    normality_concept,
    not_blank,
    tolerant,
    unit_concept,
)


def omop_rows(bronze: DataFrame) -> DataFrame:
    """Rows fit for OMOP: numeric patient id and a test code."""
    return bronze.filter(
        tolerant("patient_id", "bigint").isNotNull() & not_blank("measurement_source_value")
    )


def omop_measurement(
    bronze: DataFrame, unit_map: Mapping[str, int] | None = None, as_of=None
) -> DataFrame:
    """The 24-column MEASUREMENT table; one narrow stage, no shuffle.

    Concept ids of the test stay 0 until ``concept_backfill``. ``as_of`` dates
    rows without any time; it defaults to the run date.
    """
    times = ("sampling_datetime_utc", "result_datetime_utc", "report_date_utc")
    typed = omop_rows(bronze).withColumns(
        {
            times[0]: tolerant(times[0], "timestamp_ntz"),
            times[1]: tolerant(times[1], "timestamp_ntz"),
            times[2]: tolerant(times[2], "date"),
        }
    )
    day = first_date(*times, as_of)
    unit = unit_concept("unit_source_value", unit_map)

    def constant(value, type_name="int"):
        return F.lit(value).cast(type_name)

    columns = {
        "measurement_id": measurement_id(
            "patient_id", "laboratory_uuid", "measurement_source_value"
        ),
        "person_id": tolerant("patient_id", "bigint"),
        "measurement_concept_id": constant(0),
        "measurement_date": day,
        "measurement_datetime": first_datetime(*times, as_of),
        "measurement_type_concept_id": constant(mappings.LAB_RESULT_TYPE_CONCEPT),
        "operator_concept_id": constant(mappings.EQUALS_OPERATOR_CONCEPT),
        "value_as_number": tolerant("value_as_number", "double"),
        "value_as_concept_id": categorical_flag("value_as_string", "value_as_number"),
        "unit_concept_id": unit,
        "range_low": constant(None, "double"),
        "range_high": constant(None, "double"),
        "provider_id": tolerant("provider_id", "bigint"),
        "visit_occurrence_id": tolerant("visit_id", "bigint"),
        "visit_detail_id": constant(None, "bigint"),
        "measurement_source_value": F.col("measurement_source_value"),
        "measurement_source_concept_id": constant(0),
        "unit_source_value": F.col("unit_source_value"),
        "unit_source_concept_id": unit,
        "value_source_value": F.col("value_as_string"),
        "measurement_event_id": normality_concept("normality"),
        "meas_event_field_concept_id": constant(None, "bigint"),
        "measurement_year": F.year(day),
        "measurement_month": F.month(day),
    }
    return typed.select(*[column.alias(name) for name, column in columns.items()])
