"""Hand-made laboratory rows that cover the edges."""

from labmart.schemas import LAB_27, text_schema

FULL = {
    "visit_id": "7",
    "patient_id": "12",
    "report_id": "55",
    "laboratory_uuid": "LAB-1",
    "measurement_source_value": "LC:0001",
    "sampling_datetime_utc": "2023-02-03 04:05:06",
    "result_datetime_utc": "2023-02-04 00:00:00",
    "normality": "Normal",
    "value_type": "NUMERIC",
    "value_as_number": "5.5",
    "unit_source_value": "mg/dL",
    "report_date_utc": "2023-02-05",
}


def raw(spark, *changes):
    """One 27-column text row per dict of changes to the full row."""
    records = [{**FULL, **change} for change in changes]
    return spark.createDataFrame(
        [tuple(r.get(c) for c in LAB_27) for r in records], text_schema(LAB_27)
    )
