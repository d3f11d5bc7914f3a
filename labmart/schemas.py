"""Column layouts of the input files and the tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Header of the current laboratory export, in file order.
LAB_27 = (
    "visit_id",
    "visit_date_utc",
    "visit_rank",
    "patient_id",
    "report_id",
    "laboratory_uuid",
    "sub_laboratory_uuid",
    "site_laboratory_uuid",
    "measurement_source_value",
    "debug_external_test_id",
    "debug_external_test_scope",
    "sampling_datetime_utc",
    "sampling_datetime_timezone",
    "result_datetime_utc",
    "result_datetime_timezone",
    "normality",
    "value_type",
    "value_as_number",
    "unit_source_value",
    "internal_numerical_unit_system",
    "internal_numerical_reference_min",
    "internal_numerical_reference_max",
    "internal_categorical_qualification",
    "value_as_string",
    "bacterium_id",
    "range_type",
    "report_date_utc",
)

# Header of the older laboratory export; also the data columns of bronze.
LAB_15 = (
    "patient_id",
    "visit_id",
    "sampling_datetime_utc",
    "result_datetime_utc",
    "report_date_utc",
    "measurement_source_value",
    "value_as_number",
    "value_as_string",
    "unit_source_value",
    "normality",
    "abnormal_flag",
    "value_type",
    "bacterium_id",
    "provider_id",
    "laboratory_uuid",
)

LAB_LAYOUTS = {"27": LAB_27, "15": LAB_15}

# Headers of the vocabulary export files.
VOCAB_FILES = {
    "VOCABULARY.csv": (
        "vocabulary_id",
        "vocabulary_name",
        "vocabulary_reference",
        "vocabulary_version",
        "vocabulary_concept_id",
    ),
    "CONCEPT.csv": (
        "concept_id",
        "concept_name",
        "domain_id",
        "vocabulary_id",
        "concept_class_id",
        "standard_concept",
        "concept_code",
        "valid_start_date",
        "valid_end_date",
        "invalid_reason",
    ),
    "CONCEPT_RELATIONSHIP.csv": (
        "concept_id_1",
        "concept_id_2",
        "relationship_id",
        "valid_start_date",
        "valid_end_date",
        "invalid_reason",
    ),
    "DOMAIN.csv": ("domain_id", "domain_name", "domain_concept_id"),
}

CONCEPT_DDL = (
    "concept_id bigint, concept_name string, domain_id string, vocabulary_id string, "
    "concept_class_id string, standard_concept string, concept_code string, "
    "valid_start_date date, valid_end_date date, invalid_reason string"
)

CONCEPT_RELATIONSHIP_DDL = (
    "concept_id_1 bigint, concept_id_2 bigint, relationship_id string, "
    "valid_start_date date, valid_end_date date, invalid_reason string"
)

# Tolerant casts of the raw text columns; every other data column stays text.
BRONZE_CASTS = {
    "visit_id": "bigint",
    "sampling_datetime_utc": "timestamp_ntz",
    "result_datetime_utc": "timestamp_ntz",
    "report_date_utc": "date",
    "value_as_number": "double",
}


def text_schema(columns) -> T.StructType:
    """All columns as nullable text."""
    return T.StructType([T.StructField(name, T.StringType()) for name in columns])


def bronze_schema(source_file: bool = False) -> T.StructType:
    """Layout of an empty bronze table that batches are appended to."""
    fields = [T.StructField("source_file", T.StringType())] if source_file else []
    fields += [
        T.StructField(name, T._parse_datatype_string(BRONZE_CASTS.get(name, "string")))
        for name in LAB_15
    ]
    fields += [
        T.StructField("load_timestamp", T.TimestampNTZType()),
        T.StructField("processing_batch", T.StringType()),
    ]
    return T.StructType(fields)
