"""One query per operator, each over whole tables, with the SQL that must agree."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labmart import functions as lf
from labmart.operators import access, audits, bronze, concepts, gold, vocabulary
from labmart.operators.rowid import global_row_id
from labmart.plans import (
    bronze_to_enhanced,
    bronze_to_silver,
    csv_to_bronze,
    enhanced_bucket,
    load_vocabularies,
    validate_silver,
)
from labmart.schemas import LAB_15, LAB_27, VOCAB_FILES
from labmart.session import new_scratch_path, store
from labmart.sinks import (
    accepted,
    append_with_quarantine,
    insert_missing,
    publish_version,
    published,
    quarantined,
    with_bucket_column,
    write_table,
)
from labmart.sources import (
    discover_files,
    filter_by_path,
    scan_glob,
    scan_lab,
    union_batches,
    validate_structure,
    vocab_file_check,
    volume_report,
    with_source_file,
)
from labmart.sinks.versions import publish_steps
from labmart.sources.vocab import separator_scores
from labmart.streaming import (
    batch_progress,
    committed,
    current_trends,
    ingest_stream,
    trend_stream,
)
from registry import adapter as at
from registry import sql
from registry.sql import compose

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, uses: str = "", body: str | None = None):
    def keep(fn: Query) -> Query:
        QUERIES[name] = fn
        if body is not None:
            ORACLE[name] = compose(uses, body)
        return fn

    return keep


def _list(names, prefix: str = "") -> str:
    return ", ".join(f"{prefix}{n}" for n in names)


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Sums of floating point numbers in another order differ in the last digits."""
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _database(spark: SparkSession, label: str) -> str:
    """A database of its own in the shared folder."""
    name = f"registry_{label}_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{new_scratch_path(spark, label)}'")
    return name


BRONZE = [*LAB_15, "load_timestamp", "processing_batch"]


# ---------------------------------------------------------------- scans


@register("scan_lab_27", "scanned", f"SELECT {_list(LAB_27)} FROM scanned")
def scan_lab_27(spark, sf):
    return at.scanned(spark, sf)


@register(
    "scan_lab_15",
    "scanned",
    f"SELECT {_list(c for c in LAB_15 if c not in ('abnormal_flag', 'provider_id', 'visit_id'))}, "
    "TRY_CAST(visit_id AS BIGINT) AS visit_id, CAST(NULL AS VARCHAR) AS abnormal_flag, "
    "report_id AS provider_id FROM scanned",
)
def scan_lab_15(spark, sf):
    rows = scan_lab(spark, at.lab_csv_15(spark, sf), layout="15")
    return rows.withColumn("visit_id", lf.tolerant("visit_id", "bigint"))


@register(
    "scan_lab_blank_as_empty",
    "lab",
    "SELECT " + ", ".join(f"COALESCE({c}, '') AS {c}" for c in LAB_27) + " FROM lab",
)
def scan_lab_blank_as_empty(spark, sf):
    return at.scanned(spark, sf, blank="empty")


@register("scan_glob", "scanned", f"SELECT {_list(LAB_27)} FROM scanned")
def scan_glob_query(spark, sf):
    folder = at.lab_csv(spark, sf)
    return scan_glob(spark, [f"{folder}/source=199[0-9]/*.csv", f"{folder}/source=20*/*.csv"])


@register("scan_vocab", "concept_text", "SELECT * FROM concept_text")
def scan_vocab_query(spark, sf):
    return at.vocab_scan(spark, sf, "CONCEPT.csv", ",")


@register(
    "filter_by_path",
    "scanned",
    f"SELECT {_list(LAB_27)} FROM scanned WHERE source = '1997'",
)
def filter_by_path_query(spark, sf):
    return filter_by_path(at.scanned(spark, sf), "%/source=1997/%")


@register(
    "source_file_lineage",
    "lab",
    "SELECT visit_id, patient_id, measurement_source_value, source AS source_file FROM lab",
)
def source_file_lineage(spark, sf):
    raw = with_source_file(at.scanned(spark, sf), pattern=at.SOURCE_PATTERN, group=1)
    return raw.select("visit_id", "patient_id", "measurement_source_value", "source_file")


@register(
    "discover_files",
    "lab",
    "SELECT DISTINCT source, true AS has_bytes, true AS all_csv FROM lab",
)
def discover_files_query(spark, sf):
    manifest = discover_files(spark, at.lab_csv(spark, sf))
    return manifest.groupBy(F.regexp_extract("path", at.SOURCE_PATTERN, 1).alias("source")).agg(
        (F.sum("size") > 0).alias("has_bytes"),
        F.bool_and(F.col("name").endswith(".csv")).alias("all_csv"),
    )


@register(
    "validate_structure",
    "lab",
    "SELECT DISTINCT source, 'PASSED' AS status_27, 'FAILED' AS status_15, "
    "'abnormal_flag,provider_id' AS missing_of_15 FROM lab",
)
def validate_structure_query(spark, sf):
    folder = at.lab_csv(spark, sf)
    current = validate_structure(spark, folder, LAB_27)
    older = validate_structure(spark, folder, LAB_15).select(
        "path", F.col("status").alias("old_status"), "missing_columns"
    )
    return (
        current.drop("missing_columns")
        .join(older, "path")
        .groupBy(F.regexp_extract("path", at.SOURCE_PATTERN, 1).alias("source"))
        .agg(
            F.max("status").alias("status_27"),
            F.max("old_status").alias("status_15"),
            F.max(F.concat_ws(",", "missing_columns")).alias("missing_of_15"),
        )
    )


@register(
    "volume_report",
    "",
    """
    WITH totals AS (SELECT COUNT(*) AS files_count,
        CAST(SUM(n_chars * 1000) AS DOUBLE) / 1048576.0 AS mb FROM documents),
      names AS (SELECT 'doc_' || CAST(doc_id AS VARCHAR) || '.csv' AS name FROM documents)
    SELECT files_count, ROUND(mb, 2) AS total_size_mb,
      CAST(TRUNC(mb * 10000) AS BIGINT) AS estimated_rows,
      CAST(TRUNC(mb * 10000 / 20) AS BIGINT) AS estimated_patients,
      GREATEST(5, CAST(TRUNC(mb / 20) AS BIGINT)) AS estimated_processing_time_minutes,
      LEAST(50000, GREATEST(10000, CAST(TRUNC(mb * 1000) AS BIGINT))) AS recommended_chunk_size,
      (SELECT STRING_AGG(name, ',' ORDER BY name)
       FROM (SELECT name FROM names ORDER BY name LIMIT 5)) AS first_files
    FROM totals
    """,
)
def volume_report_query(spark, sf):
    documents = at.table(spark, sf, "documents")
    manifest = documents.select(
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".csv")).alias("name"),
        (F.col("n_chars") * 1000).alias("size"),
    )
    return volume_report(manifest).withColumn("first_files", F.concat_ws(",", "first_files"))


@register(
    "detect_separator",
    "",
    "SELECT * FROM (VALUES ('tab', 'tab', true), ('tab', 'comma', false), "
    "('comma', 'tab', false), ('comma', 'comma', true)) AS t(files, tried, accepted)",
)
def detect_separator_query(spark, sf):
    scores = [
        separator_scores(spark, at.vocab_files(spark, sf, sep)).select(
            F.lit(name).alias("files"), F.col("sep_name").alias("tried"), "accepted"
        )
        for sep, name in (("\t", "tab"), (",", "comma"))
    ]
    return union_batches(scores)


@register(
    "vocab_file_check",
    "",
    "SELECT 'CONCEPT.csv' AS file, COUNT(*) AS total_rows, 'OK' AS status, true AS sized FROM part "
    "UNION ALL SELECT 'CONCEPT_RELATIONSHIP.csv', COUNT(*), 'OK', true FROM lineitem "
    "UNION ALL SELECT 'DOMAIN.csv', COUNT(*), 'OK', true FROM customer "
    "UNION ALL SELECT 'VOCABULARY.csv', COUNT(*), 'OK', true FROM supplier",
)
def vocab_file_check_query(spark, sf):
    return union_batches(
        [
            vocab_file_check(at.vocab_scan(spark, sf, file)).select(
                F.lit(file).alias("file"),
                "total_rows",
                "status",
                (
                    (F.col("min_file_size") > 0)
                    & (F.col("total_file_size") >= F.col("max_file_size"))
                ).alias("sized"),
            )
            for file in VOCAB_FILES
        ]
    )


def _streamed(spark, sf) -> DataFrame:
    target = new_scratch_path(spark, "stream")
    query = ingest_stream(
        spark,
        at.lab_csv(spark, sf) + "/*",
        f"{target}/data",
        f"{target}/checkpoint",
        files_per_batch=10,
        run_ts=at.RUN_TS,
        source_pattern=at.SOURCE_PATTERN,
        source_group=1,
    )
    query.awaitTermination()
    return spark.read.parquet(f"{target}/data")


@register(
    "batch_ingest",
    "loaded",
    f"SELECT {_list(LAB_15)}, load_timestamp, source AS source_file FROM loaded "
    "WHERE patient_id NOT IN ('', 'nan')",
)
def batch_ingest(spark, sf):
    return _streamed(spark, sf).drop("processing_batch")


@register(
    "batch_ingest_progress",
    "loaded",
    "SELECT COUNT(*) AS rows, true AS labelled FROM loaded WHERE patient_id NOT IN ('', 'nan')",
)
def batch_ingest_progress(spark, sf):
    progress = batch_progress(_streamed(spark, sf))
    return progress.agg(
        F.sum("rows").alias("rows"),
        F.bool_and(F.col("processing_batch").rlike("^batch_[0-9a-f]{32}_[0-9]+$")).alias("labelled"),
    )


@register(
    "batch_ingest_ledger",
    "loaded",
    f"SELECT {_list(LAB_15)}, load_timestamp, source AS source_file FROM loaded "
    "WHERE patient_id NOT IN ('', 'nan')",
)
def batch_ingest_ledger(spark, sf):
    """Two streams with checkpoints of their own and one ledger: every file is loaded once."""
    target = new_scratch_path(spark, "ledger")
    for name in ("first", "second"):
        ingest_stream(
            spark, at.lab_csv(spark, sf) + "/*", f"{target}/data", f"{target}/{name}",
            run_ts=at.RUN_TS, source_pattern=at.SOURCE_PATTERN, source_group=1, ledger=f"{target}/files",
        ).awaitTermination()
    return committed(spark, f"{target}/data", f"{target}/files").drop("processing_batch")


@register(
    "union_batches",
    "scanned",
    """
    SELECT source, visit_id, patient_id, debug_external_test_id, report_id, abnormal_flag
    FROM (
      SELECT source, visit_id, patient_id, CAST(NULL AS VARCHAR) AS debug_external_test_id,
        report_id, CAST(NULL AS VARCHAR) AS abnormal_flag FROM scanned
      UNION ALL
      SELECT source, visit_id, patient_id, NULL, NULL, NULL FROM scanned)
    """,
)
def union_batches_query(spark, sf):
    current = with_source_file(
        at.scanned(spark, sf), "source", at.SOURCE_PATTERN, 1
    )
    older = scan_lab(spark, at.lab_csv_15(spark, sf), layout="15")
    older = with_source_file(older, "source", at.SOURCE_PATTERN, 1)
    return union_batches([current, older]).select(
        "source",
        "visit_id",
        "patient_id",
        "debug_external_test_id",
        "report_id",
        "abnormal_flag",
    )


# ---------------------------------------------------------------- tables


@register("write_parquet", "bronze", f"SELECT {_list(BRONZE)} FROM bronze")
def write_parquet(spark, sf):
    name = f"{_database(spark, 'plain')}.results"
    return spark.table(write_table(at.bronze(spark, sf), name))


@register("write_partitioned", "bronze", f"SELECT {_list(BRONZE)}, year, month FROM bronze")
def write_partitioned(spark, sf):
    rows = at.bronze(spark, sf, partition_columns=True)
    path = write_table(
        rows, path=new_scratch_path(spark, "partitioned"), partition_by=["year", "month"]
    )
    return spark.read.parquet(path)


@register(
    "write_transform_partitioned",
    "bronze",
    f"SELECT {_list(BRONZE)}, year, true AS bucket_in_range FROM bronze",
)
def write_transform_partitioned(spark, sf):
    rows = at.bronze(spark, sf, partition_columns=True).drop("month")
    bucketed = with_bucket_column(rows, "patient_id", 32)
    path = write_table(
        bucketed,
        path=new_scratch_path(spark, "bucketed"),
        partition_by=["patient_id_bucket", "year"],
    )
    return (
        spark.read.parquet(path)
        .withColumn("bucket_in_range", F.col("patient_id_bucket").between(0, 31))
        .drop("patient_id_bucket")
    )


@register("write_clustered", "bronze", f"SELECT {_list(BRONZE)}, year, month FROM bronze")
def write_clustered(spark, sf):
    return at.stored_bronze(spark, sf)


@register("write_bucketed", "concept", "SELECT * FROM concept")
def write_bucketed(spark, sf):
    rows = vocabulary.load_concept(at.vocab_scan(spark, sf, "CONCEPT.csv"))
    name = f"{_database(spark, 'buckets')}.concept"
    write_table(
        rows, name, bucket_by=(256, "concept_id"), sort_by=["vocabulary_id", "concept_code"]
    )
    return spark.table(name)


@register(
    "append_with_quarantine",
    "lab",
    """
    SELECT coalesce(nullif(concat_ws(',',
        CASE WHEN value_as_number IS NULL AND value_as_string IS NOT NULL THEN 'value_as_number' END,
        CASE WHEN coalesce(patient_id, '') IN ('', 'nan') THEN 'patient_id' END), ''), 'accepted') AS outcome,
      COUNT(*) AS rows, COUNT(DISTINCT patient_id) AS patients
    FROM lab GROUP BY 1
    """,
)
def append_with_quarantine_query(spark, sf):
    raw = at.lab_results(spark, sf).withColumn(
        "value_as_number", F.coalesce("value_as_number", "value_as_string")
    )
    path = new_scratch_path(spark, "quarantine")
    append_with_quarantine(raw, path, at.BATCH, at.RUN_TS)
    good = accepted(spark, path).select(F.lit("accepted").alias("outcome"), "patient_id")
    bad = quarantined(spark, path).select(
        F.col("reject_reason").alias("outcome"),
        F.get_json_object("raw_record", "$.patient_id").alias("patient_id"),
    )
    return (
        good.unionByName(bad)
        .groupBy("outcome")
        .agg(
            F.count(F.lit(1)).alias("rows"), F.count_distinct("patient_id").alias("patients")
        )
    )


@register("load_if_needed", "concept", "SELECT * FROM concept")
def load_if_needed(spark, sf):
    rows = vocabulary.load_concept(at.vocab_scan(spark, sf, "CONCEPT.csv"))
    name = f"{_database(spark, 'needed')}.concept"
    write_table(rows.filter(F.col("vocabulary_id") == "Local"), name)
    insert_missing(spark, name, rows)
    insert_missing(spark, name, rows)
    return spark.table(name)


@register(
    "staged_publish",
    "concept relation domain",
    "SELECT 'vocabulary' AS table_name, COUNT(*) AS rows FROM supplier "
    "UNION ALL SELECT 'concept', COUNT(*) FROM concept "
    "UNION ALL SELECT 'concept_relationship', COUNT(*) FROM relation "
    "UNION ALL SELECT 'domain', COUNT(*) FROM domain",
)
def staged_publish_query(spark, sf):
    database = _database(spark, "published")
    load_vocabularies(spark, at.vocab_files(spark, sf), database, min_concepts=100)
    names = ("vocabulary", "concept", "concept_relationship", "domain")
    counts = audits.row_counts({n: spark.table(f"{database}.{n}") for n in names})
    return counts.drop("enough")


# ---------------------------------------------------------------- bronze columns


@register("bronze_typed_15", "loaded", f"SELECT {_list(BRONZE)} FROM loaded WHERE patient_id <> ''")
def bronze_typed_15(spark, sf):
    raw = scan_lab(spark, at.lab_csv_15(spark, sf), layout="15")
    typed = bronze.bronze_typed(raw, at.BATCH, at.RUN_TS, keep_patients="nonblank")
    return typed.withColumn("abnormal_flag", F.coalesce("abnormal_flag", F.lit("")))


@register("bronze_typed_27", "loaded", f"SELECT {_list(BRONZE)}, year, month FROM loaded")
def bronze_typed_27(spark, sf):
    return bronze.bronze_typed(
        at.scanned(spark, sf), at.BATCH, at.RUN_TS, partition_columns=True
    )


_TEXT_COLUMNS = [c for c in LAB_15 if c not in ("visit_id", "abnormal_flag", "provider_id")]


@register(
    "bronze_strings",
    "scanned",
    f"SELECT {_list(_TEXT_COLUMNS)}, TRY_CAST(visit_id AS BIGINT) AS visit_id, "
    "report_id AS provider_id, '' AS abnormal_flag, source AS source_file, "
    "TIMESTAMP '2024-01-01 12:00:00' AS load_timestamp, 'registry' AS processing_batch "
    "FROM scanned WHERE patient_id <> ''",
)
def bronze_strings(spark, sf):
    raw = scan_glob(spark, at.lab_csv(spark, sf) + "/source=*", LAB_27)
    raw = with_source_file(raw, pattern=at.SOURCE_PATTERN, group=1)
    return bronze.bronze_typed(
        raw, at.BATCH, at.RUN_TS, keep_patients="nonblank", strings=True
    )


@register(
    "patient_filter",
    "bronze",
    " UNION ALL ".join(
        f"SELECT '{mode}' AS mode, COUNT(*) AS rows FROM bronze WHERE {test}"
        for mode, test in {
            "all": "true",
            "nonblank": "patient_id <> ''",
            "trimmed": "LENGTH(TRIM(patient_id)) > 0",
            "with_visit": "patient_id <> '' AND visit_id IS NOT NULL",
            "not_nan": "patient_id NOT IN ('', 'nan')",
        }.items()
    ),
)
def patient_filter_query(spark, sf):
    rows = at.bronze(spark, sf)
    modes = ("all", "nonblank", "trimmed", "with_visit", "not_nan")
    return union_batches(
        [
            bronze.patient_filter(rows, mode).agg(
                F.lit(mode).alias("mode"), F.count(F.lit(1)).alias("rows")
            )
            for mode in modes
        ]
    )


# Blank, spaced and "nan" patients, visits 0 and NULL, values 0 and NaN, blank texts; the same SQL in both.
_EDGES = {
    "patient_id": "CASE visit_id % 11 WHEN 0 THEN '' WHEN 1 THEN '   ' WHEN 2 THEN 'nan' ELSE patient_id END",
    "visit_id": "CASE visit_id % 13 WHEN 0 THEN NULL WHEN 1 THEN CAST(0 AS BIGINT) ELSE visit_id END",
    "value_as_number": "CASE visit_id % 7 WHEN 0 THEN CAST(0 AS DOUBLE) WHEN 1 THEN CAST('NaN' AS DOUBLE) "
    "ELSE value_as_number END",
    "value_as_string": "CASE visit_id % 5 WHEN 0 THEN '  ' WHEN 1 THEN 'weak' ELSE value_as_string END",
}
_EDGE_ROWS = f"(SELECT * REPLACE ({', '.join(f'{v} AS {k}' for k, v in _EDGES.items())}) FROM bronze)"


def _edge_rows(spark, sf) -> DataFrame:
    return at.bronze(spark, sf).withColumns({k: F.expr(v) for k, v in _EDGES.items()})


@register(
    "patient_filter_edges",
    "bronze",
    f"""
    SELECT unnest(['all', 'nonblank', 'trimmed', 'with_visit', 'not_nan']) AS mode,
      unnest([COUNT(*), COUNT(*) FILTER (patient_id <> ''), COUNT(*) FILTER (TRIM(patient_id) <> ''),
        COUNT(*) FILTER (patient_id <> '' AND visit_id IS NOT NULL),
        COUNT(*) FILTER (patient_id NOT IN ('', 'nan'))]) AS rows
    FROM {_EDGE_ROWS}
    """,
)
def patient_filter_edges(spark, sf):
    """Five modes, five different counts."""
    rows = _edge_rows(spark, sf)
    modes = ("all", "nonblank", "trimmed", "with_visit", "not_nan")
    return union_batches(
        [
            bronze.patient_filter(rows, mode).agg(F.lit(mode).alias("mode"), F.count(F.lit(1)).alias("rows"))
            for mode in modes
        ]
    )


@register(
    "partition_year_month",
    "bronze",
    "SELECT year, month, COUNT(*) AS rows FROM bronze GROUP BY year, month",
)
def partition_year_month(spark, sf):
    keyed = bronze.with_partition_columns(at.lab_results(spark, sf))
    return keyed.groupBy("year", "month").agg(F.count(F.lit(1)).alias("rows"))


@register(
    "date_fallback",
    "measurement",
    "SELECT visit_occurrence_id, person_id, measurement_date, measurement_datetime, "
    "measurement_year, measurement_month FROM measurement",
)
def date_fallback(spark, sf):
    return at.measurement(spark, sf).select(
        "visit_occurrence_id",
        "person_id",
        "measurement_date",
        "measurement_datetime",
        "measurement_year",
        "measurement_month",
    )


@register(
    "unit_concept",
    "bronze",
    f"SELECT unit_source_value, {sql.UNIT_ID} AS unit_concept_id, COUNT(*) AS rows "
    "FROM bronze GROUP BY unit_source_value",
)
def unit_concept_query(spark, sf):
    keyed = at.bronze(spark, sf).withColumn(
        "unit_concept_id", lf.unit_concept("unit_source_value")
    )
    return keyed.groupBy("unit_source_value", "unit_concept_id").agg(
        F.count(F.lit(1)).alias("rows")
    )


@register(
    "normality_concept",
    "bronze",
    f"SELECT normality, {sql.NORMALITY_ID} AS measurement_event_id, COUNT(*) AS rows "
    "FROM bronze GROUP BY normality",
)
def normality_concept_query(spark, sf):
    keyed = at.bronze(spark, sf).withColumn(
        "measurement_event_id", lf.normality_concept("normality")
    )
    return keyed.groupBy("normality", "measurement_event_id").agg(
        F.count(F.lit(1)).alias("rows")
    )


@register(
    "categorical_flag",
    "measurement",
    "SELECT value_as_concept_id, value_type, COUNT(*) AS rows FROM "
    "(SELECT CASE WHEN value_as_string IS NOT NULL AND value_as_number IS NULL THEN 0 END "
    "AS value_as_concept_id, value_type FROM bronze) GROUP BY ALL",
)
def categorical_flag_query(spark, sf):
    keyed = at.bronze(spark, sf).withColumn(
        "value_as_concept_id", lf.categorical_flag("value_as_string", "value_as_number")
    )
    return keyed.groupBy("value_as_concept_id", "value_type").agg(
        F.count(F.lit(1)).alias("rows")
    )


_CRC = sql.crc32("patient_id || '_' || laboratory_uuid || '_' || measurement_source_value")
_CRC_KEYS = "patient_id, laboratory_uuid, measurement_source_value"


@register(
    "measurement_id",
    "bronze crc_table",
    f"SELECT {_CRC_KEYS}, rows, {_CRC} AS measurement_id FROM (SELECT {_CRC_KEYS}, "
    f"COUNT(*) AS rows FROM bronze GROUP BY {_CRC_KEYS}) CROSS JOIN crc_table",
)
def measurement_id_query(spark, sf):
    keys = _CRC_KEYS.split(", ")
    grouped = at.bronze(spark, sf).groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    return grouped.withColumn("measurement_id", lf.measurement_id(*keys))


_FIXED = (
    "measurement_concept_id, measurement_type_concept_id, operator_concept_id, range_low, "
    "range_high, visit_detail_id, measurement_source_concept_id, meas_event_field_concept_id"
)


@register(
    "typed_nulls_constants",
    "measurement",
    f"SELECT {_FIXED}, COUNT(*) AS rows FROM measurement GROUP BY ALL",
)
def typed_nulls_constants(spark, sf):
    return (
        at.measurement(spark, sf)
        .groupBy(*_FIXED.split(", "))
        .agg(F.count(F.lit(1)).alias("rows"))
    )


@register(
    "omop_measurement",
    "measurement crc_table",
    "SELECT measurement.* EXCLUDE (patient_id, laboratory_uuid), ids.measurement_id "
    f"FROM measurement LEFT JOIN (SELECT {_CRC_KEYS}, {_CRC} AS measurement_id "
    f"FROM (SELECT DISTINCT {_CRC_KEYS} FROM measurement) CROSS JOIN crc_table) AS ids "
    f"USING ({_CRC_KEYS})",
)
def omop_measurement_query(spark, sf):
    return at.measurement(spark, sf)


_SCORE = (
    "CASE WHEN value_as_number IS NOT NULL AND unit_source_value IS NOT NULL "
    "THEN CAST(1.0 AS DOUBLE) WHEN {text} <> '' THEN CAST(0.8 AS DOUBLE) "
    "ELSE CAST(0.5 AS DOUBLE) END"
)
_DOMAIN = (
    "CASE WHEN value_as_number IS NOT NULL THEN 'Measurement' "
    "WHEN value_as_string IS NOT NULL THEN 'Observation' ELSE 'Unknown' END"
)
_PSEUDONYM = "UPPER(SUBSTR(SHA256(patient_id), 1, 32))"
_AUDIT = "UPPER(SUBSTR(SHA256(patient_id || CAST(visit_id AS VARCHAR)), 1, 16))"

_V5 = (
    f"{_PSEUDONYM} AS person_id_hash, CAST(sampling_datetime_utc AS DATE) AS measurement_date, "
    "sampling_datetime_utc AS measurement_datetime, CAST(sampling_datetime_utc AS DATE) AS visit_date, "
    "COALESCE(value_as_string, CAST(value_as_number AS VARCHAR)) AS value_source_value, "
    f"{_SCORE.format(text='value_as_string')} AS data_quality_score, "
    f"{_DOMAIN} AS omop_target_domain, "
    "COALESCE(normality, abnormal_flag, 'Unknown') AS value_qualifier, "
    f"{_AUDIT} AS gdpr_original_hash"
)


def _enhanced(spark, sf) -> DataFrame:
    rows = bronze.patient_filter(at.stored_bronze(spark, sf).drop("year", "month"), "with_visit")
    return bronze.bronze_enhanced(rows, 5, row_id=None)


@register(
    "bronze_enhanced_v5",
    "bronze",
    f"SELECT {_list(BRONZE)}, {_V5} FROM bronze WHERE patient_id <> '' AND visit_id IS NOT NULL",
)
def bronze_enhanced_v5(spark, sf):
    return _enhanced(spark, sf).drop("patient_id_hash")


@register(
    "bronze_enhanced_v7",
    "lab",
    f"SELECT {_list(_TEXT_COLUMNS)}, TRY_CAST(visit_id AS BIGINT) AS visit_id, '' AS abnormal_flag, "
    "report_id AS provider_id, TIMESTAMP '2024-01-01 12:00:00' AS load_timestamp, "
    f"'registry' AS processing_batch, {_PSEUDONYM} AS person_id_anonymized, "
    "TRY_STRPTIME(sampling_datetime_utc, '%Y-%m-%d %H:%M:%S') AS sampling_datetime_parsed, "
    "CAST(year(TRY_STRPTIME(sampling_datetime_utc, '%Y-%m-%d %H:%M:%S')) AS INTEGER) "
    "AS measurement_year, "
    "CAST(TRY_STRPTIME(sampling_datetime_utc, '%Y-%m-%d %H:%M:%S') AS DATE) AS measurement_date, "
    "TRY_CAST(value_as_number AS DOUBLE) AS value_as_number_parsed, "
    "COALESCE(value_as_string, value_as_number) AS value_source_value, "
    f"{_SCORE.format(text='TRIM(value_as_string)')} AS data_quality_score "
    "FROM lab WHERE patient_id <> ''",
)
def bronze_enhanced_v7(spark, sf):
    rows = at.bronze(spark, sf, strings=True, keep_patients="nonblank")
    return bronze.bronze_enhanced(rows, 7, row_id=None).drop("person_id_hash")


_ROW_IDS = """
SELECT {version} AS version, unnest(['rows', 'first_id', 'last_id', 'ids', 'hashes', 'hashed_patients']) AS measure,
  unnest([n, 1, n, n, p, p]) AS value
FROM (SELECT COUNT(*) AS n, COUNT(DISTINCT patient_id) AS p FROM {rows})
"""


@register(
    "bronze_enhanced_row_ids",
    "bronze lab",
    _ROW_IDS.format(version=5, rows="bronze WHERE patient_id <> '' AND visit_id IS NOT NULL")
    + " UNION ALL " + _ROW_IDS.format(version=7, rows="lab WHERE patient_id <> ''"),
)
def bronze_enhanced_row_ids(spark, sf):
    """Both versions with row id and 64-bit hash: ids without a gap, one hash for each patient."""
    typed = bronze.patient_filter(at.stored_bronze(spark, sf).drop("year", "month"), "with_visit")
    texts = at.bronze(spark, sf, strings=True, keep_patients="nonblank")
    found = []
    for version, rows, hashed in ((5, typed, "patient_id_hash"), (7, texts, "person_id_hash")):
        # Numbered once; the measures read the columns they need from the stored rows.
        numbered = bronze.bronze_enhanced(rows, version).select("measurement_id", "patient_id", hashed)
        numbered = store(numbered, "numbered")
        pairs = numbered.select("patient_id", hashed).distinct()
        measures = {
            "rows": numbered.agg(F.count("*")),
            "first_id": numbered.agg(F.min("measurement_id")),
            "last_id": numbered.agg(F.max("measurement_id")),
            "ids": numbered.select("measurement_id").distinct().agg(F.count("*")),
            "hashes": pairs.select(hashed).distinct().agg(F.count("*")),
            "hashed_patients": pairs.agg(F.count("*")),
        }
        found += [
            df.toDF("value").select(F.lit(version).alias("version"), F.lit(name).alias("measure"), "value")
            for name, df in measures.items()
        ]
    return union_batches(found)


_PARSED = "TRY_STRPTIME(sampling_datetime_utc, '%Y-%m-%d %H:%M:%S')"


@register(
    "enhanced_flow",
    "lab",
    f"""
    SELECT 'all' AS kind, ROW_NUMBER() OVER (ORDER BY sampling_datetime_utc, patient_id, TRY_CAST(visit_id AS BIGINT))
        AS measurement_id, sampling_datetime_utc, patient_id, TRY_CAST(visit_id AS BIGINT) AS visit_id,
      CAST(year({_PARSED}) AS INTEGER) AS measurement_year, true AS bucket_in_range
    FROM lab WHERE patient_id <> ''
    UNION ALL
    SELECT 'cohort', NULL, sampling_datetime_utc, patient_id, TRY_CAST(visit_id AS BIGINT),
      CAST(year({_PARSED}) AS INTEGER), true
    FROM lab WHERE patient_id IN ('12', '30', 'P59')
    """,
)
def enhanced_flow(spark, sf):
    """Written by patient bucket and year, read back whole and by the buckets of three patients."""
    texts = at.bronze(spark, sf, strings=True, keep_patients="nonblank")
    table = bronze_to_enhanced(spark, texts, f"{_database(spark, 'enhanced')}.results", version=7)
    stored = spark.table(table)
    some = access.cohort_filter(stored, ["12", "30", "P59"], enhanced_bucket())
    in_range = F.col("patient_bucket").between(0, 15).alias("bucket_in_range")
    columns = ["sampling_datetime_utc", "patient_id", "visit_id", "measurement_year", in_range]
    return stored.select(F.lit("all").alias("kind"), "measurement_id", *columns).unionAll(
        some.select(F.lit("cohort"), F.lit(None).cast("bigint"), *columns)
    )


@register(
    "quality_score",
    "bronze",
    f"SELECT {_SCORE.format(text='value_as_string')} AS data_quality_score, COUNT(*) AS rows "
    "FROM bronze GROUP BY 1",
)
def quality_score_query(spark, sf):
    score = lf.quality_score("value_as_number", "unit_source_value", "value_as_string")
    return (
        at.bronze(spark, sf)
        .groupBy(score.alias("data_quality_score"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )


@register(
    "target_domain",
    "bronze",
    f"SELECT {_DOMAIN} AS omop_target_domain, COUNT(*) AS rows FROM bronze GROUP BY 1",
)
def target_domain(spark, sf):
    domain = lf.omop_target_domain("value_as_number", "value_as_string")
    return (
        at.bronze(spark, sf)
        .groupBy(domain.alias("omop_target_domain"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )


@register(
    "value_qualifier",
    "bronze",
    "SELECT COALESCE(normality, abnormal_flag, 'Unknown') AS value_qualifier, COUNT(*) AS rows "
    "FROM bronze GROUP BY 1",
)
def value_qualifier_query(spark, sf):
    qualifier = lf.value_qualifier("normality", "abnormal_flag")
    return (
        at.bronze(spark, sf)
        .groupBy(qualifier.alias("value_qualifier"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )


@register(
    "pseudonymize",
    "bronze",
    f"SELECT patient_id, visit_id, {_PSEUDONYM} AS person_id_hash, {_AUDIT} AS gdpr_original_hash, "
    "patient_id IS NOT NULL AS has_hash64 FROM bronze",
)
def pseudonymize(spark, sf):
    return at.bronze(spark, sf).select(
        "patient_id",
        "visit_id",
        lf.pseudonym("patient_id").alias("person_id_hash"),
        lf.audit_hash("patient_id", "visit_id").alias("gdpr_original_hash"),
        F.coalesce(lf.person_hash64("patient_id") >= 0, F.lit(False)).alias("has_hash64"),
    )


@register(
    "value_source_value",
    "bronze",
    "SELECT visit_id, COALESCE(value_as_string, CAST(value_as_number AS VARCHAR)) "
    "AS value_source_value FROM bronze",
)
def value_source_value_query(spark, sf):
    text = lf.value_source_value("value_as_string", "value_as_number")
    return at.bronze(spark, sf).select("visit_id", text.alias("value_source_value"))


@register(
    "test_category",
    "bronze",
    f"SELECT unit_source_value, {sql.CATEGORY} AS test_category, COUNT(*) AS rows "
    "FROM bronze GROUP BY unit_source_value",
)
def category_query(spark, sf):
    keyed = at.bronze(spark, sf).withColumn("test_category", lf.lab_category("unit_source_value"))
    return keyed.groupBy("unit_source_value", "test_category").agg(
        F.count(F.lit(1)).alias("rows")
    )


# ---------------------------------------------------------------- vocabulary


@register(
    "load_vocabulary",
    "vocabulary_text",
    "SELECT * REPLACE (TRY_CAST(vocabulary_concept_id AS BIGINT) AS vocabulary_concept_id) "
    "FROM vocabulary_text",
)
def load_vocabulary_query(spark, sf):
    return vocabulary.load_vocabulary(at.vocab_scan(spark, sf, "VOCABULARY.csv"))


@register("load_concept", "concept", "SELECT * FROM concept")
def load_concept_query(spark, sf):
    return vocabulary.load_concept(at.vocab_scan(spark, sf, "CONCEPT.csv"))


@register("load_concept_relationship", "relation", "SELECT * FROM relation")
def load_concept_relationship_query(spark, sf):
    return vocabulary.load_concept_relationship(
        at.vocab_scan(spark, sf, "CONCEPT_RELATIONSHIP.csv")
    )


@register("load_domain", "domain", "SELECT * FROM domain")
def load_domain_query(spark, sf):
    return vocabulary.load_domain(at.vocab_scan(spark, sf, "DOMAIN.csv"))


def _concept(spark, sf) -> DataFrame:
    return vocabulary.load_concept(at.vocabulary_rows(spark, sf)["CONCEPT.csv"])


# ---------------------------------------------------------------- access patterns


@register(
    "time_range_count",
    "bronze",
    "SELECT 'from' AS kind, COUNT(*) AS rows FROM bronze "
    "WHERE sampling_datetime_utc >= TIMESTAMP '1998-03-15 00:00:00' UNION ALL "
    "SELECT 'between', COUNT(*) FROM bronze WHERE sampling_datetime_utc "
    "BETWEEN TIMESTAMP '1998-03-15 00:00:00' AND TIMESTAMP '1999-12-31 00:00:00'",
)
def time_range_count_query(spark, sf):
    rows = at.stored_bronze(spark, sf)
    start, end = dt.date(1998, 3, 15), dt.date(1999, 12, 31)
    kinds = {"from": None, "between": end}
    return union_batches(
        [
            access.time_range_count(rows, start, stop).select(F.lit(kind).alias("kind"), "rows")
            for kind, stop in kinds.items()
        ]
    )


@register(
    "time_range_by_result",
    "bronze",
    "SELECT patient_id, visit_id, sampling_datetime_utc, result_datetime_utc FROM bronze "
    "WHERE result_datetime_utc >= TIMESTAMP '1997-12-01 00:00:00' "
    "AND result_datetime_utc <= TIMESTAMP '1998-01-01 00:00:00'",
)
def time_range_by_result(spark, sf):
    rows = access.time_range(
        at.stored_bronze(spark, sf), dt.date(1997, 12, 1), dt.date(1998, 1, 1), "result_datetime_utc"
    )
    return rows.select("patient_id", "visit_id", "sampling_datetime_utc", "result_datetime_utc")


@register(
    "batch_ingest_two_streams",
    "loaded",
    f"SELECT {_list(LAB_15)}, load_timestamp, source AS source_file FROM loaded "
    "WHERE patient_id NOT IN ('', 'nan') UNION ALL "
    f"SELECT {_list(LAB_15)}, load_timestamp, source AS source_file FROM loaded "
    "WHERE patient_id NOT IN ('', 'nan')",
)
def batch_ingest_two_streams(spark, sf):
    """Two streams with checkpoints of their own load the same files into one target."""
    target = new_scratch_path(spark, "streams")
    for name in ("first", "second"):
        ingest_stream(
            spark, at.lab_csv(spark, sf) + "/*", f"{target}/data", f"{target}/{name}",
            run_ts=at.RUN_TS, source_pattern=at.SOURCE_PATTERN, source_group=1,
        ).awaitTermination()
    return spark.read.parquet(f"{target}/data").drop("processing_batch")


@register(
    "cohort_filter",
    "bronze",
    "SELECT 'table' AS kind, patient_id, visit_id, measurement_source_value FROM bronze "
    "WHERE patient_id IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer "
    "WHERE c_mktsegment = 'MACHINERY') UNION ALL "
    "SELECT 'list', patient_id, visit_id, measurement_source_value FROM bronze "
    "WHERE patient_id IN ('12', '30', 'P59')",
)
def cohort_filter_query(spark, sf):
    rows = at.stored_bronze(spark, sf).select(
        "patient_id", "visit_id", "measurement_source_value"
    )
    cohort = (
        at.table(spark, sf, "customer")
        .filter(F.col("c_mktsegment") == "MACHINERY")
        .select(F.col("c_custkey").cast("string").alias("patient_id"))
    )
    kinds = {"table": cohort, "list": ["12", "30", "P59"]}
    return union_batches(
        [
            access.cohort_filter(rows, who).select(F.lit(kind).alias("kind"), "*")
            for kind, who in kinds.items()
        ]
    )


_COHORT_ROWS = "SELECT {kind} AS kind, patient_id, visit_id, measurement_source_value FROM bronze WHERE patient_id IN ({ids})"


@register(
    "cohort_filter_buckets",
    "bronze",
    _COHORT_ROWS.format(
        kind="'table'",
        ids="SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_mktsegment = 'MACHINERY' AND c_nationkey = 3",
    )
    + " UNION ALL " + _COHORT_ROWS.format(kind="'list'", ids="'12', '30', 'P59'"),
)
def cohort_filter_buckets(spark, sf):
    """Over a table by patient bucket and year, of which only the patients' buckets are read."""
    rows = at.bucketed_bronze(spark, sf).select(
        "patient_id", "visit_id", "measurement_source_value", "patient_id_bucket"
    )
    customers = at.table(spark, sf, "customer")
    cohort = customers.filter("c_mktsegment = 'MACHINERY' AND c_nationkey = 3").select(
        F.col("c_custkey").cast("string").alias("patient_id")
    )
    kinds = {"table": cohort, "list": ["12", "30", "P59"]}
    columns = ["patient_id", "visit_id", "measurement_source_value"]
    return union_batches(
        [
            access.cohort_filter(rows, who, access.Bucket("patient_id_bucket", 32)).select(
                F.lit(kind).alias("kind"), *columns
            )
            for kind, who in kinds.items()
        ]
    )


@register(
    "code_filter",
    "bronze",
    "SELECT patient_id, visit_id, measurement_source_value FROM bronze "
    "WHERE measurement_source_value IN ('LC:0007', 'LC:0010') "
    "AND measurement_source_value LIKE 'LC:%'",
)
def code_filter_query(spark, sf):
    rows = access.code_filter(at.stored_bronze(spark, sf), ["LC:0007", "LC:0010"], "LC:%")
    return rows.select("patient_id", "visit_id", "measurement_source_value")


# ---------------------------------------------------------------- joins


ORACLE_OF_LOOKUP = (
    "SELECT patient_id, visit_id, measurement_source_value, concept_id, concept_name, "
    "concept.vocabulary_id FROM bronze JOIN concept ON measurement_source_value = concept_code"
)


@register(
    "concept_lookup_join",
    "bronze concept",
    ORACLE_OF_LOOKUP,
)
def concept_lookup_join(spark, sf):
    joined = concepts.concept_lookup(
        at.bronze(spark, sf), _concept(spark, sf), ["concept_id", "concept_name", "vocabulary_id"]
    )
    return joined.select(
        "patient_id",
        "visit_id",
        "measurement_source_value",
        "concept_id",
        "concept_name",
        "vocabulary_id",
    )


@register("bucketed_concept_join", "bronze concept", ORACLE_OF_LOOKUP)
def bucketed_concept_join(spark, sf):
    """Both sides bucketed by slots of the code, frequent codes in several: no exchange for the join."""
    database = _database(spark, "slots")
    names = concepts.write_by_code(
        at.bronze(spark, sf), _concept(spark, sf), f"{database}.results", f"{database}.concept",
        buckets=8, rows_per_slot=1000,
    )
    columns = ["concept_id", "concept_name", "vocabulary_id"]
    joined = concepts.slot_lookup(*[spark.table(name) for name in names], columns)
    return joined.select("patient_id", "visit_id", "measurement_source_value", *columns)


_BACKFILLED = """
SELECT person_id, visit_occurrence_id, measurement_source_value,
  CAST(COALESCE(found, 0) AS INTEGER) AS measurement_concept_id,
  CAST(COALESCE(found, 0) AS INTEGER) AS measurement_source_concept_id,
  unit_concept_id, value_as_number, measurement_date
FROM measurement LEFT JOIN (
  SELECT concept_code, MIN(concept_id) AS found FROM concept
  WHERE vocabulary_id = 'LOINC' GROUP BY concept_code)
ON measurement_source_value = concept_code
"""


def _backfilled(spark, sf) -> DataFrame:
    return concepts.concept_backfill(at.stored_measurement(spark, sf), _concept(spark, sf))


@register("concept_backfill", "measurement concept", _BACKFILLED)
def concept_backfill_query(spark, sf):
    return _backfilled(spark, sf).select(
        "person_id",
        "visit_occurrence_id",
        "measurement_source_value",
        "measurement_concept_id",
        "measurement_source_concept_id",
        "unit_concept_id",
        "value_as_number",
        "measurement_date",
    )


# ---------------------------------------------------------------- gold


@register("patient_summary", "measurement", sql.PATIENT_SUMMARY)
def patient_summary_query(spark, sf):
    return _rounded(gold.patient_summary(at.stored_measurement(spark, sf)), "stddev_numeric_value")


def _trends(measurement: DataFrame) -> DataFrame:
    return _rounded(
        gold.measurement_trends(measurement),
        "daily_stddev_value",
        "daily_median_value",
        "daily_p25_value",
        "daily_p75_value",
    )


@register("measurement_trends", "measurement", sql.MEASUREMENT_TRENDS)
def measurement_trends_query(spark, sf):
    return _trends(at.stored_measurement(spark, sf))


@register(
    "trend_stream",
    "measurement",
    """
    SELECT measurement_date, measurement_source_value, unit_source_value, COUNT(*) AS daily_test_count,
      COUNT(value_as_number) AS daily_numeric_count, ROUND(AVG(value_as_number), 6) AS daily_avg_value,
      MIN(value_as_number) AS daily_min_value, MAX(value_as_number) AS daily_max_value
    FROM measurement WHERE measurement_date IS NOT NULL AND measurement_source_value IS NOT NULL
    GROUP BY ALL
    """,
)
def trend_stream_query(spark, sf):
    """The daily trends from a stream over the stored files, some files in each batch."""
    path = new_scratch_path(spark, "trends")
    # A third of the files in each batch, two at least; their number grows with the rows.
    files = max(6, at.ranges(spark, sf))
    at.measurement(spark, sf).repartition(files).write.parquet(f"{path}/in")
    # Every day stays open, as the rows come in no order.
    query = trend_stream(
        spark, f"{path}/in", f"{path}/out", f"{path}/checkpoint", delay="20000 days", files_per_batch=-(-files // 3)
    )
    query.awaitTermination()
    return _rounded(current_trends(spark, f"{path}/out"), "daily_avg_value")


# Values with seven digits, on both sides of zero.
_DECIMAL = "value_as_number * 1000.0625 - 25001.5625"


@register(
    "measurement_trends_exact",
    "measurement",
    sql.MEASUREMENT_TRENDS.replace(
        "FROM measurement", f"FROM (SELECT * REPLACE ({_DECIMAL} AS value_as_number) FROM measurement)"
    ),
)
def measurement_trends_exact(spark, sf):
    rows = at.stored_measurement(spark, sf)
    return _trends(rows.withColumn("value_as_number", F.col("value_as_number") * 1000.0625 - 25001.5625))


def _analytics(spark, sf, **options) -> DataFrame:
    return _rounded(
        gold.laboratory_analytics(at.stored_measurement(spark, sf), **options),
        "stddev_numeric_result",
        "median_numeric_result",
        "p2_5_value",
        "p97_5_value",
    )


@register("laboratory_analytics", "measurement", sql.laboratory_analytics(1000))
def laboratory_analytics_query(spark, sf):
    return _analytics(spark, sf)


@register("laboratory_analytics_all_tests", "measurement", sql.laboratory_analytics(1, integer=True))
def laboratory_analytics_all_tests(spark, sf):
    return _analytics(spark, sf, min_count=1, integer_division=True)


@register(
    "datamart_patient_stats",
    "patient_summary",
    "SELECT COUNT(*) AS total_patients, "
    "ROUND(AVG(total_measurements), 6) AS avg_measurements_per_patient, "
    "ROUND(AVG(measurement_span_days), 6) AS avg_measurement_span_days, "
    "ROUND(AVG(unique_lab_tests), 6) AS avg_lab_tests_per_patient, "
    "CAST(SUM(abnormal_results) AS BIGINT) AS total_abnormal_results, "
    "COUNT(*) FILTER (total_measurements >= 10) AS patients_with_10plus_measurements "
    "FROM patient_summary",
)
def datamart_patient_stats_query(spark, sf):
    stats = gold.datamart_patient_stats(gold.patient_summary(at.stored_measurement(spark, sf)))
    return _rounded(
        stats,
        "avg_measurements_per_patient",
        "avg_measurement_span_days",
        "avg_lab_tests_per_patient",
    )


@register(
    "datamart_lab_stats",
    "measurement",
    "SELECT COUNT(*) AS unique_lab_test_types, COUNT(DISTINCT test_category) AS test_categories, "
    "CAST(SUM(total_test_count) AS BIGINT) AS total_lab_tests, "
    "CAST(SUM(unique_patients_tested) AS BIGINT) AS total_patients_with_tests, "
    "ROUND(AVG(pct_abnormal), 6) AS avg_abnormal_percentage "
    f"FROM ({sql.laboratory_analytics(100)})",
)
def datamart_lab_stats_query(spark, sf):
    analytics = gold.laboratory_analytics(at.stored_measurement(spark, sf), min_count=100)
    return _rounded(gold.datamart_lab_stats(analytics), "avg_abnormal_percentage")


# ---------------------------------------------------------------- audits


ORACLE_OF_VALIDATION = f"""
SELECT COUNT(*) AS total_measurements, COUNT(DISTINCT person_id) AS unique_patients,
  COUNT(*) FILTER (measurement_concept_id > 0) AS mapped_measurements,
  COUNT(*) FILTER (measurement_concept_id = 0) AS unmapped_measurements,
  COUNT(*) FILTER (unit_concept_id > 0) AS mapped_units,
  COUNT(value_as_number) AS numeric_values,
  COUNT(DISTINCT measurement_concept_id) AS unique_concepts,
  MIN(measurement_date) AS earliest_measurement, MAX(measurement_date) AS latest_measurement,
  ROUND(100.0 * COUNT(*) FILTER (measurement_concept_id > 0) / COUNT(*), 6) AS mapping_rate_pct
FROM ({_BACKFILLED})
"""


@register(
    "omop_validation",
    "measurement concept",
    ORACLE_OF_VALIDATION,
)
def omop_validation_query(spark, sf):
    return _rounded(audits.omop_validation(_backfilled(spark, sf)), "mapping_rate_pct")


@register("silver_flow", "measurement concept", ORACLE_OF_VALIDATION)
def silver_flow(spark, sf):
    """Bronze to MEASUREMENT with concepts filled during the load, then validated where it is stored."""
    database = _database(spark, "silver")
    bronze_table = f"{database}.bronze"
    at.stored_bronze(spark, sf).write.saveAsTable(bronze_table)
    concept = _concept(spark, sf)
    silver = bronze_to_silver(spark, bronze_table, f"{database}.silver", as_of=at.AS_OF, concept=concept)
    return _rounded(validate_silver(spark, silver), "mapping_rate_pct")


@register(
    "bronze_stats",
    "loaded",
    """
    SELECT COUNT(*) AS total_records, COUNT(DISTINCT patient_id) AS unique_patients,
      COUNT(DISTINCT visit_id) AS unique_visits, COUNT(DISTINCT source) AS files_processed,
      MIN(sampling_datetime_utc) AS earliest_sample, MAX(sampling_datetime_utc) AS latest_sample,
      COUNT(value_as_number) AS numeric_values, COUNT(value_as_string) AS string_values,
      COUNT(DISTINCT processing_batch) AS batches_processed,
      COUNT(*) FILTER (measurement_source_value LIKE 'LC:%') AS lab_code_measurements
    FROM loaded
    """,
)
def bronze_stats_query(spark, sf):
    return audits.bronze_stats(at.stored_loaded(spark, sf))


_STRICT = """
    SELECT COUNT(*) AS total_records,
      COUNT(DISTINCT CASE WHEN TRIM(patient_id) <> '' THEN patient_id END) AS unique_patients,
      COUNT(DISTINCT CASE WHEN visit_id <> 0 THEN visit_id END) AS unique_visits,
      MIN(sampling_datetime_utc) AS earliest_sample, MAX(sampling_datetime_utc) AS latest_sample,
      COUNT(*) FILTER (value_as_number <> 0 AND NOT isnan(value_as_number)) AS numeric_values,
      COUNT(*) FILTER (TRIM(value_as_string) <> '') AS string_values,
      COUNT(*) FILTER (TRIM(measurement_source_value) <> '') AS valid_measurements,
      ROUND(AVG(value_as_number) FILTER (value_as_number <> 0 AND NOT isnan(value_as_number)), 6)
        AS avg_numeric_value,
      COUNT(*) FILTER (sampling_datetime_utc IS NULL) AS null_dates
    FROM bronze
"""


@register("bronze_stats_strict", "bronze", _STRICT)
def bronze_stats_strict(spark, sf):
    return _rounded(
        audits.bronze_stats(at.stored_bronze(spark, sf), strict=True), "avg_numeric_value"
    )


@register("bronze_stats_strict_edges", "bronze", _STRICT.replace("FROM bronze", f"FROM {_EDGE_ROWS}"))
def bronze_stats_strict_edges(spark, sf):
    return _rounded(
        audits.bronze_stats(_edge_rows(spark, sf), strict=True), "avg_numeric_value"
    )


@register(
    "partition_audit",
    "bronze",
    """
    SELECT COUNT(DISTINCT CASE WHEN year > 1900 AND year <= 2000 THEN year END) AS years_spanned,
      COUNT(DISTINCT CASE WHEN year > 1900 AND year <= 2000 AND month BETWEEN 1 AND 12
        THEN CAST(year AS VARCHAR) || '-' || CAST(month AS VARCHAR) END) AS total_partitions,
      MIN(CASE WHEN year > 1900 AND year <= 2000 THEN year END) AS first_year,
      MAX(CASE WHEN year > 1900 AND year <= 2000 THEN year END) AS last_year,
      COUNT(*) FILTER (year IS NULL OR month IS NULL) AS null_partition_keys,
      COUNT(*) FILTER (year < 1900 OR year > 2000) AS invalid_years,
      COUNT(*) FILTER (month < 1 OR month > 12) AS invalid_months,
      COUNT(*) FILTER (year = 1900) AS sentinel_rows
    FROM bronze
    """,
)
def partition_audit_query(spark, sf):
    return audits.partition_audit(at.stored_bronze(spark, sf), dt.date(2000, 6, 30))


@register(
    "patient_id_profile",
    "lab",
    """
    SELECT COUNT(*) AS total_rows, COUNT(*) FILTER (patient_id <> '') AS valid_patients,
      COUNT(*) FILTER (patient_id IS NULL) AS null_patients,
      COUNT(*) FILTER (patient_id = '') AS empty_patients,
      COUNT(sampling_datetime_utc) AS non_null_dates,
      ROUND(100.0 * COUNT(*) FILTER (patient_id <> '') / COUNT(*), 2) AS valid_pct,
      ROUND(100.0 * COUNT(*) FILTER (patient_id IS NULL) / COUNT(*), 2) AS null_pct,
      ROUND(100.0 * COUNT(*) FILTER (patient_id = '') / COUNT(*), 2) AS empty_pct
    FROM lab
    """,
)
def patient_id_profile_query(spark, sf):
    return audits.patient_id_profile(at.scanned(spark, sf))


@register(
    "scan_access_check",
    "lab",
    "SELECT COUNT(*) AS total_rows, COUNT(DISTINCT patient_id) AS unique_patients, "
    "true AS files_found, COUNT(sampling_datetime_utc) AS non_null_timestamps, "
    "true AS accessible FROM lab WHERE patient_id IS NOT NULL",
)
def scan_access_check_query(spark, sf):
    checked = audits.scan_access_check(at.scanned(spark, sf))
    return checked.select(
        "total_rows",
        "unique_patients",
        (F.col("files_accessible") > 0).alias("files_found"),
        "non_null_timestamps",
        "accessible",
    )


@register(
    "file_distribution",
    "loaded",
    "SELECT source AS source_file, COUNT(*) AS row_count, MIN(load_timestamp) AS processed_at "
    "FROM loaded GROUP BY source ORDER BY source LIMIT 10",
)
def file_distribution_query(spark, sf):
    return audits.file_distribution(at.stored_loaded(spark, sf))


_TOP = (
    "SELECT measurement_source_value, COUNT(*) AS frequency FROM bronze "
    "WHERE measurement_source_value IS NOT NULL GROUP BY measurement_source_value "
    "ORDER BY frequency DESC, measurement_source_value LIMIT {n}"
)


@register("top_lab_codes", "bronze", _TOP.format(n=10))
def top_lab_codes_query(spark, sf):
    return audits.top_lab_codes(at.bronze(spark, sf))


@register("top_k", "bronze", _TOP.format(n=3))
def top_k(spark, sf):
    return audits.top_lab_codes(at.stored_bronze(spark, sf), 3)


@register(
    "vocab_validation",
    "vocabulary_text",
    "SELECT COUNT(*) AS total_rows, COUNT(DISTINCT vocabulary_id) AS unique_vocabs, "
    "COUNT(vocabulary_name) AS named_vocabs, "
    "CAST(MIN(LENGTH(vocabulary_id)) AS INTEGER) AS min_id_length, "
    "CAST(MAX(LENGTH(vocabulary_id)) AS INTEGER) AS max_id_length, true AS not_empty, "
    "true AS unique_ids, true AS has_names, true AS usual_id_lengths FROM vocabulary_text",
)
def vocab_validation_query(spark, sf):
    rows = vocabulary.load_vocabulary(at.vocab_scan(spark, sf, "VOCABULARY.csv"))
    return vocabulary.vocab_validation(rows)


@register(
    "row_counts",
    "bronze measurement concept relation",
    "SELECT 'bronze' AS table_name, COUNT(*) AS rows, true AS enough FROM bronze "
    "UNION ALL SELECT 'measurement', COUNT(*), true FROM measurement "
    "UNION ALL SELECT 'concept', COUNT(*), COUNT(*) >= 10000 FROM concept "
    "UNION ALL SELECT 'concept_relationship', COUNT(*), COUNT(*) > 0 FROM relation",
)
def row_counts_query(spark, sf):
    relation = at.vocabulary_rows(spark, sf)["CONCEPT_RELATIONSHIP.csv"]
    return audits.row_counts(
        {
            "bronze": at.bronze(spark, sf),
            "measurement": at.measurement(spark, sf),
            "concept": _concept(spark, sf),
            "concept_relationship": vocabulary.load_concept_relationship(relation),
        },
        {"concept": 10_000, "concept_relationship": 1},
    )


@register(
    "enhanced_summary",
    "bronze",
    "SELECT 'enhanced bronze' AS summary_type, COUNT(*) AS total_records, "
    "COUNT(DISTINCT person_id_hash) AS unique_patients, COUNT(DISTINCT visit_id) AS unique_visits, "
    "MIN(measurement_date) AS earliest_date, MAX(measurement_date) AS latest_date, "
    f"ROUND(AVG(data_quality_score), 3) AS avg_data_quality FROM (SELECT visit_id, {_V5} "
    "FROM bronze WHERE patient_id <> '' AND visit_id IS NOT NULL)",
)
def enhanced_summary_query(spark, sf):
    return audits.enhanced_summary(_enhanced(spark, sf))


@register(
    "reconcile",
    "loaded",
    """
    SELECT *, CASE WHEN actual_rows = expected_rows THEN 'MATCH'
        WHEN actual_rows < expected_rows THEN 'FILTERED_OUT' ELSE 'DUPLICATES' END AS verdict,
      ABS(actual_rows - expected_rows) AS difference,
      ROUND(100.0 * ABS(actual_rows - expected_rows) / expected_rows, 2) AS difference_pct,
      ROUND(100.0 * actual_rows / expected_rows, 2) AS success_rate_pct
    FROM (SELECT source AS source_file, GROUPING(source) = 1 AS is_total,
        COUNT(*) AS expected_rows, COUNT(*) FILTER (patient_id <> '') AS actual_rows
      FROM loaded GROUP BY ROLLUP (source))
    """,
)
def reconcile_query(spark, sf):
    raw = with_source_file(at.scanned(spark, sf), pattern=at.SOURCE_PATTERN, group=1)
    loaded = bronze.patient_filter(at.stored_loaded(spark, sf), "nonblank")
    return audits.reconcile(raw, loaded)


_COMPARED = ["patient_id", "visit_id", "measurement_source_value", "value_as_number", "sampling_datetime_utc"]
# What befell the rows of three years: some lost, some doubled, some altered.
_LOST = "source = '1993' AND visit_id % 2 = 0"
_DOUBLED = "source = '1994' AND visit_id % 3 = 0"
_ALTERED = "CASE WHEN source = '1995' AND visit_id % 5 = 0 THEN 'LC:9999' ELSE measurement_source_value END"


@register(
    "load_audit",
    "loaded measurement concept",
    f"""
    SELECT total_records, b.numeric_values, string_values, lab_code_measurements, earliest_sample, latest_sample,
      undated, total_measurements, mapped_measurements, mapped_units, latest_measurement
    FROM (SELECT COUNT(*) AS total_records, COUNT(value_as_number) AS numeric_values,
        COUNT(value_as_string) AS string_values, COUNT(*) FILTER (measurement_source_value LIKE 'LC:%') AS lab_code_measurements,
        MIN(sampling_datetime_utc) AS earliest_sample, MAX(sampling_datetime_utc) AS latest_sample,
        COUNT(*) FILTER (sampling_datetime_utc IS NULL) AS undated FROM loaded) b,
      ({ORACLE_OF_VALIDATION}) m
    """,
)
def load_audit(spark, sf):
    """What the jobs that write bronze and silver counted on their way; no scan of the tables."""
    database = _database(spark, "audited")
    first, second = audits.LoadAudit(), audits.LoadAudit()
    stored = csv_to_bronze(spark, at.lab_csv(spark, sf), f"{database}.bronze", at.BATCH, run_ts=at.RUN_TS, audit=first)
    bronze_to_silver(
        spark, stored, f"{database}.silver", as_of=at.AS_OF, concept=_concept(spark, sf), audit=second
    )
    loaded = first.frame(spark).withColumnRenamed("sentinel_rows", "undated").drop(
        "null_partition_keys", "invalid_years", "invalid_months"
    )
    mapped = second.frame(spark).select(
        "total_measurements", "mapped_measurements", "mapped_units", "latest_measurement"
    )
    return loaded.crossJoin(mapped)


@register(
    "reconcile_content",
    "loaded",
    f"""
    SELECT source_file, is_total, expected_rows, actual_rows, changed = 0 AS same_content,
      CASE WHEN actual_rows < expected_rows THEN 'FILTERED_OUT' WHEN actual_rows > expected_rows THEN 'DUPLICATES'
        WHEN changed = 0 THEN 'MATCH' ELSE 'CHANGED' END AS verdict
    FROM (SELECT source AS source_file, GROUPING(source) = 1 AS is_total, CAST(SUM(1 + twice - lost) AS BIGINT) AS actual_rows,
        COUNT(*) AS expected_rows, COUNT(*) FILTER (lost + twice > 0 OR code IS DISTINCT FROM measurement_source_value) AS changed
      FROM (SELECT source, measurement_source_value, {_ALTERED} AS code, CASE WHEN {_LOST} THEN 1 ELSE 0 END AS lost,
          CASE WHEN {_DOUBLED} THEN 1 ELSE 0 END AS twice FROM loaded) GROUP BY ROLLUP (source))
    """,
)
def reconcile_content_query(spark, sf):
    """Lost, doubled and altered rows, each in another file; the rest as it was."""
    loaded = at.stored_loaded(spark, sf).withColumnRenamed("source_file", "source")
    kept = loaded.where(f"NOT ({_LOST})").unionAll(loaded.where(_DOUBLED))
    actual = kept.withColumn("measurement_source_value", F.expr(_ALTERED))
    return audits.reconcile_content(loaded, actual, _COMPARED, "source").withColumnRenamed("source", "source_file")


@register(
    "glob_profile",
    "lab",
    "SELECT COUNT(*) AS total_rows, COUNT(DISTINCT source) AS file_count, "
    "MIN(source) AS first_file, MAX(source) AS last_file, "
    "COUNT(*) / COUNT(DISTINCT source) AS rows_per_file, MAX(patient_id) AS sample_id FROM lab",
)
def glob_profile_query(spark, sf):
    raw = scan_glob(spark, at.lab_csv(spark, sf) + "/source=[12][09]*/*.csv")
    return audits.glob_profile(raw, at.source_label())


@register(
    "coverage",
    "bronze",
    "SELECT ROUND(100.0 * unique_patients / total_records, 6) AS patients_per_row_pct, "
    "ROUND(100.0 * numeric_values / total_records, 6) AS numeric_coverage_pct, "
    "ROUND(100.0 * valid_measurements / total_records, 6) AS measurement_coverage_pct, "
    "ROUND(100.0 * (total_records - null_dates) / total_records, 6) AS date_quality_pct "
    f"FROM ({_STRICT})",
)
def coverage_query(spark, sf):
    report = audits.coverage(audits.bronze_stats(at.stored_bronze(spark, sf), strict=True))
    return _rounded(report, *report.columns)


@register(
    "quality_grades",
    "measurement concept",
    "SELECT 'mapping' AS measure, CASE WHEN rate >= 80 THEN 'EXCELLENT' WHEN rate >= 60 THEN 'GOOD' "
    "ELSE 'POOR' END AS grade FROM (SELECT 100.0 * COUNT(*) FILTER (measurement_concept_id > 0) "
    f"/ COUNT(*) AS rate FROM ({_BACKFILLED})) UNION ALL "
    "SELECT 'patients', CASE WHEN COUNT(DISTINCT person_id) > 4000000 THEN 'EXCELLENT' "
    "ELSE 'SMALL_COHORT' END FROM measurement UNION ALL "
    "SELECT 'rows', CASE WHEN COUNT(*) > 1000 THEN 'SUCCESS' ELSE 'PARTIAL' END FROM bronze "
    "UNION ALL SELECT 'files', 'MISSING_FILES' UNION ALL "
    "SELECT 'test_types', CASE WHEN COUNT(*) >= 30 THEN 'EXCELLENT' WHEN COUNT(*) > 20 THEN 'GOOD' "
    "ELSE 'FEW' END FROM (SELECT DISTINCT measurement_source_value, unit_source_value "
    "FROM measurement)",
)
def quality_grades_query(spark, sf):
    mapped = audits.quality_grades(audits.omop_validation(_backfilled(spark, sf)))
    loaded = audits.quality_grades(
        audits.bronze_stats(at.stored_loaded(spark, sf)), {"expected_rows": 1000}
    )
    types = audits.quality_grades(
        gold.datamart_lab_stats(gold.laboratory_analytics(at.stored_measurement(spark, sf), min_count=1)),
        {"expected_test_types": 30, "minimum_test_types": 20},
    )
    rows = [
        (mapped, "mapping"),
        (mapped, "patients"),
        (loaded, "rows"),
        (loaded, "files"),
        (types, "test_types"),
    ]
    return union_batches(
        [
            df.select(F.lit(m).alias("measure"), F.col(f"{m}_grade").alias("grade"))
            for df, m in rows
        ]
    )


@register(
    "sample_rows",
    "bronze",
    "SELECT patient_id, visit_id, measurement_source_value, processing_batch FROM bronze "
    "ORDER BY patient_id, visit_id, measurement_source_value LIMIT 5",
)
def sample_rows_query(spark, sf):
    order = [
        F.col(c).asc_nulls_last()
        for c in ("patient_id", "visit_id", "measurement_source_value")
    ]
    return audits.sample_rows(
        at.bronze(spark, sf),
        ["patient_id", "visit_id", "measurement_source_value", "processing_batch"],
        5,
        order,
    )


@register("limited_count", "", "SELECT 1000 AS rows")
def limited_count_query(spark, sf):
    return audits.limited_count(at.scanned(spark, sf), 1000)


@register("first_complete_rows", "", "SELECT 10 AS rows, true AS numeric_visits")
def first_complete_rows_query(spark, sf):
    rows = audits.first_complete_rows(spark, at.lab_csv(spark, sf), "27", 10)
    return rows.agg(
        F.count(F.lit(1)).alias("rows"),
        F.bool_and(F.col("visit_id").isNotNull()).alias("numeric_visits"),
    )


# ---------------------------------------------------------------- numbering and order


@register(
    "global_row_id",
    "bronze",
    "SELECT ROW_NUMBER() OVER (ORDER BY sampling_datetime_utc, patient_id, visit_id) "
    "AS measurement_id, sampling_datetime_utc, patient_id, visit_id FROM bronze",
)
def global_row_id_query(spark, sf):
    keys = ["sampling_datetime_utc", "patient_id", "visit_id"]
    numbered = global_row_id(at.stored_bronze(spark, sf), keys, "measurement_id")
    return numbered.select("measurement_id", *keys)


@register("versioned_publish", "concept", "SELECT 'concept' AS name, concept_id, concept_code FROM concept "
    "UNION ALL SELECT 'loinc', concept_id, concept_code FROM concept WHERE vocabulary_id = 'LOINC'")
def versioned_publish(spark, sf):
    """A first version, a run that stops before the switch, and the version that readers see."""
    rows = vocabulary.load_concept(at.vocab_scan(spark, sf, "CONCEPT.csv"))
    loinc = rows.filter(F.col("vocabulary_id") == "LOINC")
    database = _database(spark, "versions")
    publish_version(spark, database, {"concept": loinc, "loinc": loinc.limit(0)})
    publish_version(spark, database, {"concept": rows, "loinc": loinc})
    stopped = publish_steps(spark, database, {"concept": rows.limit(1), "loinc": loinc.limit(1)})
    for stage, _ in stopped:
        if stage == "check":
            break
    return union_batches(
        [
            published(spark, database, name).select(F.lit(name).alias("name"), "concept_id", "concept_code")
            for name in ("concept", "loinc")
        ]
    )


@register("sort_before_write", "concept", "SELECT * FROM concept")
def sort_before_write(spark, sf):
    rows = vocabulary.load_concept(at.vocab_scan(spark, sf, "CONCEPT.csv"))
    path = write_table(
        rows,
        path=new_scratch_path(spark, "sorted"),
        cluster_by=vocabulary.CONCEPT_CLUSTERING,
    )
    return spark.read.parquet(path)


@register(
    "union_all",
    "bronze loaded",
    "SELECT patient_id, visit_id, measurement_source_value, source AS source_file, "
    "CAST(NULL AS INTEGER) AS year FROM loaded UNION ALL "
    "SELECT patient_id, visit_id, measurement_source_value, NULL, year FROM bronze",
)
def union_all(spark, sf):
    columns = ["patient_id", "visit_id", "measurement_source_value"]
    return union_batches(
        [
            at.stored_loaded(spark, sf).select(*columns, "source_file"),
            at.stored_bronze(spark, sf).select(*columns, "year"),
        ]
    )
