"""SQL text for the comparison engine: common table expressions and a composer."""

from __future__ import annotations

# The unit texts in the order of the part key (mod 20).
_UNIT_CASES = " ".join(
    f"WHEN {i} THEN '{unit}'"
    for i, unit in enumerate(
        [
            "mg/dL", "mmol/L", "nmol/L", "g/dL", "U/L", "/uL", "%", "log copies/mL",
            "mOsm/kg", "cells/µL", "copies/mL", "cells/uL", "/µL",
        ]
    )
)

_NO_VALUE = [
    "sub_laboratory_uuid", "site_laboratory_uuid", "debug_external_test_id",
    "debug_external_test_scope", "sampling_datetime_timezone", "result_datetime_timezone",
    "internal_numerical_unit_system", "internal_numerical_reference_min",
    "internal_numerical_reference_max", "internal_categorical_qualification", "bacterium_id",
    "range_type",
]

LAB = f"""
SELECT
  CAST(l_orderkey AS VARCHAR) AS visit_id,
  CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS visit_date_utc,
  CAST(l_linenumber AS VARCHAR) AS visit_rank,
  CASE WHEN o_custkey % 50 = 7 THEN NULL
       WHEN o_custkey % 50 = 9 THEN 'P' || CAST(o_custkey AS VARCHAR)
       ELSE CAST(o_custkey AS VARCHAR) END AS patient_id,
  CAST(l_suppkey AS VARCHAR) AS report_id,
  'LAB-' || CAST(l_suppkey AS VARCHAR) AS laboratory_uuid,
  CASE WHEN l_partkey % 40 = 3 THEN NULL
       ELSE 'LC:' || LPAD(CAST(l_partkey % 20 AS VARCHAR), 4, '0') END AS measurement_source_value,
  CASE WHEN l_linenumber = 1 THEN NULL ELSE CAST(l_shipdate AS VARCHAR) END AS sampling_datetime_utc,
  CASE WHEN l_linenumber = 1 AND l_partkey % 3 = 0 THEN NULL
       ELSE CAST(l_shipdate + INTERVAL 1 DAY AS VARCHAR) END AS result_datetime_utc,
  CASE WHEN l_partkey % 30 = 0 THEN NULL
       ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS report_date_utc,
  CASE WHEN l_returnflag = 'A' THEN 'ABNORMAL' WHEN l_returnflag = 'R' THEN ' high '
       WHEN l_linestatus = 'O' THEN 'Normal' ELSE 'LOW' END AS normality,
  CASE WHEN l_partkey % 10 = 4 THEN 'CATEGORICAL' ELSE 'NUMERIC' END AS value_type,
  CASE WHEN l_partkey % 10 = 4 THEN NULL ELSE CAST(l_quantity AS VARCHAR) END AS value_as_number,
  CASE WHEN l_partkey % 10 = 4 AND l_linenumber <> 2 THEN 'positive' END AS value_as_string,
  CASE WHEN l_linenumber = 7 THEN ''
       ELSE CASE l_partkey % 20 {_UNIT_CASES} ELSE 'other' END END AS unit_source_value,
  {", ".join(f"CAST(NULL AS VARCHAR) AS {c}" for c in _NO_VALUE)},
  CAST(year(o_orderdate) AS VARCHAR) AS source
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""

# What a scan gives for the written files: an empty unit comes back as NULL.
SCANNED = "SELECT * REPLACE (NULLIF(unit_source_value, '') AS unit_source_value) FROM lab"


def typed(source: str) -> str:
    return f"""
SELECT
  patient_id,
  TRY_CAST(visit_id AS BIGINT) AS visit_id,
  TRY_CAST(sampling_datetime_utc AS TIMESTAMP) AS sampling_datetime_utc,
  TRY_CAST(result_datetime_utc AS TIMESTAMP) AS result_datetime_utc,
  TRY_CAST(report_date_utc AS DATE) AS report_date_utc,
  measurement_source_value,
  TRY_CAST(value_as_number AS DOUBLE) AS value_as_number,
  value_as_string, unit_source_value, normality, '' AS abnormal_flag, value_type, bacterium_id,
  report_id AS provider_id,
  laboratory_uuid,
  TIMESTAMP '2024-01-01 12:00:00' AS load_timestamp,
  'registry' AS processing_batch,
  CAST(COALESCE(year(TRY_CAST(sampling_datetime_utc AS TIMESTAMP)), 1900) AS INTEGER) AS year,
  CAST(COALESCE(month(TRY_CAST(sampling_datetime_utc AS TIMESTAMP)), 1) AS INTEGER) AS month,
  source
FROM {source}
"""


# Fixed values, as in labmart/mappings.py.
_UNIT_IDS = (
    "CASE unit_source_value WHEN 'mg/dL' THEN 8840 WHEN 'mmol/L' THEN 8753 WHEN 'nmol/L' THEN 8753 "
    "WHEN 'g/dL' THEN 8713 WHEN 'U/L' THEN 8645 WHEN '/uL' THEN 8647 WHEN '%' THEN 8554 "
    "WHEN 'log copies/mL' THEN 8519 WHEN 'mOsm/kg' THEN 8720 WHEN 'cells/µL' THEN 8647 "
    "WHEN 'copies/mL' THEN 8519 WHEN 'cells/uL' THEN 8647 WHEN '/µL' THEN 8647 ELSE 0 END"
)

# Fixed values, as in labmart/mappings.py.
NORMALITY_ID = (
    "CAST(CASE UPPER(TRIM(normality)) WHEN 'NORMAL' THEN 4124457 WHEN 'ABNORMAL' THEN 4135493 "
    "WHEN 'HIGH' THEN 4328749 WHEN 'LOW' THEN 4124457 ELSE 0 END AS INTEGER)"
)
UNIT_ID = f"CAST({_UNIT_IDS} AS INTEGER)"

# Fixed values, as in labmart/mappings.py.
CATEGORY = (
    "CASE WHEN unit_source_value IN ('mg/dL', 'mmol/L', 'nmol/L', 'g/dL') THEN 'Chemistry' "
    "WHEN unit_source_value = 'U/L' THEN 'Enzymes' "
    "WHEN unit_source_value IN ('cells/µL', 'cells/uL', '/uL', '/µL') THEN 'Hematology' "
    "WHEN unit_source_value IN ('log copies/mL', 'copies/mL') THEN 'Virology' "
    "WHEN unit_source_value = 'mOsm/kg' THEN 'Osmolality' "
    "WHEN unit_source_value = '%' THEN 'Percentage' ELSE 'Other' END"
)

# CRC-32 of an ASCII text, byte by byte over the usual reflected table.
CRC_TABLE = """
SELECT list(entry ORDER BY i) AS entries FROM (
  SELECT i, list_reduce([0, 1, 2, 3, 4, 5, 6, 7], lambda c, step:
      CASE WHEN c & 1 = 1 THEN xor(CAST(3988292384 AS BIGINT), c >> 1) ELSE c >> 1 END,
      CAST(i AS BIGINT)) AS entry
  FROM range(256) AS r(i))
"""


def crc32(text: str) -> str:
    """CRC-32 as an expression; the query must join the one row of ``crc_table``."""
    codes = f"list_transform(string_split({text}, ''), lambda ch: CAST(ord(ch) AS BIGINT))"
    step = (
        "xor(c >> 8, entries[CAST(xor(c, b) & 255 AS INTEGER) + 1])"
    )
    return (
        f"xor(list_reduce({codes}, lambda c, b: {step}, CAST(4294967295 AS BIGINT)), "
        "CAST(4294967295 AS BIGINT))"
    )


MEASUREMENT = f"""
SELECT
  TRY_CAST(patient_id AS BIGINT) AS person_id,
  0 AS measurement_concept_id,
  COALESCE(CAST(sampling_datetime_utc AS DATE), CAST(result_datetime_utc AS DATE),
           report_date_utc, DATE '2002-01-01') AS measurement_date,
  COALESCE(sampling_datetime_utc, result_datetime_utc, CAST(report_date_utc AS TIMESTAMP),
           TIMESTAMP '2002-01-01 00:00:00') AS measurement_datetime,
  44818702 AS measurement_type_concept_id,
  4172703 AS operator_concept_id,
  value_as_number,
  CASE WHEN value_as_string IS NOT NULL AND value_as_number IS NULL THEN 0 END AS value_as_concept_id,
  {UNIT_ID} AS unit_concept_id,
  CAST(NULL AS DOUBLE) AS range_low,
  CAST(NULL AS DOUBLE) AS range_high,
  TRY_CAST(provider_id AS BIGINT) AS provider_id,
  visit_id AS visit_occurrence_id,
  CAST(NULL AS BIGINT) AS visit_detail_id,
  measurement_source_value,
  0 AS measurement_source_concept_id,
  unit_source_value,
  {UNIT_ID} AS unit_source_concept_id,
  value_as_string AS value_source_value,
  {NORMALITY_ID} AS measurement_event_id,
  CAST(NULL AS BIGINT) AS meas_event_field_concept_id,
  CAST(year(COALESCE(CAST(sampling_datetime_utc AS DATE), CAST(result_datetime_utc AS DATE),
            report_date_utc, DATE '2002-01-01')) AS INTEGER) AS measurement_year,
  CAST(month(COALESCE(CAST(sampling_datetime_utc AS DATE), CAST(result_datetime_utc AS DATE),
             report_date_utc, DATE '2002-01-01')) AS INTEGER) AS measurement_month,
  patient_id, laboratory_uuid
FROM bronze
WHERE TRY_CAST(patient_id AS BIGINT) IS NOT NULL AND TRIM(measurement_source_value) <> ''
"""

MISSING = "value_as_number IS NULL AND value_source_value IS NULL"

PATIENT_SUMMARY = f"""
SELECT person_id,
  COUNT(*) AS total_measurements,
  COUNT(DISTINCT measurement_date) AS unique_measurement_dates,
  COUNT(value_as_number) AS numeric_measurements,
  COUNT(*) FILTER (unit_concept_id > 0) AS measurements_with_units,
  MIN(measurement_date) AS first_measurement_date,
  MAX(measurement_date) AS last_measurement_date,
  date_diff('day', MIN(measurement_date), MAX(measurement_date)) AS measurement_span_days,
  COUNT(DISTINCT measurement_source_value) AS unique_lab_tests,
  COUNT(*) FILTER (measurement_event_id = 4135493) AS abnormal_results,
  COUNT(*) FILTER (measurement_event_id = 4328749) AS high_results,
  COUNT(*) FILTER (measurement_event_id = 4124457) AS normal_low_results,
  AVG(value_as_number) AS avg_numeric_value,
  MIN(value_as_number) AS min_numeric_value,
  MAX(value_as_number) AS max_numeric_value,
  ROUND(STDDEV_SAMP(value_as_number), 6) AS stddev_numeric_value,
  COUNT(*) FILTER ({MISSING}) AS missing_value_count,
  COUNT(DISTINCT year(measurement_date)) AS active_years,
  COUNT(DISTINCT month(measurement_date)) AS active_months,
  CAST(year(MIN(measurement_date)) AS INTEGER) AS patient_year_of_first_measurement
FROM measurement WHERE person_id IS NOT NULL GROUP BY person_id
"""

MEASUREMENT_TRENDS = f"""
SELECT measurement_year, measurement_month, measurement_date, measurement_source_value,
  unit_source_value,
  COUNT(*) AS daily_test_count,
  COUNT(DISTINCT person_id) AS daily_unique_patients,
  AVG(value_as_number) AS daily_avg_value,
  ROUND(QUANTILE_CONT(value_as_number, 0.5), 6) AS daily_median_value,
  ROUND(QUANTILE_CONT(value_as_number, 0.25), 6) AS daily_p25_value,
  ROUND(QUANTILE_CONT(value_as_number, 0.75), 6) AS daily_p75_value,
  MIN(value_as_number) AS daily_min_value,
  MAX(value_as_number) AS daily_max_value,
  ROUND(STDDEV_SAMP(value_as_number), 6) AS daily_stddev_value,
  COUNT(*) FILTER (measurement_event_id = 4135493) AS daily_abnormal_count,
  COUNT(*) FILTER (measurement_event_id = 4328749) AS daily_high_count,
  COUNT(*) FILTER (measurement_event_id = 4124457) AS daily_normal_low_count,
  ROUND(100.0 * COUNT(*) FILTER (measurement_event_id = 4135493) / COUNT(*), 2) AS pct_abnormal,
  ROUND(100.0 * COUNT(value_as_number) / COUNT(*), 2) AS pct_numeric,
  COUNT(*) FILTER ({MISSING}) AS daily_missing_values
FROM measurement
WHERE measurement_date IS NOT NULL AND measurement_source_value IS NOT NULL
GROUP BY ALL
"""


def laboratory_analytics(min_count: int, integer: bool = False) -> str:
    divide = "//" if integer else "/"
    return f"""
SELECT measurement_source_value AS lab_test_code, unit_source_value AS lab_unit,
  {CATEGORY} AS test_category,
  COUNT(*) AS total_test_count,
  COUNT(DISTINCT person_id) AS unique_patients_tested,
  COUNT(DISTINCT measurement_date) AS unique_test_dates,
  MIN(measurement_date) AS earliest_test_date,
  MAX(measurement_date) AS latest_test_date,
  date_diff('day', MIN(measurement_date), MAX(measurement_date)) AS test_span_days,
  COUNT(value_as_number) AS numeric_result_count,
  AVG(value_as_number) AS avg_numeric_result,
  ROUND(QUANTILE_CONT(value_as_number, 0.5), 6) AS median_numeric_result,
  MIN(value_as_number) AS min_numeric_result,
  MAX(value_as_number) AS max_numeric_result,
  ROUND(STDDEV_SAMP(value_as_number), 6) AS stddev_numeric_result,
  ROUND(QUANTILE_CONT(value_as_number, 0.025), 6) AS p2_5_value,
  ROUND(QUANTILE_CONT(value_as_number, 0.975), 6) AS p97_5_value,
  COUNT(*) FILTER (measurement_event_id = 4135493) AS abnormal_result_count,
  COUNT(*) FILTER (measurement_event_id = 4328749) AS high_result_count,
  COUNT(*) FILTER (measurement_event_id = 4124457) AS normal_low_result_count,
  ROUND(100.0 * COUNT(*) FILTER (measurement_event_id = 4135493) / COUNT(*), 2) AS pct_abnormal,
  ROUND(100.0 * COUNT(value_as_number) / COUNT(*), 2) AS pct_numeric,
  COUNT(*) FILTER ({MISSING}) AS missing_value_count,
  ROUND(100.0 * COUNT(*) FILTER ({MISSING}) / COUNT(*), 2) AS pct_missing,
  COUNT(*) {divide} COUNT(DISTINCT person_id) AS avg_tests_per_patient,
  COUNT(*) {divide} NULLIF(date_diff('day', MIN(measurement_date), MAX(measurement_date)), 0)
    AS avg_tests_per_day
FROM measurement
WHERE measurement_source_value <> ''
GROUP BY measurement_source_value, unit_source_value
HAVING COUNT(*) >= {min_count}
"""


CONCEPT_TEXT = """
SELECT
  CASE WHEN p_partkey % 97 = 5 THEN 'unassigned'
       ELSE CAST(p_partkey + 3000000 AS VARCHAR) END AS concept_id,
  p_name AS concept_name, p_type AS domain_id,
  CASE WHEN p_partkey % 4 = 3 THEN 'Local' ELSE 'LOINC' END AS vocabulary_id,
  p_brand AS concept_class_id,
  CASE WHEN p_partkey % 2 = 0 THEN 'S' END AS standard_concept,
  'LC:' || CASE WHEN p_partkey < 10000 THEN LPAD(CAST(p_partkey AS VARCHAR), 4, '0')
                ELSE CAST(p_partkey AS VARCHAR) END AS concept_code,
  CASE WHEN p_partkey % 3 = 0 THEN '19700101' ELSE '1970-01-01' END AS valid_start_date,
  '20991231' AS valid_end_date,
  CASE WHEN p_partkey % 11 = 0 THEN 'D' END AS invalid_reason
FROM part
"""

CONCEPT = """
SELECT TRY_CAST(concept_id AS BIGINT) AS concept_id, concept_name, domain_id, vocabulary_id,
  concept_class_id, standard_concept, concept_code,
  DATE '1970-01-01' AS valid_start_date, DATE '2099-12-31' AS valid_end_date, invalid_reason
FROM concept_text WHERE TRY_CAST(concept_id AS BIGINT) IS NOT NULL
"""

VOCABULARY_TEXT = """
SELECT 'V' || LPAD(CAST(s_suppkey AS VARCHAR), 6, '0') AS vocabulary_id,
  s_name AS vocabulary_name, 'reference text' AS vocabulary_reference,
  CASE WHEN s_nationkey % 2 = 0 THEN 'v1' END AS vocabulary_version,
  CASE WHEN s_suppkey % 7 = 0 THEN 'none'
       ELSE CAST(s_suppkey + 44000000 AS VARCHAR) END AS vocabulary_concept_id
FROM supplier
"""

RELATION = """
SELECT l_partkey + 3000000 AS concept_id_1, l_suppkey + 44000000 AS concept_id_2,
  CASE WHEN l_returnflag = 'R' THEN 'Maps to' ELSE 'Is a' END AS relationship_id,
  CAST(l_shipdate AS DATE) AS valid_start_date, DATE '2099-12-31' AS valid_end_date,
  CAST(NULL AS VARCHAR) AS invalid_reason
FROM lineitem WHERE l_suppkey % 13 <> 0
"""

DOMAIN = """
SELECT 'D' || CAST(c_custkey AS VARCHAR) AS domain_id, c_name AS domain_name,
  CAST(c_nationkey AS VARCHAR) AS domain_concept_id
FROM customer
"""

# Name, text and the names it builds on.
_PARTS = {
    "lab": (LAB, []),
    "scanned": (SCANNED, ["lab"]),
    "bronze": (typed("lab"), ["lab"]),
    "loaded": (typed("scanned"), ["scanned"]),
    "measurement": (MEASUREMENT, ["bronze"]),
    "patient_summary": (PATIENT_SUMMARY, ["measurement"]),
    "concept_text": (CONCEPT_TEXT, []),
    "concept": (CONCEPT, ["concept_text"]),
    "vocabulary_text": (VOCABULARY_TEXT, []),
    "relation": (RELATION, []),
    "domain": (DOMAIN, []),
    "crc_table": (CRC_TABLE, []),
}


def compose(names: str, body: str) -> str:
    """``body`` preceded by the named common table expressions and what they need."""
    needed: list[str] = []

    def add(name: str) -> None:
        if name not in needed:
            for base in _PARTS[name][1]:
                add(base)
            needed.append(name)

    for name in names.split():
        add(name)
    if not needed:
        return body
    ctes = ",\n".join(f"{name} AS ({_PARTS[name][0].strip()})" for name in needed)
    return f"WITH {ctes}\n{body}"
