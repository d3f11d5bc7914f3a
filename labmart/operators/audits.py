"""Statistics and checks over the tables; every result is a small frame."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from labmart.functions import not_blank, tolerant
from labmart.functions.time import SENTINEL_YEAR, as_of_date
from labmart.schemas import LAB_LAYOUTS, text_schema
from labmart.sources.discovery import validate_structure
from labmart.sources.lab import CSV_OPTIONS, scan_lab, union_batches


def _rows() -> Column:
    return F.count(F.lit(1))


def _share(part, whole) -> Column:
    """Percentage as double; NULL when the whole is zero."""
    return F.lit(100.0) * part / F.nullif(whole, F.lit(0))


def _one_row(df: DataFrame, columns: Mapping[str, Column], distinct: Mapping[str, Column]) -> DataFrame:
    """Totals over a stored table, ``distinct`` ones counted apart.

    Each distinct count reads its own column and shuffles nothing but distinct
    values; counting several in one aggregate would copy every row per count.
    The single rows meet in a union.
    """
    parts = [df.agg(*[c.alias(name) for name, c in columns.items()])]
    for name, c in distinct.items():
        values = df.select(c.alias("v")).filter(F.col("v").isNotNull()).distinct()
        parts.append(values.agg(_rows().alias(name)))
    return union_batches(parts).agg(*[F.max(n).alias(n) for n in (*columns, *distinct)])


def bronze_metrics(strict: bool = False) -> dict[str, Column]:
    """The totals of ``bronze_stats``, without its distinct counts."""
    sampling, number = F.col("sampling_datetime_utc"), F.col("value_as_number")
    span = {"earliest_sample": F.min(sampling), "latest_sample": F.max(sampling)}
    if strict:
        real_number = F.when((number != 0) & ~F.isnan(number), number)
        return {
            "total_records": _rows(),
            **span,
            "numeric_values": F.count(real_number),
            "string_values": F.count_if(not_blank("value_as_string")),
            "valid_measurements": F.count_if(not_blank("measurement_source_value")),
            "avg_numeric_value": F.avg(real_number),
            "null_dates": F.count_if(sampling.isNull()),
        }
    return {
        "total_records": _rows(),
        **span,
        "numeric_values": F.count(number),
        "string_values": F.count("value_as_string"),
        "lab_code_measurements": F.count_if(F.col("measurement_source_value").like("LC:%")),
    }


def key_metrics(as_of=None) -> dict[str, Column]:
    """The row counts of ``partition_audit`` over the year and month columns of each row."""
    last, year, month = F.year(as_of_date(as_of)), F.col("year"), F.col("month")
    return {
        "null_partition_keys": F.count_if(year.isNull() | month.isNull()),
        "invalid_years": F.count_if((year < SENTINEL_YEAR) | (year > last)),
        "invalid_months": F.count_if((month < 1) | (month > 12)),
        "sentinel_rows": F.count_if(year == SENTINEL_YEAR),
    }


def measurement_metrics() -> dict[str, Column]:
    """The totals of ``omop_validation``, without its distinct counts."""
    concept = F.col("measurement_concept_id")
    return {
        "total_measurements": _rows(),
        "mapped_measurements": F.count_if(concept > 0),
        "unmapped_measurements": F.count_if(concept == 0),
        "mapped_units": F.count_if(F.col("unit_concept_id") > 0),
        "numeric_values": F.count("value_as_number"),
        "earliest_measurement": F.min("measurement_date"),
        "latest_measurement": F.max("measurement_date"),
    }


def enhanced_metrics() -> dict[str, Column]:
    """The totals of ``enhanced_summary``, without its distinct counts."""
    return {
        "total_records": _rows(),
        "earliest_date": F.min("measurement_date"),
        "latest_date": F.max("measurement_date"),
        "avg_data_quality": F.round(F.avg("data_quality_score"), 3),
    }


class LoadAudit:
    """Totals that the job which writes a table collects on its way, without a second scan.

    Hand one to a flow; ``frame`` gives its row once the flow has returned.
    Distinct counts, which need a shuffle of their own, are not among them. If
    Spark had to repeat a finished stage of the write, its rows count twice:
    compare total_records with the table before relying on a job that lost
    executors.
    """

    def __init__(self) -> None:
        self._seen, self._schema = None, None

    def watch(self, df: DataFrame, metrics: Mapping[str, Column]) -> DataFrame:
        columns = [c.alias(name) for name, c in metrics.items()]
        self._seen, self._schema = Observation(), df.agg(*columns).schema
        return df.observe(self._seen, *columns)

    def frame(self, spark: SparkSession) -> DataFrame:
        if self._seen is None:
            raise LookupError("no flow has been given this audit")
        row = self._seen.get
        return spark.createDataFrame([tuple(row[f.name] for f in self._schema)], self._schema)


def bronze_stats(df: DataFrame, strict: bool = False) -> DataFrame:
    """Volume and coverage of a stored bronze table.

    Files and batches are counted where the columns exist. ``strict`` ignores
    blank ids and texts, visit 0, and values that are zero or NaN, and adds the
    average value and the rows without sampling time.
    """
    if strict:
        return _one_row(
            df,
            bronze_metrics(strict),
            {
                "unique_patients": F.when(not_blank("patient_id"), F.col("patient_id")),
                "unique_visits": F.when(F.col("visit_id") != 0, F.col("visit_id")),
            },
        ).select(
            "total_records",
            "unique_patients",
            "unique_visits",
            "earliest_sample",
            "latest_sample",
            "numeric_values",
            "string_values",
            "valid_measurements",
            "avg_numeric_value",
            "null_dates",
        )
    labels = {"files_processed": "source_file", "batches_processed": "processing_batch"}
    distinct = {
        "unique_patients": F.col("patient_id"),
        "unique_visits": F.col("visit_id"),
        **{name: F.col(c) for name, c in labels.items() if c in df.columns},
    }
    return _one_row(df, bronze_metrics(), distinct)


def partition_audit(df: DataFrame, as_of=None) -> DataFrame:
    """Year and month keys: span, distinct partitions, missing, invalid and sentinel rows.

    Keys are counted per (year, month) first, so the checks run over a few
    hundred rows.
    """
    last = F.year(as_of_date(as_of))
    year, month, rows = F.col("year"), F.col("month"), F.col("rows")
    good_year = (year > SENTINEL_YEAR) & (year <= last)
    keys = df.groupBy("year", "month").agg(_rows().alias("rows"))

    def rows_if(test: Column) -> Column:
        return F.coalesce(F.sum(F.when(test, rows)), F.lit(0))

    return keys.agg(
        F.count_distinct(F.when(good_year, year)).alias("years_spanned"),
        F.count_if(good_year & month.between(1, 12)).alias("total_partitions"),
        F.min(F.when(good_year, year)).alias("first_year"),
        F.max(F.when(good_year, year)).alias("last_year"),
        rows_if(year.isNull() | month.isNull()).alias("null_partition_keys"),
        rows_if((year < SENTINEL_YEAR) | (year > last)).alias("invalid_years"),
        rows_if((month < 1) | (month > 12)).alias("invalid_months"),
        rows_if(year == SENTINEL_YEAR).alias("sentinel_rows"),
    )


def patient_id_profile(raw: DataFrame) -> DataFrame:
    """Valid, NULL and empty patient ids of a raw scan, with percentages."""
    patient = F.col("patient_id")
    counts = raw.agg(
        _rows().alias("total_rows"),
        F.count_if(patient != "").alias("valid_patients"),
        F.count_if(patient.isNull()).alias("null_patients"),
        F.count_if(patient == "").alias("empty_patients"),
        F.count("sampling_datetime_utc").alias("non_null_dates"),
    )
    return counts.withColumns(
        {
            f"{kind}_pct": F.round(_share(F.col(f"{kind}_patients"), F.col("total_rows")), 2)
            for kind in ("valid", "null", "empty")
        }
    )


def scan_access_check(raw: DataFrame) -> DataFrame:
    """Rows with a patient, patients, files and sampling times of a raw scan.

    Call it on a scan itself (it reads the file path); ``accessible`` is false
    when nothing came back.
    """
    known = raw.select("patient_id", "sampling_datetime_utc", F.col("_metadata.file_path").alias("file"))
    counts = _one_row(
        known.filter(F.col("patient_id").isNotNull()),
        {"total_rows": _rows(), "non_null_timestamps": F.count("sampling_datetime_utc")},
        {"unique_patients": F.col("patient_id"), "files_accessible": F.col("file")},
    ).select("total_rows", "unique_patients", "files_accessible", "non_null_timestamps")
    return counts.withColumn("accessible", F.col("total_rows") > 0)


def access_report(spark: SparkSession, path: str, layout: str = "27", glob: str = "*.csv") -> DataFrame:
    """``scan_access_check`` over files, with failed_files; not accessible if a header is wrong.

    Headers are compared first. Where one differs from the layout nothing is
    scanned, and the counts are 0.
    """
    structure = validate_structure(spark, path, LAB_LAYOUTS[layout], glob)
    failed = structure.where("status = 'FAILED'").count()
    if failed:
        zero = {c: F.lit(0).cast("bigint") for c in ("total_rows", "unique_patients", "files_accessible", "non_null_timestamps")}
        found = spark.range(1).select(*[v.alias(k) for k, v in zero.items()], F.lit(False).alias("accessible"))
    else:
        found = scan_access_check(scan_lab(spark, path, layout))
    return found.withColumn("failed_files", F.lit(failed).cast("bigint"))


def file_distribution(df: DataFrame, n: int = 10) -> DataFrame:
    """Rows and first load time of each source file, the first ``n`` by name."""
    return (
        df.groupBy("source_file")
        .agg(_rows().alias("row_count"), F.min("load_timestamp").alias("processed_at"))
        .orderBy("source_file")
        .limit(n)
    )


def top_lab_codes(df: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` most frequent test codes; equal counts in code order."""
    return (
        df.filter(F.col("measurement_source_value").isNotNull())
        .groupBy("measurement_source_value")
        .agg(_rows().alias("frequency"))
        .orderBy(F.desc("frequency"), "measurement_source_value")
        .limit(n)
    )


def row_counts(tables: Mapping[str, DataFrame], minimum: Mapping[str, int] | None = None) -> DataFrame:
    """One row per table: name, rows, and whether the required minimum is met."""
    counted = [
        df.agg(_rows().alias("rows")).select(
            F.lit(name).alias("table_name"),
            "rows",
            (F.col("rows") >= (minimum or {}).get(name, 0)).alias("enough"),
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def enhanced_summary(enhanced: DataFrame, label: str = "enhanced bronze") -> DataFrame:
    """Totals over enhanced bronze."""
    return _one_row(
        enhanced,
        enhanced_metrics(),
        {"unique_patients": F.col("person_id_hash"), "unique_visits": F.col("visit_id")},
    ).select(F.lit(label).alias("summary_type"), "*")


def omop_validation(measurement: DataFrame) -> DataFrame:
    """Mapping and value coverage of a stored MEASUREMENT table."""
    concept = F.col("measurement_concept_id")
    counts = _one_row(
        measurement,
        measurement_metrics(),
        {"unique_patients": F.col("person_id"), "unique_concepts": concept},
    )
    rate = _share(F.col("mapped_measurements"), F.col("total_measurements"))
    return counts.withColumn("mapping_rate_pct", F.coalesce(rate, F.lit(0.0)))


def reconcile(expected: DataFrame, actual: DataFrame, key: str = "source_file") -> DataFrame:
    """Compare row counts per source file, plus one total row (key NULL, ``is_total``).

    Both sides are counted before they meet, so the join handles one row per
    file.
    """
    left = expected.groupBy(key).agg(_rows().alias("expected_rows"))
    right = actual.groupBy(key).agg(_rows().alias("actual_rows"))
    merged = left.join(right, key, "full_outer")
    totals = merged.rollup(key).agg(
        F.grouping(key).cast("boolean").alias("is_total"),
        F.coalesce(F.sum("expected_rows"), F.lit(0)).alias("expected_rows"),
        F.coalesce(F.sum("actual_rows"), F.lit(0)).alias("actual_rows"),
    )
    want, got = F.col("expected_rows"), F.col("actual_rows")
    return totals.withColumns(
        {
            "verdict": F.when(got == want, "MATCH")
            .when(got < want, "FILTERED_OUT")
            .otherwise("DUPLICATES"),
            "difference": F.abs(got - want),
            "difference_pct": F.round(_share(F.abs(got - want), want), 2),
            "success_rate_pct": F.round(_share(got, want), 2),
        }
    )


def reconcile_content(
    expected: DataFrame, actual: DataFrame, columns: list[str], key: str = "source_file"
) -> DataFrame:
    """``reconcile`` that also compares what the rows hold, by the given columns.

    Each side sums two 64-bit hashes of its rows per file, which neither order
    nor partitioning changes and in which repeated rows count as often as they
    occur. A file of as many rows as expected, but not the same ones, is
    CHANGED; so is the total if any file is.
    """
    def side(df: DataFrame, name: str) -> DataFrame:
        hashes = [F.xxhash64(*[F.lit(seed), *columns]).cast("decimal(38,0)") for seed in (1, 2)]
        sums = [F.sum(h).alias(f"__{name}{i}") for i, h in enumerate(hashes)]
        return df.groupBy(key).agg(_rows().alias(f"__{name}"), *sums)

    merged = side(expected, "want").join(side(actual, "got"), key, "full_outer")
    equal = F.lit(True)
    for i in range(2):
        equal = equal & F.col(f"__want{i}").eqNullSafe(F.col(f"__got{i}"))
    totals = merged.rollup(key).agg(
        F.grouping(key).cast("boolean").alias("is_total"),
        F.coalesce(F.sum("__want"), F.lit(0)).alias("expected_rows"),
        F.coalesce(F.sum("__got"), F.lit(0)).alias("actual_rows"),
        F.bool_and(equal).alias("same_content"),
    )
    want, got = F.col("expected_rows"), F.col("actual_rows")
    verdict = (
        F.when(got < want, "FILTERED_OUT").when(got > want, "DUPLICATES")
        .when(F.col("same_content"), "MATCH").otherwise("CHANGED")
    )
    return totals.withColumn("verdict", verdict)


def glob_profile(raw: DataFrame, label: Column | None = None) -> DataFrame:
    """Rows, files, first and last file, rows per file and largest patient id of a scan.

    ``label`` replaces the file name as the unit that is counted.
    """
    name = F.col("_metadata.file_name") if label is None else label
    per_file = raw.groupBy(name.alias("file")).agg(
        _rows().alias("rows"), F.max("patient_id").alias("max_patient")
    )
    return per_file.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows"),
        _rows().alias("file_count"),
        F.min("file").alias("first_file"),
        F.max("file").alias("last_file"),
        (F.sum("rows") / F.nullif(_rows(), F.lit(0))).alias("rows_per_file"),
        F.max("max_patient").alias("sample_id"),
    )


# Limits of the reports; override per site.
GRADE_LIMITS = {
    "mapping_excellent_pct": 80.0,
    "mapping_good_pct": 60.0,
    "expected_files": 998,
    "expected_files_large": 2000,
    "expected_rows": 600_000_000,
    "expected_patients": 4_000_000,
    "expected_test_types": 100,
    "minimum_test_types": 50,
}


def coverage(stats: DataFrame) -> DataFrame:
    """Coverage percentages over a strict ``bronze_stats`` row."""
    total = F.col("total_records")
    return stats.select(
        _share(F.col("unique_patients"), total).alias("patients_per_row_pct"),
        _share(F.col("numeric_values"), total).alias("numeric_coverage_pct"),
        _share(F.col("valid_measurements"), total).alias("measurement_coverage_pct"),
        _share(total - F.col("null_dates"), total).alias("date_quality_pct"),
    )


def quality_grades(stats: DataFrame, limits: Mapping[str, float] | None = None) -> DataFrame:
    """Grades for whichever measures ``stats`` has.

    Known measures: mapping_rate_pct, files_processed, total_records,
    unique_patients (patients), unique_lab_test_types.
    """
    at = {**GRADE_LIMITS, **(limits or {})}
    grades = {}
    if "mapping_rate_pct" in stats.columns:
        rate = F.col("mapping_rate_pct")
        grades["mapping_grade"] = (
            F.when(rate >= at["mapping_excellent_pct"], "EXCELLENT")
            .when(rate >= at["mapping_good_pct"], "GOOD")
            .otherwise("POOR")
        )
    if "files_processed" in stats.columns:
        files = F.col("files_processed")
        grades["files_grade"] = (
            F.when(files >= at["expected_files_large"], "COMPLETE_LARGE")
            .when(files >= at["expected_files"], "COMPLETE")
            .otherwise("MISSING_FILES")
        )
    if "total_records" in stats.columns:
        enough = F.col("total_records") > at["expected_rows"]
        grades["rows_grade"] = F.when(enough, "SUCCESS").otherwise("PARTIAL")
    if "unique_patients" in stats.columns:
        enough = F.col("unique_patients") > at["expected_patients"]
        grades["patients_grade"] = F.when(enough, "EXCELLENT").otherwise("SMALL_COHORT")
    if "unique_lab_test_types" in stats.columns:
        types = F.col("unique_lab_test_types")
        grades["test_types_grade"] = (
            F.when(types >= at["expected_test_types"], "EXCELLENT")
            .when(types > at["minimum_test_types"], "GOOD")
            .otherwise("FEW")
        )
    return stats.select("*", *[grade.alias(name) for name, grade in grades.items()])


def sample_rows(df: DataFrame, columns: list[str], n: int = 5, order_by=None) -> DataFrame:
    """``n`` rows of the chosen columns; repeatable only with ``order_by``."""
    rows = df if order_by is None else df.orderBy(*order_by)
    return rows.select(*columns).limit(n)


def limited_count(df: DataFrame, n: int = 1000) -> DataFrame:
    """Rows found when at most ``n`` are read: a cheap test that a scan works."""
    return df.limit(n).agg(_rows().alias("rows"))


def first_complete_rows(spark, path: str, layout: str = "15", n: int = 10) -> DataFrame:
    """The first ``n`` rows that have all fields; a visit id that is not all digits is NULL."""
    columns = LAB_LAYOUTS[layout]
    rows = (
        spark.read.schema(text_schema(columns))
        .options(**CSV_OPTIONS)
        .option("mode", "DROPMALFORMED")
        .csv(path)
        .limit(n)
    )
    visit = F.when(F.col("visit_id").rlike("^[0-9]+$"), tolerant("visit_id", "bigint"))
    return rows.withColumn("visit_id", visit)
