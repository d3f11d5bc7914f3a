"""The layers end to end: files to bronze, bronze to silver, silver to gold."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labmart.functions import person_hash64
from labmart.functions.time import SENTINEL_YEAR
from labmart.operators.access import Bucket
from labmart.operators.audits import (
    LoadAudit,
    bronze_metrics,
    enhanced_metrics,
    key_metrics,
    measurement_metrics,
    omop_validation,
)
from labmart.operators.bronze import bronze_typed, enhance, numbered_rows, sampling_parsed
from labmart.operators.concepts import concept_backfill
from labmart.operators.gold import laboratory_analytics, measurement_trends, patient_summary
from labmart.operators.silver import omop_measurement
from labmart.operators.vocabulary import (
    CONCEPT_CLUSTERING,
    RELATIONSHIP_CLUSTERING,
    load_concept,
    load_concept_relationship,
    load_domain,
    load_vocabulary,
    vocab_validation,
)
from labmart.session import MIB, scratch_table, shuffle_partitions_for, sql_settings
from labmart.sinks import run_name, staged_publish, with_bucket_column, write_table
from labmart.sinks.tables import arrange
from labmart.sources import detect_separator, discover_files, require_files, scan_lab, scan_vocab

# Tasks and ranges whose rows, several times as large as their files, fit into memory.
TYPED_SPLIT, RANGE_TEXT = "16m", 64 * MIB
BRONZE_CLUSTERING = ["patient_id", "measurement_source_value"]


def csv_to_bronze(
    spark: SparkSession,
    path: str,
    table: str,
    batch: str,
    layout: str = "27",
    run_id: str | None = None,
    run_ts=None,
    keep_patients: str = "all",
    partitions: int | None = None,
    audit: LoadAudit | None = None,
) -> str:
    """CSV files to a bronze table by year and month, clustered by patient and test.

    Range clustering reads its input twice, once to find the ranges and once to
    move the rows. So typed rows are first stored as they come, without a
    shuffle: the text is parsed once, both passes read columns, and the stored
    rows are removed at the end. The number of ranges follows from the size of
    the files. Fails if there are none. ``audit`` receives the totals of
    ``bronze_stats`` and ``partition_audit`` from the first pass.
    """
    files = require_files(discover_files(spark, path))
    size = files.agg(F.sum("size")).first()[0] or 0
    raw = scan_lab(spark, path, layout, source_file=True)
    typed = bronze_typed(raw, batch, run_ts, keep_patients, partition_columns=True)
    if audit is not None:
        typed = audit.watch(typed, bronze_metrics() | key_metrics())
    with scratch_table(spark, typed, "typed") as bronze, sql_settings(spark, files__maxPartitionBytes=TYPED_SPLIT):
        return write_table(
            bronze,
            run_name(table, run_id),
            partition_by=["year", "month"],
            cluster_by=BRONZE_CLUSTERING,
            partitions=partitions or shuffle_partitions_for(size, RANGE_TEXT),
        )


#: Buckets of the enhanced table by the hash of the patient.
ENHANCED_BUCKETS = 16


def bronze_to_enhanced(
    spark: SparkSession,
    bronze: DataFrame,
    table: str,
    version: int = 7,
    run_id: str | None = None,
    salt: str | None = None,
    audit: LoadAudit | None = None,
) -> str:
    """Bronze rows with hashes, scores and row ids, by bucket of the patient's hash and year.

    ``bronze`` is text for version 7, typed for version 5. The rows are moved
    once, before hashes and scores are derived from them. ``enhanced_bucket``
    reads the table back by patient.
    """
    keys = ["patient_bucket", "measurement_year"]
    sampling = sampling_parsed() if version == 7 else F.col("sampling_datetime_utc").cast("date")
    rows = with_bucket_column(
        numbered_rows(bronze, version).withColumn("__patient", person_hash64("patient_id", salt)),
        "__patient", ENHANCED_BUCKETS, "patient_bucket",
    ).drop("__patient")
    placed = arrange(rows.withColumn("measurement_year", F.year(sampling)), keys)
    # Derived once more: the partition columns come last, and the row id before them.
    enhanced = enhance(placed, version, salt)
    last = ["measurement_id", *(["measurement_year"] if version == 5 else []), "patient_bucket"]
    enhanced = enhanced.select(*[c for c in enhanced.columns if c not in last], *last)
    if audit is not None:
        enhanced = audit.watch(enhanced, enhanced_metrics())
    return write_table(enhanced, run_name(table, run_id), partition_by=keys, in_place=True)


def enhanced_bucket(salt: str | None = None) -> Bucket:
    """For ``cohort_filter`` over an enhanced table: reads only the buckets of the patients."""
    return Bucket("patient_bucket", ENHANCED_BUCKETS, lambda patient: person_hash64(patient, salt))


def bronze_to_silver(
    spark: SparkSession,
    bronze: str,
    table: str,
    run_id: str | None = None,
    as_of=None,
    unit_map=None,
    concept: DataFrame | None = None,
    code_map: DataFrame | None = None,
    audit: LoadAudit | None = None,
) -> str:
    """Bronze table to MEASUREMENT by year and month; returns the new table's name.

    Bronze by year and month of the sampling time already lies where it has to
    be: only the partition of rows without that time is exchanged, as their
    other dates decide. With ``concept``, both concept ids are filled from the
    vocabulary, in the same pass, and all rows are placed anew. ``validate_silver`` gives the report over the written table,
    ``audit`` its totals without another scan.
    """
    rows, keys = spark.table(bronze), ["measurement_year", "measurement_month"]
    # Concepts may have to be joined by a shuffle, after which rows lie by code.
    stays = concept is None and {"year", "month"} <= set(rows.columns)
    if stays:
        undated = (F.col("year") == SENTINEL_YEAR) & (F.col("month") == 1)
        moved = omop_measurement(rows.where(undated), unit_map, as_of)
        measurement = omop_measurement(rows.where(~undated), unit_map, as_of).unionByName(
            moved.hint("rebalance", *[F.col(c) for c in keys])
        )
    else:
        measurement = omop_measurement(rows, unit_map, as_of)
    if concept is not None:
        measurement = concept_backfill(measurement, concept, code_map)
    if audit is not None:
        measurement = audit.watch(measurement, measurement_metrics())
    return write_table(measurement, run_name(table, run_id), partition_by=keys, in_place=stays)


def validate_silver(spark: SparkSession, silver: str) -> DataFrame:
    """Mapping rates and volumes of a stored MEASUREMENT table."""
    return omop_validation(spark.table(silver))


def silver_to_gold(
    spark: SparkSession, silver: str, database: str, run_id: str | None = None, min_count: int = 1000
) -> dict[str, str]:
    """The three research tables from one MEASUREMENT table; names by product."""
    measurement = spark.table(silver)
    products = {
        "patient_summary": (
            patient_summary(measurement),
            ["patient_year_of_first_measurement"],
        ),
        "measurement_trends": (
            measurement_trends(measurement),
            ["measurement_year", "measurement_month"],
        ),
        "laboratory_analytics": (
            laboratory_analytics(measurement, min_count),
            ["test_category"],
        ),
    }
    return {
        name: write_table(df, run_name(f"{database}.{name}", run_id), partition_by=keys)
        for name, (df, keys) in products.items()
    }


def _at_least(minimum: int):
    def check(df: DataFrame) -> list[str]:
        found = df.limit(minimum).count()
        return [] if found >= minimum else [f"{found} rows, expected at least {minimum}"]

    return check


def _vocabulary_complaints(df: DataFrame) -> list[str]:
    row = vocab_validation(df).first()
    return [f"not {rule}" for rule in ("not_empty", "unique_ids", "has_names") if not row[rule]]


def load_vocabularies(
    spark: SparkSession, path: str, database: str, min_concepts: int = 10_000, domain: bool = True
):
    """Vocabulary files to tables, published together once all checks pass."""
    sep = detect_separator(spark, path)

    def scan(file: str) -> DataFrame:
        return scan_vocab(spark, path, file, sep)

    tables = {
        "vocabulary": load_vocabulary(scan("VOCABULARY.csv")),
        "concept": load_concept(scan("CONCEPT.csv")),
        "concept_relationship": load_concept_relationship(scan("CONCEPT_RELATIONSHIP.csv")),
    }
    if domain:
        tables["domain"] = load_domain(scan("DOMAIN.csv"))
    return staged_publish(
        spark,
        database,
        tables,
        checks={
            "vocabulary": _vocabulary_complaints,
            "concept": _at_least(min_concepts),
            "concept_relationship": _at_least(1),
        },
        layouts={
            "concept": {"cluster_by": CONCEPT_CLUSTERING},
            "concept_relationship": {"cluster_by": RELATIONSHIP_CLUSTERING},
        },
    )
