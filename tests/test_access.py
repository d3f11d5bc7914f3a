"""Cohorts over tables by patient bucket."""

from pyspark.sql import functions as F

from labmart.operators.access import Bucket, cohort_filter
from labmart.plans import bronze_to_enhanced, enhanced_bucket
from labmart.sinks import with_bucket_column, write_table


def bucketed(spark, tmp_path):
    rows = spark.range(2000).select((F.col("id") % 100).cast("string").alias("patient_id"), F.col("id").alias("v"))
    path = write_table(with_bucket_column(rows, "patient_id", 16), path=str(tmp_path / "t"), partition_by=["patient_id_bucket"])
    return spark.read.parquet(path)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_list_prunes_when_planned(spark, tmp_path):
    df, bucket = bucketed(spark, tmp_path), Bucket("patient_id_bucket", 16)
    found = cohort_filter(df, ["7", "7", "nobody"], bucket)
    assert found.count() == 20 == cohort_filter(df, ["7", "nobody"]).count()
    filters = next(x for x in plan_of(found).splitlines() if "PartitionFilters" in x)
    assert "patient_id_bucket" in filters.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert found.select("patient_id_bucket").distinct().count() == 1


def test_frame_prunes_at_run_time(spark, tmp_path):
    df, bucket = bucketed(spark, tmp_path), Bucket("patient_id_bucket", 16)
    people = spark.range(100).select(F.col("id").cast("string").alias("patient_id"), F.col("id").alias("age"))
    people.write.parquet(str(tmp_path / "people"))
    cohort = spark.read.parquet(str(tmp_path / "people")).where("age < 3")
    found = cohort_filter(df, cohort, bucket)
    assert "dynamicpruning" in plan_of(found)
    assert found.count() == 60 == cohort_filter(df, cohort).count()
    assert found.columns and set(found.columns) == set(df.columns)


def test_enhanced_table_by_patient(spark, database):
    rows = spark.range(300).select(
        (F.col("id") % 30).cast("string").alias("patient_id"), F.col("id").alias("visit_id"),
        F.lit("2020-01-02 03:04:05").alias("sampling_datetime_utc"), F.lit("1").alias("value_as_number"),
        F.lit("mg").alias("unit_source_value"), F.lit(None).cast("string").alias("value_as_string"),
    )
    stored = spark.table(bronze_to_enhanced(spark, rows, f"{database}.e", salt="s"))
    assert stored.agg(F.min("measurement_id"), F.max("measurement_id"), F.count_distinct("measurement_id")).first()[:] == (1, 300, 300)
    found = cohort_filter(stored, ["4", "17"], enhanced_bucket("s"))
    assert found.count() == 20 and "PartitionFilters: [patient_bucket" in plan_of(found)
