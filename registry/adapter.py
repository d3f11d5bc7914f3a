"""Laboratory results and vocabulary rows derived from the driver's tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labmart.functions import month_or, year_or
from labmart.mappings import UNIT_CONCEPTS
from labmart.operators.bronze import bronze_typed
from labmart.operators.silver import omop_measurement
from labmart.schemas import LAB_27, VOCAB_FILES
from labmart.session import OPEN_FILES, new_scratch_path, sql_settings
from labmart.sinks import with_bucket_column, write_table
from labmart.sources import scan_lab, scan_vocab, with_source_file

AS_OF = dt.date(2002, 1, 1)
RUN_TS = dt.datetime(2024, 1, 1, 12, 0, 0)
BATCH = "registry"
SOURCE_PATTERN = "source=([^/]+)/"

# The thirteen known units in table order; part keys 13 to 19 (mod 20) get an unknown unit.
UNITS = list(UNIT_CONCEPTS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Columns of line items and orders that laboratory results are made of.
_RESULT_OF = (
    "l_orderkey l_linenumber l_partkey l_suppkey l_quantity l_returnflag l_linestatus l_shipdate "
    "o_custkey o_orderdate"
).split()


def ordered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All line items with their orders, the columns that laboratory results are made of.

    A partition's orders are held as a hash table; the line items pass by it
    unsorted, as their sort would spill.
    """
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").hint("shuffle_hash")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(*_RESULT_OF)


def lab_values() -> dict[str, Column]:
    """The text columns of a laboratory export, over ``ordered_lines``."""
    part20 = F.col("l_partkey") % 20
    categorical = F.col("l_partkey") % 10 == 4
    customer = F.col("o_custkey")
    order_day = F.col("o_orderdate").cast("date").cast("string")
    unit = F.when(F.col("l_linenumber") == 7, "")
    for i, name in enumerate(UNITS):
        unit = unit.when(part20 == i, name)
    return {
        "visit_id": F.col("l_orderkey").cast("string"),
        "visit_date_utc": order_day,
        "visit_rank": F.col("l_linenumber").cast("string"),
        "patient_id": F.when(customer % 50 == 7, None)
        .when(customer % 50 == 9, F.concat(F.lit("P"), customer.cast("string")))
        .otherwise(customer.cast("string")),
        "report_id": F.col("l_suppkey").cast("string"),
        "laboratory_uuid": F.concat(F.lit("LAB-"), F.col("l_suppkey").cast("string")),
        "measurement_source_value": F.when(F.col("l_partkey") % 40 == 3, None).otherwise(
            F.concat(F.lit("LC:"), F.lpad(part20.cast("string"), 4, "0"))
        ),
        "sampling_datetime_utc": F.when(F.col("l_linenumber") == 1, None).otherwise(
            F.col("l_shipdate").cast("string")
        ),
        "result_datetime_utc": F.when(
            (F.col("l_linenumber") == 1) & (F.col("l_partkey") % 3 == 0), None
        ).otherwise((F.col("l_shipdate") + F.expr("INTERVAL 1 DAY")).cast("string")),
        "normality": F.when(F.col("l_returnflag") == "A", "ABNORMAL")
        .when(F.col("l_returnflag") == "R", " high ")
        .when(F.col("l_linestatus") == "O", "Normal")
        .otherwise("LOW"),
        "value_type": F.when(categorical, "CATEGORICAL").otherwise("NUMERIC"),
        "value_as_number": F.when(categorical, None).otherwise(
            F.col("l_quantity").cast("string")
        ),
        "unit_source_value": unit.otherwise("other"),
        "value_as_string": F.when(categorical & (F.col("l_linenumber") != 2), "positive"),
        "report_date_utc": F.when(F.col("l_partkey") % 30 == 0, None).otherwise(order_day),
    }


def as_results(lines: DataFrame, extra: tuple[Column, ...] = ()) -> DataFrame:
    """``ordered_lines`` as the 27 text columns of a laboratory export, and ``extra``."""
    values = lab_values()
    return lines.select(*[values.get(c, F.lit(None).cast("string")).alias(c) for c in LAB_27], *extra)


def lab_results(spark: SparkSession, sf_dir: str, source: bool = False) -> DataFrame:
    """All line items with their orders, as the 27 text columns of a laboratory export."""
    extra = (F.year("o_orderdate").cast("string").alias("source"),) if source else ()
    return as_results(ordered_lines(spark, sf_dir), extra)


def bronze(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return bronze_typed(lab_results(spark, sf_dir), BATCH, RUN_TS, **options)


def measurement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return omop_measurement(bronze(spark, sf_dir), as_of=AS_OF)


_staged: dict[tuple[str, str, str], str] = {}


# The CSV writer would otherwise strip outer spaces from the values.
_WRITE_OPTIONS = {
    "header": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


#: Rows of a range of a clustered table, which are sorted in memory.
RANGE_ROWS = 400_000


def ranges(spark: SparkSession, sf_dir: str) -> int:
    """Number of ranges for a table with a row for each line item."""
    return max(8, -(-table(spark, sf_dir, "lineitem").count() // RANGE_ROWS))


#: Tasks of a join hand on, or sort, this much of its exchange: some hundred MB as rows.
_SMALL_TASKS = {"adaptive__advisoryPartitionSizeInBytes": "16m"}


#: The exchanges of a write go when it ends, not when the driver next collects its garbage.
_EXCHANGES_GO = {"classic__shuffleDependency__fileCleanup__enabled": "true"}


def _write_by_source(rows: DataFrame, path: str, **options: str) -> None:
    """CSV files below ``source=<order year>``, written without sorting the rows by it."""
    with sql_settings(rows.sparkSession, maxConcurrentOutputFileWriters=OPEN_FILES):
        writer = rows.write.options(**_WRITE_OPTIONS).option("escape", '"').options(**options)
        writer.partitionBy("source").csv(path)


def _stage_once(spark: SparkSession, sf_dir: str, kind: str, write) -> str:
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    if key not in _staged:
        path = new_scratch_path(spark, kind)
        with sql_settings(spark, **_EXCHANGES_GO):
            write(path)
        _staged[key] = path
    return _staged[key]


def lab_csv(spark: SparkSession, sf_dir: str) -> str:
    """Folder with all laboratory results as CSV below ``source=<order year>``."""

    def write(path: str) -> None:
        _write_by_source(lab_results(spark, sf_dir, source=True), path)

    return _stage_once(spark, sf_dir, "lab_csv", write)


@contextmanager
def _files_to_load(spark: SparkSession, sf_dir: str) -> Iterator[str]:
    """The folder of ``lab_csv`` if the session has it; else such files, compressed, that go when the block ends.

    As text they are eight times the table that is loaded from them.
    """
    staged = _staged.get((spark.sparkContext.applicationId, sf_dir, "lab_csv"))
    if staged:
        yield staged
        return
    folder = new_scratch_path(spark, "to_load")
    try:
        _write_by_source(
            lab_results(spark, sf_dir, source=True), folder,
            **{"compression": "gzip", "zlib.compress.level": "BEST_SPEED"},
        )
        yield folder
    finally:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def lab_csv_15(spark: SparkSession, sf_dir: str) -> str:
    """The same results in the older 15-column layout."""

    def write(path: str) -> None:
        rows = bronze_typed(
            lab_results(spark, sf_dir, source=True), BATCH, RUN_TS, strings=True, extra=(F.col("source"),)
        ).drop("load_timestamp", "processing_batch")
        _write_by_source(rows, path)

    return _stage_once(spark, sf_dir, "lab_csv_15", write)


def scanned(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return scan_lab(spark, lab_csv(spark, sf_dir), **options)


def source_label():
    return F.regexp_extract(F.col("_metadata.file_path"), SOURCE_PATTERN, 1)


def stored_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze written by year and month, clustered by patient and test.

    Line items are put in their ranges as they are; bronze rows would be 1.6 times as large there.
    """

    def typed(lines: DataFrame, kept: tuple[Column, ...]) -> DataFrame:
        return bronze_typed(as_results(lines, kept), BATCH, RUN_TS, partition_columns=True, extra=kept)

    def write(path: str) -> None:
        values = lab_values()
        sampled = values["sampling_datetime_utc"]
        with sql_settings(spark, **_SMALL_TASKS):
            write_table(
                ordered_lines(spark, sf_dir),
                path=path,
                partition_by=["year", "month"],
                cluster_by=["patient_id", "measurement_source_value"],
                partitions=ranges(spark, sf_dir),
                derive=typed,
                by=[
                    year_or(sampled), month_or(sampled),
                    values["patient_id"], values["measurement_source_value"],
                ],
            )

    return spark.read.parquet(_stage_once(spark, sf_dir, "bronze", write))


def bucketed_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze written by 32 buckets of the patient and by year."""

    def write(path: str) -> None:
        rows = bronze(spark, sf_dir, partition_columns=True).drop("month")
        bucketed = with_bucket_column(rows, "patient_id", 32)
        write_table(bucketed, path=path, partition_by=["patient_id_bucket", "year"])

    return spark.read.parquet(_stage_once(spark, sf_dir, "bucketed", write))


def stored_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed rows of the CSV files, with the source of each, as a plain table."""

    def write(path: str) -> None:
        with _files_to_load(spark, sf_dir) as folder:
            raw = with_source_file(scan_lab(spark, folder), pattern=SOURCE_PATTERN, group=1)
            bronze_typed(raw, BATCH, RUN_TS).write.parquet(path)

    return spark.read.parquet(_stage_once(spark, sf_dir, "loaded", write))


def stored_measurement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MEASUREMENT written by year and month."""

    def write(path: str) -> None:
        write_table(
            measurement(spark, sf_dir),
            path=path,
            partition_by=["measurement_year", "measurement_month"],
        )

    return spark.read.parquet(_stage_once(spark, sf_dir, "measurement", write))


def vocabulary_rows(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Vocabulary text rows: suppliers as vocabularies, parts as concepts, supplies as relations."""
    part = table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    concept = part.select(
        F.when(key % 97 == 5, "unassigned")
        .otherwise((key + 3000000).cast("string"))
        .alias("concept_id"),
        F.col("p_name").alias("concept_name"),
        F.col("p_type").alias("domain_id"),
        F.when(key % 4 == 3, "Local").otherwise("LOINC").alias("vocabulary_id"),
        F.col("p_brand").alias("concept_class_id"),
        F.when(key % 2 == 0, "S").alias("standard_concept"),
        F.concat(
            F.lit("LC:"),
            F.when(key < 10000, F.lpad(key.cast("string"), 4, "0")).otherwise(key.cast("string")),
        ).alias("concept_code"),
        F.when(key % 3 == 0, "19700101").otherwise("1970-01-01").alias("valid_start_date"),
        F.lit("20991231").alias("valid_end_date"),
        F.when(key % 11 == 0, "D").alias("invalid_reason"),
    )
    supplier = table(spark, sf_dir, "supplier")
    vocabulary = supplier.select(
        F.concat(F.lit("V"), F.lpad(F.col("s_suppkey").cast("string"), 6, "0")).alias(
            "vocabulary_id"
        ),
        F.col("s_name").alias("vocabulary_name"),
        F.lit("reference text").alias("vocabulary_reference"),
        F.when(F.col("s_nationkey") % 2 == 0, "v1").alias("vocabulary_version"),
        F.when(F.col("s_suppkey") % 7 == 0, "none")
        .otherwise((F.col("s_suppkey") + 44000000).cast("string"))
        .alias("vocabulary_concept_id"),
    )
    relation = table(spark, sf_dir, "lineitem").select(
        (F.col("l_partkey") + 3000000).cast("string").alias("concept_id_1"),
        F.when(F.col("l_suppkey") % 13 == 0, "x")
        .otherwise((F.col("l_suppkey") + 44000000).cast("string"))
        .alias("concept_id_2"),
        F.when(F.col("l_returnflag") == "R", "Maps to").otherwise("Is a").alias("relationship_id"),
        F.date_format("l_shipdate", "yyyyMMdd").alias("valid_start_date"),
        F.lit("20991231").alias("valid_end_date"),
        F.lit(None).cast("string").alias("invalid_reason"),
    )
    domain = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("D"), F.col("c_custkey").cast("string")).alias("domain_id"),
        F.col("c_name").alias("domain_name"),
        F.col("c_nationkey").cast("string").alias("domain_concept_id"),
    )
    return {
        "VOCABULARY.csv": vocabulary,
        "CONCEPT.csv": concept,
        "CONCEPT_RELATIONSHIP.csv": relation,
        "DOMAIN.csv": domain,
    }


def _rename_parts(spark: SparkSession, folder: str, target: str, suffix: str) -> None:
    """Move Spark's part files to ``target`` under names that end in ``suffix``."""
    jvm = spark.sparkContext._jvm
    source = jvm.org.apache.hadoop.fs.Path(folder)
    files = source.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(jvm.org.apache.hadoop.fs.Path(target))
    for status in files.listStatus(source):
        name = status.getPath().getName()
        if name.startswith("part-"):
            number = name.split("-")[1]
            files.rename(
                status.getPath(), jvm.org.apache.hadoop.fs.Path(f"{target}/{number}_{suffix}")
            )


def vocab_files(spark: SparkSession, sf_dir: str, sep: str = "\t") -> str:
    """Folder of vocabulary text files named ``<number>_CONCEPT.csv`` and so on."""

    def write(path: str) -> None:
        for file, rows in vocabulary_rows(spark, sf_dir).items():
            parts = f"{path}/parts/{file}"
            writer = rows.write.options(**_WRITE_OPTIONS).option("sep", sep)
            writer = writer.option("quote", "") if sep == "\t" else writer.option("escape", '"')
            writer.csv(parts)
            _rename_parts(spark, parts, f"{path}/files", file)

    kind = "vocab_tab" if sep == "\t" else "vocab_comma"
    return _stage_once(spark, sf_dir, kind, write) + "/files"


def vocab_scan(spark: SparkSession, sf_dir: str, file: str, sep: str = "\t") -> DataFrame:
    assert file in VOCAB_FILES
    return scan_vocab(spark, vocab_files(spark, sf_dir, sep), file, sep)
