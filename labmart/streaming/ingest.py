"""Incremental loading of arriving CSV files."""

from __future__ import annotations

import threading

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from labmart.operators.bronze import bronze_typed
from labmart.schemas import LAB_LAYOUTS, text_schema
from labmart.session import store
from labmart.sources.lab import CSV_OPTIONS, FILE_NAME_PATTERN, with_source_file


#: What is known of a file without opening it.
_FILE = ["file_path", "file_size", "file_modification_time"]


def ledger_lines(spark: SparkSession, ledger: str) -> DataFrame:
    """Files loaded so far: path, size, time, rows, content checksum and batch."""
    schema = (
        "file_path string, file_size bigint, file_modification_time timestamp, rows bigint, "
        "checksum decimal(38,0), processing_batch string"
    )
    try:
        return spark.read.schema(schema).parquet(ledger)
    except AnalysisException as error:  # no batch has been committed
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _fresh_files(spark: SparkSession, batch: DataFrame, ledger: str, name: str) -> DataFrame:
    """The batch's files whose content is neither in the ledger nor in an earlier file of the batch.

    A repeated batch does not meet its own lines. The checksum adds row hashes,
    so it does not depend on the order in which tasks read the rows.
    """
    content = [c for c in batch.columns if c not in {*_FILE, "source_file"}]
    files = batch.groupBy(*_FILE).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.xxhash64(*content).cast("decimal(38,0)")).alias("checksum"),
    )
    same = ["file_size", "rows", "checksum"]
    first = Window.partitionBy(*same).orderBy("file_path")
    single = files.withColumn("nth", F.row_number().over(first)).where("nth = 1").drop("nth")
    known = ledger_lines(spark, ledger).where(F.col("processing_batch") != name).select(*same)
    return single.join(known, same, "left_anti")


def committed(spark: SparkSession, target: str, ledger: str) -> DataFrame:
    """Rows of the batches that the ledger names; what a broken batch left behind is not among them."""
    batches = ledger_lines(spark, ledger).select("processing_batch").distinct()
    return spark.read.parquet(target).join(batches, "processing_batch", "left_semi")


def ingest_stream(
    spark: SparkSession,
    path: str,
    target: str,
    checkpoint: str,
    files_per_batch: int = 10,
    layout: str = "27",
    keep_patients: str = "not_nan",
    label: str = "batch",
    run_ts=None,
    source_pattern: str = FILE_NAME_PATTERN,
    source_group: int = 0,
    bytes_per_batch: str | None = None,
    ledger: str | None = None,
) -> StreamingQuery:
    """Load all files below ``path`` that no earlier run has loaded, some per batch.

    The checkpoint knows the files of each batch, and a batch overwrites its own
    ``processing_batch=<label>_<stream>_<number>`` directory, so a batch that is
    repeated after a failure leaves its rows once. The stream's part of the name
    is the id that Spark keeps in the checkpoint: streams that share a target,
    or a new checkpoint, never meet each other's directories. Run again to pick
    up new files. ``bytes_per_batch`` (such as ``1t``) sizes batches by volume
    instead of by files.

    With ``ledger``, a folder, a batch loads only files whose content no batch
    of any stream has loaded: neither a new checkpoint nor a copy of a file
    under another name adds rows. The batch's line in the ledger, written last,
    is what commits it; read the target through ``committed``. Streams that
    share a ledger run one after the other.
    """
    limit = ("maxBytesPerTrigger", bytes_per_batch) if bytes_per_batch else (
        "maxFilesPerTrigger", files_per_batch
    )
    files = (
        spark.readStream.schema(text_schema(LAB_LAYOUTS[layout]))
        .options(**CSV_OPTIONS)
        .option("enforceSchema", "false")
        .option(*limit)
        .csv(path)
    )
    rows = with_source_file(files, pattern=source_pattern, group=source_group)
    if ledger:
        rows = rows.withColumns({c: F.col(f"_metadata.{c}") for c in _FILE})

    stream: list[str] = []
    named = threading.Event()

    def load(batch: DataFrame, epoch: int) -> None:
        named.wait()
        name = f"{label}_{stream[0]}_{epoch + 1}"
        if ledger:
            fresh = store(_fresh_files(spark, batch, ledger, name), "fresh_files")
            # One short row for each file of a batch.
            batch = batch.join(F.broadcast(fresh.select("file_path")), "file_path", "left_semi").drop(*_FILE)
        typed = bronze_typed(batch, name, run_ts, keep_patients).drop("processing_batch")
        typed.write.mode("overwrite").parquet(f"{target}/processing_batch={name}")
        if ledger:
            fresh.coalesce(1).write.mode("overwrite").parquet(f"{ledger}/processing_batch={name}")

    query = (
        rows.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    stream.append(str(query.id).replace("-", ""))
    named.set()
    return query


def batch_progress(loaded: DataFrame) -> DataFrame:
    """Rows and files of each loaded batch."""
    return loaded.groupBy("processing_batch").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("source_file").alias("files")
    )
