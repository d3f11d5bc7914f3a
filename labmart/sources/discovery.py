"""What files are there, do they have the expected header, how long will a load take."""

from __future__ import annotations

import re
from collections.abc import Iterator
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labmart.session import MIB, store
from labmart.sources.lab import union_batches

LOCAL = "^file:/+"


def _plain(path: Column) -> Column:
    """A local path in one spelling, whichever reader names it."""
    return F.regexp_replace(path, LOCAL, "file:/")


def _empty_files(spark: SparkSession, listed: DataFrame, manifest: DataFrame) -> DataFrame | None:
    """Manifest rows of the files without bytes, which Spark lists but never scans."""
    paths = [re.sub(LOCAL, "file:/", unquote(p)) for p in listed.inputFiles()]
    if len(paths) == manifest.count():
        return None
    scanned = manifest.select(F.regexp_replace("path", LOCAL, "file:/").alias("path"))
    empty = spark.createDataFrame([(p,) for p in paths], "path string").join(scanned, "path", "left_anti")
    rows = []
    for (path,) in empty.collect():
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        status = at.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(at)
        rows.append((path, status.getLen(), status.getModificationTime()))
    return spark.createDataFrame(rows, "path string, size bigint, ms bigint").select(
        "path",
        F.regexp_extract("path", "[^/]+$", 0).alias("name"),
        "size",
        F.timestamp_millis("ms").alias("last_modified"),
    )


def discover_files(spark: SparkSession, path: str, glob: str = "*.csv") -> DataFrame:
    """Manifest of matching files: path, name, size, last_modified.

    Only listing data is used; the content column is pruned, no file is read.
    Files of zero bytes are listed too.
    """
    listed = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load(path)
    )
    manifest = listed.select(
        "path",
        F.regexp_extract("path", "[^/]+$", 0).alias("name"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("last_modified"),
    )
    empty = _empty_files(spark, listed, manifest)
    return manifest if empty is None else manifest.unionByName(empty)


def require_files(manifest: DataFrame) -> DataFrame:
    """The manifest, or an error when no file in it has bytes."""
    if manifest.where("size > 0").isEmpty():
        raise FileNotFoundError("no files found")
    return manifest


def _split_header(line: str, sep: str) -> list[str]:
    """Names of a header line; a quoted name may hold the separator and doubled quotes."""
    end = re.escape(sep)
    field = re.compile(f' *"((?:[^"]|"")*)" *(?={end}|$)|((?:(?!{end}).)*)', re.DOTALL)
    names, at = [], 0
    while True:
        found = field.match(line, at)
        quoted, bare = found.groups()
        names.append((bare.strip('"') if quoted is None else quoted.replace('""', '"')).strip(" "))
        if found.end() >= len(line):
            return names
        at = found.end() + len(sep)


def _first_lines(sep: str):
    """The first line of a task's only file, split; the rest of the file is not asked for."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            line = bytes(batch["line"][0]).decode("utf-8-sig", "replace")
            yield pd.DataFrame({"path": batch["path"][:1], "header": [_split_header(line, sep)]})
            return

    return run


#: One file for each task, and one line in the first batch that a task hands to Python.
_ONE_FILE = {
    "spark.sql.files.maxPartitionBytes": str(1 << 50),
    "spark.sql.files.openCostInBytes": str(1 << 50),
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1",
}


def file_headers(spark: SparkSession, path: str, glob: str = "*.csv", sep: str = ",") -> DataFrame:
    """path and ``header``, the names in the first line, of every matching file with bytes.

    Spark's text reader opens the files, so any store will do that Spark reads.
    Each task has one file and ends at its first line, when no more than the
    reader's and the worker's buffers have been read: the cost follows the
    number of files and not their size. Names may be quoted. The result, one
    short row for each file, is stored.
    """
    lines = (
        spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", "true").text(path)
        # Metadata escape a path as a URI does, where a plus sign stands for itself.
        .select(
            F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))).alias("path"),
            F.col("value").cast("binary").alias("line"),
        )
    )
    before = {k: spark.conf.get(k, None) for k in _ONE_FILE}
    try:
        for k, v in _ONE_FILE.items():
            spark.conf.set(k, v)
        return store(lines.mapInPandas(_first_lines(sep), "path string, header array<string>"), "headers")
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def validate_structure(
    spark: SparkSession, path: str, expected, glob: str = "*.csv", expected_names=None
) -> DataFrame:
    """Compare the header of each file with the expected columns.

    One row per file: path, name, size, header_ok, missing and unexpected columns, status.
    Files of zero bytes have status EMPTY. Files in ``expected_names`` that the
    listing lacks (or holds empty) show up with status MISSING.
    """
    manifest = discover_files(spark, path, glob)
    want = F.array(*[F.lit(c) for c in expected])
    compared = (
        manifest.withColumn("at", _plain(F.col("path")))
        .join(file_headers(spark, path, glob).select(_plain(F.col("path")).alias("at"), "header"), "at", "left")
        .withColumn("header_ok", F.col("header") == want)
        .select(
            "path",
            "name",
            "size",
            "header_ok",
            F.array_except(want, "header").alias("missing_columns"),
            F.array_except("header", want).alias("unexpected_columns"),
            F.when(F.col("size") == 0, "EMPTY")
            .when(F.col("header_ok"), "PASSED")
            .otherwise("FAILED")
            .alias("status"),
        )
    )
    if expected_names is None:
        return compared
    wanted = spark.createDataFrame([(n, True) for n in expected_names], "name string, wanted boolean")
    gone = F.col("status").isNull() | (F.col("wanted") & (F.col("status") == "EMPTY"))
    return (
        compared.join(wanted, "name", "full_outer")
        .withColumn("status", F.when(gone, "MISSING").otherwise(F.col("status")))
        .drop("wanted")
    )


def volume_report(manifest: DataFrame, structure: DataFrame | None = None) -> DataFrame:
    """One row of load estimates from a manifest.

    Rules of thumb: 10,000 rows per MB, 20 results per patient, 20 MB per
    minute but at least 5 minutes, chunks of a tenth of the rows within
    10,000 to 50,000.
    """
    mb = F.coalesce(F.sum("size"), F.lit(0)) / F.lit(float(MIB))
    totals = manifest.agg(F.count(F.lit(1)).alias("files_count"), mb.alias("mb"))
    # Five names by a bounded sort, so that the list of all names is never gathered.
    parts = [totals, manifest.select("name").orderBy("name").limit(5)]
    if structure is not None:
        failed = F.count_if(F.coalesce(F.col("status") != "PASSED", F.lit(True)))
        parts.append(structure.agg(failed.alias("failed_files")))
    merged = union_batches(parts).agg(
        F.max("files_count").alias("files_count"),
        F.max("mb").alias("mb"),
        F.sort_array(F.collect_list("name")).alias("first_files"),
        *([F.max("failed_files").alias("failed_files")] if structure is not None else []),
    )

    def whole(c):
        return c.cast("bigint")

    report = [
        F.col("files_count"),
        F.round("mb", 2).alias("total_size_mb"),
        whole(F.col("mb") * 10000).alias("estimated_rows"),
        whole(F.col("mb") * 10000 / 20).alias("estimated_patients"),
        F.greatest(whole(F.lit(5)), whole(F.col("mb") / 20)).alias(
            "estimated_processing_time_minutes"
        ),
        F.least(
            whole(F.lit(50000)), F.greatest(whole(F.lit(10000)), whole(F.col("mb") * 1000))
        ).alias("recommended_chunk_size"),
        F.col("first_files"),
    ]
    if structure is not None:
        report.append(
            F.when(F.col("failed_files") == 0, "PASSED").otherwise("FAILED").alias("validation_status")
        )
    return merged.select(*report)
