"""Laboratory CSV scans. Everything is read as text; typing happens in bronze."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labmart.schemas import LAB_LAYOUTS, text_schema

FILE_NAME_PATTERN = "[^/]+$"

# RFC 4180 quoting. Records never span lines, so large files stay splittable.
CSV_OPTIONS = {
    "header": "true",
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "recursiveFileLookup": "true",
}


def _with_lineage(df: DataFrame, source_file: bool) -> DataFrame:
    return with_source_file(df) if source_file else df


def _blanks(df: DataFrame, columns, blank: str) -> DataFrame:
    """The reader gives NULL for an empty field, quoted or not."""
    if blank == "null":
        return df
    if blank != "empty":
        raise ValueError(f"blank must be 'null' or 'empty', not {blank!r}")
    kept = [c for c in df.columns if c not in columns]
    return df.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in columns], *kept)


def scan_lab(
    spark: SparkSession,
    path: str | list[str],
    layout: str = "27",
    blank: str = "null",
    source_file: bool = False,
) -> DataFrame:
    """Scan CSV files with the given column layout.

    The header of each file is compared with the whole layout while it is read
    (``enforceSchema`` and the parser's column pruning off), so a file with
    other columns fails the job instead of shifting values, also where a query
    needs few columns or none. ``blank`` says whether empty fields become NULL or ``''``.
    """
    columns = LAB_LAYOUTS[layout]
    df = (
        spark.read.schema(text_schema(columns))
        .options(**CSV_OPTIONS)
        .option("enforceSchema", "false")
        .option("columnPruning", "false")
        .csv(path)
    )
    return _blanks(_with_lineage(df, source_file), columns, blank)


def scan_glob(
    spark: SparkSession,
    pattern: str | list[str],
    columns=None,
    blank: str = "null",
    source_file: bool = False,
) -> DataFrame:
    """Scan the files a glob matches, columns named by the header.

    With ``columns`` the header must be exactly these names; without, names
    come from the header and every file must share it.
    """
    reader = spark.read.options(**CSV_OPTIONS).option("enforceSchema", "false")
    if columns is not None:
        reader = reader.schema(text_schema(columns))
    df = reader.csv(pattern)
    return _blanks(_with_lineage(df, source_file), list(df.columns), blank)


def filter_by_path(df: DataFrame, like: str) -> DataFrame:
    """Rows from files whose path matches a LIKE pattern; other files are not opened."""
    return df.filter(F.col("_metadata.file_path").like(like))


def with_source_file(
    df: DataFrame, out: str = "source_file", pattern: str = FILE_NAME_PATTERN, group: int = 0
) -> DataFrame:
    """Add the part of the file path that ``pattern`` picks, by default the file name."""
    if pattern == FILE_NAME_PATTERN:
        return df.withColumn(out, F.col("_metadata.file_name"))
    return df.withColumn(out, F.regexp_extract(F.col("_metadata.file_path"), pattern, group))


def union_batches(frames: list[DataFrame]) -> DataFrame:
    """All rows of the frames, columns matched by name, absent ones NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
