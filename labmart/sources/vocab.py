"""Vocabulary export files: tab or comma separated text with a header."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labmart.functions.text import not_blank
from labmart.schemas import VOCAB_FILES, text_schema
from labmart.session import GIB

SEPARATORS = {"\t": "tab", ",": "comma"}


def scan_vocab(
    spark: SparkSession, path: str, file: str = "CONCEPT.csv", sep: str = "\t", columns=None
) -> DataFrame:
    """Scan one kind of vocabulary file below ``path``; other files are skipped at listing."""
    reader = (
        spark.read.schema(text_schema(columns or VOCAB_FILES[file]))
        .option("header", "true")
        .option("enforceSchema", "false")
        .option("sep", sep)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", f"*{file}")
    )
    # Tab files hold bare quotes inside names, so quoting is off for them.
    reader = reader.option("quote", "") if sep == "\t" else reader.option("escape", '"')
    return reader.csv(path)


def separator_scores(spark: SparkSession, path: str, file: str = "VOCABULARY.csv") -> DataFrame:
    """How each separator splits the first data line: (sep, sep_name, accepted, priority).

    A separator is accepted when the line gives an id below 50 characters and
    a name of 1 to 199.
    """
    head = (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", f"*{file}")
        .text(path)
        .filter(~F.col("value").startswith(VOCAB_FILES[file][0]) & not_blank("value"))
        .limit(1)
    )
    tries = [
        F.struct(
            F.lit(i).alias("priority"),
            F.lit(sep).alias("sep"),
            F.lit(name).alias("sep_name"),
            F.split("value", f"\\Q{sep}\\E", -1).alias("fields"),
        )
        for i, (sep, name) in enumerate(SEPARATORS.items())
    ]
    first = F.trim(F.get("fields", F.lit(0)))
    second = F.trim(F.get("fields", F.lit(1)))
    accepted = (
        (F.length(first) > 0)
        & (F.length(first) < 50)
        & F.length(second).between(1, 199)
    )
    return head.select(F.inline(F.array(*tries))).select(
        "sep", "sep_name", F.coalesce(accepted, F.lit(False)).alias("accepted"), "priority"
    )


def detect_separator(spark: SparkSession, path: str, file: str = "VOCABULARY.csv") -> str:
    """The first accepted separator, tab before comma."""
    best = separator_scores(spark, path, file).filter("accepted").orderBy("priority").first()
    if best is None:
        raise ValueError(f"no separator fits {file} below {path}")
    return best["sep"]


def vocab_file_check(df: DataFrame, max_bytes: int = 10 * GIB) -> DataFrame:
    """Rows, files and file sizes of a scan, with a verdict.

    Sizes are taken once per file, then summed.
    """
    per_file = df.groupBy(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size")
    ).count()
    totals = per_file.agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("total_rows"),
        F.count(F.lit(1)).alias("file_count"),
        F.min("size").alias("min_file_size"),
        F.max("size").alias("max_file_size"),
        F.coalesce(F.sum("size"), F.lit(0)).alias("total_file_size"),
    )
    verdict = (
        F.when(F.col("file_count") == 0, "NO_FILES")
        .when(F.col("total_rows") == 0, "NO_ROWS")
        .when(F.col("total_file_size") > max_bytes, "TOO_LARGE")
        .otherwise("OK")
    )
    return totals.withColumn("status", verdict)
