"""Helpers of the corpus operators: work tables, folds, words, free column names."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labmart.session import new_scratch_path

_databases: list[tuple[SparkSession, str]] = []


class Work:
    """Intermediate tables in the shared folder of ``spark.checkpoint.dir``.

    Each table is written by Spark and read again, which cuts the lineage: a
    lost executor costs the tasks of the step at hand only. ``drop`` removes a
    table's files; what a lazy result still reads stays until ``release``.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.name = f"llm_{label}_{uuid.uuid4().hex[:12]}"
        spark.sql(f"CREATE DATABASE {self.name} LOCATION '{new_scratch_path(spark, label)}'")
        _databases.append((spark, self.name))

    def keep(
        self, df: DataFrame, table: str, compression: str = "snappy", bucket_by: tuple[int, str] | None = None
    ) -> DataFrame:
        writer = df.write.format("parquet").mode("overwrite").option("compression", compression)
        (writer.bucketBy(*bucket_by) if bucket_by else writer).saveAsTable(f"{self.name}.{table}")
        return self.spark.table(f"{self.name}.{table}")

    def drop(self, *tables: str) -> None:
        for table in tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name}.{table}")


#: Rows of a task are located by stretches of 2**10 and the place in the stretch.
STRETCH_BITS = 10
STRETCH, AT = "__stretch", "__at"


def in_place(df: DataFrame, work: Work, table: str) -> DataFrame:
    """``df`` stored from the tasks it is in, with the locator (``STRETCH``, ``AT``) of each row.

    The rows are bucketed by stretch, so that what is found for the rows of a stretch
    meets them in a join on ``STRETCH`` that leaves wide rows where they are.
    """
    spark, locator = df.sparkSession, F.monotonically_increasing_id()
    buckets = min(
        int(spark.conf.get("spark.sql.shuffle.partitions")),
        int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets", "100000")),
    )
    located = df.withColumns({
        STRETCH: F.shiftright(locator, STRETCH_BITS),
        AT: locator.bitwiseAND(F.lit((1 << STRETCH_BITS) - 1)).cast("int"),
    })
    return work.keep(located, table, "zstd", (buckets, STRETCH))


def release() -> None:
    """Remove all work tables; call it when no result is read any more."""
    while _databases:
        spark, name = _databases.pop()
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the text as UTF-8, A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not use yet in any letter case."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base
