"""Loads that only happen when needed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def seed_if_empty(spark: SparkSession, table: str, seed: DataFrame) -> bool:
    """Append ``seed`` to ``table`` when that is empty; true if it was."""
    empty = spark.table(table).limit(1).isEmpty()
    if empty:
        seed.write.mode("append").insertInto(table)
    return empty


def missing_rows(existing: DataFrame, rows: DataFrame, key: str = "concept_id") -> DataFrame:
    """Those of ``rows`` whose key ``existing`` lacks."""
    return rows.join(existing.select(key), key, "left_anti").select(*rows.columns)


def insert_missing(
    spark: SparkSession, table: str, rows: DataFrame, key: str = "concept_id"
) -> None:
    """Append the rows whose key is new; running it again adds nothing."""
    missing_rows(spark.table(table), rows, key).write.mode("append").insertInto(table)


def vocabulary_needed(
    spark: SparkSession,
    database: str,
    tables: Sequence[str] = ("concept", "vocabulary", "concept_relationship"),
    enough_concepts: int = 50_000,
) -> bool:
    """True unless all tables exist and ``concept`` has more than ``enough_concepts`` rows."""
    if not all(spark.catalog.tableExists(f"{database}.{t}") for t in tables):
        return True
    some = spark.table(f"{database}.concept").limit(enough_concepts + 1)
    return some.count() <= enough_concepts
