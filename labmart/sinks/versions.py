"""Publishing several tables together by one pointer, safe against a stop at any point."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labmart.sinks.publish import Check, PublishError, PublishLog
from labmart.sinks.tables import write_table

POINTER = "published_versions"


def _pointers(spark: SparkSession, database: str) -> DataFrame | None:
    name = f"{database}.{POINTER}"
    return spark.table(name) if spark.catalog.tableExists(name) else None


def current_version(spark: SparkSession, database: str) -> str | None:
    """The version that readers see, None before the first one is published."""
    pointers = _pointers(spark, database)
    newest = None if pointers is None else pointers.orderBy(F.col("number").desc()).first()
    return newest and newest["version"]


def published(spark: SparkSession, database: str, table: str) -> DataFrame:
    """A table of the current version. Take all tables of one job from the same version."""
    version = current_version(spark, database)
    if version is None:
        raise LookupError(f"nothing has been published in {database}")
    return spark.table(f"{database}.{table}__{version}")


def publish_steps(
    spark: SparkSession,
    database: str,
    tables: Mapping[str, DataFrame],
    checks: Mapping[str, Check] | None = None,
    layouts: Mapping[str, dict] | None = None,
    keep: int = 2,
) -> Iterator[tuple[str, str]]:
    """The steps of ``publish_version``, each done when its (stage, table) is yielded."""
    version = f"v{uuid.uuid4().hex[:12]}"
    for name, df in tables.items():
        write_table(df, f"{database}.{name}__{version}", **(layouts or {}).get(name, {}))
        yield "write", name
    for name in tables:
        complaints = (checks or {}).get(name, lambda df: [])(spark.table(f"{database}.{name}__{version}"))
        if complaints:
            raise ValueError(f"{name}: {'; '.join(complaints)}")
        yield "check", name
    before = _pointers(spark, database)
    number = 0 if before is None else (before.agg(F.max("number")).first()[0] or 0)
    line = spark.createDataFrame([(number + 1, version)], "number bigint, version string").coalesce(1)
    # One file with one row, which the committer moves into place at once: all before or all after.
    line.write.mode("append").saveAsTable(f"{database}.{POINTER}")
    yield "switch", ""
    spark.catalog.refreshTable(f"{database}.{POINTER}")
    newest = spark.table(f"{database}.{POINTER}").orderBy(F.col("number").desc()).limit(keep).collect()
    kept = {row["version"] for row in newest}
    for table in spark.catalog.listTables(database):
        name, mark, found = table.name.rpartition("__v")
        if mark and f"v{found}" not in kept and len(found) == 12:
            spark.sql(f"DROP TABLE IF EXISTS {database}.{table.name}")
            yield "drop", table.name


def publish_version(
    spark: SparkSession,
    database: str,
    tables: Mapping[str, DataFrame],
    checks: Mapping[str, Check] | None = None,
    layouts: Mapping[str, dict] | None = None,
    keep: int = 2,
) -> PublishLog:
    """Write all tables as a new version, check them, then switch the one pointer to it.

    Readers go through ``published``. A version holds all tables of its set, so
    publish them together. Whatever stops a run, readers see all tables of the
    version before or all of the new one; what it left behind goes when a later
    run drops all but the ``keep`` newest versions. One run at a time.
    """
    log = PublishLog()
    try:
        for stage, table in publish_steps(spark, database, tables, checks, layouts, keep):
            log.add(stage, table, "ok")
    except Exception as error:
        log.add("publish", "", f"failed: {error}")
        raise PublishError(str(error), log) from error
    return log
