"""Publishing several tables together, or none of them."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from labmart.sinks.tables import write_table

Check = Callable[[DataFrame], list[str]]


@dataclass
class PublishLog:
    """What happened: (stage, table, outcome) in order."""

    events: list[tuple[str, str, str]] = field(default_factory=list)

    def add(self, stage: str, table: str, outcome: str) -> None:
        self.events.append((stage, table, outcome))


class PublishError(RuntimeError):
    def __init__(self, message: str, log: PublishLog):
        super().__init__(message)
        self.log = log


def _drop(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def _rename(spark: SparkSession, old: str, new: str) -> None:
    spark.sql(f"ALTER TABLE {old} RENAME TO {new}")


def staged_publish(
    spark: SparkSession,
    database: str,
    tables: Mapping[str, DataFrame],
    checks: Mapping[str, Check] | None = None,
    layouts: Mapping[str, dict] | None = None,
) -> PublishLog:
    """Write every table under a staging name, check all, then swap them in by rename.

    A check returns its complaints about the written table. Any complaint or
    error drops the staging tables and leaves the published ones untouched; an
    error during the swap renames the earlier tables back. ``layouts`` holds
    ``write_table`` arguments per table.
    """
    run = uuid.uuid4().hex[:8]
    log = PublishLog()
    staged = {name: f"{database}.{name}__new_{run}" for name in tables}
    kept = {name: f"{database}.{name}__old_{run}" for name in tables}
    swapped: list[str] = []
    saved: list[str] = []
    stage = "write"
    name = ""
    try:
        for name, df in tables.items():
            write_table(df, staged[name], **(layouts or {}).get(name, {}))
            log.add(stage, name, "ok")
        stage = "check"
        for name in tables:
            complaints = (checks or {}).get(name, lambda df: [])(spark.table(staged[name]))
            if complaints:
                raise ValueError("; ".join(complaints))
            log.add(stage, name, "ok")
        stage = "swap"
        for name in tables:
            final = f"{database}.{name}"
            if spark.catalog.tableExists(final):
                _rename(spark, final, kept[name])
                saved.append(name)
            _rename(spark, staged[name], final)
            swapped.append(name)
            log.add(stage, name, "ok")
    except Exception as error:
        log.add(stage, name, f"failed: {error}")
        for done in swapped:
            _drop(spark, f"{database}.{done}")
        for earlier in saved:
            _rename(spark, kept[earlier], f"{database}.{earlier}")
        for table in staged.values():
            _drop(spark, table)
        log.add("rollback", "", "done")
        raise PublishError(f"{stage} of {name} failed: {error}", log) from error
    for earlier in saved:
        _drop(spark, kept[earlier])
    return log
