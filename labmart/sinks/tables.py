"""Writing tables: partitioned, clustered, bucketed."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labmart.operators.rowid import spread_and_sort
from labmart.session import OPEN_FILES, sql_settings

# Row groups of 128 MB, pages of 1 MB.
PARQUET_LAYOUT = {"parquet.block.size": str(128 << 20), "parquet.page.size": str(1 << 20)}


def run_name(name: str, run_id: str | None = None) -> str:
    """Table name with a run suffix, by default eight random hex digits."""
    return f"{name}_{run_id or uuid.uuid4().hex[:8]}"


def with_bucket_column(df: DataFrame, c: str, n: int, out: str | None = None) -> DataFrame:
    """Add ``hash(c) mod n``, to partition a plain table by it."""
    return df.withColumn(out or f"{c}_bucket", F.pmod(F.hash(c), F.lit(n)))


def arrange(
    df: DataFrame,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    bucket_by: tuple[int, str] | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Rows placed for the write.

    Clustered tables are range-partitioned and sorted by partition columns and
    cluster columns: each file holds one range, whatever the size of a
    partition or key. Tables only partitioned or bucketed are rebalanced, where
    AQE splits big partitions and joins small ones.
    """
    if bucket_by is not None:
        n, column = bucket_by
        return df.hint("rebalance", n, F.col(column))
    if cluster_by:
        return spread_and_sort(df, [*partition_by, *cluster_by], partitions)
    if partition_by:
        return df.hint("rebalance", *[F.col(c) for c in partition_by])
    return df


def write_table(
    df: DataFrame,
    name: str | None = None,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    bucket_by: tuple[int, str] | None = None,
    sort_by: Sequence[str] = (),
    path: str | None = None,
    mode: str = "errorifexists",
    fmt: str = "parquet",
    partitions: int | None = None,
    options: Mapping[str, str] | None = None,
    in_place: bool = False,
    derive: Callable[[DataFrame, tuple[Column, ...]], DataFrame] | None = None,
    by: Sequence[Column] = (),
) -> str:
    """Write ``df`` as table ``name`` or to ``path``; returns whichever was given.

    ``bucket_by`` is (number, column) with rows sorted by ``sort_by`` in each
    bucket and needs a table name. ``fmt`` may name any format the session has.
    ``in_place`` writes rows from the tasks they are in, for rows that lie by
    partition already. ``derive`` makes a clustered table's rows from ``df`` after the
    exchange, see ``spread_and_sort``; ``by`` are its partition and cluster columns over ``df``.
    """
    if derive is not None:
        if not cluster_by or len(by) != len([*partition_by, *cluster_by]):
            raise ValueError("derive needs cluster columns, and an expression for each key")
        placed = spread_and_sort(df, [*partition_by, *cluster_by], partitions, derive, by)
    else:
        placed = df if in_place else arrange(df, partition_by, cluster_by, bucket_by, partitions)
    writer = placed.write.format(fmt).mode(mode)
    if fmt == "parquet":
        writer = writer.options(**PARQUET_LAYOUT)
    # A rebuild replaces the whole table, not only the partitions it now has.
    writer = writer.options(**{"partitionOverwriteMode": "static", **(options or {})})
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by is not None:
        writer = writer.bucketBy(*bucket_by)
        if sort_by:
            writer = writer.sortBy(*sort_by)
    # Clustered rows come in the order of the partitions; all others would be sorted by them.
    open_files = "0" if cluster_by else OPEN_FILES
    with sql_settings(df.sparkSession, maxConcurrentOutputFileWriters=open_files):
        if name is None:
            writer.save(path)
            return path
        if path is not None:
            writer = writer.option("path", path)
        writer.saveAsTable(name)
        return name
