"""Session settings and the shared working folder."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

MIB = 1024 * 1024
GIB = 1024 * MIB

_local_scratch: dict[str, str] = {}
_stores: dict[str, tuple[SparkSession, str]] = {}


def shuffle_partitions_for(input_bytes: int, target_bytes: int = 192 * MIB, floor: int = 8) -> int:
    """Initial shuffle partition count for a job over ``input_bytes``.

    AQE merges partitions that turn out small but never splits an ordinary
    aggregate's partitions, so the starting number has to be large enough:
    100 TB gives about 546,000 partitions of 192 MB.
    """
    return max(floor, -(-int(input_bytes) // target_bytes))


def build_session(
    app_name: str = "labmart",
    master: str | None = None,
    input_bytes: int | None = None,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the settings the library is tuned for.

    Pass ``input_bytes`` to size the shuffles for a known volume. Nothing in
    the library depends on these settings for right results.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "128m")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")
        .config("spark.sql.files.maxPartitionBytes", "128m")
    )
    if master:
        builder = builder.master(master)
    if input_bytes is not None:
        builder = builder.config(
            "spark.sql.shuffle.partitions", str(shuffle_partitions_for(input_bytes))
        )
    for key, value in (settings or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: ``spark.checkpoint.dir``.

    Only a local master may do without the setting; it then gets one temporary
    folder per application.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    app = context.applicationId
    if app not in _local_scratch:
        _local_scratch[app] = tempfile.mkdtemp(prefix="labmart-")
    return _local_scratch[app]


def new_scratch_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no earlier call has returned."""
    return f"{scratch_dir(spark)}/labmart/{label}-{uuid.uuid4().hex}"


@contextmanager
def sql_settings(spark: SparkSession, **settings: str) -> Iterator[None]:
    """SQL settings (names without ``spark.sql.``, dots as ``__``) that hold within the block."""
    names = {f"spark.sql.{k.replace('__', '.')}": v for k, v in settings.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


#: Files that a task of a partitioned write keeps open; rows of further partitions are sorted first.
OPEN_FILES = "64"


@contextmanager
def scratch_table(spark: SparkSession, df: DataFrame, label: str) -> Iterator[DataFrame]:
    """``df`` written to the shared folder and read again; its files go when the block ends."""
    database = f"scratch_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{new_scratch_path(spark, label)}'")
    try:
        df.write.format("parquet").saveAsTable(f"{database}.stored")
        yield spark.table(f"{database}.stored")
    finally:
        spark.sql(f"DROP DATABASE {database} CASCADE")


def store(df: DataFrame, label: str, bucket_by: tuple[int, str] | None = None) -> DataFrame:
    """``df`` written to the shared folder and read again, for results that are read later.

    Cuts the lineage, so that a lost executor costs the tasks of the step at
    hand. ``bucket_by`` (number, column) makes buckets without a shuffle: each
    task writes to those its rows fall into. The files stay until ``release``
    or the end of the Python program.
    """
    spark = df.sparkSession
    app = spark.sparkContext.applicationId
    if app not in _stores:
        name = f"labmart_{uuid.uuid4().hex[:12]}"
        spark.sql(f"CREATE DATABASE {name} LOCATION '{new_scratch_path(spark, 'stored')}'")
        _stores[app] = (spark, name)
    table = f"{_stores[app][1]}.{label}_{uuid.uuid4().hex[:12]}"
    writer = df.write.format("parquet")
    if bucket_by:
        # Rows of few buckets a task; they would be sorted by bucket, and spilled where a task is large.
        with sql_settings(spark, maxConcurrentOutputFileWriters=OPEN_FILES):
            writer.bucketBy(*bucket_by).saveAsTable(table)
    else:
        writer.saveAsTable(table)
    return spark.table(table)


def release() -> None:
    """Remove the files of all stored frames; no result over them can be read any more."""
    for app in list(_stores):
        spark, name = _stores.pop(app)
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


@atexit.register
def _release_at_exit() -> None:
    for spark, _ in list(_stores.values()):
        if spark.sparkContext._jsc is None:  # stopped: nothing can be removed through it
            return
    try:
        release()
    except Exception:  # the program ends anyway
        pass
