"""Gap-free row numbers over a whole table without a single-partition sort."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labmart.session import store

#: A task's rows are numbered in stretches of 2**20, the most that one array holds.
STRETCH_BITS = 20

_POSITION = "__position"
_TIE, _STRETCH, _ROW = "__tie", "__stretch", "__row"


def spread_and_sort(
    df: DataFrame,
    keys: list,
    partitions: int | None = None,
    derive: Callable[[DataFrame, tuple[Column, ...]], DataFrame] | None = None,
    by: Sequence[Column] = (),
) -> DataFrame:
    """Range-partition by the keys and sort each partition, NULLs last.

    The row's position in its input partition ends the partitioning key, so
    that any number of rows with equal keys, full copies included, spreads over
    several tasks. Positions repeat on a retry as long as ``df`` reads stored
    files; put a shuffle result into a table first.

    With ``derive``, the exchange moves ``df``'s columns and the rows are made from them
    afterwards, each from one: it gets the placed rows and columns to add unchanged at the
    end. ``by`` then gives the keys as expressions over ``df``.
    """
    order = [F.col(k).asc_nulls_last() for k in keys] + [F.col(_POSITION).asc()]
    spread = [c.asc_nulls_last() for c in by] + order[-1:] if derive else order
    placed = df.withColumn(_POSITION, F.monotonically_increasing_id())
    ranged = (
        placed.repartitionByRange(*spread)
        if partitions is None
        else placed.repartitionByRange(partitions, *spread)
    )
    rows = derive(ranged, (F.col(_POSITION),)) if derive else ranged
    return rows.sortWithinPartitions(*order).drop(_POSITION)


def global_row_id(
    df: DataFrame, keys: list[str], out: str = "row_id", partitions: int | None = None
) -> DataFrame:
    """Number all rows 1..n in key order; only keys and locators are exchanged.

    Rows are stored where they are, each with a locator: its stretch of at most
    2**20 rows of one task, and its place in the stretch. Keys and locators are
    range-partitioned, sorted and written, each file holding one part of the
    order. A number is the index in the file plus the rows of all files before;
    these offsets are one small row per file. The numbers of a stretch return
    as one array, which meets the stored rows by their bucket, so that wide
    rows never leave their place.

    Ties are settled by a hash over all columns, so repeated runs give equal
    results up to exact copies. The stored rows stay until ``session.release``.
    """
    spark = df.sparkSession
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = min(shuffles, int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets", "100000")))
    locator = F.monotonically_increasing_id()
    located = df.withColumns(
        {
            _STRETCH: F.shiftright(locator, STRETCH_BITS),
            _ROW: locator.bitwiseAND(F.lit((1 << STRETCH_BITS) - 1)).cast("int"),
            # Stored, as finding the ranges and moving the keys would each read and hash whole rows.
            _TIE: F.xxhash64(*[F.col(c) for c in df.columns]),
        }
    )
    # A task's rows share few stretches, so it writes few files, not one for each bucket.
    wide = store(located, "located", (buckets, _STRETCH))
    narrow = wide.select(*keys, _TIE, _STRETCH, _ROW)
    order = [F.col(k).asc_nulls_last() for k in keys] + [F.col(c) for c in (_TIE, _STRETCH, _ROW)]
    ranged = narrow.repartitionByRange(partitions, *order) if partitions else narrow.repartitionByRange(*order)
    stored = store(ranged.sortWithinPartitions(*order).select(_STRETCH, _ROW), "order")

    file_no = F.regexp_extract(F.col("_metadata.file_name"), r"^part-(\d+)-", 1).cast("bigint")
    chunk_no = F.regexp_extract(F.col("_metadata.file_name"), r"-c(\d+)\.", 1).cast("bigint")
    indexed = stored.select(
        _STRETCH,
        _ROW,
        file_no.alias("__file"),
        chunk_no.alias("__chunk"),
        F.col("_metadata.row_index").alias("__index"),
    )
    # One row per written file: the only global window runs over that list, which goes to all tasks.
    sizes = indexed.groupBy("__file", "__chunk").agg(F.count(F.lit(1)).alias("__rows"))
    before = Window.orderBy("__file", "__chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "__file",
        "__chunk",
        F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before"),
    )
    number = (F.col("__before") + F.col("__index") + 1).alias("__number")
    pairs = F.array_sort(F.collect_list(F.struct(_ROW, "__number")))
    numbers = (
        indexed.join(F.broadcast(offsets), ["__file", "__chunk"]).select(_STRETCH, _ROW, number)
        .groupBy(_STRETCH).agg(F.transform(pairs, lambda x: x["__number"]).alias("__numbers"))
    )
    return wide.drop(_TIE).join(numbers.hint("shuffle_hash"), _STRETCH).select(
        *[F.col(c) for c in df.columns], F.get("__numbers", F.col(_ROW)).alias(out)
    )
