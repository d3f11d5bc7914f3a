"""Shards of equal bytes by longest-processing-time scheduling."""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labmart.llm.common import Work, read
from labmart.operators.rowid import global_row_id

#: Bytes that every row takes besides its text.
ROW_BYTES = 16


def longest_first(sizes: list[int], shards: int) -> list[int]:
    """Shard of each item: the largest item first, always to the least loaded shard."""
    heap = [(0, s) for s in range(shards)]
    out = [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        load, shard = heapq.heappop(heap)
        out[i] = shard
        heapq.heappush(heap, (load + sizes[i], shard))
    return out


def shard_by_bytes(docs: DataFrame, shards: int = 40, fineness: int = 256) -> DataFrame:
    """Each document with its shard 0 to ``shards - 1``; equal texts share a shard.

    Columns: doc_id, size (UTF-8 bytes of the text plus 16; null: 16),
    text_crc32, law (``bytes``), shard, slot (gapless from 0 in each shard, in
    order of doc_id, rows without an id last) and grown_shard (null).

    A group is a text hash. Groups of at least 1/``fineness`` of a shard's
    share are items of their own: there are at most ``shards * fineness`` of
    them, whatever the input. All smaller groups are summed by hash into
    ``shards * fineness`` bundles, items too. So the heap on the driver sees at
    most ``2 * shards * fineness`` items, and shards differ by about one
    bundle, or by the surplus of a group larger than a whole share, which
    cannot be split. An empty table gives no rows; null and empty texts are
    one group; rows may repeat.
    """
    spark = docs.sparkSession
    work = Work(spark, "shards")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = work.keep(
        docs.select(
            F.col("doc_id").cast("bigint").alias("doc_id"),
            (F.octet_length(text).cast("bigint") + ROW_BYTES).alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("content"),
        ),
        "rows",
    )
    groups = work.keep(rows.groupBy("content").agg(F.sum("size").alias("bytes")), "groups")
    bundles = shards * fineness
    total = groups.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    least = max(1, -(-total // bundles))
    bundle = F.pmod("content", F.lit(bundles))
    large = groups.where(F.col("bytes") >= least).collect()
    small = (
        groups.where(F.col("bytes") < least)
        .groupBy(bundle.alias("bundle")).agg(F.sum("bytes").alias("bytes")).collect()
    )
    items = [(True, r["content"], r["bytes"]) for r in large]
    items += [(False, r["bundle"], r["bytes"]) for r in small]
    items.sort()
    placed = longest_first([x[2] for x in items], shards)
    table = spark.createDataFrame(
        [(own, key, shard) for (own, key, _), shard in zip(items, placed)],
        "own boolean, key bigint, shard int",
    )
    # Both maps hold at most shards * fineness rows of a few bytes.
    own = F.broadcast(
        table.where("own").select(F.col("key").alias("content"), F.col("shard").alias("own_shard"))
    )
    by_bundle = F.broadcast(
        table.where("NOT own").select(F.col("key").alias("bundle"), F.col("shard").alias("bundle_shard"))
    )
    dealt = (
        rows.join(own, "content", "left")
        .withColumn("bundle", bundle)
        .join(by_bundle, "bundle", "left")
        .select(
            "doc_id", "size", "text_crc32",
            F.coalesce("own_shard", "bundle_shard").cast("int").alias("shard"),
        )
    )
    numbered = work.keep(
        global_row_id(dealt, ["shard", "doc_id", "text_crc32", "size"], out="row_number"), "numbered"
    )
    first = F.broadcast(numbered.groupBy("shard").agg(F.min("row_number").alias("first")))
    return numbered.join(first, "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("row_number") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_by_bytes(read(spark, sf_dir, "documents"))
