"""Token ids of a corpus in binary blocks with Elias-Fano coded boundaries.

File format: a Parquet table of blocks in ascending ``doc_id`` order, written
with Spark's commit. A block is self-contained: a head (magic, version, bytes
per id, numbers of documents, ids and null doc_ids, first doc_id), the
Elias-Fano codes of the doc_ids above the first and of the documents' ends,
and the concatenated ids as little-endian integers of 2 or 4 bytes.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from labmart.llm import elias_fano
from labmart.llm.common import Work, read
from labmart.llm.tokens import encoder, pieces_of
from labmart.operators.rowid import spread_and_sort

MAGIC, VERSION = b"TOKB", 1
_HEAD = "<4sHHQQQq"
#: A block is closed once it has so many ids.
BLOCK_IDS = 1 << 21
BLOCK_SCHEMA = "part int, block int, n_docs bigint, n_ids bigint, payload binary"


def pack_block(doc_ids: list[int | None], ids: list[np.ndarray], width: int) -> bytes:
    """One block; null doc_ids come first, the others ascend."""
    known = [int(d) for d in doc_ids if d is not None]
    first = known[0] if known else 0
    above = np.array([d - first for d in known], np.uint64)
    ends = np.cumsum([len(x) for x in ids], dtype=np.uint64)
    flat = np.concatenate(ids).astype(f"<u{width}")
    head = struct.pack(_HEAD, MAGIC, VERSION, width, len(ids), len(flat), len(ids) - len(known), first)
    return head + elias_fano.encode(above) + elias_fano.encode(ends) + flat.tobytes()


class TokenBlock:
    """Reads a block; offsets come from select on the coded ends."""

    def __init__(self, payload: bytes):
        magic, version, width, self.n_docs, self.n_ids, self.n_null, self.first = struct.unpack_from(_HEAD, payload)
        if magic != MAGIC or version != VERSION:
            raise ValueError("not a token block")
        self.above = elias_fano.EliasFano(payload, struct.calcsize(_HEAD))
        self.ends = elias_fano.EliasFano(payload, self.above.end)
        self.ids = np.frombuffer(payload, f"<u{width}", self.n_ids, self.ends.end)

    def doc_id(self, i: int) -> int | None:
        return None if i < self.n_null else self.first + self.above.select(i - self.n_null)

    def start(self, i: int) -> int:
        return self.ends.select(i - 1) if i else 0

    def document(self, i: int) -> np.ndarray:
        return self.ids[self.start(i) : self.ends.select(i)]


def _write(vocabulary: str, style: str | None, end_id: int, width: int, block_ids: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tok, part, number = encoder(vocabulary, style), TaskContext.get().partitionId(), 0
        docs, ids, size = [], [], 0

        def closed() -> pd.DataFrame:
            row = (part, number, len(docs), size, pack_block(docs, ids, width))
            return pd.DataFrame([row], columns=["part", "block", "n_docs", "n_ids", "payload"])

        for batch in batches:
            for few in pieces_of(batch):
                for doc_id, x in zip(few["doc_id"], tok.encode(few["text"])):
                    docs.append(None if pd.isna(doc_id) else int(doc_id))
                    ids.append(np.append(x, np.uint32(end_id)).astype(f"<u{width}"))
                    size += len(ids[-1])
                    if size >= block_ids:
                        yield closed()
                        docs, ids, size, number = [], [], 0, number + 1
        if docs:
            yield closed()

    return run


def write_token_blocks(
    docs: DataFrame,
    work: Work,
    vocabulary: str,
    style: str | None,
    end_id: int,
    width: int = 2,
    block_ids: int = BLOCK_IDS,
) -> DataFrame:
    """Encode all texts, each followed by ``end_id``, into blocks in doc_id order.

    Null doc_ids come first, rows of one doc_id in order of the text's hash.
    Texts are range-partitioned by id and position, so neither a hot id nor
    repeated rows gather in one task.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").withColumns(
        {"known": F.col("doc_id").isNotNull(), "tie": F.xxhash64("text")}
    )
    ordered = spread_and_sort(rows, ["known", "doc_id", "tie"]).select(
        F.col("doc_id").cast("string").alias("doc_id"), "text"
    )
    blocks = ordered.mapInPandas(_write(vocabulary, style, end_id, width, block_ids), BLOCK_SCHEMA)
    return work.keep(blocks, "blocks", compression="zstd")


def _digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for part, number, payload in zip(batch["part"], batch["block"], batch["payload"]):
            block = TokenBlock(payload)
            ids = [block.doc_id(i) for i in range(block.n_docs)]
            starts = [block.start(i) for i in range(block.n_docs)]
            texts = [block.document(i) for i in range(block.n_docs)]
            crc = [zlib.crc32(x.astype("<u4").tobytes()) for x in texts]
            yield pd.DataFrame(
                {
                    "part": part, "block": number, "doc_id": pd.array(ids, "Int64"),
                    "place": starts, "n_tokens": [len(x) for x in texts], "ids_crc32": crc,
                }
            )


def read_token_digests(blocks: DataFrame) -> DataFrame:
    """doc_id, start (ids of all earlier documents), n_tokens and ids_crc32 from the blocks.

    Block sizes are summed in order in two steps: within a part, and over the
    list of parts, of which there are as many as tasks that wrote.
    """
    sizes = blocks.select("part", "block", "n_ids")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("ids")).select(
        "part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("part_start")
    )
    inside = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.join(parts, "part").select(
        "part", "block",
        (F.col("part_start") + F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).alias("block_start"),
    )
    rows = blocks.select("part", "block", "payload").mapInPandas(
        _digest, "part int, block int, doc_id bigint, place bigint, n_tokens bigint, ids_crc32 bigint"
    )
    return rows.join(starts, ["part", "block"]).select(
        "doc_id", (F.col("block_start") + F.col("place")).alias("start"), "n_tokens", "ids_crc32"
    )


def tokenize_corpus(
    docs: DataFrame, vocabulary: str, style: str | None = None, end_id: int = 1, width: int = 2
) -> DataFrame:
    """Write the corpus as token blocks and return each document's digest from the files.

    A null text is empty: its ids are the end id alone. Repeated rows are
    documents of their own; an empty table gives no rows; columns other than
    doc_id and text are ignored.
    """
    work = Work(docs.sparkSession, "tokens")
    return read_token_digests(write_token_blocks(docs, work, vocabulary, style, end_id, width))


def op2_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return tokenize_corpus(read(spark, sf_dir, "documents"), vocabulary, "word")
