"""Packing by lexical retrieval: BM25 neighbours fill each seed document's window."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from labmart.llm.common import Work, read
from labmart.llm.tokens import encoder, pieces_of
from labmart.operators.rowid import spread_and_sort

WINDOW = 1024
#: Documents of one shard of the inverted index.
SHARD = 1024
#: BM25: saturation of term frequency and weight of length.
K1, B = 1.2, 0.75
_PIECE = "doc_id string, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
PIECE_SCHEMA = f"{_PIECE}, part int, window bigint, offset bigint"
CUT_SCHEMA = f"{PIECE_SCHEMA}, ids binary, near bigint, near2 bigint"
_COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "window", "offset"]


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def _nearness(ids: np.ndarray) -> tuple[int, int]:
    """Two minhashes of the ids: documents of like words lie close in this order."""
    h = ids.astype(np.uint64)
    keys = []
    for factor in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F):
        mixed = (h + np.uint64(1)) * np.uint64(factor)
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        keys.append(int(mixed.min() >> np.uint64(1)))
    return keys[0], keys[1]


def _cut(vocabulary: str, style: str | None, end_id: int, window: int):
    """Full windows of each document become sequences; the rest is left to be packed."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tok, part, made = encoder(vocabulary, style), TaskContext.get().partitionId(), 0
        for batch in batches:
            for few in pieces_of(batch):
                out = []
                for doc_id, x in zip(few["doc_id"], tok.encode(few["text"])):
                    ids = np.append(x, np.uint32(end_id))
                    n = len(ids)
                    for start in range(0, n - n % window, window):
                        whole = crc(ids[start : start + window])
                        out.append((doc_id, start, window, whole, n, part, made, 0, None, None, None))
                        made += 1
                    if n % window:
                        rest = ids[n - n % window :]
                        data = rest.astype("<u4").tobytes()
                        out.append(
                            (doc_id, n - len(rest), len(rest), None, n, None, None, None, data, *_nearness(rest))
                        )
                yield pd.DataFrame(out, columns=[*_COLUMNS, "ids", "near", "near2"]).astype(
                    {k: "Int64" for k in [*_COLUMNS[3:], "near", "near2"]}
                )

    return run


class InvertedIndex:
    """BM25 over one shard of documents, given as arrays of ids."""

    def __init__(self, docs: list[np.ndarray]):
        self.n = len(docs)
        # All ids of the shard in one sort, by term and then by document.
        key = np.concatenate(docs).astype(np.int64) * self.n + np.repeat(np.arange(self.n), [len(d) for d in docs])
        key.sort()
        posting = np.flatnonzero(np.diff(key, prepend=-1))
        tf = np.diff(posting, append=len(key)).astype(np.float64)
        term = key[posting] // self.n
        self.owner = key[posting] - term * self.n
        self.first = first = np.flatnonzero(np.diff(term, prepend=-1))
        self.df = df = np.diff(first, append=len(term))
        by_doc = np.argsort(self.owner.astype(np.uint32), kind="stable")
        ends = np.cumsum(np.bincount(self.owner, minlength=self.n))[:-1]
        #: Numbers of each document's terms in the shard's vocabulary.
        self.terms = np.split(np.repeat(np.arange(len(df)), df)[by_doc], ends)
        length = np.array([len(d) for d in docs], np.float64)
        norm = K1 * (1 - B + B * length / length.mean())[self.owner]
        idf = np.log1p((self.n - df + 0.5) / (df + 0.5))
        self.weight = np.repeat(idf, df) * tf * (K1 + 1) / (tf + norm)
        # Lists of a quarter of the documents or more are held as full rows, which add faster.
        common = np.flatnonzero(df * 4 >= self.n)
        self.dense_row = np.full(len(df), -1)
        self.dense_row[common] = np.arange(len(common))
        self.dense = np.zeros((len(common), self.n))
        for row, term in enumerate(common):
            x = slice(first[term], first[term] + df[term])
            self.dense[row, self.owner[x]] = self.weight[x]

    def scores(self, doc: int) -> np.ndarray:
        """BM25 score of every document of the shard for the terms of one of them."""
        at = self.terms[doc]
        common = self.dense_row[at]
        at = at[common < 0]
        n = self.df[at]
        place = np.arange(n.sum()) + np.repeat(self.first[at] - np.cumsum(n) + n, n)
        rare = np.bincount(self.owner[place], self.weight[place], minlength=self.n)
        return rare + self.dense[common[common >= 0]].sum(axis=0)


def best_first(score: np.ndarray, left: np.ndarray, few: int = 16) -> Iterator[int]:
    """``left`` by falling score, ties in order; mostly few are asked for, so those are sorted first."""
    score = -score[left]
    if len(left) > 4 * few:
        near = score <= np.partition(score, few)[few]
        yield from left[near][np.argsort(score[near], kind="stable")]
        score, left = score[~near], left[~near]
    yield from left[np.argsort(score, kind="stable")]


class Packer:
    """Fills windows from shard after shard; only the last window stays short."""

    def __init__(self, part: int, window: int):
        self.part, self.size, self.window, self.filled = part, window, 0, 0
        self.out: list[tuple] = []

    def _put(self, doc: tuple, ids: np.ndarray, begin: int) -> int:
        """Place what fits of the document from ``begin`` on; return where it stopped."""
        doc_id, start, n = doc
        take = min(len(ids) - begin, self.size - self.filled)
        piece = crc(ids[begin : begin + take])
        self.out.append((doc_id, start + begin, take, piece, n, self.part, self.window, self.filled))
        self.filled += take
        if self.filled == self.size:
            self.window, self.filled = self.window + 1, 0
        return begin + take

    def pack(self, docs: list[tuple], ids: list[np.ndarray]) -> None:
        """Longest unused document as seed, then its best unused neighbours in turn.

        The neighbour that crosses the window's end is cut there, and its rest
        is the next seed.
        """
        index, unused = InvertedIndex(ids), np.ones(len(docs), bool)
        waiting = iter(np.argsort([-len(x) for x in ids], kind="stable"))
        seed, begin = None, 0
        while True:
            if seed is None:
                seed = next((int(d) for d in waiting if unused[d]), None)
                if seed is None:
                    return
                unused[seed], begin = False, 0
            begin = self._put(docs[seed], ids[seed], begin)
            if begin < len(ids[seed]):
                continue
            following = None
            if self.filled and unused.any():
                for d in best_first(index.scores(seed), np.flatnonzero(unused)):
                    unused[d] = False
                    begin = self._put(docs[d], ids[d], 0)
                    if begin < len(ids[d]):
                        following = int(d)
                        break
                    if not self.filled:
                        break
            seed = following


def _pack(window: int, shard: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        packer = Packer(TaskContext.get().partitionId(), window)
        docs, ids = [], []

        def packed() -> pd.DataFrame:
            packer.pack(docs, ids)
            rows, packer.out = packer.out, []
            return pd.DataFrame(rows, columns=_COLUMNS)

        for batch in batches:
            for doc_id, start, n, data in zip(batch["doc_id"], batch["start"], batch["doc_tokens"], batch["ids"]):
                docs.append((doc_id, start, n))
                ids.append(np.frombuffer(data, "<u4"))
                if len(docs) == shard:
                    yield packed()
                    docs, ids = [], []
        if docs:
            yield packed()

    return run


def _numbered(pieces: DataFrame, work: Work, table: str, base) -> DataFrame:
    """Windows numbered on from ``base`` over all parts, of which there is one per task."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = work.keep(
        pieces.groupBy("part").agg((F.max("window") + 1).alias("n")).select(
            "part", "n", (F.coalesce(F.sum("n").over(before), F.lit(0)) + base).alias("first")
        ),
        table,
    )
    return pieces.join(parts, "part").select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "start", "length", "ids_crc32", "doc_tokens",
        (F.col("first") + F.col("window")).alias("sequence_id"), "offset",
    )


def pack_documents(
    docs: DataFrame,
    vocabulary: str,
    style: str | None = None,
    end_id: int = 0,
    window: int = WINDOW,
    shard: int = SHARD,
) -> DataFrame:
    """Pieces of all documents in sequences of at most ``window`` ids.

    Columns: doc_id, start, length, ids_crc32, doc_tokens, sequence_id (gapless
    from 0), offset. A document is its ids and ``end_id``; null text is empty.
    Full windows of a document are sequences of their own. The rest of each is
    range-partitioned by minhashes of its ids, so that like documents share a
    shard of the inverted index and a hot group is split at any row; within a
    shard the best unused neighbours of a seed fill its window. Every window is
    full but the last of each task. Repeated rows are documents of their own;
    an empty table gives no rows.
    """
    work = Work(docs.sparkSession, "packing")
    rows = docs.select(F.col("doc_id").cast("bigint").cast("string").alias("doc_id"), "text")
    cut = work.keep(rows.mapInPandas(_cut(vocabulary, style, end_id, window), CUT_SCHEMA), "cut", "zstd")
    whole = cut.where("part IS NOT NULL").select(*_COLUMNS)
    rest = cut.where("part IS NULL").select("doc_id", "start", "doc_tokens", "ids", "near", "near2")
    near = spread_and_sort(rest, ["near", "near2"]).drop("near", "near2")
    packed = work.keep(near.mapInPandas(_pack(window, shard), PIECE_SCHEMA), "packed")
    # One number: how many sequences the full windows make.
    base = whole.groupBy("part").agg((F.max("window") + 1).alias("n")).agg(F.sum("n")).first()[0] or 0
    return _numbered(whole, work, "whole_parts", F.lit(0)).unionByName(
        _numbered(packed, work, "packed_parts", F.lit(base))
    )


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    return pack_documents(read(spark, sf_dir, "documents"), vocabulary, "byte")
