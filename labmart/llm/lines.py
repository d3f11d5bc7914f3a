"""Lines that many documents share, dropped by compressed keep bitmaps.

Line hashes are range-partitioned by hash and document and sorted by hash,
document and position. One pass over a partition streams each hash's lines:
those of its first documents wait until enough documents have it, then they
and all later ones go out. Only the first and the last hash of a partition can
go on in another one; what waits of these two is settled by their totals.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labmart.llm.common import AT, STRETCH, STRETCH_BITS, Work, free_name, in_place, read

#: The white space of a line's ends: \x20 and \x09 to \x0D.
BLANK = b" \t\n\x0b\x0c\r"
#: Rows of an output batch.
ROWS = 1 << 16
LINES = "high bigint, low bigint, row bigint, position int"
#: ``run``: null for a settled line, else the partition of an open run; ``documents``: its number there.
DROPS = "high bigint, low bigint, row bigint, position int, first boolean, run int, documents bigint"


def line_key(line: bytes) -> bytes:
    """The line without white space at its ends, A-Z in lower case."""
    return line.strip(BLANK).lower()


def _hashes(least_chars: int):
    """The 128-bit hash of each line whose key has enough code points."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, out, rows, positions = xxhash.xxh3_128_digest, [], [], []

        def batch() -> pa.RecordBatch:
            both = np.frombuffer(b"".join(out), ">i8").reshape(-1, 2)
            made = [pa.array(both[:, i].astype(np.int64)) for i in (0, 1)]
            made += [pa.array(rows, pa.int64()), pa.array(positions, pa.int32())]
            out.clear(), rows.clear(), positions.clear()
            return pa.RecordBatch.from_arrays(made, ["high", "low", "row", "position"])

        for part in batches:
            for row, text in zip(part.column("row").to_pylist(), part.column("text")):
                for position, line in enumerate((text.as_py() or b"").split(b"\n")):
                    key = line_key(line)
                    # A code point has one to four bytes, so few keys need decoding.
                    if len(key) < least_chars or (
                        len(key) < 4 * least_chars and len(key.decode("utf-8", "replace")) < least_chars
                    ):
                        continue
                    out.append(digest(key))
                    rows.append(row)
                    positions.append(position)
                    if len(out) >= ROWS:
                        yield batch()
        if out:
            yield batch()

    return run


class _Stream:
    """State of one pass over sorted lines: the hash at hand and its lines that wait."""

    def __init__(self, partition: int, least_docs: int, keep_first: bool):
        self.partition, self.least_docs, self.keep_first = partition, least_docs, keep_first
        self.key, self.row, self.documents = None, None, 0
        self.edge = True
        self.waiting: list[tuple[int, int]] = []
        self.out: list[tuple] = []

    def _emit(self, row, position, first, settled):
        run = None if settled else self.partition
        self.out.append((*self.key, row, position, first, run, None if settled else self.documents))

    def line(self, key, row, position):
        if key != self.key:
            self.close(last=False)
            self.key, self.row, self.documents = key, None, 0
        if row != self.row:
            self.row, self.documents = row, self.documents + 1
            if self.documents == self.least_docs:
                self._release()
        if self.documents < self.least_docs or (self.documents == 1 and not self.waiting):
            self.waiting.append((row, position))
        else:
            self._emit(row, position, False, True)

    def _release(self):
        """Enough documents: what waits goes out, but for the first line, on which ``close`` decides."""
        for row, position in self.waiting[1:]:
            self._emit(row, position, False, True)
        del self.waiting[1:]

    def close(self, last: bool):
        """End of a hash's lines here. At an edge of the partition the totals of all partitions decide."""
        if self.key is not None and self.waiting:
            if self.edge or last:
                for i, (row, position) in enumerate(self.waiting):
                    self._emit(row, position, i == 0, False)
            elif self.documents >= self.least_docs and not self.keep_first:
                self._emit(*self.waiting[0], True, True)
        if self.key is not None:
            self.edge = False
        self.waiting = []

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.out)) if self.out else [[]] * 7
        self.out = []
        types = [pa.int64()] * 3 + [pa.int32(), pa.bool_(), pa.int32(), pa.int64()]
        names = ["high", "low", "row", "position", "first", "run", "documents"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def _common(least_docs: int, keep_first: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        stream = _Stream(TaskContext.get().partitionId(), least_docs, keep_first)
        for part in batches:
            columns = [part.column(n).to_pylist() for n in ("high", "low", "row", "position")]
            for high, low, row, position in zip(*columns):
                stream.line((high, low), row, position)
            if len(stream.out) >= ROWS:
                yield stream.batch()
        stream.close(last=True)
        yield stream.batch()

    return run


def dropped_lines(
    lines: DataFrame, work: Work, least_docs: int, keep_first: bool = False
) -> DataFrame:
    """(row, position) of all lines whose hash ``least_docs`` documents hold.

    ``lines`` has high, low, row and position. A hash's lines may fill many
    partitions, as the document is part of the range; the lines of one hash in one document
    stay together, so that each document counts once. What waits in a task are
    the lines of fewer than ``least_docs`` documents. Open runs are at most two
    for each partition.
    """
    order = ["high", "low", "row", "position"]
    ranged = lines.repartitionByRange("high", "low", "row").sortWithinPartitions(*order)
    found = work.keep(ranged.mapInArrow(_common(least_docs, keep_first), DROPS), "drops")
    open_ = found.where(F.col("run").isNotNull())
    key = ["high", "low"]
    # One row for each open run, then one for each of their hashes.
    totals = (
        open_.groupBy(*key, "run").agg(
            F.max("documents").alias("documents"),
            F.min(F.when(F.col("first"), F.struct("row", "position"))).alias("at"),
        )
        .groupBy(*key).agg(F.sum("documents").alias("total"), F.min("at").alias("at"))
        .where(F.col("total") >= least_docs)
    )
    late = open_.join(totals, key)
    if keep_first:
        late = late.where(F.struct("row", "position") != F.col("at"))
    settled = found.where(F.col("run").isNull())
    return settled.select("row", "position").unionAll(late.select("row", "position"))


def packed_keep(n_lines: int, dropped: list[int]) -> bytes:
    """Bit i (lowest first) is 1 if line i stays; deflated."""
    keep = np.ones(n_lines, bool)
    keep[dropped] = False
    return zlib.compress(np.packbits(keep, bitorder="little").tobytes())


def kept_lines(n_lines: int, keep: bytes) -> np.ndarray:
    """The bitmap as booleans."""
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), bitorder="little")
    return bits[:n_lines].astype(bool)


@F.pandas_udf(T.BinaryType())
def _packed(n_lines: pd.Series, dropped: pd.Series) -> pd.Series:
    return pd.Series([packed_keep(n, d) for n, d in zip(n_lines, dropped)], dtype=object)


@F.pandas_udf(T.BinaryType())
def kept_text(text: pd.Series, keep: pd.Series) -> pd.Series:
    """UTF-8 of the lines that stay, joined by \\n; null where the text is null."""
    out = []
    for t, k in zip(text, keep):
        if t is None:
            out.append(None)
            continue
        parts = bytes(t).split(b"\n")
        out.append(b"\n".join(p for p, stays in zip(parts, kept_lines(len(parts), k)) if stays))
    return pd.Series(out, dtype=object)


def line_keeps(
    docs: DataFrame, least_chars: int = 1, least_docs: int = 10, keep_first: bool = False
) -> DataFrame:
    """``docs`` with n_lines, n_dropped and keep, the compressed bitmap of the lines that stay.

    Columns of these names in ``docs`` are replaced. Lines are what ``\\n``
    separates; a line's key is the line without white space at its ends, in ASCII lower
    case. A key of at least ``least_chars`` code points that occurs in at least
    ``least_docs`` documents loses its lines everywhere, or, with
    ``keep_first``, everywhere but in its first place. keep is null
    where every line stays; ``kept_text`` applies it.

    A document is a row: rows with the same id, or none, count separately. Null and
    empty texts are one empty line. A line repeated in one document counts once. An
    empty table gives no rows. Keys are told apart by 128-bit hashes.
    """
    work = Work(docs.sparkSession, "lines")
    others = [c for c in docs.columns if c.lower() not in {"n_lines", "n_dropped", "keep"}]
    stored = in_place(docs.select(*others), work, "stored")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    row = F.shiftleft(STRETCH, STRETCH_BITS).bitwiseOR(F.col(AT)).alias("row")
    bytes_of = F.col("text").cast("binary").alias("text")
    hashed = stored.select(row, bytes_of).mapInArrow(_hashes(least_chars), LINES)
    # Stored, as finding the ranges reads the lines twice.
    lines = work.keep(hashed, "hashes")
    of, gone = free_name(stored, "of"), free_name(stored, "dropped")
    at = F.col("row").bitwiseAND(F.lit((1 << STRETCH_BITS) - 1)).cast("int")
    drops = (
        dropped_lines(lines, work, least_docs, keep_first)
        .groupBy("row").agg(F.collect_list("position").alias(gone))
        .groupBy(F.shiftright("row", STRETCH_BITS).alias(of))
        .agg(F.map_from_entries(F.collect_list(F.struct(at.alias("at"), gone))).alias(gone))
    )
    n_lines = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1
    own = F.try_element_at(F.col(gone), F.col(AT))
    dropped = F.coalesce(own, F.array().cast("array<int>"))
    met = stored.join(drops.hint("shuffle_hash"), F.col(STRETCH) == F.col(of), "left")
    return met.select(
        *others,
        n_lines.alias("n_lines"),
        F.size(dropped).alias("n_dropped"),
        F.when(own.isNotNull(), _packed(n_lines, dropped)).alias("keep"),
    )


OP11_SQL = """
WITH docs AS MATERIALIZED (
  SELECT row_number() OVER () AS row, doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
lines AS MATERIALIZED (
  SELECT row, generate_subscripts(parts, 1) AS position, unnest(parts) AS line FROM docs),
keys AS MATERIALIZED (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
common AS MATERIALIZED (
  SELECT key FROM keys WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT row) >= 10),
marked AS (SELECT k.*, c.key IS NOT NULL AS gone FROM keys k LEFT JOIN common c ON k.key = c.key),
whole AS (
  SELECT row, count(*) AS n_lines, count_if(gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY position) FILTER (NOT gone), '')) AS kept_sha256
  FROM marked GROUP BY row)
SELECT d.doc_id, CAST(w.n_lines AS BIGINT) AS n_lines, CAST(w.n_dropped AS BIGINT) AS n_dropped, w.kept_sha256
FROM docs d JOIN whole w USING (row)"""


def op11_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_keeps(read(spark, sf_dir, "documents").select("doc_id", "text"))
    text = F.coalesce(F.col("text").cast("binary"), F.lit("").cast("binary"))
    # Only texts that lose a line go through Python.
    shorter = kept_text(F.when(F.col("keep").isNotNull(), text), F.col("keep"))
    return kept.select(
        "doc_id",
        F.col("n_lines").cast("bigint").alias("n_lines"),
        F.col("n_dropped").cast("bigint").alias("n_dropped"),
        F.sha2(F.when(F.col("keep").isNull(), text).otherwise(shorter), 256).alias("kept_sha256"),
    )
