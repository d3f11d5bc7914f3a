"""Vector codes from integer codebooks, assigned by Orchard's search.

For every entry of a codebook the list of all entries by distance from it is
kept. A search walks the list of its best entry so far; an entry that is nearer
to the vector becomes the best, and the walk goes on in its list. Entries seen
are marked, and the walk ends at the first entry that lies beyond twice the
best distance from the list's owner, as no later one can be nearer.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labmart.llm.common import Work, read

#: Integer steps of one unit of a component.
STEPS = 4096
#: Integers up to this size have squared distances that fit 64 bits in vectors of 2,048 components.
SMALL = 1 << 25
#: Larger integers than this saturate; error sums beyond 64 bits are null.
LARGEST = 1 << 62

_DECIMAL = pa.decimal128(38, 0)
SUMS = "width int, part int, entry int, place int, total decimal(38,0), uses bigint"


def usable(column: Column) -> Column:
    """Not null, and every component a finite number; no components at all will do."""
    finite = F.forall(
        column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    )
    return F.coalesce(finite, F.lit(False))


def part_bounds(width: int, parts: int) -> list[tuple[int, int]]:
    """Consecutive parts of equal length, or as near to that as the width allows."""
    cuts = [i * width // parts for i in range(parts + 1)]
    return list(zip(cuts, cuts[1:]))


def integers(values: np.ndarray) -> np.ndarray:
    """floor(4096 * x) of finite doubles; an int64 array, of Python integers where they are large."""
    if not values.size or np.abs(values).max() * STEPS < SMALL:
        return np.floor(values * STEPS).astype(np.int64)
    whole = lambda x: math.floor(x * STEPS) if abs(x) < 2.0**50 else int(x) * STEPS
    clipped = [min(max(whole(float(x)), -LARGEST), LARGEST) for x in values.ravel()]
    return np.array(clipped, dtype=object).reshape(values.shape)


class Codebook:
    """Entries of one part position with their neighbour lists."""

    def __init__(self, entries: list[list[int]]):
        self.entries = entries
        large = any(abs(x) >= SMALL for entry in entries for x in entry)
        width = len(entries[0]) if entries else 0
        table = np.array(entries, dtype=object if large else np.int64).reshape(len(entries), width)
        self.table = table
        gaps = ((table[:, None, :] - table[None, :, :]) ** 2).sum(axis=2)
        if width == 0:
            gaps = np.zeros((len(entries), len(entries)), np.int64)
        # The list of each entry: all entries by distance, equal ones by index; its owner is the first
        # unless a copy of it has a lower index.
        self.lists = np.array(
            [sorted(range(len(entries)), key=lambda e: (row[e], e)) for row in gaps], dtype=np.int64
        ).reshape(len(entries), len(entries))
        self.reach = np.take_along_axis(gaps, self.lists, axis=1)

    def distances(self, vectors: np.ndarray, entry: np.ndarray) -> np.ndarray:
        gap = vectors - self.table[entry]
        return (gap * gap).sum(axis=1) if gap.shape[1] else np.zeros(len(gap), np.int64)

    def nearest(self, vectors: np.ndarray, start: np.ndarray | None = None):
        """(entry, squared distance) of each vector; of equally near entries the lowest index."""
        n, k = len(vectors), len(self.entries)
        best = np.zeros(n, np.int64) if start is None else start.astype(np.int64)
        found = self.distances(vectors, best)
        seen = np.zeros((n, k), bool)
        seen[np.arange(n), best] = True
        place, walking = np.zeros(n, np.int64), np.arange(n)
        while len(walking):
            owner, at = best[walking], place[walking]
            # Squared: beyond twice the distance is over four times its square. On equality an entry
            # may be as near and have a lower index, so the walk goes on.
            near = (self.reach[owner, at] <= 4 * found[walking]).astype(bool)
            walking, owner, at = walking[near], owner[near], at[near]
            other = self.lists[owner, at]
            place[walking] = at + 1
            fresh = ~seen[walking, other]
            asked, other = walking[fresh], other[fresh]
            seen[asked, other] = True
            distance = self.distances(vectors[asked], other)
            better = (distance < found[asked]) | ((distance == found[asked]) & (other < best[asked]))
            better = better.astype(bool)
            moved = asked[better]
            best[moved], found[moved], place[moved] = other[better], distance[better], 0
            walking = walking[place[walking] < k]
        return best, found


Books = dict[int, list[Codebook]]


def _by_width(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(width, rows of the batch, their vectors as integers) for each vector length."""
    lists = batch.column(column)
    widths = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    starts = np.concatenate([[0], np.cumsum(widths)])
    for width in np.unique(widths):
        rows = np.flatnonzero(widths == width)
        at = starts[rows][:, None] + np.arange(width)[None, :]
        yield int(width), rows, integers(flat[at.astype(np.int64)])


def _assigned(batch: pa.RecordBatch, books: Books):
    """(width, rows, entries by part, distances by part, the parts themselves) for each length."""
    for width, rows, vectors in _by_width(batch, "vector"):
        cuts = part_bounds(width, len(books[width]))
        pieces = [vectors[:, a:b] for a, b in cuts]
        found = [book.nearest(piece) for book, piece in zip(books[width], pieces)]
        yield width, rows, [f[0] for f in found], [f[1] for f in found], pieces


def _sums(books: Books):
    """Sums and counts of the parts of each entry, one set of rows for a task's whole partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple[int, int, int], list[int]] = {}
        uses: dict[tuple[int, int, int], int] = {}
        for batch in batches:
            for width, _, entries, _, pieces in _assigned(batch, books):
                for part, (entry, piece) in enumerate(zip(entries, pieces)):
                    for e in np.unique(entry):
                        own, key = piece[entry == e], (width, part, int(e))
                        sums = [int(x) for x in own.sum(axis=0)]
                        totals[key] = [a + b for a, b in zip(totals.get(key, [0] * len(sums)), sums)]
                        uses[key] = uses.get(key, 0) + len(own)
        rows = [(*key, place, Decimal(x), uses[key]) for key, t in totals.items() for place, x in enumerate(t)]
        columns = list(zip(*rows)) if rows else [[]] * 6
        types = [pa.int32()] * 4 + [_DECIMAL, pa.int64()]
        names = ["width", "part", "entry", "place", "total", "uses"]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    return run


def _coded(books: Books):
    """The batch without its vectors, but with code and error of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes: list[str] = [""] * len(batch)
            errors: list[int | None] = [0] * len(batch)
            for _, rows, entries, distances, _ in _assigned(batch, books):
                octets = np.stack(entries, axis=1).astype(np.uint8)
                total = sum(distances[1:], distances[0])
                for row, code, error in zip(rows, octets, total):
                    codes[row] = code.tobytes().hex()
                    errors[row] = int(error) if error < 1 << 63 else None
            rest = batch.drop_columns(["vector"])
            yield rest.append_column("code", pa.array(codes, pa.string())).append_column(
                "error", pa.array(errors, pa.int64())
            )

    return run


def _first_books(kept: DataFrame, parts: int, entries: int) -> dict[int, list[list[list[int]]]]:
    """Per width and part position, that part of the vectors with the smallest ids."""
    widths = [r["width"] for r in kept.select("width").distinct().collect()]
    books = {}
    for width in sorted(widths):
        own = kept.where(F.col("width") == width)
        ids = own.select("vec_id").distinct().orderBy(F.col("vec_id").asc_nulls_last()).limit(entries)
        # At most ``entries`` ids. Of one id's rows the smallest vector counts, as an entry belongs to an id.
        first = own.join(F.broadcast(ids.withColumnRenamed("vec_id", "of")), F.col("vec_id").eqNullSafe(F.col("of")))
        by_id = first.groupBy("vec_id").agg(F.min("vector").alias("vector"))
        first = by_id.orderBy(F.col("vec_id").asc_nulls_last()).collect()
        whole = [integers(np.array(r["vector"], np.float64)).tolist() for r in first]
        books[width] = [[v[a:b] for v in whole] for a, b in part_bounds(width, parts)]
    return books


def codebooks_digest(books: list[list[list[int]]]) -> str:
    """SHA-256 of all components in decimal by part, entry and place, joined by commas."""
    text = ",".join(str(x) for book in books for entry in book for x in entry)
    return hashlib.sha256(text.encode()).hexdigest()


def compress_vectors(
    vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6
) -> tuple[DataFrame, dict[int, list[list[list[int]]]]]:
    """Codes of all usable vectors, and the codebooks: width -> part -> entry -> integers.

    Rows: vec_id, label, width, code (two hex digits for each part) and error
    (squared distances summed over the parts). A component x counts as
    floor(4096 * x). Codebooks start as the parts of the ``entries`` smallest
    ids; each of ``rounds`` rounds assigns every part to its nearest entry (ties
    to the lower index) and moves each used entry to the rounded-down mean of
    its parts. Then all parts are assigned once more.

    Each round is one job over the stored vectors: a task sends one row of
    sums for each component of the entries it used, and the driver receives as many as the
    codebooks have components, whatever the input. ``entries`` may be at most 256.

    Vectors that are null or hold null or non-finite components are left out.
    Vectors of different lengths have codebooks of their own (the lengths are
    taken to be few); a length that ``parts`` does not divide is cut as evenly
    as it can be. Rows without an id come last when codebooks begin; of the rows of one
    id the smallest vector counts there. Repeated rows are coded alike, once
    each. Fewer rows than ``entries`` give shorter codebooks, an empty table no
    rows. A missing label column counts as null labels. Components beyond 2**62 steps
    saturate, and an error beyond 64 bits is null.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits: 1 to 256 entries")
    work = Work(vectors.sparkSession, "orchard")
    label = F.col("label") if "label" in vectors.columns else F.lit(None).cast("int")
    kept = work.keep(
        vectors.select(
            F.col("vec_id"), label.alias("label"),
            F.col("embedding").cast("array<double>").alias("vector"),
        ).where(usable(F.col("vector"))).withColumn("width", F.size("vector")),
        "kept",
    )
    books = _first_books(kept, parts, entries)
    lists = lambda: {w: [Codebook(b) for b in book] for w, book in books.items()}
    narrow = kept.select("vector")
    for _ in range(rounds):
        sums = narrow.mapInArrow(_sums(lists()), SUMS).groupBy("width", "part", "entry", "place")
        for r in sums.agg(F.sum("total").alias("total"), F.sum("uses").alias("uses")).collect():
            books[r["width"]][r["part"]][r["entry"]][r["place"]] = int(r["total"]) // r["uses"]
    schema = T.StructType([f for f in kept.schema if f.name != "vector"])
    schema = schema.add("code", T.StringType()).add("error", T.LongType())
    return work.keep(kept.mapInArrow(_coded(lists()), schema), "codes"), books


def label_errors(codes: DataFrame) -> DataFrame:
    """``codes`` with label_error, the error summed over the rows of the same label (nulls are one).

    Null if the sum, or an error in it, leaves 64 bits. Sums are combined before they are
    exchanged; a label with most of the rows only reads its one sum.
    """
    total = F.expr("try_cast(sum(CAST(error AS decimal(38,0))) AS bigint)")
    sums = codes.groupBy(F.col("label").alias("of")).agg(
        F.when(F.count("error") == F.count(F.lit(1)), total).alias("label_error")
    )
    return codes.join(sums, codes["label"].eqNullSafe(sums["of"]), "left").drop("of")


def _oracle(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """The same by comparing every part with every entry, one set of CTEs for each round."""
    rounds_sql = ""
    for r in range(rounds + 1):
        rounds_sql += f"""
near{r} AS MATERIALIZED (SELECT p.row, p.part, b.entry, sum((p.x - b.x) * (p.x - b.x))::BIGINT AS gap
  FROM places p JOIN book{r} b ON p.part = b.part AND p.place = b.place GROUP BY ALL),
used{r} AS MATERIALIZED (SELECT row, part, arg_min(entry, {{'gap': gap, 'entry': entry}}) AS entry, min(gap) AS gap
  FROM near{r} GROUP BY row, part),"""
        if r < rounds:
            rounds_sql += f"""
mean{r} AS (SELECT u.part, u.entry, p.place, CAST(floor(sum(p.x) / count(*)) AS BIGINT) AS x
  FROM used{r} u JOIN places p ON u.row = p.row AND u.part = p.part GROUP BY ALL),
book{r + 1} AS MATERIALIZED (SELECT b.part, b.entry, b.place, coalesce(m.x, b.x) AS x
  FROM book{r} b LEFT JOIN mean{r} m ON b.part = m.part AND b.entry = m.entry AND b.place = m.place),"""
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) - 1 AS row, vec_id, label, embedding AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
whole AS (SELECT row, generate_subscripts(v, 1) - 1 AS i, len(v) // {parts} AS size, unnest(v) AS x FROM kept),
places AS MATERIALIZED (SELECT row, i // size AS part, i % size AS place,
  CAST(floor({STEPS} * CAST(x AS DOUBLE)) AS BIGINT) AS x FROM whole),
book0 AS (SELECT part, row AS entry, place, x FROM places WHERE row < {entries}),{rounds_sql}
digest AS (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, place)) AS codebooks_sha256
  FROM book{rounds}),
coded AS (SELECT row, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(gap)::BIGINT AS error
  FROM used{rounds} GROUP BY row)
SELECT k.vec_id, c.code, c.error,
  CAST(sum(c.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error, d.codebooks_sha256
FROM kept k JOIN coded c USING (row) CROSS JOIN digest d"""


#: Holds for ids that do not repeat and vectors of one length that the parts divide.
OP13_SQL = _oracle()


def op13_orchard(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = compress_vectors(read(spark, sf_dir, "embeddings"))
    digest = F.create_map(
        *[x for w, b in books.items() for x in (F.lit(w), F.lit(codebooks_digest(b)))]
    ) if books else F.create_map().cast("map<int,string>")
    return label_errors(codes).select(
        "vec_id", "code", "error", "label_error", digest[F.col("width")].alias("codebooks_sha256")
    )
