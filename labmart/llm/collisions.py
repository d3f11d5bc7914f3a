"""Nearest neighbours by collision counting over sorted projections.

Vectors lie on a sphere after a further component fills each up to the largest
norm, so that the largest inner product is the smallest distance. Each of many
random projections sorts a block of vectors once. A query opens a window around
its own projection in every array and widens all of them step by step (virtual
rehashing). A vector that has fallen into enough windows is verified by its
exact inner product.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from labmart.llm.common import Work, read

#: Projections, and the share of them whose windows a vector must fall into.
PROJECTIONS, COLLISIONS = 128, 0.65
#: Half widths of the windows in units of the unit sphere's projections, from first to last.
FIRST, GROWTH = 0.35, 1.2
#: A block's search for a query ends once so many vectors, beyond k, are verified: a share of
#: the block's n, and a multiple of the root of n, which keeps small blocks as sure as large ones.
VERIFIED, VERIFIED_ROOT = 0.05, 8
#: Vectors of a block of the table, and queries handled with it at a time.
BLOCK, QUERY_BLOCK = 8192, 2048
FOUND = "query_id bigint, vec_id bigint, score double"


def usable(column: Column) -> Column:
    """Not null, not empty, every component finite, and not all zero."""
    finite = F.forall(
        column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    )
    return column.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(column, lambda x: x != 0)


def inner_products(rows: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Sums in order of the components, so that equal vectors have equal scores anywhere."""
    total = np.zeros(len(rows))
    for j in range(rows.shape[1]):
        total += rows[:, j] * q[j]
    return total


class SortedProjections:
    """One block of vectors, each projection in ascending order."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, largest: float, seed: int = 17):
        self.ids, self.vectors, self.largest = ids, vectors, largest
        rest = np.sqrt(np.maximum(0, largest**2 - (vectors**2).sum(axis=1)))
        rng = np.random.default_rng(seed)
        self.lines = rng.standard_normal((vectors.shape[1] + 1, PROJECTIONS))
        placed = (np.column_stack([vectors, rest]) @ self.lines) / largest
        order = np.argsort(placed, axis=0, kind="stable").T.copy()
        self.sorted = np.take_along_axis(placed, order.T, axis=0).T.copy()
        #: Each vector's place in each array; a window is a range of places.
        self.place = np.empty(order.shape, np.uint16 if len(ids) <= 1 << 16 else np.uint32)
        np.put_along_axis(self.place, order, np.arange(len(ids), dtype=self.place.dtype)[None, :], axis=1)

    def _collisions(self, at: np.ndarray, width: np.ndarray) -> Iterator[np.ndarray]:
        """For each query the number of windows that each vector has fallen into."""
        kind = self.place.dtype
        left = np.column_stack([s.searchsorted(a - width) for s, a in zip(self.sorted, at.T)])
        right = np.column_stack([s.searchsorted(a + width, "right") for s, a in zip(self.sorted, at.T)])
        inside, hit = np.empty(self.place.shape, kind), np.empty(self.place.shape, bool)
        for a, b in zip(left, right):
            # Places before the window wrap round to large numbers; an empty window holds none.
            np.subtract(self.place, a.astype(kind)[:, None], out=inside)
            np.less_equal(inside, (np.maximum(b - a, 1) - 1).astype(kind)[:, None], out=hit)
            hit[b <= a] = False
            yield np.add.reduce(hit.view(np.uint8), axis=0, dtype=np.uint8)

    def _rounds(self, at: np.ndarray, widths: list[float], needed: int, enough: int, usual: int | None = None) -> np.ndarray:
        """The first of the widths at which each query has enough vectors; the last has all in every window."""
        low, high, tries = np.zeros(len(at), int), np.full(len(at), len(widths) - 1), 0
        while (open_ := np.flatnonzero(low < high)).size:
            below, above = low[open_], high[open_]
            middle = (below + above) // 2
            if usual is not None and tries < 2:
                beside = np.where(above == usual, usual - 1, usual + 1)
                middle = np.clip(beside if tries else usual, below, above - 1)
            counts = self._collisions(at[open_], np.take(widths, middle))
            done = np.array([np.count_nonzero(c >= needed) >= enough for c in counts])
            high[open_], low[open_] = np.where(done, middle, above), np.where(done, below, middle + 1)
            tries += 1
        return high

    def nearest(self, query_ids: np.ndarray, queries: np.ndarray, k: int):
        """(ids, scores) of the k best verified vectors for each query, ties to the smaller id.

        The windows of a query widen until enough vectors have the collisions
        needed. As no vector leaves a window, that width is found by bisection.
        """
        n = len(self.ids)
        # A query's own further component is zero, and its length does not matter.
        at = (queries / np.linalg.norm(queries, axis=1)[:, None]) @ self.lines[:-1]
        enough, needed = min(n, k + 1 + int(VERIFIED * n + VERIFIED_ROOT * math.sqrt(n))), math.ceil(COLLISIONS * PROJECTIONS)
        farthest = max(np.abs(self.sorted[:, i] - at).max() for i in (0, -1))
        widths = [FIRST]
        while widths[-1] <= farthest * GROWTH:
            widths.append(widths[-1] * GROWTH)
        # Widths are alike from query to query, so those of the first few are tried on the rest.
        few = self._rounds(at[:16], widths, needed, enough)
        usual = int(np.median(few)) if len(few) else 0
        rounds = np.concatenate([few, self._rounds(at[16:], widths, needed, enough, usual)])
        counts, room = self._collisions(at, np.take(widths, rounds)), np.empty_like(self.vectors)
        for query_id, q, met in zip(query_ids, queries, counts):
            near = np.flatnonzero(met >= needed)
            near = near[self.ids[near] != query_id]
            rows = np.take(self.vectors, near, axis=0, out=room[: len(near)], mode="clip")
            if len(near) > k:
                # Only those that rounding could bring among the k best are summed in order.
                about = rows @ q
                least = np.partition(about, -k)[-k] - 1e-9 * (self.largest * np.linalg.norm(q))
                if np.isfinite(about).all() and np.isfinite(least):
                    near, rows = near[about >= least], rows[about >= least]
            score = inner_products(rows, q)
            best = np.lexsort((self.ids[near], -score))[:k]
            yield self.ids[near][best], score[best]


def _search(k: int, largest: float):
    def run(key: tuple, block: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(block) or not len(queries):
            return pd.DataFrame(columns=["query_id", "vec_id", "score"])
        vectors = np.vstack(block["vector"].to_numpy()).astype(np.float64)
        index = SortedProjections(block["vec_id"].to_numpy(np.int64), vectors, largest)
        asked = queries["vec_id"].to_numpy(np.int64)
        found = list(index.nearest(asked, np.vstack(queries["vector"].to_numpy()), k))
        return pd.DataFrame(
            {
                "query_id": np.repeat(asked, [len(ids) for ids, _ in found]),
                "vec_id": np.concatenate([ids for ids, _ in found]),
                "score": np.concatenate([score for _, score in found]),
            }
        )

    return run


def nearest_neighbours(
    vectors: DataFrame,
    k: int = 20,
    every: int = 20,
    block: int = BLOCK,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` best found for each query.

    Queries are the rows whose vec_id is divisible by ``every``; candidates are
    all rows but those of the query's own id. The score is the inner product of
    the original vectors in double precision, ties go to the smaller vec_id.
    Vectors that are null, zero, or hold null or non-finite components take no
    part; neither do rows without vec_id. Repeated rows count as one; an empty
    table gives no rows. Vectors of one length are compared with each other.

    Rows are dealt by id hash to blocks of about ``block`` vectors, which every
    block of queries visits; a task holds one block of each. Each visit returns
    k rows for a query, of which the best are taken.
    """
    spark = vectors.sparkSession
    work = Work(spark, "nearest")
    rows = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector")
    ).where(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    kept = work.keep(rows.dropDuplicates(["vec_id", "vector"]).withColumn("width", F.size("vector")), "kept")
    squares = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
    queried = F.col("vec_id") % every == 0
    sizes = kept.agg(
        F.count("*").alias("n"), F.count_if(queried).alias("q"), F.sqrt(F.max(squares)).alias("largest")
    ).first()
    n_blocks = max(1, math.ceil(sizes["n"] / block))
    n_queries = max(1, math.ceil(sizes["q"] / query_block))
    own = F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)).cast("int").alias("block")
    asks = F.pmod(F.xxhash64(F.lit("q"), "vec_id"), F.lit(n_queries)).cast("int").alias("asked")
    every_query = F.explode(F.sequence(F.lit(0), F.lit(n_queries - 1))).alias("asked")
    every_block = F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block")
    table = kept.select("width", own, every_query, "vec_id", "vector").groupBy("width", "block", "asked")
    queries = (
        kept.where(queried).select("width", every_block, asks, "vec_id", "vector")
        .groupBy("width", "block", "asked")
    )
    found = work.keep(
        table.cogroup(queries).applyInPandas(_search(k, float(sizes["largest"] or 1.0)), FOUND), "found"
    )
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )


def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(read(spark, sf_dir, "embeddings"))
