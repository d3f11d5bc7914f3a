"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labmart.llm.common import Work

#: Links of a task that are followed together.
CHUNK = 1 << 18


def _followed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each node tied to the smallest that the links at hand lead to; same components, shorter ways."""
    above: dict[int, int] = {}

    def top(x: int) -> int:
        while (y := above.get(x, x)) != x:
            above[x] = x = above.get(y, y)
        return x

    def tied() -> pd.DataFrame:
        rows = [(u, top(u)) for u in list(above)]
        return pd.DataFrame([r for r in rows if r[0] != r[1]], columns=["u", "v"], dtype="int64")

    for batch in batches:
        for u, v in zip(batch["u"].tolist(), batch["v"].tolist()):
            u, v = top(u), top(v)
            above[max(u, v)] = min(u, v)
        if len(above) >= CHUNK:
            yield tied()
            above.clear()
    yield tied()


def _stars(links: DataFrame) -> bool:
    """Whether each node has one link down, to a node without any."""
    ends = links.select(F.explode(F.array(
        F.struct(F.col("u").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")),
        F.struct(F.col("v").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("up")),
    )).alias("e")).select("e.*")
    nodes = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return nodes.where("down + up > 1").isEmpty()


def connected(edges: DataFrame, work: Work) -> DataFrame:
    """(node, component) of all nodes that have a link; component is the smallest node.

    ``edges`` has the bigint columns ``a`` and ``b``. Each task first follows the
    links it holds. Every round then ties all larger neighbours of a node to its
    smallest one, then all smaller ones, until all that is left are stars; the
    number of rounds grows with the logarithm of the longest chain. Each round is
    written to the shared folder. Minima are taken by a partial aggregate and
    joined back from a written table, so that a hub with very many links is split
    like any skewed join.
    """
    run, n = uuid.uuid4().hex[:8], 0

    def kept(links: DataFrame) -> DataFrame:
        ways = links.where("u <> v").mapInPandas(_followed, "u bigint, v bigint")
        return work.keep(ways.distinct(), f"links_{run}_{n}")

    now = kept(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")))
    while not _stars(now):
        n, step = n + 1, f"{run}_{n + 1}"
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = work.keep(
            both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), f"large_{step}"
        )
        large = work.keep(
            both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct(),
            f"links_{step}a",
        )
        least = work.keep(large.groupBy("u").agg(F.min("v").alias("m")), f"small_{step}")
        joined = large.join(least, "u").select(
            F.explode(
                F.array(
                    F.struct(F.col("u"), F.col("m").alias("v")),
                    F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                )
            ).alias("e")
        )
        now = kept(joined.select("e.u", "e.v"))
        work.drop(f"large_{step}", f"small_{step}", f"links_{step}a", f"links_{run}_{n - 1}")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        roots.distinct()
    )
