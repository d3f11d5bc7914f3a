"""Document quality learned from preference pairs (Bradley-Terry)."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labmart.llm.common import Work, fold, read, words_of
from labmart.session import sql_settings

#: Preference pairs of each labelled row.
PAIRS = 2
#: Rows of the larger class in a block, whose rows are paired with each other; of the smaller at least.
BLOCK, LEAST = 4096, 64
#: Bits that tell texts without a label, which are not looked at.
FILTER_BITS = 1 << 24
#: Cells of a step towards the quantile, and rows of a cell that are fetched at most.
CELLS = 4096
BLOCKS = "block bigint, good binary, own binary, x binary"
#: Score at the chosen quantile; from here on a document counts as good.
THRESHOLD = 0.3
CHUNK = 1 << 20
FLOATS = T.ArrayType(T.FloatType())

#: Kinds of bytes: the members of each kind; what is left is other control, then non-ASCII.
KINDS = [
    b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ",
    b"\n\r\t\x0b\x0c", b".", b",", b"!", b"?:;", b"|", b"\"'`()[]{}", b"$%&#*@^~", b"-_/\\", b"<>=+",
]


def _kind_map() -> np.ndarray:
    table = np.full(256, len(KINDS), np.uint8)
    table[128:] = len(KINDS) + 1
    for k, members in enumerate(KINDS):
        table[list(members)] = k
    return table


KIND_MAP = _kind_map()
N_KINDS = len(KINDS) + 2


def features(text: str | None) -> np.ndarray:
    """Root shares of neighbouring kinds of bytes, and measures of length and repetition."""
    text = text or ""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    counts = np.zeros(N_KINDS * N_KINDS, np.int64)
    for i in range(0, len(data), CHUNK):
        kind = KIND_MAP[data[max(0, i - 1) : i + CHUNK]].astype(np.int64)
        counts += np.bincount(kind[:-1] * N_KINDS + kind[1:], minlength=len(counts))
    words, lines = words_of(text), text.split("\n")
    n = max(1, len(words))
    own = [
        math.log1p(len(data)), math.log1p(len(words)), len(set(words)) / n,
        len(set(lines)) / len(lines), math.log1p(len(lines)), min(50.0, len(data) / n) / 10,
    ]
    return np.concatenate([np.sqrt(counts / max(1, len(data) - 1)), own]).astype(np.float32)


@F.pandas_udf(FLOATS)
def features_udf(texts: pd.Series) -> pd.Series:
    return texts.map(features, na_action=None)


class PairwiseScore:
    """Worth of a document, linear in its features; 0.3 at the threshold. Unfitted, 0.5 for all."""

    fitted = False

    def fit(
        self, mean: np.ndarray, scale: np.ndarray, w: np.ndarray, cut: float
    ) -> PairwiseScore:
        self.fitted, self.mean, self.scale, self.w, self.cut = True, mean, scale, w, cut
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.fitted:
            return np.full(len(x), 0.5)
        raw = (x - self.mean) / self.scale @ self.w - self.cut
        return 1 / (1 + np.exp(-np.clip(raw + math.log(THRESHOLD / (1 - THRESHOLD)), -30, 30)))


def _labelled(docs: DataFrame, known: DataFrame) -> DataFrame:
    """doc_id, quality, features x and an even hash, mix, for each meeting of a document and a label.

    Texts stay where they are: a bitmap of the labelled ids' hashes, at most
    ``FILTER_BITS`` long, tells most documents without a label, and features are
    exchanged to meet the labels. Copies of an id have hashes of their own.
    """
    texts = docs.select("doc_id", "text")
    if texts.schema["doc_id"].dataType == known.schema["doc_id"].dataType:
        slot = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS)).alias("slot")
        bit = "CAST(slot & 63 AS INT)"
        bitmap = known.select(slot).groupBy(F.shiftright("slot", 6).alias("word")).agg(
            F.bit_or(F.expr(f"shiftleft(1L, {bit})")).alias("bits")
        )
        texts = texts.select("*", slot).join(F.broadcast(bitmap), F.shiftright("slot", 6) == F.col("word"))
        texts = texts.where(F.expr(f"bit_get(bits, {bit})") == 1)
    met = texts.select("doc_id", features_udf("text").alias("x")).join(known.hint("shuffle_hash"), "doc_id")
    copy = F.row_number().over(Window.partitionBy("doc_id").orderBy("quality", F.xxhash64("x")))
    return met.select("doc_id", "quality", "x", F.xxhash64("doc_id", copy).alias("mix"))


def _pack(rows: pd.DataFrame) -> pd.DataFrame:
    """The rows of a block as one row of binaries, in the order of the ids."""
    rows = rows.sort_values(["doc_id", "quality", "mix"], kind="stable")
    return pd.DataFrame({
        "block": [rows["block"].iloc[0]],
        "good": [(rows["quality"].to_numpy() == 1).tobytes()],
        "own": [rows["own"].to_numpy(bool).tobytes()],
        "x": [np.vstack(rows["x"].to_list()).astype(np.float32).tobytes()],
    })


def _dealt(labelled: DataFrame, rows: dict[int, int]) -> DataFrame:
    """``BLOCKS`` that hold every row once as their own, dealt by hash.

    Where a class is too small for ``LEAST`` rows in each block, its rows are also
    lent to other blocks, as partners only.
    """
    blocks = -(-max(rows.values()) // BLOCK)
    shares = {c: min(blocks, max(1, rows[c] // LEAST)) for c in (0, 1)}
    share = F.when(F.col("quality") == 0, F.lit(shares[0])).otherwise(F.lit(shares[1])).cast("bigint")
    home = F.pmod(F.col("mix"), share)
    dealt = labelled.select(
        "*", home.alias("home"), F.explode(F.sequence(home, F.lit(blocks - 1).cast("bigint"), share)).alias("block")
    ).select("block", (F.col("home") == F.col("block")).alias("own"), "doc_id", "quality", "mix", "x")
    partitions = int(labelled.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartition(min(blocks, partitions), "block").groupBy("block").applyInPandas(_pack, BLOCKS)


def _unpacked(row) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    good, own = np.frombuffer(row.good, bool), np.frombuffer(row.own, bool)
    return np.frombuffer(row.x, np.float32).reshape(len(good), -1), good, own


def pairs(good: np.ndarray, own: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Better and worse row of each pair: own rows meet ``PAIRS`` rows of the other class."""
    rng, up, down = np.random.default_rng(seed), np.flatnonzero(good), np.flatnonzero(~good)
    if not (len(up) and len(down)):
        return up[:0], down[:0]
    own_up, own_down = np.flatnonzero(good & own), np.flatnonzero(~good & own)
    better = np.concatenate([np.repeat(own_up, PAIRS), rng.choice(up, PAIRS * len(own_down))])
    worse = np.concatenate([rng.choice(down, PAIRS * len(own_up)), np.repeat(own_down, PAIRS)])
    return better, worse


def _sums(blocks: DataFrame, of) -> np.ndarray:
    """Sum over all blocks of the vector ``of(block, x, good, own)``, added up in the tasks first."""

    def run(batches):
        total = 0.0
        for batch in batches:
            for row in batch.itertuples():
                total = total + of(row.block, *_unpacked(row))
        if np.ndim(total):
            yield pd.DataFrame({"v": [total]})

    each = blocks.mapInPandas(run, "v array<double>").select(F.posexplode("v").alias("i", "v"))
    with sql_settings(blocks.sparkSession, execution__arrow__maxRecordsPerBatch="1"):
        found = each.groupBy("i").agg(F.sum("v").alias("v")).toArrow()
    sums = np.zeros(found.num_rows)
    sums[found["i"].to_numpy()] = found["v"].to_numpy()
    return sums


def _weights(blocks: DataFrame, mean: np.ndarray, scale: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Least log loss of the differences of all pairs, by Newton steps with a small ridge."""
    k = len(mean)
    upper, w = np.triu_indices(k), np.zeros(k)
    ridge = 1e-3 * PAIRS * n * np.eye(k)
    for _ in range(6):

        def step(block, x, good, own, w=w):
            z, (better, worse) = (x - mean) / scale, pairs(good, own, seed + block)
            gram, slope = np.zeros((k, k)), np.zeros(k)
            for i in range(0, len(better), 4096):
                d = (z[better[i : i + 4096]] - z[worse[i : i + 4096]]).astype(np.float64)
                p = 1 / (1 + np.exp(-np.clip(d @ w, -30, 30)))
                gram += (d * (p * (1 - p))[:, None]).T @ d
                slope += d.T @ (1 - p)
            return np.concatenate([gram[np.triu_indices(k)], slope])

        sums, gram = _sums(blocks, step), np.zeros((k, k))
        gram[upper] = sums[:-k]
        gram = gram + np.triu(gram, 1).T + ridge
        w = w + np.linalg.solve(gram, sums[-k:] - ridge @ w)
    return w


def weighted_quantile(rows: DataFrame, weight: dict[bool, float], q: float) -> float:
    """Value at ``q`` of the (raw, good) ``rows``, each in the middle of the weight of its class.

    Each step cuts the cell that holds it in ``CELLS`` and fetches their counts only.
    """
    first, last = rows.agg(F.min("raw"), F.max("raw")).first()
    low, high, below, outer = first, last, 0.0, [first, last]
    while True:
        here, part = rows.where(F.col("raw").between(low, high)), (high - low) / CELLS
        cell = F.least(F.floor((F.col("raw") - low) / part), F.lit(CELLS - 1)) if part else F.lit(0)
        cells = here.groupBy(cell.alias("cell")).agg(
            F.sum(F.col("good").cast("bigint")).alias("up"), F.count(F.lit(1)).alias("n"),
            F.min("raw").alias("low"), F.max("raw").alias("high"),
        ).orderBy("cell").collect()
        mass = np.array([weight[True] * r["up"] + weight[False] * (r["n"] - r["up"]) for r in cells])
        ends = below + np.cumsum(mass)
        at = min(int(np.searchsorted(ends, q)), len(cells) - 1)
        if at:
            outer[0] = cells[at - 1]["high"]
        if at + 1 < len(cells):
            outer[1] = cells[at + 1]["low"]
        below = float(ends[at] - mass[at])
        low, high = cells[at]["low"], cells[at]["high"]
        if low == high or not part or cells[at]["n"] <= CELLS:
            break
    # The neighbours outside the cell count too; equal values are one row a class.
    near = rows.where(F.col("raw").between(*outer)).where(
        F.col("raw").between(low, high) | F.col("raw").isin(outer)
    ).groupBy("raw", "good").count().orderBy("raw", "good").collect()
    mass = [weight[r["good"]] * r["count"] for r in near]
    ends = np.cumsum(mass) + below - sum(m for r, m in zip(near, mass) if r["raw"] < low)
    half = [weight[r["good"]] / 2 for r in near]
    places = np.array([(e - m + h, e - h) for e, m, h in zip(ends, mass, half)]).ravel()
    return float(np.interp(q, places, np.repeat([r["raw"] for r in near], 2)))


def train_quality(docs: DataFrame, labels: DataFrame, folds: int = 5, seed: int = 11) -> PairwiseScore:
    """Fit on all labelled documents outside fold 0.

    A label without a document, or null, teaches nothing. Each labelled row meets
    ``PAIRS`` rows of the other class in its block. The threshold is the quantile
    of the scores at the share of label 0 among all labels, each class weighted by
    its share. Features are stored in blocks, whose sums alone reach the driver.
    """
    known = labels.where(fold(F.col("doc_id"), folds) != 0).where("quality IN (0, 1)").select(
        "doc_id", F.col("quality").cast("int").alias("quality")
    ).where("doc_id IS NOT NULL")
    share = {r["quality"]: r["count"] for r in known.groupBy("quality").count().collect()}
    if len(share) < 2:
        return PairwiseScore()
    work = Work(docs.sparkSession, "quality")
    labelled = work.keep(_labelled(docs, known), "labelled")
    rows = {r["quality"]: r["count"] for r in labelled.groupBy("quality").count().collect()}
    if len(rows) < 2:
        work.drop("labelled")
        return PairwiseScore()
    blocks, n = work.keep(_dealt(labelled, rows), "blocks"), sum(rows.values())
    work.drop("labelled")
    mean = _sums(blocks, lambda block, x, good, own: x[own].sum(axis=0, dtype=np.float64)) / n
    spread = _sums(blocks, lambda block, x, good, own: ((x[own] - mean) ** 2).sum(axis=0)) / n
    mean, scale = mean.astype(np.float32), (np.sqrt(spread) + 1e-3).astype(np.float32)
    w = _weights(blocks, mean, scale, n, seed)

    def worth(batches):
        for batch in batches:
            for row in batch.itertuples():
                x, good, own = _unpacked(row)
                yield pd.DataFrame({"raw": ((x - mean) / scale @ w)[own], "good": good[own]})

    with sql_settings(docs.sparkSession, execution__arrow__maxRecordsPerBatch="1"):
        raws = work.keep(blocks.mapInPandas(worth, "raw double, good boolean"), "raws")
    bad = share[0] / sum(share.values())
    cut = weighted_quantile(raws, {True: (1 - bad) / rows[1], False: bad / rows[0]}, bad)
    work.drop("blocks", "raws")
    return PairwiseScore().fit(mean, scale, w, cut)


def quality_of(model: PairwiseScore, text: Column) -> Column:
    @F.pandas_udf(T.DoubleType())
    def run(texts: pd.Series) -> pd.Series:
        if not len(texts):
            return pd.Series([], dtype=float)
        return pd.Series(model.score(np.vstack([features(t) for t in texts])))

    return run(text)


def score_quality(docs: DataFrame, labels: DataFrame, folds: int = 5) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from 0.3 on) of every document.

    Scores depend on the text alone; null counts as empty. Without labels of
    both classes every score is 0.5. Fold 0 of crc32(doc_id as text) teaches
    nothing; a null doc_id counts as empty text there. Repeated rows and labels
    count as often as they occur; other columns are ignored.
    """
    model = train_quality(docs, labels, folds)
    out = fold(F.col("doc_id"), folds) == 0
    found = docs.select("doc_id", out.alias("held_out"), quality_of(model, F.col("text")).alias("score"))
    return found.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, folds: int = 5) -> DataFrame:
    """``docs`` whose score is at least 0.3."""
    model = train_quality(docs, labels, folds)
    return docs.where(quality_of(model, F.col("text")) >= THRESHOLD)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
