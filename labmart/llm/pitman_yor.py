"""A hierarchical Pitman-Yor language model over the words of a corpus.

A word is drawn in the restaurant of its context, the word before it. All these
restaurants share one parent over all words, whose base is even over the known
words but for the unknown word. Texts of unseen words so have a proper
probability, in which all unseen words are one.

Seats are sampled by Gibbs sweeps: all customers of a word leave and are seated
again, given all other words. Words are spread over buckets by hash, so a
sweep is one pass over stored buckets; what the words of a context share, its
customers and tables, is summed by the hash of the context and returned to the
buckets that need it. Predictions are averaged over the sweeps.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labmart.llm.common import Work, fold, read, words_of

#: The token after the last word; no word holds a line feed.
END = b"\n"
#: Tokens of which a task holds the numbers at a time (a longer text is held whole), with at
#: most a quarter as many distinct words.
CHUNK_TOKENS = 1 << 20
#: Gibbs sweeps whose predictions are averaged; the first seating is the burn-in.
SWEEPS = 3
STRENGTH = 1.0
#: The context of a text's first word.
START = 0
# Keys of the scalars: tokens, types, those seen once, customers and tables of the root,
# and for cells of the two levels how many have one and two customers.
ALL, TYPES, SINGLE, ROOT_CUSTOMERS, ROOT_TABLES = range(5)
ONCE, TWICE = (10, 11), (20, 21)
#: A bucket's sums of a sweep: those of its contexts, packed by part, and scalars.
SEATS = "bucket int, part int, data binary, key int, n bigint"


def pack(*values) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=3).compress(pickle.dumps(values, protocol=5))


def unpack(data: bytes) -> tuple:
    import zstandard

    return pickle.loads(zstandard.ZstdDecompressor().decompress(data))


def _planes(x: np.ndarray) -> np.ndarray:
    """Bytes of the numbers, all lowest ones first, which compress better."""
    return x.view(np.uint8).reshape(len(x), x.itemsize).T.copy()


def _unplanes(x: np.ndarray, kind) -> np.ndarray:
    return x.T.copy().reshape(-1).view(kind)


def discount(once: int, twice: int) -> float:
    """Share of a customer held back, from how many cells have one and two customers."""
    return min(0.95, max(0.05, once / (once + 2 * twice))) if once else 0.5


def seat(n: np.ndarray, new: np.ndarray, d: float, rng: np.random.Generator) -> np.ndarray:
    """Tables that n customers of one dish open; ``new`` is the weight of a new table.

    Customers come one by one up to 16, then in groups of an eighth of those
    seated, within which the chance of a new table is taken as constant.
    """
    seated = np.minimum(n, 1).astype(np.float64)
    tables, new = seated.copy(), np.broadcast_to(new, n.shape)
    left = np.flatnonzero(n > 1)
    while len(left):
        i = seated[left]
        group = np.minimum(np.maximum(1, i // 8), n[left] - i)
        chance = new[left] / (i + (group - 1) / 2 - d * tables[left] + new[left])
        tables[left] += rng.binomial(group.astype(np.int64), np.clip(chance, 0, 1))
        seated[left] += group
        left = left[seated[left] < n[left]]
    return tables


def _chunks(chunk_tokens: int):
    def packed(part: int, number: int, numbers: dict, docs: list) -> pd.DataFrame:
        """One row: ids, folds and lengths of the chunk's texts, all their word numbers, hashes of the words."""
        hashes = np.array([xxhash.xxh64_intdigest(w) for w in numbers], np.uint64)
        words = np.concatenate([x for _, _, x in docs])
        # Numbers by falling frequency have many zero bytes.
        frequent = np.argsort(-np.bincount(words), kind="stable")
        rank = np.empty(len(hashes), np.uint32)
        rank[frequent] = np.arange(len(hashes), dtype=np.uint32)
        data = pack(
            [i for i, _, _ in docs], np.array([held for _, held, _ in docs]), np.array([len(x) for _, _, x in docs]),
            _planes(rank[words]), hashes[frequent],
        )
        return pd.DataFrame([((part << 32) | number, data)], columns=["chunk", "data"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, number = TaskContext.get().partitionId(), 0
        numbers, docs, size = {}, [], 0
        for batch in batches:
            for doc_id, held, text in zip(batch["doc_id"], batch["held_out"], batch["text"]):
                words = words_of(text)
                words.append(END)
                ids = [numbers.setdefault(w, len(numbers)) for w in words]
                docs.append((doc_id, bool(held), np.array(ids, np.uint32)))
                size += len(ids)
                if size >= chunk_tokens or len(numbers) >= max(1, chunk_tokens // 4):
                    yield packed(part, number, numbers, docs)
                    numbers, docs, size, number = {}, [], 0, number + 1
        if docs:
            yield packed(part, number, numbers, docs)

    return run


class Chunk:
    """A chunk's distinct cells in ascending order, the cell of each token, and the cells of each bucket."""

    def __init__(self, data: bytes, buckets: int):
        self.ids, self.held, self.lengths, words, self.hashes = unpack(data)
        flat = _unplanes(words, np.uint32).astype(np.int64)
        # Contexts are numbered after the words, from 1; 0 is the start.
        before = np.concatenate([[0], flat[:-1] + 1])
        before[np.cumsum(self.lengths)[:-1]] = 0
        self.kinds = len(self.hashes) + 1
        self.cells, self.cell = np.unique(flat * self.kinds + before, return_inverse=True)
        bucket = (self.hashes[self.cells // self.kinds] % np.uint64(buckets)).astype(np.int64)
        self.order = np.argsort(bucket, kind="stable")
        self.cuts = np.searchsorted(bucket[self.order], np.arange(buckets + 1))


def _asked(buckets: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Each chunk's cells by bucket, with how often they occur in training."""
        for batch in batches:
            for chunk, data in zip(batch["chunk"], batch["data"]):
                c = Chunk(data, buckets)
                contexts = np.concatenate([np.array([START], np.uint64), c.hashes])
                n = np.bincount(c.cell[np.repeat(~c.held, c.lengths)], minlength=len(c.cells))
                out = []
                for k in np.flatnonzero(np.diff(c.cuts)):
                    own = c.order[c.cuts[k] : c.cuts[k + 1]]
                    used, word = np.unique(c.cells[own] // c.kinds, return_inverse=True)
                    met, place = np.unique(c.cells[own] % c.kinds, return_inverse=True)
                    data = pack(
                        c.hashes[used], np.diff(word, prepend=0).astype(np.uint8), contexts[met],
                        _planes(place.astype(np.uint32)), _planes(n[own].astype(np.uint32)),
                    )
                    out.append((chunk, int(k), data))
                yield pd.DataFrame(out, columns=["chunk", "bucket", "data"])

    return run


def _merge(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """All chunks' cells of one bucket's words with their counts, and where each chunk's are among them.

    Cells, words and contexts that are only asked for are there too, without customers.
    """
    parts = [unpack(x) for x in rows["data"]]
    kinds, words = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    contexts, places = np.unique(np.concatenate([p[2] for p in parts]), return_inverse=True)
    offset = np.cumsum([0, *(len(p[0]) for p in parts)])
    shift = np.cumsum([0, *(len(p[2]) for p in parts)])
    word = np.concatenate([words[np.cumsum(p[1], dtype=np.int64) + o] for p, o in zip(parts, offset)])
    context = np.concatenate([places[_unplanes(p[3], np.uint32) + o] for p, o in zip(parts, shift)])
    cells, at = np.unique(word * len(contexts) + context, return_inverse=True)
    n = np.bincount(at, np.concatenate([_unplanes(p[4], np.uint32) for p in parts]), len(cells))
    data = pack(
        len(kinds), contexts, np.diff(cells // len(contexts), prepend=0).astype(np.uint8),
        _planes((cells % len(contexts)).astype(np.uint32)), _planes(n.astype(np.uint64)),
    )
    pieces = np.split(at.astype(np.uint32), np.cumsum([p[4].shape[1] for p in parts])[:-1])
    return pd.DataFrame(
        {
            "bucket": key[0],
            "chunk": pd.array([None, *rows["chunk"]], "Int64"),
            "data": [data, *(pack(_planes(np.diff(x, prepend=np.uint32(0)))) for x in pieces)],
        }
    )


def _cells(data: bytes) -> tuple:
    """A bucket's number of words, hashes of its contexts, and word, context and customers of each cell."""
    kinds, contexts, word, context, n = unpack(data)
    return kinds, contexts, np.cumsum(word, dtype=np.int64), _unplanes(context, np.uint32).astype(np.int64), _unplanes(n, np.uint64).astype(np.int64)


def _by_part(contexts: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of contexts by part, and where each part begins and ends."""
    part = (contexts % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    return order, np.searchsorted(part[order], np.arange(buckets + 1))


def _counts(n: np.ndarray) -> np.ndarray:
    return _planes(n.astype(np.uint64))


def _seats(buckets: int, bucket: int, contexts, numbers: tuple, scalars: dict) -> pd.DataFrame:
    """Rows of ``SEATS``: numbers by context, sent to the context's part."""
    order, cuts = _by_part(contexts, buckets)
    rows = []
    for k in np.flatnonzero(np.diff(cuts)):
        own = order[cuts[k] : cuts[k + 1]]
        data = pack(*(x[own] if x is contexts else _counts(x[own]) for x in numbers))
        rows.append((bucket, int(k), data, None, None))
    rows += [(bucket, None, None, key, int(n)) for key, n in scalars.items()]
    frame = pd.DataFrame(rows, columns=["bucket", "part", "data", "key", "n"])
    return frame.astype({"part": "Int32", "key": "Int32", "n": "Int64"})


def _count(buckets: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The sums of the first seating, one table for each cell."""
        for batch in batches:
            for bucket, data in zip(batch["bucket"], batch["data"]):
                kinds, contexts, word, context, n = _cells(data)
                learnt, count = n > 0, np.bincount(word, n, kinds)
                types = (count > 0).sum()
                levels = n, np.bincount(word[learnt], minlength=kinds)
                scalars = {
                    ALL: n.sum(), TYPES: types, SINGLE: (count == 1).sum(),
                    ROOT_CUSTOMERS: learnt.sum(), ROOT_TABLES: types,
                    **{key: (x == 1).sum() for key, x in zip(ONCE, levels)},
                    **{key: (x == 2).sum() for key, x in zip(TWICE, levels)},
                }
                customers = np.bincount(context, n, len(contexts))
                tables = np.bincount(context[learnt], minlength=len(contexts))
                yield _seats(buckets, bucket, contexts, (contexts, customers, tables), scalars)

    return run


def _first_total(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Sums of a part's contexts over all buckets, returned to each bucket in its own order.

    ``at`` stays with the part: the places of a bucket's contexts among the part's, for the sweeps.
    """
    parts = [unpack(x) for x in rows["data"]]
    kinds, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    customers, tables = (
        np.bincount(at, np.concatenate([_unplanes(p[i], np.uint64) for p in parts]), len(kinds)) for i in (1, 2)
    )
    pieces = np.split(at.astype(np.uint32), np.cumsum([len(p[0]) for p in parts])[:-1])
    return pd.DataFrame(
        {
            "bucket": rows["bucket"], "part": key[0],
            "customers": [pack(_counts(customers[x])) for x in pieces],
            "data": [pack(_counts(tables[x])) for x in pieces],
            "at": [pack(_planes(np.diff(x, prepend=np.uint32(0)))) for x in pieces],
        }
    )


def _total(key: tuple, places: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
    """A sweep's sums of a part's contexts; each bucket names its contexts in the order of ``places``."""
    places, rows = places.sort_values("bucket"), rows.sort_values("bucket")
    pieces = [np.cumsum(_unplanes(unpack(x)[0], np.uint32), dtype=np.uint32) for x in places["at"]]
    tables = np.bincount(
        np.concatenate(pieces), np.concatenate([_unplanes(unpack(x)[0], np.uint64) for x in rows["data"]])
    )
    return pd.DataFrame(
        {"bucket": places["bucket"], "part": key[0], "data": [pack(_counts(tables[x])) for x in pieces]}
    )


def _scalars(seats: DataFrame) -> dict[int, int]:
    """The sums over all buckets, some ten numbers."""
    rows = seats.where("key IS NOT NULL").groupBy("key").agg(F.sum("n").alias("n")).collect()
    return {r["key"]: r["n"] for r in rows}


class Level:
    """Numbers of one restaurant kind: customers, tables, discount."""

    def __init__(self, customers, tables, d: float):
        self.d, self.new, self.all = d, STRENGTH + d * tables, STRENGTH + customers


class Totals:
    """What all words share: sizes, discounts and the root's totals after a sweep."""

    def __init__(self, first: dict[int, int], now: dict[int, int]):
        self.n, self.types = first.get(ALL, 0), first.get(TYPES, 0)
        self.d = [discount(first.get(a, 0), first.get(b, 0)) for a, b in zip(ONCE, TWICE)]
        self.root = Level(now.get(ROOT_CUSTOMERS, 0), now.get(ROOT_TABLES, 0), self.d[1])
        # Good-Turing: as likely as tokens of words seen once, over all contexts.
        unseen = first[SINGLE] / (np.prod(self.d) * self.types) if self.types else 1.0
        self.unknown = min(0.9, max(1 / (self.types + 1), unseen))
        self.known = (1 - self.unknown) / max(1, self.types)

    def fine(self, contexts: np.ndarray, customers: np.ndarray, rows: pd.DataFrame, buckets: int) -> Level:
        """The restaurants of a bucket's contexts, from the packed tables of all parts."""
        return Level(customers, _returned(contexts, rows["part"], rows["data"], buckets), self.d[0])


def _returned(contexts: np.ndarray, parts: pd.Series, data: pd.Series, buckets: int) -> np.ndarray:
    """What all parts returned, in the order of the contexts."""
    out = np.zeros(len(contexts))
    order, _ = _by_part(contexts, buckets)
    out[order] = np.concatenate([_unplanes(unpack(x)[0], np.uint64) for x in data.iloc[np.argsort(parts)]])
    return out


def _seated(kinds: int, word, context, n, totals: Totals, fine: Level, rng):
    """Tables of all cells of a bucket (none without customers), customers and tables of its words at the root."""
    root = totals.root
    tables = np.minimum(n, 1).astype(np.float64)
    n0 = np.bincount(word, tables, kinds)
    t0 = np.minimum(n0, 1)
    for _ in range(2):
        p0 = (n0 - root.d * t0 + root.new * totals.known) / root.all
        tables = seat(n, fine.new[context] * p0[word], fine.d, rng)
        n0 = np.bincount(word, tables, kinds)
        t0 = seat(n0, np.float64(root.new * totals.known), root.d, rng)
    return tables, n0, t0


def _sweep(totals: Totals, sweep: int, buckets: int):
    def run(key: tuple, model: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        kinds, contexts, word, context, n = _cells(model["data"].iloc[0])
        first, now = rows[rows["customers"].notna()], rows[rows["customers"].isna()]
        customers = _returned(contexts, first["part"], first["customers"], buckets)
        fine = totals.fine(contexts, customers, now if len(now) else first, buckets)
        rng = np.random.default_rng([sweep, int(key[0])])
        tables, _, t0 = _seated(kinds, word, context, n, totals, fine, rng)
        scalars = {ROOT_CUSTOMERS: tables.sum(), ROOT_TABLES: t0.sum()}
        by_context = np.bincount(context, tables, len(contexts))
        return _seats(buckets, int(key[0]), contexts, (by_context,), scalars)

    return run


def _answer(sweeps: list[Totals], buckets: int):
    """For the cells of each chunk: the word's count and the averaged log10 chance.

    A sweep's seats are those it had: the same numbers are drawn again.
    """

    def run(key: tuple, model: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        asked = model["chunk"].notna()
        kinds, contexts, word, context, n = _cells(model["data"][~asked].iloc[0])
        count = np.bincount(word, n, kinds).astype(np.uint64)
        first = rows[rows["customers"].notna()]
        customers = _returned(contexts, first["part"], first["customers"], buckets)
        fines = [t.fine(contexts, customers, rows[rows["sweep"] == s], buckets) for s, t in enumerate(sweeps)]
        mean = np.zeros(len(n))
        for s in range(1, len(sweeps)):
            rng = np.random.default_rng([s, int(key[0])])
            tables, n0, t0 = _seated(kinds, word, context, n, sweeps[s - 1], fines[s - 1], rng)
            root, fine = sweeps[s].root, fines[s]
            base = np.where(count > 0, sweeps[s].known, sweeps[s].unknown)
            p0 = (n0 - root.d * t0 + root.new * base) / root.all
            mean += (n - fine.d * tables + fine.new[context] * p0[word]) / fine.all[context]
        chance = np.log10(mean / (len(sweeps) - 1)).astype(np.float32)
        out = []
        for chunk, data in zip(model["chunk"][asked], model["data"][asked]):
            at = np.cumsum(_unplanes(unpack(data)[0], np.uint32), dtype=np.uint32)
            out.append((int(chunk), key[0], pack(_planes(count[word[at]]), _planes(chance[at]))))
        return pd.DataFrame(out, columns=["chunk", "bucket", "data"])

    return run


def _score(n: int, types: int, buckets: int):
    def run(key: tuple, texts: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        parts = [unpack(x) for x in answers.sort_values("bucket")["data"]]
        c = Chunk(texts["data"].iloc[0], buckets)
        count, chance = np.zeros(len(c.cells), np.int64), np.zeros(len(c.cells))
        count[c.order] = np.concatenate([_unplanes(p[0], np.uint64) for p in parts]).astype(np.int64)
        chance[c.order] = np.concatenate([_unplanes(p[1], np.float32) for p in parts])
        base = np.log10((count + 1) / (n + types + 1))
        out = []
        for doc_id, held, x in zip(c.ids, c.held, np.split(c.cell, np.cumsum(c.lengths)[:-1])):
            out.append((doc_id, bool(held), len(x), int((count[x] > 0).sum()), n, base[x].sum(), chance[x].sum()))
        return pd.DataFrame(out, columns=SCORE_COLUMNS)

    return run


SCORE_COLUMNS = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]


def score_language_model(
    docs: DataFrame, folds: int = 7, held: int = 2, chunk_tokens: int = CHUNK_TOKENS, sweeps: int = SWEEPS
) -> DataFrame:
    """Scores of all documents by a model learnt from those outside one fold.

    Columns: doc_id, held_out, n_tokens (words and one end), n_known (tokens
    seen in training), train_tokens, base_score (log10, add-one unigrams) and
    score (log10 probability under the model), perplexity (10 to the power of
    minus score per token). Null text is empty: the end alone. Repeated rows
    count as often as they occur; an empty table gives no rows.

    Texts are read once, into stored chunks of word numbers, from which the cells
    that go to the buckets are made anew; chunks and buckets of words exchange packed
    tables. Buckets and contexts do so in each sweep, but name the contexts and count
    their customers once.
    There are as many buckets as ``spark.sql.shuffle.partitions``. Words are
    told apart by 64-bit hashes.
    """
    spark = docs.sparkSession
    work = Work(spark, "hpylm")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(
        F.col("doc_id").cast("string").alias("doc_id"),
        (fold(F.col("doc_id"), folds) == held).alias("held_out"), "text",
    )
    chunks = work.keep(
        rows.mapInPandas(_chunks(chunk_tokens), "chunk bigint, data binary"), "chunks", bucket_by=(buckets, "chunk")
    )
    asked = chunks.mapInPandas(_asked(buckets), "chunk bigint, bucket int, data binary")
    cells = work.keep(
        asked.groupBy("bucket").applyInPandas(_merge, "bucket int, chunk bigint, data binary"), "cells", bucket_by=(buckets, "bucket")
    )

    model = cells.where("chunk IS NULL")
    seats = work.keep(model.mapInPandas(_count(buckets), SEATS), "seats0")
    first = _scalars(seats)
    moved = seats.where("part IS NOT NULL").groupBy("part").applyInPandas(
        _first_total, "bucket int, part int, customers binary, data binary, at binary"
    )
    kept = work.keep(moved, "totals0", bucket_by=(buckets, "part"))
    work.drop("seats0")
    places = kept.select("part", "bucket", "at")
    states, sums = [Totals(first, first)], [kept.drop("at").withColumn("sweep", F.lit(0))]
    for sweep in range(1, sweeps + 1):
        # The customers of contexts are those of the first seating.
        known = sums[0] if sweep == 1 else sums[0].drop("data").withColumn("data", F.lit(None).cast("binary")).unionByName(sums[-1])
        moved = model.groupBy("bucket").cogroup(known.groupBy("bucket")).applyInPandas(
            _sweep(states[-1], sweep, buckets), SEATS
        )
        seats = work.keep(moved, f"seats{sweep}")
        states.append(Totals(first, _scalars(seats)))
        moved = places.groupBy("part").cogroup(seats.where("part IS NOT NULL").groupBy("part")).applyInPandas(
            _total, "bucket int, part int, data binary"
        )
        kept = work.keep(moved, f"totals{sweep}")
        work.drop(f"seats{sweep}")
        sums.append(kept.withColumns({"customers": F.lit(None).cast("binary"), "sweep": F.lit(sweep)}))
    answers = cells.groupBy("bucket").cogroup(reduce(DataFrame.unionByName, sums).groupBy("bucket")).applyInPandas(
        _answer(states, buckets), "chunk bigint, bucket int, data binary"
    )
    scored = chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(
        _score(states[0].n, states[0].types, buckets),
        "doc_id string, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
        "base_score double, score double",
    )
    return scored.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType)).withColumn(
        "perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens"))
    )


def op8_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_language_model(read(spark, sf_dir, "documents"))
