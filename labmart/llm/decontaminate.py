"""Benchmark passages in documents, by edit distance over words.

The CGK embedding walks through a word sequence with shared random bits and
writes the word at its pointer at each step; sequences within a small edit
distance get strings within a small Hamming distance. Sampled positions of
repeated embeddings are the keys under which windows of an item's size meet
the item; what meets is verified by the exact edit distance.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labmart.llm.common import read

SIMILARITY, RECALL = 0.8, 0.97
#: Shorter items are reported where they occur, but do not make a document contaminated.
LEAST_WORDS = 5
#: Sampled positions of a key, and keys of each embedding.
POSITIONS, KEYS = 4, 16
#: Items held by a task at a time; a larger benchmark is searched in slabs.
SLAB = 20_000
#: Edited copies of the items of one length, at least, by which recall is measured.
COPIES = 64
#: Embeddings of the items of one length; what they do not reach is searched by common pairs.
ROUNDS = 32
#: Characters of text, and windows, looked at together.
BATCH, WINDOWS = 1 << 21, 1 << 15
_WORD = re.compile(r"\w+")
HITS = T.ArrayType(
    T.StructType(
        [
            T.StructField("item", T.IntegerType()),
            T.StructField("start_word", T.LongType()),
            T.StructField("n_words", T.LongType()),
            T.StructField("distance", T.LongType()),
        ]
    )
)


def passage_words(text: str | None) -> list[str]:
    """Runs of letters, digits and underscores, in lower case."""
    return _WORD.findall(text.lower()) if text else []


def substring_distance(item: np.ndarray, region: np.ndarray) -> int:
    """Least edit distance between the item and any stretch of the region."""
    steps = np.arange(len(region) + 1)
    row = np.zeros(len(region) + 1, np.int64)
    for i, word in enumerate(item, 1):
        best = np.minimum(row[:-1] + (region != word), row[1:] + 1)
        row = np.concatenate([[i], best])
        row = np.minimum.accumulate(row - steps) + steps
    return int(row.min())


def embed(words: np.ndarray, starts: np.ndarray, n: int, bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Embedded symbols of the windows of n words, at the given ascending steps only.

    ``bits[step]`` are a factor and a summand that hash a word to one bit, which
    says whether the pointer moves on; past its end a window reads the symbol
    -1, which moves nothing.
    """
    pointer = np.zeros(len(starts), np.int64)
    out = np.empty((len(starts), len(at)), np.int64)
    wanted = {int(s): j for j, s in enumerate(at)}
    for step in range(int(at[-1]) + 1):
        inside = pointer < n
        symbol = words[np.minimum(starts + pointer, len(words) - 1)]
        if step in wanted:
            out[:, wanted[step]] = np.where(inside, symbol, -1)
        factor, summand = bits[step]
        pointer += ((symbol.view(np.uint64) * factor + summand) >> np.uint64(63)).view(np.int64) & inside
    return out


def _edited(item: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    words = list(item)
    for kind in rng.integers(0, 3, k):
        place = int(rng.integers(0, max(1, len(words))))
        if kind == 0 and words:
            words[place] = 0
        elif kind == 1:
            words.insert(place, 0)
        elif len(words) > 1:
            del words[place]
    return np.array([*words, *[0] * len(item)])[: len(item)]


class _Size:
    """All items of one length: how many edits they may have, and their keys.

    An item that allows no edit has its words as its only key. Otherwise rounds
    are added until the share ``recall`` of edited copies, of each item equally
    many, has met its item. If ``ROUNDS`` rounds do not reach that, the items that
    share a pair of words with a window are candidates too.
    """

    def __init__(self, n: int, items: list[tuple[int, np.ndarray]], similarity: float, recall: float):
        self.n, self.items, self.edits = n, items, int((1 - similarity) * n + 1e-9)
        # An edit breaks two neighbouring pairs of words at most.
        self.pairs = min(n - 1, max(1, n - 1 - 2 * self.edits))
        rng = np.random.default_rng(n)
        flat, starts = np.concatenate([x for _, x in items]), np.arange(len(items)) * n
        self.rounds, self.sharing = [], {}
        if not self.edits:
            self.whole = self._table(flat.reshape(-1, n))
            return
        of = np.tile(np.arange(len(items)), -(-COPIES // len(items)))
        edited = np.concatenate([_edited(items[i][1], self.edits, rng) for i in of])
        met = np.zeros(len(of), bool)
        while met.mean() < recall and len(self.rounds) < ROUNDS:
            # The pointer moves every other step, so later steps often lie past the window's end.
            length = n + n // 2
            bits = rng.integers(0, 1 << 64, (length, 2), np.uint64) | np.array([1, 0], np.uint64)
            samples = [np.sort(rng.choice(length, POSITIONS, replace=False)) for _ in range(KEYS)]
            steps = np.unique(np.concatenate(samples))
            places = [np.searchsorted(steps, s) for s in samples]
            own = embed(flat, starts, n, bits, steps)
            near = embed(edited, np.arange(len(of)) * n, n, bits, steps)
            for p in places:
                met |= (own[of][:, p] == near[:, p]).all(axis=1)
            self.rounds.append((bits, steps, places, [self._table(own[:, p]) for p in places]))
        if met.mean() < recall:
            for i, (_, x) in enumerate(items):
                for pair in set(zip(x[:-1].tolist(), x[1:].tolist())):
                    self.sharing.setdefault(pair, []).append(i)

    @staticmethod
    def _mix(symbols: np.ndarray) -> np.ndarray:
        key = np.zeros(len(symbols), np.uint64)
        for column in symbols.T:
            key = (key ^ column.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
        return key

    def _table(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = self._mix(symbols)
        order = np.argsort(key, kind="stable")
        return key[order], order

    @staticmethod
    def _met(part: np.ndarray, symbols: np.ndarray, table) -> list[tuple[int, int]]:
        keys, order = table
        mixed = _Size._mix(symbols)
        first = np.searchsorted(keys, mixed, "left")
        at = np.flatnonzero(keys[np.minimum(first, len(keys) - 1)] == mixed)
        last = np.searchsorted(keys, mixed[at], "right")
        return [
            (int(part[w]), int(i)) for w, end in zip(at, last) for i in order[first[w] : end]
        ]

    def candidates(self, words: np.ndarray, starts: np.ndarray) -> set[tuple[int, int]]:
        """(window start, place of the item) that share a key; equal windows are embedded once."""
        found = set()
        factors = np.random.default_rng(0).integers(0, 1 << 64, self.n, np.uint64) | np.uint64(1)
        for a in range(0, len(starts), WINDOWS):
            part = starts[a : a + WINDOWS]
            alike = np.zeros(len(part), np.uint64)
            for j, factor in enumerate(factors):
                alike += (words[part + j].view(np.uint64) + np.uint64(j + 1)) * factor
            _, first, which = np.unique(alike, return_index=True, return_inverse=True)
            met = self._candidates(words, part[first])
            members = np.split(np.argsort(which, kind="stable"), np.cumsum(np.bincount(which))[:-1])
            place = {int(w): k for k, w in enumerate(part[first])}
            found.update((int(part[w]), i) for start, i in met for w in members[place[start]])
        return found

    def _candidates(self, words: np.ndarray, part: np.ndarray) -> set[tuple[int, int]]:
        found = set()
        if not self.edits:
            found.update(self._met(part, words[part[:, None] + np.arange(self.n)], self.whole))
        for bits, steps, places, tables in self.rounds:
            symbols = embed(words, part, self.n, bits, steps)
            for p, table in zip(places, tables):
                found.update(self._met(part, symbols[:, p], table))
        if self.sharing:
            for w in part.tolist():
                own = words[w : w + self.n].tolist()
                for pair in set(zip(own, own[1:])):
                    found.update((w, i) for i in self.sharing.get(pair, ()))
        return found


class PassageIndex:
    """Items (number, text) to be found in texts at a similarity of at least ``similarity``.

    Windows are compared only if they hold as many neighbouring pairs of words of
    the items of their size as the edits leave, which each true window does.
    """

    def __init__(
        self,
        items: list[tuple[int, str]],
        similarity: float = SIMILARITY,
        recall: float = RECALL,
        least_words: int = 1,
    ):
        split = [(i, w) for i, t in items if len(w := passage_words(t)) >= max(1, least_words)]
        self.numbers: dict[str, int] = {}
        coded = [(i, np.array([self.numbers.setdefault(x, len(self.numbers) + 1) for x in w])) for i, w in split]
        n_words = len(self.numbers) + 1
        self.n_words = n_words
        self.pairs = np.unique(np.concatenate([np.zeros(0, np.int64), *(self._pairs(x) for _, x in coded)]))
        by_size: dict[int, list] = {}
        for i, x in coded:
            by_size.setdefault(len(x), []).append((i, x))
        self.sizes = [
            _Size(n, own, similarity, recall) for n, own in sorted(by_size.items())
        ]
        #: For each size the numbers of the pairs of its items.
        self.own = [
            np.unique(np.searchsorted(self.pairs, np.concatenate([self._pairs(x) for _, x in size.items])))
            for size in self.sizes
        ]
        self.gap = np.zeros(max(by_size, default=0) + 1, np.int64)

    def _pairs(self, words: np.ndarray) -> np.ndarray:
        return words[:-1] * self.n_words + words[1:]

    @staticmethod
    def _distance(item: np.ndarray, region: np.ndarray, edits: int, seen: dict) -> int:
        """``substring_distance``, or more than ``edits`` if so many of the item's words are missing."""
        key = (item.tobytes(), region.tobytes())
        if key not in seen:
            missing = len(item) - np.count_nonzero(np.isin(item, region))
            seen[key] = missing if missing > edits else substring_distance(item, region)
        return seen[key]

    @staticmethod
    def _dense(at: np.ndarray, n: int, least: int, n_words: int) -> np.ndarray:
        """Starts of the windows of n words that hold ``least`` of the pairs at the ascending places."""
        if len(at) < least:
            return np.zeros(0, np.int64)
        first, last = at[: len(at) - least + 1], at[least - 1 :]
        low, high = np.maximum(last - (n - 2), 0), np.minimum(first, n_words - n)
        low, high = low[low <= high], high[low <= high]
        size = high - low + 1
        before = np.cumsum(size) - size
        return np.unique(np.arange(size.sum()) - np.repeat(before - low, size))

    def find(self, texts: list[str | None]) -> list[list[tuple[int, int, int, int]]]:
        """For each text the items in it: number, first word, words, edit distance; the best place each."""
        out: list[dict[int, tuple]] = [{} for _ in texts]
        if not self.sizes:
            return [[] for _ in texts]
        get, parts, bounds = self.numbers.get, [], [0]
        for text in texts:
            own = np.array([get(w, 0) for w in passage_words(text)], np.int64)
            parts += [own, self.gap]
            bounds.append(bounds[-1] + len(own) + len(self.gap))
        words, bounds = np.concatenate(parts), np.array(bounds)
        paired = np.flatnonzero((words[:-1] > 0) & (words[1:] > 0))
        keys = self._pairs(words)[paired]
        number = np.zeros(0, np.int64)
        if len(self.pairs):
            number = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
            known = self.pairs[number] == keys
            paired, number = paired[known], number[known]
        for size, own in zip(self.sizes, self.own):
            seen: dict[tuple[bytes, bytes], int] = {}
            if len(words) < size.n:
                continue
            if size.n == 1:
                starts = np.flatnonzero(words > 0)
            else:
                wanted = np.zeros(len(self.pairs), bool)
                wanted[own] = True
                starts = self._dense(paired[wanted[number]], size.n, size.pairs, len(words))
            if not len(starts):
                continue
            for start, place in sorted(size.candidates(words, starts)):
                item, item_words = size.items[place]
                doc = int(np.searchsorted(bounds, start, "right")) - 1
                old = out[doc].get(item)
                if old and (old[3] == 0 or abs(old[1] + bounds[doc] - start) <= size.edits and old[4] == start):
                    continue
                if (words[start : start + size.n] == item_words).all():
                    distance = 0
                else:
                    a = max(int(bounds[doc]), start - size.edits)
                    b = min(int(bounds[doc + 1]) - len(self.gap), start + size.n + size.edits)
                    distance = self._distance(item_words, words[a:b], size.edits, seen)
                if distance <= size.edits and (old is None or distance < old[3]):
                    out[doc][item] = (item, start - int(bounds[doc]), size.n, distance, start)
        return [[h[:4] for _, h in sorted(x.items())] for x in out]


def passages_in(index: PassageIndex, text: Column) -> Column:
    """Array of the hits in each text."""

    @F.pandas_udf(HITS)
    def run(texts: pd.Series) -> pd.Series:
        found, own, size = [], [], 0
        for text in texts:
            own.append(text)
            size += len(text or "")
            if size >= BATCH:
                found += index.find(own)
                own, size = [], 0
        found += index.find(own) if own else []
        keys = ("item", "start_word", "n_words", "distance")
        return pd.Series([[dict(zip(keys, h)) for h in x] for x in found], dtype=object)

    return run(text)


def _slabs(benchmark: DataFrame, slab: int) -> list[list[tuple]]:
    """The benchmark's items in lists of at most ``slab`` rows, fetched one by one."""
    items = benchmark.select("item_id", "text").where("text IS NOT NULL")
    n = max(1, math.ceil(items.count() / slab))
    number = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    for k in range(n):
        rows = items.where(number == k).orderBy("item_id", "text").collect()
        yield [(r["item_id"], r["text"]) for r in rows]


def benchmark_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    similarity: float = SIMILARITY,
    recall: float = RECALL,
    slab: int = SLAB,
    least_words: int = 1,
) -> DataFrame:
    """doc_id, item_id, start_word, n_words, distance and similarity of each item in each document.

    Words are runs of letters and digits in lower case; an item is in a text if
    a stretch of it is within ``(1 - similarity) * words of the item`` edits of
    words. Of each item the best place is given. Unaltered passages are always
    found, altered ones with at least the ``recall`` given, as measured on
    edited copies of the items. Items of up to four words allow no edit. Items of
    fewer than ``least_words`` words, wordless items, null and empty texts have no
    match; repeated documents and items match each by itself.
    """
    out = None
    for items in _slabs(benchmark, slab):
        index = PassageIndex([(i, t) for i, (_, t) in enumerate(items)], similarity, recall, least_words)
        ids = F.array(*[F.lit(i) for i, _ in items]) if items else F.lit(None)
        hits = docs.select("doc_id", F.explode(passages_in(index, F.col("text"))).alias("h")).select(
            "doc_id", ids[F.col("h.item")].cast(benchmark.schema["item_id"].dataType).alias("item_id")
            if items else F.lit(None).cast(benchmark.schema["item_id"].dataType).alias("item_id"),
            "h.start_word", "h.n_words", "h.distance",
            (1 - F.col("h.distance") / F.col("h.n_words")).alias("similarity"),
        )
        out = hits if out is None else out.unionByName(hits)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without those that hold a benchmark passage; columns stay as they are.

    Items of fewer than ``least_words`` words, five unless given, are no passages.
    """
    slab, options = options.pop("slab", SLAB), {"least_words": LEAST_WORDS} | options
    for items in _slabs(benchmark, slab):
        index = PassageIndex([(i, t) for i, (_, t) in enumerate(items)], **options)
        docs = docs.where(F.size(passages_in(index, F.col("text"))) == 0)
    return docs


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark_passages(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
