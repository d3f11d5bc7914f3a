"""Language identification by error-correcting output codes over byte n-grams."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labmart.llm.common import fold, read

#: Hash buckets of the n-grams, as bits, and the n-gram lengths in bytes.
BUCKET_BITS, ORDERS = 14, (1, 2, 3)
#: Bytes taken at a time, so that long texts need no more memory.
CHUNK = 1 << 20
#: A margin is the mean log odds of the n-grams, times the root of their number up to this.
LIFT = 2.0
UNKNOWN = "und"
VERDICT = T.StructType(
    [
        T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("ambiguous", T.BooleanType()),
    ]
)
_FACTORS = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)


def _byte_map() -> np.ndarray:
    """ASCII that is no letter becomes a space, all other bytes stay."""
    table = np.arange(256, dtype=np.uint8)
    for b in range(128):
        if not chr(b).isalpha():
            table[b] = 32
    return table


BYTE_MAP = _byte_map()


def gram_counts(text: str) -> np.ndarray:
    """Hashed counts of the text's byte n-grams, in lower case, spaces merged."""
    size = 1 << BUCKET_BITS
    counts = np.zeros(size, np.int64)
    data = np.frombuffer(f" {text.lower()} ".encode("utf-8", "surrogatepass"), np.uint8)
    # The bytes before a chunk that its first n-grams begin with, and the last one, which decides on a space.
    carried, last = np.zeros(0, np.uint8), np.zeros(1, np.uint8)
    for i in range(0, len(data), CHUNK):
        mapped = BYTE_MAP[data[i : i + CHUNK]]
        kept = mapped[(mapped != 32) | (np.concatenate([last, mapped[:-1]]) != 32)]
        b, old = np.concatenate([carried, kept]), len(carried)
        for n in ORDERS:
            # Only the n-grams that end in this chunk.
            own = b[max(0, old - n + 1) :].astype(np.uint32)
            if len(own) >= n:
                h = np.full(len(own) - n + 1, (n * 0x27D4EB2F) & 0xFFFFFFFF, np.uint32)
                for k in range(n):
                    h += own[k : len(own) - n + 1 + k] * np.uint32(_FACTORS[k])
                h ^= h >> np.uint32(15)
                h *= np.uint32(0x2C1B3C6D)
                counts += np.bincount(h >> np.uint32(32 - BUCKET_BITS), minlength=size)
        carried, last = b[-(max(ORDERS) - 1) :], mapped[-1:]
    return counts


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """A matrix of -1 and 1 with one row for each of n languages.

    Up to five languages get every split into two parts, more get the best of
    64 random codes of ten times log2(n) bits, by the least distance of rows.
    """
    if n <= 5:
        splits = [s for k in range(1, n) for s in combinations(range(n), k) if 0 not in s]
        code = np.full((n, max(1, len(splits))), 1 if n == 1 else -1)
        for j, split in enumerate(splits):
            code[list(split), j] = 1
        return code
    rng, bits, best, least = np.random.default_rng(seed), math.ceil(10 * math.log2(n)), None, -1
    for _ in range(64):
        code = rng.choice([-1, 1], size=(n, bits))
        code[:, np.abs(code.sum(axis=0)) == n] *= np.where(np.arange(n) % 2, 1, -1)[:, None]
        apart = ((bits - code @ code.T) // 2)[np.triu_indices(n, 1)].min()
        if apart > least:
            best, least = code, apart
    return best


class LanguageCode:
    """Codewords of the languages and one n-gram classifier for each bit.

    A bit's classifier sums the log odds of the n-grams between the languages
    whose codeword has a 1 there and the others, each language with the same
    weight. Its margin is the mean log odds, lifted at most by ``LIFT`` however
    long the text. Decoding takes the codeword with the least total logistic loss.
    """

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        self.code = codewords(len(languages)) if languages else np.zeros((0, 1))
        smooth = counts + 0.5
        chance = smooth / smooth.sum(axis=1, keepdims=True)
        self.weights = np.zeros((counts.shape[1], self.code.shape[1]), np.float32)
        if len(languages) > 1:
            for j in range(self.code.shape[1]):
                one = self.code[:, j] > 0
                odds = np.log(chance[one].mean(axis=0)) - np.log(chance[~one].mean(axis=0))
                self.weights[:, j] = odds

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, share of the codeword in all likelihoods, ambiguous)."""
        if not text or not self.languages or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, True
        counts = gram_counts(text)
        n = max(1, int(counts.sum()))
        margin = counts.astype(np.float32) @ self.weights / n * min(math.sqrt(n), LIFT)
        loss = np.logaddexp(0, -self.code * margin).sum(axis=1)
        likely = np.exp(loss.min() - loss)
        at = int(loss.argmin())
        share = float(1 / likely.sum())
        return self.languages[at], share, share < 0.5


def _count_part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The n-gram counts of each language over one partition."""
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch["lang"], batch["text"]):
            counts.setdefault(lang, np.zeros(1 << BUCKET_BITS, np.int64))
            counts[lang] += gram_counts(text)
    for lang, n in counts.items():
        yield pd.DataFrame({"lang": [lang], "n": [n]})


def train_language_code(docs: DataFrame) -> LanguageCode:
    """Learn from the ``text`` and ``lang`` of all rows; nulls in either teach nothing.

    The n-gram counts of all texts are summed per language; the driver gets one
    row per language and bucket.
    """
    known = docs.select("lang", "text").where("lang IS NOT NULL AND text IS NOT NULL")
    sums = (
        known.mapInPandas(_count_part, "lang string, n array<bigint>")
        .select("lang", F.posexplode("n").alias("bucket", "n"))
        .where("n > 0").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    )
    languages = sorted(sums["lang"].unique())
    counts = np.zeros((len(languages), 1 << BUCKET_BITS))
    row = sums["lang"].map({x: i for i, x in enumerate(languages)}).to_numpy(np.int64)
    counts[row, sums["bucket"].to_numpy(np.int64)] = sums["n"]
    return LanguageCode(languages, counts)


def language_of(model: LanguageCode, text: Column) -> Column:
    """Struct of lang_pred, score and ambiguous for each text."""

    @F.pandas_udf(VERDICT)
    def run(texts: pd.Series) -> pd.DataFrame:
        found = [model.predict(t) for t in texts]
        return pd.DataFrame(found, columns=["lang_pred", "score", "ambiguous"])

    return run(text)


def identify_language(docs: DataFrame, folds: int = 5) -> DataFrame:
    """doc_id, held_out, lang_pred, score and ambiguous of every document.

    Learns from rows outside fold 0 of crc32(doc_id as text); predicts from the
    text alone. A text that is null or has no letter gives ``und`` with score
    0, as does everything if no row teaches. A null doc_id counts as empty text
    for the fold. Equal texts get equal results; other columns are ignored.
    """
    out = fold(F.col("doc_id"), folds) == 0
    model = train_language_code(docs.where(~out))
    found = docs.select("doc_id", out.alias("held_out"), language_of(model, F.col("text")).alias("v"))
    return found.select("doc_id", "held_out", "v.lang_pred", "v.score", "v.ambiguous")


def keep_known_language(docs: DataFrame, folds: int = 5) -> DataFrame:
    """``docs`` without texts of no language: no letter, or no codeword ahead of all others together."""
    model = train_language_code(docs.where(fold(F.col("doc_id"), folds) != 0))
    return docs.where(~language_of(model, F.col("text"))["ambiguous"])


def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_language(read(spark, sf_dir, "documents"))
