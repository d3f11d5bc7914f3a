"""SimHash fingerprints, linked by multi-index hashing.

A fingerprint is cut into segments. For each segment the small Hamming ball
around its value is enumerated and looked up in the table of the values that
occur; the documents that meet at a value are then compared by their complete
distance. Two texts at a distance of at most ``k`` agree in one of ``m``
segments up to ``k // m`` bits, so the balls lose no link (pigeonhole).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labmart.llm.common import AT, STRETCH, Work, free_name, in_place, read, words_of
from labmart.llm.components import connected

SEED = 42
LONGS = T.ArrayType(T.LongType())
#: Shingles hashed and counted at a time, so that long texts need no more memory.
CHUNK = 1 << 16
#: Members of one value compared in one task; larger groups are dealt as a grid of blocks.
BLOCK = 256


def shingle_hashes(words: list[bytes], size: int) -> Iterator[np.ndarray]:
    """XXH64 of each space-joined shingle in chunks; fewer words make one shingle."""
    if not words:
        return
    text = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    if len(words) < size:
        pairs = [(0, len(text))]
    else:
        pairs = list(zip([0, *ends], (e - 1 for e in ends[size - 1 :])))
    digest = xxhash.xxh64_intdigest
    for i in range(0, len(pairs), CHUNK):
        part = pairs[i : i + CHUNK]
        yield np.fromiter((digest(text[a:b], SEED) for a, b in part), np.uint64, len(part))


def _sign(chunks: Iterator[np.ndarray]) -> int:
    """Bit i is 1 if set in over half of all hashes; none: zero."""
    total, counts = 0, np.zeros(64, np.int64)
    for h in chunks:
        total += len(h)
        octets = np.ascontiguousarray(h).astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.add.reduce(np.unpackbits(octets, axis=1, bitorder="little"), axis=0, dtype=np.int32)
    return int(np.packbits(counts * 2 > total, bitorder="little").view("<i8")[0])


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64-bit SimHash over all word shingles, repeats included, as a signed integer."""
    return _sign(shingle_hashes(words_of(text), shingle))


@F.pandas_udf(LONGS)
def fingerprint_3(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: [fingerprint(t, 3)], na_action=None)


def _values(cuts: list[tuple[int, int, int]]) -> list:
    """Value of each segment of the fingerprint in ``words``."""
    out = []
    for start, bits, _ in cuts:
        value = F.shiftrightunsigned(F.col("words")[start // 64], start % 64)
        if start % 64 + bits > 64:
            value = value.bitwiseOR(F.shiftleft(F.col("words")[start // 64 + 1], 64 - start % 64))
        out.append(value.bitwiseAND(F.lit((1 << bits) - 1).cast("bigint")))
    return out


def _key(seg: int, value):
    return F.struct(F.lit(seg).alias("seg"), value.alias("key"))


def _forest(words: np.ndarray, ids: np.ndarray, first: int, most: int) -> list[tuple[int, int]]:
    """Links that span what is within ``most`` bits, by breadth-first search over one block."""
    found, left = [], np.arange(len(ids))
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            far = np.bitwise_count(words[left, first:] ^ words[at, first:]).sum(axis=1)
            near = left[far <= most]
            if len(near):
                found += [(int(ids[at]), int(ids[x])) for x in near]
                queue += list(near)
                left = left[far > most]
    return found


def _compare(first: int, most: int):
    columns = ["seg", "key", "bi", "bj"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Batches come sorted by value and block; a group may span batches."""
        rest = None
        for batch in batches:
            now = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            keys = now[columns].to_numpy()
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            last = cuts[-1] if len(cuts) else 0
            yield links(now.iloc[:last], cuts)
            rest = now.iloc[last:]
        if rest is not None:
            yield links(rest, [])

    def links(rows: pd.DataFrame, cuts) -> pd.DataFrame:
        out = []
        if len(rows) > 1:
            ids = rows["id"].to_numpy()
            words = np.vstack(rows["words"].to_numpy()).astype(np.int64).view(np.uint64)
            bounds = [0, *(c for c in cuts if c < len(rows)), len(rows)]
            for a, b in zip(bounds, bounds[1:]):
                if b - a > 1:
                    one, at = np.unique(ids[a:b], return_index=True)
                    if len(one) > 1:
                        out += _forest(words[a:b][at], one, first, most)
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return run


def _compared(spread: DataFrame, prints: DataFrame, most: int, first: int, block: int) -> DataFrame:
    """Spanning links among the members (id) of each value (seg, key), of which there are n."""
    blocks = F.ceil(F.col("n") / block).cast("int")
    mine = F.pmod(F.xxhash64("id"), blocks).cast("int")
    dealt = (
        spread.join(prints, "id")
        .select("id", "words", "seg", "key", mine.alias("mine"), blocks.alias("blocks"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "id", "words", "seg", "key",
            F.least("mine", "other").alias("bi"), F.greatest("mine", "other").alias("bj"),
        )
    )
    met = dealt.repartition("seg", "key", "bi", "bj").sortWithinPartitions("seg", "key", "bi", "bj")
    return met.mapInPandas(_compare(first, most), "a bigint, b bigint").distinct()


def linked(
    prints: DataFrame,
    cuts: list[tuple[int, int, int]],
    most: int,
    work: Work,
    first: int = 0,
    block: int = BLOCK,
) -> DataFrame:
    """(node, component) of the fingerprints that link at ``most`` or fewer differing bits.

    ``prints`` has one row per distinct fingerprint: ``id`` bigint and ``words``
    array of 64-bit words. ``cuts`` are segments (first bit, bits, radius 0 or
    1); distances count the words from ``first`` on.

    The members of a value are the fingerprints that have it and, with radius 1,
    those that look it up as another value of their ball; of two such values the
    one with the bit unset looks up the other, which finds each pair once.
    Members meet in one task, or in a grid of blocks if they are more than
    ``block``, and each task returns a spanning forest, never all pairs.
    """
    values = _values(cuts)
    own = work.keep(
        prints.select("id", F.explode(F.array(*[_key(i, v) for i, v in enumerate(values)])).alias("k"))
        .select("id", "k.seg", "k.key"),
        "own",
    )
    balls = [
        F.array(
            *[
                F.when(v.bitwiseAND(F.lit(1 << i).cast("bigint")) == 0, _key(seg, v + F.lit(1 << i)))
                for i in range(bits)
            ]
        )
        for seg, (v, (_, bits, radius)) in enumerate(zip(values, cuts)) if radius
    ]
    probes = prints.select("id", F.explode(F.concat(*balls)).alias("k")).where("k IS NOT NULL")
    occurring = own.select("seg", "key").distinct()
    hits = work.keep(
        probes.select("id", "k.seg", "k.key").join(occurring, ["seg", "key"]).select("id", "seg", "key"),
        "hits",
    )
    members = own.unionByName(hits)
    several = work.keep(
        members.groupBy("seg", "key").agg(F.count("*").alias("n")).where("n > 1"), "several"
    )
    spread = members.join(several, ["seg", "key"])
    near = work.keep(_compared(spread, prints, most, first, block), "near")
    found = work.keep(connected(near, work), "components")
    work.drop("own", "hits", "several", "near")
    return found


def linked_classes(
    docs: DataFrame, words, cuts, most: int, work: Work, first: int = 0, block: int = BLOCK
) -> DataFrame:
    """(doc_id, words, component_id) of all documents; see ``linked``."""
    prints = work.keep(docs.select("doc_id", words.alias("words")), "prints")
    distinct = prints.where("doc_id IS NOT NULL").groupBy("words").agg(F.min("doc_id").alias("id"))
    distinct = work.keep(distinct, "distinct")
    tied = linked(distinct, cuts, most, work, first, block)
    classes = work.keep(
        distinct.join(tied, distinct["id"] == tied["node"], "left").select(
            "words", F.coalesce("component", "id").alias("component_id")
        ),
        "classes",
    )
    work.drop("distinct", "components")
    return prints.join(classes, "words", "left")


def simhash_near_duplicates(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every document.

    Fingerprints of 64 bits over 3-word shingles link at 2 or fewer differing
    bits: halves of 32 bits, one searched with a ball of radius 1 and the other
    for equality (if the first half differs in 2 bits, the second is equal).
    A null or wordless text has fingerprint zero and is linked like any other;
    equal rows give equal rows; a row without doc_id keeps its fingerprint and
    has the class of that fingerprint, or null if no row with an id has it. An
    empty table gives no rows. Columns other than doc_id and text are ignored.
    """
    work = Work(docs.sparkSession, "simhash")
    rows = linked_classes(
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"),
        fingerprint_3("text"), [(32, 32, 1), (0, 32, 0)], 2, work, block=block,
    )
    digits = F.lower(F.lpad(F.hex(F.col("words")[0]), 16, "0"))
    return rows.select("doc_id", digits.alias("fingerprint"), "component_id")


def drop_near_copies(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """``docs`` with one document of each class of ``simhash_near_duplicates``: that of the smallest id.

    Columns stay as they are. Rows of one doc_id stay or go together, and if they
    stay, one of them does: the id stays if one of its texts has no class with a
    smaller id. A row without doc_id stays, as no decision can name it.
    """
    work = Work(docs.sparkSession, "copies")
    stored = in_place(docs, work, "stored")
    doc_id, of, rows = F.col("doc_id").cast("bigint"), free_name(stored, "of"), free_name(stored, "rows")
    known = simhash_near_duplicates(stored.where("doc_id IS NOT NULL"), block)
    kept = known.groupBy("doc_id").agg(F.max("component_id").alias("component_id")).where("component_id = doc_id")
    # Only ids and locators are exchanged, one row for each id; the texts stay.
    first = stored.where("doc_id IS NOT NULL").groupBy(doc_id.alias("doc_id")).agg(
        F.min(F.struct(STRETCH, AT)).alias("first")
    )
    stay = (
        first.join(kept, "doc_id", "left_semi")
        .groupBy(F.col(f"first.{STRETCH}").alias(of)).agg(F.collect_list(f"first.{AT}").alias(rows))
    )
    met = stored.join(stay.hint("shuffle_hash"), F.col(STRETCH) == F.col(of), "left")
    stays = F.coalesce(F.array_contains(rows, F.col(AT)), F.lit(False)) | F.col("doc_id").isNull()
    return met.where(stays).select(*[stored[c] for c in docs.columns])


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_near_duplicates(read(spark, sf_dir, "documents"))
