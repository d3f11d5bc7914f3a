"""Spelling variants by a dictionary of trie-node pairs.

All words are put into a trie, and all reversed words into another one; the
nodes of both are numbered. A word cut at a position is a pair of integers, the
node of what comes before and the node of what comes after. Two words differ by
one replaced code point exactly if they share a pair that skips one position in
both, and by an inserted or deleted one if a pair that skips a position of the
longer equals a pair that skips none of the shorter.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labmart.llm.common import Work, read

#: The letters of a run, and every how many runs lose a code point.
RUN = "[A-Za-zÀ-ÿ]+"
DELETE_EVERY = 97
#: Code points of a text that are searched at a time, and words that a task counts before it sends them on.
CHUNK, COUNTED = 1 << 20, 400_000
#: Words of an output batch.
ROWS = 1 << 12

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
PATHS = "part int, place bigint, word string, n bigint, path array<bigint>"


def lowered(run: str) -> str:
    """A-Z in lower case; other letters stay."""
    return run.lower() if run.isascii() else run.translate(_LOWER)


def runs_of(text: str, pattern: re.Pattern) -> Counter:
    """Number of each run of letters; the text is searched in pieces that end between runs."""
    counts: Counter = Counter()
    at = 0
    while at < len(text):
        end = min(at + CHUNK, len(text))
        if rest := pattern.match(text, end):
            end = rest.end()
        counts.update(pattern.findall(text, at, end))
        at = end
    return counts


def words_with_deletions(doc_id: str, text: str, pattern: re.Pattern) -> Counter:
    """Number of each word of a document, after the deletions that id and run decide."""
    words: Counter = Counter()
    lower: Counter = Counter()
    for run, n in runs_of(text, pattern).items():
        lower[lowered(run)] += n
    seed = zlib.crc32(f"{doc_id}:".encode())
    for run, n in lower.items():
        h = zlib.crc32(run.encode(), seed)
        if h % DELETE_EVERY == 0:
            i = h % len(run)
            run = run[:i] + run[i + 1 :]
        words[run] += n
    return words


def _counted(least_chars: int):
    """Counts of the words of a task's documents, added up before they are exchanged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern, total = re.compile(RUN), Counter()

        def batch() -> pa.RecordBatch:
            words, n = list(total), list(total.values())
            total.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), pa.array(n, pa.int64())], ["word", "n"]
            )

        for part in batches:
            for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text")):
                decoded = text.as_py().decode("utf-8", "replace")
                for word, n in words_with_deletions(doc_id, decoded, pattern).items():
                    if len(word) >= least_chars:
                        total[word] += n
                if len(total) >= COUNTED:
                    yield batch()
        yield batch()

    return run


def word_counts(docs: DataFrame, least_chars: int = 5, least_count: int = 3) -> DataFrame:
    """word and n: the words of all texts, of at least so many code points and occurrences.

    A null id counts as empty text, a null text as no text. Rows may repeat.
    """
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"),
        F.col("text").cast("string").cast("binary").alias("text"),
    ).where(F.col("text").isNotNull())
    counted = rows.mapInArrow(_counted(least_chars), "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def shared(a: str, b: str) -> int:
    """Length of the common prefix."""
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def _paths(reverse: bool):
    """Walks the trie over sorted words. A word's path keeps the nodes that it shares with the word before.

    Numbers start at 1 in each partition, and the first word's nodes are 1 to
    its length. ``path`` has no root; ``place`` is the word's position.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        before, path, nodes, place = "", [], 0, 0
        names = ["part", "place", "word", "n", "path"]
        types = [pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.list_(pa.int64())]
        out: list[tuple] = []

        def batch() -> pa.RecordBatch:
            columns = list(zip(*out)) if out else [[]] * 5
            made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)
            out.clear()
            return made

        held = 0
        for rows in batches:
            for key, n in zip(rows.column("key").to_pylist(), rows.column("n").to_pylist()):
                common = shared(before, key)
                new = len(key) - common
                path = path[:common] + list(range(nodes + 1, nodes + new + 1))
                nodes, before = nodes + new, key
                out.append((part, place, key[::-1] if reverse else key, n, path))
                place, held = place + 1, held + len(path)
                if held >= ROWS * 16:
                    held = 0
                    yield batch()
        yield batch()

    return run


def trie_paths(words: DataFrame, work: Work, reverse: bool = False) -> DataFrame:
    """word, n, rank (from 0, in the order of the trie) and path, the numbered nodes of its prefixes.

    Words are range-partitioned and sorted, so that each task numbers the nodes
    of its stretch of the trie. The first word of a partition may share nodes
    with the last word of the one before: the driver follows these borders, one
    word and its path for each partition, and returns what each partition adds
    to its numbers and which of its first nodes are nodes met before.
    """
    key = F.reverse("word") if reverse else F.col("word")
    # The order is part of the stored rows: a file need not be read as it was written.
    ranged = words.select(key.alias("key"), "n").repartitionByRange("key").sortWithinPartitions("key")
    local = work.keep(ranged.mapInArrow(_paths(reverse), PATHS), "backward" if reverse else "forward")
    facts = local.groupBy("part").agg(
        F.count(F.lit(1)).alias("words"),
        F.coalesce(F.max(F.try_element_at("path", F.lit(-1))), F.lit(0)).alias("nodes"),
        F.min_by("word", "place").alias("first"),
        F.max_by("word", "place").alias("last"),
        F.max_by("path", "place").alias("last_path"),
    )
    place, offset, before, path, borders = 0, 0, "", [], []
    for r in facts.orderBy("part").collect():
        first, last = (w[::-1] if reverse else w for w in (r["first"], r["last"]))
        known = path[: shared(before, first)]
        borders.append((r["part"], place, offset, known))
        path = [known[x - 1] if x <= len(known) else offset + x for x in r["last_path"]]
        place, offset, before = place + r["words"], offset + r["nodes"], last
    table = words.sparkSession.createDataFrame(
        borders, "part int, start bigint, offset bigint, known array<bigint>"
    )
    number = F.transform(
        "path",
        lambda x: F.when(x <= F.size("known"), F.get("known", (x - 1).cast("int"))).otherwise(F.col("offset") + x),
    )
    # One row for each partition.
    return local.join(F.broadcast(table), "part").select(
        "word", "n", (F.col("start") + F.col("place")).alias("rank"), number.alias("path")
    )


def _pairs(words: DataFrame) -> DataFrame:
    """The pairs of each word (rank, n): ``skip`` leaves a position out, ``once`` if it is the first of its run.

    Skipping any of several equal code points in a row leaves the same word, so
    only the first of them stands for the deletion. A word's pairs are made in
    one array, in time in proportion to its length.
    """
    size = F.size("forward")
    # Node of the first i code points, and of the last i; 0 is the root.
    before = lambda i: F.coalesce(F.get("forward", i - 1), F.lit(0)).alias("before")
    after = lambda i: F.coalesce(F.get("backward", i - 1), F.lit(0)).alias("after")
    no = F.lit(False)

    def whole(i):
        return F.struct(before(i), after(size - i), no.alias("skip"), no.alias("once"))

    def skipping(_, i):
        once = (i == 0) | (F.get("letters", i) != F.get("letters", i - 1))
        return F.struct(before(i), after(size - i - 1), F.lit(True).alias("skip"), once.alias("once"))

    pairs = F.concat(F.transform(F.sequence(F.lit(0), size), whole), F.transform("forward", skipping))
    rows = words.select("rank", "n", "forward", "backward", F.split("word", "").alias("letters"))
    return rows.select("rank", "n", F.inline(pairs))


def near_words(words: DataFrame) -> DataFrame:
    """rank, n_near and best (n, rank as -down) of each word that has near words.

    Words that share a pair are one group: at most one word that is just the
    pair, and words with one more code point between. Each member takes its
    counts and the most frequent other from aggregates over the group, so no
    pairs of words are made. The best of the others is right only where it is
    more frequent than the word itself, which is all that ``variants`` asks.
    """
    over = F.expr  # window aggregates in SQL, all over the same unordered window
    group = "OVER (PARTITION BY before, after)"
    own = "struct(n, -rank AS down)"
    grouped = _pairs(words).select(
        "rank", "n", "skip", "once",
        over(f"count_if(skip) {group}").alias("skips"),
        over(f"count_if(once) {group}").alias("onces"),
        over(f"max(CASE WHEN skip THEN {own} END) {group}").alias("top_skip"),
        over(f"max(CASE WHEN once THEN {own} END) {group}").alias("top_once"),
        over(f"max(CASE WHEN NOT skip THEN {own} END) {group}").alias("whole"),
    )
    shorter = F.col("once") & F.col("whole").isNotNull()
    other = F.when(F.col("top_skip.down") != -F.col("rank"), F.col("top_skip"))
    # The skipping members are near each other; the whole word is near those that count once.
    near = F.when(F.col("skip"), F.col("skips") - 1 + shorter.cast("int")).otherwise(F.col("onces"))
    best = F.when(F.col("skip"), F.greatest(other, F.when(shorter, F.col("whole")))).otherwise(F.col("top_once"))
    return (
        grouped.select("rank", near.alias("near"), best.alias("best")).where(F.col("near") > 0)
        .groupBy("rank").agg(F.sum("near").alias("n_near"), F.max("best").alias("best"))
    )


def roots(forms: DataFrame, work: Work, longest: int) -> DataFrame:
    """rank and root: the end of each word's chain of forms, of at most ``longest`` steps.

    Each round joins the table with itself, which doubles the steps that are
    done. Every round's table is stored.
    """
    chain, k = work.keep(forms.select("rank", F.col("form").alias("root")), "chain0"), 0
    while 1 << k < longest:
        k += 1
        beyond = chain.select(F.col("rank").alias("root"), F.col("root").alias("beyond"))
        chain = work.keep(
            chain.join(beyond, "root", "left").select("rank", F.coalesce("beyond", "root").alias("root")),
            f"chain{k}",
        )
        work.drop(f"chain{k - 1}")
    return chain


def variants(words: DataFrame, ratio: float = 2) -> DataFrame:
    """word, form, root, n, n_near and form_n of words with their counts.

    Two words are near if they differ by exactly one inserted, deleted or
    replaced code point. A word's form is its near word of largest n, ties to
    the smaller word in code-point order, if that n is at least ``ratio`` (over
    1) times its own; its root is the end of the chain of forms. Words without
    near words have n_near 0 and no form; the empty word may take part. Rows of one
    word add up. An empty table gives no rows. Null words and words with a sum below
    one take no part.

    Very long words have as many pairs as code points, each of two integers.
    """
    if ratio <= 1:
        raise ValueError("chains of forms end only if each form is more frequent")
    work = Work(words.sparkSession, "spelling")
    summed = words.where("word IS NOT NULL").groupBy("word").agg(F.sum("n").alias("n"))
    words = work.keep(summed.where("n >= 1"), "words")
    forward = trie_paths(words, work).withColumnRenamed("path", "forward")
    backward = trie_paths(words, work, reverse=True).select("word", F.col("path").alias("backward"))
    numbered = work.keep(forward.join(backward, "word"), "numbered")
    near = work.keep(near_words(numbered), "near")
    base = numbered.select("rank", "word", "n")
    found = base.join(near, "rank", "left").withColumn(
        "form", F.when(F.col("best.n") >= ratio * F.col("n"), -F.col("best.down"))
    )
    found = work.keep(found.withColumn("form_n", F.when(F.col("form").isNotNull(), F.col("best.n"))), "found")
    spread = found.agg(F.max("form_n").alias("most"), F.min("n").alias("least")).first()
    longest, n, most = 0, spread["least"], spread["most"] or 0
    while most and n * ratio <= most:
        longest, n = longest + 1, n * ratio
    ends = roots(found.where(F.col("form").isNotNull()), work, longest)
    names = lambda c: base.select(F.col("rank").alias(c), F.col("word").alias(f"{c}_word"))
    return (
        found.join(ends, "rank", "left")
        .join(names("form"), "form", "left").join(names("root"), "root", "left")
        .select(
            "word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"),
            "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), "form_n",
        )
    )


OP12_SQL = f"""
WITH RECURSIVE crc_table AS MATERIALIZED (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda a, x: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) ORDER BY i) AS crcs
  FROM (SELECT unnest(range(256)) AS i)),
runs AS MATERIALIZED (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '{RUN}')) AS run FROM documents) GROUP BY ALL),
spelt AS MATERIALIZED (
  SELECT run, n, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS digits FROM runs),
hashed AS MATERIALIZED (
  SELECT run, n, xor(list_reduce(list_concat([4294967295], list_transform(range(length(digits) // 2), lambda k:
      16 * (instr('0123456789ABCDEF', substr(digits, 2 * k + 1, 1)) - 1)
      + instr('0123456789ABCDEF', substr(digits, 2 * k + 2, 1)) - 1)),
    lambda a, x: xor(a >> 8, crcs[1 + (xor(a, x) & 255)])), 4294967295) AS h
  FROM spelt, crc_table),
words AS MATERIALIZED (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT n, CASE WHEN h % {DELETE_EVERY} = 0
      THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
skips AS MATERIALIZED (
  SELECT word, n, left(word, i) AS a, substr(word, i + 2) AS b
  FROM (SELECT *, unnest(range(length(word))) AS i FROM words)),
near AS MATERIALIZED (
  SELECT x.word, y.word AS other, y.n FROM skips x JOIN skips y ON x.a = y.a AND x.b = y.b AND x.word <> y.word
  UNION SELECT x.word, y.word, y.n FROM skips x JOIN words y ON x.a || x.b = y.word
  UNION SELECT y.word, x.word, x.n FROM skips x JOIN words y ON x.a || x.b = y.word),
counted AS (SELECT word, count(*) AS n_near FROM near GROUP BY word),
best AS (SELECT * FROM near QUALIFY row_number() OVER (PARTITION BY word ORDER BY n DESC, other) = 1),
forms AS MATERIALIZED (
  SELECT w.word, b.other AS form, b.n AS form_n FROM words w JOIN best b ON w.word = b.word WHERE b.n >= 2 * w.n),
chain AS (SELECT word, word AS root FROM words
  UNION ALL SELECT c.word, f.form FROM chain c JOIN forms f ON c.root = f.word)
SELECT w.word, f.form, c.root, w.n, coalesce(k.n_near, 0) AS n_near, f.form_n
FROM words w LEFT JOIN forms f ON w.word = f.word LEFT JOIN counted k ON w.word = k.word
JOIN chain c ON w.word = c.word AND c.root NOT IN (SELECT word FROM forms)"""


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(word_counts(read(spark, sf_dir, "documents")))
