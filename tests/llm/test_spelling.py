"""Near words, forms and roots against comparing all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest

from labmart.llm import spelling
from labmart.llm.common import Work
from labmart.llm.spelling import RUN, near_words, runs_of, trie_paths, variants, word_counts


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain(counts, ratio=2):
    near = {w: [x for x in counts if one_edit(w, x)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    out = {}
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, counts[w], len(near[w]), None if form[w] is None else counts[form[w]])
    return out


def words(n, seed, letters="abcé", most=7):
    rng = random.Random(seed)
    return {"".join(rng.choice(letters) for _ in range(rng.randrange(most))): rng.choice([1, 2, 3, 5, 9, 30, 200, 5000]) for _ in range(n)}


@pytest.mark.parametrize("seed,ratio,partitions", [(1, 2, 8), (2, 1.5, 40), (3, 3, 40)])
def test_variants_equal_all_pairs(spark, seed, ratio, partitions):
    counts = words(400, seed)
    counts |= {"hello": 50, "helo": 7, "hell": 3, "helllo": 1, "x" * 3000: 9, "x" * 2999: 2, "x" * 1500 + "y" + "x" * 1499: 1, "\U0001f600a": 4, "\U0001f601a": 9}
    rows = [(w, n, "z", 1) for w, n in counts.items()]
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", str(partitions == 8))
        df = spark.createDataFrame(rows, "word string, n bigint, form string, rank int")
        found = variants(df, ratio).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in found}
    assert len(found) == len(counts) and got == plain(counts, ratio)


def test_trie_nodes_are_prefixes(spark):
    counts = words(300, 8, "ab", 12)
    df = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    for reverse in (False, True):
        rows = trie_paths(df.repartition(20), Work(spark, "trie"), reverse).collect()
        node = {}
        for r in rows:
            key = r.word[::-1] if reverse else r.word
            assert len(r.path) == len(key)
            for i, x in enumerate(r.path):
                assert node.setdefault(key[: i + 1], x) == x
        assert len(set(node.values())) == len(node)
        assert [r.rank for r in sorted(rows, key=lambda r: r.word[::-1] if reverse else r.word)] == list(range(len(rows)))


def test_no_pairs_within_a_group(spark):
    """Aggregates over the group, no join: the rows made are the words' own positions."""
    df = spark.createDataFrame([("abcde", 1)], "word string, n bigint")
    numbered = df.selectExpr("word", "n", "0L rank", "array(1L,2L,3L,4L,5L) forward", "array(1L,2L,3L,4L,5L) backward")
    plan = near_words(numbered)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Window" in plan


def test_counts_and_deletions(spark, monkeypatch):
    rng = random.Random(4)
    lexicon = [f"{a}{b}{c}" for a in "bdf" for b in ("ÉL", "ol", "Or") for c in ("nest", "rk", "ÿl")]
    texts = [" ".join(rng.choice(lexicon) for _ in range(200)) + "×÷ 1a2" for _ in range(30)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, texts[0]), (3, None), (4, ""), (5, "wörter " * 5), (5, "wörter " * 5), (6, "q" * 5000)]
    want = Counter()
    for i, t in rows:
        for run in re.findall(RUN, t or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            want[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run] += 1
    want = {w: n for w, n in want.items() if len(w) >= 5 and n >= 3}
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "'x' word", "1 n")
    assert {r.word: r.n for r in word_counts(df).collect()} == want
    assert variants(word_counts(df.limit(0))).count() == 0
    monkeypatch.setattr(spelling, "CHUNK", 7)
    for text in (*texts[:3], "", "é" * 100):
        assert runs_of(text, re.compile(RUN)) == Counter(re.findall(RUN, text))
