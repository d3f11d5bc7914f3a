"""Keep bitmaps against counting the keys of all lines."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from labmart.llm.lines import kept_lines, kept_text, line_key, line_keeps, packed_keep


def plain(texts, least_chars, least_docs, keep_first=False):
    """Kept lines of each text; documents in order."""
    docs = [(t or "").split("\n") for t in texts]
    keys = [[line_key(x.encode()).decode() for x in d] for d in docs]
    holders = {}
    for i, own in enumerate(keys):
        for key in set(own):
            holders.setdefault(key, set()).add(i)
    seen, out = set(), []
    for lines, own in zip(docs, keys):
        kept = []
        for line, key in zip(lines, own):
            common = len(key) >= least_chars and len(holders[key]) >= least_docs
            if not common or (keep_first and key not in seen):
                kept.append(line)
            seen.add(key)
        out.append(kept)
    return docs, out


def corpus(n, seed):
    rng = random.Random(seed)
    lines = [f"Line {i} é" for i in range(12)] + ["hot", "  HOT\t", "", " ", "\x0bÉx", "ab", "a"]
    texts = []
    for i in range(n):
        own = [rng.choice(lines) for _ in range(rng.randrange(8))] + (["Hot"] if i % 3 else [])
        rng.shuffle(own)
        texts.append("\n".join(own))
    texts[::9] = [None if i % 2 else "" for i in range(len(texts[::9]))]
    texts[1] = "\n".join(["hot", "own line"] * 4000)
    texts[2] = "x" * 300_000
    return texts


@pytest.mark.parametrize("least_chars,least_docs,keep_first", [(1, 10, False), (3, 2, False), (1, 1, False), (1, 10, True), (2, 3, True)])
@pytest.mark.parametrize("partitions", ["8", "61"])
def test_keeps_equal_counting(spark, least_chars, least_docs, keep_first, partitions):
    texts = corpus(150, least_docs)
    docs, kept = plain(texts, least_chars, least_docs, keep_first)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        # Many small partitions: the hot key's lines fill several.
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", str(partitions == "8"))
        found = line_keeps(df.coalesce(1), least_chars, least_docs, keep_first).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(found) == len(texts)
    for r in found:
        lines, own = docs[r.doc_id], kept[r.doc_id]
        assert (r.n_lines, r.n_dropped) == (len(lines), len(lines) - len(own))
        assert (r.keep is None) == (r.n_dropped == 0)
        if r.keep is not None:
            assert [x for x, stays in zip(lines, kept_lines(r.n_lines, r.keep)) if stays] == own


def test_bitmap_round_trip():
    for n, dropped in ((1, []), (1, [0]), (9, [0, 8]), (100_000, list(range(0, 100_000, 2)))):
        keep = kept_lines(n, packed_keep(n, dropped))
        assert len(keep) == n and [i for i in range(n) if not keep[i]] == dropped
    assert len(packed_keep(1_000_000, [])) < 2_000


def test_odd_rows(spark):
    rows = [(None, "a\nb"), (1, "A \n c"), (1, "a\nb"), (1, "a\nb"), (2, None), (3, ""), (4, "\n\n")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "'x' row", "1 keep", "2 high", "3 position", "4 of", "5 dropped", "6 n_lines")
    found = line_keeps(df, least_docs=3)
    assert found.columns == ["doc_id", "text", "row", "high", "position", "of", "dropped", "n_lines", "n_dropped", "keep"]
    text = F.coalesce("text", F.lit("")).cast("binary")
    rest = found.where("keep IS NOT NULL").select("doc_id", kept_text(text, "keep").cast("string").alias("t")).collect()
    assert sorted((str(r.doc_id), r.t) for r in rest) == [("1", ""), ("1", ""), ("1", " c"), ("None", "")]
    assert found.where("keep IS NULL").count() == 3
    assert line_keeps(df.limit(0)).count() == 0


def test_query_digest(spark, tmp_path):
    from labmart.llm.lines import op11_lines

    texts = corpus(60, 5)
    spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    _, kept = plain(texts, 1, 10)
    for r in op11_lines(spark, str(tmp_path)).collect():
        assert r.kept_sha256 == hashlib.sha256("\n".join(kept[r.doc_id]).encode()).hexdigest()


def test_texts_stay_where_they_are(spark, capsys):
    """With no side small enough for a broadcast, no exchange carries the text."""
    texts = [f"hot\n{i} own\n\nhot" for i in range(3000)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    limits = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k, None) for k in limits}
    try:
        for k in limits:
            spark.conf.set(k, "-1")
        found = line_keeps(df.repartition(3))
        found.explain("formatted")
        moved = re.findall(r"\) Exchange *\nInput \[\d+\]: (.*)", capsys.readouterr().out)
        rows = found.select("doc_id", "n_lines", "n_dropped").collect()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert moved and not any("text#" in columns for columns in moved)
    assert sorted(map(tuple, rows)) == [(i, 4, 2) for i in range(3000)]
