"""The quality model learns from every labelled row; its blocks and quantile against plain computations."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from labmart.llm import quality
from labmart.llm.quality import features, pairs, train_quality, weighted_quantile


def test_every_labelled_row_teaches(spark):
    good = lambda i: f"A plain sentence {'and more ' * (i % 7)}number {i * i}."
    bad = lambda i: f"BUY {i * i} {'$! ' * (1 + i % 5)}and more"
    text = {i: bad(i) if i % 10 == 0 else good(i) for i in range(9000)}
    docs = spark.createDataFrame([*text.items()], "doc_id bigint, text string")
    model = train_quality(docs, docs.selectExpr("doc_id", "IF(doc_id % 10 = 0, 0, 1) AS quality"))
    taught = [i for i in text if zlib.crc32(str(i).encode()) % 5]
    x, up = np.vstack([features(text[i]) for i in taught]).astype(float), np.array([i % 10 > 0 for i in taught])
    assert up.sum() > 6000
    assert np.allclose(model.mean, x.mean(axis=0), rtol=1e-6, atol=1e-7)
    assert np.allclose(model.scale, x.std(axis=0) + 1e-3, rtol=1e-5)
    raw, share = ((x - model.mean) / model.scale) @ model.w, 1 - up.mean()
    weight, order = np.where(up, (1 - share) / up.sum(), share / (~up).sum()), np.argsort(raw, kind="stable")
    cut = np.interp(share, np.cumsum(weight[order]) - weight[order] / 2, raw[order])
    assert abs(model.cut - cut) < 1e-4
    assert ((model.score(x.astype(np.float32)) >= 0.3) == up).mean() > 0.99


@pytest.mark.parametrize("down", [300, 6, 1])
def test_blocks_hold_each_row_once_and_both_classes(spark, monkeypatch, down):
    monkeypatch.setattr(quality, "BLOCK", 50)
    monkeypatch.setattr(quality, "LEAST", 3)
    rows = spark.range(500 + down).select(
        F.col("id").alias("doc_id"), (F.col("id") < 500).cast("int").alias("quality"),
        F.xxhash64("id").alias("mix"), F.array(F.col("id").cast("float"), F.lit(1).cast("float")).alias("x"),
    )
    blocks = quality._dealt(rows, {0: down, 1: 500}).collect()
    assert len(blocks) == len({r.block for r in blocks}) == 10
    own, begun = [], 0
    for r in blocks:
        x, good, mine = quality._unpacked(r)
        assert x.shape == (len(good), 2) and ((x[:, 0] < 500) == good).all()
        assert 0 < good.sum() < 100 and (~good).any()
        own += x[mine, 0].tolist()
        better, worse = pairs(good, mine, 3)
        assert good[better].all() and not good[worse].any()
        assert len(better) == len(worse) == quality.PAIRS * mine.sum()
        begun += len(better)
    assert sorted(own) == list(range(500 + down)) and begun == 2 * (500 + down)


def test_blocks_do_not_change_what_is_learnt(spark, monkeypatch):
    text = {i: f"A plain sentence number {i}. " * (1 + i % 5) if i % 3 else f"BUY!!! {i} $$$ " * (1 + i % 7) for i in range(600)}
    docs = spark.createDataFrame([*text.items()], "doc_id bigint, text string")
    labels = docs.selectExpr("doc_id", "IF(doc_id % 3 = 0, 0, 1) AS quality")
    whole = train_quality(docs, labels)
    monkeypatch.setattr(quality, "BLOCK", 60)
    cut = train_quality(docs, labels)
    x = np.vstack([features(t) for t in text.values()])
    assert np.allclose(whole.mean, cut.mean, rtol=1e-6) and np.allclose(whole.scale, cut.scale, rtol=1e-6)
    assert not np.array_equal(whole.w, cut.w)
    for model in (whole, cut):
        assert ((model.score(x) >= 0.3) == [i % 3 > 0 for i in text]).all()


def test_weighted_quantile_is_exact(spark, monkeypatch):
    monkeypatch.setattr(quality, "CELLS", 4)
    rng = np.random.default_rng(5)
    for values in (rng.normal(size=300), rng.integers(0, 6, 300) / 4, np.concatenate([rng.normal(size=60), [1e9] * 3, [0.5] * 90]), np.ones(7), np.array([2.0, 3.0])):
        rows = sorted((float(v), bool(g)) for v, g in zip(values, rng.random(len(values)) < 0.7))
        table, weight = spark.createDataFrame(rows, "raw double, good boolean").cache(), {True: 0.3, False: 1.7}
        each = np.array([weight[g] for _, g in rows])
        weight, each = {g: w / each.sum() for g, w in weight.items()}, each / each.sum()
        for q in (0.0, 0.013, 0.37, 0.61, 0.97, 1.0):
            wanted = np.interp(q, np.cumsum(each) - each / 2, [v for v, _ in rows])
            assert weighted_quantile(table, weight, q) == pytest.approx(wanted, rel=1e-9, abs=1e-9)
        table.unpersist()


def test_labels_meet_their_documents(spark):
    docs = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (3, "c"), (None, "d"), (4, None)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (4, 1), (9, 1)], "doc_id bigint, quality int")
    wanted = [(1, 0), (1, 0), (1, 1), (1, 1), (2, 0), (4, 1)]
    for known in (labels, labels.selectExpr("int(doc_id) doc_id", "quality")):
        met = quality._labelled(docs, known).collect()
        assert sorted((r.doc_id, r.quality) for r in met) == wanted
        assert len({r.mix for r in met}) == len(met)
        assert all(np.allclose(r.x, features({1: "a", 2: "b", 4: None}[r.doc_id])) for r in met)
