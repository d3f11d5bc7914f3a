"""Passages, neighbours and licences against brute force."""

import random

import numpy as np
import pytest

from labmart.llm import collisions
from labmart.llm.collisions import nearest_neighbours
from labmart.llm.decontaminate import (
    PassageIndex,
    benchmark_passages,
    drop_contaminated,
    passage_words,
    substring_distance,
)
from labmart.llm.licenses import scan_licenses

LEXICON = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in ("n", "st", "r", "lm")]


def sentence(n, seed):
    rng = random.Random(seed)
    return " ".join(rng.choice(LEXICON) for _ in range(n))


def edit_distance(item, region):
    row = [0] * (len(region) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(region, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_substring_distance_matches_plain():
    rng = np.random.default_rng(2)
    for _ in range(200):
        a, b = rng.integers(0, 4, rng.integers(1, 9)), rng.integers(0, 4, rng.integers(0, 14))
        assert substring_distance(a, b) == edit_distance(list(a), list(b))


def test_altered_passages_are_found():
    items = [(i, sentence(14 + i, i)) for i in range(40)]
    index, rng, found, total = PassageIndex(items), random.Random(4), 0, 0
    for i, text in items:
        assert [h[0] for h in index.find([f"{sentence(50, 900 + i)} {text.upper()}! {sentence(50, 950 + i)}"])[0]] == [i]
        words = text.split()
        for _ in range(len(words) // 5):
            words[rng.randrange(len(words))] = "zzz"
        total += 1
        found += any(h[0] == i for h in index.find([sentence(30, i + 500) + " " + " ".join(words)])[0])
    assert found / total >= 0.9
    hits = index.find([sentence(400, 7000 + i) for i in range(30)])
    assert not any(hits)


def test_short_items_are_found_exactly(spark):
    items = [(1, "yes"), (2, "Paris, France"), (3, "one two three"), (4, "ka kb kc kd"), (5, "yes yes")]
    texts = [(1, "say YES now"), (2, "paris france"), (3, "paris in france"), (4, "zero one two three."), (5, "ka kb kd"), (6, "x ka kb kc kd yes yes"), (7, None)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    found = sorted((r.doc_id, r.item_id, r.start_word, r.distance) for r in benchmark_passages(docs, benchmark).collect())
    assert found == [(1, 1, 1, 0), (2, 2, 0, 0), (4, 3, 1, 0), (6, 1, 5, 0), (6, 4, 1, 0), (6, 5, 5, 0)]
    assert drop_contaminated(docs, benchmark).count() == len(texts)
    assert benchmark_passages(docs, benchmark, least_words=3).count() == 2


def test_unreached_recall_is_searched_by_common_pairs(monkeypatch):
    items = [(i, sentence(14 + i % 3, i)) for i in range(30)]
    monkeypatch.setattr("labmart.llm.decontaminate.ROUNDS", 0)
    index, rng = PassageIndex(items), random.Random(4)
    for i, text in items:
        words = text.split()
        for _ in range(len(words) // 5):
            words[rng.randrange(len(words))] = "zzz"
        assert i in [h[0] for h in index.find([sentence(30, i + 500) + " " + " ".join(words)])[0]]


def test_passages_of_a_very_long_text():
    items = [(i, sentence(20, i)) for i in range(12)]
    text = " ".join(sentence(9000, 50 + k) + " " + t for k, (_, t) in enumerate(items))
    assert [(h[0], h[3]) for h in PassageIndex(items).find([text])[0]] == [(i, 0) for i in range(12)]


def test_hits_are_within_the_distance(spark):
    items = [(i, sentence(20, i)) for i in range(12)] + [(90, None), (91, ""), (92, "too short"), (93, sentence(20, 3))]
    texts = [(i, f"{sentence(40, 100 + i)} {sentence(20, i)} {sentence(9, i)}") for i in range(6)]
    texts += [(20, None), (21, ""), (22, sentence(30, 77)), (0, texts[0][1]), (None, sentence(20, 5)), (23, sentence(20, 2)[:-4])]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").selectExpr("*", "'x' item_id", "1 h")
    benchmark = spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "5 n_words")
    want = []
    for d, t in texts:
        for i, x in items:
            words = passage_words(x)
            if len(words) >= 5 and t:
                distance = edit_distance(words, passage_words(t))
                if distance <= len(words) // 5:
                    want.append((d, i, distance))
    key = lambda x: (x[0] is None, x)
    for slab in (20_000, 3):
        found = benchmark_passages(docs, benchmark, slab=slab).collect()
        assert sorted([(r.doc_id, r.item_id, r.distance) for r in found], key=key) == sorted(want, key=key)
    kept = drop_contaminated(docs, benchmark, slab=5)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [20, 21, 22]
    assert benchmark_passages(docs, benchmark.limit(0)).count() == 0
    assert benchmark_passages(docs.limit(0), benchmark).count() == 0


@pytest.mark.parametrize("block,query_block", [(8192, 2048), (300, 17)])
def test_neighbours_reach_recall(spark, block, query_block):
    rng = np.random.default_rng(9)
    centres = rng.standard_normal((30, 24))
    vectors = (centres[rng.integers(0, 30, 1500)] + 0.7 * rng.standard_normal((1500, 24))).astype(np.float32)
    vectors[700:760] = vectors[40]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id bigint, embedding array<float>")
    found = nearest_neighbours(df, block=block, query_block=query_block).collect()
    exact, hits = vectors.astype(np.float64), 0
    by_query = {}
    for r in found:
        by_query.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(by_query) == set(range(0, 1500, 20))
    for q, own in by_query.items():
        own.sort()
        assert [r for r, _, _ in own] == list(range(1, 21))
        assert [(-s, v) for _, v, s in own] == sorted((-s, v) for _, v, s in own)
        score = exact @ exact[q]
        assert np.allclose([s for _, _, s in own], score[[v for _, v, _ in own]])
        score[q] = -np.inf
        true = np.lexsort((np.arange(1500), -score))[:20]
        hits += len(set(true) & {v for _, v, _ in own})
    assert hits / (20 * len(by_query)) >= 0.95


def test_neighbours_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [None, 1.0]), (6, [inf, 1.0]),
            (7, [1.0, 0.0]), (7, [1.0, 0.0]), (20, [0.5, 0.5]), (21, []), (22, [1.0]), (40, [2.0]), (None, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").selectExpr("*", "1 width", "2 rank")
    found = {tuple(r) for r in nearest_neighbours(df).collect()}
    assert found == {(0, 1, 1, 1.0), (0, 2, 7, 1.0), (0, 3, 20, 0.5), (20, 1, 0, 0.5), (20, 2, 1, 0.5), (20, 3, 7, 0.5), (40, 1, 22, 2.0)}
    assert nearest_neighbours(df.limit(0)).count() == 0


def test_licences_of_own_text_and_of_folders(spark):
    mit, apache = "Released under the MIT License.", "Licensed under the Apache License, Version 2.0 (the text)"
    files = [
        ("LICENSE", mit), ("a.txt", "nothing"), ("p/LICENSE.txt", apache), ("p/q/r/x.txt", "plain\nwords"),
        ("p/q/r/y.txt", f"code\n{mit}\n{apache}"), ("pq/z.txt", None), ("p/q/empty", ""), ("p/COPYING", "license to kill and rob"),
        ("p/q/r/x.txt", "plain\nwords"), (None, mit), ("p/q/far.txt", "this licence is unlike any of the others we know of here"),
    ]
    df = spark.createDataFrame(files, "path string, text string").selectExpr("*", "1 unit", "2 license", "3 folder")
    found = {r.path: (r.license, r.origin, r.license_path) for r in scan_licenses(df).collect()}
    assert found == {
        "LICENSE": ("MIT", "notice", None), "a.txt": ("MIT", "inherited", "LICENSE"),
        "p/LICENSE.txt": ("Apache-2.0", "notice", None), "p/q/r/x.txt": ("Apache-2.0", "inherited", "p/LICENSE.txt"),
        "p/q/r/y.txt": ("MIT", "notice", None), "pq/z.txt": ("MIT", "inherited", "LICENSE"),
        "p/q/empty": ("Apache-2.0", "inherited", "p/LICENSE.txt"), "p/COPYING": ("Apache-2.0", "inherited", "p/LICENSE.txt"),
        "p/q/far.txt": ("Apache-2.0", "inherited", "p/LICENSE.txt"),
    }
    assert scan_licenses(df.limit(0)).count() == 0
    assert "Python" not in scan_licenses(df)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("n", [1, 30, 900])
def test_bisected_windows_equal_widened_ones(monkeypatch, n):
    """The width at which a query has enough collisions, without counting window by window."""
    rng = np.random.default_rng(n)
    vectors = rng.standard_normal((n, 12))
    vectors[n // 2 :: 3] = vectors[0]
    queries = np.vstack([vectors[: n // 20 + 1], 1e3 * rng.standard_normal((2, 12))])
    ids = np.arange(n) * 7
    index = collisions.SortedProjections(ids, vectors, float(np.linalg.norm(vectors, axis=1).max()))
    placed = np.empty((n, collisions.PROJECTIONS))
    rest = np.sqrt(np.maximum(0, index.largest**2 - (vectors**2).sum(axis=1)))
    placed = (np.column_stack([vectors, rest]) @ index.lines) / index.largest
    needed = int(np.ceil(collisions.COLLISIONS * collisions.PROJECTIONS))
    enough = min(n, 21 + int(collisions.VERIFIED * n + collisions.VERIFIED_ROOT * np.sqrt(n)))
    monkeypatch.setattr(collisions.np, "bincount", None)
    asked = np.r_[ids[: len(queries) - 2], [-1, -2]]
    for (found, score), q, own in zip(index.nearest(asked, queries, 20), queries, asked):
        gap, width = np.abs(placed - (q / np.linalg.norm(q)) @ index.lines[:-1]), collisions.FIRST
        while ((gap <= width).sum(axis=1) >= needed).sum() < enough:
            width *= collisions.GROWTH
        near = np.flatnonzero(((gap <= width).sum(axis=1) >= needed) & (ids != own))
        exact = vectors[near] @ q
        want = near[np.lexsort((near, -np.round(exact, 9)))[:20]]
        assert found.tolist() == ids[want].tolist() and np.allclose(score, vectors[want] @ q)
