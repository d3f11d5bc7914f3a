"""Fingerprints, links and classes against brute force."""

import itertools
import re

import pytest
import xxhash

from labmart.llm.common import Work
from labmart.llm.components import connected
from labmart.llm.simhash import (
    drop_near_copies,
    fingerprint,
    linked,
    simhash_near_duplicates,
)

WORDS = [f"w{i}x{i * 7 % 13}" for i in range(400)]


def text(n, seed=0, swap=()):
    own = [WORDS[(i * i + 31 * seed + i * seed) % 400] for i in range(n)]
    for i in swap:
        own[i] = f"new{seed}_{i}"
    return " ".join(own)


def plain(t):
    w = t.encode().lower().split() if t else []
    s = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(prints, most):
    root = {i: i for i in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, x), (b, y) in itertools.combinations(prints.items(), 2):
        if (x ^ y).bit_count() <= most:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return {i: find(i) for i in prints}


def test_fingerprint_matches_its_definition():
    for t in (None, "", " \n", "One", "one two", "One two THREE", "É é \x1f a\x0bb", text(300), "a b c a b c"):
        assert fingerprint(t) & (2**64 - 1) == plain(t)
    assert fingerprint("x y z " * 70000) & (2**64 - 1) == plain("x y z " * 70000)


def test_classes_match_brute_force(spark):
    rows = [(i, text(40 + i % 5, i % 9, [i % 3] if i % 4 else [])) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "one"), (103, "one"), (7, text(47, 7)), (None, text(40)), (None, "only here")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "'x' words", "1 component_id")
    prints = {i: plain(t) for i, t in rows if i is not None}
    found = simhash_near_duplicates(docs).collect()
    assert len(found) == len(rows)
    by_id = {}
    for i, t in rows:
        by_id.setdefault(i, set()).add(plain(t))
    for r in found:
        assert int(r.fingerprint, 16) in by_id[r.doc_id]
    if all(len(v) == 1 for k, v in by_id.items() if k is not None):
        want = classes(prints, 2)
        assert {r.doc_id: r.component_id for r in found if r.doc_id is not None} == want
    assert [r.component_id for r in found if r.fingerprint == f"{plain('only here'):016x}"] == [None]
    assert simhash_near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize("block", [256, 4])
def test_links_lose_nothing_in_blocks(spark, block):
    base, rows = 0x0123456789ABCDEF, []
    for i in range(40):
        rows.append(base ^ (1 << (i % 20)) ^ (1 << (i * 7 % 64)))
    rows += [base ^ 0xFFFF << (8 * i) for i in range(6)]
    rows = sorted(set(rows))
    signed = [x - 2**64 if x >> 63 else x for x in rows]
    prints = spark.createDataFrame([(i, [x]) for i, x in enumerate(signed)], "id bigint, words array<bigint>")
    work = Work(spark, "test")
    tied = linked(prints, [(32, 32, 1), (0, 32, 0)], 2, work, block=block)
    found = {i: i for i in range(len(rows))} | {r.node: r.component for r in tied.collect()}
    assert found == classes(dict(enumerate(rows)), 2)


def test_components_of_chains_and_hubs(spark):
    pairs = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7), (300, 200)]
    edges = spark.createDataFrame(pairs, "a bigint, b bigint")
    found = {r.node: r.component for r in connected(edges, Work(spark, "test")).collect()}
    assert found == {
        **{i: 0 for i in range(51)}, **{100 + i: 100 for i in range(60)}, 200: 200, 300: 200
    }


def test_components_of_many_small_groups(spark):
    pairs = [(1000 * g + (i * 7) % 40, 1000 * g + (i * 11 + 3) % 40) for g in range(30) for i in range(40)]
    edges = spark.createDataFrame(pairs, "a bigint, b bigint").repartition(6)
    found = {r.node: r.component for r in connected(edges, Work(spark, "test")).collect()}
    root = {i: i for p in pairs for i in p}
    for _ in root:
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    tied = {i for a, b in pairs if a != b for i in (a, b)}
    assert found == {i: r for i, r in root.items() if i in tied}


def test_near_copies_go_and_others_stay(spark):
    rows = [(10 * k + j, text(400 + k, k, swap)) for k in range(30) for j, swap in enumerate(([], [], [k + 3], [5, 90, 290]))]
    rows += [(901, "short one"), (902, "short two"), (903, None), (904, " "), (905, "one two " * 5000)]
    prints = {i: plain(t) for i, t in rows}
    want = classes(prints, 2)
    docs = spark.createDataFrame([*rows, (903, None), (None, "x"), (None, "x")], "doc_id bigint, text string")
    docs = docs.selectExpr("*", "'en' lang", "7 times", "1 kept_id", "'z' fingerprint", "2 component_id")
    kept = drop_near_copies(docs)
    assert kept.columns == docs.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=lambda x: (x is None, x))
    assert ids == [*sorted(set(want.values())), None, None]
    assert 30 <= len(set(want.values())) < len(rows) - 30 and 904 not in ids
    assert drop_near_copies(docs.limit(0)).count() == 0


def test_texts_stay_where_they_are(spark, capsys):
    """With no side small enough for a broadcast, no exchange carries the text."""
    rows = [(i, text(30, i % 50)) for i in range(2500)] + [(7, text(30, 7))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    prints = {}
    for i, t in sorted(rows):
        prints.setdefault(t, i)
    want = classes({i: plain(t) for t, i in prints.items()}, 2)
    limits = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k, None) for k in limits}
    try:
        for k in limits:
            spark.conf.set(k, "-1")
        kept = drop_near_copies(docs)
        kept.explain("formatted")
        moved = re.findall(r"\) Exchange *\nInput \[\d+\]: (.*)", capsys.readouterr().out)
        found = sorted(r.doc_id for r in kept.collect())
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert moved and not any("text#" in columns for columns in moved)
    assert found == sorted(set(want.values()))
