"""Vector codes against plain comparison with every entry."""

import hashlib
import math

import numpy as np
import pytest

from labmart.llm.orchard import Codebook, compress_vectors, integers, label_errors, part_bounds


def plain(rows, parts=8, entries=16, rounds=6):
    """Codes, errors and codebooks of (id, vector) rows of one length, in Python integers."""
    kept = [(i, [math.floor(4096 * x) for x in v]) for i, v in rows]
    cuts = part_bounds(len(kept[0][1]), parts)
    books = [[v[a:b] for _, v in sorted(kept)[:entries]] for a, b in cuts]

    def assign():
        out = []
        for _, v in kept:
            own = []
            for (a, b), book in zip(cuts, books):
                gaps = [sum((x - y) ** 2 for x, y in zip(v[a:b], e)) for e in book]
                own.append((gaps.index(min(gaps)), min(gaps)))
            out.append(own)
        return out

    for _ in range(rounds):
        used = assign()
        for p, (a, b) in enumerate(cuts):
            for e in range(len(books[p])):
                own = [v[a:b] for (_, v), u in zip(kept, used) if u[p][0] == e]
                if own:
                    books[p][e] = [sum(c) // len(own) for c in zip(*own)]
    final = assign()
    return {i: ("".join(f"{e:02x}" for e, _ in u), sum(g for _, g in u)) for (i, _), u in zip(kept, final)}, books


@pytest.mark.parametrize("spread", [3, 40, 1 << 40])
def test_search_equals_comparing_all(spread):
    rng = np.random.default_rng(spread)
    for k in (1, 2, 16, 40):
        table = rng.integers(-spread, spread, (k, 3))
        table[k // 2] = table[0]
        vectors = rng.integers(-spread, spread, (300, 3)).astype(object if spread > 1 << 20 else np.int64)
        entry, gap = Codebook(table.tolist()).nearest(vectors)
        for v, e, g in zip(vectors, entry, gap):
            gaps = [sum((int(x) - int(y)) ** 2 for x, y in zip(v, t)) for t in table]
            assert g == min(gaps) and e == gaps.index(min(gaps))


def test_integers_go_down():
    assert integers(np.array([[0.0, -0.0001, 1.5, -1.5]])).tolist() == [[0, -1, 6144, -6144]]
    assert integers(np.array([[1e6, -1e6, 1e300]])).tolist() == [[4096 * 10**6, -4096 * 10**6, 1 << 62]]


@pytest.mark.parametrize("n,width,scale", [(400, 16, 1.0), (9, 24, 1.0), (60, 11, 1.0), (50, 16, 1e5)])
def test_codes_equal_plain(spark, n, width, scale):
    rng = np.random.default_rng(n)
    vectors = (scale * rng.standard_normal((n, width))).astype(np.float32)
    vectors[n // 2 :: 7] = vectors[1]
    rows = [(3 * i + 1, v.tolist(), i % 3 if i % 5 else None) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").repartition(5)
    codes, books = compress_vectors(df)
    want, want_books = plain([(i, v) for i, v, _ in rows])
    found = label_errors(codes).collect()
    assert {r.vec_id: (r.code, r.error) for r in found} == want and len(found) == n
    assert books[width] == want_books
    for r in found:
        assert r.label_error == sum(want[i][1] for i, _, label in rows if label == r.label)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (0, [0.5, 0.0]), (2, None), (3, [nan, 1.0]), (4, [None, 1.0]), (5, [inf, 1.0]), (6, []),
            (7, [1.0]), (7, [1.0]), (None, [1.0, 1.0]), (8, [1e38, 0.0]), (9, [-1e38, 0.0]), (10, [3e38, 0.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").selectExpr("*", "'x' code", "1 error", "2 part")
    codes, books = compress_vectors(df, entries=4)
    found = label_errors(codes).collect()
    assert sorted(-1 if r.vec_id is None else r.vec_id for r in found) == [-1, 0, 0, 6, 7, 7, 8, 9, 10]
    assert set(books) == {0, 1, 2} and [len(b) for b in books[2]] == [4] * 8
    by_id = {r.vec_id: r for r in found}
    assert by_id[6].code == "00" * 8 and by_id[6].error == 0 and by_id[7].error == 0
    far = {r.vec_id: r for r in label_errors(compress_vectors(df, entries=1, rounds=0)[0]).collect()}
    assert far[8].error is None and far[9].label_error is None and far[None].error == 2**24 + 2**22
    assert label_errors(compress_vectors(df.limit(0))[0]).count() == 0


def test_digest_is_of_decimals():
    from labmart.llm.orchard import codebooks_digest

    assert codebooks_digest([[[1, -2]], [[3]]]) == hashlib.sha256(b"1,-2,3").hexdigest()
