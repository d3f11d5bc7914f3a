"""Learned operators on held-out rows, edge rows and against plain computations."""

import collections
import math
import zlib

import numpy as np
import pytest

from labmart.llm.langid import codewords, gram_counts, identify_language, keep_known_language
from labmart.llm.pitman_yor import score_language_model, seat
from labmart.llm.quality import keep_good, score_quality

SOUND = {"aa": "kato mira lupo sena", "bb": "strch brnt wulk grimpf", "cc": "où ça déjà éléve"}


def document(lang, i):
    parts = SOUND[lang].split()
    return " ".join(parts[(i * k + k) % len(parts)] + parts[(i + k) % len(parts)][:2] for k in range(1, 9 + i % 30))


def test_codewords_keep_apart():
    for n in (1, 2, 3, 4, 5, 9, 40):
        code = codewords(n)
        assert code.shape[0] == n and set(np.unique(code)) <= {-1, 1}
        assert len({tuple(r) for r in code}) == n
        if n > 1:
            assert (np.abs(code.sum(axis=0)) < n).all()


def test_counts_do_not_depend_on_chunks(monkeypatch):
    from labmart.llm import langid

    texts = ["Été 12, à la plage... " * 40, "", " ", "a", "  , " * 50, "ab" * 60]
    whole = [gram_counts(t) for t in texts]
    plain = " ab cd ".encode()
    assert gram_counts("ab, cd").sum() == sum(len(plain) - n + 1 for n in langid.ORDERS)
    for chunk in (1, 2, 3, 7, 50):
        monkeypatch.setattr(langid, "CHUNK", chunk)
        assert all((gram_counts(t) == w).all() for t, w in zip(texts, whole))


def test_language_of_held_out_rows(spark):
    rows = [(i, document(lang, i), lang) for i, lang in enumerate(list(SOUND) * 60)]
    odd = [(1000, None, "aa"), (1001, "", "bb"), (1002, "123 !!", None), (None, document("aa", 3), None), (0, rows[0][1], "aa")]
    docs = spark.createDataFrame(rows + odd, "doc_id bigint, text string, lang string").selectExpr("*", "1 score", "'z' lang_pred")
    found = identify_language(docs).collect()
    assert len(found) == len(rows) + len(odd)
    truth = {i: lang for i, _, lang in rows}
    for r in found:
        assert r.held_out == (zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1
        if r.doc_id in truth:
            assert r.lang_pred == truth[r.doc_id]
        elif r.doc_id is not None:
            assert r.lang_pred == "und" and r.ambiguous
    kept = keep_known_language(docs)
    assert kept.columns == docs.columns and kept.count() == len(rows) + 2
    assert {r.lang_pred for r in identify_language(docs.where("lang = 'q'")).collect()} == set()
    nothing = identify_language(docs.withColumn("lang", docs["lang"].substr(9, 1)).where("lang IS NULL"))
    assert {r.lang_pred for r in nothing.collect()} <= {"und"}
    assert {r.lang_pred for r in identify_language(docs.where("lang = 'aa' AND doc_id < 900")).collect()} == {"aa"}


def test_quality_of_held_out_rows(spark):
    good = lambda i: f"A plain sentence number {i} stands here. " * (1 + i % 5)
    bad = lambda i: f"BUY!!! NOW### {i} $$$ " * (1 + i % 7)
    rows = [(i, good(i) if i % 3 else bad(i)) for i in range(240)] + [(900, None), (901, ""), (None, good(1)), (1, good(1))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 quality", "0.0 score")
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(240)] + [(5, None, 0), (7777, 1, 0)], "doc_id bigint, quality int, toxic int")
    found = score_quality(docs, labels).collect()
    assert len(found) == len(rows)
    for r in found:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        if r.doc_id is not None and r.doc_id < 900:
            assert r.predicted == int(r.doc_id % 3 > 0)
    kept = keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect() if r.doc_id is not None and r.doc_id < 900} == {i for i in range(240) if i % 3}
    unlabelled = score_quality(docs, labels.limit(0)).collect()
    assert {(r.score, r.predicted) for r in unlabelled} == {(0.5, 1)}
    assert score_quality(docs.limit(0), labels).count() == 0


def test_seating_follows_the_restaurant(monkeypatch):
    n, d, new = 60, 0.6, 1.5
    want, chance = 0.0, {1: 1.0}
    for i in range(1, n):
        step = collections.Counter()
        for t, p in chance.items():
            open_ = new / (i - d * t + new)
            step[t + 1] += p * open_
            step[t] += p * (1 - open_)
        chance = step
    want = sum(t * p for t, p in chance.items())
    got = seat(np.full(20000, n), np.full(20000, new), d, np.random.default_rng(1)).mean()
    assert got == pytest.approx(want, rel=0.03)
    assert list(seat(np.array([0, 1, 2]), np.zeros(3), d, np.random.default_rng(1))) == [0, 1, 1]


@pytest.mark.parametrize("chunk", [1 << 21, 50])
def test_language_model_counts_and_chances(spark, chunk):
    rows = [(i, " ".join(SOUND["aa"].split()[(i + k * k) % 4] for k in range(3 + i % 20)) + f" rare{i % 9}") for i in range(150)]
    rows += [(500, None), (501, ""), (502, "Zürich  \t zürich ZÜRICH"), (None, "kato mira"), (3, rows[3][1])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "'x' data", "0 chunk")
    found = score_language_model(docs, chunk_tokens=chunk).collect()
    assert len(found) == len(rows)
    words = lambda t: ((t or "").encode().lower().split()) + [b"\n"]
    held = lambda i: zlib.crc32(str("" if i is None else i).encode()) % 7 == 2
    count = collections.Counter(w for i, t in rows if not held(i) for w in words(t))
    total, types = sum(count.values()), len(count)
    texts = dict(rows)
    out = []
    for r in found:
        own = words(texts[r.doc_id])
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held(r.doc_id), len(own), total)
        assert r.n_known == sum(w in count for w in own)
        assert r.base_score == pytest.approx(sum(math.log10((count[w] + 1) / (total + types + 1)) for w in own), rel=1e-12)
        assert r.score < 0 and r.perplexity == pytest.approx(10 ** (-r.score / r.n_tokens))
        out += [(r.score - r.base_score) / r.n_tokens] if r.held_out and r.n_known == r.n_tokens else []
    assert np.mean(out) > 0
    assert score_language_model(docs.limit(0)).count() == 0
    untrained = score_language_model(docs.where("doc_id = 502"), held=zlib.crc32(b"502") % 7).first()
    assert untrained.train_tokens == untrained.n_known == 0 and untrained.base_score == 0


def test_chances_of_all_words_sum_to_one(spark):
    """One-word texts: after the start, known words and the unknown word share probability 1."""
    known = [f"k{i % 12}" for i in range(140)]
    rows = [(i, w) for i, w in enumerate(known)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    train = {w for i, w in rows if zlib.crc32(str(i).encode()) % 7 != 2}
    probe = [(1000 + i, w) for i, w in enumerate([*sorted(train), "never"])]
    probe = [(i, w) for i, w in probe]
    held = next(h for h in range(7) if h == 2)
    # Probes join the held-out fold by ids of that fold.
    ids = (i for i in range(10_000, 99_999) if zlib.crc32(str(i).encode()) % 7 == held)
    probe = [(next(ids), w) for _, w in probe]
    asked = docs.union(spark.createDataFrame(probe, docs.schema)).union(
        spark.createDataFrame([(next(ids), None)], docs.schema)
    )
    found = {r.doc_id: r.score for r in score_language_model(asked).collect()}
    # A text's chance is word after start, times end after word; starts share one context.
    total = sum(10 ** found[i] for i, _ in probe)
    empty = [10 ** s for i, s in found.items() if i not in dict(rows) and i not in dict(probe)][0]
    assert 0 < total + empty <= 1.0001


def test_whole_word_before_is_the_context(spark):
    """Words that end alike are contexts of their own: what follows one is not likelier after the other."""
    pairs = [("bulmato", "sun"), ("kirvato", "moon"), ("dorgato", "star")]
    rows = [(i, f"{a} {b}") for i, (a, b) in enumerate(pairs * 60)]
    ids = [i for i in range(10_000, 20_000) if zlib.crc32(str(i).encode()) % 7 == 2]
    asked = [(next(iter(ids[k : k + 1])), f"{a} {b}") for k, (a, b) in enumerate((x, y) for x, _ in pairs for _, y in pairs)]
    found = {r.doc_id: r.score for r in score_language_model(spark.createDataFrame(rows + asked, "doc_id bigint, text string")).collect()}
    texts = {t: found[i] for i, t in asked}
    for a, b in pairs:
        assert all(texts[f"{a} {b}"] > texts[f"{a} {other}"] + 1 for _, other in pairs if other != b)


def test_cells_are_exchanged_unstored_and_contexts_named_once(spark, monkeypatch):
    """Only chunks of word numbers are stored before cells meet; later sweeps send counts alone."""
    from labmart.llm.common import Work

    size, keep = {}, Work.keep

    def measured(self, df, table, *a, **b):
        kept = keep(self, df, table, *a, **b)
        binary = [c for c, kind in kept.dtypes if kind == "binary"]
        size[table] = sum(sum(len(x) for x in r if x is not None) for r in kept.select(*binary).collect())
        return kept

    monkeypatch.setattr(Work, "keep", measured)
    rng = np.random.default_rng(5)
    rows = [(i, " ".join(f"w{x}" for x in rng.integers(0, 3000, 100))) for i in range(400)]
    assert score_language_model(spark.createDataFrame(rows, "doc_id bigint, text string")).count() == len(rows)
    before_cells = [size[t] for t in list(size)[: list(size).index("cells")]]
    assert sum(before_cells) < 6 * 40_000
    assert size["seats1"] < size["seats0"] / 4 and size["totals1"] < size["totals0"] / 2
