"""Token files, packing and shards by exact round trips."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from labmart.llm import elias_fano, packing
from labmart.llm.common import Work
from labmart.llm.packing import InvertedIndex, pack_documents
from labmart.llm.shards import longest_first, shard_by_bytes
from labmart.llm.token_blocks import TokenBlock, pack_block, read_token_digests, write_token_blocks
from labmart.llm.tokens import Encoder

BYTE, WORD = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
ODD = ["", "a", "a  b", " x", "x ", "<|endoftext|> it's 's", "Ünï é ß ﬁ Σας İ", "日本 text", "tab\tq  w", "foo. Bar,\nbaz!?", "a\n\nb c\n"]
ROWS = [(i, f"Word{i} and {'more ' * (i % 40)}text of {i % 7}.\nLine {i}") for i in range(120)]
ROWS += [(200 + i, t) for i, t in enumerate(ODD)]
ROWS += [(300, None), (301, "long text here " * 3000), (5, "again"), (5, "again"), (-9, "below zero"), (None, "no id"), (None, None)]


@pytest.fixture
def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id bigint, text string").selectExpr("*", "1 part", "'p' tie", "2 known", "0 near")


@pytest.mark.parametrize("n,top", [(0, 0), (1, 0), (5, 3), (1000, 10), (3000, 10**6), (777, 2**50)])
def test_elias_fano_round_trip(n, top):
    values = np.sort(np.random.default_rng(n).integers(0, top + 1, n)).astype(np.uint64)
    coded = elias_fano.EliasFano(b"xx" + elias_fano.encode(values), 2)
    assert list(coded.all()) == list(values) == [coded.select(i) for i in range(n)]
    with pytest.raises(IndexError):
        coded.select(n)
    if n == 3000:
        assert len(elias_fano.encode(values)) * 8 < n * (2 + 9 + 1) + 800


def test_block_round_trip():
    block = TokenBlock(pack_block([None, 3, 3, 9], [np.array(x) for x in ([1, 2], [5], [7, 8, 9], [1])], 2))
    assert [(block.doc_id(i), block.start(i), block.document(i).tolist()) for i in range(4)] == [
        (None, 0, [1, 2]), (3, 2, [5]), (3, 3, [7, 8, 9]), (9, 6, [1])
    ]
    with pytest.raises(ValueError):
        TokenBlock(b"\0" * 64)


@pytest.mark.parametrize("path,style", [(BYTE, "byte"), (WORD, "word"), (BYTE, None)])
def test_encoder_equals_the_library(path, style):
    rng, letters = random.Random(3), "ab.,!\n '9é×\t<Ā"
    texts = ODD + ["".join(rng.choice(letters) for _ in range(rng.randint(1, 14))) for _ in range(1500)]
    own, library = Encoder(path, style), Tokenizer.from_file(path)
    library.encode_special_tokens = True
    for text, ids in zip(texts, own.encode(texts)):
        assert library.encode(text, add_special_tokens=False).ids == ids.tolist(), text


def encoded(path, end):
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return [(i, np.array([*t.encode(x or "", add_special_tokens=False).ids, end], "<u4")) for i, x in ROWS]


@pytest.mark.parametrize("block", [1 << 21, 100])
def test_token_files_read_back(spark, docs, block):
    blocks = write_token_blocks(docs, Work(spark, "test"), WORD, "word", 1, block_ids=block)
    found = sorted(read_token_digests(blocks).collect(), key=lambda r: r.start)
    assert len(found) == len(ROWS)
    ids = [r.doc_id for r in found]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))
    want = {}
    for i, x in encoded(WORD, 1):
        want.setdefault(i, []).append((len(x), zlib.crc32(x.tobytes())))
    place = 0
    for r in found:
        assert r.start == place
        place += r.n_tokens
        want[r.doc_id].remove((r.n_tokens, r.ids_crc32))
    assert not any(want.values())
    assert read_token_digests(write_token_blocks(docs.limit(0), Work(spark, "test"), WORD, "word", 1)).count() == 0


def test_inverted_index_scores_bm25():
    docs = [np.array(x) for x in ([1, 2, 2, 3], [2, 3, 4], [9], [1, 1, 1, 5, 6])]
    got = InvertedIndex(docs).scores(0)
    mean = np.mean([len(d) for d in docs])
    for j, d in enumerate(docs):
        want = 0.0
        for term in {1, 2, 3}:
            df = sum(term in x for x in docs)
            tf = int((d == term).sum())
            want += np.log1p((4 - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(d) / mean))
        assert got[j] == pytest.approx(want)


@pytest.mark.parametrize("window,shard", [(1024, 1024), (64, 16)])
def test_packed_pieces_cover_every_id_once(docs, window, shard):
    found = pack_documents(docs, BYTE, "byte", window=window, shard=shard).toPandas()
    want = {}
    for i, x in encoded(BYTE, 0):
        want.setdefault(i, []).append(x)
    for i, xs in want.items():
        own = found[found.doc_id.isna() if i is None else found.doc_id == i]
        assert own.length.sum() == sum(map(len, xs))
        if len(xs) == 1:
            own, place = own.sort_values("start"), 0
            for p in own.itertuples():
                assert (p.start, p.doc_tokens) == (place, len(xs[0]))
                assert p.ids_crc32 == zlib.crc32(xs[0][place : place + p.length].tobytes())
                place += p.length
    full = found.groupby("sequence_id").length.sum()
    assert full.max() <= window and sorted(full.index) == list(range(len(full)))
    assert (full < window).sum() <= 16
    for _, g in found.sort_values("offset").groupby("sequence_id"):
        assert list(g.offset) == [0, *np.cumsum(g.length)[:-1]]
    assert pack_documents(docs.limit(0), BYTE, "byte").count() == 0


def test_longest_first_beats_no_bound():
    sizes = [7, 7, 6, 6, 5, 5, 4, 4, 4]
    load = np.bincount(longest_first(sizes, 3), sizes)
    assert load.max() <= 4 / 3 * 16


@pytest.mark.parametrize("shards,fineness", [(40, 256), (3, 2)])
def test_shards_are_even_and_keep_groups(spark, docs, shards, fineness):
    more = docs.select("doc_id", "text").union(
        spark.range(500).selectExpr("1000 + id", "concat('text ', id % 90, repeat(' x', cast(id % 90 as int)))")
    )
    rows = more.collect()
    found = shard_by_bytes(more, shards, fineness).collect()
    assert len(found) == len(rows)
    texts = {}
    for r in rows:
        texts.setdefault(r.doc_id, r.text)
    size = lambda t: len((t or "").encode()) + 16
    assert sorted(r["size"] for r in found) == sorted(size(r.text) for r in rows)
    by_text, load, slots = {}, {}, {}
    for r in found:
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
        by_text.setdefault((r.text_crc32, r["size"]), set()).add(r.shard)
        load[r.shard] = load.get(r.shard, 0) + r["size"]
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(len(s) == 1 for s in by_text.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    groups = {}
    for r in rows:
        groups[r.text or ""] = groups.get(r.text or "", 0) + size(r.text)
    share = sum(groups.values()) / shards
    assert max(load.values()) <= max(share + max(share / fineness * 3, 2 * sorted(groups.values())[-2]), max(groups.values()))
    assert shard_by_bytes(docs.limit(0)).count() == 0


def test_best_first_sorts_only_what_is_asked_for(monkeypatch):
    rng = np.random.default_rng(4)
    for n in (0, 1, 64, 65, 500, 1000):
        score, left = rng.integers(0, 9, 1000).astype(float), np.sort(rng.choice(1000, n, replace=False))
        assert list(packing.best_first(score, left)) == left[np.argsort(-score[left], kind="stable")].tolist()
    sorted_sizes, plain = [], np.argsort
    monkeypatch.setattr(packing.np, "argsort", lambda x, **k: sorted_sizes.append(len(x)) or plain(x, **k))
    next(packing.best_first(np.arange(1000.0), np.arange(1000)))
    assert sorted_sizes == [17]


def test_index_is_built_without_a_sort_for_each_document(monkeypatch):
    rng, sorts = np.random.default_rng(4), []
    docs = [rng.integers(0, 300, n + 1) for n in range(60)]
    unique = np.unique
    monkeypatch.setattr(packing.np, "unique", lambda *a, **k: sorts.append(1) or unique(*a, **k))
    index = InvertedIndex(docs)
    assert not sorts
    for d, terms in zip(docs, index.terms):
        assert len(terms) == len(unique(d))
    assert sum(index.df) == sum(len(unique(d)) for d in docs)
