"""Digests of token blocks come from select, not from a decoded table."""

import zlib

import numpy as np
import pandas as pd

from labmart.llm import token_blocks


def test_digests_are_read_by_select(monkeypatch):
    ids = [np.arange(k % 5 + 1, dtype="<u2") + k for k in range(300)]
    payload = token_blocks.pack_block([None, None, *range(-3, 892, 3)][:300], ids, 2)
    monkeypatch.setattr(token_blocks.elias_fano.EliasFano, "all", None)
    rows = next(token_blocks._digest(iter([pd.DataFrame({"part": [1], "block": [0], "payload": [payload]})])))
    assert rows["n_tokens"].tolist() == [len(x) for x in ids]
    assert rows["place"].tolist() == [sum(map(len, ids[:i])) for i in range(300)]
    assert rows["doc_id"].isna().sum() == 2 and rows["doc_id"].dropna().tolist() == list(range(-3, 891, 3))
    assert rows["ids_crc32"].tolist() == [zlib.crc32(x.astype("<u4").tobytes()) for x in ids]
