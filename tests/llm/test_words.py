"""Words and windows against regular expressions."""

import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from archiveloom.llm import packing as pk
from archiveloom.llm import words as wd

TEXT = st.text(alphabet="aAbZz09 \t\n\x0b\x0c\r\x1c.,é\xa0\u3000\U0001f600", max_size=40)
CASES = [(wd.SPACE, r"[^\x20\x09-\x0D]+", False), (wd.SPACE, r"[^\x20\x09-\x0D]+", True), (wd.NON_WORD, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", True)]


@pytest.mark.parametrize("separators, pattern, lower", CASES)
@settings(deadline=None, max_examples=150)
@given(texts=st.lists(st.none() | TEXT, max_size=6), step=st.sampled_from([1, 16, 1 << 18]))
def test_words_and_windows(separators, pattern, lower, texts, step):
    held, wd.STEP_BYTES = wd.STEP_BYTES, step
    try:
        found = wd.split(pa.array(texts, pa.string()), separators, lower)
    finally:
        wd.STEP_BYTES = held
    plain = [re.sub("[A-Z]", lambda m: m[0].lower(), t or "") if lower else (t or "") for t in texts]
    want = [re.findall(pattern, t) for t in plain]
    assert list(found.counts) == [len(w) for w in want]
    flat = [w for words in want for w in words]
    seen = {}
    assert all(seen.setdefault(w, h) == h for w, h in zip(flat, found.hashes))
    assert len(set(seen.values())) == len(seen)
    for k in (1, 3):
        hashes, at = wd.windows(found, k, short=True)
        spelled = [tuple(w[i : i + k]) for w in want for i in range(max(1, len(w) - k + 1) if w else 0)]
        assert len(spelled) == len(hashes)
        groups = {}
        assert all(groups.setdefault(s, h) == h for s, h in zip(spelled, hashes))
        assert len(set(groups.values())) == len(groups)


def test_blocks_keep_rows_in_order(monkeypatch):
    monkeypatch.setattr(pk, "BLOCK_BYTES", 10)
    texts = ["a" * n for n in (3, 30, 0, 4, 4, 4, 12)] + [None]
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string())})
    tables = list(pk.blocks(iter([batch, batch]), "text"))
    assert [t for table in tables for t in table["text"].to_pylist()] == texts * 2
    assert len(tables) > 3


def test_low_bytes_round_trip():
    x = np.array([0, 1, 2**55 + 7, 2**56 - 1], np.uint64)
    assert list(pk.from_low_bytes(pk.low_bytes(x, 7), 7)) == list(x)
