"""Flat byte arrays against plain Python."""

import re

import numpy as np
import pyarrow as pa

from logloom.llm import flat

TEXTS = ["a bb  c\n", None, "", "é ñ\x0bx", "  ", "same same", "x" * 5000]


def joined(limit=0):
    return list(flat.blocks(pa.array(TEXTS), limit))


def test_words_and_hashes():
    for limit in (1, 0):
        seen = {}
        for first, end, texts in joined(limit):
            starts, ends, docs = texts.spans(flat.SPACE)
            for s, e, d, h in zip(starts, ends, docs, texts.hashes(starts, ends).tolist()):
                word = texts.data[s:e].tobytes()
                assert seen.setdefault(h, word) == word
                seen.setdefault((first + d, "words"), []).append(word.decode())
        for i, text in enumerate(TEXTS):
            assert seen.get((i, "words"), []) == re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_code_points_and_slices():
    column = pa.array(["skip", *TEXTS]).slice(1)
    (_, _, texts), = flat.blocks(column, 1 << 20)
    assert texts.code_points().tolist() == [len(t or "") for t in TEXTS]
    assert [texts.text(i).decode() for i in range(texts.n)] == [t or "" for t in TEXTS]


def test_windows_stay_inside_a_text():
    _, first = flat.windows(np.arange(6, dtype=np.uint64), np.array([0, 0, 0, 1, 1, 1]), 2)
    assert first.tolist() == [0, 1, 3, 4]


def test_long_texts_have_own_powers():
    up, down = flat.powers(4 * flat.BLOCK_BYTES + 10)
    with np.errstate(over="ignore"):
        assert (up * down == 1).all()
