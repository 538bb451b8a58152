import re

import numpy as np
import pyarrow as pa
import pytest

from adloom.llm import words as w

TEXTS = ["", None, "one Two  three", "\n", "x" * 100, "a b " * 50, " é one", "two", " one", "y " + "z" * 70 + " y"]


@pytest.mark.parametrize("piece", [1 << 21, 16, 40])
def test_words_are_those_of_the_rule(monkeypatch, piece):
    monkeypatch.setattr(w, "PIECE", piece)
    data, at = w.text_buffer(pa.array(TEXTS, pa.string()))
    hashes, first, end, starts = w.words(data, at)
    assert len(starts) == len(TEXTS) + 1
    seen = {}
    for i, text in enumerate(TEXTS):
        raw = (text or "").encode()
        want = [m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", raw)]
        own = slice(starts[i], starts[i + 1])
        got = list(zip((first[own] - at[i]).tolist(), (end[own] - at[i]).tolist(), strict=True))
        assert got == want
        for (a, b), h in zip(want, hashes[own].tolist(), strict=True):
            assert seen.setdefault(raw[a:b], h) == h
    assert len(set(seen.values())) == len(seen)


def test_lower_case_and_shingles():
    data, at = w.text_buffer(pa.array(["A b C", "a B c d", "b c"]).slice(0, 3))
    hashes, _, _, starts = w.words(data, at, w.BLANKS, w.LOWER)
    found, whole = w.shingles(hashes, starts, 2)
    assert whole.tolist() == [True, True, False, True, True, True, False, True, False]
    assert found[0] == found[3] and found[1] == found[4] == found[7] and found[5] not in (found[0], found[1])
    assert len(w.shingles(hashes[:1], np.array([0, 1]), 5)[0]) == 1


def test_slices_and_batches():
    column = pa.array(["a", "bb", None, "ccc"])
    data, at = w.text_buffer(column.slice(1, 3))
    assert data.tobytes() == b"bbccc" and at.tolist() == [0, 2, 2, 5]
    batch = pa.RecordBatch.from_arrays([column], names=["t"])
    assert [b.num_rows for b in w.batches(iter([batch]), rows=3)] == [3, 1]
