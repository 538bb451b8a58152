import random
from collections import defaultdict

import numpy as np
import pytest

from adloom.llm import suffixes
from adloom.llm.suffixes import Levels, remove_repeats


def brute(rows, length):
    least = defaultdict(lambda: 1 << 62)
    data = [(t or "").encode() for _, t in rows]
    key = [d if d is not None else 1 << 61 for d, _ in rows]
    for d, x in zip(key, data, strict=True):
        for i in range(len(x) - length + 1):
            least[x[i : i + length]] = min(d, least[x[i : i + length]])
    out = []
    for (doc, _), d, x in zip(rows, key, data, strict=True):
        gone = [False] * len(x)
        for i in range(len(x) - length + 1):
            if least[x[i : i + length]] < d:
                gone[i : i + length] = [True] * length
        edges = [i for i, (a, b) in enumerate(zip([False, *gone], [*gone, False], strict=True)) if a != b]
        spans = list(zip(edges[::2], edges[1::2], strict=True))
        out.append((doc, len(x), spans, bytes(b for b, g in zip(x, gone, strict=True) if not g)))
    return sorted(out, key=repr)


def corpus(seed):
    rng = random.Random(seed)
    letters = "abcé \n"
    part = lambda n: "".join(rng.choice(letters) for _ in range(n))
    shared = [part(n) for n in (20, 45, 50, 51, 80, 300, 2000)] + ["a" * 120, "ab" * 100]
    texts = [None, "", "x", "a" * 49, "a" * 50, "a" * 51, part(6000)]
    for _ in range(90):
        texts.append("".join(rng.choice(shared) if rng.random() < 0.4 else part(rng.randrange(90)) for _ in range(4)))
    texts += [texts[12]] * 5
    ids = rng.sample(range(-50, 900), len(texts))
    return list(zip(ids, texts, strict=True)) + [(ids[5], texts[9]), (None, texts[12]), (None, texts[12]), (None, None)]


@pytest.mark.parametrize(("length", "batch", "piece"), [(50, 3000, 1 << 19), (50, 1 << 20, 700), (33, 2000, 1 << 19), (300, 4000, 2000)])
def test_equals_every_window(spark, monkeypatch, length, batch, piece):
    monkeypatch.setattr(suffixes, "PIECE", piece)
    rows = corpus(length + batch)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = remove_repeats(df, length=length, batch_bytes=batch).collect()
    got = sorted(((r["doc_id"], r["n_bytes"], [tuple(s) for s in r["spans"]], bytes(r["kept"])) for r in got), key=repr)
    assert got == brute(rows, length)


def test_edges(spark):
    df = spark.createDataFrame([(1, None, 2, "z"), (2, "", 3, "y")], "doc_id long, text string, batch int, kept string")
    assert sorted(map(tuple, remove_repeats(df).collect())) == [(1, 0, [], b""), (2, 0, [], b"")]
    assert remove_repeats(df.limit(0)).collect() == []


def test_levels_merge_geometrically():
    family, rng, seen = Levels(), np.random.default_rng(0), set()
    for _ in range(64):
        keys = np.unique(rng.integers(0, 5000, 40).astype(np.uint64))
        assert family.holds(keys).tolist() == [int(k) in seen for k in keys]
        family.add(keys)
        seen |= set(map(int, keys))
    sizes = list(map(len, family.levels))
    assert len(sizes) <= 8 and all(a >= 2 * b for a, b in zip(sizes, sizes[1:], strict=False))
