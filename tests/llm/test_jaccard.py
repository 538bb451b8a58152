import random
import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
from brute import jaccard_components  # noqa: E402

from adloom.llm import jaccard  # noqa: E402
from adloom.llm.components import connected_components  # noqa: E402


def corpus(seed, groups=12):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    line = " ".join(rng.choice(vocab) for _ in range(12))
    texts = [None, "", "  \n", "one two", "ONE Two", "one two three", line, line.upper()]
    for _ in range(groups):
        base = [rng.choice(vocab) for _ in range(rng.choice([8, 30, 80, 200]))]
        for _ in range(rng.choice([1, 2, 5, 20])):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4, 8])):
                own[rng.randrange(len(own))] = rng.choice(vocab)
            # A line that many share, and a chain of growing versions.
            texts.append(" ".join(own) + (" \n" + line if rng.random() < 0.5 else ""))
        for i in range(0, 30, 3):
            texts.append(" ".join(base[: max(1, len(base) - i)]))
    rng.shuffle(texts)
    return [(i * 3, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize(("k", "num", "small", "block"), [(4, 85, 8, 4096), (5, 80, 2, 7), (4, 85, 1, 3)])
def test_equals_all_pairs(spark, monkeypatch, k, num, small, block):
    monkeypatch.setattr(jaccard, "SMALL_LIST", small)
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "COMMON", 8)
    rows = corpus(num + small)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [tuple(r) for r in jaccard.near_duplicates(df, k=k, num=num, den=100).collect()]
    assert sorted(got, key=lambda r: tuple(map(str, r))) == jaccard_components(rows, k, num, 100)


def test_edges(spark):
    rows = [(1, "a b c d e"), (1, "a b c d e"), (None, "a b c d e"), (0, "x"), (2, None), (None, "y z"), (5, "Y Z")]
    df = spark.createDataFrame([(*r, 9, "q") for r in rows], "doc_id long, text string, node int, component_id string")
    got = [tuple(r) for r in jaccard.near_duplicates(df).collect()]
    assert sorted(got, key=lambda r: tuple(map(str, r))) == jaccard_components(rows, 5, 80, 100)
    assert jaccard.near_duplicates(df.limit(0)).collect() == []



@pytest.mark.parametrize("seed", [1, 2])
def test_near_copies_without_an_id(spark, seed):
    rows = [(None if i % 3 else doc, text) for i, (doc, text) in enumerate(corpus(seed))]
    base = [f"v{i}" for i in range(100)]
    texts = [[*(f"x{n}" for n in range(i)), *base[i:]] for i in (0, 7, 14)]
    rows += [(9000, " ".join(texts[0])), (None, " ".join(texts[1])), (9001, " ".join(texts[2]))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [tuple(r) for r in jaccard.near_duplicates(df, k=4, num=80, den=100).collect()]
    assert sorted(got, key=lambda r: tuple(map(str, r))) == jaccard_components(rows, 4, 80, 100)
    assert {c for doc, _, c in got if doc in (9000, 9001)} == {9000}


def test_components(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 140)] + [(7, 7), (None, 3), (200, 201)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(chain, "x long, y long")).collect()}
    want = {i: 0 for i in range(61)} | {i: 100 for i in range(100, 140)} | {200: 200, 201: 200}
    assert got == want
    assert connected_components(spark.createDataFrame([], "x long, y long")).collect() == []


def test_parities_bound_what_two_sets_share():
    import numpy as np

    rng = np.random.default_rng(2)
    pruned = 0
    for _ in range(300):
        pool = rng.integers(0, 1 << 63, 400).astype(np.uint64) * np.uint64(2)
        a, b = (np.unique(rng.choice(pool, rng.integers(1, 300))) for _ in range(2))
        shared = len(np.intersect1d(a, b))
        x, y = (np.frombuffer(jaccard._parities(s), np.uint64) for s in (a, b))
        bound = (len(a) + len(b) - int(np.bitwise_count(x ^ y).sum())) // 2
        assert shared <= bound
        pruned += bound < min(len(a), len(b))
    assert pruned > 100


def test_buckets_grow_with_the_entries(spark, monkeypatch):
    """A group of the join holds about as many entries whatever the size of the table."""
    df = spark.createDataFrame(corpus(4), "doc_id long, text string").repartition(2)
    made = []

    class Seen(Exception):
        pass

    def prefixes(*args):
        made.append(args)
        raise Seen

    original = jaccard._prefixes
    monkeypatch.setattr(jaccard, "_prefixes", prefixes)
    for most in (1_000_000, 10):
        monkeypatch.setattr(jaccard, "BUCKET_ENTRIES", most)
        with pytest.raises(Seen):
            jaccard.near_duplicates(df, k=4, num=85, den=100)
    few, many = (args[-1] for args in made)
    assert many > 2 * few

    def entries(args):
        parts = [np.frombuffer(r["entries"], np.int64).reshape(3, -1) for r in original(*args).collect()]
        return sorted(map(tuple, np.concatenate(parts, axis=1).T.tolist()))

    whole = entries(made[0])
    assert few * 10 < 2 * len(whole) < 4 * many * 10
    monkeypatch.setattr(jaccard, "PACK_ENTRIES", 300)
    assert entries(made[1]) == whole
