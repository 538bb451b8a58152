"""Fingerprints and their components against plain versions."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from adloom.llm import simhash
from adloom.llm.simhash import Index, gray_rank, near_fingerprints, near_links, split_mask
from brute import LOWER, WORD


def plain_print(text, k=3):
    words = WORD.findall((text or "").translate(LOWER))
    shingles = [words[i : i + k] for i in range(len(words) - k + 1)] or ([words] if words else [])
    hashes = [xxhash.xxh64_intdigest(" ".join(s).encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, most=2):
    """Smallest position reachable, comparing every two."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= most:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def plain(rows):
    prints = [plain_print(t) for _, t in rows]
    roots = components(prints)
    least = {}
    for (doc, _), r in zip(rows, roots, strict=True):
        if doc is not None:
            least[r] = min(doc, least.get(r, doc))
    return sorted(((d, f"{p:016x}", least.get(r)) for (d, _), p, r in zip(rows, prints, roots, strict=True)), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def variants(rng, base, n):
    return [base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for _ in range(n)]


def test_documents_match_brute_force(spark):
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(120):
        words = rng.choices(vocabulary, k=rng.choice([1, 2, 3, 30, 200]))
        rows.append((i, " ".join(words)))
        if i % 3 == 0 and len(words) > 20:
            words[rng.randrange(len(words))] = "Changed"
            rows.append((1000 + i, "\n".join(words).upper()))
    assert got(near_fingerprints(spark.createDataFrame(rows, "doc_id bigint, text string"))) == plain(rows)


def test_odd_rows(spark):
    """Null, empty and blank texts are linked; ids may be null or repeat; columns may have the operator's names."""
    rows = [(5, None), (9, ""), (7, " \t\n"), (None, "a b c d"), (None, None), (3, "one"), (3, "one"), (2, "ONE"), (4, "é x y z"), (8, "É x y z")]
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], "doc_id bigint, text string, print int, fingerprint string")
    found = got(near_fingerprints(df))
    assert found == plain(rows)
    assert sum(c == 5 and f == "0" * 16 for _, f, c in found) == 4
    assert (None, f"{plain_print('a b c d'):016x}", None) in found
    assert near_fingerprints(df.limit(0)).count() == 0


def test_very_long_text_is_read_whole(monkeypatch):
    rng = random.Random(3)
    text = " ".join(rng.choices(["alpha", "beta", "x" * 500, "gamma\tdelta"], k=3000))
    whole = plain_print(text)
    for piece, counted in ((1 << 20, 1 << 14), (64, 5), (1, 1)):
        monkeypatch.setattr(simhash, "_PIECE", piece)
        monkeypatch.setattr(simhash, "_COUNTED", counted)
        assert simhash.fingerprint(text.encode()) == whole


@pytest.mark.parametrize("most", [1, 2, 3])
def test_index_finds_every_pair(most):
    rng = random.Random(most)
    prints = sorted({p for _ in range(6) for p in variants(rng, rng.getrandbits(64), 200)} | {0, (1 << 64) - 1})
    x = np.array(prints, np.uint64)
    node = (x >> np.uint64(62)).astype(np.int64)
    order = np.lexsort((gray_rank(x), node))
    x, node = x[order], np.unique(node[order], return_inverse=True)[1]
    a, b = Index(node, x).near(np.arange(len(x)), node, most)
    found = {(int(x[i]), int(x[j])) for i, j in zip(a, b, strict=True)}
    wanted = {
        (int(x[i]), int(x[j]))
        for i in range(len(x))
        for j in range(i + 1, len(x))
        if node[i] == node[j] and int(x[i] ^ x[j]).bit_count() <= most
    }
    assert found == wanted and len(wanted) > 100


def test_gray_rank_puts_gray_codes_in_order():
    codes = np.arange(1 << 12, dtype=np.uint64)
    assert (gray_rank(codes ^ (codes >> np.uint64(1))) == codes).all()


def test_masks_split_all_bits():
    for free in ((1 << 64) - 1, 0xF0F0, 0b101):
        parts = split_mask(free, 3)
        assert sum(parts) == free and len(parts) == 3


def test_large_nodes_are_factored_without_losing_links(spark, monkeypatch):
    """All fingerprints below one node, which is split three levels deep."""
    monkeypatch.setattr(simhash, "NODE", 8)
    rng = random.Random(1)
    base = rng.getrandbits(64)
    prints = sorted({p for p in variants(rng, base, 400)})
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    links = near_links(spark.createDataFrame(signed, "print bigint"), len(prints)).collect()
    place = {s[0]: i for i, s in enumerate(signed)}
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for r in links:
        a, b = find(place[r["x"]]), find(place[r["y"]])
        root[max(a, b)] = min(a, b)
    assert [find(i) for i in range(len(prints))] == components(prints)


def test_links_grow_with_fingerprints_not_pairs(spark):
    """A node's task names one partner per fingerprint, however many are near it."""
    prints = [(1 << a | 1 << b) for a in range(20) for b in range(a)]
    df = spark.createDataFrame([(p,) for p in prints], "print bigint")
    assert near_links(df, len(prints), 4).count() <= 5 * len(prints)


def test_repeated_rows_stay(spark):
    df = spark.range(300).select(F.lit(1).cast("long").alias("doc_id"), F.lit("same old text here").alias("text"))
    found = near_fingerprints(df)
    assert found.count() == 300 and found.distinct().count() == 1
