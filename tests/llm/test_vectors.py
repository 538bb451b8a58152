"""Clusters and codes of vectors against plain versions in Python's integers."""

import hashlib
import math
import random

import numpy as np
import pytest

from adloom.llm import clusters
from adloom.llm.clusters import cluster_vectors, loosening, reassign, squared_distances
from adloom.llm.codes import Book, compress_vectors

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def kept(rows, scale, dims):
    limit = min(2**31 - 1, math.isqrt(2**63 // dims) // 2)
    out = []
    for doc, v, label in rows:
        if v is not None and len(v) == dims and all(c is not None and math.isfinite(c) for c in v):
            x = [math.floor(scale * float(np.float32(c))) for c in v]
            if all(abs(c) < limit for c in x):
                out.append((doc, x, label))
    return out


def stored_order(x):
    return np.array(x, "<i4").tobytes()


def gap(a, b):
    return sum((p - q) ** 2 for p, q in zip(a, b, strict=True))


def nearest(x, entries):
    return min(range(len(entries)), key=lambda e: (gap(x, entries[e]), e))


def means(members, before):
    return [[sum(c) // len(m) for c in zip(*m, strict=True)] if m else b for m, b in zip(members, before, strict=True)]


def plain_clusters(rows, k, rounds, dims, scale):
    held = kept(rows, scale, dims)

    def place(r):
        return (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), stored_order(r[1]))

    centers = [x for _, x, _ in sorted(held, key=place)[:k]]
    for step in range(rounds + 1):
        found = [nearest(x, centers) for _, x, _ in held]
        if step < rounds:
            centers = means([[x for (_, x, _), c in zip(held, found, strict=True) if c == j] for j in range(len(centers))], centers)
    far = [gap(x, centers[c]) for (_, x, _), c in zip(held, found, strict=True)]
    per = {j: sum(d for d, c in zip(far, found, strict=True) if c == j) for j in found}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]
    return sorted(((h[0], c, d, per[c], sum(far), digest[c]) for h, c, d in zip(held, found, far, strict=True)), key=repr)


def plain_codes(rows, dims, parts, entries, rounds, scale):
    held = kept(rows, scale, dims)
    width = dims // parts
    cut = [[x[p * width : (p + 1) * width] for p in range(parts)] for _, x, _ in held]
    first = sorted(range(len(held)), key=lambda i: (held[i][0] is None, held[i][0] or 0, stored_order(held[i][1])))[:entries]
    books = [[cut[i][p] for i in first] for p in range(parts)]
    for step in range(rounds + 1):
        found = [[nearest(c[p], books[p]) for p in range(parts)] for c in cut]
        if step < rounds:
            books = [
                means([[c[p] for c, f in zip(cut, found, strict=True) if f[p] == e] for e in range(len(books[p]))], books[p])
                for p in range(parts)
            ]
    errors = [sum(gap(c[p], books[p][f[p]]) for p in range(parts)) for c, f in zip(cut, found, strict=True)]
    digest = hashlib.sha256(",".join(str(n) for b in books for e in b for n in e).encode()).hexdigest()
    labels = {}
    for (_, _, label), e in zip(held, errors, strict=True):
        labels[label] = labels.get(label, 0) + e
    return sorted(
        (
            (h[0], "".join(f"{e:02x}" for e in f), e_, labels[h[2]], digest)
            for h, f, e_ in zip(held, found, errors, strict=True)
        ),
        key=repr,
    )


def table(seed, n, dims, spread=0.05):
    rng = random.Random(seed)
    middles = [[rng.uniform(-1, 1) for _ in range(dims)] for _ in range(6)]
    rows = []
    for i in range(n):
        m = rng.choice(middles)
        rows.append((i, [c + rng.gauss(0, spread) for c in m], rng.choice([0, 1, 2, None])))
    return rows


def odd_rows(dims):
    one = [0.5] * dims
    bad = [[*one[:-1], x] for x in (None, float("nan"), float("inf"), -float("inf"))]
    return [
        (900, None, 1), (901, [], 1), (902, one[:-1], 1), (903, [*one, 0.5], 1), (904, [1e30] * dims, 1),
        *[(910 + i, v, 1) for i, v in enumerate(bad)],
        (None, one, None), (920, one, 3), (920, one, 3), (921, [-0.001] * dims, None), (None, [0.25] * dims, 3),
    ]


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed, n, k, spread", [(1, 300, 40, 0.05), (2, 200, 7, 0.5), (3, 60, 40, 0.0)])
def test_clusters_match_brute_force(spark, seed, n, k, spread):
    rows = table(seed, n, 8, spread) + odd_rows(8)
    found = cluster_vectors(spark.createDataFrame(rows, SCHEMA).repartition(3), k=k, dims=8)
    assert got(found) == plain_clusters(rows, k, 5, 8, 256)


@pytest.mark.parametrize("seed, n, spread", [(1, 300, 0.05), (2, 100, 0.5), (3, 40, 0.0)])
def test_codes_match_brute_force(spark, seed, n, spread):
    rows = table(seed, n, 16, spread) + odd_rows(16)
    found = compress_vectors(spark.createDataFrame(rows, SCHEMA).repartition(3), dims=16)
    assert got(found) == plain_codes(rows, 16, 8, 16, 6, 4096)


@pytest.mark.parametrize("operator", [cluster_vectors, compress_vectors])
def test_small_and_empty_tables(spark, operator):
    """Fewer vectors than centroids or entries; none kept; no rows; columns named like the operator's own."""
    rows = [(7, [0.1] * 64, None), (3, [0.2] * 64, 1), (3, [0.2] * 64, 1)]
    plain = plain_clusters(rows, 40, 5, 64, 256) if operator is cluster_vectors else plain_codes(rows, 64, 8, 16, 6, 4096)
    clashing = [(*r, 9, "q", 0.5, b"") for r in rows]
    df = spark.createDataFrame(clashing, f"{SCHEMA}, cluster int, code string, distance double, x binary")
    assert got(operator(df)) == plain
    for empty in (df.limit(0), df.filter("label = 1").withColumn("embedding", df["embedding"].getItem(0) + 1).selectExpr("vec_id", "cast(null as array<float>) as embedding", "label")):
        out = operator(empty)
        assert out.count() == 0 and out.columns == operator(df).columns


def test_loosening_is_a_bound_below_the_drift():
    """No vector of the sphere loses more than the bound, which stays below the full drift."""
    rng = np.random.default_rng(5)
    less = 0
    for _ in range(40):
        old = rng.integers(-300, 300, (6, 5))
        new = old + rng.integers(-40, 40, (6, 5))
        radius = rng.uniform(1, 150, 6)
        bound = loosening(old, new, radius)
        drift = np.sqrt(((new - old) ** 2).sum(1))
        for i in range(6):
            others = [j for j in range(6) if j != i]
            x = rng.normal(size=(400, 5))
            x = old[i] + x / np.linalg.norm(x, axis=1)[:, None] * radius[i] * rng.random((400, 1)) ** 0.2
            lost = np.linalg.norm(x[:, None] - old[None], axis=2) - np.linalg.norm(x[:, None] - new[None], axis=2)
            assert (lost[:, others].max() <= bound[i] + 1e-9) and bound[i] <= drift[others].max() + 1e-9
            less += bound[i] < 0.99 * drift[others].max()
    assert less > 60


def test_bounds_spare_most_vectors_of_parted_clusters():
    rng = np.random.default_rng(2)
    centers = rng.integers(-4000, 4000, (10, 16))
    x = np.repeat(centers, 200, axis=0) + rng.integers(-50, 50, (2000, 16))
    cluster, upper, lower = clusters._scan(x, centers)
    radius = np.array([upper[cluster == j].max() for j in range(10)])
    moved = centers + rng.integers(-20, 20, centers.shape)
    found, _, _, scanned = reassign(x, cluster, upper, lower, moved, clusters._move(centers, moved, radius))
    assert (found == squared_distances(x, moved).argmin(1)).all() and scanned < 20


@pytest.mark.parametrize("most", [2**9, 2**27])
def test_distances_are_exact(most):
    rng = np.random.default_rng(0)
    x, c = rng.integers(-most, most, (20, 64)), rng.integers(-most, most, (5, 64))
    wanted = [[gap(a, b) for b in c.tolist()] for a in x.tolist()]
    assert squared_distances(x, c).tolist() == wanted


@pytest.mark.parametrize("spread", [2, 30, 5000])
def test_orchard_search_finds_the_nearest_entry(spread):
    """Also among equal entries and ties, where the lower index counts."""
    rng = np.random.default_rng(spread)
    entries = rng.integers(-spread, spread, (16, 8))
    entries[5] = entries[11]
    x = rng.integers(-spread, spread, (3000, 8))
    best, near = Book(entries).search(x)
    every = ((x[:, None] - entries[None]) ** 2).sum(2)
    assert (best == every.argmin(1)).all() and (near == every.min(1)).all()
    assert Book(entries[:1]).search(x)[0].max() == 0 and len(Book(entries).search(x[:0])[0]) == 0
