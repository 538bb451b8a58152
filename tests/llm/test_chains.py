import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from adloom.llm import chains
from adloom.llm.chains import Fenwick, align, chain, find_passages


def test_fenwick_is_prefix_maximum():
    rng = random.Random(1)
    tree, values = Fenwick(40), {}
    for n in range(300):
        at, value = rng.randrange(40), (rng.random(), n)
        tree.enter(at, value)
        values[at] = max(value, values.get(at, value))
        below = rng.randrange(41)
        assert tree.up_to(below) == max([v for a, v in values.items() if a < below], default=(float("-inf"), -1))


@pytest.mark.parametrize("seed", range(8))
def test_best_chain_of_all(seed):
    rng = random.Random(seed)
    points = sorted({(rng.randrange(30), rng.randrange(30)) for _ in range(9)})
    points = [p for i, p in enumerate(points) if i == 0 or p[0] > points[i - 1][0]]

    def score(c):
        gaps = sum(b[0] - a[0] + b[1] - a[1] for a, b in itertools.pairwise(c))
        return chains.SEED_SCORE * len(c) - chains.GAP_COST * gaps

    ordered = [
        c
        for n in range(1, len(points) + 1)
        for c in itertools.combinations(points, n)
        if all(a[0] < b[0] and a[1] < b[1] for a, b in itertools.pairwise(c))
    ]
    best = max(map(score, ordered))
    p, q = (np.array(x) for x in zip(*points, strict=True))
    assert chain(p, q)[0][0] == pytest.approx(best)


def test_align():
    x = np.arange(100, dtype=np.uint32)
    assert align(x, x) == 100
    y = np.concatenate([x[:30], [999, 998], x[33:60], x[62:]]).astype(np.uint32)
    assert align(x, y) == 95
    assert align(x, x + 1000) == 0


def test_planted_passages(spark):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))
    text = lambda n: [word() for _ in range(n)]
    passages = [text(rng.choice([52, 60, 90, 200])) for _ in range(10)]
    rows, want = [], {}
    holders = {}
    for i in range(150):
        number = i * 7 - 100
        body = text(rng.randrange(120))
        if rng.random() < 0.6:
            k = rng.randrange(len(passages))
            own = list(passages[k])
            for _ in range(rng.choice([0, 0, 1, 3])):
                at = rng.randrange(len(own))
                own[at : at + rng.choice([0, 1])] = [word()]
            before = len(body)
            body += own + text(rng.randrange(60))
            if k in holders:
                want[number] = (before, before + len(own), holders[k])
            holders.setdefault(k, []).append(number)
        rows.append((number, rng.choice([" ", "\n"]).join(body)))
    shared = text(49)
    rows += [(5000, " ".join(shared)), (5001, " ".join(text(9) + shared)), (6000, None), (6001, ""), (None, rows[3][1])]
    rows += [(7000, rows[8][1].upper()), (7000, "~ repeats an id"), (5001, "zz")]
    df = spark.createDataFrame([(*r, 4, "w") for r in rows], "doc_id long, text string, batch int, n_words string")
    out = find_passages(df.repartition(4), batch_bytes=6000).collect()
    assert len(out) == len(rows)
    got = {}
    for r in out:
        if r["passages"]:
            got.setdefault(r["doc_id"], []).extend(r["passages"])
    for number, (a, b, sources) in want.items():
        body = re.findall(r"\S+", dict(rows)[number])
        covered = set()
        for p in got[number]:
            assert p["source"] < number and 100 * p["matched"] >= 75 * p["words"] and p["words"] >= 50
            before = len(dict(rows)[number].encode()[: p["start"]].split())
            covered.update(range(before, before + p["words"]))
        assert {p["source"] for p in got[number]} & set(sources)
        missed = [w for w in range(a, b) if w not in covered]
        assert len(missed) <= 8 and len(body) >= b, (number, len(missed))
    whole = {7000} if len(rows[8][1].split()) >= 50 else set()
    assert set(got) == set(want) | whole
    assert find_passages(df.limit(0)).collect() == []


def words_of(rng, n):
    return ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 7))) for _ in range(n)]


def covered_words(row, text):
    """Words of a text inside its passages."""
    data, out = text.encode(), set()
    for p in row["passages"]:
        before = len(data[: p["start"]].split())
        out.update(range(before, before + p["words"]))
    return out


def test_several_passages_of_one_partner(spark):
    rng = random.Random(5)
    rows, want = [], {}
    for i in range(12):
        shared = [words_of(rng, 60) for _ in range(3)]
        gaps = [rng.choice([25, 60, 100, 160]) for _ in range(4)]
        own, at, places = words_of(rng, 10), 10, []
        source = words_of(rng, 5)
        for s, n, m in zip(shared, gaps[:3], gaps[1:], strict=True):
            places.append((at, at + 60))
            own, source = own + s + words_of(rng, n), source + s + words_of(rng, m)
            at += 60 + n
        rows += [(10 * i, " ".join(source)), (10 * i + 1, " ".join(own))]
        want[10 * i + 1] = places
    got = {r["doc_id"]: r for r in find_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for number, places in want.items():
        covered = covered_words(got[number], dict(rows)[number])
        for a, b in places:
            assert covered >= set(range(a, b)), (number, a, b)
        assert all(p["source"] == number - 1 and p["words"] >= 50 for p in got[number]["passages"])
        assert all(100 * p["matched"] >= 80 * p["words"] - 1 for p in got[number]["passages"])


def test_failed_chain_hides_no_other_partner(spark):
    rng = random.Random(6)
    own = words_of(rng, 240)
    torn = [w for i in range(0, 240, 16) for w in own[i : i + 16] + words_of(rng, 14)]
    rows = [(1, " ".join(torn)), (2, " ".join(own[90:150])), (3, " ".join(own))]
    got = {r["doc_id"]: r for r in find_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [p["source"] for p in got[3]["passages"]] == [2]
    assert covered_words(got[3], rows[2][1]) >= set(range(90, 150))


def test_parts_are_the_longest():
    rng = random.Random(7)
    for _ in range(200):
        p = q = 0
        found = []
        for _ in range(rng.randrange(1, 9)):
            n = rng.randrange(1, 30)
            found.append((p, q, n))
            p, q = p + n + rng.randrange(1, 20), q + n + rng.randrange(20)
        found = np.array(found).T

        def good(a, b, found=found):
            x = found[0, b] + found[2, b] - found[0, a]
            y = found[1, b] + found[2, b] - found[1, a]
            return x >= 20 and 200 * found[2, a : b + 1].sum() >= 80 * (x + y)

        size = lambda r, found=found: found[0, r[1]] + found[2, r[1]] - found[0, r[0]]
        every = [(a, b) for a in range(found.shape[1]) for b in range(a, found.shape[1]) if good(a, b)]
        got = chains.parts(found, 20, 80, 100)
        assert all(r in every for r in got) and bool(got) == bool(every)
        assert max(map(size, got), default=0) == max(map(size, every), default=0)


@pytest.mark.parametrize("percent", [80, 83, 87, 90, 95])
def test_recall_of_changed_copies(spark, percent):
    """Copies with single words changed, at even distances or anywhere, against every range on their diagonal."""
    rng = random.Random(percent)
    rows, want = [], {}
    for i in range(60):
        n = rng.choice([60, 80, 150])
        source = words_of(rng, n)
        changes = n * (100 - percent) // 100
        even = [n * (2 * c + 1) // (2 * changes) for c in range(changes)]
        changed = set(even if i % 2 else rng.sample(range(n), changes))
        copy = [words_of(rng, 1)[0] + "z" if w in changed else x for w, x in enumerate(source)]
        same = np.concatenate(([0], np.cumsum([w not in changed for w in range(n)])))
        ranges = [(a, b) for a in range(n) for b in range(a + 50, n + 1) if 100 * (same[b] - same[a]) >= 80 * (b - a)]
        rows += [(2 * i, " ".join(words_of(rng, 20) + source)), (2 * i + 1, " ".join(words_of(rng, 30) + copy))]
        if ranges:
            want[2 * i + 1] = max(b - a for a, b in ranges)
    got = {r["doc_id"]: r for r in find_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    found = [n for n in want if got[n]["passages"]]
    assert len(want) >= 50 and len(found) == len(want), (len(found), len(want))
    assert all({p["source"] for p in got[n]["passages"]} == {n - 1} for n in found)
    near = [max(p["words"] for p in got[n]["passages"]) >= 0.8 * want[n] for n in found]
    assert sum(near) >= 0.95 * len(near), (sum(near), len(near))


def test_packed_numbers_come_back():
    rng = np.random.default_rng(3)
    ends = np.iinfo(np.int64)
    for low, high in [(0, 1), (-5, 200), (7, 70000), (-(1 << 40), 1 << 20), (ends.min, ends.max)]:
        columns = rng.integers(low, high, (3, 50), endpoint=True)
        assert (chains._wide(chains._narrow(columns), 3) == columns).all()


def test_long_seeds_are_chosen_alike():
    rng = np.random.default_rng(1)
    shared = rng.integers(0, 1 << 62, 60).astype(np.uint64)
    for n in (0, 3, 40):
        keys = np.concatenate([rng.integers(0, 1 << 62, n).astype(np.uint64), shared, rng.integers(0, 1 << 62, 9).astype(np.uint64)])
        at = chains._chosen(keys)
        assert set(chains._chosen(shared)) <= {x - n for x in at}
        assert (np.diff(at) <= chains.WINDOW).all()
    assert chains._chosen(shared[:5]).tolist() == [int(shared[:5].argmin())] and len(chains._chosen(shared[:0])) == 0


def test_a_whole_copy_is_found_among_holders_of_its_pieces(spark):
    """Every short seed of the passage has other first and nearest holders."""
    rng = random.Random(8)
    passage = words_of(rng, 60)
    pieces = [passage[a : a + 12] for a in range(0, 54, 6)]
    alone = lambda: [" ".join(words_of(rng, 8) + p + words_of(rng, 8)) for p in pieces]
    whole = lambda: " ".join(words_of(rng, 5) + passage + words_of(rng, 7))
    texts = [*alone(), whole(), *alone(), whole(), *alone(), whole()]
    got = {r["doc_id"]: r for r in find_passages(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for number, sources in ((19, {9}), (29, {9, 19})):
        assert {p["source"] for p in got[number]["passages"]} & sources
        assert covered_words(got[number], texts[number]) >= set(range(5, 65))
    assert {n for n, r in got.items() if r["passages"]} == {19, 29}


@pytest.mark.parametrize("seed", [1, 2])
def test_exact_copies_against_every_pair(spark, seed):
    """All words in runs of 50 that any earlier document has, by comparing every two documents."""
    rng = random.Random(seed)
    pool = [words_of(rng, rng.choice([12, 30, 50, 55, 80, 140])) for _ in range(14)]
    rows = []
    for i in range(70):
        body = []
        for _ in range(rng.randrange(1, 5)):
            own = rng.choice(pool)
            a = rng.choice([0, 0, rng.randrange(len(own))])
            body += words_of(rng, rng.randrange(15)) + own[a:]
        rows.append((i, " ".join(body)))
    rows += [(0, "zz repeats an id"), (None, rows[3][1]), (200, "x " * 300_000 + " ".join(pool[-1] + pool[3]))]
    got = {}
    for r in find_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect():
        if r["doc_id"] != 200 or r["passages"]:
            got.setdefault(r["doc_id"], []).append(r)
    seen, missed, wanted = {}, 0, 0
    for i, text in rows[:70]:
        w = text.split()
        covered = set()
        for r in got[i]:
            covered |= covered_words(r, text)
        for a in range(len(w) - 49):
            if tuple(w[a : a + 50]) in seen:
                wanted += 50
                missed += len(set(range(a, a + 50)) - covered)
        for a in range(len(w) - 49):
            seen.setdefault(tuple(w[a : a + 50]), i)
    # A passage that has less than a fifth of new words is not reported.
    assert wanted > 1000 and 1000 * missed <= wanted, (missed, wanted)


@pytest.mark.parametrize("others", [0, 5])
def test_a_changed_copy_is_found_among_holders_of_all_its_seeds(spark, others):
    """No seed of the passage has its source as first or nearest holder, and it has no more seeds than it must have."""
    rng = random.Random(9)
    lengths = [4, 3, 4, 4, 3, 4, 4, 3, 4, 3, 4]
    runs = [words_of(rng, n) for n in lengths]
    joined = lambda: [w for r in runs for w in [*words_of(rng, 1), *r]][1:]
    pieces = lambda: [" ".join(words_of(rng, 9) + r + words_of(rng, 9)) for r in runs if len(r) == 4]
    texts = [*pieces(), " ".join(words_of(rng, 30) + joined() + words_of(rng, 20))]
    source = len(texts) - 1
    for _ in range(others):
        texts += pieces()[:3]
    texts += [*pieces(), " ".join(words_of(rng, 12) + joined() + words_of(rng, 40))]
    got = {r["doc_id"]: r for r in find_passages(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    last = len(texts) - 1
    assert [p["source"] for p in got[last]["passages"]] == [source]
    assert covered_words(got[last], texts[last]) >= set(range(12, 62))
    assert {n for n, r in got.items() if r["passages"]} == {last}


@pytest.mark.parametrize("low", [0, -(1 << 62)])
def test_pairs_of_links_are_told_once(low):
    ids = low + np.random.default_rng(3).integers(0, 40, (2, 3000)) * ((1 << 62) // 40)
    links = np.concatenate([ids, np.zeros((2, 3000), np.int64)])
    assert (chains._pairs(links) == np.unique(links[:2], axis=1)).all()
    assert chains._pairs(links[:, :0]).shape == (2, 0)


def test_links_with_all_earlier_holders(monkeypatch):
    """First and further links of an occurrence together lead to every earlier document that has its seed."""
    rng = np.random.default_rng(2)
    seeds = np.stack([rng.integers(0, 12, 900), rng.integers(0, 60, 900), 2 * rng.integers(0, 40, 900)])
    seeds = np.unique(seeds, axis=1)
    rest, held = chains._often(seeds)
    monkeypatch.setattr(chains, "LINK_BLOCK", 50)
    further = list(chains._further(rest[[3, 0, 1]], held))
    assert len(further) > 10
    first = chains._links(seeds)
    first[2:] >>= 1
    got = sorted(map(tuple, np.concatenate([first, *further], axis=1).T.tolist()))
    where: dict[tuple[int, int], int] = {}
    for key, doc, place in seeds.T.tolist():
        where.setdefault((key, doc), place >> 1)
    want = sorted((doc, d, place >> 1, p) for key, doc, place in seeds.T.tolist() for (k, d), p in where.items() if k == key and d < doc)
    assert got == want


def test_parts_of_packed_links_are_all_of_them():
    links = np.random.default_rng(4).integers(-50, 50, (4, 900))
    column = pa.chunked_array([pa.array([chains._narrow(links[:, a : a + 300]) for a in range(0, 900, 300)], pa.binary())])
    parts = [chains._unpacked(column, 4, i, 7) for i in range(7)]
    assert sorted(map(tuple, np.concatenate(parts, axis=1).T.tolist())) == sorted(map(tuple, links.T.tolist()))
    assert (chains._unpacked(column, 4) == links).all()


def test_chains_of_segments_in_a_row():
    """Segments that follow each other in both texts have the chains that the tree finds."""
    rng = np.random.default_rng(5)
    for _ in range(200):
        steps = rng.choice([1, 1, 1, 4, 30, 300, 700], (2, int(rng.integers(3, 60))))
        steps[1, rng.random(steps.shape[1]) < 0.7] = 1
        steps[0, steps[1] == 1] = 1
        p, q = np.cumsum(steps, axis=1)
        links = np.stack([np.full(len(p), 9), np.full(len(p), 2), p, q])
        want = [(q0, q1 + 4, p0, p1 + 4, round(100 * s)) for s, p0, p1, q0, q1, n in chain(p, q) if n >= chains.MIN_SEEDS]
        got = chains._chains(links, 0)
        assert sorted(zip(*got[[1, 2, 4, 5, 6]].tolist(), strict=True)) == sorted(want)
