import random
import re

import pytest

from adloom.llm import decontaminate
from adloom.llm.decontaminate import drop_contaminated, find_contaminated, needed, needed_in_parts, part_of


def shingles(text):
    w = re.findall(r"[^\W_]+", (text or "").lower())
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def brute(rows, items, num, den):
    sets = {}
    for item, text in items:
        if item is not None:
            sets.setdefault(item, set()).update(shingles(text))
    out = []
    for doc, text in rows:
        own = shingles(text)
        for item, s in sets.items():
            if s and den * len(s & own) >= num * len(s):
                out.append((doc, item, len(s & own), len(s)))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("num", "seed"), [(80, 1), (50, 2), (100, 3)])
def test_equals_every_pair(spark, num, seed):
    rng = random.Random(seed)
    word = lambda: rng.choice("the of cat dog Über run 12 é sky sea ice oak elm ash fir yew".split()) + str(rng.randrange(9))
    text = lambda n: " ".join(word() for _ in range(n))
    start = text(6)
    items = [(i, text(rng.choice([3, 5, 6, 9, 30, 200]))) for i in range(25)]
    items += [(100 + i, start + " " + text(8)) for i in range(8)] + [(None, text(9)), (200, None), (201, ""), (3, text(7))]
    rows = [(i, text(rng.randrange(60))) for i in range(20)] + [(90, None), (91, ""), (92, start)]
    for i in range(120):
        words = rng.choice(items)[1] or ""
        words = words.split(" ")
        for _ in range(rng.choice([0, 0, 1, 2, 5])):
            words[rng.randrange(len(words))] = word()
        copy = rng.choice([" ", "\n", " - "]).join(words)
        rows.append((300 + i, f"{text(rng.randrange(300))} {copy.upper() if i % 3 else copy}, {text(rng.randrange(30))}"))
    rows += [(None, rows[-1][1]), rows[-1], rows[-1]]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, item_id int, t long")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute(rows, items, num, 100)
    assert len(want) > 30
    assert sorted(map(tuple, find_contaminated(df, bench, num=num).collect()), key=repr) == want
    bad = {r[1] for r in rows if any(brute([r], items, num, 100))}
    left = drop_contaminated(df, bench, num=num)
    assert left.columns == df.columns
    assert sorted((tuple(r)[:2] for r in left.collect()), key=repr) == sorted((r for r in rows if r[1] not in bad), key=repr)


def test_empty(spark):
    df = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert find_contaminated(df.limit(0), bench).collect() == []
    assert find_contaminated(df, bench.limit(0)).collect() == []
    assert drop_contaminated(df, bench.limit(0)).collect() == [(1, "a b c d e f")]
    assert drop_contaminated(df, bench).collect() == []


@pytest.mark.parametrize("num", [80, 60])
def test_items_with_one_passage_and_own_questions(spark, num):
    rng = random.Random(9)
    text = lambda n: " ".join(f"w{rng.randrange(100000)}" for _ in range(n))
    passage = text(130)
    items = [(i, f"{passage} {text(rng.randrange(14, 24))}") for i in range(12)]
    rows = [(1, passage), (2, f"{text(40)} {passage} {text(300)}"), (3, items[4][1]), (4, text(200)), (5, passage[:300])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute(rows, items, num, 100)
    assert len(want) == 36
    assert sorted(map(tuple, find_contaminated(df, bench, num=num).collect()), key=repr) == want
    assert [r["doc_id"] for r in drop_contaminated(df, bench, num=num).orderBy("doc_id").collect()] == [4, 5]


def test_parts_rely_on_no_more_than_any_of_their_sizes():
    """Sampled sizes of every part, and the tail itself summed plainly."""
    for num in (50, 80, 95, 100):
        parts = needed_in_parts(num, 100)
        for size in [*range(33, 700), 1000, 4097, 30_000, 600_000]:
            assert parts[part_of(size)] <= needed(size, num, 100), (num, size)
    size, held, kept = 200, 160, decontaminate.SKETCH
    from math import comb

    chance = lambda n: sum(comb(held, m) * comb(size - held, kept - m) for m in range(n)) / comb(size, kept)
    n = needed(size, 80, 100)
    assert chance(n) <= decontaminate.MISS < chance(n + 1) and 8 < n < 20
    assert needed(30, 80, 100) == 24 and needed(31, 80, 100) == 25


def test_recall_against_exact_containment(spark):
    """Items of every part inside long documents, right at the threshold: none is missed."""
    rng = random.Random(4)
    text = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    items = [(i, " ".join(text(n + 4))) for i, n in enumerate([5, 20, 32, 33, 40, 64, 65, 120, 250, 500, 1000] * 3)]
    rows = []
    for i, item in items:
        words = item.split(" ")
        gone = (len(words) - 4) // 5
        rows.append((i, " ".join(text(800) + words[gone:] + text(800))))
        rows.append((1000 + i, " ".join(text(500) + words[gone + 1 :] + text(500))))
    want = brute(rows, items, 80, 100)
    got = find_contaminated(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(map(tuple, got.collect()), key=repr) == want and len(want) >= 33


def test_very_long_text(spark):
    item = " ".join(f"q{i}" for i in range(60))
    rows = [(1, "x " * 400_000 + item + " y" * 400_000), (2, "x " * 400_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    assert [tuple(r) for r in find_contaminated(df, bench).collect()] == [(1, 7, 56, 56)]
