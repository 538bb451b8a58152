import random
import re
from collections import Counter, defaultdict

import pytest

from adloom.llm.templates import DEPTH, FREQUENT, MIN_SAME, drop_templates


def masked(line):
    tokens = re.findall(r"[^\x20\x09-\x0D]+", line)
    if 2 * sum(bool(re.search("[0-9]", t)) for t in tokens) <= len(tokens):
        tokens = [re.sub("[0-9]+", "<*>", t) for t in tokens]
    return tuple(tokens)


def brute(rows, min_docs):
    entries = []
    for doc, text in set(rows):
        for at, line in enumerate((text or "").split("\n") if text is not None else []):
            if tokens := masked(line):
                entries.append(((doc, text), at, tokens))
    order = lambda r: (r[0] is None, r[0] or 0)
    gone = set()

    def drop(groups):
        found = set()
        for key, members in groups.items():
            docs = {e[0] for e in members}
            if len(docs) >= min_docs:
                first = min(docs, key=order)
                found.add(key)
                gone.update((e[0], e[1]) for e in members if e[0] != first)
        return found

    whole = defaultdict(list)
    for e in entries:
        whole[e[2]].append(e)
    exact = drop(whole)
    leaves = defaultdict(list)
    for e in entries:
        if e[2] not in exact and len(e[2]) > DEPTH:
            leaves[len(e[2]), e[2][:DEPTH]].append(e)
    general = defaultdict(list)
    for leaf, members in leaves.items():
        distinct = {e[2] for e in members}
        if len({e[0] for e in members}) < min_docs:
            continue
        counts = [Counter(x) for x in zip(*distinct, strict=True)]
        for e in members:
            held = {}
            for at, t in enumerate(e[2]):
                n = counts[at][t]
                if n >= min_docs and FREQUENT * n >= len(distinct) or 2 * n > len(distinct):
                    held[at] = t
            if 100 * sum("<*>" not in t for t in held.values()) >= MIN_SAME * len(e[2]):
                general[leaf, tuple(held.items())].append(e)
    drop(general)
    out = []
    for doc, text in rows:
        lines = text.split("\n") if text is not None else []
        left = [x for i, x in enumerate(lines) if ((doc, text), i) not in gone]
        out.append((doc, None if text is None else "\n".join(left), len(lines), len(lines) - len(left)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("min_docs", [2, 5])
def test_equals_plain_tree(spark, min_docs):
    rng = random.Random(min_docs)
    vocab = [f"{a}{b}" for a in "abcdefgh" for b in "xyzé"]
    words = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    names = [words(1) + "n" for _ in range(30)]
    boiler = ["All rights reserved.", "page {d} of {d}", "Posted by the user {v} on {v} in the main forum", "x {d}"]
    boiler += ["Posted by the user {v} in the old archive of our club", "{d} {d} {d}", "http://x/{d}", "a{d},b{d} c"]

    def line():
        if rng.random() < 0.4:
            form = rng.choice(boiler)
            return rng.choice(["", " ", "\t"]) + form.replace("{d}", str(rng.randrange(99))).replace("{v}", rng.choice(names))
        return words(rng.choice([1, 3, 8])) if rng.random() < 0.9 else rng.choice(["", "  ", "\r"])

    rows = [(i, "\n".join(line() for _ in range(rng.randrange(1, 9)))) for i in range(80)]
    rows += [(200, None), (201, ""), (None, rows[3][1]), (None, rows[3][1]), (5, rows[4][1]), rows[7], rows[7]]
    df = spark.createDataFrame([(*r, "l", 1.5) for r in rows], "doc_id long, text string, n_lines string, r double")
    out = drop_templates(df, min_docs=min_docs)
    assert out.columns == ["doc_id", "text", "r", "n_lines", "n_dropped"]
    got = sorted(map(tuple, out.drop("r").collect()), key=repr)
    assert got == brute(rows, min_docs)
    assert sum(r[3] for r in got) > 50
    assert any("Posted by the user" in (t or "") for _, t, _, _ in got)


def dropped(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: r.n_dropped for r in drop_templates(df).collect()}


@pytest.mark.parametrize(
    "lines",
    [
        [f"https://site{i}.example/a{i}" for i in range(6)],
        [f"https://example.com/item/{i}" for i in range(6)],
        [f"{1990 + i}{a * 4}" for i, a in enumerate("日月火水木金")],
        [f"{i} {i * i} {i + 7}" for i in range(6)],
        [f"{i},{i * 3},x" for i in range(6)],
    ],
)
def test_single_content_stays(spark, lines):
    """Different addresses, sentences without blanks and rows of numbers are no template."""
    assert set(dropped(spark, lines).values()) == {0}


def test_recurring_templates_go(spark):
    assert dropped(spark, [f"page {i} of 20" for i in range(6)]) == {0: 0, **dict.fromkeys(range(1, 6), 1)}


def test_several_templates_of_one_leaf(spark):
    """Same number of tokens, same beginning, two forms of like size."""
    names = [f"name{a}" for a in "abcdef"]
    forms = ["Posted by the user {} on our good old main forum", "Posted by the user {} from his small new red phone"]
    texts = [f.format(n) for f in forms for n in names]
    assert sum(dropped(spark, texts).values()) == 10


def test_any_column_name_and_a_very_long_text(spark):
    line = "All rights reserved by the owner"
    rows = [(i, f"{line}\n" + f"w{i} " * (400_000 if i == 3 else 5), 1, "r") for i in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, gone int, row string").withColumnsRenamed({"gone": "__gone", "row": "r"})
    for own in (df, df.withColumnsRenamed({"__gone": "gone", "r": "row"})):
        out = drop_templates(own)
        assert out.columns == [*own.columns, "n_lines", "n_dropped"]
        got = {r.doc_id: (r.n_dropped, len(r.text)) for r in out.collect()}
        assert got == {i: (int(i > 0), len(t) - (len(line) + 1) * (i > 0)) for i, t, _, _ in rows}


def test_empty(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    assert sorted(map(tuple, drop_templates(df).collect())) == [(1, "a", 1, 0), (2, None, 0, 0)]
    assert drop_templates(df.limit(0)).collect() == []
