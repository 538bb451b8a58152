import random
import re

import numpy as np

from adloom.llm import licenses
from adloom.llm.licenses import NOTICES, scan_licenses, window_ranges


def tokens(text):
    data = (text or "").encode()
    for m in re.finditer(rb"[0-9A-Za-z\x80-\xff]+", data):
        yield re.sub(rb"[0-9]", b"0", m[0].lower()), m.start(), m.end()


def brute(rows, templates, num):
    known = []
    for t, (name, text) in enumerate(sorted({x for x in templates if None not in x})):
        w = [x[0] for x in tokens(text)]
        known.append((t, name, {tuple(w[i : i + 5]) for i in range(len(w) - 4)}))
    out = []
    for doc, text in rows:
        w = list(tokens(text))
        s = [tuple(x[0] for x in w[i : i + 5]) for i in range(len(w) - 4)]
        for t, name, own in known:
            best = (0,)
            for a, b in window_ranges(1 << (len(own) - 1).bit_length(), len(s)) if own else []:
                held = [i for i in range(a, b) if s[i] in own]
                count = len({s[i] for i in held})
                if 100 * count >= num * len(own) and count > best[0]:
                    best = (count, len(own), w[held[0]][1], w[held[-1] + 4][2])
            if best[0]:
                out.append((doc, name, t, *best))
    return sorted(out, key=repr)


def test_equals_every_window(spark):
    rng = random.Random(5)
    vocab = "the of License under Version 2 é licensed is public work copy".split()
    filler = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    templates = [*NOTICES, ("long", filler(300)), ("short", "MIT License"), ("none", None), (None, "a b c d e f")]
    rows = [(1, None), (2, ""), (3, "MIT License"), (4, NOTICES[0][1]), (None, NOTICES[4][1]), (None, NOTICES[4][1])]
    for i in range(200):
        words = (rng.choice(templates)[1] or "").split()
        for _ in range(rng.choice([0, 0, 1, 3])):
            if words:
                words[rng.randrange(len(words))] = rng.choice(vocab)
        copy = rng.choice([" ", "\n", " * "]).join(words).replace("3", "2")
        rows.append((10 + i, f"{filler(rng.randrange(400))}. {copy.upper() if i % 4 else copy} {filler(rng.randrange(50))}"))
    df = spark.createDataFrame([(*r, "x", 0) for r in rows], "doc_id long, text string, license string, start int")
    table = spark.createDataFrame(templates, "license string, text string")
    want = brute(rows, templates, 80)
    assert len(want) > 100 and len({r[1] for r in want}) > 8
    got = sorted(map(tuple, scan_licenses(df, table).collect()), key=repr)
    assert got == want
    assert scan_licenses(df.limit(0), table).collect() == scan_licenses(df, table.limit(0)).collect() == []
    assert np.isclose((1 - 0.4 / 2.1) ** 96, 0, atol=2e-9)


def test_bands_are_an_index():
    """A window meets the templates that share a band's value with it, and only in the same band."""
    known = licenses.Templates(sorted(NOTICES))
    for size, (keys, owner) in known.classes.items():
        assert (np.diff(keys.astype(object)) >= 0).all() and len(keys) == len(owner) == 96 * len(set(owner.tolist()))
    found = licenses._read(licenses.pa.array([NOTICES[0][1]]))[0]
    own = sorted(NOTICES).index(NOTICES[0])
    size = known._class(known.sets[own])
    n = len(known.sets[own])
    got = list(licenses._candidates(known, found, np.arange(n), 0, n, size))
    assert (0, n, own) in got


def test_very_long_text(spark):
    text = "word " * 300_000 + NOTICES[0][1] + " word" * 300_000
    df = spark.createDataFrame([(1, text), (2, "word " * 300_000)], "doc_id long, text string")
    table = spark.createDataFrame(NOTICES, "license string, text string")
    assert [(r.doc_id, r.license) for r in scan_licenses(df, table).collect()] == [(1, NOTICES[0][0])]
