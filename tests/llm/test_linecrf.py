import itertools
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from adloom.llm import linecrf
from adloom.llm.linecrf import N_FEATURES, LineModel, fit, fit_lines, judge_lines, viterbi

SF = "/root/testdata/sf0.01"


def base(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(w, w[1:], w[2:], strict=False))
    repeated = {i + j for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(w) < 50 or 100 * len(repeated) > 50 * len(w)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(repeated), failed


def test_base_statistics(spark):
    rng = random.Random(2)
    words = ["a", "é日", "x#", "<b>", "of", "|", "9"]
    texts = [None, "", " \n\t", "\n\n", "a", "a\na\na \na", "é " * 60, "a b c " * 30, "  x y"]
    texts += [" ".join(rng.choice(words) + rng.choice(["", "", "\n", "\r\n"]) for _ in range(rng.randrange(150))) for _ in range(80)]
    rows = [(i, t, True, 1) for i, t in enumerate(texts)] + [(5, texts[5], None, None), (None, texts[8], None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept boolean, n_words int")
    out = judge_lines(df, LineModel())
    assert out.columns[:2] == ["doc_id", "text"] and len(set(out.columns)) == len(out.columns) == 11
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r[c] for c in names) == base(r["text"]), r["text"]
        assert r["kept"] == (not r["base_failed"]) and r["boilerplate_lines"] == [] and r["content_words"] == r["n_words"]
    assert judge_lines(df.limit(0), LineModel()).collect() == []


def test_viterbi_is_the_best_of_all_labellings():
    rng = np.random.default_rng(3)
    for _ in range(30):
        model = LineModel(moves=rng.normal(size=(2, 2)), start=rng.normal(size=2))
        sizes = rng.integers(0, 8, 6)
        scores = rng.normal(size=int(sizes.sum()))
        got = viterbi(scores, sizes, model)
        at = 0
        for n in sizes.tolist():

            def score(labels, at=at):
                total = model.start[labels[0]]
                total += sum(scores[at + i] for i, label in enumerate(labels) if label)
                return total + sum(model.moves[a, b] for a, b in itertools.pairwise(labels))

            if n:
                best = max(itertools.product((0, 1), repeat=n), key=score)
                assert got[at : at + n].tolist() == list(map(bool, best))
            at += n


def test_model_without_both_labels_keeps_everything(spark):
    features = [np.zeros((3, 8), np.int64)]
    assert not fit(features, np.array([True])).weights.any()
    assert len(fit(features + [features[0] + 1], np.array([True, False]), rounds=5).weights) == N_FEATURES
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, None), (None, 0), (7, 0)], "doc_id long, quality int")
    assert not fit_lines(docs, labels).weights.any()


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    model = fit_lines(docs, labels.filter(half))
    judged = judge_lines(docs, model).join(labels.filter(~half), "doc_id").filter("not base_failed").collect()
    good = [r["kept"] for r in judged if r["quality"] == 1]
    bad = [not r["kept"] for r in judged if r["quality"] == 0]
    assert len(good) > 100 and len(bad) > 5
    assert np.mean(good) >= 0.98 and np.mean(bad) >= 0.9
    marked = judge_lines(docs.filter("text like '%&&&%'"), model).filter("not kept and not base_failed").first()
    lines = marked["text"].split("\n")
    assert all(lines[i].strip() for i in marked["boilerplate_lines"])


def test_lines_are_drawn_from_the_whole_text():
    assert linecrf._drawn(5, 100) == [(0, 100)] and linecrf._drawn(5, 0) == [(0, 0)]
    places = [a for number in range(200) for a, _ in linecrf._drawn(number, 5000)]
    assert all(sum(b - a for a, b in linecrf._drawn(n, 5000)) == 100 for n in range(20))
    assert min(places) < 500 and max(places) > 4500 and 2000 < np.mean(places) < 3000
    assert linecrf._drawn(7, 130) == linecrf._drawn(7, 130) and all(b <= 130 for _, b in linecrf._drawn(7, 130))


def test_verdict_against_a_plain_version(spark):
    """Statistics, all labellings of short texts, share of content: the whole verdict by other means."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    model = fit_lines(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    rows = judge_lines(docs, model).collect()
    checked = 0
    for r in rows:
        seen = linecrf._measure(pa.array([r["text"]]))
        scores = model.weights[seen["features"]].sum(axis=1) + model.bias
        n = len(scores)
        if not 0 < n <= 10:
            continue
        checked += 1

        def score(labels, scores=scores):
            total = model.start[labels[0]] + sum(s for s, label in zip(scores, labels, strict=True) if label)
            return total + sum(model.moves[a, b] for a, b in itertools.pairwise(labels))

        best = max(itertools.product((0, 1), repeat=n), key=score)
        words = [len(re.findall(r"[^\x20\x09-\x0D]+", x)) for x in r["text"].split("\n")]
        words = [w for w in words if w]
        content = sum(w for w, label in zip(words, best, strict=True) if not label)
        assert r["content_words"] == content and r["base_failed"] == base(r["text"])[-1]
        assert r["kept"] == (not r["base_failed"] and content >= 0.5 * r["n_words"])
    assert checked > 50


def test_very_long_text(spark):
    text = "\n".join(f"This is line number {i} of a long and rather dull report about things" for i in range(20_000))
    df = spark.createDataFrame([(1, text), (2, "x " * 300_000)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in judge_lines(df, LineModel()).collect()}
    assert got[1]["n_words"] == 14 * 20_000 and not got[1]["n_dup_lines"] and got[2]["base_failed"] and got[2]["n_words"] == 300_000
