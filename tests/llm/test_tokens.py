import random

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
from pyspark.sql import functions as F  # noqa: E402

from adloom.llm.tokens import PrefixCounter, count_at, longest_within, prefix_token_counts  # noqa: E402

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, n_tokens string, prefix_tokens string"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def tokens(library, text):
    return len(library.encode(text, add_special_tokens=False).ids)


def test_every_prefix_equals_the_library(library):
    rng = random.Random(7)
    counter = PrefixCounter(PATH)
    letters = "ab et'slrvmd  \n\t.!é日 ﬁ12½ <|endoftext|>"
    for n in range(400):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 24)))
        if n % 5 == 0:
            text = text[:5] + "<|endoftext|>" + text[5:]
        want = [tokens(library, text[: i + 1]) for i in range(len(text))]
        assert counter.counts(text).tolist() == want, text


def test_long_word_and_blank_runs(library):
    rng = random.Random(3)
    counter = PrefixCounter(PATH)
    for text in ("".join(rng.choice("abcdeé") for _ in range(5000)), "x" + " " * 700 + "\n" * 300 + "y", "-" * 999):
        assert counter.counts(text)[-1] == tokens(library, text)
        for i in (1, 3, 400, 705, 998):
            assert counter.counts(text)[i - 1] == tokens(library, text[:i])


@pytest.mark.parametrize("sign", ["\U00012000", "\U00020000", "\U000e0001"])
@pytest.mark.parametrize("n", [63, 64, 65, 300])
def test_words_of_signs_that_take_four_tokens(library, sign, n):
    """Their counts leave a byte at 64 characters."""
    counter = PrefixCounter(PATH)
    text = f"a {sign * n} b"
    counts = counter.counts(text)
    assert [int(counts[i - 1]) for i in (2, n, n + 2, n + 4)] == [tokens(library, text[:i]) for i in (2, n, n + 2, n + 4)]
    assert counter.counts(sign * n)[-1] == tokens(library, sign * n)


def test_frame(spark, library):
    rows = [(1, "Hello hello world", "x", "y"), (1, "Hello hello world", "x", "y"), (2, None, None, None), (3, "", "", "")]
    rows.append((None, "word " * 3000, None, None))
    df = spark.createDataFrame(rows, SCHEMA)
    out = prefix_token_counts(df, PATH, limit=10)
    assert out.columns == ["doc_id", "text", "prefix_tokens", "n_tokens", "n_bytes", "fit_chars"]
    got = out.collect()
    assert len(got) == 5
    for r in got:
        text = r["text"] or ""
        assert r["n_tokens"] == (tokens(library, text) if text else 0)
        assert r["n_bytes"] == len(text.encode())
        fits = [i for i in range(min(len(text), 200) + 1) if not i or tokens(library, text[:i]) <= 10]
        assert r["fit_chars"] == max(fits)
    asked = out.select(
        F.col("text"),
        count_at(F.col("prefix_tokens"), F.lit(7)).alias("at"),
        longest_within(F.col("prefix_tokens"), F.lit(2)).alias("fit"),
    ).collect()
    for r in asked:
        text = r["text"] or ""
        assert r["at"] == (tokens(library, text[:7]) if text else 0)
        assert r["fit"] == max(i for i in range(min(len(text), 60) + 1) if not i or tokens(library, text[:i]) <= 2)
    assert prefix_token_counts(df.limit(0), PATH).count() == 0
    assert np.all([len(r["prefix_tokens"]) == len(r["text"] or "") for r in got])
