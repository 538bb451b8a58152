"""Token counts of every prefix of a text, without re-encoding it.

A byte-pair encoding of a prefix is found by dynamic programming: the last token
of prefix ``j`` is the one vocabulary entry ``t`` ending there that may follow the
last token of the prefix before it, and then ``count[j] = count[j - len(t)] + 1``.
Two tokens may follow each other exactly if their joint bytes encode to just the
two of them, and such a chain is unique, so the counts equal those of the
library. The library's split into words cuts the work: a distinct word is solved
once per task, and a text's counts are the words' counts on top of what precedes.

The counts are not monotone (``hel`` may take more tokens than ``hello``), hence a
count per prefix: ``count_at`` and ``longest_within`` answer any truncation or
budget question from the stored array.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adloom.llm.words import batches

#: Words solved once and kept by a task; the store is emptied when full.
KEEP_WORDS = 800_000
KEEP_PAIRS = 700_000
LONGEST_KEPT = 64

# Characters whose class (letter, number, blank, other) no Unicode version changes. A text
# with any other one is split by the library itself, which is slower.
_PLAIN_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_PLAIN_NUMBERS = "0-9²³¹¼-¾"
_UNUSUAL = re.compile("[^\t\n\r\x20-\x7e¡-ɏ‐-‧‰-⁞€]")
# The English endings that the vocabulary's splitting rule keeps apart.
_ENDINGS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
_SPLIT = re.compile(
    "|".join(_ENDINGS)
    + f"| ?[{_PLAIN_LETTERS}]+| ?[{_PLAIN_NUMBERS}]+| ?[^\\s{_PLAIN_LETTERS}{_PLAIN_NUMBERS}]+|\\s+(?!\\S)|\\s+"
)
_BLANK_RUN = re.compile(r"\s\s+")


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in the vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class PrefixCounter:
    """Counts of a byte-level vocabulary file of the ``tokenizers`` library."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = _byte_letters()
        raw = lambda s: "".join(chr(letters[c]) for c in s)
        pairs = (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
        self.ranks = {(raw(a), raw(b)): i for i, (a, b) in enumerate(pairs)}
        self.matches = ahocorasick.Automaton()
        for token in map(raw, spec["model"]["vocab"]):
            self.matches.add_word(token, token)
        self.matches.make_automaton()
        self.special = [t["content"] for t in spec["added_tokens"] if t["special"]]
        self.split_special = re.compile("|".join(map(re.escape, self.special)) or "(?!)")
        self.library = Tokenizer.from_file(path)
        self.made = {}
        for (a, b), rank in self.ranks.items():
            if a + b in self.made:
                raise ValueError("two merges make the same token")
            self.made[a + b] = (rank, (a, b))
        self.spines: tuple[dict, dict] = ({}, {})
        self.fits: dict[tuple[str, str], bool] = {}
        self.kept: dict[str, bytes] = {}

    def _spine(self, token: str, side: int) -> list[tuple[str, int]]:
        """Symbols at one end of a token while it is merged, each with the rank of the merge that ends it."""
        kept = self.spines[side].get(token)
        if kept is None:
            kept, symbol, until = [], token, 1 << 60
            while True:
                kept.append((symbol, until))
                if symbol not in self.made:
                    break
                until, parts = self.made[symbol]
                symbol = parts[side]
            self.spines[side][token] = kept
        return kept

    def _follows(self, before: str, token: str) -> bool:
        """Whether no merge joins the two across their border before each is complete.

        Of equal merges the one further left comes first, hence the two comparisons.
        """
        if len(self.fits) >= KEEP_PAIRS:
            self.fits.clear()
        starts = self._spine(token, 0)
        known = not any(
            (rank := self.ranks.get((x, y))) is not None and rank < x_until and rank <= y_until
            for x, x_until in self._spine(before, 1)
            for y, y_until in starts
        )
        self.fits[before, token] = known
        return known

    def _solve(self, word: str) -> list[int]:
        """Exact count at the end of every character of a word that the library doesn't split."""
        data = word.encode().decode("latin-1")
        last, count = [""], [0]
        for end, token in self.matches.iter(data):
            if len(last) == end + 2:
                continue
            start = end + 1 - len(token)
            before = last[start]
            known = self.fits.get((before, token)) if start else True
            if known or known is None and self._follows(before, token):
                last.append(token)
                count.append(count[start] + 1)
        if len(data) == len(word):
            return count[1:]
        ends = [i for i in range(1, len(data) + 1) if i == len(data) or ord(data[i]) & 0xC0 != 0x80]
        return [count[i] for i in ends]

    def _word(self, word: str) -> bytes | np.ndarray:
        """Counts of a word's prefixes; bytes if they fit and the word is short enough to keep."""
        if word in _ENDINGS:
            counts = [sum(self._solve(p)[-1] for p in _SPLIT.findall(word[: i + 1])) for i in range(len(word))]
        else:
            counts = self._solve(word)
        if len(word) > LONGEST_KEPT or counts[-1] > 255:
            return np.array(counts, np.int32)
        if len(self.kept) >= KEEP_WORDS:
            self.kept.clear()
        self.kept[word] = bytes(counts)
        return self.kept[word]

    def _pieces(self, text: str) -> list[str]:
        if _UNUSUAL.search(text) is None:
            return _SPLIT.findall(text)
        return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def _ordinary(self, text: str) -> np.ndarray:
        pieces = self._pieces(text)
        kept = self.kept
        parts = [kept[p] if p in kept else self._word(p) for p in pieces]
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        if set(map(type, parts)) != {bytes}:
            own = np.concatenate([np.frombuffer(p, np.uint8).astype(np.int32) if type(p) is bytes else p for p in parts])
        else:
            own = np.frombuffer(b"".join(parts), np.uint8).astype(np.int32)
        ends = np.cumsum(sizes)
        totals = own[ends - 1]
        before = np.cumsum(totals) - totals
        counts = own + np.repeat(before, sizes).astype(np.int32)
        # A prefix that ends in blanks has them as one piece, although the whole text
        # leaves the last of them to the word that follows.
        for run in _BLANK_RUN.finditer(text):
            a, b = run.span()
            if b < len(text):
                solved = kept.get(run[0]) or self._word(run[0])
                counts[b - 1] = (counts[a - 1] if a else 0) + solved[-1]
        return counts

    def counts(self, text: str) -> np.ndarray:
        """Number of tokens of ``text[:1]``, ``text[:2]`` and so on; empty for no text."""
        if not text:
            return np.zeros(0, np.int32)
        found, at, base = [], 0, 0
        for special in self.split_special.finditer(text):
            # Inside the special string a prefix is still ordinary text.
            counts = self._ordinary(text[at : special.end() - 1])
            before = int(counts[special.start() - at - 1]) if special.start() > at else 0
            found += [counts + base, np.array([base + before + 1], np.int32)]
            base, at = base + before + 1, special.end()
        if at < len(text):
            found.append(self._ordinary(text[at:]) + base)
        return np.concatenate(found).astype(np.int32)


_counters: dict[str, PrefixCounter] = {}


def _counter(path: str) -> PrefixCounter:
    if path not in _counters:
        _counters[path] = PrefixCounter(path)
    return _counters[path]


def prefix_token_counts(
    df: DataFrame, path: str, text: str = "text", limit: int = 1024, keep_prefixes: bool = True
) -> DataFrame:
    """Add ``prefix_tokens``, ``n_tokens``, ``n_bytes`` and ``fit_chars`` to every row.

    ``prefix_tokens[i]`` is the token count of the first ``i + 1`` characters and
    ``fit_chars`` the length of the longest prefix of at most ``limit`` tokens; both
    follow the library's defaults for special strings. Null and empty texts have no
    prefix and 0 elsewhere. Rows, repeated or not, stay apart; other columns are kept,
    and ones of the added names are replaced. No shuffle: one pass over the input.
    ``keep_prefixes=False`` leaves the array out where only totals are wanted.
    """
    added = ["prefix_tokens", "n_tokens", "n_bytes", "fit_chars"]
    kept = [c for c in df.columns if c not in added]
    where = kept.index(text)

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path)
        for batch in batches(found):
            prefixes, total, size, fit = [], [], [], []
            for value in batch.column(where).to_pylist():
                counts = counter.counts(value or "")
                prefixes.append(counts)
                total.append(int(counts[-1]) if len(counts) else 0)
                size.append(len((value or "").encode()))
                within = np.flatnonzero(counts <= limit)
                fit.append(int(within[-1]) + 1 if len(within) else 0)
            columns = [*batch.columns]
            if keep_prefixes:
                columns.append(pa.array(prefixes, pa.list_(pa.int32())))
            columns += [pa.array(x, pa.int64()) for x in (total, size, fit)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    names = kept + added[not keep_prefixes :]
    base = df.select(*[f"`{c}`" for c in kept])
    kinds = {"prefix_tokens": T.ArrayType(T.IntegerType())}
    fields = [T.StructField(c, kinds.get(c, T.LongType())) for c in added[not keep_prefixes :]]
    schema = T.StructType(list(base.schema.fields) + fields)
    return base.mapInArrow(run, schema)


def count_at(prefix_tokens: Column, n_chars: Column) -> Column:
    """Tokens of the first ``n_chars`` characters, from the stored counts."""
    last = F.least(n_chars, F.size(prefix_tokens))
    return F.when(last <= 0, F.lit(0)).otherwise(F.element_at(prefix_tokens, last.cast("int")))


def longest_within(prefix_tokens: Column, budget: Column) -> Column:
    """Characters of the longest prefix of at most ``budget`` tokens, from the stored counts."""
    at = F.sequence(F.lit(1), F.size(prefix_tokens))
    fits = F.filter(at, lambda i: F.element_at(prefix_tokens, i) <= budget)
    return F.when(F.size(prefix_tokens) == 0, F.lit(0)).otherwise(F.coalesce(F.array_max(fits), F.lit(0)))
