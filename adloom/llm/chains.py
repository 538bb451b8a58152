"""Fuzzy passages shared between documents, by collinear chaining of word seeds.

1. Seeds are all k-mers of words, none left out. In 50 words of which 10 are changed one by
   one, 40 words stand in 11 runs at most and so hold 40 - 11 * (``SEED`` - 1) = 7 seeds or more.
   Runs of ``LONG`` words are seeds as well: of every ``WINDOW`` that begin one after the other
   the one with the least hash, so both copies of ``LONG + WINDOW - 1`` words choose the same.
2. Seeds are joined by value. An occurrence is linked first with the first document that has
   the seed and with the one just before its own: those links grow with the occurrences, and
   a passage that many documents share chains with its first copy and with its nearest one.
3. Where these links leave words that no sure passage covers, a seed is looked for with all of its
   earlier holders, except for the few in any ``min_words`` words that have the most: of the 7
   or more seeds of a passage one is left at least, whatever the others are. Occurrence and
   holders meet with the words around them, and are linked where those agree, too
   (``around.py``): most holders of a frequent line share nothing but the line.
4. Per document and partner, matches are chained in order of both texts: each seed scores,
   each word of a gap in either text costs, and a Fenwick tree gives the best chain to
   join.
5. Chains are grown at both ends and aligned word by word between the words on which both
   texts surely agree. The longest parts of ``min_words`` words and ``num / den`` identity or
   more are passages: a chain over several of them, with foreign text between, gives each.
   A document's passages are taken by the score of their chains as long as they cover new words.

Seeds are cut where the texts are read; only packed numbers travel, seeds by value and
links by document. Links and chains are written tables, after which the exchanges are cleared.
Words around seeds go to the seeds' buckets. Then texts go to hash batches once, and both sides of a chain are read there.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adloom.llm import around
from adloom.llm.words import BLANKS, LOWER, mix, order_by, shingles, text_buffer, words
from adloom.llm.words import batches as pieces
from adloom.operators.joins import size_checked
from adloom.session import materialize

SEED = 4
#: Words of a long seed, how many that begin one after the other have one chosen, and the matches one stands for.
LONG = 32
WINDOW = 16
STEPS = (0, 14, 28)
SEED_SCORE = 10.0
GAP_COST = 0.15
MIN_SEEDS = 3
#: Words a chain may grow by at either end.
MARGIN = 24
#: Links with further holders that are made at once.
LINK_BLOCK = 1_000_000
#: Seeds of a passage that are looked for with all holders, at least: one, since what it leads to is compared.
MET_SEEDS = 1
#: Words looked ahead, in either text, for the next match after a difference.
RESYNC = 12
#: Words that must agree after a difference for a chain to grow over it, or to anchor an alignment.
SURE = 3
#: Share of a passage's words that passages of the document's better chains must not cover yet.
NEW_WORDS = 0.2
BATCH_BYTES = 3 << 20
#: Bits by which the seeds of one bucket are told apart: two of them meet by chance once in a million, and aligning tells.
KEY_BITS = 40
#: Bytes of text whose seeds one bucket gets, about.
BUCKET_BYTES = 4 << 20


class _Texts:
    """Word hashes of the documents of a batch; of rows with the same id, the first by text takes part."""

    def __init__(self, table: pa.Table) -> None:
        ids = table.column("doc_id").to_pylist()
        self.data, self.at = text_buffer(table.column("text"))
        self.hashes, self.first, self.end, self.starts = words(self.data, self.at, BLANKS, LOWER)
        self.row: dict[int, int] = {}
        for i, number in enumerate(ids):
            if number is not None and (number not in self.row or self._text(i) < self._text(self.row[number])):
                self.row[number] = i

    def _text(self, i: int) -> bytes:
        return self.data[self.at[i] : self.at[i + 1]].tobytes()

    def words(self, number: int) -> np.ndarray:
        i = self.row[number]
        return self.hashes[self.starts[i] : self.starts[i + 1]]


def _long(short: np.ndarray) -> np.ndarray:
    """Hash of ``LONG`` words from each word on, by doubling what ``SEED`` words have."""
    found, words_ = short, SEED
    while words_ < LONG:
        after = np.zeros_like(found)
        after[:-words_] = found[words_:]
        found = mix(found * np.uint64(0xD1B54A32D192ED03) + after)
        words_ *= 2
    return found


def _over_windows(values: np.ndarray, least: np.ufunc, size: int) -> np.ndarray:
    """Least (or greatest) of every ``size`` values in a row, a power of two, by doubling."""
    step = 1
    while step < size:
        values = least(values[:-step], values[step:])
        step *= 2
    return values


def _chosen(keys: np.ndarray) -> np.ndarray:
    """Places of the least key of every ``WINDOW`` in a row; of all if there are fewer."""
    if len(keys) <= WINDOW:
        return np.flatnonzero(keys == keys.min()) if len(keys) else np.zeros(0, np.int64)
    least = _over_windows(keys, np.minimum, WINDOW)
    # A key is the least of some window if the greatest of the minima around it is the key itself.
    edge = np.zeros(WINDOW - 1, np.uint64)
    return np.flatnonzero(_over_windows(np.concatenate([edge, least, edge]), np.maximum, WINDOW) == keys)


def _seeds(texts: _Texts) -> np.ndarray:
    """Value, document and place of the seeds; the place doubled, and one more for a long seed."""
    short, whole = shingles(texts.hashes, texts.starts, SEED)
    long = _long(short)
    parts = []
    for number, i in texts.row.items():
        a, b = texts.starts[i], texts.starts[i + 1]
        own = short[a:b][whole[a:b]]
        if len(own):
            parts.append(np.stack([own.view(np.int64), np.full(len(own), number, np.int64), 2 * np.arange(len(own))]))
        if b - a >= LONG:
            runs_ = long[a : b - LONG + 1]
            at = _chosen(runs_)
            parts.append(np.stack([runs_[at].view(np.int64), np.full(len(at), number, np.int64), 2 * at + 1]))
    return np.concatenate(parts, axis=1) if parts else np.zeros((3, 0), np.int64)


def _matches(links: np.ndarray) -> np.ndarray:
    """Links sorted, with the places of their matches, each once; a long one stands for several."""
    long = links[2] % 2 == 1
    places = links.copy()
    places[2:] >>= 1
    more = [places[:, ~long]]
    for step in STEPS:
        own = places[:, long].copy()
        own[2:] += step
        more.append(own)
    return _distinct(np.concatenate(more, axis=1))


def _distinct(found: np.ndarray) -> np.ndarray:
    """Matches in order, each once."""
    found = found[:, order_by(*found)]
    new = np.ones(found.shape[1], bool)
    new[1:] = (found[:, 1:] != found[:, :-1]).any(axis=0)
    return found[:, new]


def _links(seeds: np.ndarray) -> np.ndarray:
    """Document, partner, place in either, for each occurrence of a seed, in order, that an earlier document has."""
    key, doc, place = seeds
    if not len(key):
        return np.zeros((4, 0), np.int64)
    new_key = np.concatenate(([True], key[1:] != key[:-1]))
    new_run = new_key | np.concatenate(([True], doc[1:] != doc[:-1]))
    start = np.flatnonzero(new_key)[np.cumsum(new_key) - 1]
    runs = np.flatnonzero(new_run)
    run = np.cumsum(new_run) - 1
    later = np.flatnonzero(runs[run] != start)
    before = runs[run[later] - 1]
    far = before != start[later]
    source = np.concatenate([start[later], before[far]])
    own = np.concatenate([later, later[far]])
    return np.stack([doc[own], doc[source], place[own], place[source]])


def _often(seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What ``_links`` leaves out: occurrences with holders between the first and the nearest, and who holds their seeds.

    The former as document, place, number of earlier holders and seed; the latter as seed,
    document and its first place, by seed and document.
    """
    key, doc, place = seeds[:, seeds[2] % 2 == 0]
    if not len(key):
        return np.zeros((4, 0), np.int64), np.zeros((3, 0), np.int64)
    new_key = np.concatenate(([True], key[1:] != key[:-1]))
    new_run = new_key | np.concatenate(([True], doc[1:] != doc[:-1]))
    run = np.cumsum(new_run) - 1
    first = run[new_key][np.cumsum(new_key) - 1]
    earlier = run - first
    rest = earlier > 2
    often = np.zeros(run[-1] + 1, bool)
    often[first[rest]] = True
    held = new_run & often[first]
    return np.stack([doc[rest], place[rest] >> 1, earlier[rest], key[rest]]), np.stack([key[held], doc[held], place[held] >> 1])


def _further(asked: np.ndarray, held: np.ndarray) -> Iterator[np.ndarray]:
    """Links of the asked occurrences (seed, document, place) with all earlier holders but the first and the nearest.

    The plain form of what ``around.alike`` picks from: that many links are too many to be made.
    """
    held = held[:, order_by(held[0], held[1])]
    # Seed and document as one number: held rows are in order of it.
    keys, docs = np.unique(held[0]), np.unique(held[1])
    whose = np.searchsorted(keys, held[0]) * len(docs) + np.searchsorted(docs, held[1])
    own = np.searchsorted(keys, asked[0]) * len(docs) + np.searchsorted(docs, asked[1])
    low = np.searchsorted(held[0], asked[0]) + 1
    many = np.maximum(np.searchsorted(whose, own) - 1 - low, 0)
    after = np.cumsum(many)
    a = 0
    while a < len(many):
        b = max(a + 1, int(np.searchsorted(after, (after[a - 1] if a else 0) + LINK_BLOCK, side="right")))
        n = many[a:b]
        ask = np.repeat(np.arange(a, b), n)
        at = np.arange(len(ask)) - np.repeat(np.cumsum(n) - n, n) + low[ask]
        yield np.stack([asked[1, ask], held[1, at], asked[2, ask], held[2, at]])
        a = b


def _pairs(links: np.ndarray) -> np.ndarray:
    """Documents and partners of links in order, each pair once."""
    docs, sources = np.unique(links[0]), np.unique(links[1])
    number = np.unique(np.searchsorted(docs, links[0]) * len(sources) + np.searchsorted(sources, links[1]))
    return np.stack([docs[number // len(sources)], sources[number % len(sources)]])


def _stretches(new: np.ndarray, p: np.ndarray, q: np.ndarray, min_words: int, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last match of the stretches, begun where ``new`` says, whose seeds alone have the identity."""
    first, last = np.flatnonzero(np.concatenate(([True], new))), np.flatnonzero(np.concatenate((new, [True])))
    step = np.minimum(np.diff(p), np.diff(q))
    agree = np.concatenate(([0], np.cumsum(np.append(np.where(new, SEED, np.minimum(step, SEED)), SEED))))
    own, other = p[last] + SEED - p[first], q[last] + SEED - q[first]
    sure = (own >= min_words) & (2 * den * (agree[last + 1] - agree[first]) >= num * (own + other))
    return first[sure], last[sure]


def _surely(matches: np.ndarray, min_words: int, num: int, den: int) -> np.ndarray:
    """Document, start and end of stretches that are passages by the words of their seeds alone.

    Those of one diagonal, and those that go on over short gaps of any length in either text. Matches are in order.
    """
    doc, source, p, q = matches
    if not len(doc):
        return np.zeros((3, 0), np.int64)
    out = []
    for order in (order_by(doc, source, p - q, p), slice(None)):
        d, x, own, other = (c[order] for c in (doc, source, p, q))
        new = (np.diff(d) != 0) | (np.diff(x) != 0)
        for step in (np.diff(own), np.diff(other)):
            new |= (step <= 0) | (step > 2 * SEED_SCORE)
        if not out:
            new |= np.diff(own) != np.diff(other)
        first, last = _stretches(new, own, other, min_words, num, den)
        out.append(np.stack([d[first], own[first], own[last] + SEED]))
    return np.concatenate(out, axis=1)


def _asking(rest: np.ndarray, matches: np.ndarray, sure: np.ndarray, min_words: int, num: int, den: int) -> np.ndarray:
    """Which occurrences are to be looked for with all earlier holders.

    Those with enough words around them that no sure passage covers, except in any ``min_words``
    words the few seeds with most holders that a passage can do without. ``rest`` is in order
    of document and place.
    """
    doc, place, earlier = rest[:3]
    if not len(doc):
        return np.zeros(0, bool)
    seeds = min_words - SEED + 1
    changed = min_words * (den - num) // den
    spare = max(min_words - changed - (changed + 1) * (SEED - 1) - MET_SEEDS, 0)
    more = np.zeros(len(doc), np.int64)
    for step in range(1, len(doc)):
        near = (doc[step:] == doc[:-step]) & (place[step:] - place[:-step] < seeds)
        if not near.any():
            break
        earlier_first = earlier[:-step] >= earlier[step:]
        more[step:] += near & earlier_first
        more[:-step] += near & ~earlier_first
    # Words of all documents in a row, each up to its last seed that another has.
    numbers, at = np.unique(np.concatenate([matches[0], doc]), return_inverse=True)
    length = np.zeros(len(numbers), np.int64)
    np.maximum.at(length, at, np.concatenate([matches[2], place]) + SEED)
    starts = np.concatenate(([0], np.cumsum(length)))
    cover = np.zeros(starts[-1] + 1, np.int64)
    known, a, b = sure
    known = np.searchsorted(numbers, known)
    np.add.at(cover, starts[known] + a, 1)
    np.add.at(cover, starts[known] + b, -1)
    left = np.concatenate(([0], np.cumsum(np.cumsum(cover[:-1]) == 0)))
    own = np.searchsorted(numbers, doc)
    low = np.maximum(starts[own] + place + SEED - min_words, starts[own])
    high = np.minimum(starts[own] + place + min_words, starts[own + 1])
    return (left[high] - left[low] >= NEW_WORDS * min_words) & (more >= spare)


def _apart(rest: np.ndarray, apart: int) -> np.ndarray:
    """Which occurrences are the first of their seed in a stretch of so many places of their document."""
    doc, place, _, key, bucket = rest
    order = order_by(doc, bucket, key, place)
    where = np.stack([doc, bucket, key, place // apart])[:, order]
    out = np.zeros(len(order), bool)
    out[order[np.append(True, (where[:, 1:] != where[:, :-1]).any(axis=0))[: len(order)]]] = True
    return out


def _near(matches: np.ndarray, rest: np.ndarray, words_: int) -> np.ndarray:
    """Which matches lie within so many words of an occurrence of their document, of those in order of document and place."""
    docs = np.unique(rest[0])
    at = lambda rows, place: (np.searchsorted(docs, rows[0]) << 32) + place
    asked = np.append(at(rest, rest[1]), np.iinfo(np.int64).max)
    return asked[np.searchsorted(asked[:-1], at(matches, matches[2] - words_))] <= at(matches, matches[2] + words_)


class Fenwick:
    """Best of the values entered at places up to a given one."""

    def __init__(self, n: int) -> None:
        self.best: list[tuple[float, int]] = [(float("-inf"), -1)] * (n + 1)

    def enter(self, at: int, value: tuple[float, int]) -> None:
        at += 1
        while at < len(self.best):
            if value > self.best[at]:
                self.best[at] = value
            at += at & -at

    def up_to(self, at: int) -> tuple[float, int]:
        """Best value at places below ``at``."""
        found = (float("-inf"), -1)
        while at:
            if self.best[at] > found:
                found = self.best[at]
            at -= at & -at
        return found


def chain(p: np.ndarray, q: np.ndarray) -> list[tuple[float, int, int, int, int, int]]:
    """Chains of matches ``(p, q)``, sorted by ``p``: score, first and last places, number of matches.

    Neighbouring matches on one diagonal are one segment first. A chain joins a segment
    to an earlier one that ends before it in both texts; it scores ``SEED_SCORE`` a match
    less ``GAP_COST`` a word between matches. Best chains come first, none shares a segment.
    """
    step = (np.diff(p) == np.diff(q)) & (np.diff(p) > 0) & (np.diff(p) <= 2 * SEED_SCORE)
    cuts = np.concatenate(([0], np.flatnonzero(~step) + 1, [len(p)]))
    a, b = cuts[:-1], cuts[1:] - 1
    value = (SEED_SCORE * (b - a + 1) - 2 * GAP_COST * (p[b] - p[a])).tolist()
    p0, p1, q0, q1, n = (x.tolist() for x in (p[a], p[b], q[a], q[b], b - a + 1))
    if len(a) == 1:
        return [(value[0], p0[0], p1[0], q0[0], q1[0], n[0])]
    places = np.unique(q[b])
    rank_in, rank_out = np.searchsorted(places, q[a]).tolist(), np.searchsorted(places, q[b]).tolist()
    tree, score, back = Fenwick(len(places)), list(value), [-1] * len(a)
    ends = sorted(range(len(a)), key=p1.__getitem__)
    entered = 0
    for i in sorted(range(len(a)), key=p0.__getitem__):
        while entered < len(ends) and p1[ends[entered]] < p0[i]:
            j = ends[entered]
            tree.enter(rank_out[j], (score[j] + GAP_COST * (p1[j] + q1[j]), j))
            entered += 1
        best, j = tree.up_to(rank_in[i])
        gain = best - GAP_COST * (p0[i] + q0[i])
        if j >= 0 and gain > 0:
            score[i], back[i] = value[i] + gain, j
    used, out = [False] * len(a), []
    for i in sorted(range(len(a)), key=lambda x: -score[x]):
        if used[i]:
            continue
        last, at, count = i, i, 0
        while at >= 0 and not used[at]:
            used[at] = True
            count += n[at]
            first, at = at, back[at]
        total = score[last] - (score[at] if at >= 0 else 0.0)
        out.append((total, p0[first], p1[last], q0[first], q1[last], count))
    return out


def _in_a_row(
    first: np.ndarray, last: np.ndarray, whose: np.ndarray, p: np.ndarray, q: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """What ``chain`` finds for pairs whose segments (first and last match) follow each other in both texts.

    First and last match of the chains, their scores in hundredths, and the number of matches. A segment's
    best predecessor is the one before it; a chain ends where no later segment that is joined to it scores more.
    """
    n = last - first + 1
    if not len(n):
        return (np.zeros(0, np.int64),) * 4
    gap = round(100 * GAP_COST)
    value = round(100 * SEED_SCORE) * n - 2 * gap * (p[last] - p[first])
    cost = gap * (p[first[1:]] - p[last[:-1]] + q[first[1:]] - q[last[:-1]])
    same = np.diff(whose) == 0
    # What a segment has from those before it: sums that start anew where they fall below zero, or a pair begins.
    sums = np.concatenate(([0], np.cumsum(np.where(same, value[:-1] - cost, 0))))
    step = int(sums.max() - sums.min()) + 1
    level = sums - step * whose.astype(np.int64)
    before = level - np.minimum.accumulate(level)
    score = value + before
    joined = np.concatenate(([False], same & (before[1:] > 0)))
    run = np.cumsum(~joined) - 1
    # The best of what is left ends a chain: no later one of its run scores more.
    step = int(score.max() - score.min()) + 1
    rank = (score - step * run.astype(np.int64))[::-1]
    later = np.concatenate((np.maximum.accumulate(rank)[::-1][1:], [np.iinfo(np.int64).min]))
    end = np.flatnonzero((rank[::-1] >= later) | np.append(run[1:] != run[:-1], True))
    begin = np.concatenate(([0], end[:-1] + 1))
    total = score[end] - np.where(joined[begin], score[np.maximum(begin - 1, 0)], 0)
    sums = np.concatenate(([0], np.cumsum(n)))
    return first[begin], last[end], total, sums[end + 1] - sums[begin]


def _chains(links: np.ndarray, min_words: int, wide: np.ndarray | None = None) -> np.ndarray:
    """The chains, from sorted links, that can grow to a passage.

    Partner, its range, document, its range, score in hundredths, and words by which either end may
    grow: ``min_words`` for the pairs (document, partner) in ``wide``, of which seeds may be missing.
    """
    if not links.shape[1]:
        return np.zeros((8, 0), np.int64)
    doc, source, p, q = links
    new = np.concatenate(([True], (np.diff(doc) != 0) | (np.diff(source) != 0)))
    step = np.diff(p)
    cut = new.copy()
    cut[1:] |= (step != np.diff(q)) | (step <= 0) | (step > 2 * SEED_SCORE)
    pair, ends = np.flatnonzero(new), np.append(np.flatnonzero(new)[1:], len(doc))
    margin = np.full(len(pair), MARGIN)
    if wide is not None:
        docs, sources = np.unique(doc), np.unique(source)
        number = lambda d, x: np.searchsorted(docs, d) * len(sources) + np.searchsorted(sources, x)
        margin[np.isin(number(doc[pair], source[pair]), number(*wide))] = max(min_words, MARGIN)
    count = ends - pair
    # A pair of a single segment is a chain as it stands.
    one = (np.add.reduceat(cut.astype(np.int64), pair) == 1) & (count >= MIN_SEEDS)
    a, b, n = pair[one], ends[one] - 1, count[one]
    score = np.rint(100 * (SEED_SCORE * n - 2 * GAP_COST * (p[b] - p[a]))).astype(np.int64)
    plain = np.stack([source[a], q[a], q[b] + SEED, doc[a], p[a], p[b] + SEED, score, margin[one]])
    # Segments of a pair that follow each other in both texts need no tree.
    begins = np.flatnonzero(cut)
    first, last = begins, np.append(begins[1:], len(doc)) - 1
    whose = np.cumsum(new[begins]) - 1
    behind = (p[last[:-1]] < p[first[1:]]) & (q[last[:-1]] < q[first[1:]])
    tangled = np.bincount(whose[1:][~behind & (np.diff(whose) == 0)], minlength=len(pair)) > 0
    row = ~one & ~tangled & (count >= MIN_SEEDS)
    some = row[whose]
    a, b, total, n = _in_a_row(first[some], last[some], whose[some], p, q)
    a, b, total, n, i = (x[n >= MIN_SEEDS] for x in (a, b, total, n, np.searchsorted(pair, a, side="right") - 1))
    strung = np.stack([source[a], q[a], q[b] + SEED, doc[a], p[a], p[b] + SEED, total, margin[i]])
    out = []
    for i in np.flatnonzero(~one & ~row & (count >= MIN_SEEDS)).tolist():
        a, b = int(pair[i]), int(ends[i])
        for score, p0, p1, q0, q1, n in chain(p[a:b], q[a:b]):
            if n >= MIN_SEEDS:
                out.append((int(source[a]), q0, q1 + SEED, int(doc[a]), p0, p1 + SEED, round(100 * score), int(margin[i])))
    found = np.concatenate([plain, strung, np.array(out, np.int64).reshape(-1, 8).T], axis=1)
    return found[:, found[5] - found[4] + 2 * found[7] >= min_words]


def _run(x: np.ndarray, y: np.ndarray) -> int:
    """Words that two sequences have in common from the start."""
    n, done, step = min(len(x), len(y)), 0, 32
    while done < n:
        same = x[done : min(done + step, n)] == y[done : min(done + step, n)]
        if not same.all():
            return done + int(same.argmin())
        done, step = done + len(same), step * 4
    return n


def _next(x: np.ndarray, y: np.ndarray) -> tuple[int, int]:
    """Words to pass over in each sequence up to the nearest match; ``RESYNC`` in both without one."""
    rows, cols = np.nonzero(x[:RESYNC, None] == y[None, :RESYNC])
    if not len(rows):
        return RESYNC, RESYNC
    best = np.lexsort((np.abs(rows - cols), rows + cols))[0]
    return int(rows[best]), int(cols[best])


def _nearest_first(x: np.ndarray, y: np.ndarray) -> list[tuple[int, int, int]]:
    """Runs ``(place, place, words)`` on which two sequences agree, differences resolved nearest first."""
    i = j = 0
    found = []
    while i < len(x) and j < len(y):
        run = _run(x[i:], y[j:])
        if run:
            found.append((i, j, run))
        i, j = i + run, j + run
        a, b = _next(x[i:], y[j:])
        i, j = i + a, j + b
    return found


def _between(x: np.ndarray, y: np.ndarray) -> list[tuple[int, int, int]]:
    """Runs on which the stretches between two anchors agree: a long one belongs to the nearer anchor by halves."""
    if max(len(x), len(y)) <= 2 * RESYNC:
        return _nearest_first(x, y)
    a, b = len(x) // 2, len(y) // 2
    late = _nearest_first(x[a:][::-1], y[b:][::-1])
    return _nearest_first(x[:a], y[:b]) + [(len(x) - i - n, len(y) - j - n, n) for i, j, n in reversed(late)]


def _anchors(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where ``SURE`` words begin that stand once in either sequence: the longest series in order of both."""
    once = []
    for z in (x, y):
        n = max(len(z) - SURE + 1, 0)
        key = np.zeros(n, np.uint64)
        for j in range(SURE):
            key = key * np.uint64(0x9E3779B97F4A7C15) + z[j : j + n]
        value, place, count = np.unique(key, return_index=True, return_counts=True)
        once.append((value[count == 1], place[count == 1]))
    _, a, b = np.intersect1d(once[0][0], once[1][0], assume_unique=True, return_indices=True)
    p, q = once[0][1][a], once[1][1][b]
    order = np.argsort(p)
    p, q = p[order], q[order]
    if (np.diff(q) < 0).any():
        least, at, back = [], [], []
        for n, place in enumerate(q.tolist()):
            k = bisect_left(least, place)
            back.append(at[k - 1] if k else -1)
            least[k : k + 1], at[k : k + 1] = [place], [n]
        kept, n = [], at[-1]
        while n >= 0:
            kept.append(n)
            n = back[n]
        p, q = p[kept[::-1]], q[kept[::-1]]
    return p, q


def runs(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Runs (place, place, words) on which two sequences agree when they are aligned from end to end."""
    if len(x) == len(y) and (x == y).all():
        return np.array([[0], [0], [len(x)]])
    p, q = _anchors(x, y)
    cuts = [0, *(np.flatnonzero((np.diff(p) != 1) | (np.diff(q) != 1)) + 1).tolist(), len(p)] if len(p) else [0]
    sure = [(int(p[a]), int(q[a]), b - a) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    i = j = 0
    found: list[tuple[int, int, int]] = []
    for a, b, n in [*sure, (len(x), len(y), 0)]:
        for u, v, m in [*((i + u, j + v, m) for u, v, m in _between(x[i:a], y[j:b])), (a, b, n)]:
            if found and found[-1][0] + found[-1][2] == u and found[-1][1] + found[-1][2] == v:
                found[-1] = (*found[-1][:2], found[-1][2] + m)
            elif m:
                found.append((u, v, m))
        i, j = a + n, b + n
    return np.array(found, np.int64).reshape(-1, 3).T


def align(x: np.ndarray, y: np.ndarray) -> int:
    """Words matched when two sequences are aligned from end to end."""
    return int(runs(x, y)[2].sum())


def parts(found: np.ndarray, min_words: int, num: int, den: int) -> list[tuple[int, int]]:
    """First and last run of the longest part of an alignment that is a passage, and of those on either side of it.

    Matched words score what they are above the bound and the others cost what they are below it, so a
    part has the identity if its sum is not negative.
    """
    p, q, n = found
    gaps = np.concatenate(([0], np.cumsum((p[1:] - p[:-1] - n[:-1]) + (q[1:] - q[:-1] - n[:-1]))))
    gain = np.concatenate(([0], np.cumsum(2 * (den - num) * n)))
    before, after = gain[:-1] - num * gaps, gain[1:] - num * gaps
    out, left = [], [(0, len(p))]
    while left:
        a, b = left.pop()
        if a == b:
            continue
        best = np.maximum.accumulate(after[a:b][::-1])[::-1]
        last = a + np.searchsorted(-best, -before[a:b], side="right") - 1
        words = p[last] + n[last] - p[a:b]
        first = a + int(words.argmax())
        if words[first - a] >= min_words:
            out.append((first, int(last[first - a])))
            left += [(a, first), (out[-1][1] + 1, b)]
    return sorted(out)


def grow(x: np.ndarray, y: np.ndarray) -> tuple[int, int]:
    """Words by which a chain's end moves on in each text: over differences that a run of ``SURE`` words follows."""
    i = j = 0
    while True:
        run = _run(x[i:], y[j:])
        i, j = i + run, j + run
        a, b = _next(x[i:], y[j:])
        if _run(x[i + a :], y[j + b :]) < SURE:
            return i, j
        i, j = i + a, j + b


def _last_seed(x: np.ndarray, y: np.ndarray) -> int:
    """End of the last ``SEED`` words on which two sequences agree at the same place."""
    n = min(len(x), len(y))
    same = np.concatenate(([0], np.cumsum(x[:n] == y[:n])))
    ends = np.flatnonzero(same[SEED:] - same[:-SEED] == SEED)
    return int(ends[-1]) + SEED if len(ends) else 0


def _narrow(columns: np.ndarray) -> bytes:
    """Columns of numbers, each as its least value, a width, and what exceeds the least in so many bytes, like by like."""
    out = [np.int64(columns.shape[1]).tobytes()]
    for column in columns:
        low = column.min()
        above = column.view(np.uint64) - low.view(np.uint64)
        width = (int(above.max()).bit_length() + 7) // 8
        planes = above.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T
        out += [np.array([low, width], np.int64).tobytes(), planes.tobytes()]
    return b"".join(out)


def _wide(packed: bytes, n_columns: int) -> np.ndarray:
    """The columns that ``_narrow`` packed."""
    n, at = int(np.frombuffer(packed, np.int64, 1)[0]), 8
    out = np.empty((n_columns, n), np.int64)
    for row in out:
        low, width = np.frombuffer(packed, np.int64, 2, at)
        above = np.zeros((n, 8), np.uint8)
        above[:, :width] = np.frombuffer(packed, np.uint8, n * int(width), at + 16).reshape(int(width), n).T
        row[:] = (above.view("<u8")[:, 0] + low.view(np.uint64)).view(np.int64)
        at += 16 + n * int(width)
    return out


def _packed(batches: np.ndarray, columns: np.ndarray) -> list[tuple[int, bytes]]:
    order = np.argsort(batches, kind="stable")
    batches, columns = batches[order], np.ascontiguousarray(columns[:, order])
    cuts = [0, *(np.flatnonzero(np.diff(batches)) + 1).tolist(), len(batches)] if len(batches) else [0]
    return [(int(batches[a]), _narrow(columns[:, a:b])) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _unpacked(column: pa.ChunkedArray, n_columns: int, part: int = 0, parts: int = 1) -> np.ndarray:
    """The columns of all rows; those of one of several parts, dealt by the first."""
    found = (_wide(b.as_py(), n_columns) for b in column)
    kept = [c[:, c[0] % parts == part] if parts > 1 else c for c in found]
    return np.concatenate(kept, axis=1) if kept else np.zeros((n_columns, 0), np.int64)


def _met(asked: np.ndarray, held: np.ndarray) -> np.ndarray:
    """Seed, document, place and what they are (``around.ASKS``, ``around.FIRST``) of the occurrences that meet.

    ``asked`` and ``held`` have seed, document and place: those that ask, and the first ones of
    documents. Only seeds that are asked for meet, with documents before the last that asks.
    """
    keys, whose = np.unique(asked[0], return_inverse=True)
    if not len(keys):
        return np.zeros((4, 0), np.int64)
    latest = np.full(len(keys), np.iinfo(np.int64).min)
    np.maximum.at(latest, whose, asked[1])
    at = np.minimum(np.searchsorted(keys, held[0]), len(keys) - 1)
    held = held[:, (keys[at] == held[0]) & (held[1] < latest[at])]
    kinds = [np.full(x.shape[1], kind) for x, kind in ((asked, around.ASKS), (held, around.FIRST))]
    rows = np.concatenate([np.concatenate([asked, held], axis=1), [np.concatenate(kinds)]])
    rows = rows[:, order_by(*rows[:3])]
    new = np.flatnonzero(np.append(True, (rows[:3, 1:] != rows[:3, :-1]).any(axis=0)))
    return np.concatenate([rows[:3, new], [np.bitwise_or.reduceat(rows[3], new)]])


def _surroundings(texts: _Texts, rows: np.ndarray, sure: np.ndarray, size: around.Size) -> tuple[np.ndarray, np.ndarray]:
    """Rows (bucket, seed, document, place, what it is) with the seed behind each, and the words around them.

    Of asking occurrences of a document that have the same seed and the same words around, the first asks.
    """
    rows = rows[:, np.isin(rows[2], np.array(list(texts.row), np.int64))]
    rows = rows[:, order_by(rows[2], rows[3])]
    lines = np.array([texts.row[d] for d in rows[2].tolist()], np.int64)
    covered = np.zeros(len(texts.hashes) + 1, np.int64)
    for number, a, b in sure.T.tolist():
        if number in texts.row:
            covered[texts.starts[texts.row[number]] + a] += 1
            covered[texts.starts[texts.row[number]] + b] -= 1
    short = around.short_words(texts.hashes) | np.where(np.cumsum(covered[:-1]) == 0, np.uint8(around.NEW), np.uint8(0))
    seen = around.windows(short, texts.starts[lines] + rows[3], texts.starts[lines], texts.starts[lines + 1], size)
    asks = np.flatnonzero(rows[4] & around.ASKS)
    seeds = mix((rows[0] << KEY_BITS | rows[1]).view(np.uint64))
    alike = mix(around.window_keys(seen[asks]) ^ seeds[asks]) ^ mix(rows[2, asks].view(np.uint64))
    again = np.ones(len(asks), bool)
    again[np.unique(alike, return_index=True)[1]] = False
    rows[4, asks[again]] &= ~around.ASKS
    kept = rows[4] > 0
    rows, seen = rows[:, kept], seen[kept]
    # What stands behind an occurrence, if that meets others as well.
    ahead, what = np.zeros(rows.shape[1], np.int64), rows[4].copy()
    next_ = np.flatnonzero((np.diff(rows[2]) == 0) & (np.diff(rows[3]) == 1))
    ahead[next_] = (seeds[kept][next_ + 1] >> np.uint64(32)).view(np.int64)
    for kind, behind in ((around.ASKS, around.NEXT_ASKS), (around.FIRST, around.NEXT_FIRST)):
        what[next_] |= np.where(rows[4, next_ + 1] & kind, behind, 0)
    return np.concatenate([rows[:4], [what, ahead]]), seen


_KINDS = "kind int, at int, n long, packed binary"
_AROUND = "at int, packed binary, words binary"


def _kind(kind: int, rows: list[tuple[int, bytes]], n: int = 0) -> pa.Table:
    """Rows of one kind, each with the group it goes to; the first says how many links they ask for."""
    columns = [kind] * len(rows), [r[0] for r in rows], [n] * len(rows[:1]) + [0] * len(rows[1:]), [r[1] for r in rows]
    kinds = pa.int32(), pa.int32(), pa.int64(), pa.binary()
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["kind", "at", "n", "packed"])


def _sent(key: str, rows: list[tuple[int, bytes]]) -> pa.Table:
    return pa.table({key: pa.array([r[0] for r in rows], pa.int32()), "packed": pa.array([r[1] for r in rows], pa.binary())})


def _batch_of(numbers: np.ndarray, batches: int) -> np.ndarray:
    """Batch of each id, as the SQL expression in ``find_passages`` has it."""
    distinct, place = np.unique(numbers, return_inverse=True)
    return np.array([crc32(str(d).encode()) % batches for d in distinct.tolist()], np.int64)[place]


def _first_of_each_id(docs: DataFrame) -> DataFrame:
    """Rows with an id; of those that repeat one, the ones with the first text."""
    known = docs.filter("doc_id is not null and text is not null")
    often = known.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("doc_id")
    (often,) = size_checked(often)
    first = known.join(often, "doc_id", "left_semi").groupBy("doc_id").agg(F.min("text").alias("first"))
    (first,) = size_checked(first)
    return known.join(first, "doc_id", "left").filter("first is null or text = first").drop("first")


#: Clears the exchanges of a query once it has ended, instead of when the driver happens to collect its garbage.
_CLEAR = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a written table, whose making leaves no exchanged data behind."""
    conf = df.sparkSession.conf
    before = conf.get(_CLEAR, None)
    conf.set(_CLEAR, "true")
    try:
        return materialize(df, name)
    finally:
        conf.unset(_CLEAR) if before is None else conf.set(_CLEAR, before)


#: Packed links that are chained at once.
PART_BYTES = 4 << 20
#: Words of slices that are sent at once, and chains whose ends are compared at once.
SLICE_WORDS = 1 << 23
ENDS = 1 << 12

_SLICE = ["doc_id", "source", "low", "q0", "q1", "p0", "p1", "score", "reach", "held"]


def _ends_agree(text: tuple, source: tuple, step: int, far: int) -> np.ndarray:
    """Which chains may grow in a direction from places of two texts: see ``_last_seed``, up to ``far`` words, and ``grow``.

    Either text is given as its words, the places, and the ends it has in that direction.
    """
    out = np.zeros(len(text[1]), bool)
    ahead = step * np.arange(max(far, RESYNC + SURE - 1))
    for a in range(0, len(out), ENDS):
        sides = []
        for words_, at, end in (text, source):
            places = at[a : a + ENDS, None] + ahead
            inside = (places < end[a : a + ENDS, None]) if step > 0 else (places >= end[a : a + ENDS, None])
            # Beyond either text stand numbers that are no words and differ.
            sides.append(np.where(inside, words_[np.where(inside, places, 0)].astype(np.int64), -1 - len(sides)))
        x, y = sides
        alike = x == y
        near = x[:, : RESYNC + SURE - 1, None] == y[:, None, : RESYNC + SURE - 1]
        run = near[:, :RESYNC, :RESYNC].copy()
        for i in range(1, SURE):
            run &= near[:, i : RESYNC + i, i : RESYNC + i]
        good = alike[:, 0] | run.any(axis=(1, 2))
        if far >= SEED:
            run = alike[:, : far - SEED + 1].copy()
            for i in range(1, SEED):
                run &= alike[:, i : far - SEED + 1 + i]
            good |= run.any(axis=1)
        out[a : a + ENDS] = good
    return out


def _slices(table: pa.Table, texts: _Texts, own_words: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Chains that are long enough or may grow, the best of a text first, and the words of their sources.

    Row, source, its first word that is held, the ranges in source and text, the words by which an
    end may grow, and where the source's words begin and end.
    """
    held = [c for c in table.column("held").chunks if len(c)]
    flat, starts, done = [np.zeros(1, np.uint32)], [], 1
    for part in held:
        ends = np.frombuffer(part.buffers()[1], np.int32, len(part) + 1, 4 * part.offset).astype(np.int64) // 4
        flat.append(np.frombuffer(part.buffers()[2], np.uint32, ends[-1] - ends[0], 4 * ends[0]) if ends[-1] > ends[0] else flat[0][:0])
        starts.append(np.stack([ends[:-1], ends[1:]]) - ends[0] + done)
        done += ends[-1] - ends[0]
    words_ = np.concatenate(flat)
    at, end = np.concatenate([np.zeros((2, 0), np.int64), *starts], axis=1)
    number, source, low, q0, q1, p0, p1, score, reach = (table.column(c).to_numpy() for c in _SLICE[:9])
    distinct, whose = np.unique(number, return_inverse=True)
    line = np.array([texts.row.get(d, -1) for d in distinct.tolist()], np.int64)[whose]
    begin, finish = texts.starts[line], texts.starts[line + 1]
    good = (line >= 0) & (p1 - p0 >= min_words)
    for wide in (False, True):
        few = np.flatnonzero((line >= 0) & ~good & ((reach > MARGIN) == wide))
        far = int(reach[few].max(initial=0)) if wide else 0
        b, e, p, q, r, s = (c[few] for c in (begin, finish, p0, q0 - low, reach, at))
        grows = _ends_agree((own_words, b + p - 1, np.maximum(b + p - r, b)), (words_, s + q - 1, s), -1, far)
        p, q = p1[few], (q1 - low)[few]
        grows |= _ends_agree((own_words, b + p, e), (words_, s + q, end[few]), 1, far)
        good[few] = grows
    kept = np.flatnonzero(good)
    kept = kept[order_by(number[kept], -score[kept], source[kept], p0[kept])]
    return np.stack([c[kept] for c in (line, source, low, q0, q1, p0, p1, reach, at, end)]), words_


_PASSAGES = "passages array<struct<start:long,end:long,words:long,source:long,source_start:long,matched:long>>"
_OUT = f"doc_id long, n_words long, {_PASSAGES}"
_STRUCT = pa.list_(
    pa.struct([(c, pa.int64()) for c in ("start", "end", "words", "source", "source_start", "matched")])
)


def find_passages(
    df: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    min_words: int = 50,
    num: int = 80,
    den: int = 100,
    batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """``doc_id``, ``n_words`` and ``passages`` per row: what of a text an earlier document has in like words.

    Words are parted by ASCII blanks and A-Z lower-cased. A passage has ``start`` and ``end``
    (bytes of the text), its number of ``words``, the ``source`` (a document of smaller id), the word
    there at which it starts, and the words ``matched`` by the alignment; twice those are at least
    ``num / den`` of the words of both sides. Passages of one row may overlap if their sources
    differ. Null, empty and short texts have none. Rows without an id take no part, nor do rows
    that repeat an id (the first by text does); they come back without passages. Other columns
    are ignored and an empty table gives no rows. Texts are read whole, and a very long one meets
    others in its batch. What the first and the nearest earlier holder of its seeds do not cover is
    looked for in all earlier holders, so that ``min_words`` words with single ones changed are found
    whoever else holds their pieces; holders are linked where the words around the seed agree as well.
    """
    docs = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    total = docs.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    batches = max(1, -(-total // batch_bytes))
    own = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    spread = F.pmod(F.xxhash64("text"), F.lit(batches))
    batch = F.when(F.col("doc_id").isNull(), spread).otherwise(own % batches).cast("int")
    docs = docs.withColumn("batch", batch)
    buckets = max(2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // BUCKET_BYTES)
    shift = max(4, buckets.bit_length())
    size = around.size_for(min_words, SEED)

    def send_seeds(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(found):
            seeds = _seeds(_Texts(pa.Table.from_batches([part])))
            value = seeds[0].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            bucket = value >> np.uint64(64 - shift)
            seeds[0] = ((value << np.uint64(shift)) >> np.uint64(64 - KEY_BITS)).view(np.int64)
            yield from _sent("bucket", _packed(bucket.astype(np.int64), seeds)).to_batches()

    def link_seeds(table: pa.Table) -> pa.Table:
        seeds = _unpacked(table.column("packed"), 3)
        seeds = seeds[:, order_by(*seeds)]
        links = _links(seeds)
        rest, held = _often(seeds)
        bucket = table.column("bucket")[0].as_py()
        rest = np.concatenate([rest, np.full((1, rest.shape[1]), bucket)])
        kinds = [
            _kind(0, _packed(_batch_of(links[0], batches), links)),
            _kind(1, _packed(_batch_of(rest[0], batches), rest)),
            _kind(2, _packed(np.full(held.shape[1], bucket), held)),
        ]
        return pa.concat_tables(kinds)

    def chain_links(table: pa.Table) -> pa.Table:
        """Chains (``kind`` 0); of documents that ask for more holders the matches near what they ask (1) and others (5).

        Besides, what they ask (2), and what is covered (4).
        """
        is_link = np.array(table.column("kind").to_numpy() == 0)
        matches = _matches(_unpacked(table.column("packed").filter(pa.array(is_link)), 4))
        rest = _unpacked(table.column("packed").filter(pa.array(~is_link)), 5)
        rest = rest[:, order_by(rest[0], rest[1])]
        sure = _surely(matches, min_words, num, den)
        rest = rest[:, _asking(rest, matches, sure, min_words, num, den)]
        rest = rest[:, _apart(rest, size.apart)]
        later = np.isin(matches[0], rest[0])
        sure = sure[:, np.isin(sure[0], rest[0])]
        chains = _chains(matches[:, ~later], min_words)
        matches = matches[:, later]
        near = _near(matches, rest, min_words)
        batch = table.column("at")[0].as_py()
        here = lambda columns: _packed(np.full(columns.shape[1], batch), columns)
        kinds = [
            _kind(0, _packed(_batch_of(chains[0], batches), chains)),
            _kind(1, here(matches[:, near])),
            _kind(5, here(matches[:, ~near])),
            _kind(2, _packed(rest[4], rest[[3, 0, 1]]), rest.shape[1]),
            _kind(4, here(sure)),
        ]
        return pa.concat_tables(kinds)

    def ask_holders(table: pa.Table) -> pa.Table:
        kind = table.column("kind").to_numpy()
        asked = _unpacked(table.column("packed").filter(pa.array(kind == 3)), 3)
        held = _unpacked(table.column("packed").filter(pa.array(kind == 2)), 3)
        rows = _met(asked, held)
        rows = np.concatenate([np.full((1, rows.shape[1]), table.column("at")[0].as_py()), rows])
        return _kind(3, _packed(_batch_of(rows[2], batches), rows))

    def cut_surroundings(table: pa.Table, asked: pa.Table) -> pa.Table:
        kind = asked.column("kind").to_numpy()
        rows = _unpacked(asked.column("packed").filter(pa.array(kind == 3)), 5)
        sure = _unpacked(asked.column("packed").filter(pa.array(kind == 4)), 3)
        rows, seen = _surroundings(_Texts(table), rows, sure, size)
        order = np.argsort(rows[0], kind="stable")
        sent = _packed(rows[0, order], rows[1:, order])
        ends = np.flatnonzero(np.diff(rows[0, order], append=-1)) + 1
        around_ = [seen[some].tobytes() for some in np.split(order, ends[:-1])] if len(order) else []
        return _sent("at", sent).append_column("words", pa.array(around_, pa.binary()))

    def link_alike(table: pa.Table) -> pa.Table:
        parts = zip(table.column("packed").to_pylist(), table.column("words").to_pylist(), strict=True)
        rows, seen = zip(*((_wide(p, 5), np.frombuffer(w, np.uint8).reshape(-1, size.width)) for p, w in parts), strict=True)
        found = around.alike(np.concatenate(rows, axis=1), np.concatenate(seen), size, SEED)
        return _kind(1, [row for links in found for row in _packed(_batch_of(links[0], batches), links)])

    def chain_all(table: pa.Table) -> pa.Table:
        is_near = table.column("kind").to_numpy() == 1
        packed = table.column("packed")
        parts, out = 1 + packed.nbytes // PART_BYTES, []
        for part in range(parts):  # documents by turns: their links take many times the packed bytes
            near, far = (_unpacked(packed.filter(pa.array(some)), 4, part, parts) for some in (is_near, ~is_near))
            chains = _chains(_distinct(np.concatenate([far, near], axis=1)), min_words, _pairs(near))
            out += _packed(_batch_of(chains[0], batches), chains)
        return _kind(0, out)

    def cut_sources(table: pa.Table, asked: pa.Table) -> pa.Table:
        texts = _Texts(table)
        chains = _unpacked(asked.column("packed"), 8)
        chains = chains[:, np.isin(chains[0], np.array(list(texts.row), np.int64))]
        distinct, whose = np.unique(chains[0], return_inverse=True)
        lines = np.array([texts.row[d] for d in distinct.tolist()], np.int64)[whose]
        source, q0, q1, number, p0, p1, score, reach = chains
        low = np.maximum(q0 - reach, 0)
        start = texts.starts[lines] + low
        size_ = np.minimum(texts.starts[lines] + q1 + reach, texts.starts[lines + 1]) - start
        ends = np.cumsum(size_)
        at = _batch_of(number, batches).astype(np.int32)
        parts = [none([*_SLICE, "batch"], [pa.int64()] * 9 + [pa.binary(), pa.int32()])]
        a = 0
        while a < len(size_):
            b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + SLICE_WORDS, side="right")))
            borders = np.concatenate(([0], np.cumsum(size_[a:b])))
            flat = np.arange(borders[-1]) + np.repeat(start[a:b] - borders[:-1], size_[a:b])
            held = pa.py_buffer(texts.hashes[flat].astype(np.uint32).tobytes())
            held = pa.Array.from_buffers(pa.binary(), b - a, [None, pa.py_buffer((4 * borders).astype(np.int32).tobytes()), held])
            columns = [pa.array(c[a:b]) for c in (number, source, low, q0, q1, p0, p1, score, reach)]
            parts.append(pa.table([*columns, held, pa.array(at[a:b])], [*_SLICE, "batch"]))
            a = b
        return pa.concat_tables(parts)

    def align_chains(table: pa.Table, slices: pa.Table) -> pa.Table:
        texts = _Texts(table)
        found: dict[int, list] = {}
        covered: dict[int, np.ndarray] = {}
        own_words = texts.hashes.astype(np.uint32)
        asked, held = _slices(slices, texts, own_words, min_words)
        for i, source, low, q0, q1, p0, p1, margin, at, end in asked.T.tolist():
            known = covered.get(i)
            if known is None:
                known = covered[i] = np.zeros(texts.starts[i + 1] - texts.starts[i], bool)
            reach = known[max(p0 - margin, 0) : p1 + margin]
            if len(reach) - np.count_nonzero(reach) < NEW_WORDS * min_words:
                continue  # nothing that is left here can be a passage of enough new words
            x, y = own_words[texts.starts[i] : texts.starts[i + 1]], held[at:end]
            q0, q1 = q0 - low, q1 - low
            if margin > MARGIN:  # up to the outermost seeds, which may not have been linked
                a = _last_seed(x[max(p0 - margin, 0) : p0][::-1], y[:q0][::-1])
                p0, q0, margin = p0 - a, q0 - a, margin - a
                a = _last_seed(x[p1 : p1 + margin], y[q1:])
                p1, q1, margin = p1 + a, q1 + a, max(margin - a, MARGIN)
            a, b = grow(x[max(p0 - margin, 0) : p0][::-1], y[:q0][::-1])
            p0, q0 = p0 - a, q0 - b
            a, b = grow(x[p1 : p1 + margin], y[q1:])
            p1, q1 = p1 + a, q1 + b
            if p1 - p0 < min_words:
                continue
            agree = runs(x[p0:p1], y[q0:q1])
            a = texts.starts[i]
            for first, last in parts(agree, min_words, num, den):
                start, end = p0 + int(agree[0, first]), p0 + int(agree[0, last] + agree[2, last])
                if (~known[start:end]).sum() < NEW_WORDS * (end - start):
                    continue
                known[start:end] = True
                span = int(texts.first[a + start] - texts.at[i]), int(texts.end[a + end - 1] - texts.at[i])
                at = low + q0 + int(agree[1, first])
                found.setdefault(i, []).append((*span, end - start, source, at, int(agree[2, first : last + 1].sum())))
        fields = ["start", "end", "words", "source", "source_start", "matched"]
        rows = [[dict(zip(fields, f, strict=True)) for f in sorted(found.get(i, []))] for i in range(table.num_rows)]
        return pa.table(
            {
                "doc_id": table.column("doc_id").cast(pa.int64()),
                "n_words": pa.array(np.diff(texts.starts).astype(np.int64)),
                "passages": pa.array(rows, _STRUCT),
            }
        )

    def none(names: list[str], kinds: list) -> pa.Table:
        return pa.table({n: pa.array([], k) for n, k in zip(names, kinds, strict=True)})

    def one(step, empty: pa.Table):
        return lambda table: step(table) if table.num_rows else empty

    def two(step, names: list[str], kinds: list):
        return lambda table, other: step(table, other) if table.num_rows else none(names, kinds)

    def groups(frame: DataFrame):
        return frame.groupBy("batch")

    linked, chained = (one(step, _kind(0, [])) for step in (link_seeds, chain_links))
    seeds = _first_of_each_id(docs).select("doc_id", "text").mapInArrow(send_seeds, "bucket int, packed binary")
    links = _written(seeds.groupBy("bucket").applyInArrow(linked, _KINDS), "links")
    chains = _written(links.filter("kind < 2").groupBy("at").applyInArrow(chained, _KINDS), "chains")
    chains_of_all = chains.filter("kind = 0")
    if chains.agg(F.sum("n").alias("n")).first()["n"]:
        asked = chains.filter("kind = 2").withColumn("kind", F.lit(3)).unionByName(links.filter("kind = 2"))
        asked = asked.groupBy("at").applyInArrow(one(ask_holders, _kind(0, [])), _KINDS)
        asked = asked.unionByName(chains.filter("kind = 4")).withColumnRenamed("at", "batch")
        cut = two(cut_surroundings, ["at", "packed", "words"], [pa.int32(), pa.binary(), pa.binary()])
        seen = groups(docs).cogroup(groups(asked)).applyInArrow(cut, _AROUND)
        found = seen.groupBy("at").applyInArrow(one(link_alike, _kind(0, [])), _KINDS)
        found = found.unionByName(chains.filter("kind in (1, 5)"))
        more = _written(found.groupBy("at").applyInArrow(one(chain_all, _kind(0, [])), _KINDS), "more-chains")
        chains_of_all = chains_of_all.unionByName(more)
    chains = chains_of_all.select(F.col("at").alias("batch"), "packed")
    cut = two(cut_sources, [*_SLICE, "batch"], [pa.int64()] * 9 + [pa.binary(), pa.int32()])
    schema = ", ".join(f"{c} long" for c in _SLICE[:9]) + ", held binary, batch int"
    slices = groups(docs).cogroup(groups(chains)).applyInArrow(cut, schema)
    end = two(align_chains, ["doc_id", "n_words", "passages"], [pa.int64(), pa.int64(), _STRUCT])
    return groups(docs).cogroup(groups(slices)).applyInArrow(end, _OUT)
