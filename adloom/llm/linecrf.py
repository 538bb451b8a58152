"""Quality rules: base statistics of a text, and a linear-chain CRF over its lines.

The CRF labels each line as content or boilerplate from features of the line and
from its neighbour's label. It is fitted to a bounded sample of labelled documents
(the lines of a good one count as content, those of a bad one as boilerplate) and
decoded with the Viterbi recursion over all lines of every document at once per
batch. A document is kept if it passes the base rules and enough of its words are
in content lines.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adloom.llm.words import BLANKS, EXACT, batches, mix, shingles, text_buffer, words

#: Labelled documents and lines of each that the model is fitted to, and neighbouring lines drawn together.
SAMPLE_DOCS = 2000
SAMPLE_LINES = 100
DRAWN = 20

_NEWLINE = np.zeros(256, bool)
_NEWLINE[10] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[0xC0:] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_MARK = np.zeros(256, bool)
_MARK[33] = True
_FIRST_BYTE = np.ones(256, bool)
_FIRST_BYTE[0x80:0xC0] = False
_CHAR = ~BLANKS & _FIRST_BYTE

# Upper bounds of the buckets of each line feature, in the order of ``_line_features``.
_BOUNDS = (
    (0, 0.1, 0.3, 0.6),  # symbols a word
    (0.3, 0.6),  # upper-case letters a letter
    (2, 5, 20),  # words
    (0, 0.3, 0.6),  # repeated words a word
    (0,),  # equal to an earlier line
    (0, 0.3),  # exclamation marks a word
    (0, 0.3),  # digits a word
    (3, 6, 9),  # characters a word
)
N_FEATURES = sum(len(b) + 1 for b in _BOUNDS)


@dataclass
class LineModel:
    """Scores for boilerplate against content; transitions and start are ``[from, to]`` and ``[label]``."""

    weights: np.ndarray = field(default_factory=lambda: np.zeros(N_FEATURES))
    moves: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    start: np.ndarray = field(default_factory=lambda: np.zeros(2))
    bias: float = -1.0


class _Sums:
    """Counts of marked bytes between two places."""

    def __init__(self, data: np.ndarray, marked: np.ndarray) -> None:
        self.sums = np.zeros(len(data) + 1, np.int32)
        np.cumsum(marked[data], out=self.sums[1:])

    def between(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (self.sums[b] - self.sums[a]).astype(np.int64)


def _same_before(values: np.ndarray) -> np.ndarray:
    """Whether each value occurs at an earlier place."""
    order = np.argsort(values, kind="stable")
    out = np.zeros(len(values), bool)
    out[order[1:]] = values[order[1:]] == values[order[:-1]]
    return out


def _twice(values: np.ndarray) -> np.ndarray:
    """Whether each value occurs more than once."""
    ordered = np.sort(values)
    often = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(often):
        return np.zeros(len(values), bool)
    at = np.searchsorted(often, values)
    at[at == len(often)] = 0
    return often[at] == values


def _measure(column: pa.Array) -> dict[str, np.ndarray]:
    """Base statistics of each text, and features of each of its lines that hold a word."""
    data, at = text_buffer(column)
    docs = len(at) - 1
    hashes, first, _, starts = words(data, at, BLANKS, EXACT)
    n_words = np.diff(starts)
    out = {"n_words": n_words}
    out["word_chars"] = _Sums(data, _CHAR).between(at[:-1], at[1:])
    symbols = _Sums(data, _SYMBOL)
    out["n_symbols"] = symbols.between(at[:-1], at[1:])

    windows, whole = shingles(hashes, starts, 3)
    doc_of = np.repeat(np.arange(docs, dtype=np.uint64), n_words)
    place = np.flatnonzero(whole)
    place = place[_twice(mix(windows[place] ^ mix(doc_of[place])))]
    repeated = np.zeros(len(hashes) + 2, bool)
    for step in range(3):
        repeated[place + step] = True
    repeated = np.concatenate(([0], np.cumsum(repeated[: len(hashes)])))
    out["n_repeat_words"] = repeated[starts[1:]] - repeated[starts[:-1]]

    lines, a, b, line_at = words(data, at, _NEWLINE, EXACT)
    w0, w1 = np.searchsorted(first, a), np.searchsorted(first, b)
    line_doc = np.repeat(np.arange(docs), np.diff(line_at))
    full = w1 > w0
    lines, a, b, w0, w1, line_doc = (x[full] for x in (lines, a, b, w0, w1, line_doc))
    again = _same_before(mix(lines ^ mix(line_doc.astype(np.uint64))))
    out["n_dup_lines"] = np.bincount(line_doc[again], minlength=docs)
    out["line_doc"], out["line_words"] = line_doc, w1 - w0
    newlines = _Sums(data, _NEWLINE)
    out["line_number"] = newlines.between(at[line_doc], a)
    count = np.maximum(w1 - w0, 1)
    letters = np.maximum(_Sums(data, _LETTER).between(a, b), 1)
    values = (
        symbols.between(a, b) / count,
        _Sums(data, _UPPER).between(a, b) / letters,
        w1 - w0,
        (repeated[w1] - repeated[w0]) / count,
        again.astype(np.int64),
        _Sums(data, _MARK).between(a, b) / count,
        _Sums(data, _DIGIT).between(a, b) / count,
        _Sums(data, _CHAR).between(a, b) / count,
    )
    base, found = 0, []
    for value, bounds in zip(values, _BOUNDS, strict=True):
        found.append(base + np.searchsorted(np.array(bounds, float), value.astype(float)))
        base += len(bounds) + 1
    out["features"] = np.stack(found, axis=1) if len(a) else np.zeros((0, len(_BOUNDS)), np.int64)
    return out


def _grid(sizes: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values of consecutive sequences as a sequence-by-place grid, and which cells are used."""
    grid = np.zeros((len(sizes), int(sizes.max()) if len(sizes) else 0))
    used = np.arange(grid.shape[1]) < sizes[:, None]
    grid[used] = values
    return grid, used


def viterbi(scores: np.ndarray, sizes: np.ndarray, model: LineModel) -> np.ndarray:
    """Most likely labels (True: boilerplate) of consecutive sequences of the given sizes."""
    labels = np.zeros(len(scores), bool)
    at = np.concatenate(([0], np.cumsum(sizes)))
    order = np.argsort(sizes, kind="stable")
    # Sequences of like length side by side, so that the grid stays about as large as the input.
    for group in np.split(order, np.flatnonzero(np.diff(np.frexp(sizes[order])[1])) + 1):
        own = sizes[group]
        if not len(own) or own[-1] == 0:
            continue
        lines = np.concatenate([np.arange(at[g], at[g + 1]) for g in group])
        grid, used = _grid(own, scores[lines])
        best = np.stack([np.full(len(own), model.start[0]), model.start[1] + grid[:, 0]], axis=1)
        back = np.zeros((grid.shape[1], len(own), 2), np.int8)
        for t in range(1, grid.shape[1]):
            reach = best[:, :, None] + model.moves
            back[t] = reach[:, 1] > reach[:, 0]
            step = reach.max(axis=1)
            step[:, 1] += grid[:, t]
            best = np.where(used[:, t, None], step, best)
            back[t][~used[:, t]] = (0, 1)
        label = (best[:, 1] > best[:, 0]).astype(np.int8)
        path = np.zeros(grid.shape, bool)
        for t in range(grid.shape[1] - 1, -1, -1):
            path[:, t] = label
            label = back[t][np.arange(len(own)), label]
        labels[lines] = path[used]
    return labels


def fit(features: list[np.ndarray], bad: np.ndarray, rounds: int = 300, decay: float = 1e-5) -> LineModel:
    """Most likely model for sequences of line features whose lines share their document's label.

    Without examples of both labels nothing can be told apart and every line is content.
    """
    model = LineModel()
    kept = [i for i, f in enumerate(features) if len(f)]
    if not kept or bad[kept].all() or not bad[kept].any():
        return model
    kept.sort(key=lambda i: -len(features[i]))  # stable; the sequences still open at a place come first
    features, bad = [features[i] for i in kept], bad[kept].astype(float)
    sizes = np.array([len(f) for f in features])
    flat = np.concatenate(features)
    truth = np.repeat(bad, sizes)
    theta = np.zeros(N_FEATURES + 1 + 4 + 2)
    momentum, scale = np.zeros_like(theta), np.zeros_like(theta)
    _, used = _grid(sizes, truth)
    last = sizes - 1
    n, width = used.shape
    still = used.sum(axis=0)
    for turn in range(1, rounds + 1):
        weights, bias, moves, start = theta[:N_FEATURES], theta[N_FEATURES], theta[-6:-2].reshape(2, 2), theta[-2:]
        grid, _ = _grid(sizes, weights[flat].sum(axis=1) + bias)
        unary = np.stack([np.zeros_like(grid), grid], axis=2)
        alpha, beta = np.zeros((width, n, 2)), np.zeros((width, n, 2))
        alpha[0] = start + unary[:, 0]
        for t in range(1, width):
            a = still[t]
            reach = alpha[t - 1, :a, :, None] + moves
            alpha[t, :a] = np.logaddexp(reach[:, 0], reach[:, 1]) + unary[:a, t]
        for t in range(width - 2, -1, -1):
            a = still[t + 1]
            reach = moves + (unary[:a, t + 1] + beta[t + 1, :a])[:, None, :]
            beta[t, :a] = np.logaddexp(reach[:, :, 0], reach[:, :, 1])
        total = np.logaddexp.reduce(alpha[last, np.arange(n)], axis=1)
        share = np.exp(alpha + beta - total[None, :, None])
        share = np.where(used.T[:, :, None], share, 0)
        pairs = alpha[:-1, :, :, None] + moves + (unary.transpose(1, 0, 2)[1:] + beta[1:])[:, :, None, :]
        pairs = np.where(used.T[1:, :, None, None], np.exp(pairs - total[None, :, None, None]), 0).sum(axis=(0, 1))
        off = truth - share[:, :, 1].T[used]
        slope = np.zeros_like(theta)
        slope[:N_FEATURES] = np.bincount(flat.ravel(), np.repeat(off, flat.shape[1]), N_FEATURES)
        slope[N_FEATURES] = off.sum()
        real = np.diag([((sizes - 1) * (1 - bad)).sum(), ((sizes - 1) * bad).sum()])
        slope[-6:-2] = (real - pairs).ravel()
        slope[-2:] = np.array([(1 - bad).sum(), bad.sum()]) - share[0].sum(axis=0)
        slope = slope / len(truth) - decay * theta
        momentum = 0.9 * momentum + 0.1 * slope
        scale = 0.99 * scale + 0.01 * slope**2
        theta = theta + 0.2 * (momentum / (1 - 0.9**turn)) / (np.sqrt(scale / (1 - 0.99**turn)) + 1e-8)
    return LineModel(theta[:N_FEATURES].copy(), theta[-6:-2].reshape(2, 2).copy(), theta[-2:].copy(), float(theta[N_FEATURES]))


def _base_failed(seen: dict[str, np.ndarray], min_words: int) -> np.ndarray:
    return (seen["n_words"] < min_words) | (100 * seen["n_repeat_words"] > 50 * seen["n_words"])


def _drawn(number: int, n: int) -> list[tuple[int, int]]:
    """Ranges of a document's ``n`` lines that enter the fit: all, or as many by a hash of their place in the whole text."""
    if n <= SAMPLE_LINES:
        return [(0, n)]
    blocks = np.arange(-(-n // DRAWN), dtype=np.uint64)
    rank = mix(blocks + mix(np.array([number], np.int64).view(np.uint64)))
    drawn = np.sort(np.argsort(rank, kind="stable")[: SAMPLE_LINES // DRAWN])
    return [(a, min(a + DRAWN, n)) for a in (drawn * DRAWN).tolist()]


def fit_lines(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", min_words: int = 50
) -> LineModel:
    """Fit the model to at most ``SAMPLE_DOCS`` rows of ``labels(doc_id, quality)`` and their documents.

    Documents that fail the base rules are left out, since the model never decides on
    them. The sample is drawn by a hash of the id; of a document with more than
    ``SAMPLE_LINES`` lines so many are drawn from its whole text, ``DRAWN`` neighbours at a
    time, each a sequence of its own. Labels without a document, a quality or an id are
    passed over. Only line features reach the driver.
    """
    chosen = labels.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col("quality").cast("int").alias("quality"))
    chosen = chosen.na.drop().groupBy("id").agg(F.min("quality").alias("quality"))
    chosen = chosen.orderBy(F.xxhash64("id"), "id").limit(SAMPLE_DOCS)
    picked = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    picked = picked.join(F.broadcast(chosen), "id").select("id", "quality", "text")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(parts):
            seen = _measure(batch.column(2))
            failed = _base_failed(seen, min_words)
            at = np.searchsorted(seen["line_doc"], np.arange(batch.num_rows + 1))
            rows = [
                (number, quality, seen["features"][a + x : a + y].astype(np.int8).tobytes())
                for number, quality, a, b, bad in zip(
                    batch.column(0).to_pylist(), batch.column(1).to_pylist(), at[:-1].tolist(), at[1:].tolist(), failed, strict=True
                )
                if not bad
                for x, y in _drawn(number, b - a)
            ]
            columns = list(zip(*rows, strict=True)) or [()] * 3
            kinds = [pa.int64(), pa.int32(), pa.binary()]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=["id", "quality", "features"])

    rows = picked.mapInArrow(run, "id long, quality int, features binary").collect()
    rows.sort(key=lambda r: (r["id"], bytes(r["features"])))
    features = [np.frombuffer(r["features"], np.int8).reshape(-1, len(_BOUNDS)).astype(np.int64) for r in rows]
    return fit(features, np.array([r["quality"] == 0 for r in rows], bool))


def judge_lines(
    df: DataFrame, model: LineModel, text: str = "text", min_content: float = 0.5, min_words: int = 50
) -> DataFrame:
    """Add base statistics, ``content_words``, ``boilerplate_lines`` and the verdicts to every row.

    ``boilerplate_lines`` holds the numbers (from 0, parted by line feeds) of the lines
    with a word that the model marks. ``base_failed`` is true below ``min_words`` words
    or if more than half of them are in three-word windows found twice or more in the
    text; ``kept`` is true if the base rules pass and at least ``min_content`` of the words
    are in content lines. Null and empty texts have no words and fail. Repeated rows
    get equal results; other columns are kept, those of the added names replaced.
    No shuffle: whole texts, one pass.
    """
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "content_words"]
    added = [*counts, "boilerplate_lines", "base_failed", "kept"]
    passed = [c for c in df.columns if c not in added]
    where = passed.index(text)
    base = df.select(*[f"`{c}`" for c in passed])
    fields = [T.StructField(c, T.LongType()) for c in counts]
    fields.append(T.StructField("boilerplate_lines", T.ArrayType(T.LongType())))
    fields += [T.StructField(c, T.BooleanType()) for c in ("base_failed", "kept")]

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(found):
            seen = _measure(batch.column(where))
            rows = batch.num_rows
            sizes = np.bincount(seen["line_doc"], minlength=rows)
            marked = viterbi(model.weights[seen["features"]].sum(axis=1) + model.bias, sizes, model)
            good = np.bincount(seen["line_doc"][~marked], seen["line_words"][~marked], rows).astype(np.int64)
            at = np.concatenate(([0], np.cumsum(np.bincount(seen["line_doc"][marked], minlength=rows))))
            lines = pa.ListArray.from_arrays(at.astype(np.int32), pa.array(seen["line_number"][marked], pa.int64()))
            failed = _base_failed(seen, min_words)
            kept = ~failed & (good >= min_content * seen["n_words"])
            values = [seen[c] if c in seen else good for c in counts]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(v, pa.int64()) for v in values), lines, pa.array(failed), pa.array(kept)],
                names=passed + added,
            )

    return base.mapInArrow(run, T.StructType(list(base.schema.fields) + fields))
