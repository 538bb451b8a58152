"""Codes of vectors from one small codebook per part, entries found by Orchard's search.

Every entry of a codebook has the others listed by distance. A search holds the best entry
so far and walks its list: an entry not yet visited is measured, a nearer one becomes the
best and its list is walked from the start. It ends where the list goes beyond twice the
distance of the best, since by the triangle inequality nothing there can be nearer. All
rows of a batch take their steps together, each at its own place in its own list.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adloom.llm.vectors import floor_means, integer_vectors, unpacked
from adloom.operators.joins import join_null_safe, size_checked
from adloom.session import materialize


class Book:
    """One part's entries, each with the others in order of their squared distance, and where a search starts."""

    def __init__(self, entries: np.ndarray) -> None:
        n = len(entries)
        gaps = ((entries[:, None] - entries[None]) ** 2).sum(2)
        order = np.argsort(gaps, axis=1, kind="stable")
        others = order != np.arange(n)[:, None]
        self.entries = entries
        self.order = order[others].reshape(n, n - 1)
        self.gaps = np.take_along_axis(gaps, self.order, axis=1)
        sums = entries.sum(1)
        self.by_sum = np.argsort(sums, kind="stable")
        self.sums = sums[self.by_sum]

    def search(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest entry of every row, the lower index if tied, and its squared distance."""
        entries, order, gaps = self.entries, self.order, self.gaps
        # A fair first guess: the entry next in the sum of its components.
        best = self.by_sum[np.minimum(np.searchsorted(self.sums, x.sum(1)), len(entries) - 1)]
        near = ((x - entries[best]) ** 2).sum(1)
        visited = np.zeros((len(x), len(entries)), bool)
        visited[np.arange(len(x)), best] = True
        place = np.zeros(len(x), np.int64)
        open_ = np.arange(len(x)) if order.shape[1] else np.zeros(0, np.int64)
        while len(open_):
            held, at = best[open_], place[open_]
            inside = gaps[held, at] <= 4 * near[open_]
            open_, entry = open_[inside], order[held[inside], at[inside]]
            place[open_] += 1
            fresh = ~visited[open_, entry]
            rows, entry = open_[fresh], entry[fresh]
            visited[rows, entry] = True
            found = ((x[rows] - entries[entry]) ** 2).sum(1)
            better = (found < near[rows]) | ((found == near[rows]) & (entry < best[rows]))
            rows, entry = rows[better], entry[better]
            best[rows], near[rows], place[rows] = entry, found[better], 0
            open_ = open_[place[open_] < order.shape[1]]
        return best, near


def _tally(books: list[Book], dims: int):
    """Per task, count and sums of the parts that each entry is nearest to."""
    parts, entries, width = len(books), len(books[0].entries), dims // len(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(parts * entries, np.int64)
        sums = np.zeros((parts * entries, width), np.int64)
        for batch in batches:
            x = unpacked(batch.column("x"), dims)
            for p, book in enumerate(books):
                part = x[:, p * width : (p + 1) * width]
                slot = p * entries + book.search(part)[0]
                np.add.at(n, slot, 1)
                np.add.at(sums, slot, part)
        slots = pa.array(np.arange(parts * entries), pa.int32())
        yield pa.RecordBatch.from_arrays([slots, pa.array(n), pa.array(list(sums), pa.list_(pa.int64()))], ["slot", "n", "sums"])

    return run


def _means(vectors: DataFrame, books: list[Book], dims: int) -> list[Book]:
    """The next codebooks; ``parts * entries`` rows reach the driver whatever the data."""
    width = dims // len(books)
    found = vectors.select("x").mapInArrow(_tally(books, dims), "slot int, n bigint, sums array<bigint>")
    sums = [F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(width)]
    before = np.concatenate([b.entries for b in books])
    n, total = np.zeros(len(before), np.int64), np.zeros_like(before)
    for r in found.groupBy("slot").agg(F.sum("n").alias("n"), *sums).collect():
        n[r["slot"]], total[r["slot"]] = r["n"], [r[f"s{i}"] for i in range(width)]
    return [Book(b) for b in np.split(floor_means(total, n, before), len(books))]


def _encode(books: list[Book], dims: int):
    width = dims // len(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = unpacked(batch.column("x"), dims)
            found = [b.search(x[:, p * width : (p + 1) * width]) for p, b in enumerate(books)]
            text = np.stack([f[0] for f in found], axis=1).astype(np.uint8).tobytes().hex()
            step = 2 * len(books)
            code = [text[i : i + step] for i in range(0, len(text), step)]
            columns = [batch.column("vec_id"), pa.array(code, pa.string()), pa.array(sum(f[1] for f in found)), batch.column("label")]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "code", "error", "label"])

    return run


def compress_vectors(
    df: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
    dims: int = 64,
    parts: int = 8,
    entries: int = 16,
    rounds: int = 6,
    scale: int = 4096,
) -> DataFrame:
    """``vec_id``, ``code``, ``error``, ``label_error`` and ``codebooks_sha256`` per vector kept.

    Components become ``floor(scale * x)`` and vectors are cut into ``parts`` equal parts.
    A part's codebook starts as that part of the ``entries`` (256 at most) smallest ids,
    those that are null last; each of ``rounds`` rounds replaces an entry that is nearest to
    any part by the floor of their mean; ties go to the lower index. The code has the
    entry's index in two hex digits for each part, ``error`` sums squared distances,
    ``label_error`` sums errors of rows with an equal label, null ones together. Kept are
    rows of :func:`integer_vectors`, so rows with a null vector, a null or non-finite
    component or another number of components are left out. Rows that repeat an id count
    each and, with different vectors, enter a codebook by stored bytes; fewer vectors
    than ``entries`` make smaller codebooks; without any there are no rows. Other columns
    are ignored. A label's sum beyond 64 bits is null.
    """
    if dims % parts or not 0 < entries <= 256:
        raise ValueError("dims must be a multiple of parts, and a code has two hex digits")
    spark = df.sparkSession
    vectors = integer_vectors(df, vec_col, scale, dims, vec_id=id_col, label=label_col)
    vectors = materialize(vectors.withColumn("vec_id", F.col("vec_id").cast("long")), "code-vectors")
    first = vectors.select("vec_id", "x").orderBy(F.asc_nulls_last("vec_id"), "x").limit(entries).collect()
    if not first:
        kind = "vec_id bigint, code string, error bigint, label_error bigint, codebooks_sha256 string"
        return spark.createDataFrame([], kind)
    start = np.frombuffer(b"".join(bytes(r["x"]) for r in first), "<i4").astype(np.int64).reshape(-1, dims)
    books = [Book(part) for part in np.split(start, parts, axis=1)]
    for _ in range(rounds):
        books = _means(vectors, books, dims)
    numbers = np.concatenate([b.entries.ravel() for b in books]).tolist()
    digest = hashlib.sha256(",".join(map(str, numbers)).encode()).hexdigest()

    kind = vectors.select("vec_id", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), "label").schema
    coded = materialize(vectors.mapInArrow(_encode(books, dims), kind), "codes")
    (sums,) = size_checked(coded.groupBy("label").agg(F.try_sum("error").alias("label_error")))
    return join_null_safe(coded, sums, ["label"]).select(
        "vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    )
