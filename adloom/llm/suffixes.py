"""Removal of long byte strings that an earlier document holds, by a logarithmic index family.

Documents come in batches of ascending ids. A batch's suffixes are ordered by the
64-bit key of their first ``length`` bytes (which is all that decides a match), and
the array is scanned against the levels of the family, each of them the merged
array of earlier batches; then it becomes the newest level, and levels of equal
size merge, so a suffix is merged a logarithmic number of times.

The family is split by suffix: every window of ``length`` bytes has an anchor, the
smallest of its hashed ``GRAM``-byte strings, and equal windows have equal anchors.
All windows of an anchor go to the bucket of its hash. A first exchange finds, from
four bytes per distinct anchor and batch, which anchors occur in several documents;
only the windows around those are sent, as the strings that hold them, once per
batch. A string that a third of all documents share is therefore one entry per
batch, and a bucket's memory is its share of the repeated windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adloom.llm.words import EXACT, mix, prefix_hash, text_buffer

GRAM = 16
#: Bytes of text in a batch, on average, and in one step of a task.
BATCH_BYTES = 8 << 20
PIECE = 1 << 19
#: Rows without an id come after all others and are no source for each other; their batches.
LATE_BATCHES = 64
_SALT = np.uint64(0x452821E638D01377)


class Levels:
    """Sorted arrays of distinct suffix keys, the newest last."""

    def __init__(self) -> None:
        self.levels: list[np.ndarray] = []

    def holds(self, keys: np.ndarray) -> np.ndarray:
        """Whether each key, given in order, is in any level."""
        found = np.zeros(len(keys), bool)
        for level in self.levels:
            at = np.searchsorted(level, keys)
            at[at == len(level)] = 0
            found |= level[at] == keys
        return found

    def add(self, keys: np.ndarray) -> None:
        """Append the sorted distinct keys of a batch and merge levels until each is twice the next."""
        if not len(keys):
            return
        self.levels.append(keys)
        while len(self.levels) > 1 and len(self.levels[-2]) < 2 * len(self.levels[-1]):
            both = np.sort(np.concatenate([self.levels.pop(), self.levels.pop()]), kind="stable")
            self.levels.append(both[np.concatenate(([True], both[1:] != both[:-1]))])


def _ragged(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``first[0], first[0] + 1 .. `` for each range, one after the other."""
    ends = np.cumsum(sizes)
    out = np.ones(int(ends[-1]) if len(ends) else 0, np.int64)
    if len(out):
        full = np.flatnonzero(sizes)
        starts = (ends - sizes)[full]
        out[starts[0]] = first[full[0]]
        out[starts[1:]] = first[full[1:]] - (first[full[:-1]] + sizes[full[:-1]] - 1)
    return np.cumsum(out)


def _bits(sent: np.ndarray) -> bytes:
    return np.packbits(sent).tobytes()


class _Batch:
    """Anchors of a batch: per run of windows with one anchor its first window, their number and hashes."""

    def __init__(self, table: pa.Table, length: int, shift: int) -> None:
        ids = table.column("doc_id").combine_chunks()
        self.ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
        self.data, self.at = text_buffer(table.column("text"))
        self.length = length
        found = [self._runs(a, b, n) for a, b, n in self._pieces()]
        columns = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.zeros(0, np.int64)] * 4
        self.first, self.count = columns[0].astype(np.int64), columns[1].astype(np.int64)
        self.gram, self.string = columns[2].astype(np.uint64), columns[3].astype(np.uint64)
        self.doc = np.searchsorted(self.at, self.first, "right") - 1
        self.bucket = (self.gram >> np.uint64(64 - shift)).astype(np.int64)
        self.short = ((self.gram << np.uint64(shift)) >> np.uint64(32)).astype(np.uint32)

    def _pieces(self) -> Iterator[tuple[int, int, int]]:
        """Byte ranges with the number of window starts looked at; cut at documents or at fixed places of a long one."""
        at, doc, docs = self.at, 0, len(self.at) - 1
        while doc < docs:
            last = max(int(np.searchsorted(at, at[doc] + PIECE, "right")) - 1, doc + 1)
            a, b = int(at[doc]), int(at[last])
            for start in range(a, b, PIECE):
                end = min(start + PIECE, b) if last == doc + 1 else b
                if b - start >= self.length:
                    yield start, min(end + self.length - 1, b), end - start
                if end == b:
                    break
            doc = last

    def _runs(self, a: int, b: int, n: int) -> tuple[np.ndarray, ...]:
        length = self.length
        sums, down = prefix_hash(self.data[a:b], EXACT)
        grams = mix((sums[GRAM:] - sums[:-GRAM]) * down[: len(sums) - GRAM])
        low = (grams >> np.uint64(20) << np.uint64(20)) | np.arange(len(grams), dtype=np.uint64)
        wide, left = 1, length - GRAM + 1
        while wide * 2 <= left:
            low = np.minimum(low[:-wide], low[wide:])
            wide *= 2
        if left > wide:
            low = np.minimum(low[: wide - left], low[left - wide :])
        starts = np.arange(a, a + min(len(low), n))
        ends = self.at[np.searchsorted(self.at, starts, "right")] if len(self.at) > 2 else self.at[-1]
        starts = starts[starts + length <= ends]
        anchor = (low[starts - a] & np.uint64((1 << 20) - 1)).astype(np.int64)
        if not len(starts):
            none = np.zeros(0, np.int64)
            return none, none, none.astype(np.uint64), none.astype(np.uint64)
        new = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (np.diff(starts) != 1))))
        count = np.diff(np.append(new, len(starts)))
        first = starts[new]
        lo, hi = first - a, first - a + count + length - 1
        string = mix((sums[hi] - sums[lo]) * down[lo] + count.astype(np.uint64))
        return first, count, mix(grams[anchor[new]] ^ _SALT), string

    def keys(self, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, documents and suffix keys of all windows of the runs."""
        starts, docs, keys = [], [], []
        for a, b, n in self._pieces():
            own = runs[(self.first[runs] >= a) & (self.first[runs] < a + n)]
            if len(own):
                sums, down = prefix_hash(self.data[a:b], EXACT)
                at = _ragged(self.first[own], self.count[own])
                lo = at - a
                starts.append(at)
                docs.append(np.repeat(self.doc[own], self.count[own]))
                keys.append(mix((sums[lo + self.length] - sums[lo]) * down[lo]))
        if not starts:
            none = np.zeros(0, np.int64)
            return none, none, none.astype(np.uint64)
        return tuple(np.concatenate(x) for x in (starts, docs, keys))

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct anchors as bucket and four bytes, in order, and for each run its place among them."""
        joint = self.bucket.astype(np.uint64) << np.uint64(32) | self.short.astype(np.uint64)
        distinct, place = np.unique(joint, return_inverse=True)
        return (distinct >> np.uint64(32)).astype(np.int64), distinct.astype(np.uint32), place

    def repeated(self, replies: dict[int, bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Runs whose anchor occurs in several documents, and those where some are of this batch."""
        bucket, _, place = self.anchors()
        elsewhere = np.zeros(len(bucket), bool)
        for b, a, e in _groups(bucket):
            if b in replies:
                elsewhere[a:e] = np.unpackbits(np.frombuffer(replies[b], np.uint8), count=e - a)
        ids = self.ids[self.doc]
        if len(place):
            order = np.argsort(place, kind="stable")
            at = np.flatnonzero(np.concatenate(([True], np.diff(place[order]) != 0)))
            here = np.minimum.reduceat(ids[order], at) != np.maximum.reduceat(ids[order], at)
        else:
            here = elsewhere
        return np.flatnonzero((here | elsewhere)[place]), np.flatnonzero(here[place])

    def strings(self, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Runs that stand for the distinct strings, in order of bucket and string; for each run its string."""
        order = np.lexsort((self.string[runs], self.bucket[runs]))
        own = runs[order]
        new = np.ones(len(own), bool)
        new[1:] = (self.string[own][1:] != self.string[own][:-1]) | (self.bucket[own][1:] != self.bucket[own][:-1])
        place = np.empty(len(own), np.int64)
        place[order] = np.cumsum(new) - 1
        return own[new], self.bucket[own[new]], place


def _groups(values: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Value, start and end of each run of equal values."""
    if len(values):
        cuts = [0, *(np.flatnonzero(np.diff(values)) + 1).tolist(), len(values)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            yield int(values[a]), a, b


def _batched(docs: DataFrame, size: int) -> tuple[DataFrame, int]:
    """Documents with a batch number that grows with the id, and the number of batches."""
    total = docs.agg(F.count("doc_id").alias("n"), F.sum(F.octet_length("text")).alias("b")).first()
    batches = max(1, -(-(total["b"] or 0) // size))
    splits: list[int] = []
    if batches > 1 and total["n"]:
        shares = [i / batches for i in range(1, batches)]
        cut = docs.agg(F.percentile_approx("doc_id", shares, 50 * batches + 10_000).alias("p")).first()["p"]
        splits = sorted(set(cut))
    late = len(splits) + 1 + F.pmod(F.xxhash64("text"), F.lit(LATE_BATCHES))
    place = F.size(F.filter(F.array(*map(F.lit, splits)).cast("array<bigint>"), lambda s: s < F.col("doc_id")))
    return docs.withColumn("batch", F.when(F.col("doc_id").isNull(), late).otherwise(place).cast("int")), len(splits) + 1


def remove_repeats(
    df: DataFrame, id_col: str = "doc_id", text: str = "text", length: int = 50, batch_bytes: int = BATCH_BYTES
) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``spans`` and ``kept`` per row.

    Texts are UTF-8 bytes, null is empty. A byte is removed if a string of ``length``
    bytes that covers it also starts in a row with a smaller id; matches never cross
    rows and are judged on the input. ``spans`` holds the maximal removed ranges
    (``start``, ``end``), ``kept`` the other bytes in order, which may begin inside a
    character. Rows of the same id are no source for each other; rows without an id
    come after all others. Other columns are ignored, an empty table gives no rows.
    Windows are equal if their 64-bit keys are.
    """
    if length <= GRAM:
        raise ValueError(f"length must be more than {GRAM}")
    spark = df.sparkSession
    docs = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    docs, batches = _batched(docs, batch_bytes)
    shift = max(4, (2 * int(spark.conf.get("spark.sql.shuffle.partitions"))).bit_length())

    def send_anchors(key: tuple, table: pa.Table) -> pa.Table:
        bucket, short, _ = _Batch(table, length, shift).anchors()
        rows = [(b, short[a:e].tobytes()) for b, a, e in _groups(bucket)]
        return pa.table(
            {
                "bucket": pa.array([r[0] for r in rows], pa.int32()),
                "batch": pa.array([key[0].as_py()] * len(rows), pa.int32()),
                "anchors": pa.array([r[1] for r in rows], pa.binary()),
            }
        )

    def find_repeated(key: tuple, table: pa.Table) -> pa.Table:
        sent = [np.frombuffer(b, np.uint32) for b in table.column("anchors").to_pylist()]
        every = np.sort(np.concatenate(sent))
        repeated = np.unique(every[1:][every[1:] == every[:-1]])
        marks = []
        for own in sent:
            at = np.searchsorted(repeated, own)
            at[at == len(repeated)] = 0
            marks.append(_bits(repeated[at] == own) if len(repeated) else _bits(np.zeros(len(own), bool)))
        return pa.table(
            {
                "batch": table.column("batch"),
                "bucket": table.column("bucket"),
                "marks": pa.array(marks, pa.binary()),
            }
        )

    def replies_of(table: pa.Table) -> dict[int, bytes]:
        return dict(zip(table.column("bucket").to_pylist(), table.column("marks").to_pylist(), strict=True))

    def send_strings(key: tuple, table: pa.Table, replies: pa.Table) -> pa.Table:
        names = ["bucket", "batch", "sizes", "strings"]
        if not table.num_rows:
            return pa.table([pa.array([], t) for t in (pa.int32(), pa.int32(), pa.binary(), pa.binary())], names)
        batch = _Batch(table, length, shift)
        runs, _ = batch.repeated(replies_of(replies))
        stand, bucket, _ = batch.strings(runs)
        packer = zstandard.ZstdCompressor(level=1)
        rows = []
        for b, a, e in _groups(bucket):
            sizes = batch.count[stand[a:e]]
            held = batch.data[_ragged(batch.first[stand[a:e]], sizes + length - 1)]
            rows.append((b, key[0].as_py(), sizes.astype(np.uint32).tobytes(), packer.compress(held.tobytes())))
        return pa.table(
            {
                "bucket": pa.array([r[0] for r in rows], pa.int32()),
                "batch": pa.array([r[1] for r in rows], pa.int32()),
                "sizes": pa.array([r[2] for r in rows], pa.binary()),
                "strings": pa.array([r[3] for r in rows], pa.binary()),
            }
        )

    def scan_levels(key: tuple, table: pa.Table) -> pa.Table:
        family, unpacker = Levels(), zstandard.ZstdDecompressor()
        order = np.argsort(table.column("batch").to_numpy(), kind="stable")
        marks = []
        numbers = []
        for i in order.tolist():
            number = table.column("batch")[i].as_py()
            sizes = np.frombuffer(table.column("sizes")[i].as_py(), np.uint32).astype(np.int64)
            held = np.frombuffer(unpacker.decompress(table.column("strings")[i].as_py()), np.uint8)
            sums, down = prefix_hash(held, EXACT)
            whole = np.cumsum(sizes + length - 1)
            at = _ragged(whole - (sizes + length - 1), sizes)
            keys = mix((sums[at + length] - sums[at]) * down[at])
            array = np.argsort(keys)
            found = np.empty(len(keys), bool)
            ordered = keys[array]
            found[array] = family.holds(ordered)
            marks.append(_bits(found))
            numbers.append(number)
            if number < batches:
                family.add(ordered[np.concatenate(([True], ordered[1:] != ordered[:-1]))])
        return pa.table(
            {
                "batch": pa.array(numbers, pa.int32()),
                "bucket": pa.array([key[0].as_py()] * len(numbers), pa.int32()),
                "marks": pa.array(marks, pa.binary()),
                "late": pa.array([True] * len(numbers), pa.bool_()),
            }
        )

    def cut(key: tuple, table: pa.Table, replies: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _no_rows()
        batch = _Batch(table, length, shift)
        late = replies.column("late").combine_chunks()
        runs, here = batch.repeated(replies_of(replies.filter(pa.compute.invert(late))))
        stand, bucket, place = batch.strings(runs)
        answers = replies_of(replies.filter(late))
        sizes = batch.count[stand]
        marks = np.zeros(int(sizes.sum()), bool)
        at = np.concatenate(([0], np.cumsum(sizes)))
        for b, a, e in _groups(bucket):
            if b in answers:
                n = int(at[e] - at[a])
                marks[at[a] : at[e]] = np.unpackbits(np.frombuffer(answers[b], np.uint8), count=n)
        edges = np.zeros(len(batch.data) + 1, np.int64)
        windows = _ragged(batch.first[runs], batch.count[runs])
        hit = windows[marks[_ragged(at[place], batch.count[runs])]] if len(runs) else windows
        if len(here) and key[0].as_py() < batches:
            starts, docs_of, keys = batch.keys(here)
            order = np.lexsort((batch.ids[docs_of], keys))
            starts, ids, keys = starts[order], batch.ids[docs_of][order], keys[order]
            new = np.concatenate(([True], keys[1:] != keys[:-1]))
            least = ids[np.flatnonzero(new)][np.cumsum(new) - 1]
            hit = np.concatenate([hit, starts[ids > least]])
        np.add.at(edges, hit, 1)
        np.add.at(edges, hit + length, -1)
        gone = np.cumsum(edges[:-1]) > 0
        spans, kept = [], []
        for a, b in zip(batch.at[:-1].tolist(), batch.at[1:].tolist(), strict=True):
            own = gone[a:b]
            turns = np.flatnonzero(np.diff(np.concatenate(([False], own, [False])).astype(np.int8))).tolist()
            spans.append([{"start": s, "end": e} for s, e in zip(turns[::2], turns[1::2], strict=True)])
            kept.append(batch.data[a:b][~own].tobytes())
        return pa.table(
            {
                "doc_id": table.column("doc_id"),
                "n_bytes": pa.array(np.diff(batch.at)),
                "spans": pa.array(spans, _SPANS),
                "kept": pa.array(kept, pa.binary()),
            }
        )

    groups = lambda frame: frame.groupBy("batch")
    anchors = groups(docs).applyInArrow(send_anchors, "bucket int, batch int, anchors binary")
    marks = anchors.groupBy("bucket").applyInArrow(find_repeated, "batch int, bucket int, marks binary")
    strings = (
        groups(docs)
        .cogroup(groups(marks))
        .applyInArrow(send_strings, "bucket int, batch int, sizes binary, strings binary")
    )
    found = strings.groupBy("bucket").applyInArrow(scan_levels, "batch int, bucket int, marks binary, late boolean")
    replies = marks.withColumn("late", F.lit(False)).unionByName(found)
    return (
        groups(docs)
        .cogroup(groups(replies))
        .applyInArrow(cut, "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")
    )


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _no_rows() -> pa.Table:
    kinds = {"doc_id": pa.int64(), "n_bytes": pa.int64(), "spans": _SPANS, "kept": pa.binary()}
    return pa.table({c: pa.array([], t) for c, t in kinds.items()})
