"""Words and shingles of whole texts as 64-bit hashes, computed on Arrow batches with NumPy.

Texts are laid end to end and cut into pieces of about ``PIECE`` bytes at word
boundaries, so memory is bounded by a piece and by the words of one batch, not
by the batch's text. Equal words have equal hashes; two different words or
shingles share one with a chance of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)

# The six ASCII blanks: space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = np.zeros(256, bool)
BLANKS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def _byte_codes(lower: bool, digits: bool = False) -> np.ndarray:
    seen = np.arange(256, dtype=np.uint64)
    if lower:
        seen[65:91] += np.uint64(32)
    if digits:
        seen[48:58] = 48
    return mix(seen + np.uint64(0x632BE59BD9B4E019))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit value over all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def order_by(*columns: np.ndarray) -> np.ndarray:
    """Order of rows by columns of 64-bit integers, the first counting most; equal rows stay as they are.

    As many columns as fit into 64 bits beside a row's number are sorted at once, as plain numbers,
    which is faster than sorting row numbers by each column (``np.lexsort``).
    """
    n = len(columns[0])
    order = np.arange(n)
    if n < 2:
        return order
    row_bits = (n - 1).bit_length()
    parts: list[tuple[np.ndarray, int]] = []
    for column in reversed(columns):
        low = int(column.min())
        bits = (int(column.max()) - low).bit_length()
        above = column.astype(np.uint64) - np.uint64(low & (1 << 64) - 1)
        while bits > 64 - row_bits:
            parts.append((above & np.uint64((1 << 24) - 1), 24))
            above, bits = above >> np.uint64(24), bits - 24
        parts.append((above, bits))
    number, used = np.zeros(n, np.uint64), 0
    for i, (part, bits) in enumerate(parts):
        number |= part << np.uint64(used)
        used += bits
        if i + 1 == len(parts) or used + parts[i + 1][1] > 64 - row_bits:
            rows = np.sort(number[order] << np.uint64(row_bits) | np.arange(n, dtype=np.uint64)) & np.uint64((1 << row_bits) - 1)
            order = order[rows.astype(np.int64)]
            number, used = np.zeros(n, np.uint64), 0
    return order


EXACT = _byte_codes(False)
LOWER = _byte_codes(True)
LOWER_DIGITS = _byte_codes(True, True)


class _Powers:
    """Powers of the hash base and of its inverse, as many as the longest piece needed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            for name, base in (("up", _BASE), ("down", _INVERSE)):
                steps = np.full(n, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up[:n], self.down[:n]


_powers = _Powers()


def prefix_hash(data: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums ``c`` and factors ``d``: bytes ``a`` to ``b`` hash to ``(c[b] - c[a]) * d[a]``."""
    up, down = _powers.get(len(data) + 1)
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(codes[data] * up[:-1], out=sums[1:])
    return sums, down


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text column end to end, and where each text starts and the last ends; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    at = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[at[0] : at[-1]], at - at[0]


def _pieces(data: np.ndarray, at: np.ndarray, blank: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of about ``PIECE`` bytes that cut no word; texts end words as well."""
    start, n = 0, len(data)
    while start < n:
        end = min(start + PIECE, n)
        if end < n:
            whole = at[np.searchsorted(at, end, "right") - 1]
            if whole > start:
                end = int(whole)
            else:
                limit = int(at[np.searchsorted(at, end)])
                while end < limit and not blank[data[end]]:
                    step = blank[data[end : min(end + 65536, limit)]]
                    end = end + int(step.argmax()) if step.any() else min(end + 65536, limit)
        yield start, end
        start = end


def words(
    data: np.ndarray, at: np.ndarray, blank: np.ndarray = BLANKS, codes: np.ndarray = EXACT
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and end of every word, and the first word of each text (one entry more than texts)."""
    found = []
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    for a, b in _pieces(data, at, blank):
        part = data[a:b]
        solid = ~blank[part]
        opens = solid.copy()
        opens[1:] &= ~solid[:-1] | edge[a + 1 : b]
        closes = solid.copy()
        closes[:-1] &= ~solid[1:] | edge[a + 1 : b]
        first, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        sums, down = prefix_hash(part, codes)
        found.append((mix((sums[end] - sums[first]) * down[first] + (end - first).astype(np.uint64)), first + a, end + a))
    if not found:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, np.zeros(len(at), np.int64)
    hashes, first, end = (np.concatenate(x) for x in zip(*found, strict=True))
    return hashes, first, end, np.searchsorted(first, at)


def shingles(hashes: np.ndarray, starts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of ``k`` words from each word on, and which of them lie within one text."""
    n = len(hashes)
    out = np.full(n, 0xD1B54A32D192ED03 + k, np.uint64)
    for j in range(min(k, n)):
        out[: n - j] = mix(out[: n - j] * np.uint64(_BASE) + hashes[j:])
    left = np.repeat(starts[1:], np.diff(starts)) - np.arange(n)
    return out, left >= k


def batches(found: Iterator[pa.RecordBatch], rows: int = 4096) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most ``rows`` rows and about two pieces of bytes."""
    for batch in found:
        done = 0
        while done < batch.num_rows:
            part = batch.slice(done, rows)
            while part.num_rows > 1 and part.nbytes > 2 * PIECE:
                part = part.slice(0, part.num_rows // 2)
            yield part
            done += part.num_rows
