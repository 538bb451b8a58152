"""SimHash fingerprints, and all pairs of them within a few bits by a Gray-order hierarchical index.

An upper node of the index is a mask with the bits its fingerprints share under it. The
topmost nodes split the 64 bits into one more part than bits may differ, so two near
fingerprints agree on a part and meet below at least one of these nodes. A node that holds
more than ``NODE`` fingerprints is factored again by the parts of its free bits, which
again loses no pair. Different fingerprints below a node differ in its free bits only, so
there are at most ``2 ** free`` of them: factoring ends by itself, and no node is too
large for a task whatever the data.

Below such a node fingerprints are sorted by Gray rank, which puts those with common leading
bits side by side. Runs of ``FAN`` neighbours, then runs of these, are nodes as well: each
keeps the bits that all below it share and no node above it has. A search adds up the
differences on these masks on its way down and drops a whole node once there are too many.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adloom.llm.components import connected_components
from adloom.llm.words import batches, text_buffer
from adloom.operators.joins import size_checked, stored
from adloom.session import materialize

#: Fingerprints of one node that a task searches among each other.
NODE = 4096
#: Children of an inner node.
FAN = 16
#: Rows of nodes that meet in a task, on average.
BUCKET = 200_000
#: Steps of searches that a task looks at together.
_STEPS = 1 << 20
#: Shingles whose bits are counted together, and bytes of a text that are cut into words at once.
_COUNTED = 1 << 14
_PIECE = 1 << 20

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_BLANK = re.compile(rb"[\x20\x09-\x0D]")
_XXH64 = partial(xxhash.xxh64_intdigest, seed=42)


def _words(text: bytes) -> Iterator[list[bytes]]:
    """Words of a text in lists that together hold no more than about a piece of it."""
    start = 0
    while start < len(text):
        cut = _BLANK.search(text, min(start + _PIECE, len(text)))
        end = cut.start() if cut else len(text)
        yield _WORD.findall(text, start, end)
        start = end


def _hashes(text: bytes, k: int) -> Iterator[int]:
    """XXH64 of every shingle of ``k`` words, or of all words if there are fewer."""
    held: list[bytes] = []
    whole = True
    for found in _words(text):
        held += found
        if len(held) >= k:
            whole = False
            yield from map(_XXH64, map(b" ".join, zip(*(held[i:] for i in range(k)), strict=False)))
            held = held[len(held) - k + 1 :]
    if whole and held:
        yield _XXH64(b" ".join(held))


def fingerprint(text: bytes, k: int = 3) -> int:
    """The 64 bits that are set in over half of the shingles' hashes; 0 without words."""
    ones, n = np.zeros(64, np.int64), 0
    hashes = _hashes(text.lower(), k)
    while part := list(islice(hashes, _COUNTED)):
        bits = np.unpackbits(np.array(part, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
        n += len(part)
    return int((2 * ones > n) @ (np.uint64(1) << np.arange(64, dtype=np.uint64))) if n else 0


def _fingerprints(k: int):
    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(found):
            data, at = text_buffer(batch.column("text"))
            prints = [fingerprint(data[a:b].tobytes(), k) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            signed = np.array(prints, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(signed)], ["doc_id", "print"])

    return run


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Place of 64-bit words in Gray order, in which neighbours differ in one bit."""
    x = x.copy()
    for step in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(step)
    return x


def split_mask(free: int, parts: int) -> list[int]:
    """The set bits of ``free`` as ``parts`` masks of nearly equal size, highest bits first."""
    bits = [i for i in range(63, -1, -1) if free >> i & 1]
    edges = [len(bits) * i // parts for i in range(parts + 1)]
    return [sum(1 << i for i in bits[a:b]) for a, b in zip(edges, edges[1:], strict=False)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


class Index:
    """Nodes over sorted fingerprints, level by level: where children begin, and what is shared."""

    def __init__(self, node: np.ndarray, prints: np.ndarray) -> None:
        """``node`` numbers the upper node of each fingerprint; both are sorted by it, then by Gray rank."""
        self.prints = prints
        none = np.zeros(len(prints), np.uint64)
        group, both, either = node, prints, prints
        levels = [(both, ~none, None)]
        while len(group) > 1 and (group[1:] == group[:-1]).any():
            first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
            inside = np.arange(len(group)) - np.repeat(first, np.diff(np.r_[first, len(group)]))
            starts = np.flatnonzero(inside % FAN == 0)
            both = np.bitwise_and.reduceat(both, starts)
            either = np.bitwise_or.reduceat(either, starts)
            group = group[starts]
            levels.append((both, ~(both ^ either), starts))
        # From the top: (pattern, bits shared beyond the parent's, first child, end of children).
        self.levels = []
        for depth in range(len(levels) - 1, -1, -1):
            pattern, shared, starts = levels[depth]
            above = none[: len(pattern)]
            if depth + 1 < len(levels):
                up = levels[depth + 1]
                above = np.repeat(up[1], np.diff(np.r_[up[2], len(pattern)]))
            ends = None if starts is None else np.r_[starts[1:], len(levels[depth - 1][0])]
            self.levels.append((pattern, shared & ~above, starts, ends))
        self.roots = group

    def near(self, rows: np.ndarray, root: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (row, later row) below the same upper node that differ in 1 to ``most`` bits."""
        query, at, far = rows, root, np.zeros(len(rows), np.int64)
        for pattern, shared, starts, ends in self.levels:
            far = far + np.bitwise_count((self.prints[query] ^ pattern[at]) & shared[at])
            kept = far <= most
            query, at, far = query[kept], at[kept], far[kept]
            if starts is None:
                later = at > query
                return query[later], at[later]
            n = ends[at] - starts[at]
            child = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(starts[at], n)
            query, at, far = np.repeat(query, n), child, np.repeat(far, n)
        raise AssertionError("the last level holds the fingerprints")


def _find(parent: np.ndarray) -> np.ndarray:
    while True:
        up = parent[parent]
        if (up == parent).all():
            return parent
        parent = up


def _join(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``parent`` after the ends of all pairs are joined; it always names a component's first row."""
    while True:
        parent = _find(parent)
        x, y = parent[a], parent[b]
        apart = x != y
        if not apart.any():
            return parent
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))


def _links(most: int):
    """Links of one bucket's nodes: every fingerprint with the first one of those it is connected to."""

    def run(table: pa.Table) -> pa.Table:
        path, pattern, prints = (table.column(c).to_numpy() for c in ("path", "pattern", "print"))
        prints = prints.view(np.uint64)
        order = np.lexsort((gray_rank(prints), pattern, path))
        path, pattern, prints = path[order], pattern[order], prints[order]
        new = np.r_[True, (path[1:] != path[:-1]) | (pattern[1:] != pattern[:-1])] if len(prints) else np.zeros(0, bool)
        node = np.cumsum(new) - 1
        index = Index(node, prints)
        parent = np.arange(len(prints))
        # A search takes at most its node's fingerprints in steps; so many of them go together.
        cost = np.cumsum(np.bincount(node)[node]) if len(node) else node
        begin = 0
        while begin < len(prints):
            end = max(begin + 1, int(np.searchsorted(cost, (cost[begin - 1] if begin else 0) + _STEPS)))
            rows = np.arange(begin, end)
            parent = _join(parent, *index.near(rows, np.searchsorted(index.roots, node[rows]), most))
            begin = end
        linked = np.flatnonzero(parent != np.arange(len(prints)))
        ends = [prints[linked].view(np.int64), prints[parent[linked]].view(np.int64)]
        return pa.table([pa.array(x, pa.int64()) for x in ends], names=["x", "y"])

    return run


def near_links(prints: DataFrame, n: int, most: int = 2) -> DataFrame:
    """``(x, y)``: links that connect the ``n`` different fingerprints ``print`` like all pairs within ``most`` bits."""
    masks = dict(enumerate(split_mask((1 << 64) - 1, most + 1)))
    spread = prints.select("print", F.explode(F.array(*[_node(i, m) for i, m in masks.items()])).alias("node"))
    rows = materialize(spread.select("print", "node.*"), "prints")
    dealt, total = [], (most + 1) * n
    while True:
        large = rows.groupBy("path", "pattern").count().filter(F.col("count") > NODE).select("path", "pattern")
        large, small = stored(large, "large-nodes")
        if large.isEmpty():
            dealt.append(rows)
            break
        held = F.broadcast(large) if small else large
        dealt.append(rows.join(held, ["path", "pattern"], "left_anti"))
        below = {}
        for path, mask in masks.items():
            for i, part in enumerate(split_mask(((1 << 64) - 1) & ~mask, most + 1)):
                below[(path + 1) * (most + 2) + i] = (path, mask | part)
        nodes = F.filter(
            F.array(*[F.when(F.col("path") == up, _node(path, mask)) for path, (up, mask) in below.items()]),
            lambda x: x.isNotNull(),
        )
        spread = rows.join(held, ["path", "pattern"], "left_semi").select("print", F.explode(nodes).alias("node"))
        rows = materialize(spread.select("print", "node.*"), "prints")
        masks = {path: mask for path, (_, mask) in below.items()}
        total += rows.count()
    found = dealt[0]
    for more in dealt[1:]:
        found = found.union(more)
    # The number of buckets follows the rows; a node is never cut.
    bucket = F.pmod(F.xxhash64("path", "pattern"), F.lit(max(64, -(-total // BUCKET)))).alias("bucket")
    return found.select("path", "pattern", "print", bucket).groupBy("bucket").applyInArrow(_links(most), "x bigint, y bigint")


def _node(path: int, mask: int):
    pattern = F.col("print").bitwiseAND(F.lit(_signed(mask)))
    return F.struct(F.lit(path).cast("long").alias("path"), pattern.alias("pattern"))


def near_fingerprints(
    df: DataFrame, id_col: str = "doc_id", text: str = "text", k: int = 3, most: int = 2
) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 lower-case hex digits) and ``component_id`` per row.

    A fingerprint's bit is set if over half of the XXH64 (seed 42) of the text's shingles
    have it: ``k`` words parted by ASCII blanks, A-Z lower-cased, joined by one blank each,
    repeats counted; fewer words are one shingle. Null, empty and blank texts have the
    fingerprint zero and are linked like any other. Rows link where their fingerprints
    differ in at most ``most`` bits; ``component_id`` is the smallest id reachable, a row's
    own included, and null where no such row has an id. Texts are read whole, in pieces;
    repeated rows come out as often; other columns are ignored; an empty table gives no rows.
    """
    docs = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    rows = materialize(docs.mapInArrow(_fingerprints(k), "doc_id bigint, print bigint"), "fingerprints")
    classes = materialize(rows.groupBy("print").agg(F.min("doc_id").alias("first")), "fingerprint-classes")
    links = materialize(near_links(classes, classes.count(), most), "fingerprint-links")
    roots = connected_components(links, "fingerprint-roots")
    # Only classes with a link change their name; the others keep their own first id.
    held = classes.join(roots.withColumnRenamed("node", "print"), "print")
    named = held.groupBy("root").agg(F.min("first").alias("component_id"))
    linked = held.join(named, "root").select("print", "component_id")
    alone = classes.join(roots.select(F.col("node").alias("print")), "print", "left_anti")
    (named,) = size_checked(linked.union(alone.select("print", F.col("first").alias("component_id"))))
    shown = F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint")
    return rows.join(named, "print").select("doc_id", shown, "component_id")
