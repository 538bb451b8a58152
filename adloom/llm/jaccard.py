"""Exact Jaccard join of word-shingle sets by prefixes under several token orders.

Two sets of Jaccard similarity ``t`` or more share a token among the first
``n - ceil(t n) + 1`` of each, whatever global order the tokens are put in. The
join therefore takes two orders, keeps the pairs that share a prefix token under
both, and as many of them as their sizes ask for, and only then compares whole sets. Each order puts tokens that many
documents hold last, by classes of their count, and is otherwise random, so the
lists of documents per prefix token stay short.

Equal sets are one node of the join. No list is expanded into all its pairs
where that can be spared: in a list of more than ``SMALL_LIST`` nodes a node is
first compared with the best of a few anchors only. Once those links are joined into
components, the candidates between different components are listed, in blocks, unless a
bitmap of their tokens' parities shows that they differ in too many; each node's nearest ones are compared, and of the others all that still lie between
different components. The links so found connect the same documents as all links would.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adloom.llm.components import connected_components
from adloom.llm.words import BLANKS, LOWER, batches, mix, shingles, text_buffer, words
from adloom.operators.joins import stored
from adloom.session import materialize

#: Longest list that is expanded into its pairs at once.
SMALL_LIST = 2
#: Nodes of a longer list that all others are compared with at first, and candidates
#: of a node that are compared before the rest. Both only save comparisons.
ANCHORS = 3
NEAREST = 4
#: Nodes of a list that meet those of another block in one step.
BLOCK = 4096
#: Classes of tokens, as a power of two, whose parities bound what two sets share.
PARITY_BITS = 9
#: A token repeated so often within ``COUNT_BLOCK`` shingles of a task is counted
#: over the corpus; from ``COMMON`` on it goes to the end of the orders, the most
#: frequent last. These steer the order only, never the result.
LOCAL_REPEATS = 8
COUNT_BLOCK = 2_000_000
COMMON = 64
COMMON_KEPT = 1 << 17
#: Prefix entries that one bucket gets, about, and that a task packs at once.
BUCKET_ENTRIES = 100_000
PACK_ENTRIES = 500_000
_SEEDS = (np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344))


def _sets(batch: pa.RecordBatch, where: int, k: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text; the whole sequence where it is shorter than ``k`` words."""
    data, at = text_buffer(batch.column(where))
    hashes, _, _, starts = words(data, at, BLANKS, LOWER)
    found, whole = shingles(hashes, starts, k)
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
        if b - a >= k:
            own = np.sort(found[a : b - k + 1])
            yield own[np.concatenate(([True], own[1:] != own[:-1]))]
        elif b > a:
            short, fits = shingles(hashes[a:b], np.array([0, b - a]), b - a)
            yield short[fits]
        else:
            yield found[:0]


def _node(tokens: np.ndarray) -> int:
    """One number for a set."""
    total = np.array([mix(tokens).sum(dtype=np.uint64) + np.uint64(len(tokens))])
    return int(mix(total).view(np.int64)[0])


def _parities(tokens: np.ndarray) -> bytes:
    """A bit per class of tokens: whether the set has an odd number of them.

    Where the bits of two sets differ, at least one token of that class is in one set only, so
    they share at most ``(n1 + n2 - differing bits) / 2`` tokens.
    """
    odd = np.bincount((tokens >> np.uint64(64 - PARITY_BITS)).astype(np.int64), minlength=1 << PARITY_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _survey(df: DataFrame, k: int) -> DataFrame:
    """Per row its node, set size, key and parities (``kind`` 0), and locally repeated tokens with counts (``kind`` 1)."""
    schema = "kind int, doc_id long, node long, n long, row long, bits binary"

    def flush(seen: list[np.ndarray]) -> pa.RecordBatch:
        tokens, counts = np.unique(np.concatenate(seen), return_counts=True)
        often = counts >= LOCAL_REPEATS
        n = int(often.sum())
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.ones(n, np.int32)),
                pa.nulls(n, pa.int64()),
                _signed(tokens[often]),
                pa.array(counts[often].astype(np.int64)),
                pa.nulls(n, pa.int64()),
                pa.nulls(n, pa.binary()),
            ],
            names=["kind", "doc_id", "node", "n", "row", "bits"],
        )

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, held = [], 0
        for batch in batches(found):
            sets = list(_sets(batch, 1, k))
            nodes = [_node(s) if len(s) else None for s in sets]
            sizes = [len(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.zeros(len(sets), np.int32)),
                    batch.column(0),
                    pa.array(nodes, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    batch.column(2),
                    pa.array([_parities(s) for s in sets], pa.binary()),
                ],
                names=["kind", "doc_id", "node", "n", "row", "bits"],
            )
            seen += sets
            held += sum(sizes)
            if held >= COUNT_BLOCK:
                yield flush(seen)
                seen, held = [], 0
        if seen:
            yield flush(seen)

    return df.mapInArrow(run, schema)


class _Common:
    """Frequent tokens and their classes, for task-side lookup."""

    def __init__(self, tokens: list[int], counts: list[int]) -> None:
        values = np.array(tokens, np.int64).view(np.uint64)
        order = np.argsort(values)
        self.tokens = values[order]
        self.classes = np.log2(np.array(counts, np.float64)[order] / COMMON).astype(np.int64) + 1
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[self.tokens & np.uint64(0xFFFF)] = True

    def of(self, tokens: np.ndarray) -> np.ndarray | None:
        if not len(self.tokens):
            return None
        maybe = np.flatnonzero(self.maybe[tokens & np.uint64(0xFFFF)])
        at = np.searchsorted(self.tokens, tokens[maybe])
        at[at == len(self.tokens)] = 0
        hit = self.tokens[at] == tokens[maybe]
        if not hit.any():
            return None
        classes = np.zeros(len(tokens), np.int64)
        classes[maybe[hit]] = self.classes[at[hit]]
        return classes


def _prefixes(df: DataFrame, k: int, num: int, den: int, common: Broadcast, buckets: int) -> DataFrame:
    """Prefix entries ``(key, node, size and order)``, packed per batch and key bucket.

    A key names a token under one order. Entries are eight-byte columns laid one after
    the other; keys of the same bucket meet in one group of the next step.
    """
    shift = np.uint64(64 - int(buckets).bit_length() + 1)

    def pack(parts: list[tuple]) -> pa.RecordBatch:
        sizes = [len(p[0]) for p in parts]
        key = np.concatenate([p[0] for p in parts])
        node = np.repeat(np.array([p[1] for p in parts], np.int64), sizes)
        about = np.repeat(np.array([p[2] * 2 + p[3] for p in parts], np.int64), sizes)
        # Prefixes hold the least ranks, so the key itself would fill few buckets.
        bucket = (mix(key) >> shift).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        packed = np.stack([key.view(np.int64), node, about])[:, order]
        bucket = bucket[order]
        cuts = np.flatnonzero(np.diff(bucket)) + 1
        ends = [0, *cuts.tolist(), len(bucket)]
        rows = [(bucket[a], packed[:, a:b].tobytes()) for a, b in zip(ends[:-1], ends[1:], strict=True)]
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())],
            names=["bucket", "entries"],
        )

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = common.value
        parts: list[tuple] = []
        held = 0
        for batch in batches(found, 8192):
            for tokens in _sets(batch, 1, k):
                n = len(tokens)
                if not n:
                    continue
                size = n - -(-num * n // den) + 1
                classes = lookup.of(tokens)
                node = _node(tokens)
                for order, seed in enumerate(_SEEDS):
                    rank = mix(tokens ^ seed)
                    if classes is not None:
                        first = np.lexsort((rank, classes))[:size]
                    elif size < n:
                        first = np.argpartition(rank, size - 1)[:size]
                    else:
                        first = np.arange(n)
                    parts.append((rank[first], node, n, order))
                held += 2 * size
                if held >= PACK_ENTRIES:
                    yield pack(parts)
                    parts, held = [], 0
        if parts:
            yield pack(parts)

    return df.mapInArrow(run, "bucket long, entries binary")


def _close(n1: np.ndarray, n2: np.ndarray, num: int, den: int) -> np.ndarray:
    """Whether sets of these sizes can be similar."""
    return num * np.maximum(n1, n2) <= den * np.minimum(n1, n2)


def _need(n1: np.ndarray, n2: np.ndarray, num: int, den: int) -> np.ndarray:
    """Prefix tokens that similar sets share under each order: what lies beyond the prefixes can't make up for less."""
    overlap = -(-num * (n1 + n2) // (den + num))
    return overlap - np.maximum(-(-num * n1 // den), -(-num * n2 // den)) + 1


_FOUND = "kind int, x long, y long, first long, second long, need long, anchor long"


def _found(kind: int, *columns) -> pa.Table:
    columns = [np.full(len(columns[0]), kind, np.int32), *(np.asarray(c, np.int64) for c in columns)]
    return pa.table(dict(zip([c.split()[0] for c in _FOUND.split(", ")], columns, strict=True)))


def _pair_table(x, y, second, need, anchor) -> pa.Table:
    """Distinct pairs, the smaller node first, with the tokens shared under each order."""
    lo, hi = np.minimum(x, y), np.maximum(x, y)
    order = np.lexsort((hi, lo))
    lo, hi, second, need, anchor = (c[order] for c in (lo, hi, second, need, anchor))
    if not len(lo):
        return _found(0, lo, hi, second, second, need, anchor)
    at = np.flatnonzero(np.concatenate(([True], (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1]))))
    seconds = np.add.reduceat(second, at)
    met = np.diff(np.append(at, len(lo)))
    return _found(0, lo[at], hi[at], met - seconds, seconds, need[at], np.minimum.reduceat(anchor, at))


def _lists(num: int, den: int):
    """Pairs of short lists and of long ones with their anchor (``kind`` 0); entries of long lists (``kind`` 1)."""

    def run(table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(b, np.int64).reshape(3, -1) for b in table.column("entries").to_pylist()]
        key, node, about = np.concatenate(parts, axis=1)
        order = np.lexsort((node, key))
        key, node, about = key[order], node[order], about[order]
        new = np.concatenate(([True], (key[1:] != key[:-1]) | (node[1:] != node[:-1])))
        key, node, about = key[new], node[new], about[new]
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        length = np.diff(np.append(first, len(key)))
        start, long = np.repeat(first, length), np.repeat(length, length)
        size, second = about >> 1, about & 1
        pairs = []
        for step in range(1, SMALL_LIST):
            a = np.flatnonzero((long[:-step] <= SMALL_LIST) & (key[:-step] == key[step:]))
            pairs.append((a, a + step, np.zeros(len(a), np.int64)))
        for step in range(ANCHORS):
            far = np.flatnonzero((long > SMALL_LIST) & (start + step < np.arange(len(key))))
            pairs.append((start[far] + step, far, np.ones(len(far), np.int64)))
        a, b, anchor = (np.concatenate(c) for c in zip(*pairs, strict=True))
        fits = _close(size[a], size[b], num, den)
        a, b, anchor = a[fits], b[fits], anchor[fits]
        keep = np.flatnonzero(long > SMALL_LIST)
        none = np.zeros(len(keep), np.int64)
        return pa.concat_tables(
            [
                _pair_table(node[a], node[b], second[a], _need(size[a], size[b], num, den), anchor),
                _found(1, key[keep], node[keep], about[keep], long[keep], node[start[keep]], none),
            ]
        )

    return run


def _crossing(num: int, den: int):
    """Candidates between different components among the lists of one first node.

    The lists of a group of versions nearly all meet here. For one node at a time its fellows
    are counted over all its lists; a pair is passed on if the tokens shared here, with all
    that either node could still share in other lists, suffice under both orders.
    """

    def run(table: pa.Table) -> pa.Table:
        names = ["head", "parts", "lo", "hi", "key", "block", "node", "about", "root", "left_first", "left_second"]
        col = {c: table.column(c).to_numpy() for c in names}
        col["bits"] = np.frombuffer(b"".join(table.column("bits").to_pylist()), np.uint64).reshape(table.num_rows, -1)
        order = np.lexsort((col["node"], col["key"], col["hi"], col["lo"], col["parts"], col["head"]))
        col = {c: v[order] for c, v in col.items()}
        cuts = np.zeros(len(order), bool)
        cuts[0] = True
        for c in ("head", "parts", "lo", "hi"):
            cuts[1:] |= col[c][1:] != col[c][:-1]
        at = [*np.flatnonzero(cuts).tolist(), len(order)]
        parts = []
        for a, b in zip(at[:-1], at[1:], strict=True):
            if (col["root"][a:b] != col["root"][a]).any():
                parts.append(_meetings({c: v[a:b] for c, v in col.items()}, num, den))
        none = np.zeros(0, np.int64)
        x, y, first, second, need = (np.concatenate(c) for c in zip(*parts, strict=True)) if parts else [none] * 5
        return _found(0, x, y, first, second, need, np.zeros(len(x), np.int64))

    return run


def _meetings(col: dict[str, np.ndarray], num: int, den: int) -> tuple[np.ndarray, ...]:
    """Pairs ``(x, y)`` of one group of lists with the tokens they share there under each order."""
    nodes, one, place = np.unique(col["node"], return_index=True, return_inverse=True)
    size, root, block, bits = col["about"][one] >> 1, col["root"][one], col["block"][one], col["bits"][one]
    second = (col["about"] & 1).astype(bool)
    starts = np.flatnonzero(np.concatenate(([True], col["key"][1:] != col["key"][:-1])))
    ends = np.append(starts[1:], len(place))
    list_of = np.repeat(np.arange(len(starts)), ends - starts)
    other = np.stack([col["left_first"][one], col["left_second"][one]])
    other -= np.stack([np.bincount(place[~second], minlength=len(nodes)), np.bincount(place[second], minlength=len(nodes))])
    split = col["lo"][0] != col["hi"][0]
    mine = np.argsort(place, kind="stable")
    own_at = np.concatenate(([0], np.cumsum(np.bincount(place, minlength=len(nodes)))))
    found = []
    for i in range(len(nodes)):
        if split and block[i] != col["lo"][0]:
            continue
        entries = mine[own_at[i] : own_at[i + 1]]
        shared = []
        for order in (False, True):
            lists = list_of[entries[second[entries] == order]]
            members = [place[starts[k] : ends[k]] for k in lists.tolist()]
            shared.append(np.bincount(np.concatenate(members), minlength=len(nodes)) if members else np.zeros(len(nodes), np.int64))
        j = np.flatnonzero((shared[0] + shared[1] > 0) & (root != root[i]) & _close(size, size[i], num, den))
        j = j[block[j] == col["hi"][0]] if split else j[j > i]
        need = np.maximum(_need(size[j], size[i], num, den), 1)
        for order in (0, 1):
            most = shared[order][j] + np.minimum(other[order][j], other[order][i])
            j, need = j[most >= need], need[most >= need]
        both = size[j] + size[i]
        most = (both - np.bitwise_count(bits[j] ^ bits[i]).sum(axis=1, dtype=np.int64)) // 2
        fits = (den + num) * most >= num * both
        j, need = j[fits], need[fits]
        if len(j):
            lo, hi = np.minimum(nodes[i], nodes[j]), np.maximum(nodes[i], nodes[j])
            found.append((lo, hi, shared[0][j], shared[1][j], need))
    none = np.zeros(0, np.int64)
    return tuple(np.concatenate(c) for c in zip(*found, strict=True)) if found else (none,) * 5


def _linked(df: DataFrame, pairs: DataFrame, nodes: DataFrame, k: int, num: int, den: int, name: str) -> DataFrame:
    """``(x, y, linked)`` for each pair, by comparing the whole sets."""
    pairs = materialize(pairs.select("x", "y"), f"{name}-pairs")
    wanted = pairs.select(F.explode(F.array("x", "y")).alias("node")).distinct()
    owners = nodes.join(wanted, "node").groupBy("node").agg(F.min("row").alias("row")).select("row").distinct()
    owners, small = stored(owners, f"{name}-owners")
    texts = df.join(F.broadcast(owners) if small else owners, "row", "left_semi").select("doc_id", "text")

    def sets(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(found):
            own = [s for s in _sets(batch, 1, k) if len(s)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([_node(s) for s in own], pa.int64()), pa.array([s.tobytes() for s in own], pa.binary())],
                names=["node", "tokens"],
            )

    own = materialize(texts.mapInArrow(sets, "node long, tokens binary").dropDuplicates(["node"]), f"{name}-sets")

    def compare(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(found):
            linked = []
            for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                both = np.sort(np.concatenate([np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)]))
                shared = int((both[1:] == both[:-1]).sum())
                linked.append(den * shared >= num * (len(both) - shared))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(linked, pa.bool_())], names=["x", "y", "linked"]
            )

    left = own.select(F.col("node").alias("x"), F.col("tokens").alias("a"))
    right = own.select(F.col("node").alias("y"), F.col("tokens").alias("b"))
    joined = pairs.join(left, "x").join(right, "y").select("x", "y", "a", "b")
    return materialize(joined.mapInArrow(compare, "x long, y long, linked boolean"), f"{name}-linked")


def _between(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs whose ends lie in different components."""
    ends = roots.withColumnsRenamed({"node": "x", "root": "rx"})
    pairs = pairs.join(ends, "x", "left")
    pairs = pairs.join(ends.withColumnsRenamed({"x": "y", "rx": "ry"}), "y", "left")
    return pairs.filter(F.coalesce("rx", "x") != F.coalesce("ry", "y")).drop("rx", "ry")


def _joined(roots: DataFrame, tried: DataFrame) -> DataFrame:
    """Components after the new links."""
    stars = roots.filter("node != root").select(F.col("node").alias("x"), F.col("root").alias("y"))
    more = stars.union(tried.filter("linked").select("x", "y"))
    return materialize(connected_components(more, "join-roots"), "join-roots")


def near_duplicates(
    df: DataFrame, id_col: str = "doc_id", text: str = "text", k: int = 5, num: int = 80, den: int = 100
) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` (smallest id reachable by links) per row.

    A text's set holds its distinct shingles of ``k`` words (A-Z lower-cased, parted
    by ASCII blanks), or its whole sequence where it has fewer words. Rows link if
    ``den * intersection >= num * union``. Null, empty and blank texts have size 0
    and stay alone; equal texts, also repeated rows, are linked. A row without an id
    counts as a document but never names a component. Other columns are ignored;
    an empty table gives no rows. Texts are read whole; tokens are compared by
    64-bit hashes.
    """
    spark = df.sparkSession
    docs = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    keyed = docs.withColumn("row", F.xxhash64("doc_id", "text"))
    survey = materialize(_survey(keyed, k), "join-survey")
    rows = survey.filter("kind = 0").select("doc_id", "node", F.col("n").alias("n_shingles"))
    nodes = survey.filter("kind = 0 and node is not null").select("doc_id", "node", "row")
    bits = survey.filter("kind = 0 and node is not null").groupBy("node").agg(F.first("bits").alias("bits"))

    often = survey.filter("kind = 1").groupBy("node").agg(F.sum("n").alias("n")).filter(F.col("n") >= COMMON)
    often = often.orderBy(F.desc("n"), "node").limit(COMMON_KEPT).toPandas()  # bounded; steers the order only
    common = spark.sparkContext.broadcast(_Common(often["node"].tolist(), often["n"].tolist()))

    # Buckets by what they hold, so that a group takes the same memory whatever the size of the table.
    size = F.expr(f"n_shingles - ceil({num} * n_shingles / {den}) + 1")
    total = 2 * int(rows.filter("n_shingles > 0").agg(F.sum(size).alias("n")).first()["n"] or 0)
    tasks = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = 1 << max(6, tasks.bit_length(), (total // BUCKET_ENTRIES).bit_length())
    entries = _prefixes(docs, k, num, den, common, buckets)
    lists = materialize(entries.groupBy("bucket").applyInArrow(_lists(num, den), _FOUND), "join-lists")

    # First the pairs already seen to share enough under both orders; of a node's anchors in
    # long lists, the one met most often.
    sums = [F.sum("first").alias("first"), F.sum("second").alias("second"), F.max("need").alias("need")]
    met = lists.filter("kind = 0").groupBy("x", "y", "anchor").agg(*sums)
    met = materialize(met, "join-met")
    both = met.groupBy("x", "y").agg(*sums, F.min("anchor").alias("anchor"))
    both = both.filter("first >= greatest(need, 1) and second >= greatest(need, 1)")
    n = F.col("first") + F.col("second")
    best = both.filter("anchor = 1").groupBy("y").agg(F.max_by("x", F.struct(n, "x")).alias("x")).select("x", "y")
    first = both.filter("anchor = 0").select("x", "y").union(best).distinct()
    tried = _linked(keyed, first, nodes, k, num, den, "join-1")
    links = tried.filter("linked").select("x", "y")
    roots = materialize(connected_components(links, "join-roots"), "join-roots")

    # What is left: pairs whose ends are not connected yet, now with all shared tokens counted.
    # Lists with the same first node, as those of a group of versions, meet in one bucket.
    root = F.coalesce("root", "node").alias("root")
    held = lists.filter("kind = 1").select(
        F.col("x").alias("key"),
        F.col("y").alias("node"),
        F.col("first").alias("about"),
        F.col("second").alias("long"),
        F.col("need").alias("head"),
    )
    # Tokens of a node that any other has, under each order: a bound of what it can share.
    two = lists.filter("kind = 0 and anchor = 0").select(F.explode(F.array("x", "y")).alias("node"), "first", "second")
    ones = held.select("node", (1 - F.col("about") % 2).alias("first"), (F.col("about") % 2).alias("second"))
    sharing = two.union(ones).groupBy("node").agg(F.sum("first").alias("left_first"), F.sum("second").alias("left_second"))
    held = held.join(sharing.join(roots, "node", "left").join(bits, "node"), "node")
    held = held.select("key", "node", "about", "long", "head", root, "left_first", "left_second", "bits")
    held = held.withColumn("parts", F.ceil(F.col("long") / BLOCK).cast("int"))
    held = held.withColumn("block", F.pmod(F.xxhash64("node"), "parts").cast("int"))
    held = held.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    held = held.withColumns({"lo": F.least("block", "other"), "hi": F.greatest("block", "other")})
    held = held.withColumn("bucket", F.pmod(F.xxhash64("head", "parts", "lo", "hi"), F.lit(buckets))).drop("other", "long")
    late = held.groupBy("bucket").applyInArrow(_crossing(num, den), _FOUND)
    late = late.select("x", "y", "first", "second", "need")
    late = late.union(met.filter("anchor = 0").select("x", "y", "first", "second", "need"))
    late = late.groupBy("x", "y").agg(*sums)
    late = late.filter("first >= greatest(need, 1) and second >= greatest(need, 1)")
    late = late.join(tried, ["x", "y"], "left_anti").select("x", "y", n.alias("n"))
    late = materialize(_between(late, roots), "join-late")

    ends = late.select(F.col("x").alias("node"), F.col("y").alias("other"), "n")
    ends = ends.union(ends.select(F.col("other").alias("node"), F.col("node").alias("other"), "n"))
    nearest = Window.partitionBy("node").orderBy(F.desc("n"), "other")
    ends = ends.withColumn("rank", F.row_number().over(nearest)).filter(F.col("rank") <= NEAREST)
    near = ends.select(F.least("node", "other").alias("x"), F.greatest("node", "other").alias("y")).distinct()
    tried = _linked(keyed, near, nodes, k, num, den, "join-2")
    roots = _joined(roots, tried)
    rest = _between(late.join(tried, ["x", "y"], "left_anti"), roots)
    roots = _joined(roots, _linked(keyed, rest, nodes, k, num, den, "join-3"))

    firsts = nodes.groupBy("node").agg(F.min("doc_id").alias("first"))
    firsts = firsts.join(roots, "node", "left").select("node", "first", root)
    least = firsts.groupBy("root").agg(F.min("first").alias("component_id"))
    named = firsts.join(least, "root").select("node", "component_id")
    out = rows.join(named, "node", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
