"""Benchmark items inside documents: size-partitioned MinHash containment search.

Items are parted by the size of their shingle set. In each part an item is sketched by the
shingles with its smallest hashes under one MinHash function, and a document is a candidate
once it holds enough of them. How many are kept and how many must be met follows from the
part: a document that contains the item holds at least the threshold's share of its set,
and the sketch is a sample of the set, so the chance that it shows fewer is a hypergeometric
tail, kept below ``MISS`` for every size of the part. Small items are sketched by their
whole set. A long document is probed with every one of its shingles, not by a sketch of its
own, so its length doesn't blunt the search. Candidates are then compared by all shingles.

Everything is DataFrame expressions: shingles are numbers made of five word hashes in the
rows that ``explode`` streams into a hash join; only hits are shuffled.
"""

from __future__ import annotations

from functools import cache
from math import comb

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adloom.operators.joins import size_checked

WORDS = 5
#: Shingles of an item's sketch; items of no more are kept whole.
SKETCH = 32
#: Chance, for an item right at the threshold, that its sketch is met too seldom.
MISS = 1e-9
#: Sizes of a part reach from a power of two to the next; sizes above the last count as it.
LARGEST_PART = 20


@cache
def needed(size: int, num: int, den: int) -> int:
    """Sketch shingles that a document which contains an item of ``size`` shingles holds, but for ``MISS``."""
    held = -(-num * size // den)
    kept = min(size, SKETCH)
    if kept == size:
        return held
    below, most = 0, int(MISS * comb(size, kept))
    for met in range(kept + 1):
        below += comb(held, met) * comb(size - held, kept - met)
        if below > most:
            return max(met, 1)
    return kept


def part_of(size: int) -> int:
    """Number of the part that items of ``size`` shingles are in: its sizes have as many binary digits."""
    return min(size.bit_length(), LARGEST_PART)


def needed_in_parts(num: int, den: int) -> dict[int, int]:
    """Per part of items that are not kept whole, what all its sizes can rely on.

    The least is that of the smallest size or, where rounding matters, of one of the next;
    samples from larger sets tend to the binomial tail, which bounds them all.
    """
    found = {}
    for part in range(part_of(SKETCH + 1), LARGEST_PART + 1):
        first = max(SKETCH + 1, 1 << (part - 1))
        sizes = {first + i for i in range(min(den, first))} | {(1 << part) - 1}
        found[part] = min(*(needed(n, num, den) for n in sizes), _binomial(num, den))
    return found


def _binomial(num: int, den: int) -> int:
    """The same for a set so large that drawing from it doesn't change it."""
    below = 0
    for met in range(SKETCH + 1):
        below += comb(SKETCH, met) * num**met * (den - num) ** (SKETCH - met)
        if below > MISS * den**SKETCH:
            return max(met, 1)
    return SKETCH


def _word_hashes(text: Column) -> Column:
    """Hash of each word: runs of letters and digits, lower-cased."""
    split = F.split(F.lower(F.coalesce(text, F.lit(""))), "[^\\p{L}\\p{N}]+")
    return F.transform(F.filter(split, lambda w: w != ""), lambda w: F.xxhash64(w))


def _shingles(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row ``(*keys, h)`` for each place where ``WORDS`` words begin."""
    words = df.select(*keys, _word_hashes(F.col("text")).alias("w")).filter(F.size("w") >= WORDS)
    places = F.explode(F.sequence(F.lit(0), F.size("w") - WORDS)).alias("i")
    parts = [F.get("w", F.col("i") + j) for j in range(WORDS)]
    return words.select(*keys, "w", places).select(*keys, F.xxhash64(*parts).alias("h"))


def _needed(size: Column, num: int, den: int) -> Column:
    """Sketch shingles to be met: the threshold's share of small sets, and what the part says of others."""
    out = F.ceil(size * num / den).cast("int")
    digits = F.least(F.length(F.bin(size)), F.lit(LARGEST_PART))
    for part, n in needed_in_parts(num, den).items():
        out = F.when((size > SKETCH) & (digits == part), F.lit(n)).otherwise(out)
    return out


def _documents(df: DataFrame, id_col: str, text: str) -> DataFrame:
    docs = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return docs.withColumn("t", _text_key(F.col("text")))


def _text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _hits(docs: DataFrame, benchmark: DataFrame, num: int, den: int) -> DataFrame:
    """``(t, item_id, n_shared, n_item)`` for each text key and item it contains."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
    items = items.filter("item_id is not null")
    own = _shingles(items, ["item_id"]).distinct()
    ordered = F.array_sort(F.collect_list(F.struct(F.xxhash64("h", F.lit(7)).alias("order"), "h")))
    sets = own.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_item"), ordered.getField("h").alias("s"))
    sketch = sets.select(
        "item_id", _needed(F.col("n_item"), num, den).alias("needed"), F.explode(F.slice("s", 1, SKETCH)).alias("h")
    )
    whole = sets.select("item_id", "n_item", F.explode("s").alias("h"))
    sketch, whole = size_checked(sketch, whole)

    met = _shingles(docs, ["t"]).join(sketch, "h").select("t", "item_id", "h", "needed").distinct()
    found = met.groupBy("t", "item_id").agg(F.count(F.lit(1)).alias("n"), F.max("needed").alias("needed"))
    found = found.filter("n >= needed").select("t", "item_id")
    (found,) = size_checked(found)
    near = docs.select("t", "text").join(found.select("t").distinct(), "t", "left_semi")
    shared = _shingles(near, ["t"]).join(whole, "h").join(found, ["t", "item_id"], "left_semi").distinct()
    counted = shared.groupBy("t", "item_id").agg(F.count(F.lit(1)).alias("n_shared"), F.max("n_item").alias("n_item"))
    return counted.filter(den * F.col("n_shared") >= num * F.col("n_item"))


def find_contaminated(
    df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text", num: int = 80, den: int = 100
) -> DataFrame:
    """``doc_id``, ``item_id``, ``n_shared`` and ``n_item`` for each row that contains an item.

    ``benchmark(item_id, text)`` gives the items. Words are lower-cased runs of letters and
    digits, so marks and line breaks don't hide a copy. A row contains an item if its whole
    text has at least ``num / den`` of the item's distinct shingles of five words. Items or texts
    that are null, empty or shorter than five words take no part; items of one id are one
    set, rows without an id are reported with a null id, repeated rows each on their own.
    Other columns are ignored; empty tables give no rows. Shingles are compared by 64 bits.
    """
    docs = _documents(df, id_col, text)
    (hits,) = size_checked(_hits(docs, benchmark, num, den))
    return docs.select("doc_id", "t").join(hits, "t").select("doc_id", "item_id", "n_shared", "n_item")


def drop_contaminated(
    df: DataFrame, benchmark: DataFrame, text: str = "text", num: int = 80, den: int = 100
) -> DataFrame:
    """The rows that contain no benchmark item, with all their columns; see ``find_contaminated``."""
    docs = df.select(F.col(f"`{text}`").alias("text")).withColumn("t", _text_key(F.col("text")))
    (hits,) = size_checked(_hits(docs, benchmark, num, den).select("t").distinct())
    own = F.xxhash64(F.coalesce(df[f"`{text}`"], F.lit("")))
    return df.join(hits, own == hits["t"], "left_anti")
