"""URL verdicts by a sort-merge range join of hosts with nested rules.

A host's labels are written in reverse, each ended by a zero character, so that a
rule on a host becomes the interval of all keys that begin with the rule's key.
Such intervals nest or are apart. URLs are cut into ranges of about equal size by
key, path and id (a hot host spans several ranges), every rule goes to the ranges
its interval meets, and one sorted sweep per range keeps the active rules on a stack.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: URLs in a range, and sampled keys for each range border; both only balance the work.
RANGE_ROWS = 100_000
SAMPLED = 50

_LAST = "\U0010ffff"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_key(host: Column) -> Column:
    """Reversed labels, each ended by a zero character."""
    return F.concat(F.array_join(F.reverse(F.split(host, "\\.")), "\u0000"), F.lit("\u0000"))


_ROW = "part int, key string, kind int, id long, host string, path string, rule string, verdict string"
_NAMES = [c.split()[0] for c in _ROW.split(", ")]
_OUT = "id long, host string, path string, rule string, verdict string"


def _place(splits: list[tuple], interval: bool):
    """Number of the range of each URL, or of every range that a rule's interval meets."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            col = {c: batch.column(c) for c in batch.schema.names}
            keys = col["key"].to_pylist()
            if interval:
                first = [bisect_right(splits, (k,)) for k in keys]
                last = [bisect_right(splits, (k + _LAST,)) for k in keys]
                rows = [i for i, (a, b) in enumerate(zip(first, last, strict=True)) for _ in range(a, b + 1)]
                parts = [p for a, b in zip(first, last, strict=True) for p in range(a, b + 1)]
                picked = batch.take(pa.array(rows, pa.int64()))
            else:
                ids = (-(1 << 63) if i is None else i for i in col["id"].to_pylist())
                parts = [bisect_right(splits, x) for x in zip(keys, col["path"].to_pylist(), ids, strict=True)]
                picked = batch
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), *picked.columns], names=_NAMES)

    return run


def _sweep(default: str):
    """One pass over sorted rules and URLs; the stack holds the rules whose interval has begun and not ended."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, stack = None, []
        for batch in found:
            out: list[tuple] = []
            columns = (batch.column(i).to_pylist() for i in range(batch.num_columns))
            for now, key, kind, number, host, path, rule, verdict in zip(*columns, strict=True):
                if now != part:
                    part, stack = now, []
                while stack and not key.startswith(stack[-1][0]):
                    stack.pop()
                if kind == 0:
                    if not stack or stack[-1][0] != key:
                        stack.append((key, {}, []))
                    _, rules, sizes = stack[-1]
                    if path not in rules or verdict == "block":
                        rules[path] = (len(rule), len(key), rule, verdict)
                    if len(path) not in sizes:
                        sizes.append(len(path))
                        sizes.sort(reverse=True)
                    continue
                best = None
                for _, rules, sizes in stack:
                    for size in sizes:
                        hit = rules.get(path[:size]) if size <= len(path) else None
                        if hit is not None:
                            best = hit if best is None else max(best, hit)
                            break
                out.append((number, host, path, *(best[2:] if best else (None, default))))
            columns = list(zip(*out, strict=True)) or [()] * 5
            kinds = [pa.int64(), *[pa.string()] * 4]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["id", "host", "path", "rule", "verdict"],
            )

    return run


def judge_urls(
    df: DataFrame, rules: DataFrame, id_col: str = "page_id", url: str = "url", default: str = "allow"
) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule`` and ``verdict`` for every row.

    ``rules(rule, verdict)`` holds strings like ``example.net/en/``: a host, then the path
    that the URL's must start with. A rule fits its host and all subdomains; the longest
    rule wins, of equally long ones that with the longer host, then the greater string.
    A rule given twice blocks if one of its verdicts is ``block``. Where no rule fits, the
    rule is null and the verdict ``default``. Null URLs and those without ``://`` have an
    empty host and path, which no rule fits; rules that are null or name no host are
    passed over. Rows without an id and repeated rows are judged like all others. Other
    columns are ignored, whatever their names; an empty table gives no rows.
    """
    spark = df.sparkSession
    urls = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{url}`").alias("url"))
    urls = urls.select("id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    urls = urls.select("id", F.coalesce("host", F.lit("")).alias("host"), F.coalesce("path", F.lit("")).alias("path"))
    urls = urls.withColumn("key", host_key(F.col("host")))

    split = F.when(F.instr("rule", "/") > 0, F.instr("rule", "/")).otherwise(F.length("rule") + 1)
    rules = rules.select("rule", "verdict").na.drop()
    rules = rules.withColumn("host", F.translate(F.substring("rule", F.lit(1), split - 1), _UPPER, _LOWER))
    rules = rules.withColumn("path", F.substring("rule", split, F.length("rule"))).filter("host != ''")

    n = df.count()
    ranges = -(-n // RANGE_ROWS)
    splits: list[tuple] = []
    if ranges > 1:
        seen = urls.sample(min(1.0, SAMPLED * ranges / n), 7).select("key", "path", "id").collect()
        order = sorted((r["key"], r["path"], -(1 << 63) if r["id"] is None else r["id"]) for r in seen)
        splits = [order[i * len(order) // ranges] for i in range(1, ranges)] if order else []

    none = F.lit(None).cast("string")
    rows = urls.select(
        "key", F.lit(1).alias("kind"), "id", "host", "path", none.alias("rule"), none.alias("verdict")
    ).mapInArrow(_place(splits, False), _ROW)
    starts = rules.select(
        host_key(F.col("host")).alias("key"),
        F.lit(0).alias("kind"),
        F.lit(None).cast("long").alias("id"),
        "host",
        "path",
        "rule",
        "verdict",
    ).mapInArrow(_place(splits, True), _ROW)
    parts = max(len(splits) + 1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    merged = rows.union(starts).repartition(parts, "part").sortWithinPartitions("part", "key", "kind", "path", "id")
    return merged.mapInArrow(_sweep(default), _OUT).withColumnRenamed("id", "page_id")
