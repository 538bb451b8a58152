"""Join helpers: broadcasts behind a size check, null-safe joins, hot-null spreading."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adloom.session import materialize

MAX_ROWS = 2_000_000
MAX_BYTES = 64 * 1024 * 1024


# Types whose values all take 16 bytes or less.
_FIXED = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.NullType)


def _payload(df: DataFrame) -> Column:
    """Bytes of one row: text and binary at their real length, nested values by their JSON text."""

    def size(field: T.StructField) -> Column:
        column = df[f"`{field.name}`"]
        if isinstance(field.dataType, _FIXED):
            return F.lit(16)
        if not isinstance(field.dataType, (T.StringType, T.BinaryType)):
            column = F.to_json(F.struct(column))
        return F.coalesce(F.octet_length(column), F.lit(0)) + 16

    return reduce(lambda a, b: a + b, [size(f) for f in df.schema.fields]).cast("bigint")


def stored(
    df: DataFrame, name: str = "dim", max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES
) -> tuple[DataFrame, bool]:
    """The frame, written once to the shared folder, and whether it is within the bound.

    Rows and bytes are observed during the write, so nothing is computed twice.
    """
    seen = Observation()
    counts = F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(_payload(df)), F.lit(0)).alias("b")
    kept = materialize(df.observe(seen, *counts), name)
    size = seen.get
    return kept, size["n"] <= max_rows and size["b"] <= max_bytes


def size_checked(
    *dims: DataFrame, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES
) -> tuple[DataFrame, ...]:
    """Store each dimension and mark it for broadcast if it turned out small enough.

    One above the bound comes back unmarked and is joined by shuffle, where AQE
    splits hot keys.
    """

    def check(dim: DataFrame) -> DataFrame:
        kept, small = stored(dim, "dim", max_rows, max_bytes)
        return F.broadcast(kept) if small else kept

    with ThreadPoolExecutor(max_workers=len(dims)) as pool:
        return tuple(pool.map(check, dims))


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Equi-join in which null keys match null keys; the keys appear once."""
    temp = {k: f"__r_{i}" for i, k in enumerate(keys)}
    renamed = right.withColumnsRenamed(temp)
    on = [F.col(f"`{k}`").eqNullSafe(F.col(t)) for k, t in temp.items()]
    return left.join(renamed, reduce(lambda a, b: a & b, on), how).drop(*temp.values())


def numbered_rows(dim: DataFrame, name: str) -> DataFrame:
    """Rows of a dimension within the broadcast bound, numbered from 0 in the order of all columns."""
    order = Window.orderBy(*[F.col(f"`{c}`").asc_nulls_first() for c in dim.columns])
    return dim.withColumn(name, (F.row_number().over(order) - 1).cast("long"))


#: Numbers that one bitmap of Spark's bitmap functions holds.
_BITMAP = 8 * 4096


class Met:
    """Which of the numbers 0 to ``n - 1`` occur in a column, found while its rows are evaluated.

    ``bitmaps()`` are aggregates to observe with ``seen``; afterwards ``missed()`` tells for a
    row of the dimension whether its number never occurred. A bit per row reaches the
    driver, 250 kB at the bound of a broadcast.
    """

    def __init__(self, n: int, name: str) -> None:
        self.n, self.name, self.seen = n, name, Observation()

    def bitmaps(self) -> list[Column]:
        place = F.bitmap_bit_position(F.col(self.name) + 1)
        bucket = F.floor(F.col(self.name) / _BITMAP)
        count = max(1, -(-self.n // _BITMAP))
        return [F.bitmap_construct_agg(F.when(bucket == b, place)).alias(f"b{b}") for b in range(count)]

    def missed(self) -> Column:
        found = self.seen.get
        held = F.array(*[F.lit(bytes(found[f"b{b}"])) for b in range(len(found))])
        number = F.col(self.name)
        inside = number % _BITMAP
        bitmap = F.get(held, F.floor(number / _BITMAP).cast("int"))
        byte = F.conv(F.hex(F.substring(bitmap, (F.floor(inside / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        return F.getbit(byte, (inside % 8).cast("int")) == 0


SPREAD = 4096


def spread_nulls(key: Column, *others: Column) -> Column:
    """Join key in which nulls are scattered over values no dimension holds.

    A left join sends all null keys to one task although none can match; here they
    go out under ``SPREAD`` different dummy keys chosen by the row's other columns.
    """
    dummy = F.concat(F.lit("\u0000"), F.pmod(F.xxhash64(*others), F.lit(SPREAD)).cast("string"))
    return F.coalesce(key, dummy)
