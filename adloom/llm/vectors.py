"""Vectors as exact integers, and tables that one round of an iteration hands to the next."""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adloom.session import scratch_path


def largest(dims: int) -> int:
    """Bound of a component below which no squared distance of ``dims`` components leaves 64 bits."""
    return min(2**31 - 1, isqrt(2**63 // dims) // 2)


def integer_vectors(df: DataFrame, vec_col: str, scale: int, dims: int, **kept: str) -> DataFrame:
    """Columns ``kept`` (new name = column) and ``x``: ``floor(scale * component)`` as 32-bit integers end to end.

    Rows whose vector is null, has other than ``dims`` components, or a component that is
    null, not finite or, scaled, not below ``largest(dims)`` are left out.
    """
    named = [F.col(f"`{column}`").alias(name) for name, column in kept.items()]
    wide = df.select(*named, F.col(f"`{vec_col}`").cast("array<double>").alias("x"))
    schema = wide.select(*kept, F.lit(b"").alias("x")).schema
    limit = largest(dims)

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(len(kept))
            there = np.asarray(vectors.is_valid()) & (np.asarray(vectors.value_lengths().fill_null(0)) == dims)
            rows = batch.filter(pa.array(there))
            values = rows.column(len(kept)).flatten()
            x = np.floor(values.fill_null(np.nan).to_numpy(zero_copy_only=False) * scale).reshape(-1, dims)
            with np.errstate(invalid="ignore"):
                good = (np.abs(x) < limit).all(axis=1)
            rows = rows.filter(pa.array(good))
            yield pa.RecordBatch.from_arrays([*rows.columns[:-1], packed(x[good])], [*kept, "x"])

    return wide.mapInArrow(convert, schema)


def packed(x: np.ndarray) -> pa.Array:
    """One binary value per row of ``x``."""
    data = np.ascontiguousarray(x, "<i4")
    at = np.arange(len(x) + 1, dtype=np.int32) * (4 * x.shape[1])
    return pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(at), pa.py_buffer(data)])


def unpacked(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of 64-bit integers from :func:`packed`."""
    column = column.cast(pa.binary())
    at = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if len(column) else np.zeros(0, np.uint8)
    return np.frombuffer(raw.tobytes(), "<i4").astype(np.int64).reshape(-1, dims)


def floor_means(sums: np.ndarray, counts: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Componentwise exact floor of sum over count; rows without members stay as before."""
    means = np.floor_divide(sums, np.maximum(counts, 1)[:, None])
    return np.where(counts[:, None] > 0, means, before)


class Relay:
    """The table a round hands to the next: each is written to the shared folder, then its predecessor goes.

    A round reads nothing but the table before it, so a lost executor costs a re-read,
    and no more than two tables are stored at a time.
    """

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark, self.name, self.path = spark, name, ""

    def next(self, df: DataFrame) -> DataFrame:
        path = scratch_path(self.spark, self.name)
        df.write.parquet(path)
        self.drop()
        self.path = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        if self.path:
            old = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
            old.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(old, True)
        self.path = ""
