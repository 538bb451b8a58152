"""Identifier and date normalisation at the input edge."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def normalize_id(col: Column | str, dtype: T.DataType) -> Column:
    """Id as text without a fractional tail: ``123``, ``123.0`` and ``"123.0"`` agree.

    Numbers go through a decimal, so a large double never prints as ``1.2E14``.
    """
    c = F.col(col) if isinstance(col, str) else col
    if isinstance(dtype, T.IntegralType):
        return c.cast("string")
    if isinstance(dtype, (T.FractionalType, T.DecimalType)):
        return F.floor(c.try_cast("decimal(38,4)")).cast("string")
    return F.substring_index(c, ".", 1)


def id_of(df, name: str) -> Column:
    return normalize_id(df[name], df.schema[name].dataType)


def to_day(col: Column | str) -> Column:
    """Date of a text, timestamp or date column; unreadable text becomes null."""
    c = F.col(col) if isinstance(col, str) else col
    return c.try_cast("date")
