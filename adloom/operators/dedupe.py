"""Duplicate removal, latest row per key, latest snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adloom.operators.joins import join_null_safe, size_checked


def _q(names: list[str]) -> list[str]:
    return [f"`{n}`" for n in names]


def dedupe(df: DataFrame, keys: list[str] | None = None, order: list | None = None) -> DataFrame:
    """Distinct rows, or one row per key: the first by ``order``, then by all other columns.

    Spark limits each map task to one candidate per key before the shuffle, so a
    hot key reaches its reducer with at most one row per task.
    """
    if keys is None:
        return df.dropDuplicates()
    rest = [F.col(c).asc_nulls_first() for c in _q([c for c in df.columns if c not in keys])]
    w = Window.partitionBy(*_q(keys)).orderBy(*(order or []), *(rest or [F.lit(0)]))
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")


def latest_per_key(
    df: DataFrame, keys: list[str], order_col: str, ties: bool = False
) -> DataFrame:
    """Newest row per key; with ``ties`` every row that shares the newest value.

    Ties can be any number of rows, so they are not ranked in a window: the newest
    value per key comes from a partial aggregate and is joined back.
    """
    if not ties:
        return dedupe(df, keys, [F.col(order_col).desc()])
    newest = df.groupBy(*_q(keys)).agg(F.max(order_col).alias(order_col))
    (newest,) = size_checked(newest)
    return join_null_safe(df, newest, [*keys, order_col], "inner")


def latest_bids(bids: DataFrame) -> DataFrame:
    """(keyword_id, bid, bid_tym): the newest bid of each keyword."""
    slim = bids.select("keyword_id", "bid", "updated_date")
    return latest_per_key(slim, ["keyword_id"], "updated_date").select(
        "keyword_id", "bid", F.col("updated_date").cast("date").alias("bid_tym")
    )


def latest_snapshot(df: DataFrame, account_col: str, date_col: str) -> DataFrame:
    """Rows dated at their account's newest date, for all accounts at once.

    The newest dates come from a partial aggregate over two columns; an account
    that owns most rows is never gathered into one window.
    """
    newest = df.groupBy(F.col(account_col).alias("__acc")).agg(F.max(date_col).alias("__max"))
    (newest,) = size_checked(newest)
    same = (df[account_col] == F.col("__acc")) & (df[date_col] == F.col("__max"))
    return df.join(newest, same, "inner").drop("__acc", "__max")
