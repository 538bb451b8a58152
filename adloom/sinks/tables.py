"""Report writers: JDBC or Parquet tables, stamped CSV, staged loads."""

from __future__ import annotations

from dataclasses import replace
from datetime import date, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adloom.schemas import conform, misfits
from adloom.session import file_system, materialize
from adloom.sources.tables import TableSource, present, read_table


def write_table(
    df: DataFrame,
    target: TableSource,
    mode: str = "overwrite",
    schema: T.StructType | None = None,
    sort: list[str] | None = None,
    partition_by: list[str] | None = None,
    allow_misfits: bool = False,
    replace_partitions: bool = False,
) -> None:
    """Write to a JDBC table or a Parquet path.

    ``schema`` casts to the target's declared types; a value that does not fit, or a
    null in a required column, is an error before the target is touched, unless
    ``allow_misfits`` lets it become null. ``sort`` lays Parquet out in that order by
    range partitions; a row hash ends the range key, so that equal sort keys can span
    several. A typed or sorted write stores its rows first: misfits are counted while
    that happens, and ranges are sampled from the stored rows, so ``df`` is evaluated
    once. With ``replace_partitions`` an overwrite replaces only those partitions of
    ``partition_by`` that ``df`` has rows of; the files of the others stay. JDBC
    overwrites keep the table definition.
    """
    if replace_partitions and (target.url or not partition_by or mode != "overwrite"):
        raise ValueError("partitions can be replaced by overwriting a Parquet path that has some")
    if schema is not None:
        df = _typed(df, schema, allow_misfits)
    elif sort and not target.url:
        df = materialize(df, "unsorted")
    if target.url:
        options = target.write_options(mode)
        df.write.format("jdbc").options(**options).mode(mode).save()
        return
    if sort:
        columns = [f"`{c}`" for c in sort]
        spread = F.xxhash64(*[f"`{c}`" for c in df.columns])
        df = df.repartitionByRange(*columns, spread).sortWithinPartitions(*columns)
    elif partition_by:
        # Few files per partition, and a large partition still spread over tasks.
        df = df.hint("rebalance", *[F.col(f"`{c}`") for c in partition_by])
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    # Stated either way, so that a session's own setting can't replace what should stay.
    writer.option("partitionOverwriteMode", "dynamic" if replace_partitions else "static").parquet(target.path)


def _typed(df: DataFrame, schema: T.StructType, allow_misfits: bool) -> DataFrame:
    """Stored rows under the target's types; an error if values do not fit."""
    if allow_misfits:
        return materialize(conform(df, schema), "typed")
    seen = Observation()
    typed = materialize(conform(df.observe(seen, *misfits(df, schema)), schema), "typed")
    wrong = {c: n for c, n in seen.get.items() if n}
    if wrong:
        raise ValueError(f"values that do not fit the target: {wrong}")
    return typed


def stage_load(df: DataFrame, staging_path: str, fmt: str = "parquet") -> str:
    """Write the files a warehouse loads from; returns the staging path."""
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.csv(staging_path, header=True)
    else:
        writer.format(fmt).save(staging_path)
    return staging_path


def write_stamped_csv(df: DataFrame, path: str, name: str, as_of: datetime) -> str:
    """CSV under ``name_dd_mm_YYYY_HH_MM.csv``; returns its path."""
    out = f"{path.rstrip('/')}/{name}_{as_of.strftime('%d_%m_%Y_%H_%M')}.csv"
    df.write.mode("overwrite").csv(out, header=True)
    return out


def is_stale(spark: SparkSession, target: TableSource, as_of: date, date_col: str = "updated_date") -> bool:
    """Whether the newest row of the target is not dated ``as_of``; a missing target is stale."""
    if target.path and not present(spark, [target.path]):
        return True
    newest = read_table(spark, newest_source(target, date_col)) if target.url else read_table(spark, target, [date_col])
    return newest.agg(F.max(date_col).cast("date").alias("d")).first()["d"] != as_of


def newest_source(target: TableSource, date_col: str) -> TableSource:
    """The target's greatest date alone, found by the database."""
    source = target.query and f"({target.query}) t" or target.table
    query = f"select max({date_col}) as {date_col} from {source}"
    split = {"partition_column": None, "lower_bound": None, "upper_bound": None, "num_partitions": None}
    return replace(target, table=None, query=query, **split)


def refresh_days(df: DataFrame, target: TableSource, days: list[date], date_col: str = "updated_date") -> None:
    """Replace the named days of a Parquet target laid out by day; the files of all others stay.

    Only rows of these days are asked of ``df``. A named day without rows goes.
    """
    replace_parts(df.filter(F.col(date_col).isin(days)), target, date_col, days)


def replace_parts(df: DataFrame, target: TableSource, column: str, values: list) -> None:
    """Put the rows of ``df``, all with one of ``values``, in the place of the partitions of these values.

    Rows are counted per value while they are written; the folder of a value without rows is deleted.
    """
    seen = Observation()
    counts = [F.count_if(F.col(column) == F.lit(v)).alias(str(v)) for v in values]
    write_table(df.observe(seen, *counts), target, partition_by=[column], replace_partitions=True)
    for value in (v for v, n in seen.get.items() if not n):
        folder, fs = file_system(df.sparkSession, f"{target.path}/{column}={value}")
        fs.delete(folder, True)


def write_bucketed(df: DataFrame, table: str, path: str, keys: list[str], buckets: int) -> DataFrame:
    """Store rows bucketed and sorted by ``keys`` under ``path`` and return them as a table.

    Two tables with the same keys and number of buckets join on them without an exchange.
    Rows are dealt out by the keys first, so each bucket is one file.
    """
    columns = [f"`{k}`" for k in keys]
    dealt = df.repartition(buckets, *columns)
    dealt.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(table)
    return df.sparkSession.table(table)


def refresh_if_stale(df: DataFrame, target: TableSource, as_of: date, date_col: str = "updated_date") -> bool:
    """Replace a target left from another day, append to one already written today.

    Returns whether the target was replaced.
    """
    stale = is_stale(df.sparkSession, target, as_of, date_col)
    write_table(df, target, "overwrite" if stale else "append")
    return stale


def row_count(df: DataFrame) -> int:
    return df.count()
