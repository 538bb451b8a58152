"""Scans of tables (JDBC or Parquet) and delimited files."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adloom.sources.delimited import read_delimited


#: Connections of a JDBC write that names no number; without one, every task opens its own.
WRITE_CONNECTIONS = 8


@dataclass(frozen=True)
class TableSource:
    """Where a table lives: a Parquet ``path``, or a JDBC ``url`` plus ``table``.

    Credentials belong in ``options`` and come from the caller's configuration.
    ``partition_column`` with its bounds splits a JDBC read over executors.
    """

    path: str | None = None
    url: str | None = None
    table: str | None = None
    query: str | None = None
    driver: str | None = None
    partition_column: str | None = None
    lower_bound: object = None
    upper_bound: object = None
    num_partitions: int | None = None
    fetch_size: int = 10_000
    batch_size: int = 10_000
    options: dict[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if (self.path is None) == (self.url is None):
            raise ValueError("a table source needs either a path or a JDBC url")
        if self.url and not (self.table or self.query):
            raise ValueError("a JDBC source needs a table or a query")
        split = [self.partition_column, self.lower_bound, self.upper_bound, self.num_partitions]
        if any(v is not None for v in split) and any(v is None for v in split):
            raise ValueError("a split JDBC read needs column, both bounds and a partition count")

    def _connection(self) -> dict[str, str]:
        options = {"url": self.url, **self.options}
        if self.driver:
            options["driver"] = self.driver
        return options

    def read_options(self) -> dict[str, str]:
        options = self._connection()
        options["dbtable"] = f"({self.query}) src" if self.query else self.table
        options["fetchsize"] = str(self.fetch_size)
        if self.partition_column:
            options["partitionColumn"] = self.partition_column
            options["lowerBound"] = str(self.lower_bound)
            options["upperBound"] = str(self.upper_bound)
            options["numPartitions"] = str(self.num_partitions)
        return options

    def write_options(self, mode: str) -> dict[str, str]:
        options = self._connection()
        options["dbtable"] = self.table
        options["batchsize"] = str(self.batch_size)
        options["numPartitions"] = str(self.num_partitions or WRITE_CONNECTIONS)
        if mode == "overwrite":
            options["truncate"] = "true"
        return options


def read_table(
    spark: SparkSession,
    source: TableSource,
    columns: list[str] | dict[str, str | Column] | None = None,
    where: Column | str | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Lazy scan. ``where`` and ``columns`` reach the source as pushed filters and pruning.

    ``columns`` may map output names to source names or to expressions, such as a
    typed null for a measure the table does not have.
    """
    if source.url:
        df = spark.read.format("jdbc").options(**source.read_options()).load()
    else:
        reader = spark.read.schema(schema) if schema else spark.read
        df = reader.parquet(source.path)
    if where is not None:
        df = df.filter(where)
    if isinstance(columns, dict):
        return df.select(
            *[(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in columns.items()]
        )
    return df.select(*columns) if columns else df


def read_csv(
    spark: SparkSession, path: str | list[str], schema: T.StructType, sep: str = ",", header: bool = True
) -> DataFrame:
    """Delimited files of one layout under a declared schema; bad values are null."""
    return spark.read.schema(schema).csv(path, sep=sep, header=header, mode="PERMISSIVE")


def gather(
    spark: SparkSession,
    paths: list[str],
    schema: T.StructType,
    columns: list[str] | None = None,
    distinct: bool = True,
    sep: str = ",",
    skip_rows: int = 0,
    with_file: bool = False,
) -> DataFrame:
    """One table out of many files of the same layout, in a single multi-path scan.

    Files that do not exist are skipped, empty ones add nothing. Short lines and bad
    values give nulls; see ``read_delimited`` for the lines that are set aside.
    """
    existing = present(spark, paths)
    wanted = list(columns or schema.fieldNames())
    if not existing:
        return spark.createDataFrame([], schema).select(*wanted)
    df = read_delimited(spark, existing, schema, sep=sep, skip_rows=skip_rows).rows
    df = df.select(*[f"`{c}`" for c in wanted], *["file_path"] * with_file)
    return df.dropDuplicates() if distinct else df


def concat(*frames: DataFrame) -> DataFrame:
    """Union by name; a column a frame lacks is null there."""
    first, *rest = frames
    for other in rest:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def present(spark: SparkSession, paths: list[str]) -> list[str]:
    """Those of the paths that exist; one listing for each folder that holds any, not one per path."""
    folders: dict[str, list[str]] = {}
    for path in paths:
        folders.setdefault(path.rstrip("/").rpartition("/")[0] or "/", []).append(path)
    kept = set()
    for folder, own in folders.items():
        there = _listed(spark, folder)
        kept.update(p for p in own if p.rstrip("/").rpartition("/")[2] in there)
    return [p for p in paths if p in kept]


def _listed(spark: SparkSession, folder: str) -> set[str]:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return {s.getPath().getName() for s in fs.listStatus(jvm_path)} if fs.exists(jvm_path) else set()


def only_account(df: DataFrame, account: str, account_col: str = "account_name") -> DataFrame:
    """Rows of one tenant; the equality is pushed into the scan."""
    return df.filter(F.col(account_col) == F.lit(account))
