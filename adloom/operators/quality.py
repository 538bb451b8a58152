"""File header checks, audit rows and unfinished-load checks."""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adloom.operators.enrich import ambiguous_targets
from adloom.operators.joins import size_checked
from adloom.schemas import DATE, STRING, struct
from adloom.sinks.tables import replace_parts
from adloom.sources.delimited import Delimited, Source, file_headers, open_lines, read_by_header
from adloom.sources.tables import TableSource

AUDIT_SCHEMA = struct(
    {"account_name": STRING, "table_name": STRING, "updated_date": DATE, "error": STRING}
)


def check_columns(
    spark: SparkSession, source: Source, mandatory: list[str], sep: str = ",", skip_rows: int = 0
) -> DataFrame:
    """(path, status, missing, extra) per file, also of folders; valid if no mandatory column is missing.

    A file that names a column twice is rejected, with the names in ``missing`` if any.
    """
    return check_headers(file_headers(spark, source, sep, skip_rows), mandatory)


def check_headers(headers: DataFrame, mandatory: list[str]) -> DataFrame:
    """As :func:`check_columns`, of headers that are known already."""
    needed = F.array(*map(F.lit, mandatory))
    checked = headers.select(
        F.col("file_path").alias("path"),
        F.array_except(needed, "header").alias("missing"),
        F.array_except("header", needed).alias("extra"),
        (F.size(F.array_distinct("header")) == F.size("header")).alias("once"),
    )
    valid = (F.size("missing") == 0) & F.col("once")
    return checked.select("path", F.when(valid, "valid").otherwise("rejected").alias("status"), "missing", "extra")


def read_valid_files(
    spark: SparkSession, source: Source, schema: T.StructType, sep: str = ",", skip_rows: int = 0
) -> Delimited:
    """Rows and rejected lines of the valid files, each read by its own header.

    The files are scanned once; their headers are stored and shared by check and read.
    """
    lines = open_lines(spark, source)
    (names,) = size_checked(file_headers(spark, lines, sep, skip_rows))
    checked = check_headers(names, schema.fieldNames())
    valid = checked.filter("status = 'valid'").select(F.col("path").alias("file_path"))
    return read_by_header(spark, lines, names.join(valid, "file_path", "left_semi"), schema, sep, skip_rows)


def read_valid(spark: SparkSession, source: Source, schema: T.StructType) -> DataFrame:
    """Rows of the valid files; columns beyond ``schema`` go to ``additional_columns``."""
    return read_valid_files(spark, source, schema).rows.drop("file_path")


def audit(df: DataFrame, table: str, as_of: date, accounts: DataFrame) -> DataFrame:
    """One row per expected account that has no rows in ``df``."""
    present = df.select("account_name").distinct()
    return (
        accounts.select("account_name")
        .distinct()
        .join(present, "account_name", "left_anti")
        .select(
            "account_name",
            F.lit(table).alias("table_name"),
            F.lit(as_of).alias("updated_date"),
            F.lit(None).cast("string").alias("error"),
        )
    )


def audit_error(spark: SparkSession, table: str, error: Exception | str, as_of: date) -> DataFrame:
    """Audit row of a failed load."""
    return spark.createDataFrame([(None, table, as_of, str(error))], AUDIT_SCHEMA)


def append_audit(rows: DataFrame, target: TableSource, run: str) -> None:
    """Add the audit rows of a run to the Parquet table; a run that is repeated replaces its own rows only."""
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", run):
        raise ValueError("a run is named by letters, digits, dots, dashes and underscores")
    replace_parts(rows.withColumn("run", F.lit(run)), target, "run", [run])


def audit_targets(per_campaign: DataFrame, as_of: date) -> DataFrame:
    """One row per campaign with more than one target ACOS, of which the lowest is used."""
    error = F.concat(F.lit("several targets: "), F.col("campaign_name"))
    return ambiguous_targets(per_campaign).select(
        F.lit(None).cast("string").alias("account_name"),
        F.lit("target_info").alias("table_name"),
        F.lit(as_of).alias("updated_date"),
        error.alias("error"),
    )


def unfinished_files(files: DataFrame, staging: DataFrame) -> DataFrame:
    """Listed files that the last run left with status ``I``."""
    return files.join(staging.filter(F.col("status") == "I"), "file_name", "left_semi")


def last_run_failed(files: DataFrame, staging: DataFrame) -> bool:
    return not unfinished_files(files, staging).isEmpty()
