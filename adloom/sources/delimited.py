"""Delimited files as lines: preamble, header and field count per file, with one scan of the files.

The scan stores every line with its file, its place and whether it stands in the file's first
block; everything else reads that table, so a file that changes meanwhile, or that is packed
into other tasks, can't shift a line. Lines of a first block are numbered from the file's
smallest place there; later blocks hold no preamble, so nothing has to be counted across
blocks, and the table's statistics let the search for headers skip them. Fields are parted
by Spark's own CSV parser and then cast, so a bad value or a short line costs fields, not the
row; only lines with too many fields are set aside. A quoted field may not span lines.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adloom.operators.joins import size_checked
from adloom.session import materialize

TOO_MANY = "too many fields"


@dataclass(frozen=True)
class Lines:
    """Stored lines of files and the stored list of the files that hold any.

    ``lines`` has ``file_path``, ``head`` (in the first block), ``id`` and ``line``;
    ``files`` has ``file_path``, ``size`` in bytes and ``first``, the place of the first line.
    """

    lines: DataFrame
    files: DataFrame

    def numbered(self) -> DataFrame:
        """(file_path, line_no, line); ``line_no`` is null beyond a file's first block."""
        number = F.when(F.col("head"), F.col("id") - F.col("first")).alias("line_no")
        return self.lines.join(self.files, "file_path").select("file_path", number, "line")

    def first_block(self) -> DataFrame:
        """As :meth:`numbered`, of first blocks only; the others are not read."""
        number = (F.col("id") - F.col("first")).alias("line_no")
        return self.lines.filter("head").join(self.files, "file_path").select("file_path", number, "line")


Source = str | list[str] | Lines


@dataclass(frozen=True)
class Delimited:
    """Rows under the declared schema with ``file_path``, and the lines set aside.

    ``rejects`` has ``file_path``, ``line`` and ``reason``; ``reject_counts`` sums them up.
    """

    parsed: DataFrame
    wrong: Column
    shown: list[Column]

    @property
    def rows(self) -> DataFrame:
        return self.parsed.filter(~self.wrong).select(*self.shown, "file_path")

    @property
    def rejects(self) -> DataFrame:
        return self.parsed.filter(self.wrong).select("file_path", "line", F.lit(TOO_MANY).alias("reason"))

    def reject_counts(self) -> DataFrame:
        return self.rejects.groupBy("file_path", "reason").agg(F.count(F.lit(1)).alias("lines"))

    def counting_rows(self, seen: Observation) -> DataFrame:
        """The rows; once they are evaluated, ``seen`` has the number of ``rejects``."""
        counted = self.parsed.observe(seen, F.count_if(self.wrong).alias("rejects"))
        return counted.filter(~self.wrong).select(*self.shown, "file_path")


def plain_path(path: str) -> Column:
    """A file's name as it was given; Spark reports it with blanks and the like escaped."""
    escaped = F.replace(path, F.lit("+"), F.lit("%2B"))
    return F.coalesce(F.try_url_decode(escaped), F.col(path))


def described(text: DataFrame) -> DataFrame:
    """(file_path, size, head, line) of a text scan or stream."""
    return text.select(
        plain_path("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_size").alias("size"),
        (F.col("_metadata.file_block_start") == 0).alias("head"),
        F.col("value").alias("line"),
    )


def store_lines(found: DataFrame) -> Lines:
    """The lines of :func:`described`, evaluated once and stored; the list of their files from the first blocks."""
    lines = materialize(found.withColumn("id", F.monotonically_increasing_id()), "lines")
    files = lines.filter("head").groupBy("file_path").agg(F.max("size").alias("size"), F.min("id").alias("first"))
    (files,) = size_checked(files)
    return Lines(lines.drop("size"), files)


def open_lines(spark: SparkSession, source: Source) -> Lines:
    """Files or folders, scanned once; lines that are stored already stay as they are."""
    return source if isinstance(source, Lines) else store_lines(described(spark.read.text(source)))


def fields(line: Column, width: int, sep: str) -> Column:
    """Struct of ``width`` text fields ``f0``.. and ``more``, which is not null if there are further ones."""
    names = [*(f"f{i}" for i in range(width)), "more"]
    schema = ", ".join(f"{n} string" for n in names)
    return F.from_csv(line, F.lit(schema), {"sep": sep, "nullValue": "\u0000", "emptyValue": ""})


def read_delimited(
    spark: SparkSession,
    source: Source,
    schema: T.StructType,
    sep: str = ",",
    skip_rows: int = 0,
    header: bool = True,
) -> Delimited:
    """Files of one layout: ``skip_rows`` preamble lines each, then a header if there is one.

    Missing fields, blank fields and values that don't fit their type are null; blank
    lines are passed over, and a blank field past the last is none.
    """
    lines = open_lines(spark, source).numbered().filter("trim(line) != ''")
    data = lines.filter(F.col("line_no").isNull() | (F.col("line_no") >= skip_rows + header))
    parsed = data.withColumn("f", fields(F.col("line"), len(schema), sep))
    typed = [_typed(F.col(f"f.f{i}"), f) for i, f in enumerate(schema.fields)]
    return Delimited(parsed, F.col("f.more").isNotNull(), typed)


def _typed(text: Column, field: T.StructField) -> Column:
    return F.nullif(text, F.lit("")).try_cast(field.dataType).alias(field.name)


def file_headers(spark: SparkSession, source: Source, sep: str = ",", skip_rows: int = 0) -> DataFrame:
    """(file_path, header): the column names each file begins with; only first blocks are read."""
    first = open_lines(spark, source).first_block().filter(F.col("line_no") == skip_rows)
    names = F.transform(F.split(F.col("line"), _literal(sep)), lambda n: F.trim(F.regexp_replace(n, '^\\s*"|"\\s*$', "")))
    return first.select("file_path", names.alias("header"))


def _literal(sep: str) -> str:
    return "\\Q" + sep + "\\E"


def read_by_header(
    spark: SparkSession, source: Source, headers: DataFrame, schema: T.StructType, sep: str = ",", skip_rows: int = 0
) -> Delimited:
    """Rows of files of any layouts by the names in their own header, with ``additional_columns``.

    ``headers(file_path, header)`` names the files to read. Columns beyond ``schema`` show up as
    ``name=value``, several joined by commas.
    """
    (headers,) = size_checked(headers)
    width = headers.agg(F.max(F.size("header")).alias("w")).first()["w"] or 0
    lines = open_lines(spark, source).numbered().filter("trim(line) != ''").join(headers, "file_path")
    data = lines.filter(F.col("line_no").isNull() | (F.col("line_no") > skip_rows))
    parsed = data.withColumn("f", fields(F.col("line"), width, sep))
    values = F.array(*[F.col(f"f.f{i}") for i in range(width)]) if width else F.array().cast("array<string>")
    n = F.size("header")
    # Fields under no name: those beyond the file's own header.
    beyond = F.exists(F.slice(values, n + 1, F.lit(max(width, 1))), lambda v: v.isNotNull()) | F.col("f.more").isNotNull()
    parsed = parsed.withColumns({"beyond": beyond, "v": F.slice(values, 1, n)})

    def named(name: str) -> Column:
        return F.try_element_at("v", F.array_position("header", name).cast("int"))

    typed = [_typed(named(f.name), f) for f in schema.fields]
    pairs = F.filter(F.arrays_zip("header", "v"), lambda p: ~p["header"].isin(schema.fieldNames()))
    shown = F.transform(pairs, lambda p: F.concat(p["header"], F.lit("="), F.coalesce(p["v"], F.lit(""))))
    extra = F.when(F.size(shown) > 0, F.array_join(shown, ",")).alias("additional_columns")
    return Delimited(parsed, F.col("beyond"), [*typed, extra])
