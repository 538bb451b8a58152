"""Whole-frame clean-up: currency columns, date columns, ids in URLs, headers, fills."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adloom.functions.text import currency_number

# Date layouts tried on a text column, in order.
DATE_LAYOUTS = ["yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss", "yyyy/MM/dd", "MM/dd/yyyy", "dd-MMM-yyyy", "yyyyMMdd"]


def _text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def clean_currency(df: DataFrame) -> DataFrame:
    """Text columns that hold nothing but amounts become whole numbers.

    One aggregate over all text columns decides; a single unreadable or missing
    value leaves its column as it was.
    """
    names = _text_columns(df)
    if not names:
        return df
    checks = [F.bool_and(currency_number(f"`{c}`").isNotNull()) for c in names]
    verdict = df.agg(*[check.alias(f"c{i}") for i, check in enumerate(checks)]).first()
    clean = [c for i, c in enumerate(names) if verdict[i]]
    return df.withColumns({c: currency_number(f"`{c}`") for c in clean})


def normalize_date_columns(df: DataFrame, layouts: list[str] | None = None) -> DataFrame:
    """Columns with ``date`` in their name as ``yyyy-MM-dd`` text.

    A text column is rewritten if one layout reads all its values; otherwise it
    stays as it is. Date and timestamp columns are always formatted.
    """
    layouts = layouts or DATE_LAYOUTS
    dated = [f for f in df.schema.fields if "date" in f.name.lower()]
    typed = [f.name for f in dated if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))]
    text = [f.name for f in dated if isinstance(f.dataType, T.StringType)]
    made = {c: F.date_format(F.col(f"`{c}`"), "yyyy-MM-dd") for c in typed}
    if text:
        readable = [
            F.bool_and(F.col(f"`{c}`").isNull() | F.try_to_timestamp(F.col(f"`{c}`"), F.lit(layout)).isNotNull())
            for c in text
            for layout in layouts
        ]
        verdict = df.agg(*[check.alias(f"c{i}") for i, check in enumerate(readable)]).first()
        for i, c in enumerate(text):
            hits = verdict[i * len(layouts) : (i + 1) * len(layouts)]
            layout = next((name for name, hit in zip(layouts, hits) if hit), None)
            if layout:
                parsed = F.try_to_timestamp(F.col(f"`{c}`"), F.lit(layout))
                made[c] = F.date_format(parsed, "yyyy-MM-dd")
    return df.withColumns(made) if made else df


def extract_ids(df: DataFrame, col: str, pattern: str) -> DataFrame:
    """One row per match of the pattern's first group in ``col``; column ``id``."""
    hits = F.regexp_extract_all(F.col(col), F.lit(pattern), F.lit(1))
    return df.withColumn("id", F.explode(hits))


def path_piece(col: str, index: int):
    """Piece of a slash-separated text, counted from 0; null beyond the end."""
    return F.get(F.split(F.col(col), "/"), F.lit(index))


def title_headers(df: DataFrame) -> DataFrame:
    """``ad_spend`` -> ``Ad Spend`` for every column name."""
    return df.toDF(*[" ".join(w.capitalize() for w in c.split("_")) for c in df.columns])


def report_headers(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(mapping)


def truncate_measures(df: DataFrame, columns: list[str]) -> DataFrame:
    """Measures as whole numbers, cut towards zero; 64 bits, as sums of a big tenant need them."""
    return df.withColumns({c: F.col(f"`{c}`").try_cast("bigint") for c in columns})


def fill_nulls(df: DataFrame, spec: dict[str, object] | None = None) -> DataFrame:
    """Fill by column, or every numeric column with 0."""
    return df.fillna(0 if spec is None else spec)


def move_column(df: DataFrame, name: str, position: int) -> DataFrame:
    names = [c for c in df.columns if c != name]
    names.insert(position, name)
    return df.select(*[f"`{c}`" for c in names])
