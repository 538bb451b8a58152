"""Text clean-up expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
MAGNITUDE = r"^([+-]?(?:\d+\.?\d*|\.\d+))\s*([a-z]*)$"

# Unit words and what they multiply by.
MAGNITUDES = {
    "": 1,
    "units": 1,
    "k": 1_000,
    "lakh": 100_000,
    "lakhs": 100_000,
    "lkhs": 100_000,
    "m": 1_000_000,
    "cr": 10_000_000,
    "crore": 10_000_000,
    "crores": 10_000_000,
}

# Currency marks removed before a number is read.
CURRENCY_MARKS = ["₹", "Rs.", ","]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_commas(col: Column | str) -> Column:
    return F.replace(_col(col), F.lit(","), F.lit(""))


def _magnitude(col: Column | str) -> Column:
    text = F.lower(F.trim(strip_commas(col)))
    number = F.regexp_extract(text, MAGNITUDE, 1).try_cast("decimal(28,6)")
    unit = F.regexp_extract(text, MAGNITUDE, 2)
    factors = F.create_map(*[F.lit(x) for pair in MAGNITUDES.items() for x in pair])
    return number * F.try_element_at(factors, unit).cast("decimal(8,0)")


def parse_magnitude(col: Column | str) -> Column:
    """``1.2K``, ``3M``, ``5 Lakhs``, ``2 Crores``, ``1,200``, ``7 Units`` as whole numbers.

    The sign is kept, a lone ``-`` is 0 and anything unreadable is null.
    """
    lone_dash = F.trim(_col(col)) == "-"
    return F.when(lone_dash, F.lit(0).cast("bigint")).otherwise(_magnitude(col).try_cast("bigint"))


def parse_lakh_crore(col: Column | str) -> Column:
    """As :func:`parse_magnitude` but fractional, with blank text read as 0."""
    blank = F.trim(_col(col)) == ""
    return F.when(blank, F.lit(0.0)).otherwise(_magnitude(col).cast("double"))


def currency_number(col: Column | str) -> Column:
    """Whole number inside a currency text, null if there is none."""
    text = _col(col)
    for mark in CURRENCY_MARKS:
        text = F.replace(text, F.lit(mark), F.lit(""))
    return F.when(text.rlike(NUMBER), text.try_cast("decimal(38,18)")).try_cast("bigint")


def quote_regex(col: Column | str) -> Column:
    """Literal text as a regex that matches exactly that text."""
    inner = F.replace(_col(col), F.lit("\\E"), F.lit("\\E\\\\E\\Q"))
    return F.concat(F.lit("\\Q"), inner, F.lit("\\E"))


def word_pattern(word: str) -> str:
    """Case-insensitive whole-word regex for a literal word."""
    quoted = word.replace("\\E", "\\E\\\\E\\Q")
    return rf"(?i)\b\Q{quoted}\E\b"


def starred_keyword(col: Column | str) -> Column:
    """Keyword text with ``+`` shown as ``*``."""
    return F.translate(_col(col), "+", "*")
