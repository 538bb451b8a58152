"""Advertising ratios with zero guards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Ratio name -> (numerator, denominator, factor).
RATIOS = {
    "CPC": ("ad_spend", "clicks", 1),
    "CPA": ("ad_spend", "ads_units", 1),
    "ROI": ("ads_sale", "ad_spend", 1),
    "ACOS": ("ad_spend", "ads_sale", 100),
    "CVR": ("ads_units", "clicks", 100),
    "CTR": ("clicks", "impressions", 100),
}

# Coercing ratio name -> factor.
COERCED_FACTORS = {
    "ACOS": 100,
    "TACOS": 100,
    "CPC": 1,
    "CVR": 100,
    "CTR": 100,
    "ASP": 1,
    "GMV_ATTAINMENT": 100,
    "SPEND_ATTAINMENT": 100,
}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio_sql(num: str, den: str, factor: int = 1, digits: int | None = None) -> str:
    """SQL text of :func:`ratio`; one parsed text is cheaper to build than many Columns."""
    top = f"`{num}` * {factor}" if factor != 1 else f"`{num}`"
    value = f"cast({top} as double) / cast(`{den}` as double)"
    if digits is not None:
        value = f"round({value}, {digits})"
    return f"case when `{den}` != 0 then {value} else 0D end"


def ratio(num: str, den: str, factor: int = 1, digits: int | None = None) -> Column:
    """``num * factor / den``; 0 where the denominator is zero or null.

    A null numerator over a usable denominator stays null. Inputs are exact
    (integers, decimals); the division is done in double.
    """
    return F.expr(ratio_sql(num, den, factor, digits))


def with_ratios(
    df: DataFrame, names: list[str], columns: dict[str, str] | None = None, digits: int | None = None
) -> DataFrame:
    """Add the named ratios; ``columns`` maps canonical measure names to the frame's own."""
    columns = columns or {}
    made = {}
    for name in names:
        num, den, factor = RATIOS[name]
        made[name] = ratio(columns.get(num, num), columns.get(den, den), factor, digits)
    return df.withColumns(made)


def coerced_ratio(num: Column | str, den: Column | str, factor: int = 1) -> Column:
    """Ratio of two columns that may hold text: bad input, x/0 and 0/0 all give 0."""
    quotient = F.try_divide(_col(num).try_cast("double"), _col(den).try_cast("double"))
    value = quotient * factor if factor != 1 else quotient
    finite = value.isNotNull() & ~F.isnan(value) & (F.abs(value) != float("inf"))
    return F.when(finite, value).otherwise(F.lit(0.0))


def coerced(name: str, num: Column | str, den: Column | str) -> Column:
    return coerced_ratio(num, den, COERCED_FACTORS[name])
