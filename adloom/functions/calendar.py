"""Reporting periods and calendars relative to an explicit ``as_of`` date."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Month abbreviations of Spark's and the report's ``MMM``.
MONTHS = "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split()

# Rolling windows of the keyword report, in days.
ROLLING_DAYS = [7, 14, 30, 60]


@dataclass(frozen=True)
class Period:
    """Dates from ``start`` to ``end``, both included; no ``end`` means open."""

    name: str
    start: date
    end: date | None = None

    def condition(self, day: str = "date") -> str:
        """SQL text that holds for the period's days."""
        after = f"{day} >= date'{self.start}'"
        return after if self.end is None else f"{after} and {day} <= date'{self.end}'"


def day_periods(as_of: date) -> list[Period]:
    """Today and yesterday as single days, then windows open at the top."""
    yesterday = as_of - timedelta(days=1)
    singles = [Period("today", as_of, as_of), Period("yesterday", yesterday, yesterday)]
    return singles + [Period(f"last_{n}_days", as_of - timedelta(days=n)) for n in ROLLING_DAYS]


def _month(as_of: date, back: int) -> date:
    index = as_of.year * 12 + as_of.month - 1 - back
    return date(index // 12, index % 12 + 1, 1)


def month_periods(as_of: date, n: int = 4) -> list[Period]:
    """The month of ``as_of`` and the months before it, newest first.

    Named ``MMM``; of more than twelve months, whose names repeat, ``MMM_yyyy``.
    """
    if n < 1:
        raise ValueError("at least one month is needed")

    def name(first: date) -> str:
        return MONTHS[first.month - 1] + (f"_{first.year}" if n > 12 else "")

    starts = [_month(as_of, back) for back in range(-1, n)]
    return [Period(name(s), s, after - timedelta(days=1)) for after, s in zip(starts, starts[1:])]


def in_any(periods: list[Period], day: str = "date") -> str:
    """SQL text for days that any period holds.

    The enclosing range comes first, as a plain comparison a scan can use.
    """
    enclosing = f"{day} >= date'{min(p.start for p in periods)}'"
    if all(p.end is not None for p in periods):
        enclosing += f" and {day} <= date'{max(p.end for p in periods)}'"
    held = " or ".join(f"({p.condition(day)})" for p in periods)
    return f"{enclosing} and ({held})"


def last_days(spark: SparkSession, as_of: date, n: int = 15) -> DataFrame:
    """(date): ``as_of`` and the days before it, newest first."""
    return spark.range(n).select(F.date_sub(F.lit(as_of), F.col("id").cast("int")).alias("date"))


def last_months(spark: SparkSession, as_of: date, n: int = 3) -> DataFrame:
    """(start_date, end_date): whole months, newest first."""
    start = F.add_months(F.trunc(F.lit(as_of), "month"), -F.col("id").cast("int"))
    return spark.range(n).select(start.alias("start_date"), F.last_day(start).alias("end_date"))


def month_ranges(spark: SparkSession, as_of: date, n: int) -> DataFrame:
    """(start_date, end_date): oldest first, the running month ending the day before ``as_of``."""
    back = (F.lit(n - 1) - F.col("id")).cast("int")
    start = F.add_months(F.trunc(F.lit(as_of), "month"), -back)
    end = F.when(back == 0, F.date_sub(F.lit(as_of), 1)).otherwise(F.last_day(start))
    return spark.range(n).select(start.alias("start_date"), end.alias("end_date"))
