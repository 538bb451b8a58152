"""Daily and per-period keyword aggregates."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adloom.functions.calendar import Period, in_any
from adloom.functions.ratios import RATIOS, ratio_sql
from adloom.schemas import MEASURES
from adloom.sinks.tables import refresh_days, write_table
from adloom.sources.tables import TableSource, read_table

KEYS = ["account_name", "campaignId", "ad_group_id", "keyword_id"]
PERIOD_RATIOS = ["CPC", "CPA", "ACOS", "CVR", "CTR"]


def daily_keyword(fact: DataFrame, with_match_type: bool = True) -> DataFrame:
    """Sums of the five measures per keyword and day."""
    # What describes a keyword on a day.
    keys = [
        "account_name",
        "campaignId",
        "ad_group_id",
        "ad_group_name",
        "kt_type",
        "keyword_id",
        "keyword",
        *(["new_match_type"] if with_match_type else []),
        "date",
    ]
    return fact.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in MEASURES])


def daily_sums(fact: DataFrame, keys: list[str]) -> DataFrame:
    """Sums of the five measures per key and day, whatever describes the key; the partial sums of all periods."""
    return fact.groupBy(*keys, "date").agg(*[F.sum(m).alias(m) for m in MEASURES])


def refresh_daily(
    fact: DataFrame, store: TableSource, days: list[date] | None = None, keys: list[str] | None = None
) -> DataFrame:
    """The stored daily sums, of which those of ``days``, or all, are made anew; other days of the fact are not read.

    Periods over the store (:func:`period_metrics`) equal those over the fact, since a sum of
    daily sums is the sum of the rows.
    """
    keys = keys or KEYS
    made = daily_sums(fact, keys)
    if days is None:
        write_table(made, store, partition_by=["date"])
    else:
        refresh_days(made, store, days, "date")
    return read_table(fact.sparkSession, store, schema=made.schema)


def period_sums(fact: DataFrame, periods: list[Period], keys: list[str]) -> DataFrame:
    """One conditional sum per period and measure: one scan, one shuffle, partial sums first."""
    sums = [
        F.expr(f"sum(case when {p.condition()} then {m} end) as {m}_{p.name}")
        for p in periods
        for m in MEASURES
    ]
    return fact.filter(in_any(periods)).groupBy(*keys).agg(*sums)


def whole_sums(df: DataFrame, periods: list[Period]) -> DataFrame:
    """Period sums rounded to whole numbers, missing ones 0."""
    sums = [f"{m}_{p.name}" for p in periods for m in MEASURES]
    whole = [
        f"cast(coalesce(round({c}, 0), 0) as "
        + ("decimal(28,0)" if c.startswith(("ad_spend", "ads_sale")) else "bigint")
        + f") as {c}"
        for c in sums
    ]
    others = [f"`{c}`" for c in df.columns if c not in sums]
    return df.selectExpr(*others, *whole)


def add_period_ratios(df: DataFrame, periods: list[Period], digits: int | None = 2) -> DataFrame:
    """Five ratios per period, from the whole-number sums."""
    made = []
    for p in periods:
        for name in PERIOD_RATIOS:
            num, den, factor = RATIOS[name]
            value = ratio_sql(f"{num}_{p.name}", f"{den}_{p.name}", factor, digits)
            made.append(f"{value} as {name}_{p.name}")
    return df.selectExpr("*", *made)


def metric_columns(periods: list[Period]) -> list[str]:
    return [f"{m}_{p.name}" for p in periods for m in [*MEASURES, *PERIOD_RATIOS]]


def period_metrics(
    fact: DataFrame, periods: list[Period], keys: list[str] | None = None, digits: int | None = 2
) -> DataFrame:
    """Ten metrics per period and key; a key appears if any period has a row for it."""
    keys = keys or KEYS
    sums = whole_sums(period_sums(fact, periods, keys), periods)
    return add_period_ratios(sums, periods, digits).select(*keys, *metric_columns(periods))


# Leading and closing columns of the keyword report.
REPORT_HEAD = [
    "account_name",
    "portfolioId",
    "portfolio_name",
    "ads_type",
    "campaignId",
    "campaign_name",
    "ad_group_id",
    "ad_group_name",
    "kt_type",
    "keyword_id",
    "keyword",
    "new_match_type",
    "targeting_type",
    "bid",
    "bid_tym",
    "creative_products",
    "target_acos",
    "priority_index",
]
REPORT_TAIL = ["cumulative_sales", "total_sales_portfolio", "cumulative_percent"]


def keyword_report_columns(periods: list[Period]) -> list[str]:
    return [*REPORT_HEAD, *metric_columns(periods), *REPORT_TAIL]
