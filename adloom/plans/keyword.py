"""Keyword report: rolling and monthly metrics, target ACOS, priority index, bid rules."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adloom.functions.calendar import Period, day_periods, in_any, month_periods
from adloom.functions.text import starred_keyword
from adloom.operators.canonical import canonical_fact, with_match_type
from adloom.operators.cleaning import move_column
from adloom.operators.dedupe import dedupe, latest_bids
from adloom.operators.enrich import (
    account_ads_dim,
    account_targets,
    campaign_targets,
    join_targets,
    keyword_campaigns,
    keyword_metadata,
    with_ads,
    with_bids,
)
from adloom.operators.joins import size_checked
from adloom.operators.pareto import pareto
from adloom.operators.periods import (
    KEYS,
    add_period_ratios,
    keyword_report_columns,
    period_sums,
    whole_sums,
)
from adloom.operators.rules import suggest_bids
from adloom.schemas import MEASURES
from adloom.session import materialize

DESCRIPTION = ["ad_group_name", "kt_type", "keyword", "new_match_type"]


def report_periods(as_of: date, months: int = 4) -> list[Period]:
    return day_periods(as_of) + month_periods(as_of, months)


# Stands for a null key, so that sums and descriptions can meet by plain equality.
_NO_KEY = "\u0000"


def keyword_sums(fact: DataFrame, periods: list[Period]) -> DataFrame:
    """Period sums per keyword with one description each: the first, in order, of the periods' rows.

    The wide sums are exchanged once, by a hash aggregate on the keys alone. Descriptions
    are a narrow aggregate by the same keys, so the two meet where they are; the narrow
    side is hashed and the wide rows are not sorted.
    """
    held = fact.withColumns({k: F.coalesce(k, F.lit(_NO_KEY)) for k in KEYS})
    sums = period_sums(held, periods, KEYS)
    first = F.min(F.struct(*DESCRIPTION)).alias("__first")
    described = held.filter(in_any(periods)).groupBy(*KEYS).agg(first).hint("shuffle_hash")
    names = [f"{m}_{p.name}" for p in periods for m in MEASURES]
    keys = [f"nullif({k}, '\\u0000') as {k}" for k in KEYS]
    return sums.join(described, KEYS).selectExpr(*keys, "__first.*", *names)


def keyword_base(
    fact: DataFrame,
    campaigns: DataFrame,
    portfolios: DataFrame,
    targets: DataFrame,
    ads: DataFrame,
    bids: DataFrame,
    per_campaign: DataFrame,
    per_account: DataFrame,
    periods: list[Period],
) -> DataFrame:
    """Keyword rows with period sums, dimensions and target ACOS, before ratios and ranking.

    Dimensions are joined after the aggregation: each has one row per key, so the
    result is the same and the joins see keywords instead of daily rows. The fact's rows of the
    periods are stored once, since sums and descriptions both read them.
    """
    ads_by_campaign, latest, dim, campaign_target, account_target = size_checked(
        account_ads_dim(ads),
        latest_bids(bids),
        keyword_campaigns(campaigns, portfolios, targets),
        campaign_targets(per_campaign),
        account_targets(per_account),
    )
    held = with_match_type(fact).filter(in_any(periods)).select(*KEYS, *DESCRIPTION, "date", *MEASURES)
    sums = whole_sums(keyword_sums(materialize(held, "facts"), periods), periods)
    rows = keyword_metadata(with_bids(with_ads(sums, ads_by_campaign), latest), dim)
    return join_targets(rows, campaign_target, account_target)


def keyword_report(
    sp: DataFrame,
    sb: DataFrame,
    sd: DataFrame,
    campaigns: DataFrame,
    portfolios: DataFrame,
    targets: DataFrame,
    ads: DataFrame,
    bids: DataFrame,
    per_campaign: DataFrame,
    per_account: DataFrame,
    as_of: date,
    months: int = 4,
    digits: int | None = 2,
    pareto_keys: list[str] | None = None,
) -> DataFrame:
    """The keyword report. Its base is stored once, since ranking reads it three times."""
    periods = report_periods(as_of, months)
    base = keyword_base(
        canonical_fact(sp, sb, sd),
        campaigns,
        portfolios,
        targets,
        ads,
        bids,
        per_campaign,
        per_account,
        periods,
    )
    ranked = pareto(materialize(base, "keywords"), partition=pareto_keys)
    return add_period_ratios(ranked, periods, digits).select(*keyword_report_columns(periods))


def bid_sheet(
    report: DataFrame,
    rules: DataFrame,
    account: str | None = None,
    ratio_digits: int | None = 2,
    bid_digits: int | None = 1,
    shown_digits: int | None = 1,
    sort: bool = True,
) -> DataFrame:
    """Keyword report with suggested bids beside the keyword, biggest spenders first."""
    sheet = suggest_bids(report, rules, account, ratio_digits, bid_digits, shown_digits)
    sheet = sheet.withColumn("keyword", starred_keyword("keyword"))
    sheet = move_column(move_column(sheet, "suggested_bid", 14), "Acos_ratio", 15)
    if not sort:
        return sheet
    return sheet.orderBy(F.col("ad_spend_last_14_days").desc(), *KEYS)


def enabled_keywords(fact: DataFrame, ads: DataFrame, state: str | None = "ENABLED") -> DataFrame:
    """Distinct keywords of campaigns whose ad has the given status."""
    (dim,) = size_checked(account_ads_dim(ads))
    return dedupe(with_ads(fact, dim, state))
