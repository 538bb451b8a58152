"""Campaign report: classified search-term rows with ratios and an optional masked copy."""

from __future__ import annotations

from pyspark.sql import DataFrame

from adloom.functions.labels import match_label
from adloom.functions.ratios import with_ratios
from adloom.operators.canonical import canonical_fact, with_match_type
from adloom.operators.cleaning import fill_nulls, report_headers
from adloom.operators.dedupe import latest_bids
from adloom.operators.enrich import campaign_dim, with_bids
from adloom.operators.joins import size_checked
from adloom.operators.masking import MaskSpec, masked_union
from adloom.operators.strategy import (
    account_brands,
    campaign_strategy,
    classify_strategy,
    name_index,
    own_asins,
)

# Report headers.
HEADERS = {
    "campaignId": "campaign_id",
    "account_name": "ACCOUNT NAME",
    "campaign_name": "CAMPAIGNS",
    "ad_group_name": "AD GRP",
    "keyword": "KEYWORD",
    "search_term": "SEARCH TERM",
    "date": "DATE",
    "impressions": "IMPRSN",
    "clicks": "CLICKS",
    "ad_spend": "SPEND",
    "ads_sale": "SALES",
    "ads_units": "UNITS",
    "strategy": "STRATEGY",
    "bid_tym": "BID TYM",
    "portfolio_name": "PORTFOLIOS",
    "targeting_type": "TARGETING TYP",
    "ads_type": "ADS TYP",
}
# Report columns in which null reads 0; ACOS is left alone.
ZERO_FILLED = ["CPC", "SPEND", "SALES", "UNITS", "CLICKS", "ROI", "CVR", "IMPRSN", "bid"]
RATIO_NAMES = ["CPC", "ROI", "ACOS", "CVR"]
REPORT_MEASURES = ["IMPRSN", "CLICKS", "SPEND", "SALES", "UNITS"]
MEASURE_HEADERS = {
    "impressions": "IMPRSN",
    "clicks": "CLICKS",
    "ad_spend": "SPEND",
    "ads_sale": "SALES",
    "ads_units": "UNITS",
}
LEVELS = [
    ("PORTFOLIOS", "portfolio", ()),
    ("CAMPAIGNS", "campaign", ("PORTFOLIOS",)),
    ("AD GRP", "adgroup", ("PORTFOLIOS", "CAMPAIGNS")),
    ("KEYWORD", "keyword", ("PORTFOLIOS", "CAMPAIGNS", "AD GRP")),
]


def mask_spec(digits: int | None = 0) -> MaskSpec:
    return MaskSpec(
        levels=LEVELS,
        measures=REPORT_MEASURES,
        recompute=lambda df: with_ratios(df, RATIO_NAMES, MEASURE_HEADERS, digits),
    )


def campaign_report(
    sp: DataFrame,
    sb: DataFrame,
    sd: DataFrame,
    campaigns: DataFrame,
    portfolios: DataFrame,
    targets: DataFrame,
    ads: DataFrame,
    competitors: DataFrame,
    bids: DataFrame,
    aliases: dict[str, str] | None = None,
    digits: int | None = 0,
    mask_tenant: str | None = None,
    factor: int = 5,
) -> DataFrame:
    """One row per search-term row; a narrow pass over the fact when all dimensions fit."""
    asins, names, sizes, latest, dim = size_checked(
        own_asins(competitors),
        *name_index(account_brands(competitors, aliases)),
        latest_bids(bids),
        campaign_dim(campaigns, portfolios, targets, ads),
    )
    fact = with_match_type(canonical_fact(sp, sb, sd).drop("kt_type"))
    rows = classify_strategy(fact, asins, (names, sizes))
    rows = with_bids(rows, latest).join(dim, "campaignId", "left")
    rows = with_ratios(rows, RATIO_NAMES, digits=digits)
    rows = rows.withColumn("MATCH TYP", match_label("new_match_type")).drop("match_type")
    report = fill_nulls(report_headers(rows, HEADERS), {c: 0 for c in ZERO_FILLED})
    if mask_tenant is None:
        return report
    return masked_union(report, mask_tenant, mask_spec(digits), factor)


def campaign_strategy_report(
    sp: DataFrame,
    sb: DataFrame,
    sd: DataFrame,
    campaigns: DataFrame,
    portfolios: DataFrame,
    targets: DataFrame,
    ads: DataFrame,
    competitors: DataFrame,
    bids: DataFrame,
    aliases: dict[str, str] | None = None,
) -> DataFrame:
    """Search-term rows with their own and their campaign's strategy, without ratios.

    The campaign strategies come from a first pass over the few columns that decide
    them; their size is checked like any other dimension's.
    """
    asins, names, sizes, latest = size_checked(
        own_asins(competitors), *name_index(account_brands(competitors, aliases)), latest_bids(bids)
    )
    fact = with_match_type(canonical_fact(sp, sb, sd).drop("kt_type"))
    rows = classify_strategy(fact, asins, (names, sizes))
    (dim,) = size_checked(campaign_dim(campaigns, portfolios, targets, ads, campaign_strategy(rows)))
    return with_bids(rows, latest).join(dim, "campaignId", "left")
