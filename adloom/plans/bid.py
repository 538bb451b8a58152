"""Bid report: bid changes with keyword and portfolio, and an optional masked copy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adloom.operators.canonical import KEYWORD_COLUMNS, canonical_fact
from adloom.operators.dedupe import dedupe
from adloom.operators.enrich import portfolio_dim
from adloom.operators.joins import size_checked
from adloom.operators.masking import MaskSpec, masked_union
from adloom.sinks.tables import write_bucketed


def mask_spec(tenant_column: str = "ACCOUNT NAME") -> MaskSpec:
    return MaskSpec(levels=[("PORTFOLIOS", "portfolio", ())], tenant_column=tenant_column)


# What identifies a bid change, and the report's columns in output order.
CHANGE = ("keyword_id", "bid", "updated_date", "account_name")
REPORT = {
    "campaign_id": "campaign_id",
    "PORTFOLIOS": "portfolio_name",
    "DATE": "updated_date",
    "KEYWORD": "keyword",
    "bid": "bid",
    "keyword_id": "keyword_id",
    "ACCOUNT NAME": "account_name",
}


def keyword_names(sp: DataFrame, sb: DataFrame, sd: DataFrame) -> DataFrame:
    """Distinct keywords with account and campaign."""
    wanted = {"keyword_id", "account_name", "campaign_name", "keyword", "campaignId"}
    names = canonical_fact(sp, sb, sd, KEYWORD_COLUMNS)
    return dedupe(names.select(*[c for c in names.columns if c in wanted]))


def bid_changes(bids: DataFrame) -> DataFrame:
    """Distinct bid changes, dated by day."""
    return dedupe(bids.select(*CHANGE)).withColumn("updated_date", F.col("updated_date").try_cast("date"))


#: Join keys of bid history and keywords, and so the layout of their stored tables.
HISTORY_KEYS = ["account_name", "keyword_id"]


def bucketed_history(
    bids: DataFrame, sp: DataFrame, sb: DataFrame, sd: DataFrame, name: str, path: str, buckets: int
) -> tuple[DataFrame, DataFrame]:
    """Bid changes and keyword names as tables ``<name>_changes`` and ``<name>_names`` that join where they lie.

    Both are bucketed and sorted by account and keyword; a keyword has a row per bid change
    and per name, so a bucket grows with the table and not with a key.
    """
    changes = write_bucketed(bid_changes(bids), f"{name}_changes", f"{path}/changes", HISTORY_KEYS, buckets)
    names = write_bucketed(keyword_names(sp, sb, sd), f"{name}_names", f"{path}/names", HISTORY_KEYS, buckets)
    return changes, names.hint("merge")


def named_changes(changes: DataFrame, names: DataFrame) -> DataFrame:
    """Every bid change with each keyword it belongs to, or none."""
    return changes.join(names, HISTORY_KEYS, "left")


def placed_changes(named: DataFrame, campaigns: DataFrame, portfolios: DataFrame) -> DataFrame:
    """The report's columns, with the portfolio of the keyword's campaign."""
    portfolio_of = portfolio_dim(campaigns, portfolios).select(
        F.col("campaign_id").alias("campaignId"), "campaign_id", "portfolio_name"
    )
    (portfolio_of,) = size_checked(portfolio_of)
    placed = named.join(portfolio_of, "campaignId", "left")
    return placed.select(*[F.col(source).alias(name) for name, source in REPORT.items()])


def bid_report(
    bids: DataFrame,
    sp: DataFrame,
    sb: DataFrame,
    sd: DataFrame,
    campaigns: DataFrame,
    portfolios: DataFrame,
    mask_tenant: str | None = None,
    tenant_column: str = "ACCOUNT NAME",
) -> DataFrame:
    """Every bid change, with each keyword it belongs to; bids without one are kept."""
    report = placed_changes(named_changes(bid_changes(bids), keyword_names(sp, sb, sd)), campaigns, portfolios)
    if mask_tenant is None:
        return report
    return masked_union(report, mask_tenant, mask_spec(tenant_column), factor=1)
