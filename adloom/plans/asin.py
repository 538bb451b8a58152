"""ASIN report: advertised-product rows with portfolio, and an optional masked copy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adloom.operators.canonical import ADVERTISED_MEASURES, advertised_products
from adloom.operators.cleaning import fill_nulls, truncate_measures
from adloom.operators.enrich import portfolio_dim
from adloom.operators.joins import Met, numbered_rows, stored
from adloom.operators.masking import MaskSpec, masked_union
from adloom.session import materialize

# Report headers in output order.
HEADERS = {
    "account_name": "ACCOUNT NAME",
    "asin": "ASINS",
    "portfolio_name": "PORTFOLIOS",
    "campaign_name": "CAMPAIGNS",
    "ad_group_name": "AD GRP",
    "date": "DATE",
    "impressions": "IMPRSN",
    "clicks": "CLICKS",
    "ads_spend": "SPEND",
    "ads_sales": "SALES",
    "units": "UNITS",
}
MASK = MaskSpec(
    levels=[
        ("ASINS", "asin", ()),
        ("PORTFOLIOS", "portfolio", ()),
        ("CAMPAIGNS", "campaign", ("PORTFOLIOS",)),
        ("AD GRP", "adgroup", ("PORTFOLIOS", "CAMPAIGNS")),
    ],
    measures=["IMPRSN", "CLICKS", "SPEND", "SALES", "UNITS"],
    cast="double",
)


def with_portfolios(products: DataFrame, campaigns: DataFrame, small: bool) -> DataFrame:
    """Full outer join on the campaign; ``campaigns`` has one stored row per campaign, ``small`` if within the bound.

    A full outer join can neither broadcast its small side nor split a hot campaign. Here
    small campaigns are numbered and broadcast, and while the joined rows are stored a
    bitmap collects the numbers met; the campaigns of the others are added, so products
    are read once. Beyond the bound a second, narrow pass over the products finds them.
    """
    if not small:
        used = products.select("campaign_id").distinct()
        unused = campaigns.join(used, "campaign_id", "left_anti")
        return products.join(campaigns, "campaign_id", "left").unionByName(unused, allowMissingColumns=True)
    numbered = materialize(numbered_rows(campaigns, "__no"), "campaigns")
    joined = products.join(F.broadcast(numbered), "campaign_id", "left")  # within size_checked's bound
    met = Met(campaigns.count(), "__no")
    rows = materialize(joined.observe(met.seen, *met.bitmaps()).drop("__no"), "products")
    unused = numbered.filter(met.missed()).drop("__no")
    return rows.unionByName(unused, allowMissingColumns=True)


def asin_report(
    sp: DataFrame,
    sb: DataFrame,
    sd: DataFrame,
    campaigns: DataFrame,
    portfolios: DataFrame,
    mask_tenant: str | None = None,
    factor: int = 5,
) -> DataFrame:
    portfolio_of = portfolio_dim(campaigns, portfolios).select("campaign_id", "portfolio_name")
    rows = with_portfolios(advertised_products(sp, sb, sd), *stored(portfolio_of))
    rows = truncate_measures(fill_nulls(rows, {m: 0 for m in ADVERTISED_MEASURES}), ADVERTISED_MEASURES)
    report = rows.select(*[F.col(c).alias(header) for c, header in HEADERS.items()])
    return report if mask_tenant is None else masked_union(report, mask_tenant, MASK, factor)
