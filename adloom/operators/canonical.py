"""Source tables of the three ad products brought to one fact layout."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adloom.functions.ids import id_of, to_day
from adloom.functions.labels import match_type
from adloom.schemas import MEASURES, MONEY

NAMES = ["account_name", "campaignId", "campaign_name", "ad_group_id", "ad_group_name"]
IDS = {"campaignId", "ad_group_id", "keyword_id"}

# Canonical column -> source column, or a constant, per ad product.
COMMON = {
    "account_name": "account_name",
    "campaignId": "campaignId",
    "campaign_name": "campaignName",
    "ad_group_id": "adGroupId",
    "ad_group_name": "adGroupName",
    "date": "date",
    "impressions": "impressions",
    "clicks": "clicks",
    "ad_spend": "cost",
}
PRODUCTS: dict[str, dict[str, str | Column]] = {
    "sp": {
        "keyword_id": "keywordId",
        "keyword": "targeting",
        "search_term": "searchTerm",
        "ads_sale": "sales30d",
        "ads_units": "unitsSoldSameSku1d",
        "match_type": "matchType",
    },
    "sb": {
        "keyword_id": "keywordId",
        "keyword": "keywordText",
        "search_term": "searchTerm",
        "ads_sale": "sales",
        "ads_units": "unitsSold",
        "match_type": "matchType",
    },
    "sd": {
        "keyword_id": "targetingId",
        "keyword": "targetingText",
        "ads_sale": "sales",
        "ads_units": "unitsSold",
    },
}
# Constants per ad product.
CONSTANTS = {
    "sp": {"kt_type": "targeting_id"},
    "sb": {"kt_type": "keyword_id"},
    "sd": {"kt_type": "targeting_id", "search_term": "not_applicable", "match_type": "DSP TGT"},
}

FACT_COLUMNS = [
    *NAMES,
    "keyword_id",
    "keyword",
    "search_term",
    "date",
    *MEASURES,
    "match_type",
    "kt_type",
]
KEYWORD_COLUMNS = [*NAMES, "keyword_id", "keyword"]


def _canonical(df: DataFrame, product: str, columns: list[str]) -> DataFrame:
    mapping = {**COMMON, **PRODUCTS[product]}
    constants = CONSTANTS[product]

    def one(name: str) -> Column:
        if name in constants:
            return F.lit(constants[name])
        if name in IDS:
            return id_of(df, mapping[name])
        if name == "date":
            return to_day(mapping[name])
        if name in MEASURES:
            return F.col(mapping[name]).try_cast(MEASURES[name])
        return F.col(mapping[name])

    return df.select(*[one(name).alias(name) for name in columns])


def canonical_fact(
    sp: DataFrame, sb: DataFrame, sd: DataFrame, columns: list[str] | None = None
) -> DataFrame:
    """Union of the three products; ``columns`` may ask for a shorter form."""
    wanted = columns or FACT_COLUMNS
    parts = {"sp": sp, "sb": sb, "sd": sd}
    first, *rest = [_canonical(df, product, wanted) for product, df in parts.items()]
    for other in rest:
        first = first.unionByName(other)
    return first


def with_match_type(fact: DataFrame) -> DataFrame:
    return fact.withColumn("new_match_type", match_type("match_type", "keyword"))


# Advertised-product source columns per ad product (None = not reported).
ADVERTISED = {
    "sp": ("advertisedAsin", "impressions", "clicks", "spend", "sales30d", "unitsSoldClicks30d"),
    "sb": ("purchasedAsin", None, None, None, "sales14d", "unitsSold14d"),
    "sd": ("promotedAsin", "impressions", "clicks", "cost", "sales", "unitsSold"),
}
ADVERTISED_MEASURES = ["impressions", "clicks", "ads_spend", "ads_sales", "units"]


def _advertised(df: DataFrame, product: str) -> DataFrame:
    asin, *measures = ADVERTISED[product]
    out = [
        F.col("account_name"),
        F.col(asin).alias("asin"),
        id_of(df, "campaignId").alias("campaign_id"),
        F.col("campaignName").alias("campaign_name"),
        F.col("adGroupName").alias("ad_group_name"),
        to_day("date").alias("date"),
    ]
    for name, source in zip(ADVERTISED_MEASURES, measures):
        value = F.lit(None) if source is None else F.col(source)
        out.append(value.try_cast(MONEY).alias(name))
    return df.select(*out)


def advertised_products(sp: DataFrame, sb: DataFrame, sd: DataFrame) -> DataFrame:
    """Advertised-product rows of the three ad products, each taken once."""
    rows = _advertised(sp, "sp")
    return rows.unionByName(_advertised(sb, "sb")).unionByName(_advertised(sd, "sd"))


def stamp(df: DataFrame, as_of: date, **constants: str) -> DataFrame:
    """Add constants and ``updated_date`` unless the frame already has them."""
    made = {**constants, "updated_date": as_of}
    return df.withColumns({k: F.lit(v) for k, v in made.items() if k not in df.columns})


def with_month_year(df: DataFrame, date_col: str = "date") -> DataFrame:
    return df.withColumns(
        {"month": F.date_format(F.col(date_col), "MMM"), "year": F.year(F.col(date_col))}
    )
