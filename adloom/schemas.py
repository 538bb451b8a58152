"""Declared schemas; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

STRING, LONG, INT, DATE = T.StringType(), T.LongType(), T.IntegerType(), T.DateType()
DOUBLE, FLOAT, TIMESTAMP = T.DoubleType(), T.FloatType(), T.TimestampType()
STRINGS = T.ArrayType(STRING)
MONEY = T.DecimalType(18, 2)

# Canonical fact measures and their types.
MEASURES = {
    "impressions": LONG,
    "clicks": LONG,
    "ad_spend": MONEY,
    "ads_sale": MONEY,
    "ads_units": LONG,
}


def struct(fields: dict[str, T.DataType], required: tuple[str, ...] = ()) -> T.StructType:
    return T.StructType([T.StructField(n, t, n not in required) for n, t in fields.items()])


TARGET_INFO = struct({"campaign_name": STRING, "target_acos": INT})
ACCOUNT_SETTINGS = struct({"account_name": STRING, "target_acos": INT})

# Retail sales files: column order and types, and the columns a file must have.
RETAIL_SALES = struct(
    {
        "customer_id": LONG,
        "store_id": LONG,
        "product_name": STRING,
        "sales_date": DATE,
        "sales_person_id": LONG,
        "price": MONEY,
        "quantity": INT,
        "total_cost": MONEY,
    }
)
MANDATORY_SALES_COLUMNS = RETAIL_SALES.fieldNames()

STAGING = struct(
    {
        "id": INT,
        "file_name": STRING,
        "file_location": STRING,
        "created_date": TIMESTAMP,
        "updated_date": TIMESTAMP,
        "status": STRING,
    }
)

# Columns and types of the campaign report's target. Unsigned 32-bit counts need 64 signed bits.
CAMPAIGN_INFO = struct(
    {
        "campaign_id": STRING,
        "keyword_id": STRING,
        "ACCOUNT NAME": STRING,
        "CAMPAIGNS": STRING,
        "ad_group_id": STRING,
        "AD GRP": STRING,
        "KEYWORD": STRING,
        "SEARCH TERM": STRING,
        "DATE": DATE,
        "IMPRSN": LONG,
        "CLICKS": LONG,
        "SPEND": DOUBLE,
        "SALES": DOUBLE,
        "UNITS": LONG,
        "new_match_type": STRING,
        "STRATEGY": STRING,
        "bid": FLOAT,
        "BID TYM": DATE,
        "PORTFOLIOS": STRING,
        "TARGETING TYP": STRING,
        "ADS TYP": STRING,
        "CAMP STATUS": STRING,
        "CPC": DOUBLE,
        "ROI": DOUBLE,
        "ACOS": DOUBLE,
        "CVR": DOUBLE,
        "MATCH TYP": STRING,
    },
    required=(
        "campaign_id",
        "keyword_id",
        "DATE",
        "IMPRSN",
        "CLICKS",
        "SPEND",
        "SALES",
        "UNITS",
        "bid",
        "CPC",
        "ROI",
        "ACOS",
        "CVR",
    ),
)
CAMPAIGN_INFO_ORDER = ["campaign_id", "keyword_id", "DATE"]


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast to a target schema; a value that does not fit becomes null."""
    return df.select(
        *[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema.fields]
    )


def misfits(df: DataFrame, schema: T.StructType) -> list[Column]:
    """Per target column, the number of values that don't fit, and of nulls it may not have."""
    counts = []
    for f in schema.fields:
        given = F.col(f"`{f.name}`")
        wrong = given.isNotNull() & given.try_cast(f.dataType).isNull()
        counts.append(F.count_if(wrong if f.nullable else wrong | given.isNull()).alias(f.name))
    return counts
