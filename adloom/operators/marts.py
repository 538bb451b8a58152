"""Monthly retail marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _monthly(sales: DataFrame, keys: list[str]) -> DataFrame:
    month = F.trunc("sales_date", "month").alias("sales_date_month")
    return sales.groupBy(*keys, month).agg(F.sum("total_cost").alias("total_sales"))


def customer_mart(sales: DataFrame, customers: DataFrame) -> DataFrame:
    """Customer attributes with the customer's sales per month.

    Sales are summed before the join, so the join moves one row per customer and month.
    """
    return _monthly(sales, ["customer_id"]).join(customers, "customer_id", "inner")


def sales_team_mart(sales: DataFrame, team: DataFrame, incentive: Column | None = None) -> DataFrame:
    """Sales per store, person and month; ``incentive`` is the caller's formula, if any."""
    mart = _monthly(sales, ["store_id", "sales_person_id"]).join(team, "sales_person_id", "inner")
    return mart if incentive is None else mart.withColumn("incentive", incentive)
