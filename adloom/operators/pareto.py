"""Running share of sales and the priority index, without gathering a whole group.

A running sum over one big portfolio would put that portfolio into one task.
Here rows are first summed per distinct value, the values are cut into bands of
fixed width, whole bands are summed, and only the rows of one band are ordered
together. Values are exact numbers, so a band holds at most ``BAND_UNITS``
distinct values however large the group is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adloom.operators.joins import join_null_safe, size_checked

BAND_UNITS = 1_000_000


def _unit(dtype: T.DataType) -> str:
    """Smallest step of an exact numeric type."""
    if isinstance(dtype, T.IntegralType):
        return "1"
    if isinstance(dtype, T.DecimalType):
        return "1" if dtype.scale == 0 else "0." + "0" * (dtype.scale - 1) + "1"
    raise TypeError(f"a running sum needs an integer or decimal column, not {dtype.simpleString()}")


def running_sum(
    df: DataFrame, value: str, partition: list[str], band_units: int = BAND_UNITS
) -> DataFrame:
    """(*partition, value, running): the sum over all rows of the group at or above each value.

    Rows with the same value share one result, as in a RANGE frame. Null values
    come last and add nothing.
    """
    dtype = df.schema[value].dataType
    width = F.lit(_unit(dtype)).cast("decimal(38,18)") * band_units
    band = F.floor(F.col(value) / width.cast("decimal(38,6)")).cast("bigint")
    per_value = (
        df.groupBy(*partition, value).agg(F.sum(value).alias("__at")).withColumn("__band", band)
    )
    bands = per_value.groupBy(*partition, "__band").agg(F.sum("__at").alias("__sum"))
    before = Window.partitionBy(*partition).orderBy(F.col("__band").desc_nulls_last())
    above = F.sum("__sum").over(before.rowsBetween(Window.unboundedPreceding, -1))
    bands = bands.withColumn("__above", above).drop("__sum")
    within = Window.partitionBy(*partition, "__band").orderBy(F.col(value).desc_nulls_last())
    inside = F.sum("__at").over(within)
    joined = join_null_safe(per_value, bands, [*partition, "__band"], "inner")
    total = F.coalesce(F.col("__above") + inside, F.col("__above"), inside)
    return joined.select(*partition, value, total.alias("running"))


def pareto(
    df: DataFrame,
    value: str = "ads_sale_last_60_days",
    partition: list[str] | None = None,
    total_partition: list[str] | None = None,
    threshold: float = 0.8,
) -> DataFrame:
    """Add cumulative sales, portfolio total, cumulative share and priority index.

    Index: -1 without sales, 1 up to the threshold share, else 0. The share is
    null where the total is 0. ``df`` is read three times; hand in stored rows.
    """
    partition = partition or ["portfolio_name", "keyword_id"]
    total_partition = total_partition or ["portfolio_name"]
    running = running_sum(df, value, partition).withColumnRenamed("running", "cumulative_sales")
    totals = df.groupBy(*total_partition).agg(F.sum(value).alias("total_sales_portfolio"))
    (totals,) = size_checked(totals)
    # Most keywords of a portfolio may sell nothing: they have one result per group, a small
    # side of its own that a hot group's rows needn't be sorted for.
    keys, idle = [*partition, value], F.coalesce(F.col(value), F.lit(0)) == 0
    out = join_null_safe(df.filter(~idle), running.filter(~idle), keys)
    out = out.unionByName(join_null_safe(df.filter(idle), running.filter(idle), keys))
    out = join_null_safe(out, totals, total_partition)
    share = F.try_divide(
        F.col("cumulative_sales").cast("double"), F.col("total_sales_portfolio").cast("double")
    )
    return out.withColumn("cumulative_percent", share).withColumn(
        "priority_index",
        F.when(F.col(value) == 0, -1).when(F.col("cumulative_percent") <= threshold, 1).otherwise(0),
    )
