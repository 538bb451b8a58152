"""Hot keys and dimensions beyond the broadcast bound, at a size a test can afford."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from adloom.operators import enrich, joins, masking, pareto, strategy
from adloom.session import apply_settings

LOW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def low_bounds(spark):
    old = {k: spark.conf.get(k, None) for k in LOW}
    for k, v in LOW.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def executed(df) -> tuple[list, str]:
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString()


def hot_fact(spark, n=300_000):
    """A third of all rows share one keyword; most keywords name no product."""
    return spark.range(0, n, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 997)).alias("keyword_id"),
        F.when(F.col("id") % 50 == 0, 'asin="P7"').otherwise(F.concat(F.lit("word "), F.col("id"))).alias("keyword"),
        F.lit("acc").alias("account_name"),
        F.sha2(F.col("id").cast("string"), 256).alias("search_term"),
        F.current_date().alias("date"),
    )


def test_hot_keyword_is_split(spark, low_bounds):
    fact = hot_fact(spark)
    bids = spark.range(1000).select(F.concat(F.lit("k"), F.col("id")).alias("keyword_id"), F.lit(1).alias("bid"))
    bids = bids.unionByName(spark.createDataFrame([("hot", 2)], "keyword_id string, bid int"))
    joined = enrich.with_bids(fact, bids)
    # The aggregate follows the join on the same key: splitting must still happen.
    rows, plan = executed(joined.groupBy("keyword_id").agg(F.sum("bid").alias("s"), F.max("search_term")))
    assert "skew=true" in plan
    assert {r.keyword_id: r.s for r in rows}["hot"] == 200_000


def test_missing_products_are_spread(spark, low_bounds):
    asins = spark.createDataFrame([("acc", "P7")], "account_name string, our_asins string")
    brands = spark.createDataFrame([("acc", "x", True)], "account_name string, name string, own boolean")
    out = strategy.classify_strategy(hot_fact(spark, 30_000), asins, strategy.name_index(brands))
    assert {r.strategy: r["count"] for r in out.groupBy("strategy").count().collect()} == {"BD": 600, "GENERIC": 29_400}


def test_hot_portfolio_is_ranked_in_bands(spark, low_bounds):
    df = spark.range(0, 60_000, 1, 8).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("p"), F.col("id") % 5)).alias("portfolio_name"),
        F.col("id").cast("string").alias("keyword_id"),
        F.when(F.col("id") % 2 == 0, 0).otherwise(F.pmod(F.xxhash64("id"), F.lit(5_000))).cast("decimal(28,0)").alias("s"),
    )
    got = pareto.pareto(df, "s", ["portfolio_name"]).select("keyword_id", "cumulative_sales", "total_sales_portfolio")
    expected = df.selectExpr(
        "keyword_id",
        "sum(s) over (partition by portfolio_name order by s desc)",
        "sum(s) over (partition by portfolio_name)",
    )
    assert got.exceptAll(expected).isEmpty() and expected.exceptAll(got).isEmpty()
    running = pareto.running_sum(df, "s", ["portfolio_name"], band_units=100)
    sizes = running.withColumn("band", F.floor(F.col("running") * 0 + F.col("s") / 100)).groupBy("portfolio_name", "band").count()
    assert sizes.agg(F.max("count")).first()[0] <= 100


def test_empty_dimensions(spark):
    (empty,) = joins.size_checked(spark.range(5).filter("id > 9").select(F.col("id").cast("string").alias("keyword_id"), F.lit(1).alias("bid")))
    assert empty.count() == 0
    fact = spark.createDataFrame([("a",)], "keyword_id string")
    assert [tuple(r) for r in enrich.with_bids(fact, empty).collect()] == [("a", None)]
    none = spark.createDataFrame([], "`ACCOUNT NAME` string, P string, n int")
    spec = masking.MaskSpec(levels=[("P", "portfolio", ())], measures=["n"])
    assert masking.masked_union(none, "acme", spec).count() == 0
    assert masking.pseudonymize(none, spec.levels).count() == 0


def test_labels_of_a_hot_parent_span_ranges(spark):
    df = spark.range(0, 20_000, 1, 8).select(F.lit("p").alias("P"), F.format_string("k%06d", "id").alias("K"), F.col("id"))
    out = masking.pseudonymize(df, [("P", "portfolio", ()), ("K", "keyword", ("P",))], partitions=16)
    wrong = out.filter(F.col("K") != F.concat(F.lit("keyword"), (F.col("id") + 1).cast("string")))
    assert wrong.isEmpty() and out.count() == 20_000


def test_partitions_put_together_stay_small(spark):
    """A task of a report gets 16 MB of compressed rows at most where partitions are put together."""
    assert apply_settings(spark).conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "16m"


def test_lines_are_dealt_out_once_by_order(views):
    """Customers join the narrow orders, not the wide lines."""
    plan = views["ad_fact"]._jdf.queryExecution().optimizedPlan().toString()
    lines = [line for line in plan.splitlines() if "Join Inner" in line and "custkey" in line]
    assert len(lines) == 1 and "o_custkey" in lines[0]
    below = plan.splitlines()[plan.splitlines().index(lines[0]) :]
    assert not any("l_orderkey" in line for line in below)
