"""Every registered query against its SQL in DuckDB, and the shape of the plans."""

from __future__ import annotations

import duckdb
import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

import __spark_entry__ as contract
from adloom import catalog, fixtures
from adloom.functions.calendar import day_periods, in_any, month_periods
from adloom.operators import canonical, dedupe, enrich, masking, periods, strategy
from adloom.plans import campaign, keyword
from check import compare

NAMES = sorted(catalog.QUERIES)


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for table in fixtures.TABLES:
        con.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, con, name):
    result = compare(spark, con, name, contract.queries()[name], contract.oracle_sql().get(name), SF_DIR)
    assert ": ok," in result, result


def test_entry(spark):
    assert contract.entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", sorted(fixtures.VIEWS))
def test_views_agree(spark, con, views, name):
    ours = views[name].count()
    (theirs,) = con.execute(fixtures.with_views(f"select count(*) from {name}")).fetchone()
    assert ours == theirs > 0


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["q10_campaign_report", "q12_period_metrics", "q20_masked_union", "q43_asin_masked", "q47_keyword_report"])
def test_plans_stay_in_the_jvm_and_distributed(spark, name):
    plan = plan_of(contract.queries()[name](spark, SF_DIR))
    for forbidden in ("EvalPython", "MapInPandas", "FlatMapGroups", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert forbidden not in plan, forbidden


def test_no_unbounded_single_partition(spark, views):
    report = views.campaign_report()
    assert "SinglePartition" not in plan_of(report)
    assert "SinglePartition" not in plan_of(views.keyword_report(pareto_keys=["portfolio_name"]))
    chain = masking._chains(campaign.LEVELS)[0]
    paths = report.select(*[level[0] for level in chain]).distinct().withColumn("__chunk", F.spark_partition_id())
    ranks = plan_of(masking._level_ranks(paths, chain, 1))
    # Only the root level's row counts, one per range, meet in one task.
    assert ranks.count("Exchange SinglePartition") == 1
    assert "Window [sum(__n" in ranks


def test_ten_periods_take_one_shuffle(spark, views):
    every = day_periods(fixtures.AS_OF) + month_periods(fixtures.AS_OF)
    fact = views.ad_fact.selectExpr("account_name", "campaignId", "adGroupId as ad_group_id", "keywordId as keyword_id", "date", "impressions", "clicks", "ad_spend", "ads_sale", "ads_units")
    plan = plan_of(periods.period_metrics(fact, every))
    assert plan.count("Exchange hashpartitioning(account_name") == 1
    assert "partial_sum" in plan


def test_period_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "fact")
    schema = "account_name string, campaignId string, ad_group_id string, keyword_id string, date date, impressions bigint, clicks bigint, ad_spend decimal(18,2), ads_sale decimal(18,2), ads_units bigint, note string"
    spark.createDataFrame([], schema).write.parquet(path)
    plan = plan_of(periods.period_metrics(spark.read.parquet(path), day_periods(fixtures.AS_OF)))
    assert "GreaterThanOrEqual(date,2001-06-02)" in plan
    assert "note" not in plan.split("ReadSchema: ")[1]


def test_tenant_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.createDataFrame([("a", "b", 1)], "`ACCOUNT NAME` string, P string, n int").write.parquet(path)
    rows = masking.tenant_rows(spark.read.parquet(path), "a", masking.MaskSpec(levels=[("P", "p", ())]))
    assert "EqualTo(ACCOUNT NAME,a)" in plan_of(rows) or "EqualTo(`ACCOUNT NAME`,a)" in plan_of(rows)


def test_products_are_scanned_once(spark, tmp_path):
    """The full outer join reads each product table in one pass, also for the campaigns it doesn't name."""
    from adloom.plans import asin

    path = str(tmp_path / "products")
    spark.range(50_000).selectExpr("cast(id % 40000 as string) as campaign_id", "id as n").write.parquet(path)
    products = spark.read.parquet(path)
    campaigns = spark.range(0, 90_000, 1, 4).selectExpr("cast(id as string) as campaign_id", "cast(id % 9 as string) as portfolio_name")
    joined = asin.with_portfolios(products, campaigns, small=True)
    assert path not in str(joined.inputFiles())
    wanted = products.join(campaigns, "campaign_id", "full")
    assert joined.exceptAll(wanted.select(*joined.columns)).isEmpty() and joined.count() == wanted.count() == 100_000
    two_passes = asin.with_portfolios(products, campaigns, small=False)
    assert two_passes.exceptAll(joined).isEmpty() and joined.exceptAll(two_passes).isEmpty()
    empty = asin.with_portfolios(products.limit(0), campaigns.limit(3), small=True)
    assert empty.count() == 3 and asin.with_portfolios(products.limit(2), campaigns.limit(0), small=True).count() == 2


def test_history_joins_without_an_exchange(spark, views, tmp_path):
    from adloom.plans import bid

    changes, names = bid.bucketed_history(views.bid_values, *views.searched(), "plan_history", str(tmp_path / "t"), 4)
    named = bid.named_changes(changes, names)
    plan = plan_of(named)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert named.count() == bid.named_changes(bid.bid_changes(views.bid_values), bid.keyword_names(*views.searched())).count()


def test_a_later_day_reads_one_day_of_facts(spark, tmp_path):
    from datetime import date

    from adloom.sources.tables import TableSource

    facts, store = str(tmp_path / "facts"), TableSource(path=str(tmp_path / "daily"))
    schema = "account_name string, campaignId string, ad_group_id string, keyword_id string, date date, impressions bigint, clicks bigint, ad_spend decimal(18,2), ads_sale decimal(18,2), ads_units bigint"
    days = [date(2001, 7, 30), date(2001, 7, 31), date(2001, 8, 1)]
    rows = [("a", "c", "g", f"k{i % 3}", days[i % 3], i, 1, None, None, 2) for i in range(30)]
    spark.createDataFrame(rows, schema).write.partitionBy("date").parquet(facts)
    fact = spark.read.schema(schema).parquet(facts)
    periods.refresh_daily(fact.filter("date < '2001-08-01'"), store)
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "daily").rglob("date=2001-07-*/*.parquet")}
    asked = fact.filter(F.col("date").isin([days[2]]))
    assert "PartitionFilters: [isnotnull(date" in plan_of(asked) and "2001-08-01" in plan_of(asked)
    daily = periods.refresh_daily(fact, store, [days[2]])
    assert {p: p.stat().st_mtime_ns for p in (tmp_path / "daily").rglob("date=2001-07-*/*.parquet")} == before and before
    windows = day_periods(days[2])
    made, wanted = periods.period_metrics(daily, windows), periods.period_metrics(fact, windows)
    assert made.exceptAll(wanted).isEmpty() and wanted.exceptAll(made).isEmpty() and made.count() == 3
    periods.refresh_daily(fact.filter("date < '2001-07-31'"), store, days[1:])
    assert [r[0] for r in spark.read.parquet(store.path).select("date").distinct().collect()] == [days[0]]


def test_keyword_report_sums_take_one_wide_shuffle(spark, views):
    periods = keyword.report_periods(fixtures.AS_OF)
    plan = plan_of(keyword.keyword_sums(canonical.with_match_type(views.fact()), periods))
    # One exchange of the sums, one of the descriptions; no third one joins them.
    assert plan.count("Exchange hashpartitioning(account_name") == 2
    wide = [line for line in plan.splitlines() if "Aggregate" in line and "sum(" in line]
    assert wide and not any("SortAggregate" in line for line in wide)
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan


def test_keyword_report_stores_the_rows_of_its_periods_once(spark, views, monkeypatch):
    """Sums and descriptions read the stored rows; the fact's joins run once."""
    made, keyword_sums = [], keyword.keyword_sums
    monkeypatch.setattr(keyword, "keyword_sums", lambda fact, periods: made.append(fact) or keyword_sums(fact, periods))
    catalog.q15_pareto(views)
    (held,) = made
    assert held.inputFiles() and all("/facts-" in f for f in held.inputFiles())
    wanted = canonical.with_match_type(views.fact()).filter(in_any(keyword.report_periods(fixtures.AS_OF)))
    assert held.exceptAll(wanted.select(held.columns)).isEmpty() and held.count() == wanted.count() > 0


def test_keyed_pick_is_limited_before_the_shuffle(spark, views):
    assert "WindowGroupLimit" in plan_of(enrich.ads_dim(views.ads))
    assert "WindowGroupLimit" in plan_of(dedupe.latest_bids(views.bid_values))
    assert "Window" not in plan_of(dedupe.latest_per_key(views.bid_values, ["keyword_id"], "updated_date", ties=True))


def test_strategy_without_broadcasts_gives_the_same(spark, views):
    """Above the size bound the dimensions are joined by shuffle."""
    fact = views.fact()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        index = strategy.name_index(strategy.account_brands(views.competitors))
        joined = strategy.classify_strategy(fact, strategy.own_asins(views.competitors), index)
        assert "SortMergeJoin" in plan_of(joined)
        shuffled = joined.groupBy("strategy").count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    checked = strategy.strategy_from(fact, views.competitors).groupBy("strategy").count().collect()
    assert sorted(map(tuple, shuffled)) == sorted(map(tuple, checked))


def test_catalog_is_complete():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert [n.split("_")[0] for n in NAMES] == [f"q{i:02d}" for i in range(1, len(NAMES) + 1)]
    assert len(catalog.RULES) == 7
