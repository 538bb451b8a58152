"""Registered queries: every operator over the fixture views of a test-data folder.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame whose money columns
are doubles, so results compare with any SQL engine.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adloom import fixtures, schemas
from adloom.fixtures import AS_OF
from adloom.functions import calendar, labels, ratios, text
from adloom.operators import (
    canonical,
    cleaning,
    dedupe,
    enrich,
    joins,
    marts,
    masking,
    periods,
    quality,
    strategy,
)
from adloom.plans import asin, bid, campaign, keyword
from adloom.session import apply_settings, file_system, scratch_path
from adloom.sinks import tables as sinks
from adloom.sources import tables as sources
from adloom.sources.delimited import open_lines, read_delimited
from adloom.streaming.ingest import ingest_folder

TENANT = "BUILDING"

RULE_COLUMNS = [
    "account_name",
    "portfolio_name",
    "1_column_filter",
    "1_start",
    "1_end",
    "2_column_filter",
    "2_start",
    "2_end",
    "cpc_column_name",
    "bid_change",
]
RULE_SCHEMA = schemas.struct({c: schemas.STRING for c in RULE_COLUMNS} | {"rule_no": schemas.INT})
# Rule table of FIXTURES.md; no account means every account.
CPC_60 = "CPC_last_60_days"
RULES = [
    (None, None, "Acos_ratio", "0.01", "0.5", None, None, None, CPC_60, "10"),
    (None, " nation_1 , NATION_2", "Acos_ratio", "0.5", "1", None, None, None, CPC_60, "5"),
    (None, None, "Acos_ratio", None, "0.01", "clicks_last_60_days", "5", None, CPC_60, "-50"),
    (None, None, "clicks_last_60_days", "1", "5", None, None, None, CPC_60, "no change"),
    (None, None, "not_a_column", "1", None, "Acos_ratio", "1", None, CPC_60, "cpc/ratio"),
    (None, None, None, None, None, None, None, None, "no_such_cpc", "10"),
    (None, None, None, None, None, None, None, None, CPC_60, "abc"),
]

# Long brand names and what they are shortened to.
ALIASES = {"small": "all"}

URL_ID = r"example\.[a-z]+/[a-z]+/([0-9]+)"


class Views(fixtures.Fixtures):
    """Fixture views of one folder by attribute, and the report inputs made of them."""

    def __getattr__(self, name: str) -> DataFrame:
        if name not in fixtures.VIEWS and name not in fixtures.TABLES:
            raise AttributeError(name)
        return self[name]

    def searched(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        return self.sp_search_term, self.sb_search_term, self.sd_targeting

    def fact(self) -> DataFrame:
        return canonical.canonical_fact(*self.searched())

    def typed(self) -> DataFrame:
        return canonical.with_match_type(self.fact())

    def campaign_report(self, plan=campaign.campaign_report, **options) -> DataFrame:
        return plan(
            *self.searched(),
            self.campaigns,
            self.portfolios,
            self.targets,
            self.ads,
            self.competitors,
            self.bid_values,
            **options,
        )

    def keyword_report(self, **options) -> DataFrame:
        return keyword.keyword_report(
            *self.searched(),
            self.campaigns,
            self.portfolios,
            self.targets,
            self.ads,
            self.bid_values,
            self.target_info,
            self.account_settings,
            AS_OF,
            **options,
        )


def plain(df: DataFrame) -> DataFrame:
    """Decimals and floats as double."""
    inexact = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DecimalType, T.FloatType))]
    return df.withColumns({c: F.col(f"`{c}`").cast("double") for c in inexact}) if inexact else df


def q01_canonical_fact(v: Views) -> DataFrame:
    return v.fact()


def q02_match_type(v: Views) -> DataFrame:
    return v.typed().select(
        "campaignId",
        "keyword_id",
        "date",
        "keyword",
        "match_type",
        "new_match_type",
        labels.match_label("new_match_type").alias("match_label"),
    )


def q03_asin_extract(v: Views) -> DataFrame:
    return v.fact().select(
        "account_name", "keyword_id", "keyword", labels.extract_asin("keyword").alias("asin_extracted")
    )


def q04_brand_pattern(v: Views) -> DataFrame:
    names, sizes = joins.size_checked(*strategy.name_index(strategy.account_brands(v.competitors)))
    return strategy.with_brand_flags(v.fact().select("account_name", "keyword_id", "keyword"), (names, sizes))


def q05_strategy(v: Views) -> DataFrame:
    return strategy.strategy_from(v.fact(), v.competitors).select(
        "account_name", "campaignId", "keyword_id", "keyword", "date", "strategy"
    )


def q06_campaign_strategy(v: Views) -> DataFrame:
    per_campaign = strategy.campaign_strategy(strategy.strategy_from(v.fact(), v.competitors))
    return enrich.campaign_info(v.targets, v.ads, per_campaign)


def q07_target_group(v: Views) -> DataFrame:
    return enrich.target_dim(v.targets)


def q08_ads_type(v: Views) -> DataFrame:
    return enrich.ads_dim(v.ads)


def q09_latest_bid(v: Views) -> DataFrame:
    (latest,) = joins.size_checked(dedupe.latest_bids(v.bid_values))
    return enrich.with_bids(v.fact().select("campaignId", "keyword_id", "date"), latest)


def q10_campaign_report(v: Views) -> DataFrame:
    return v.campaign_report()


def q11_daily_keyword(v: Views) -> DataFrame:
    return canonical.with_month_year(periods.daily_keyword(v.typed()))


def q12_period_metrics(v: Views) -> DataFrame:
    return periods.period_metrics(v.fact(), calendar.day_periods(AS_OF))


def q13_monthly_metrics(v: Views) -> DataFrame:
    return periods.period_metrics(v.fact(), calendar.month_periods(AS_OF))


def q14_target_acos(v: Views) -> DataFrame:
    (dim,) = joins.size_checked(enrich.keyword_campaigns(v.campaigns, v.portfolios, v.targets))
    keys = v.fact().select(*periods.KEYS).distinct()
    rows = enrich.with_target_acos(
        enrich.keyword_metadata(keys, dim), v.target_info, v.account_settings
    )
    return rows.select(*periods.KEYS, "campaign_name", "portfolio_name", "targeting_type", "target_acos")


def _ranked(v: Views, pareto_keys: list[str]) -> DataFrame:
    return v.keyword_report(pareto_keys=pareto_keys).select(
        *periods.KEYS,
        "portfolio_name",
        "ads_sale_last_60_days",
        *periods.REPORT_TAIL,
        "priority_index",
    )


def q15_pareto(v: Views) -> DataFrame:
    return _ranked(v, ["portfolio_name", "keyword_id"])


def q16_pareto_portfolio(v: Views) -> DataFrame:
    return _ranked(v, ["portfolio_name"])


def _rules(v: Views) -> DataFrame:
    """The rule table as stored in two files, the later rules written first."""
    path = scratch_path(v.spark, "rules")
    numbered = v.spark.createDataFrame([(*rule, i) for i, rule in enumerate(RULES)], RULE_SCHEMA)
    for later in (True, False):
        numbered.filter((F.col("rule_no") > 2) == later).coalesce(1).write.mode("append").parquet(path)
    return v.spark.read.schema(RULE_SCHEMA).parquet(path)


def q17_bid_rules(v: Views) -> DataFrame:
    rules = _rules(v)
    sheet = keyword.bid_sheet(
        v.keyword_report(digits=None), rules, ratio_digits=None, bid_digits=None, shown_digits=None
    )
    return sheet.select(
        *periods.KEYS,
        "keyword",
        "portfolio_name",
        "target_acos",
        "ACOS_last_14_days",
        "clicks_last_60_days",
        "CPC_last_60_days",
        "suggested_bid",
        F.when(F.col("Acos_ratio") == float("inf"), -1.0).otherwise(F.col("Acos_ratio")).alias("Acos_ratio"),
    )


def q18_mask_word(v: Views) -> DataFrame:
    names = v.fact().select("account_name", "campaign_name", "ad_group_name", "keyword", "date", "clicks")
    return masking.replace_word(names.filter(F.col("account_name") == TENANT), TENANT)


def q19_mask_labels(v: Views) -> DataFrame:
    rows = v.campaign_report().filter(F.col("ACCOUNT NAME") == TENANT)
    rows = rows.select("campaign_id", "keyword_id", "DATE", "PORTFOLIOS", "CAMPAIGNS", "AD GRP", "KEYWORD")
    return masking.pseudonymize(rows, campaign.LEVELS)


def q20_masked_union(v: Views) -> DataFrame:
    return v.campaign_report(mask_tenant=TENANT)


def _asin(v: Views, **options) -> DataFrame:
    return asin.asin_report(
        v.sp_advertised, v.sb_purchased, v.sd_advertised, v.campaigns, v.portfolios, **options
    )


def q21_asin_report(v: Views) -> DataFrame:
    return _asin(v)


def _bid(v: Views, **options) -> DataFrame:
    return bid.bid_report(v.bid_values, *v.searched(), v.campaigns, v.portfolios, **options)


def q22_bid_report(v: Views) -> DataFrame:
    return _bid(v)


def q23_enabled_keywords(v: Views) -> DataFrame:
    names = canonical.canonical_fact(*v.searched(), canonical.KEYWORD_COLUMNS).select(
        "account_name", "campaignId", "keyword_id", "keyword"
    )
    return keyword.enabled_keywords(names, v.ads)


COERCE_SOURCE = """
select l_orderkey, l_linenumber,
  case when l_linenumber = 1 then 'n/a' else cast(cast(l_extendedprice as decimal(18,2)) as varchar(30)) end as spend,
  case when l_partkey % 7 = 0 then '' else cast(cast(l_quantity as bigint) % 5 as varchar(20)) end as clicks,
  cast(cast(l_quantity as bigint) * 100 as varchar(20)) as impressions,
  case when l_linestatus = 'F' then cast(l_suppkey as varchar(20)) else '0' end as sales,
  cast(l_quantity as bigint) % 3 as units,
  cast(l_extendedprice as decimal(18,2)) as gmv
from lineitem
"""


def q24_coercing_metrics(v: Views) -> DataFrame:
    src = v.sql(COERCE_SOURCE)
    return src.select(
        "l_orderkey",
        "l_linenumber",
        ratios.coerced("ACOS", "spend", "sales").alias("acos"),
        ratios.coerced("TACOS", "spend", "gmv").alias("tacos"),
        ratios.coerced("CPC", "spend", "clicks").alias("cpc"),
        ratios.coerced("CVR", "units", "clicks").alias("cvr"),
        ratios.coerced("CTR", "clicks", "impressions").alias("ctr"),
        ratios.coerced("ASP", "gmv", "units").alias("asp"),
        ratios.coerced("GMV_ATTAINMENT", "gmv", "impressions").alias("gmv_attainment"),
        ratios.coerced("SPEND_ATTAINMENT", "spend", "gmv").alias("spend_attainment"),
    )


MAGNITUDE_SOURCE = """
select case l_partkey % 13
    when 0 then n || '.25K' when 1 then n || 'M' when 2 then '-' when 3 then '-' || n
    when 4 then n || ' Lakhs' when 5 then n || ' Lakh' when 6 then n || '.5 Crores' when 7 then n || ' Crore'
    when 8 then n || ',200' when 9 then n || ' Units' when 10 then '' when 11 then 'x' || n
    else n || ' cr' end as raw
from (select l_partkey, cast(cast(l_quantity as bigint) as varchar(20)) as n from lineitem) t
"""


def q25_magnitude_parse(v: Views) -> DataFrame:
    src = v.sql(MAGNITUDE_SOURCE)
    return src.select(
        "raw",
        text.parse_magnitude("raw").alias("whole"),
        text.parse_lakh_crore("raw").alias("amount"),
        text.strip_commas("raw").alias("no_commas"),
    )


CURRENCY_SOURCE = """
select l_orderkey,
  '₹' || cast(cast(l_quantity as bigint) as varchar(20)) || ',200' as price,
  'Rs.' || cast(cast(l_extendedprice as decimal(18,2)) as varchar(30)) as cost,
  case when l_partkey = 7 then 'free' else cast(l_suppkey as varchar(20)) end as fee,
  case when l_partkey = 8 then null else '5' end as tax
from lineitem
"""


def q26_currency_clean(v: Views) -> DataFrame:
    return cleaning.clean_currency(v.sql(CURRENCY_SOURCE))


def q27_url_ids(v: Views) -> DataFrame:
    pages = v.pages.select("page_id", "url")
    return cleaning.extract_ids(pages, "url", URL_ID).withColumn("piece", cleaning.path_piece("url", 3))


def _daily_totals(v: Views, first: date, last: date) -> DataFrame:
    """Totals per day of the calendar's range; days outside are never aggregated."""
    inside = v.fact().filter(F.col("date").between(F.lit(first), F.lit(last)))
    return inside.groupBy("date").agg(F.sum("clicks").alias("clicks"), F.sum("ad_spend").alias("ad_spend"))


def q28_calendar_days(v: Views) -> DataFrame:
    days = calendar.last_days(v.spark, AS_OF)
    return days.join(_daily_totals(v, AS_OF - timedelta(days=14), AS_OF), "date", "left")


def q29_calendar_months(v: Views) -> DataFrame:
    whole = calendar.last_months(v.spark, AS_OF).withColumn("kind", F.lit("whole"))
    running = calendar.month_ranges(v.spark, AS_OF, 6).withColumn("kind", F.lit("running"))
    periods_ = calendar.month_periods(AS_OF, 6)
    daily = _daily_totals(v, periods_[-1].start, periods_[0].end)
    daily = daily.withColumn("start_date", F.trunc("date", "month").cast("date"))
    # Nine rows whatever the data; the totals stream past them.
    months = F.broadcast(whole.unionByName(running))
    inside = F.col("date") <= F.col("end_date")
    sums = daily.join(months, "start_date").filter(inside).groupBy("kind", "start_date", "end_date").agg(
        F.sum("clicks").alias("clicks"), F.sum("ad_spend").alias("ad_spend")
    )
    return months.join(sums, ["kind", "start_date", "end_date"], "left")


def q30_latest_snapshot(v: Views) -> DataFrame:
    src = v.events.select(
        F.col("event_type").alias("account_name"),
        "event_id",
        "value",
        F.col("ts").cast("date").alias("updated_date"),
    )
    return dedupe.latest_snapshot(src, "account_name", "updated_date")


def q31_dedupe_keyed(v: Views) -> DataFrame:
    names = v.fact().select("account_name", "keyword_id", "campaign_name", "keyword", "search_term")
    return dedupe.dedupe(names, ["account_name", "keyword_id"])


def q32_dedupe_full(v: Views) -> DataFrame:
    return dedupe.dedupe(bid.keyword_names(*v.searched()))


def _sheets(v: Views) -> list[str]:
    """Target sheets as tab files: preamble, header, then good, bad, short and over-long lines."""
    path = scratch_path(v.spark, "sheets")
    goal = (F.col("campaignId") % 40).cast("string")
    variants = [[goal], [F.lit("none")], [], [goal, F.lit("extra")]]
    body = v.campaigns.select(
        (F.col("campaignId") % 4).alias("sheet"),
        F.lit(1).alias("place"),
        F.array_join(F.array(*[F.concat_ws("\t", "name", *rest) for rest in variants]), "\n").alias("value"),
    )
    head = F.lit("Report,of today\ncampaign_name\ttarget_acos")
    head = body.select("sheet").distinct().select("sheet", F.lit(0).alias("place"), head.alias("value"))
    sheets = body.unionByName(head).repartition("sheet").sortWithinPartitions("sheet", "place")
    sheets.drop("place").write.partitionBy("sheet").text(path)
    return [f"{path}/sheet={i}" for i in range(6)]


def q33_gather(v: Views) -> DataFrame:
    return sources.gather(v.spark, _sheets(v), schemas.TARGET_INFO, sep="\t", skip_rows=1)


DATE_SOURCE = """
select o_orderkey, cast(cast(o_orderdate as date) as varchar(10)) as order_date,
  replace(cast(cast(o_orderdate as date) as varchar(10)), '-', '/') as slash_date,
  case when o_orderkey % 1000 = 7 then 'unknown' else cast(cast(o_orderdate as date) as varchar(10)) end as Odd_Date,
  o_orderstatus as status
from orders
"""


def q34_date_columns(v: Views) -> DataFrame:
    return cleaning.normalize_date_columns(v.sql(DATE_SOURCE))


def _sales_files(v: Views) -> list[str]:
    """Retail sales as two CSV folders: one of two layouts, one whose files lack a column."""
    base = scratch_path(v.spark, "sales")
    sales = v.retail_sales
    mode = F.when(F.col("store_id") == 121, "cash").otherwise("UPI")
    layouts = [
        ("mixed", sales),
        ("mixed", sales.select(mode.alias("payment_mode"), *sales.columns[::-1])),
        ("short", sales.drop("store_id").withColumn("payment_mode", F.lit("cash"))),
    ]
    for i, (folder, df) in enumerate(layouts):
        df.filter(F.col("sales_person_id") % 3 == i).write.mode("append").csv(f"{base}/{folder}", header=True)
    return [f"{base}/mixed", f"{base}/short"]


def q35_mandatory_columns(v: Views) -> DataFrame:
    """Lines by folder and what the header check says of their files."""
    found = open_lines(v.spark, _sales_files(v))
    checked = quality.check_columns(v.spark, found, schemas.MANDATORY_SALES_COLUMNS)
    lines = found.lines.groupBy(F.col("file_path").alias("path")).agg((F.count("line") - 1).alias("n"))
    folder = F.element_at(F.split("path", "/"), -2).alias("folder")
    named = [F.array_join(F.array_sort(c), ",").alias(c) for c in ("missing", "extra")]
    per_file = checked.join(lines, "path").select(folder, "status", *named, "n")
    return per_file.groupBy("folder", "status", "missing", "extra").agg(F.sum("n").alias("lines"))


def q36_audit(v: Views) -> DataFrame:
    """Accounts without settings or without a brand, and the row of a load that failed."""
    settings = quality.audit(v.account_settings, "account_settings", AS_OF, v.accounts)
    brands = quality.audit(strategy.brand_names(v.competitors, "our_brand_name"), "brands", AS_OF, v.accounts)
    failed = quality.audit_error(v.spark, "ads", ValueError("no such table"), AS_OF)
    return settings.unionByName(brands).unionByName(failed)


def q37_table_roundtrip(v: Views) -> DataFrame:
    target = sources.TableSource(path=scratch_path(v.spark, "facts"))
    sinks.write_table(v.fact(), target, sort=["account_name", "date"])
    return sources.read_table(
        v.spark,
        target,
        columns={"account_name": "account_name", "day": "date", "spend": "ad_spend", "note": F.lit(None).cast("string")},
        where=F.col("account_name") == TENANT,
        schema=v.fact().schema,
    )


def q38_typed_sink(v: Views) -> DataFrame:
    target = sources.TableSource(path=scratch_path(v.spark, "campaign_info"))
    sinks.write_table(
        v.campaign_report(), target, schema=schemas.CAMPAIGN_INFO, sort=schemas.CAMPAIGN_INFO_ORDER
    )
    return sources.read_table(v.spark, target)


def _deliver(v: Views, df: DataFrame, folder: str, name: str) -> None:
    """CSV files of ``df`` in ``folder`` under a name that needs escaping, numbered."""
    sent = scratch_path(v.spark, "sent")
    df.write.csv(sent, header=True)
    place, fs = file_system(v.spark, sent)
    fs.mkdirs(file_system(v.spark, folder)[0])
    parts = [s.getPath() for s in fs.listStatus(place) if s.getPath().getName().startswith("part-")]
    for i, part in enumerate(parts):
        fs.rename(part, file_system(v.spark, f"{folder}/{name} {i}.csv")[0])


def q39_drop_folder(v: Views) -> DataFrame:
    """Two deliveries of oddly named files into one folder, each followed by a run; then a run with nothing new."""
    base = scratch_path(v.spark, "drop")
    sales = v.retail_sales
    for part, name in enumerate(("daily sales", "50%20 + #1 (new)")):
        _deliver(v, sales.filter(F.col("customer_id") % 2 == part), f"{base}/in", name)
        ingest_folder(v.spark, f"{base}/in", schemas.RETAIL_SALES, f"{base}/out", f"{base}/state")
    ingest_folder(v.spark, f"{base}/in", schemas.RETAIL_SALES, f"{base}/out", f"{base}/state")
    return v.spark.read.parquet(f"{base}/out").select(*schemas.RETAIL_SALES.fieldNames())


def q40_refresh_if_stale(v: Views) -> DataFrame:
    """A target left from the day before is replaced, then appended to on the same day."""
    target = sources.TableSource(path=scratch_path(v.spark, "bids"))
    rows = v.bid_values.select("keyword_id", "bid", "account_name")
    stale = canonical.stamp(rows, AS_OF - timedelta(days=1), source="old")
    fresh = canonical.stamp(rows, AS_OF, source="new")
    sinks.write_table(stale, target)
    sinks.refresh_if_stale(fresh, target, AS_OF)
    sinks.refresh_if_stale(fresh, target, AS_OF)
    return sources.read_table(v.spark, target)


def q41_customer_mart(v: Views) -> DataFrame:
    customers = v.customer.select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("full_name"))
    return marts.customer_mart(v.retail_sales, customers)


def q42_sales_mart(v: Views) -> DataFrame:
    team = v.nation.select(
        F.col("n_nationkey").cast("bigint").alias("sales_person_id"), F.col("n_name").alias("full_name")
    )
    return marts.sales_team_mart(v.retail_sales, team)


def q43_asin_masked(v: Views) -> DataFrame:
    return _asin(v, mask_tenant=TENANT)


def q44_bid_masked(v: Views) -> DataFrame:
    return _bid(v, mask_tenant=TENANT)


def q45_valid_sales(v: Views) -> DataFrame:
    return quality.read_valid(v.spark, _sales_files(v), schemas.RETAIL_SALES)


def q46_unfinished_files(v: Views) -> DataFrame:
    name = F.concat(F.lit("sales_"), F.col("key").cast("string"), F.lit(".csv")).alias("file_name")
    files = v.lineitem.select(F.col("l_orderkey").alias("key")).distinct().select(name)
    staging = v.orders.select(
        F.col("o_orderkey").alias("key"), F.when(F.col("o_orderstatus") == "O", "I").otherwise("A").alias("status")
    ).select(name, "status")
    return quality.unfinished_files(files, staging)


def q47_keyword_report(v: Views) -> DataFrame:
    return v.keyword_report()


def q48_tied_bids(v: Views) -> DataFrame:
    """Newest bids per account and day, every bid of a tie kept."""
    bids = v.bid_values.withColumn("day", F.col("updated_date").cast("date")).drop("updated_date")
    return dedupe.latest_per_key(bids, ["account_name"], "day", ties=True)


def q49_campaign_strategy_report(v: Views) -> DataFrame:
    return v.campaign_report(campaign.campaign_strategy_report)


def q50_ambiguous_targets(v: Views) -> DataFrame:
    """Audit rows of campaigns with several targets; the fixture gives every fifth a second one."""
    second = v.target_info.filter(F.col("target_acos") % 5 == 0).withColumn("target_acos", F.col("target_acos") + 1)
    return quality.audit_targets(v.target_info.unionByName(second), AS_OF)


def q51_rejected_lines(v: Views) -> DataFrame:
    """Lines of the target sheets with too many fields, by reason."""
    found = read_delimited(v.spark, sources.present(v.spark, _sheets(v)), schemas.TARGET_INFO, "\t", skip_rows=1)
    return found.reject_counts().groupBy("reason").agg(F.sum("lines").alias("lines"))


def q52_strategy_aliases(v: Views) -> DataFrame:
    """As q05 with a long brand name shortened, which then matches more keywords."""
    return strategy.strategy_from(v.fact(), v.competitors, ALIASES).select(
        "account_name", "campaignId", "keyword_id", "keyword", "date", "strategy"
    )


def q53_bid_coverage(v: Views) -> DataFrame:
    """How many keywords of an account get a bid once bids are rounded."""
    sheet = keyword.bid_sheet(v.keyword_report(digits=None), _rules(v), ratio_digits=None, bid_digits=1, sort=False)
    return sheet.groupBy("account_name").agg(
        F.count("suggested_bid").alias("with_bid"), F.count(F.lit(1)).alias("total")
    )


def q54_staged_files(v: Views) -> DataFrame:
    """Bids as a staged load and as a stamped CSV, both read again."""
    base = scratch_path(v.spark, "out")
    rows = v.bid_values.select("keyword_id", F.col("bid").cast("double").alias("bid"), "account_name")
    staged = v.spark.read.schema(rows.schema).parquet(sinks.stage_load(rows, f"{base}/stage"))
    stamped = sinks.write_stamped_csv(rows, base, "bids", datetime(2001, 8, 1, 7, 5))
    again = sources.read_csv(v.spark, stamped, rows.schema)
    return staged.withColumn("kind", F.lit("staged")).unionByName(again.withColumn("kind", F.lit("stamped")))


def q55_replaced_day(v: Views) -> DataFrame:
    """Bids by day, of which one day is replaced: source and rows of each day, and whether its files stayed."""
    target = sources.TableSource(path=scratch_path(v.spark, "bids_by_day"))
    day = F.col("updated_date").cast("date").alias("updated_date")
    bids = v.bid_values.select("keyword_id", "bid", day)
    days = bids.select("updated_date").distinct()
    (newest,) = days.agg(F.max("updated_date")).first()
    sinks.write_table(bids.withColumn("source", F.lit("old")), target, partition_by=["updated_date"])
    before = _files(v, target)
    sinks.refresh_days(bids.withColumn("source", F.lit("new")), target, [newest])
    stayed = _files(v, target).join(before, ["updated_date", "file"], "left_semi").select("updated_date").distinct()
    rows = sources.read_table(v.spark, target).groupBy("updated_date", "source").agg(F.count(F.lit(1)).alias("bids"))
    return rows.join(stayed.withColumn("stayed", F.lit(True)), "updated_date", "left").fillna(False, ["stayed"])


def _files(v: Views, target: sources.TableSource) -> DataFrame:
    """Day and name of every file of a table laid out by day, as they are now."""
    name = F.element_at(F.split(F.input_file_name(), "/"), -1).alias("file")
    now = sources.read_table(v.spark, target).select("updated_date", name).distinct()
    return joins.stored(now, "files")[0]


def q56_daily_store(v: Views) -> DataFrame:
    """Period metrics from stored daily sums: made before the rows of a day came in, then refreshed by that day.

    The store holds the days that any of the periods has, as the report over the fact reads them.
    """
    store = sources.TableSource(path=scratch_path(v.spark, "daily"))
    periods_ = calendar.day_periods(AS_OF)
    earlier = v.fact().filter(calendar.in_any(periods_)).filter(F.col("date") != F.lit(AS_OF))
    periods.refresh_daily(earlier, store)
    return periods.period_metrics(periods.refresh_daily(v.fact(), store, [AS_OF]), periods_)


def q57_bucketed_bids(v: Views) -> DataFrame:
    """The bid report over bid history and keywords stored in buckets of the same keys."""
    path = scratch_path(v.spark, "history")
    name = "history_" + path.rpartition("-")[2]
    changes, names = bid.bucketed_history(v.bid_values, *v.searched(), name, path, buckets=8)
    return bid.placed_changes(bid.named_changes(changes, names), v.campaigns, v.portfolios)


def q58_title_headers(v: Views) -> DataFrame:
    """Totals per account under title headers, spend moved to the front, as (account, place, header, total)."""
    totals = v.fact().groupBy("account_name").agg(*[F.sum(m).cast("double").alias(m) for m in schemas.MEASURES])
    shown = cleaning.move_column(cleaning.title_headers(totals), "Ad Spend", 1)
    names = shown.columns[1:]
    cells = F.array(*[F.struct(F.lit(n).alias("header"), F.col(f"`{n}`").alias("total")) for n in names])
    cells = shown.select(F.col("`Account Name`").alias("account_name"), F.posexplode(cells).alias("place", "cell"))
    return cells.select("account_name", "place", "cell.header", "cell.total")


def q59_row_counts(v: Views) -> DataFrame:
    """Rows of the fact and of the ads, as counted by the writer's row count."""
    counts = [(name, sinks.row_count(df)) for name, df in (("fact", v.fact()), ("ads", v.ads))]
    return v.spark.createDataFrame(counts, "name string, n bigint")


def q60_audit_table(v: Views) -> DataFrame:
    """An audit table after two runs, the second of which was repeated and found less."""
    target = sources.TableSource(path=scratch_path(v.spark, "audit"))
    missing = quality.audit(v.account_settings, "account_settings", AS_OF, v.accounts)
    brands = quality.audit(strategy.brand_names(v.competitors, "our_brand_name"), "brands", AS_OF, v.accounts)
    quality.append_audit(missing.unionByName(brands), target, "first")
    quality.append_audit(missing.unionByName(brands), target, "second")
    quality.append_audit(brands, target, "second")
    return sources.read_table(v.spark, target)


def _registered(query):
    return lambda spark, sf_dir: plain(query(Views(apply_settings(spark), sf_dir)))


QUERIES = {
    name: _registered(query)
    for name, query in sorted(globals().items())
    if name.startswith("q") and name[1:3].isdigit()
}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["q10_campaign_report"](spark, sf_dir)
