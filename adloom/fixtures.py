"""Advertising and retail views over the TPC-H-like test tables (see FIXTURES.md).

The SQL text is shared by Spark and DuckDB. Three views pair every supplier with
every account; Spark builds those with ``explode`` and an equi-join instead of a
cross join, and the fact joins orders and customers first (``SPARK_VIEWS``), which
yields the same rows.
"""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import DataFrame, SparkSession

AS_OF = date(2001, 8, 1)

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

VIEWS = {
    "ad_fact": """
select c.c_mktsegment as account_name,
  cast(l.l_suppkey * 10 + case c.c_mktsegment when 'AUTOMOBILE' then 0 when 'BUILDING' then 1 when 'FURNITURE' then 2 when 'HOUSEHOLD' then 3 else 4 end as varchar(20)) || '.0' as campaignId,
  s.s_name || '-' || c.c_mktsegment as campaign_name,
  cast(p.p_size as varchar(20)) || '.0' as adGroupId,
  p.p_type as ad_group_name,
  cast(l.l_partkey as varchar(20)) || '.0' as keywordId,
  case when l.l_returnflag = 'A' and l.l_partkey % 4 = 0 then 'category="' || p.p_brand || '"'
       when l.l_returnflag = 'A' and l.l_partkey % 4 = 1 then 'asin-expanded="P' || cast(l.l_partkey as varchar(20)) || '"'
       when l.l_returnflag = 'A' then 'asin="P' || cast(l.l_partkey as varchar(20)) || '"'
       when l.l_returnflag = 'R' then case l.l_partkey % 4 when 0 then 'close-match' when 1 then 'loose-match' when 2 then 'substitutes' else 'complements' end
       else p.p_name end as keyword,
  p.p_name as search_term,
  cast(l.l_shipdate as date) as date,
  cast(l.l_quantity * 100 as bigint) as impressions,
  cast(l.l_quantity as bigint) % 7 as clicks,
  cast(cast(l.l_extendedprice as decimal(18,2)) * cast(l.l_discount as decimal(4,2)) as decimal(18,2)) as ad_spend,
  case when l.l_linestatus = 'F' then cast(l.l_extendedprice as decimal(18,2)) else cast(0 as decimal(18,2)) end as ads_sale,
  cast(l.l_quantity as bigint) % 3 as ads_units,
  case l.l_returnflag when 'A' then 'TARGETING_EXPRESSION' when 'R' then 'TARGETING_EXPRESSION_PREDEFINED' else 'BROAD' end as match_type,
  l.l_linenumber % 3 as src
from lineitem l
join orders o on l.l_orderkey = o.o_orderkey
join customer c on o.o_custkey = c.c_custkey
join part p on l.l_partkey = p.p_partkey
join supplier s on l.l_suppkey = s.s_suppkey
""",
    "sp_search_term": """
select account_name, campaignId, campaign_name as campaignName, adGroupId, ad_group_name as adGroupName,
  keywordId, keyword as targeting, search_term as searchTerm, cast(date as varchar(10)) as date, impressions, clicks,
  ad_spend as cost, ads_sale as sales30d, ads_units as unitsSoldSameSku1d, match_type as matchType
from ad_fact where src = 0
""",
    "sb_search_term": """
select account_name, campaignId, campaign_name as campaignName, adGroupId, ad_group_name as adGroupName,
  keywordId, keyword as keywordText, search_term as searchTerm, cast(date as varchar(10)) as date, impressions, clicks,
  ad_spend as cost, ads_sale as sales, ads_units as unitsSold, match_type as matchType
from ad_fact where src = 1
""",
    "sd_targeting": """
select account_name, campaignId, campaign_name as campaignName, adGroupId, ad_group_name as adGroupName,
  keywordId as targetingId, keyword as targetingText, cast(date as varchar(10)) as date, impressions, clicks,
  ad_spend as cost, ads_sale as sales, ads_units as unitsSold
from ad_fact where src = 2
""",
    "sp_advertised": """
select account_name, 'P' || replace(keywordId, '.0', '') as advertisedAsin, campaignId, campaign_name as campaignName,
  ad_group_name as adGroupName, cast(date as varchar(10)) as date, impressions, clicks, ad_spend as spend,
  ads_sale as sales30d, ads_units as unitsSoldClicks30d
from ad_fact where src = 0
""",
    "sd_advertised": """
select account_name, 'P' || replace(keywordId, '.0', '') as promotedAsin, campaignId, campaign_name as campaignName,
  ad_group_name as adGroupName, cast(date as varchar(10)) as date, impressions, clicks, ad_spend as cost,
  ads_sale as sales, ads_units as unitsSold
from ad_fact where src = 2
""",
    "sb_purchased": """
select account_name, 'P' || replace(keywordId, '.0', '') as purchasedAsin, campaignId, campaign_name as campaignName,
  ad_group_name as adGroupName, cast(date as varchar(10)) as date, ads_sale as sales14d, ads_units as unitsSold14d
from ad_fact where src = 1
""",
    "accounts": """
select distinct c_mktsegment as account_name,
  case c_mktsegment when 'AUTOMOBILE' then 0 when 'BUILDING' then 1 when 'FURNITURE' then 2 when 'HOUSEHOLD' then 3 else 4 end as account_no
from customer
""",
    "campaigns": """
select s.s_suppkey * 10 + a.account_no as campaignId,
  case when s.s_suppkey % 10 = 0 then null else s.s_nationkey end as portfolioId,
  s.s_name || '-' || a.account_name as name
from supplier s cross join accounts a
""",
    "portfolios": """
select n_nationkey as portfolioId, n_name as name from nation where n_nationkey <> 3
""",
    "targets": """
select s.s_suppkey * 10 + a.account_no as campaignId,
  case s.s_suppkey % 9 when 0 then 'product' when 1 then 'KEYWORD' when 2 then 'AUTO' when 3 then 'THEME' when 4 then 'PRODUCT_CATEGORY'
    when 5 then 'AUDIENCE' when 6 then 'PRODUCT_AUDIENCE' when 7 then 'PRODUCT_CATEGORY_AUDIENCE' else 'OTHER' end as targetType,
  case when s.s_suppkey % 2 = 0 then 'PURCHASES' else 'views' end as targetDetails_event
from supplier s cross join accounts a where s.s_suppkey % 11 <> 0
""",
    "ads": """
select a.account_name as account_name, s.s_suppkey * 10 + a.account_no as campaignId,
  case when s.s_suppkey % 8 = 0 then 'SPONSORED_PRODUCTS' when s.s_suppkey % 8 <= 4 then 'SPONSORED_BRANDS' else 'SPONSORED_DISPLAY' end as adProduct,
  case s.s_suppkey % 8 when 0 then 'PRODUCT_AD' when 1 then 'BRAND_VIDEO' when 2 then 'VIDEO' when 3 then 'PRODUCT_COLLECTION'
    when 4 then 'STORE_SPOTLIGHT' when 5 then 'IMAGE' when 6 then 'PRODUCT_AD' else 'VIDEO' end as adType,
  case when s.s_suppkey % 3 = 0 then 'PAUSED' else 'ENABLED' end as state,
  'P' || cast(s.s_suppkey as varchar(20)) as creative_products
from supplier s cross join accounts a where s.s_suppkey % 13 <> 0
""",
    "competitors": """
select a.account_name as account_name,
  case when p.p_partkey % 3 = 0 then 'P' || cast(p.p_partkey as varchar(20)) else null end as our_asins,
  case a.account_no when 0 then 'Red' when 1 then 'HOT' when 2 then 'small' when 3 then '' else null end as our_brand_name,
  case when p.p_partkey % 2 = 0 then 'Blue' else 'old (bolt' end as competitor_brand_name
from accounts a join part p on p.p_partkey % 5 = a.account_no
""",
    "bid_values": """
select cast(user_id as varchar(20)) as keyword_id, cast(value as decimal(10,2)) as bid, ts as updated_date,
  case user_id % 5 when 0 then 'AUTOMOBILE' when 1 then 'BUILDING' when 2 then 'FURNITURE' when 3 then 'HOUSEHOLD' else 'MACHINERY' end as account_name
from events
""",
    "target_info": """
select name as campaign_name, cast(campaignId % 40 as int) as target_acos from campaigns where campaignId % 2 = 0
""",
    "account_settings": """
select account_name, 30 + 10 * account_no as target_acos from accounts where account_no < 4
""",
    "retail_sales": """
select o.o_custkey as customer_id, 121 + o.o_orderkey % 3 as store_id, p.p_name as product_name,
  cast(o.o_orderdate as date) as sales_date, 1 + l.l_suppkey % 9 as sales_person_id,
  cast(p.p_retailprice as decimal(18,2)) as price, cast(l.l_quantity as int) as quantity,
  cast(cast(p.p_retailprice as decimal(18,2)) * cast(l.l_quantity as int) as decimal(18,2)) as total_cost
from orders o join lineitem l on l.l_orderkey = o.o_orderkey join part p on l.l_partkey = p.p_partkey
""",
}

_CROSS = "from supplier s cross join accounts a"
_EXPLODED = (
    "from (select *, explode(sequence(0, 4)) as slot from supplier) s "
    "join accounts a on a.account_no = s.slot"
)
# Narrow orders meet their customers before the wide lines, which then are dealt out once less.
_IN_TURN = """join orders o on l.l_orderkey = o.o_orderkey
join customer c on o.o_custkey = c.c_custkey
"""
_AT_ONCE = """join (select o_orderkey, c_mktsegment from orders join customer on o_custkey = c_custkey) c
on l.l_orderkey = c.o_orderkey
"""
SPARK_VIEWS = {
    name: text.replace(_CROSS, _EXPLODED).replace(_IN_TURN, _AT_ONCE) for name, text in VIEWS.items()
}


def _needed(sql: str, views: dict[str, str]) -> list[str]:
    """View names ``sql`` uses, directly or through other views, in VIEWS order."""
    found: set[str] = set()
    queue = [sql]
    while queue:
        words = set(re.findall(r"\w+", queue.pop()))
        for name in views:
            if name in words and name not in found:
                found.add(name)
                queue.append(views[name])
    return sorted(found, key=_dependency_order(views).index)


def _dependency_order(views: dict[str, str]) -> list[str]:
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for other in views:
            if other != name and re.search(rf"(from|join) {other}\b", views[name]):
                visit(other)
        order.append(name)

    for name in views:
        visit(name)
    return order


def with_views(sql: str) -> str:
    """``sql`` behind the CTEs it needs, for an engine that has the base tables."""
    names = _needed(sql, VIEWS)
    if not names:
        return sql
    ctes = ",\n".join(f"{name} as ({VIEWS[name].strip()})" for name in names)
    body = sql.strip()
    if body.lower().startswith("with "):
        return f"with {ctes},\n{body[5:]}"
    return f"with {ctes}\n{body}"


class Fixtures:
    """The views, and the base tables, of one test-data folder as lazy DataFrames.

    Each is analysed once and shared by the views built on it.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._known: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._known:
            self._known[name] = self._build(name)
        return self._known[name]

    def _build(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self.sql(SPARK_VIEWS[name])

    def sql(self, query: str) -> DataFrame:
        """A query over views and base tables named after ``from`` and ``join``."""
        used: set[str] = set()

        def mark(match: re.Match) -> str:
            word, name = match.groups()
            if name not in TABLES and name not in VIEWS:
                return match[0]
            used.add(name)
            return f"{word} {{{name}}}"

        text = re.sub(r"\b(from|join) (\w+)", mark, query)
        return self.spark.sql(text, **{name: self[name] for name in used})
