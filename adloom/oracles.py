"""The registered queries as plain SQL for DuckDB, over the same tables.

Written independently of the DataFrame code: windows where Spark uses banded
sums, full outer joins where Spark splits them, and so on. DuckDB's ``round`` on
doubles differs in the last digit, so two-digit ratios are rounded as decimals.
"""

from __future__ import annotations

from adloom import catalog
from adloom.fixtures import AS_OF, with_views
from adloom.functions.calendar import Period, day_periods, month_periods

DAY = f"date '{AS_OF.isoformat()}'"
MEASURES = ["impressions", "clicks", "ad_spend", "ads_sale", "ads_units"]
KEYS = "account_name, campaignId, ad_group_id, keyword_id"


def _id(column: str) -> str:
    return f"split_part(cast({column} as varchar), '.', 1)"


def _ratio(num: str, den: str, factor: int = 1, digits: int | None = None) -> str:
    top = f"cast({num} * {factor} as double)" if factor != 1 else f"cast({num} as double)"
    value = f"{top} / cast({den} as double)"
    if digits == 0:
        value = f"round({value}, 0)"
    elif digits is not None:
        value = f"cast(round(cast({value} as decimal(28,10)), {digits}) as double)"
    return f"case when {den} <> 0 then {value} else 0.0 end"


def _fact_part(view: str, keyword_id: str, keyword: str, search: str, sale: str, units: str, match: str, kt: str) -> str:
    return f"""select account_name, {_id('campaignId')} as campaignId, campaignName as campaign_name,
  {_id('adGroupId')} as ad_group_id, adGroupName as ad_group_name, {_id(keyword_id)} as keyword_id,
  {keyword} as keyword, {search} as search_term, cast(date as date) as date, impressions, clicks,
  cost as ad_spend, {sale} as ads_sale, {units} as ads_units, {match} as match_type, '{kt}' as kt_type from {view}"""


FACT = "\nunion all\n".join(
    [
        _fact_part("sp_search_term", "keywordId", "targeting", "searchTerm", "sales30d", "unitsSoldSameSku1d", "matchType", "targeting_id"),
        _fact_part("sb_search_term", "keywordId", "keywordText", "searchTerm", "sales", "unitsSold", "matchType", "keyword_id"),
        _fact_part("sd_targeting", "targetingId", "targetingText", "'not_applicable'", "sales", "unitsSold", "'DSP TGT'", "targeting_id"),
    ]
)

TYPED = """select *, case
    when match_type = 'TARGETING_EXPRESSION' and keyword like '%asin=%' then 'PT EXACT'
    when match_type = 'TARGETING_EXPRESSION' and keyword like '%category=%' then 'PT CAT'
    when match_type = 'TARGETING_EXPRESSION' and keyword like '%asin-expanded=%' then 'PT EXP'
    when match_type = 'TARGETING_EXPRESSION_PREDEFINED' then upper(keyword)
    else match_type end as new_match_type from o_fact"""

MATCH_LABEL = """case lower(new_match_type) when 'close-match' then 'CLOSE' when 'complements' then 'COMP'
    when 'substitutes' then 'SUB' when 'loose-match' then 'LOOSE' else new_match_type end"""

ASIN = """case when keyword like '%asin=%' or keyword like '%asin-expanded=%'
    then replace(split_part(keyword, '=', 2), '"', '') end"""


def _pattern(column: str) -> str:
    return f"""select account_name, '(?i)(' || string_agg('\\Q' || name || '\\E', '|' order by name) || ')' as pattern
    from (select distinct account_name, {column} as name from competitors where {column} is not null and {column} <> '') t
    group by account_name"""


FLAGGED = f"""select f.*, {ASIN} as asin_extracted, regexp_matches(f.keyword, own.pattern) as bd_brand,
    regexp_matches(f.keyword, rival.pattern) as ba_brand
    from o_typed f left join o_own own on f.account_name = own.account_name
    left join o_rival rival on f.account_name = rival.account_name"""

STRATEGY = """select f.*, case when f.asin_extracted = a.our_asins or f.bd_brand then 'BD'
    when f.ba_brand or (f.asin_extracted is not null and (f.asin_extracted <> a.our_asins or a.our_asins is null)) then 'BA'
    else 'GENERIC' end as strategy
    from o_flagged f left join (select distinct account_name, our_asins from competitors where our_asins is not null) a
    on f.account_name = a.account_name and f.asin_extracted = a.our_asins"""

TARGET_DIM = """select campaign_id, target_group from (
    select campaign_id, target_group, row_number() over (partition by campaign_id order by target_group nulls first) as rn from (
      select cast(campaignId as varchar) as campaign_id, case upper(targetType) when 'PRODUCT' then 'PT' when 'KEYWORD' then 'KT'
        when 'AUTO' then 'AT' when 'THEME' then 'AT' when 'PRODUCT_CATEGORY' then 'CT' when 'AUDIENCE' then 'ADT'
        else case when upper(targetType) in ('PRODUCT_CATEGORY_AUDIENCE', 'PRODUCT_AUDIENCE') and upper(targetDetails_event) = 'PURCHASES' then 'PR'
          when upper(targetType) in ('PRODUCT_CATEGORY_AUDIENCE', 'PRODUCT_AUDIENCE') and upper(targetDetails_event) = 'VIEWS' then 'VR'
          else 'Not Applicable' end end as target_group from targets) t) u where rn = 1"""

ADS_TYPED = """select account_name, cast(campaignId as varchar) as campaign_id, case
      when adProduct = 'SPONSORED_PRODUCTS' then 'SP'
      when adProduct = 'SPONSORED_BRANDS' and adType in ('BRAND_VIDEO', 'VIDEO') then 'SBV'
      when adProduct = 'SPONSORED_BRANDS' and adType = 'PRODUCT_COLLECTION' then 'SBB'
      when adProduct = 'SPONSORED_BRANDS' and adType = 'STORE_SPOTLIGHT' then 'SBS'
      when adProduct = 'SPONSORED_DISPLAY' and adType = 'IMAGE' then 'SDI'
      when adProduct = 'SPONSORED_DISPLAY' and adType = 'PRODUCT_AD' then 'SDP'
      when adProduct = 'SPONSORED_DISPLAY' and adType = 'VIDEO' then 'SDV'
      else 'Not Applicable' end as ads_type, state, creative_products from ads"""

ADS_DIM = """select campaign_id, ads_type, state as "CAMP STATUS" from (
    select *, row_number() over (partition by campaign_id order by ads_type nulls first, state nulls first) as rn from o_ads_typed) t where rn = 1"""

ACCOUNT_ADS = """select account_name, campaign_id, ads_type, state, creative_products from (
    select *, row_number() over (partition by campaign_id order by account_name nulls first, ads_type nulls first,
      state nulls first, creative_products nulls first) as rn from o_ads_typed) t where rn = 1"""

PORTFOLIO_DIM = """select cast(c.campaignId as varchar) as campaign_id, c.name as campaign_name,
    cast(p.portfolioId as varchar) as portfolioId, p.name as portfolio_name
    from (select campaignId, min(portfolioId) as portfolioId, min(name) as name from campaigns group by campaignId) c
    left join (select portfolioId, min(name) as name from portfolios group by portfolioId) p on c.portfolioId = p.portfolioId"""

INFO = """select campaign_id, target_group as targeting_type, ads_type, "CAMP STATUS"
    from o_target_dim full join o_ads_dim using (campaign_id)"""

LATEST_BID = """select keyword_id, bid, cast(updated_date as date) as bid_tym from (
    select *, row_number() over (partition by keyword_id order by updated_date desc, bid) as rn from bid_values) t where rn = 1"""


def _campaign_ratios(spend: str, sale: str, clicks: str, units: str) -> str:
    return f"""coalesce({_ratio(spend, clicks, 1, 0)}, 0) as CPC, coalesce({_ratio(sale, spend, 1, 0)}, 0) as ROI,
  {_ratio(spend, sale, 100, 0)} as ACOS, coalesce({_ratio(units, clicks, 100, 0)}, 0) as CVR"""


REPORT = f"""select f.campaignId as campaign_id, f.keyword_id, f.account_name as "ACCOUNT NAME", f.campaign_name as CAMPAIGNS,
  f.ad_group_id, f.ad_group_name as "AD GRP", f.keyword as KEYWORD, f.search_term as "SEARCH TERM", f.date as DATE,
  coalesce(f.impressions, 0) as IMPRSN, coalesce(f.clicks, 0) as CLICKS, coalesce(f.ad_spend, 0) as SPEND,
  coalesce(f.ads_sale, 0) as SALES, coalesce(f.ads_units, 0) as UNITS, f.new_match_type, f.strategy as STRATEGY,
  coalesce(b.bid, 0) as bid, b.bid_tym as "BID TYM", p.portfolio_name as PORTFOLIOS, i.targeting_type as "TARGETING TYP",
  i.ads_type as "ADS TYP", i."CAMP STATUS" as "CAMP STATUS", {_campaign_ratios('f.ad_spend', 'f.ads_sale', 'f.clicks', 'f.ads_units')},
  {MATCH_LABEL} as "MATCH TYP"
  from o_strategy f left join o_latest_bid b on f.keyword_id = b.keyword_id
  left join o_portfolio_dim p on f.campaignId = p.campaign_id left join o_info i on p.campaign_id = i.campaign_id"""


def _labels(levels: list[tuple[str, str, tuple[str, ...]]]) -> dict[str, str]:
    """Label expression of each masked column, as windows over the rows themselves."""
    out = {}
    for name, prefix, parents in levels:
        over = f"order by \"{name}\" nulls first"
        if parents:
            over = "partition by " + ", ".join(f'"{p}"' for p in parents) + " " + over
        known = " and ".join(f'"{c}" is not null' for c in (*parents, name))
        out[name] = f"case when {known} then '{prefix}' || dense_rank() over ({over}) end"
    return out


def _masked(table: str, columns: dict[str, str], text: set[str], levels, tenant_column: str) -> str:
    """Masked rows of ``table``; ``columns`` maps output names to expressions over masked text."""
    replaced = ", ".join(
        f"regexp_replace(\"{c}\", '(?i)\\b{catalog.TENANT}\\b', 'Dummy', 'g') as \"{c}\"" if c in text else f'"{c}"'
        for c in columns
    )
    labels = _labels(levels)
    shown = ", ".join(f'{labels.get(c, e)} as "{c}"' for c, e in columns.items())
    return f"select {shown} from (select {replaced} from {table} where \"{tenant_column}\" = '{catalog.TENANT}') m"


REPORT_TEXT = {
    "campaign_id", "keyword_id", "ACCOUNT NAME", "CAMPAIGNS", "ad_group_id", "AD GRP", "KEYWORD", "SEARCH TERM",
    "new_match_type", "STRATEGY", "PORTFOLIOS", "TARGETING TYP", "ADS TYP", "CAMP STATUS", "MATCH TYP",
}
REPORT_ORDER = [
    "campaign_id", "keyword_id", "ACCOUNT NAME", "CAMPAIGNS", "ad_group_id", "AD GRP", "KEYWORD", "SEARCH TERM", "DATE",
    "IMPRSN", "CLICKS", "SPEND", "SALES", "UNITS", "new_match_type", "STRATEGY", "bid", "BID TYM", "PORTFOLIOS",
    "TARGETING TYP", "ADS TYP", "CAMP STATUS", "CPC", "ROI", "ACOS", "CVR", "MATCH TYP",
]
DOUBLES = {"SPEND", "SALES", "bid", "CPC", "ROI", "ACOS", "CVR"}
CAMPAIGN_LEVELS = [
    ("PORTFOLIOS", "portfolio", ()),
    ("CAMPAIGNS", "campaign", ("PORTFOLIOS",)),
    ("AD GRP", "adgroup", ("PORTFOLIOS", "CAMPAIGNS")),
    ("KEYWORD", "keyword", ("PORTFOLIOS", "CAMPAIGNS", "AD GRP")),
]


def _as_double(expression: str, name: str, doubles: set[str]) -> str:
    return f"cast({expression} as double)" if name in doubles else expression


def _select(table: str, names: list[str], doubles: set[str]) -> str:
    shown = ", ".join(f'{_as_double(chr(34) + n + chr(34), n, doubles)} as "{n}"' for n in names)
    return f"select {shown} from {table}"


def _masked_report() -> str:
    columns = {n: f'"{n}"' for n in REPORT_ORDER}
    scaled = {m: f"({m} * 5)" for m in ("IMPRSN", "CLICKS", "SPEND", "SALES", "UNITS")}
    columns.update(scaled)
    spend, sale, clicks, units = (scaled[m] for m in ("SPEND", "SALES", "CLICKS", "UNITS"))
    columns["CPC"] = _ratio(spend, clicks, 1, 0)
    columns["ROI"] = _ratio(sale, spend, 1, 0)
    columns["ACOS"] = _ratio(spend, sale, 100, 0)
    columns["CVR"] = _ratio(units, clicks, 100, 0)
    columns = {n: _as_double(e, n, DOUBLES) for n, e in columns.items()}
    return _masked("o_report", columns, REPORT_TEXT, CAMPAIGN_LEVELS, "ACCOUNT NAME")


def _held(p: Period) -> str:
    after = f"date >= date '{p.start}'"
    return after if p.end is None else f"{after} and date <= date '{p.end}'"


def _sums(periods: list[Period]) -> str:
    """Rounded sums per period, missing ones 0."""
    out = []
    for p in periods:
        for m in MEASURES:
            kind = "decimal(38,0)" if m in ("ad_spend", "ads_sale") else "bigint"
            out.append(
                f"cast(coalesce(round(sum({m}) filter (where {_held(p)}), 0), 0) as {kind}) as {m}_{p.name}"
            )
    return ",\n  ".join(out)


def _metrics(periods: list[Period], digits: int | None) -> str:
    """The ten output metrics of each period over the columns of :func:`_sums`."""
    out = []
    for p in periods:
        n = p.name
        out += [f"{_as_double(f'{m}_{n}', m, {'ad_spend', 'ads_sale'})} as {m}_{n}" for m in MEASURES]
        out += [
            f"{_ratio(f'ad_spend_{n}', f'clicks_{n}', 1, digits)} as CPC_{n}",
            f"{_ratio(f'ad_spend_{n}', f'ads_units_{n}', 1, digits)} as CPA_{n}",
            f"{_ratio(f'ad_spend_{n}', f'ads_sale_{n}', 100, digits)} as ACOS_{n}",
            f"{_ratio(f'ads_units_{n}', f'clicks_{n}', 100, digits)} as CVR_{n}",
            f"{_ratio(f'clicks_{n}', f'impressions_{n}', 100, digits)} as CTR_{n}",
        ]
    return ",\n  ".join(out)


def _any(periods: list[Period]) -> str:
    return " or ".join(f"({_held(p)})" for p in periods)


def _period_query(periods: list[Period], digits: int | None) -> str:
    return f"""select {KEYS}, {_metrics(periods, digits)} from (
    select {KEYS}, {_sums(periods)} from o_fact where {_any(periods)} group by {KEYS}) t"""


DAYS = day_periods(AS_OF)
MONTHS = month_periods(AS_OF)
ALL = DAYS + MONTHS

# Period sums, one description per key, ads (inner), bids, campaign attributes and targets.
BASE = f"""select s.*, d.ad_group_name, d.kt_type, d.keyword, d.new_match_type, a.ads_type, a.creative_products,
    b.bid, b.bid_tym, p.portfolioId, p.portfolio_name, p.campaign_name, g.target_group as targeting_type,
    cast(coalesce(tc.target_acos, ta.target_acos) as float) as target_acos
  from (select {KEYS}, {_sums(ALL)} from o_typed where {_any(ALL)} group by {KEYS}) s
  join (select * from (select {KEYS}, ad_group_name, kt_type, keyword, new_match_type, row_number() over (partition by {KEYS}
      order by ad_group_name nulls first, kt_type nulls first, keyword nulls first, new_match_type nulls first) as rn
      from o_typed where {_any(ALL)}) x where rn = 1) d using ({KEYS})
  join o_account_ads a on s.account_name = a.account_name and s.campaignId = a.campaign_id
  left join o_latest_bid b on s.keyword_id = b.keyword_id
  left join o_portfolio_dim p on s.campaignId = p.campaign_id
  left join o_target_dim g on p.campaign_id = g.campaign_id
  left join (select campaign_name, min(target_acos) as target_acos from target_info group by 1) tc on p.campaign_name = tc.campaign_name
  left join account_settings ta on s.account_name = ta.account_name"""

SALE = "ads_sale_last_60_days"


def _ranked(partition: str) -> str:
    return f"""select *, cast(cum as double) / nullif(cast(total as double), 0) as share from (
    select *, sum({SALE}) over (partition by {partition} order by {SALE} desc) as cum,
      sum({SALE}) over (partition by portfolio_name) as total from o_base) r"""


PRIORITY = f"case when {SALE} = 0 then -1 when share <= 0.8 then 1 else 0 end"


def _pareto_query(partition: str) -> str:
    return f"""select {KEYS}, portfolio_name, cast({SALE} as double) as {SALE}, cast(cum as double) as cumulative_sales,
  cast(total as double) as total_sales_portfolio, share as cumulative_percent, {PRIORITY} as priority_index
  from ({_ranked(partition)}) t"""


KEYWORD_REPORT = f"""select account_name, portfolioId, portfolio_name, ads_type, campaignId, campaign_name, ad_group_id,
  ad_group_name, kt_type, keyword_id, keyword, new_match_type, targeting_type, cast(bid as double) as bid, bid_tym,
  creative_products, cast(target_acos as double) as target_acos, {PRIORITY} as priority_index, {_metrics(ALL, 2)},
  cast(cum as double) as cumulative_sales, cast(total as double) as total_sales_portfolio, share as cumulative_percent
  from ({_ranked('portfolio_name, keyword_id')}) t"""

BIDS = f"""select {KEYS}, replace(keyword, '+', '*') as keyword, portfolio_name, cast(target_acos as double) as target_acos,
  acos as ACOS_last_14_days, clicks_last_60_days, cpc as CPC_last_60_days,
  case when n_ratio >= 0.01 and n_ratio < 0.5 then cpc * (1 + 10.0 / 100)
    when lower(trim(coalesce(portfolio_name, ''))) in ('nation_1', 'nation_2') and n_ratio >= 0.5 and n_ratio < 1 then cpc * (1 + 5.0 / 100)
    when n_ratio < 0.01 and clicks_last_60_days >= 5 then cpc * (1 + -50.0 / 100)
    when clicks_last_60_days >= 1 and clicks_last_60_days < 5 then cpc
    when n_ratio >= 1 then case when is_inf then 0.0 when ratio > 0 then cpc / ratio else cpc end
  end as suggested_bid,
  case when is_inf then -1.0 else n_ratio end as Acos_ratio
  from (select *, is_inf_ratio as is_inf, case when is_inf_ratio then 1e300 else coalesce(ratio, 0.0) end as n_ratio from (
    select *, target_acos = 0 and acos > 0 as is_inf_ratio,
      case when target_acos <> 0 then acos / cast(target_acos as double) end as ratio from (
      select *, {_ratio('ad_spend_last_14_days', 'ads_sale_last_14_days', 100)} as acos,
        {_ratio('ad_spend_last_60_days', 'clicks_last_60_days')} as cpc from o_base) a) b) c"""

ADVERTISED = f"""select account_name, advertisedAsin as asin, {_id('campaignId')} as campaign_id, campaignName as campaign_name,
    adGroupName as ad_group_name, cast(date as date) as date, impressions, clicks, spend, sales30d as sales, unitsSoldClicks30d as units from sp_advertised
  union all select account_name, purchasedAsin, {_id('campaignId')}, campaignName, adGroupName, cast(date as date),
    null, null, null, sales14d, unitsSold14d from sb_purchased
  union all select account_name, promotedAsin, {_id('campaignId')}, campaignName, adGroupName, cast(date as date),
    impressions, clicks, cost, sales, unitsSold from sd_advertised"""

ASIN_ORDER = ["ACCOUNT NAME", "ASINS", "PORTFOLIOS", "CAMPAIGNS", "AD GRP", "DATE", "IMPRSN", "CLICKS", "SPEND", "SALES", "UNITS"]
ASIN_REPORT = """select a.account_name as "ACCOUNT NAME", a.asin as ASINS, p.portfolio_name as PORTFOLIOS,
  a.campaign_name as CAMPAIGNS, a.ad_group_name as "AD GRP", a.date as DATE,
  cast(coalesce(a.impressions, 0) as int) as IMPRSN, cast(coalesce(a.clicks, 0) as int) as CLICKS,
  cast(trunc(coalesce(a.spend, 0)) as int) as SPEND, cast(trunc(coalesce(a.sales, 0)) as int) as SALES,
  cast(coalesce(a.units, 0) as int) as UNITS
  from o_advertised a full join o_portfolio_dim p on a.campaign_id = p.campaign_id"""


def _masked_asin() -> str:
    columns = {n: f'"{n}"' for n in ASIN_ORDER}
    columns.update({m: f"cast({m} as double) * 5" for m in ("IMPRSN", "CLICKS", "SPEND", "SALES", "UNITS")})
    text = {"ACCOUNT NAME", "ASINS", "PORTFOLIOS", "CAMPAIGNS", "AD GRP"}
    levels = [("ASINS", "asin", ()), *CAMPAIGN_LEVELS[:3]]
    masked = _masked("o_asin_report", columns, text, levels, "ACCOUNT NAME")
    real = _select("o_asin_report", ASIN_ORDER, {"IMPRSN", "CLICKS", "SPEND", "SALES", "UNITS"})
    return f"{real}\nunion all\n{masked}"


BID_REPORT = """select p.campaign_id, p.portfolio_name as PORTFOLIOS, cast(b.updated_date as date) as DATE, k.keyword as KEYWORD,
  b.bid, b.keyword_id, b.account_name as "ACCOUNT NAME"
  from (select distinct keyword_id, bid, updated_date, account_name from bid_values) b
  left join (select distinct keyword_id, account_name, campaign_name, keyword, campaignId from o_fact) k
    on b.keyword_id = k.keyword_id and b.account_name = k.account_name
  left join o_portfolio_dim p on k.campaignId = p.campaign_id"""
BID_ORDER = ["campaign_id", "PORTFOLIOS", "DATE", "KEYWORD", "bid", "keyword_id", "ACCOUNT NAME"]


def _masked_bid() -> str:
    columns = {n: _as_double(f'"{n}"', n, {"bid"}) for n in BID_ORDER}
    text = {"campaign_id", "PORTFOLIOS", "KEYWORD", "keyword_id", "ACCOUNT NAME"}
    masked = _masked("o_bid_report", columns, text, CAMPAIGN_LEVELS[:1], "ACCOUNT NAME")
    return f"{_select('o_bid_report', BID_ORDER, {'bid'})}\nunion all\n{masked}"


STEPS = {
    "o_fact": FACT,
    "o_typed": TYPED,
    "o_own": _pattern("our_brand_name"),
    "o_rival": _pattern("competitor_brand_name"),
    "o_flagged": FLAGGED,
    "o_strategy": STRATEGY,
    "o_own_aliases": _pattern("replace(our_brand_name, 'small', 'all')"),
    "o_flagged_aliases": FLAGGED.replace("o_own own", "o_own_aliases own"),
    "o_strategy_aliases": STRATEGY.replace("o_flagged f", "o_flagged_aliases f"),
    "o_target_dim": TARGET_DIM,
    "o_ads_typed": ADS_TYPED,
    "o_ads_dim": ADS_DIM,
    "o_account_ads": ACCOUNT_ADS,
    "o_portfolio_dim": PORTFOLIO_DIM,
    "o_info": INFO,
    "o_latest_bid": LATEST_BID,
    "o_report": REPORT,
    "o_base": BASE,
    "o_advertised": ADVERTISED,
    "o_asin_report": ASIN_REPORT,
    "o_bid_report": BID_REPORT,
}


def _query(body: str) -> str:
    """``body`` behind the steps and fixture views it uses."""
    needed: set[str] = set()
    queue = [body]
    while queue:
        sql = queue.pop()
        for name, step in STEPS.items():
            if name not in needed and name in sql.replace('"', " ").replace("(", " ").replace(")", " ").split():
                needed.add(name)
                queue.append(step)
    steps = [f"{name} as ({step})" for name, step in STEPS.items() if name in needed]
    return with_views("with " + ",\n".join(steps) + "\n" + body if steps else body)


def _coerced(num: str, den: str, factor: int = 1) -> str:
    top, bottom = f"try_cast({num} as double)", f"try_cast({den} as double)"
    times = f" * {factor}" if factor != 1 else ""
    return f"coalesce(case when {bottom} <> 0 then {top} / {bottom}{times} end, 0.0)"


def _magnitude(kind: str) -> str:
    number = "try_cast(regexp_extract(t, '^([+-]?(\\d+\\.?\\d*|\\.\\d+))\\s*([a-z]*)$', 1) as decimal(28,6))"
    unit = "regexp_extract(t, '^([+-]?(\\d+\\.?\\d*|\\.\\d+))\\s*([a-z]*)$', 3)"
    factor = f"""case {unit} when '' then 1 when 'units' then 1 when 'k' then 1000 when 'lakh' then 100000 when 'lakhs' then 100000
      when 'm' then 1000000 when 'cr' then 10000000 when 'crore' then 10000000 when 'crores' then 10000000 end"""
    return f"cast({number} * {factor} as {kind})"


def sql() -> dict[str, str]:
    """DuckDB SQL per registered query."""
    money = "cast(ad_spend as double) as ad_spend, cast(ads_sale as double) as ads_sale"
    names = "account_name, campaignId, campaign_name, ad_group_id, ad_group_name, keyword_id, keyword, search_term, date"
    daily_keys = "account_name, campaignId, ad_group_id, ad_group_name, kt_type, keyword_id, keyword, new_match_type, date"
    daily = "select date, cast(sum(clicks) as bigint) as clicks, cast(sum(ad_spend) as double) as ad_spend from o_fact group by date"
    bodies = {
        "q01_canonical_fact": f"select {names}, impressions, clicks, {money}, ads_units, match_type, kt_type from o_fact",
        "q02_match_type": f"select campaignId, keyword_id, date, keyword, match_type, new_match_type, {MATCH_LABEL} as match_label from o_typed",
        "q03_asin_extract": f"select account_name, keyword_id, keyword, {ASIN} as asin_extracted from o_fact",
        "q04_brand_pattern": "select account_name, keyword_id, keyword, bd_brand, ba_brand from o_flagged",
        "q05_strategy": "select account_name, campaignId, keyword_id, keyword, date, strategy from o_strategy",
        "q06_campaign_strategy": """select campaign_id, targeting_type, ads_type, "CAMP STATUS", coalesce(strategy_camp, 'Not Applicable') as strategy_camp
          from o_info full join (select campaignId as campaign_id, case when sum(case when strategy = 'GENERIC' then 1 else 0 end) > 0 then 'GENERIC'
            when sum(case when strategy = 'BA' then 1 else 0 end) = count(*) then 'BA'
            when sum(case when strategy = 'BD' then 1 else 0 end) = count(*) then 'BD' else 'Not Applicable' end as strategy_camp
            from o_strategy group by campaignId) s using (campaign_id)""",
        "q07_target_group": "select campaign_id, target_group from o_target_dim",
        "q08_ads_type": 'select campaign_id, ads_type, "CAMP STATUS" from o_ads_dim',
        "q09_latest_bid": """select f.keyword_id, f.campaignId, f.date, cast(b.bid as double) as bid, b.bid_tym
          from o_fact f left join o_latest_bid b on f.keyword_id = b.keyword_id""",
        "q10_campaign_report": _select("o_report", REPORT_ORDER, DOUBLES),
        "q11_daily_keyword": f"""select {daily_keys}, cast(sum(impressions) as bigint) as impressions, cast(sum(clicks) as bigint) as clicks,
          cast(sum(ad_spend) as double) as ad_spend, cast(sum(ads_sale) as double) as ads_sale, cast(sum(ads_units) as bigint) as ads_units,
          strftime(date, '%b') as month, cast(year(date) as int) as year from o_typed group by {daily_keys}""",
        "q12_period_metrics": _period_query(DAYS, 2),
        "q13_monthly_metrics": _period_query(MONTHS, 2),
        "q14_target_acos": f"""select k.account_name, k.campaignId, k.ad_group_id, k.keyword_id, p.campaign_name, p.portfolio_name,
          g.target_group as targeting_type, cast(coalesce(tc.target_acos, ta.target_acos) as double) as target_acos
          from (select distinct {KEYS} from o_fact) k left join o_portfolio_dim p on k.campaignId = p.campaign_id
          left join o_target_dim g on p.campaign_id = g.campaign_id
          left join (select campaign_name, min(target_acos) as target_acos from target_info group by 1) tc on p.campaign_name = tc.campaign_name
          left join account_settings ta on k.account_name = ta.account_name""",
        "q15_pareto": _pareto_query("portfolio_name, keyword_id"),
        "q16_pareto_portfolio": _pareto_query("portfolio_name"),
        "q17_bid_rules": BIDS,
        "q18_mask_word": _masked(
            "o_fact",
            {c: f'"{c}"' for c in ("account_name", "campaign_name", "ad_group_name", "keyword", "date", "clicks")},
            {"account_name", "campaign_name", "ad_group_name", "keyword"},
            [],
            "account_name",
        ),
        "q19_mask_labels": "select campaign_id, keyword_id, DATE, "
        + ", ".join(f'{e} as "{c}"' for c, e in _labels(CAMPAIGN_LEVELS).items())
        + f" from (select * from o_report where \"ACCOUNT NAME\" = '{catalog.TENANT}') m",
        "q20_masked_union": _select("o_report", REPORT_ORDER, DOUBLES) + "\nunion all\n" + _masked_report(),
        "q21_asin_report": _select("o_asin_report", ASIN_ORDER, set()),
        "q22_bid_report": _select("o_bid_report", BID_ORDER, {"bid"}),
        "q23_enabled_keywords": """select distinct f.account_name, f.campaignId, f.keyword_id, f.keyword, a.ads_type, a.state as "CAMP STATUS", a.creative_products
          from o_fact f join o_account_ads a on f.account_name = a.account_name and f.campaignId = a.campaign_id where a.state = 'ENABLED'""",
        "q24_coercing_metrics": f"""select l_orderkey, l_linenumber, {_coerced('spend', 'sales', 100)} as acos,
          {_coerced('spend', 'gmv', 100)} as tacos, {_coerced('spend', 'clicks')} as cpc, {_coerced('units', 'clicks', 100)} as cvr,
          {_coerced('clicks', 'impressions', 100)} as ctr, {_coerced('gmv', 'units')} as asp, {_coerced('gmv', 'impressions', 100)} as gmv_attainment,
          {_coerced('spend', 'gmv', 100)} as spend_attainment from ({catalog.COERCE_SOURCE}) s""",
        "q25_magnitude_parse": f"""select raw, case when trim(raw) = '-' then 0 else {_magnitude('bigint')} end as whole,
          case when trim(raw) = '' then 0.0 else {_magnitude('double')} end as amount, replace(raw, ',', '') as no_commas
          from (select raw, lower(trim(replace(raw, ',', ''))) as t from ({catalog.MAGNITUDE_SOURCE}) s) u""",
        "q26_currency_clean": f"""select l_orderkey, cast(replace(replace(price, '₹', ''), ',', '') as bigint) as price,
          cast(trunc(cast(replace(cost, 'Rs.', '') as double)) as bigint) as cost, fee, tax
          from ({catalog.CURRENCY_SOURCE}) s""",
        "q27_url_ids": f"""select page_id, url, unnest(regexp_extract_all(url, '{catalog.URL_ID}', 1)) as id,
          split_part(url, '/', 4) as piece from pages""",
        "q28_calendar_days": f"""select cal.date, t.clicks, t.ad_spend from (
          select cast({DAY} - cast(n as int) as date) as date from range(15) r(n)) cal left join ({daily}) t on cal.date = t.date""",
        "q29_calendar_months": f"""select kind, start_date, end_date, cast(sum(clicks) as bigint) as clicks, cast(sum(ad_spend) as double) as ad_spend from (
          select kind, start_date, end_date, f.clicks, f.ad_spend from (
            select 'whole' as kind, cast(date_trunc('month', {DAY}) - to_months(cast(n as int)) as date) as start_date,
              last_day(cast(date_trunc('month', {DAY}) - to_months(cast(n as int)) as date)) as end_date from range(3) r(n)
            union all
            select 'running', cast(date_trunc('month', {DAY}) - to_months(cast(n as int)) as date),
              case when n = 0 then {DAY} - 1 else last_day(cast(date_trunc('month', {DAY}) - to_months(cast(n as int)) as date)) end from range(6) r(n)
          ) m left join o_fact f on f.date between m.start_date and m.end_date) x group by kind, start_date, end_date""",
        "q30_latest_snapshot": """select event_type as account_name, event_id, value, cast(ts as date) as updated_date from events e
          where cast(ts as date) = (select max(cast(ts as date)) from events x where x.event_type = e.event_type)""",
        "q31_dedupe_keyed": """select account_name, keyword_id, campaign_name, keyword, search_term from (
          select *, row_number() over (partition by account_name, keyword_id order by campaign_name nulls first, keyword nulls first, search_term nulls first) as rn
          from o_fact) t where rn = 1""",
        "q32_dedupe_full": "select distinct keyword_id, account_name, campaign_name, keyword, campaignId from o_fact",
        "q33_gather": """select distinct name as campaign_name, cast(campaignId % 40 as int) as target_acos from campaigns
          union select name, null from campaigns""",
        "q34_date_columns": f"""select o_orderkey, order_date, replace(slash_date, '/', '-') as slash_date, Odd_Date, status
          from ({catalog.DATE_SOURCE}) s""",
        "q35_mandatory_columns": """select folder, status, missing, extra, cast(count(*) as bigint) as lines
          from retail_sales join (values (0, 'mixed', 'valid', '', ''), (1, 'mixed', 'valid', '', 'payment_mode'),
            (2, 'short', 'rejected', 'store_id', 'payment_mode')) t(part, folder, status, missing, extra) on sales_person_id % 3 = part
          group by folder, status, missing, extra""",
        "q36_audit": f"""select account_name, 'account_settings' as table_name, {DAY} as updated_date, cast(null as varchar) as error from accounts
          where account_name not in (select account_name from account_settings)
          union all select account_name, 'brands', {DAY}, null from accounts
          where account_name not in (select account_name from competitors where our_brand_name <> '')
          union all select null, 'ads', {DAY}, 'no such table'""",
        "q37_table_roundtrip": f"""select account_name, date as day, cast(ad_spend as double) as spend, cast(null as varchar) as note
          from o_fact where account_name = '{catalog.TENANT}'""",
        "q38_typed_sink": _select("o_report", [n for n in REPORT_ORDER if n != "bid"], DOUBLES).replace(
            " from o_report", ", cast(cast(bid as float) as double) as bid from o_report"
        ),
        "q39_drop_folder": """select customer_id, store_id, product_name, sales_date, sales_person_id, cast(price as double) as price,
          quantity, cast(total_cost as double) as total_cost from retail_sales""",
        "q40_refresh_if_stale": f"""select keyword_id, cast(bid as double) as bid, account_name, 'new' as source, {DAY} as updated_date from bid_values
          union all select keyword_id, cast(bid as double), account_name, 'new', {DAY} from bid_values""",
        "q41_customer_mart": """select r.customer_id, cast(date_trunc('month', r.sales_date) as date) as sales_date_month,
          cast(sum(r.total_cost) as double) as total_sales, c.c_name as full_name from retail_sales r join customer c on r.customer_id = c.c_custkey
          group by r.customer_id, cast(date_trunc('month', r.sales_date) as date), c.c_name""",
        "q42_sales_mart": """select r.sales_person_id, r.store_id, cast(date_trunc('month', r.sales_date) as date) as sales_date_month,
          cast(sum(r.total_cost) as double) as total_sales, n.n_name as full_name from retail_sales r join nation n on r.sales_person_id = n.n_nationkey
          group by r.sales_person_id, r.store_id, cast(date_trunc('month', r.sales_date) as date), n.n_name""",
        "q43_asin_masked": _masked_asin(),
        "q44_bid_masked": _masked_bid(),
        "q45_valid_sales": """select customer_id, store_id, product_name, sales_date, sales_person_id, cast(price as double) as price, quantity,
          cast(total_cost as double) as total_cost, case when sales_person_id % 3 = 1 then
            'payment_mode=' || case when store_id = 121 then 'cash' else 'UPI' end end as additional_columns
          from retail_sales where sales_person_id % 3 in (0, 1)""",
        "q46_unfinished_files": """select distinct 'sales_' || l_orderkey || '.csv' as file_name from lineitem
          where l_orderkey in (select o_orderkey from orders where o_orderstatus = 'O')""",
        "q47_keyword_report": KEYWORD_REPORT,
        "q48_tied_bids": """select keyword_id, cast(bid as double) as bid, account_name, day from (
          select *, cast(updated_date as date) as day, rank() over (partition by account_name order by cast(updated_date as date) desc) as rk
          from bid_values) t where rk = 1""",
        "q49_campaign_strategy_report": """select f.account_name, f.campaignId, f.campaign_name, f.ad_group_id, f.ad_group_name, f.keyword_id,
          f.keyword, f.search_term, f.date, f.impressions, f.clicks, cast(f.ad_spend as double) as ad_spend, cast(f.ads_sale as double) as ads_sale,
          f.ads_units, f.match_type, f.new_match_type, f.strategy, cast(b.bid as double) as bid, b.bid_tym, p.portfolio_name,
          i.targeting_type, i.ads_type, i."CAMP STATUS", case when p.campaign_id is not null then coalesce(s.strategy_camp, 'Not Applicable') end as strategy_camp
          from o_strategy f left join o_latest_bid b on f.keyword_id = b.keyword_id left join o_portfolio_dim p on f.campaignId = p.campaign_id
          left join o_info i on p.campaign_id = i.campaign_id left join (select campaignId, case when bool_or(strategy = 'GENERIC') then 'GENERIC'
            when bool_and(strategy = 'BA') then 'BA' when bool_and(strategy = 'BD') then 'BD' else 'Not Applicable' end as strategy_camp
            from o_strategy group by campaignId) s on f.campaignId = s.campaignId""",
        "q50_ambiguous_targets": f"""select cast(null as varchar) as account_name, 'target_info' as table_name, {DAY} as updated_date,
          'several targets: ' || campaign_name as error from target_info where target_acos % 5 = 0""",
        "q51_rejected_lines": "select 'too many fields' as reason, cast(count(*) as bigint) as lines from campaigns",
        "q52_strategy_aliases": "select account_name, campaignId, keyword_id, keyword, date, strategy from o_strategy_aliases",
        "q53_bid_coverage": f"""select account_name, count(suggested_bid) as with_bid, count(*) as total from ({BIDS}) s
          group by account_name""",
        "q54_staged_files": """select keyword_id, cast(bid as double) as bid, account_name, kind
          from bid_values cross join (values ('staged'), ('stamped')) t(kind)""",
        "q55_replaced_day": """select cast(updated_date as date) as updated_date, count(*) as bids,
          case when cast(updated_date as date) = (select max(cast(updated_date as date)) from bid_values) then 'new' else 'old' end as source,
          cast(updated_date as date) <> (select max(cast(updated_date as date)) from bid_values) as stayed
          from bid_values group by cast(updated_date as date)""",
        "q56_daily_store": _period_query(DAYS, 2),
        "q57_bucketed_bids": _select("o_bid_report", BID_ORDER, {"bid"}),
        "q58_title_headers": f"""select account_name, place, header, cast(total as double) as total from (
          select account_name, unnest([0, 1, 2, 3, 4]) as place, unnest(['Ad Spend', 'Impressions', 'Clicks', 'Ads Sale', 'Ads Units']) as header,
            unnest([sum(cast(ad_spend as decimal(28,2))), sum(cast(impressions as decimal(28,2))), sum(cast(clicks as decimal(28,2))),
              sum(cast(ads_sale as decimal(28,2))), sum(cast(ads_units as decimal(28,2)))]) as total from o_fact group by account_name) t""",
        "q59_row_counts": "select 'fact' as name, count(*) as n from o_fact union all select 'ads', count(*) from ads",
        "q60_audit_table": f"""select account_name, table_name, {DAY} as updated_date, cast(null as varchar) as error, run from (
          select account_name, 'account_settings' as table_name, 'first' as run from accounts where account_name not in (select account_name from account_settings)
          union all select account_name, 'brands', run from accounts cross join (values ('first'), ('second')) r(run)
          where account_name not in (select account_name from competitors where our_brand_name <> '')) t""",
    }
    return {name: _query(body) for name, body in bodies.items()}
