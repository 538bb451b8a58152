from __future__ import annotations

import random
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from adloom.functions import calendar
from adloom.operators import (
    canonical,
    cleaning,
    dedupe,
    enrich,
    joins,
    marts,
    masking,
    pareto,
    periods,
    quality,
    rules,
    strategy,
)


def test_keyed_dedupe_is_deterministic(spark, rows):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 9), (1, None, 5), (2, "z", 1)], "k int, s string, n int")
    assert rows(dedupe.dedupe(df, ["k"])) == [(1, None, 5), (2, "z", 1)]
    assert rows(dedupe.dedupe(df, ["k"], [F.col("n").desc()])) == [(1, "a", 9), (2, "z", 1)]
    assert rows(dedupe.dedupe(df.union(df))) == rows(df)


def test_latest_per_key_ties(spark, rows):
    df = spark.createDataFrame([("k", 1, 10), ("k", 2, 10), ("k", 3, 9)], "k string, bid int, t int")
    assert rows(dedupe.latest_per_key(df, ["k"], "t")) == [("k", 1, 10)]
    assert rows(dedupe.latest_per_key(df, ["k"], "t", ties=True)) == [("k", 1, 10), ("k", 2, 10)]
    undated = spark.createDataFrame([("k", 1, None), (None, 2, None), (None, 3, 5)], "k string, bid int, t int")
    assert rows(dedupe.latest_per_key(undated, ["k"], "t", ties=True)) == [("k", 1, None), (None, 3, 5)]


def test_latest_snapshot_per_account(spark, rows):
    data = [("a", 1, "2024-01-01"), ("a", 2, "2024-01-02"), ("a", 3, "2024-01-02"), ("b", 4, "2023-01-01"), (None, 5, None)]
    df = spark.createDataFrame(data, "acc string, v int, d string")
    assert [r[1] for r in rows(dedupe.latest_snapshot(df, "acc", "d"))] == [2, 3, 4]


def test_size_check_broadcasts_only_what_fits(spark):
    small, big = spark.range(10).toDF("k"), spark.range(1000).toDF("k")
    a, b = joins.size_checked(small, big, max_rows=100)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = spark.range(50).toDF("k")
        assert "BroadcastHashJoin" in left.join(a, "k")._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in left.join(b, "k")._jdf.queryExecution().executedPlan().toString()
        assert left.join(a, "k").count() == 10 and left.join(b, "k").count() == 50
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_null_safe_join(spark, rows):
    left = spark.createDataFrame([(None, 1), ("a", 2), ("b", 3)], "k string, x int")
    right = spark.createDataFrame([(None, 10), ("a", 20)], "k string, y int")
    assert rows(joins.join_null_safe(left, right, ["k"])) == [("a", 2, 20), ("b", 3, None), (None, 1, 10)]


def test_spread_nulls_never_equals_a_real_key(spark):
    df = spark.createDataFrame([(None, i) for i in range(200)] + [("a", 0)], "k string, i int")
    keys = [r[0] for r in df.select(joins.spread_nulls(F.col("k"), F.col("i"))).collect()]
    assert keys[-1] == "a" and len(set(keys)) > 100 and all(k.startswith("\0") for k in keys[:-1])


def _sources(spark):
    sp = spark.createDataFrame(
        [("acc", 11.0, "c", "2.0", "g", "3", "kw", "term", "2024-01-02", 10, 2, Decimal("1.50"), Decimal("9.00"), 1, "EXACT")],
        "account_name string, campaignId double, campaignName string, adGroupId string, adGroupName string, keywordId string, "
        "targeting string, searchTerm string, date string, impressions int, clicks int, cost decimal(18,2), "
        "sales30d decimal(18,2), unitsSoldSameSku1d int, matchType string",
    )
    sb = sp.withColumnsRenamed({"targeting": "keywordText", "sales30d": "sales", "unitsSoldSameSku1d": "unitsSold"})
    sd = sb.withColumnsRenamed({"keywordId": "targetingId", "keywordText": "targetingText"}).drop("searchTerm", "matchType")
    return sp, sb, sd


def test_canonical_fact_of_three_products(spark):
    fact = canonical.canonical_fact(*_sources(spark))
    assert fact.columns == canonical.FACT_COLUMNS
    got = fact.collect()
    assert {(r.campaignId, r.ad_group_id, r.keyword_id, r.date) for r in got} == {("11", "2", "3", date(2024, 1, 2))}
    assert sorted((r.kt_type, r.search_term, r.match_type) for r in got) == [
        ("keyword_id", "term", "EXACT"),
        ("targeting_id", "not_applicable", "DSP TGT"),
        ("targeting_id", "term", "EXACT"),
    ]


def test_stamp_keeps_existing_columns(spark):
    df = spark.createDataFrame([("x", date(2020, 1, 1))], "a string, updated_date date")
    out = canonical.stamp(df, date(2024, 1, 1), account_name="t").first()
    assert (out.updated_date, out.account_name) == (date(2020, 1, 1), "t")


COMPETITORS = [
    ("a", "P1", "Red", "Blue"),
    ("a", "P1", "Red", "old (bolt"),
    ("a", None, "", None),
    ("b", "P2", None, "Blue"),
    ("c", None, "", None),
]
COMPETITOR_SCHEMA = "account_name string, our_asins string, our_brand_name string, competitor_brand_name string"


def test_brand_names_skip_blanks(spark, rows):
    df = spark.createDataFrame(COMPETITORS, COMPETITOR_SCHEMA)
    assert rows(strategy.brand_names(df, "our_brand_name")) == [("a", "Red")]
    assert rows(strategy.brand_names(df, "competitor_brand_name")) == [("a", "Blue"), ("a", "old (bolt"), ("b", "Blue")]
    assert rows(strategy.brand_names(df, "our_brand_name", {"Red": "R"})) == [("a", "R")]
    assert rows(strategy.account_brands(df))[0] == ("a", "Blue", False)


def test_few_names_are_tried_row_by_row(spark, rows, monkeypatch):
    """Same flags as the lookup by parts, without dealing the fact out or reading it twice."""
    names = [("A", "Red", True), ("A", "Rot", False), ("A", "(b", False), ("B", "x\u00e9", True), (None, "Red", True)]
    names = spark.createDataFrame(names, "account_name string, name string, own boolean")
    index = strategy.name_index(names)
    words = ["a RED one", "red(B", "", None, "rot", "x\u00e9y", "plain", "plain"]
    words = [(a, w, i) for a in ("A", "B", "C", None) for i, w in enumerate(words)]
    words = spark.createDataFrame(words, "account_name string, keyword string, n int")
    tried = strategy.with_brand_flags(words, index)
    plan = tried._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan
    got = rows(tried)
    assert ("A", "red(B", 1, True, True) in got and ("B", "plain", 6, False, None) in got
    assert ("A", None, 3, None, None) in got and ("C", "rot", 4, None, None) in got
    monkeypatch.setattr(strategy, "MAX_TRIED", 1)
    assert strategy.tried_names(index[0]) is None
    assert rows(strategy.with_brand_flags(words, index)) == got


def test_brand_flags_are_null_without_brands(spark, rows):
    words = spark.createDataFrame([("a", "a RED old (BOLT"), ("a", None), ("b", "blue"), ("c", "x")], "account_name string, keyword string")
    brands = strategy.account_brands(spark.createDataFrame(COMPETITORS, COMPETITOR_SCHEMA))
    flagged = strategy.with_brand_flags(words, strategy.name_index(brands))
    assert rows(flagged) == [("a", "a RED old (BOLT", True, True), ("a", None, None, None), ("b", "blue", None, True), ("c", "x", None, None)]
    assert "RLIKE" not in flagged._jdf.queryExecution().toString()


def test_names_are_looked_up_at_a_cost_of_the_keyword(spark):
    """Ten thousand names of one account give a keyword no more parts to look up than ten do."""
    rng = random.Random(4)
    letters = "abcdefgh"
    names = sorted({"".join(rng.choices(letters, k=rng.choice([4, 5, 6]))) for _ in range(12_000)})[:10_000]
    keywords = ["".join(rng.choices(letters + " ", k=rng.randrange(0, 40))) for _ in range(300)]
    words = spark.createDataFrame([("a", k) for k in keywords], "account_name string, keyword string")
    for some in (names[:10], names):
        brands = spark.createDataFrame([("a", n.upper(), i % 2 == 0) for i, n in enumerate(some)], "account_name string, name string, own boolean")
        index = strategy.name_index(brands)
        parts = strategy.keyword_parts(words, index[1])
        assert parts.count() <= 3 * sum(max(1, len(k)) for k in set(keywords))
        got = {r.keyword: (r.bd_brand, r.ba_brand) for r in strategy.brand_flags(words, index).collect()}
        assert got == {k: tuple(any(n in k for n in some[i::2]) for i in (0, 1)) for k in keywords}


def test_a_name_that_an_alias_makes_blank_is_left_out(spark, rows):
    df = spark.createDataFrame(COMPETITORS, COMPETITOR_SCHEMA)
    assert rows(strategy.brand_names(df, "our_brand_name", {"Red": ""})) == []


@pytest.mark.parametrize(
    "account, keyword, expected",
    [
        ("a", 'asin="P1"', "BD"),
        ("a", "big RED hat", "BD"),
        ("a", "red and blue", "BD"),
        ("a", "blue hat", "BA"),
        ("a", "OLD (BOLT", "BA"),
        ("a", 'asin="P2"', "BA"),
        ("a", "hat", "GENERIC"),
        ("b", 'asin="P2"', "BD"),
        ("b", "red", "GENERIC"),
        ("c", "anything", "GENERIC"),
        ("c", 'asin="P1"', "BA"),
        ("nobody", 'asin-expanded="P1"', "BA"),
        ("a", None, "GENERIC"),
    ],
)
def test_strategy(spark, account, keyword, expected):
    fact = spark.createDataFrame([(account, keyword, "t", date(2024, 1, 1))], "account_name string, keyword string, search_term string, date date")
    competitors = spark.createDataFrame(COMPETITORS, COMPETITOR_SCHEMA)
    out = strategy.strategy_from(fact, competitors).collect()
    assert [r.strategy for r in out] == [expected]


def test_campaign_strategy(spark):
    data = [("1", "GENERIC"), ("1", "BD"), ("2", "BA"), ("2", "BA"), ("3", "BD"), ("4", "BA"), ("4", "BD")]
    df = spark.createDataFrame(data, "campaignId string, strategy string")
    got = {r.campaign_id: r.strategy_camp for r in strategy.campaign_strategy(df).collect()}
    assert got == {"1": "GENERIC", "2": "BA", "3": "BD", "4": "Not Applicable"}


def test_campaign_info_keeps_one_sided_campaigns(spark, rows):
    targets = spark.createDataFrame([(1, "KEYWORD", None)], "campaignId long, targetType string, targetDetails_event string")
    ads = spark.createDataFrame([("a", 2, "SPONSORED_PRODUCTS", None, "ENABLED", "P")], "account_name string, campaignId long, adProduct string, adType string, state string, creative_products string")
    camp = spark.createDataFrame([("3", "BA")], "campaign_id string, strategy_camp string")
    assert rows(enrich.campaign_info(targets, ads, camp)) == [
        ("1", "KT", None, None, "Not Applicable"),
        ("2", None, "SP", "ENABLED", "Not Applicable"),
        ("3", None, None, None, "BA"),
    ]


def test_target_acos_prefers_campaign_and_lowest_target(spark):
    df = spark.createDataFrame([("c1", "a"), ("c2", "a"), ("c3", "z"), (None, "a")], "campaign_name string, account_name string")
    per_campaign = spark.createDataFrame([("c1", 20), ("c1", 10)], "campaign_name string, target_acos int")
    per_account = spark.createDataFrame([("a", 50)], "account_name string, target_acos int")
    out = enrich.with_target_acos(df, per_campaign, per_account)
    assert {r.campaign_name: r.target_acos for r in out.collect()} == {"c1": 10.0, "c2": 50.0, "c3": None, None: 50.0}
    assert [r[0] for r in enrich.ambiguous_targets(per_campaign).collect()] == ["c1"]


FACT_SCHEMA = (
    "account_name string, campaignId string, ad_group_id string, keyword_id string, date date, impressions bigint, "
    "clicks bigint, ad_spend decimal(18,2), ads_sale decimal(18,2), ads_units bigint"
)


def test_period_metrics_match_one_aggregation_per_period(spark):
    rng = random.Random(7)
    as_of = date(2024, 1, 20)
    data = [
        ("a", str(rng.randrange(2)), "g", str(rng.randrange(3)), date.fromordinal(as_of.toordinal() - rng.randrange(200)),
         rng.randrange(100), rng.randrange(3), Decimal(rng.randrange(9999)) / 100, Decimal(rng.randrange(9999)) / 100, rng.randrange(3))
        for _ in range(400)
    ]
    fact = spark.createDataFrame(data, FACT_SCHEMA)
    every = calendar.day_periods(as_of) + calendar.month_periods(as_of)
    got = {tuple(r[k] for k in periods.KEYS): r for r in periods.period_metrics(fact, every).collect()}
    expected: dict = {}
    for p in every:
        for r in data:
            if p.start <= r[4] and (p.end is None or r[4] <= p.end):
                sums = expected.setdefault(r[:4], {}).setdefault(p.name, [0] * 5)
                for i in range(5):
                    sums[i] += r[5 + i]
    assert set(got) == set(expected)
    for key, by_period in expected.items():
        for p in every:
            impressions, clicks, spend, sale, units = by_period.get(p.name, [0] * 5)
            spend, sale = (Decimal(x).quantize(Decimal(1), rounding="ROUND_HALF_UP") for x in (spend, sale))
            row = got[key]
            assert row[f"clicks_{p.name}"] == clicks and row[f"ad_spend_{p.name}"] == spend
            acos = Decimal(0) if sale == 0 else (spend * 100 / sale).quantize(Decimal("0.01"), rounding="ROUND_HALF_UP")
            assert row[f"ACOS_{p.name}"] == pytest.approx(float(acos))
            ctr = 0 if impressions == 0 else float((Decimal(clicks) * 100 / impressions).quantize(Decimal("0.01"), rounding="ROUND_HALF_UP"))
            assert row[f"CTR_{p.name}"] == pytest.approx(ctr)


@pytest.mark.parametrize("band_units", [1, 3, 50, 1_000_000])
def test_running_sum_equals_range_window(spark, band_units):
    rng = random.Random(band_units)
    data = [(rng.choice(["p", "q", None]), rng.choice([None, Decimal(0), Decimal(rng.randrange(300)) / 100])) for _ in range(300)]
    data += [("hot", Decimal(0))] * 100
    df = spark.createDataFrame(data, "p string, v decimal(18,2)")
    got = {(r.p, r.v): r.running for r in pareto.running_sum(df, "v", ["p"], band_units).collect()}
    expected = df.selectExpr("p", "v", "sum(v) over (partition by p order by v desc) as s").distinct().collect()
    assert got == {(r.p, r.v): r.s for r in expected}


def test_pareto_index(spark):
    data = [("p", "k1", Decimal(70)), ("p", "k2", Decimal(20)), ("p", "k3", Decimal(10)), ("p", "k4", Decimal(0)), ("z", "k5", Decimal(0))]
    df = spark.createDataFrame(data, "portfolio_name string, keyword_id string, s decimal(28,0)")
    by_portfolio = pareto.pareto(df, "s", ["portfolio_name"], ["portfolio_name"])
    assert {r.keyword_id: (r.priority_index, r.cumulative_percent) for r in by_portfolio.collect()} == {
        "k1": (1, 0.7),
        "k2": (0, 0.9),
        "k3": (0, 1.0),
        "k4": (-1, 1.0),
        "k5": (-1, None),
    }
    by_keyword = pareto.pareto(df, "s")
    assert {r.keyword_id: r.priority_index for r in by_keyword.collect()} == {"k1": 1, "k2": 1, "k3": 1, "k4": -1, "k5": -1}
    with pytest.raises(TypeError):
        pareto.running_sum(df.withColumn("s", F.col("s").cast("double")), "s", ["portfolio_name"])


def _rule(**given):
    return {"account_name": None, "portfolio_name": None, "cpc_column_name": "CPC", "bid_change": "no change", **given}


def _rule_table(spark, rule_list):
    names = sorted({c for r in rule_list for c in r} | {"account_name", "portfolio_name", "cpc_column_name", "bid_change"})
    rows = [(i, *(r.get(c) for c in names)) for i, r in enumerate(rule_list)]
    return spark.createDataFrame(rows[::-1], "rule_no int, " + ", ".join(f"`{c}` string" for c in names))


def _bids(spark, rule_list, data, schema="account_name string, portfolio_name string, CPC double, Acos_ratio double, n bigint"):
    df = spark.createDataFrame([(*d, i) for i, d in enumerate(data)], schema + ", place int")
    out = rules.price_rows(df, _rule_table(spark, rule_list))
    return [r.suggested_bid for r in out.orderBy("place").collect()]


def test_priced_rows_are_read_where_they_lie(spark, tmp_path):
    """Rows are not stored again with all their columns, whatever the caller goes on to use."""
    schema = "account_name string, portfolio_name string, CPC double, Acos_ratio double, unused string"
    data = [("a", "x", 2.0, 1.0, "u"), ("a", None, 4.0, None, "v"), (None, "x", None, 1.0, None)]
    spark.createDataFrame(data, schema).write.parquet(str(tmp_path / "rows"))
    df = spark.read.schema(schema).parquet(str(tmp_path / "rows"))
    out = rules.price_rows(df, _rule_table(spark, [_rule(bid_change="50")]))
    assert set(df.inputFiles()) <= set(out.inputFiles())
    plan = out.select("suggested_bid")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema" in plan and "unused" not in plan
    assert sorted((r.unused or "", r.suggested_bid) for r in out.collect()) == [("", None), ("u", 3.0), ("v", 6.0)]


def test_rule_order_is_that_of_the_numbers(spark, tmp_path):
    first, second = _rule(bid_change="50"), _rule(bid_change="-50")
    table = _rule_table(spark, [first, second])
    for part in (1, 0):
        table.filter(f"rule_no = {part}").coalesce(1).write.mode("append").parquet(str(tmp_path / "rules"))
    df = spark.createDataFrame([("a", "x", 2.0, 1.0)], "account_name string, portfolio_name string, CPC double, Acos_ratio double")
    stored = spark.read.parquet(str(tmp_path / "rules"))
    assert rules.price_rows(df, stored).first().suggested_bid == 3.0
    with pytest.raises(ValueError, match="rule_no"):
        rules.price_rows(df, stored.drop("rule_no"))
    with pytest.raises(ValueError, match="number 1"):
        rules.price_rows(df, stored.union(stored.filter("rule_no = 1")))


def test_more_rules_than_any_expression_holds(spark):
    rule_list = [_rule(account_name=f"a{i}", bid_change=str(i)) for i in range(12_000)]
    assert _bids(spark, rule_list, [("a11000", "x", 1.0, 1.0, 1)]) == [111.0]


def test_first_rule_with_a_bid_wins(spark):
    data = [("a", "X ", 2.0, 0.4, 3), ("a", None, 2.0, 0.9, 3), ("a", "x", None, 0.4, 3)]
    rule_list = [
        _rule(portfolio_name=" x , y", bid_change="50"),
        _rule(bid_change="abc"),
        _rule(cpc_column_name="nope"),
        _rule(bid_change="-50"),
    ]
    assert _bids(spark, rule_list, data) == [3.0, 1.0, None]


def test_rule_ranges_are_half_open_and_unknown_columns_ignored(spark):
    data = [("a", "x", 2.0, r, 3) for r in (0.0, 0.5, 1.0, None)]
    between = _rule(**{"1_column_filter": "Acos_ratio", "1_start": "0.5", "1_end": "1"})
    assert _bids(spark, [between], data) == [None, 2.0, None, None]
    below = _rule(**{"1_column_filter": "Acos_ratio", "1_start": None, "1_end": "0.5"})
    assert _bids(spark, [below], data) == [2.0, None, None, 2.0]
    unknown = _rule(**{"1_column_filter": "gone", "1_start": "5", "1_end": "6"})
    assert _bids(spark, [unknown], data) == [2.0] * 4
    account = _rule(account_name="b")
    assert _bids(spark, [account], data) == [None] * 4
    assert _bids(spark, [], data) == [None] * 4


def _first_bid(row, rule_list):
    """Plain version: the first rule that applies and gives a bid."""
    account, portfolio, cpc, ratio, n = row
    seen = {"Acos_ratio": ratio or 0.0, "n": float(n or 0)}
    for rule in rule_list:
        listed = [p.strip() for p in (rule["portfolio_name"] or "").lower().split(",") if p.strip()]
        if rule["account_name"] not in (None, account) or listed and (portfolio or "").strip().lower() not in listed:
            continue
        for i in (1, 2):
            name, start, end = (rule[f"{i}_{k}"] for k in ("column_filter", "start", "end"))
            if name in seen and not (start is None or seen[name] >= float(start)):
                break
            if name in seen and not (end is None or seen[name] < float(end)):
                break
        else:
            if rule["cpc_column_name"] == "CPC" and cpc is not None:
                return round(cpc * (1 + float(rule["bid_change"]) / 100), 9)
    return None


def test_rules_of_one_account_match_a_plain_version(spark):
    rng = random.Random(9)

    def bound(top):
        return rng.choice([None, str(rng.randrange(top))])

    def ranges():
        out = {}
        for i in (1, 2):
            out |= {f"{i}_column_filter": rng.choice(["Acos_ratio", "n", "gone", None]), f"{i}_start": bound(30), f"{i}_end": bound(30)}
        return out

    rule_list = [
        _rule(account_name=rng.choice(["a", "b", None]), portfolio_name=rng.choice([None, "x", "x,y"]),
              cpc_column_name=rng.choice(["CPC", "CPC", "no"]), bid_change=str(i), **ranges())
        for i in range(60)
    ]
    data = [
        (rng.choice(["a", "b", "c", None]), rng.choice(["x", "Y ", "z", None]), rng.choice([1.0, None]), rng.choice([None, *range(30)]), rng.randrange(30))
        for _ in range(400)
    ]
    data = [(a, p, c, None if r is None else float(r), n) for a, p, c, r, n in data]
    got = [None if b is None else round(b, 9) for b in _bids(spark, rule_list, data)]
    assert got == [_first_bid(row, rule_list) for row in data]
    assert len(set(got)) >= 10


def test_ten_thousand_rules_of_one_account(spark):
    """Each row meets the few rules whose narrowest range holds it, and carries none of them."""
    rule_list = [
        _rule(account_name="a", bid_change=str(i), **{"1_column_filter": "n", "1_start": str(i), "1_end": str(i + 2), "2_column_filter": "Acos_ratio", "2_start": "0.5", "2_end": None})
        for i in range(10_000)
    ]
    data = [("a", "x", 1.0, i % 2, i) for i in range(0, 10_000, 7)]
    data = [(a, p, c, float(r), n) for a, p, c, r, n in data]
    got = _bids(spark, rule_list, data)
    wanted = [None if r < 0.5 else 1 + max(n - 1, 0) / 100.0 for _, _, _, r, n in data]
    assert got == pytest.approx(wanted)
    table = rules.rule_rows(_rule_table(spark, rule_list))
    bounds = rules._bounds(table, ["Acos_ratio", "n"])
    filed = rules.filed_rules(table, bounds, ["Acos_ratio", "n"], ["CPC"], 15)
    assert filed.count() <= 2 * len(rule_list)
    df = spark.createDataFrame(data, "account_name string, portfolio_name string, CPC double, Acos_ratio double, n bigint")
    held = rules.with_intervals(df, bounds, ["Acos_ratio", "n"], ["CPC"], 15)
    assert dict(held.dtypes)["__own"] == "array<int>" and max(len(r["__own"]) for r in held.collect()) == 2


def test_bounds_beyond_the_limit_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(rules, "MAX_BOUNDS", 3)
    rule_list = [_rule(**{"1_column_filter": "n", "1_start": str(i), "1_end": None}) for i in range(4)]
    with pytest.raises(ValueError, match="4 bounds"):
        _bids(spark, rule_list, [("a", "x", 1.0, 1.0, 1)])


def test_cpc_over_ratio(spark):
    data = [("a", "x", 3.0, r, 1) for r in (2.0, 0.0, None, float("inf"))]
    assert _bids(spark, [_rule(bid_change="CPC/Ratio")], data) == [1.5, 3.0, 3.0, 0.0]


def test_suggest_bids_end_to_end(spark):
    report = spark.createDataFrame(
        [("a", "p", 30.0, 20.0, 2.25), ("a", "p", 30.0, 0.0, 2.0), ("a", "p", 0.0, 0.0, 2.0), ("a", "p", 30.0, None, 2.0), ("b", "p", 1.0, 1.0, 1.0)],
        "account_name string, portfolio_name string, ACOS_last_14_days double, target_acos double, CPC double",
    )
    rule_rows = [(1, "a", "", "Acos_ratio", "1", "", "CPC", "cpc/ratio"), (2, "a", "", "", "", "", "CPC", "no change")]
    rule_df = spark.createDataFrame(rule_rows, "rule_no int, account_name string, portfolio_name string, 1_column_filter string, 1_start string, 1_end string, cpc_column_name string, bid_change string")
    out = rules.suggest_bids(report, rule_df, "a")
    got = sorted((r.Acos_ratio, r.suggested_bid) for r in out.collect())
    assert got == [(0.0, 2.0), (0.0, 2.0), (1.5, 1.5), (float("inf"), 0.0)]
    coverage = rules.bid_coverage(out).first()
    assert (coverage.with_bid, coverage.total) == (4, 4)


def test_replace_word_is_whole_word_and_case_blind(spark):
    df = spark.createDataFrame([("ACME shoes", "acmeish", 5), ("x-Acme-y", None, 6)], "a string, b string, n int")
    got = [tuple(r) for r in masking.replace_word(df, "acme").collect()]
    assert got == [("Dummy shoes", "acmeish", 5), ("x-Dummy-y", None, 6)]


LEVELS = [("P", "portfolio", ()), ("C D", "campaign", ("P",)), ("K", "keyword", ("P", "C D"))]


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_labels_equal_nested_dense_ranks(spark, partitions):
    rng = random.Random(partitions)

    def value(n):
        return rng.choice([None, *[f"v{i:02d}" for i in range(n)]])

    data = [(i, value(4), value(6), value(30)) for i in range(500)]
    df = spark.createDataFrame(data, "id int, P string, `C D` string, K string")
    got = {r.id: (r.P, r["C D"], r.K) for r in masking.pseudonymize(df, LEVELS, partitions).collect()}
    order = lambda vs: sorted(set(vs), key=lambda v: (v is not None, v or ""))
    for i, p, c, k in data:
        p_rank = order(x[1] for x in data).index(p) + 1
        c_rank = order(x[2] for x in data if x[1] == p).index(c) + 1
        k_rank = order(x[3] for x in data if x[1] == p and x[2] == c).index(k) + 1
        assert got[i] == (
            None if p is None else f"portfolio{p_rank}",
            None if p is None or c is None else f"campaign{c_rank}",
            None if None in (p, c, k) else f"keyword{k_rank}",
        )


def test_pseudonymize_two_hierarchies(spark, rows):
    df = spark.createDataFrame([("A1", "x"), ("A2", "x"), ("A2", "y")], "ASIN string, P string")
    out = masking.pseudonymize(df, [("ASIN", "asin", ()), ("P", "portfolio", ())], 2)
    assert rows(out) == [("asin1", "portfolio1"), ("asin2", "portfolio1"), ("asin2", "portfolio2")]
    with pytest.raises(ValueError):
        masking.pseudonymize(df, [("P", "p", ("ASIN",))])


def test_masked_union(spark):
    df = spark.createDataFrame([("acme", "acme one", 2), ("other", "b", 3)], "`ACCOUNT NAME` string, P string, n int")
    spec = masking.MaskSpec(levels=[("P", "portfolio", ())], measures=["n"])
    got = sorted(tuple(r) for r in masking.masked_union(df, "acme", spec).collect())
    assert got == [("Dummy", "portfolio1", 10), ("acme", "acme one", 2), ("other", "b", 3)]


def test_clean_currency_is_all_or_nothing(spark):
    df = spark.createDataFrame([("₹1,200", "1", "Rs.5", None), ("Rs.50", "x", "7.9", "1")], "a string, b string, c string, d string")
    out = cleaning.clean_currency(df)
    assert dict(out.dtypes) == {"a": "bigint", "b": "string", "c": "bigint", "d": "string"}
    assert [tuple(r) for r in out.collect()] == [(1200, "1", 5, None), (50, "x", 7, "1")]


def test_date_columns(spark):
    df = spark.createDataFrame(
        [("2024-01-02", "01/31/2024", "2024-01-02", "x", date(2024, 5, 6)), (None, "12/01/2024", "01/31/2024", "y", None)],
        "order_date string, ShipDate string, mixed_date string, note string, day_date date",
    )
    out = cleaning.normalize_date_columns(df)
    assert [tuple(r) for r in out.collect()] == [
        ("2024-01-02", "2024-01-31", "2024-01-02", "x", "2024-05-06"),
        (None, "2024-12-01", "01/31/2024", "y", None),
    ]


def test_extract_ids_and_headers(spark):
    df = spark.createDataFrame([("x /sheets/d/AA/edit y /sheets/d/BB/z",), ("none",), (None,)], "u string")
    assert [r.id for r in cleaning.extract_ids(df, "u", "/sheets/d/([^/]+)").collect()] == ["AA", "BB"]
    urls = spark.createDataFrame([("https://h/a/d/ID/edit",), ("short",)], "u string")
    assert [r[0] for r in urls.select(cleaning.path_piece("u", 5)).collect()] == ["ID", None]
    assert cleaning.title_headers(spark.createDataFrame([(1, 2)], "ad_spend int, x int")).columns == ["Ad Spend", "X"]


def test_small_frame_helpers(spark):
    df = spark.createDataFrame([(2.9, None, "t"), (-2.9, 1, None)], "a double, b int, c string")
    assert [r.a for r in cleaning.truncate_measures(df, ["a"]).collect()] == [2, -2]
    assert [tuple(r) for r in cleaning.fill_nulls(df).collect()] == [(2.9, 0, "t"), (-2.9, 1, None)]
    assert [r.c for r in cleaning.fill_nulls(df, {"c": "-"}).collect()] == ["t", "-"]
    assert cleaning.move_column(df, "c", 1).columns == ["a", "c", "b"]
    assert cleaning.report_headers(df, {"a": "AD GRP"}).columns == ["AD GRP", "b", "c"]


def _csv(tmp_path, name, text):
    path = tmp_path / name
    path.write_text(text)
    return str(path)


def test_header_check_and_valid_rows(spark, tmp_path, rows):
    from adloom.schemas import INT, STRING, struct

    schema = struct({"id": INT, "name": STRING})
    normal = _csv(tmp_path, "normal.csv", "id,name\n1,a\n")
    extra = _csv(tmp_path, "extra.csv", "name,id,mode,note\nb,2,cash,\n")
    missing = _csv(tmp_path, "missing.csv", "id,mode\n3,cash\n")
    checked = quality.check_columns(spark, [normal, extra, missing], ["id", "name"])
    assert {(r.path.rsplit("/")[-1], r.status, tuple(r.missing), tuple(r.extra)) for r in checked.collect()} == {
        ("normal.csv", "valid", (), ()),
        ("extra.csv", "valid", (), ("mode", "note")),
        ("missing.csv", "rejected", ("name",), ("mode",)),
    }
    got = rows(quality.read_valid(spark, [normal, extra, missing], schema))
    assert got == [(1, "a", None), (2, "b", "mode=cash,note=")]
    assert quality.read_valid(spark, [missing], schema).count() == 0


def test_audit_and_staging(spark, rows):
    accounts = spark.createDataFrame([("a",), ("b",)], "account_name string")
    as_of = date(2024, 1, 1)
    got = rows(quality.audit(accounts.filter("account_name = 'a'"), "t", as_of, accounts))
    assert got == [("b", "t", as_of, None)]
    assert quality.audit_error(spark, "t", ValueError("boom"), as_of).first().error == "boom"
    files = spark.createDataFrame([("f1",), ("f2",)], "file_name string")
    staging = spark.createDataFrame([("f1", "A"), ("f2", "I"), ("f2", "I"), ("f9", "I")], "file_name string, status string")
    assert rows(quality.unfinished_files(files, staging)) == [("f2",)]
    assert quality.last_run_failed(files, staging)
    assert not quality.last_run_failed(files, staging.filter("status = 'A'"))


def test_marts(spark, rows):
    sales = spark.createDataFrame(
        [(1, 121, 5, date(2024, 1, 2), Decimal("10.00")), (1, 121, 5, date(2024, 1, 30), Decimal("5.00")), (2, 122, 5, date(2024, 2, 1), Decimal("1.00"))],
        "customer_id int, store_id int, sales_person_id int, sales_date date, total_cost decimal(18,2)",
    )
    customers = spark.createDataFrame([(1, "x"), (2, "y")], "customer_id int, full_name string")
    assert rows(marts.customer_mart(sales, customers)) == [
        (1, date(2024, 1, 1), Decimal("15.00"), "x"),
        (2, date(2024, 2, 1), Decimal("1.00"), "y"),
    ]
    team = spark.createDataFrame([(5, "z")], "sales_person_id int, name string")
    assert "incentive" not in marts.sales_team_mart(sales, team).columns
    paid = marts.sales_team_mart(sales, team, F.col("total_sales") * Decimal("0.01"))
    assert sorted(float(r.incentive) for r in paid.collect()) == [0.01, 0.15]
