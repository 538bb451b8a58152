from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adloom.functions import calendar, labels, ratios, text
from adloom.functions.ids import normalize_id, to_day


def one(spark, schema, value, column):
    df = spark.createDataFrame([(v,) for v in value], schema)
    return [r[0] for r in df.select(column).collect()]


@pytest.mark.parametrize(
    "dtype, values, expected",
    [
        (T.StringType(), ["123.0", "123", "a.b.c", None], ["123", "123", "a", None]),
        (T.LongType(), [123, None], ["123", None]),
        (T.DoubleType(), [123.0, 1.23e14, None], ["123", "123000000000000", None]),
        (T.DecimalType(20, 2), [Decimal("123.00"), Decimal("7.90")], ["123", "7"]),
    ],
)
def test_normalize_id(spark, dtype, values, expected):
    schema = T.StructType([T.StructField("x", dtype)])
    assert one(spark, schema, values, normalize_id("x", dtype)) == expected


def test_to_day_reads_text_and_timestamps(spark):
    assert one(spark, "x string", ["2024-02-29", "soon", None], to_day("x")) == [date(2024, 2, 29), None, None]
    assert one(spark, "x timestamp", [datetime(2024, 1, 2, 3)], to_day("x")) == [date(2024, 1, 2)]


@pytest.mark.parametrize(
    "kind, keyword, expected",
    [
        ("TARGETING_EXPRESSION", 'asin="B1"', "PT EXACT"),
        ("TARGETING_EXPRESSION", 'category="x" asin="B1"', "PT EXACT"),
        ("TARGETING_EXPRESSION", 'category="x"', "PT CAT"),
        ("TARGETING_EXPRESSION", 'asin-expanded="B1"', "PT EXP"),
        ("TARGETING_EXPRESSION", "other", "TARGETING_EXPRESSION"),
        ("TARGETING_EXPRESSION", None, "TARGETING_EXPRESSION"),
        ("TARGETING_EXPRESSION_PREDEFINED", "close-match", "CLOSE-MATCH"),
        ("BROAD", 'asin="B1"', "BROAD"),
        (None, "x", None),
    ],
)
def test_match_type(spark, kind, keyword, expected):
    df = spark.createDataFrame([(kind, keyword)], "m string, k string")
    assert df.select(labels.match_type("m", "k")).first()[0] == expected


def test_match_label(spark):
    values = ["CLOSE-MATCH", "complements", "Substitutes", "loose-match", "EXACT", None]
    assert one(spark, "x string", values, labels.match_label("x")) == ["CLOSE", "COMP", "SUB", "LOOSE", "EXACT", None]


def test_extract_asin(spark):
    values = ['asin="B1"', 'asin-expanded="B2"', "asin=", 'category="x"', "plain", None]
    assert one(spark, "x string", values, labels.extract_asin("x")) == ["B1", "B2", "", None, None, None]


@pytest.mark.parametrize(
    "kind, event, expected",
    [
        ("product", None, "PT"),
        ("KEYWORD", None, "KT"),
        ("auto", None, "AT"),
        ("Theme", None, "AT"),
        ("PRODUCT_CATEGORY", "VIEWS", "CT"),
        ("AUDIENCE", None, "ADT"),
        ("PRODUCT_AUDIENCE", "purchases", "PR"),
        ("PRODUCT_CATEGORY_AUDIENCE", "PURCHASES", "PR"),
        ("PRODUCT_AUDIENCE", "VIEWS", "VR"),
        ("PRODUCT_CATEGORY_AUDIENCE", "views", "VR"),
        ("PRODUCT_AUDIENCE", None, "Not Applicable"),
        ("other", "VIEWS", "Not Applicable"),
        (None, None, "Not Applicable"),
    ],
)
def test_target_group(spark, kind, event, expected):
    df = spark.createDataFrame([(kind, event)], "t string, e string")
    assert df.select(labels.target_group("t", "e")).first()[0] == expected


@pytest.mark.parametrize(
    "product, kind, expected",
    [
        ("SPONSORED_PRODUCTS", None, "SP"),
        ("SPONSORED_PRODUCTS", "VIDEO", "SP"),
        ("SPONSORED_BRANDS", "BRAND_VIDEO", "SBV"),
        ("SPONSORED_BRANDS", "VIDEO", "SBV"),
        ("SPONSORED_BRANDS", "PRODUCT_COLLECTION", "SBB"),
        ("SPONSORED_BRANDS", "STORE_SPOTLIGHT", "SBS"),
        ("SPONSORED_BRANDS", "IMAGE", "Not Applicable"),
        ("SPONSORED_DISPLAY", "IMAGE", "SDI"),
        ("SPONSORED_DISPLAY", "PRODUCT_AD", "SDP"),
        ("SPONSORED_DISPLAY", "VIDEO", "SDV"),
        (None, None, "Not Applicable"),
    ],
)
def test_ads_type(spark, product, kind, expected):
    df = spark.createDataFrame([(product, kind)], "p string, t string")
    assert df.select(labels.ads_type("p", "t")).first()[0] == expected


def test_ratio_guards_and_rounding(spark):
    schema = "spend decimal(18,2), clicks bigint"
    data = [(Decimal("10.00"), 4), (Decimal("10.00"), 0), (Decimal("10.00"), None), (None, 4)]
    df = spark.createDataFrame(data, schema)
    assert [r[0] for r in df.select(ratios.ratio("spend", "clicks")).collect()] == [2.5, 0.0, 0.0, None]
    assert [r[0] for r in df.select(ratios.ratio("spend", "clicks", 100, 0)).collect()] == [250.0, 0.0, 0.0, None]


@pytest.mark.parametrize("num, den, digits, expected", [(5, 2, 0, 3.0), (1, 8, 2, 0.13), (857821, 200, 2, 4289.11)])
def test_ratio_rounds_half_up(spark, num, den, digits, expected):
    df = spark.createDataFrame([(num, den)], "n bigint, d bigint")
    assert df.select(ratios.ratio("n", "d", 1, digits)).first()[0] == expected


def test_with_ratios_covers_all_six(spark):
    df = spark.createDataFrame(
        [(1000, 50, Decimal("200.00"), Decimal("400.00"), 10)],
        "impressions bigint, clicks bigint, ad_spend decimal(18,2), ads_sale decimal(18,2), ads_units bigint",
    )
    out = ratios.with_ratios(df, list(ratios.RATIOS)).first()
    got = {n: out[n] for n in ratios.RATIOS}
    assert got == {"CPC": 4.0, "CPA": 20.0, "ROI": 2.0, "ACOS": 50.0, "CVR": 20.0, "CTR": 5.0}


def test_coerced_ratio(spark):
    df = spark.createDataFrame(
        [("10", "4"), ("n/a", "4"), ("10", "0"), ("0", "0"), (None, "4"), ("10", ""), ("inf", "1")], "a string, b string"
    )
    assert [r[0] for r in df.select(ratios.coerced_ratio("a", "b", 100)).collect()] == [250.0, 0, 0, 0, 0, 0, 0]


def test_coerced_names(spark):
    df = spark.createDataFrame([("10", "4")], "a string, b string")
    factors = {n: df.select(ratios.coerced(n, "a", "b")).first()[0] for n in ratios.COERCED_FACTORS}
    assert factors["ACOS"] == factors["TACOS"] == factors["GMV_ATTAINMENT"] == factors["SPEND_ATTAINMENT"] == 250.0
    assert factors["CPC"] == factors["ASP"] == 2.5


MAGNITUDES = {
    "1.2K": 1200,
    "2.3K": 2300,
    "3M": 3_000_000,
    "-": 0,
    "-5": -5,
    "5 Lakhs": 500_000,
    "5 Lakh": 500_000,
    "2 Crores": 20_000_000,
    "5 Crore": 50_000_000,
    "1.5 cr": 15_000_000,
    "1,200": 1200,
    "1,200K": 1_200_000,
    "7 Units": 7,
    "": None,
    "x": None,
    "5 parsecs": None,
    None: None,
}


def test_parse_magnitude(spark):
    got = one(spark, "x string", list(MAGNITUDES), text.parse_magnitude("x"))
    assert dict(zip(MAGNITUDES, got)) == MAGNITUDES


def test_parse_lakh_crore(spark):
    values = ["", "  ", "1.5 Lakhs", "2 Cr", "12.25", "bad", None]
    assert one(spark, "x string", values, text.parse_lakh_crore("x")) == [0.0, 0.0, 150000.0, 2e7, 12.25, None, None]


def test_currency_number_keeps_every_digit(spark):
    values = ["9007199254740993", "₹9,007,199,254,740,993", "1.9999999"]
    assert one(spark, "x string", values, text.currency_number("x")) == [9007199254740993, 9007199254740993, 1]


def test_currency_number(spark):
    values = ["₹1,200", "Rs.50", "12.9", "-3", "12d", "NaN", "", "free", None]
    assert one(spark, "x string", values, text.currency_number("x")) == [1200, 50, 12, -3, None, None, None, None, None]


@pytest.mark.parametrize("name", ["old (bolt", "a|b", r"x\Ey", r"\d+", "plain", "[a]"])
def test_quoted_names_match_only_themselves(spark, name):
    df = spark.createDataFrame([(name, f"say {name} now"), (name, "say 7 now")], "n string, t string")
    hits = df.withColumn("p", text.quote_regex("n")).select(F.expr("t rlike p")).collect()
    assert [h[0] for h in hits] == [True, False]


def test_starred_keyword_and_commas(spark):
    assert one(spark, "x string", ["a+b", None], text.starred_keyword("x")) == ["a*b", None]
    assert one(spark, "x string", ["1,2,3", None], text.strip_commas("x")) == ["123", None]


def test_day_periods_are_open_at_the_top(spark):
    periods = {p.name: p for p in calendar.day_periods(date(2024, 3, 1))}
    assert (periods["today"].start, periods["today"].end) == (date(2024, 3, 1), date(2024, 3, 1))
    assert (periods["yesterday"].start, periods["yesterday"].end) == (date(2024, 2, 29), date(2024, 2, 29))
    assert (periods["last_7_days"].start, periods["last_7_days"].end) == (date(2024, 2, 23), None)
    assert list(periods) == ["today", "yesterday", "last_7_days", "last_14_days", "last_30_days", "last_60_days"]


def test_month_periods_cross_the_year():
    got = [(p.name, p.start, p.end) for p in calendar.month_periods(date(2024, 2, 10))]
    assert got == [
        ("Feb", date(2024, 2, 1), date(2024, 2, 29)),
        ("Jan", date(2024, 1, 1), date(2024, 1, 31)),
        ("Dec", date(2023, 12, 1), date(2023, 12, 31)),
        ("Nov", date(2023, 11, 1), date(2023, 11, 30)),
    ]
    long = [p.name for p in calendar.month_periods(date(2024, 2, 10), 14)]
    assert (long[0], long[1], long[12], long[13]) == ("Feb_2024", "Jan_2024", "Feb_2023", "Jan_2023")
    with pytest.raises(ValueError):
        calendar.month_periods(date(2024, 2, 10), 0)


def test_calendars(spark):
    as_of = date(2024, 3, 10)
    days = [r[0] for r in calendar.last_days(spark, as_of, 3).collect()]
    assert sorted(days) == [date(2024, 3, 8), date(2024, 3, 9), date(2024, 3, 10)]
    months = sorted(tuple(r) for r in calendar.last_months(spark, as_of, 3).collect())
    assert months == [
        (date(2024, 1, 1), date(2024, 1, 31)),
        (date(2024, 2, 1), date(2024, 2, 29)),
        (date(2024, 3, 1), date(2024, 3, 31)),
    ]
    ranges = sorted(tuple(r) for r in calendar.month_ranges(spark, as_of, 4).collect())
    assert ranges[0] == (date(2023, 12, 1), date(2023, 12, 31))
    assert ranges[-1] == (date(2024, 3, 1), date(2024, 3, 9))
