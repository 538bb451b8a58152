"""Classification expressions: match type, ASIN, target group, ad type."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Product-target texts and the match type each one names, first hit wins.
EXPRESSION_KINDS = [("asin=", "PT EXACT"), ("category=", "PT CAT"), ("asin-expanded=", "PT EXP")]

# Automatic-targeting texts and their short report labels.
SHORT_MATCH = {
    "close-match": "CLOSE",
    "complements": "COMP",
    "substitutes": "SUB",
    "loose-match": "LOOSE",
}

# Target types and their groups.
TARGET_GROUPS = {
    "PRODUCT": "PT",
    "KEYWORD": "KT",
    "AUTO": "AT",
    "THEME": "AT",
    "PRODUCT_CATEGORY": "CT",
    "AUDIENCE": "ADT",
}
AUDIENCE_TYPES = ["PRODUCT_CATEGORY_AUDIENCE", "PRODUCT_AUDIENCE"]
AUDIENCE_EVENTS = {"PURCHASES": "PR", "VIEWS": "VR"}

# Ad product, ad creative type (None = any) and the report's ad type.
AD_TYPES = [
    ("SPONSORED_PRODUCTS", None, "SP"),
    ("SPONSORED_BRANDS", "BRAND_VIDEO", "SBV"),
    ("SPONSORED_BRANDS", "VIDEO", "SBV"),
    ("SPONSORED_BRANDS", "PRODUCT_COLLECTION", "SBB"),
    ("SPONSORED_BRANDS", "STORE_SPOTLIGHT", "SBS"),
    ("SPONSORED_DISPLAY", "IMAGE", "SDI"),
    ("SPONSORED_DISPLAY", "PRODUCT_AD", "SDP"),
    ("SPONSORED_DISPLAY", "VIDEO", "SDV"),
]

NOT_APPLICABLE = "Not Applicable"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def first_match(cases: list[tuple[Column, Column]], default: Column) -> Column:
    """``CASE`` over ``cases`` in order."""
    if not cases:
        return default
    chain = F.when(*cases[0])
    return reduce(lambda acc, case: acc.when(*case), cases[1:], chain).otherwise(default)


def match_type(match_col: Column | str, keyword_col: Column | str) -> Column:
    kind, keyword = _col(match_col), _col(keyword_col)
    product = kind == "TARGETING_EXPRESSION"
    cases = [(product & keyword.contains(text), F.lit(label)) for text, label in EXPRESSION_KINDS]
    cases.append((kind == "TARGETING_EXPRESSION_PREDEFINED", F.upper(keyword)))
    return first_match(cases, kind)


def match_label(col: Column | str) -> Column:
    c = _col(col)
    return first_match([(F.lower(c) == text, F.lit(short)) for text, short in SHORT_MATCH.items()], c)


def extract_asin(keyword_col: Column | str) -> Column:
    """Product id inside a product-target keyword, else null."""
    keyword = _col(keyword_col)
    holds_asin = keyword.contains("asin=") | keyword.contains("asin-expanded=")
    piece = F.split_part(keyword, F.lit("="), F.lit(2))
    return F.when(holds_asin, F.translate(piece, '"', ""))


def target_group(type_col: Column | str, event_col: Column | str) -> Column:
    kind, event = F.upper(_col(type_col)), F.upper(_col(event_col))
    cases = [(kind == name, F.lit(group)) for name, group in TARGET_GROUPS.items()]
    cases += [
        (kind.isin(AUDIENCE_TYPES) & (event == name), F.lit(group))
        for name, group in AUDIENCE_EVENTS.items()
    ]
    return first_match(cases, F.lit(NOT_APPLICABLE))


def ads_type(product_col: Column | str, type_col: Column | str) -> Column:
    product, kind = _col(product_col), _col(type_col)
    cases = [
        (product == p if t is None else (product == p) & (kind == t), F.lit(label))
        for p, t, label in AD_TYPES
    ]
    return first_match(cases, F.lit(NOT_APPLICABLE))
