"""Bid rules as an ordered table, applied by joins on the intervals that their bounds make.

A rule names its number, an account (none: every account), a comma-separated list of
portfolios, ranges ``<i>_column_filter, <i>_start, <i>_end``, the column it prices from
and what to do with that price; each row takes the first rule that applies and gives a bid.

The bounds that an account's rules set on a column part its values into numbered
intervals, and within one interval no rule tells two values apart. Rows that agree in
account, portfolio, intervals and in which prices they have take the same rule, so the
rule is looked up once for each such combination. A rule is filed under the few dyadic
nodes that make up its narrowest range of intervals; a combination asks for the nodes
above its own intervals, so it meets the rules whose narrowest range holds it, not all.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adloom.operators.joins import join_null_safe, size_checked, stored

RATIO = "Acos_ratio"
NUMBER = "rule_no"

#: Bounds that the rules of one account may set on one column; a row of all of them is broadcast.
MAX_BOUNDS = 100_000

#: Scope of rules that hold for every account.
EVERY = "\u0000"


def _filled(name: str) -> Column:
    """Text of a rule column, null where it is blank."""
    text = F.trim(F.col(f"`{name}`").cast("string"))
    return F.when(text != "", text)


def _ranges(rules_df: DataFrame) -> Column:
    """Named ranges of a rule, in the order of their numbers."""
    numbers = sorted({int(m[1]) for c in rules_df.columns if (m := re.fullmatch(r"(\d+)_end", c))})
    parts = [
        F.struct(
            _filled(f"{i}_column_filter").alias("name"),
            _filled(f"{i}_start").cast("double").alias("start"),
            _filled(f"{i}_end").cast("double").alias("end"),
        )
        for i in numbers
    ]
    if not parts:
        return F.array().cast("array<struct<name:string,start:double,end:double>>")
    return F.filter(F.array(*parts), lambda r: r["name"].isNotNull())


def rule_rows(rules_df: DataFrame) -> DataFrame:
    """(scope, number, portfolios, ranges, price, change), one row per rule; the scope is an account or ``EVERY``.

    The order is that of ``rule_no`` and so independent of how the table is stored; a
    missing or repeated number is an error.
    """
    if NUMBER not in rules_df.columns:
        raise ValueError(f"bid rules need a column {NUMBER!r} that orders them")
    wrong = rules_df.groupBy(NUMBER).count().filter(F.col(NUMBER).isNull() | (F.col("count") > 1)).first()
    if wrong is not None:
        raise ValueError(f"bid rules with the number {wrong[NUMBER]}: {wrong['count']}")
    names = F.transform(F.split(F.lower(F.coalesce(F.col("portfolio_name"), F.lit(""))), ","), lambda n: F.trim(n))
    return rules_df.select(
        F.coalesce(_filled("account_name"), F.lit(EVERY)).alias("scope"),
        F.col(NUMBER).cast("long").alias("number"),
        F.filter(names, lambda n: n != "").alias("portfolios"),
        _ranges(rules_df).alias("ranges"),
        _filled("cpc_column_name").alias("price"),
        F.lower(_filled("bid_change")).alias("change"),
    )


def _named(rules: DataFrame, columns: list[str]) -> tuple[list[str], list[str]]:
    """Columns of the report that any rule filters by, and that any prices from; at most the report's width."""
    filters = rules.select(F.explode("ranges.name").alias("c"), F.lit(0).alias("k"))
    prices = rules.select(F.col("price").alias("c"), F.lit(1).alias("k"))
    used = filters.union(prices).filter(F.col("c").isin(columns)).distinct().collect()
    return tuple(sorted(r["c"] for r in used if r["k"] == k) for k in (0, 1))


def _bounds(rules: DataFrame, filters: list[str]) -> DataFrame:
    """(scope, used, b0, b1, ..): columns a scope's rules filter by, and the sorted bounds they set on each."""
    named = rules.select("scope", F.explode("ranges").alias("r")).filter(F.col("r.name").isin(filters))
    ends = named.select("scope", "r.name", F.explode(F.array("r.start", "r.end")).alias("bound")).distinct()
    each = [F.array_sort(F.collect_list(F.when(F.col("name") == f, F.col("bound")))) for f in filters]
    return ends.groupBy("scope").agg(F.collect_set("name").alias("used"), *[b.alias(f"b{i}") for i, b in enumerate(each)])


def _interval(bounds: Column, value: Column, levels: int) -> Column:
    """How many of the sorted bounds are at most ``value``, by halving."""
    steps = F.array(*[F.lit(1 << k) for k in range(levels - 1, -1, -1)])

    def further(at: Column, step: Column) -> Column:
        inside = (at + step <= F.size(bounds)) & (F.get(bounds, at + step - 1) <= value)
        return F.when(inside, at + step).otherwise(at)

    return F.aggregate(steps, F.lit(0), further)


def _ints(columns: list[Column]) -> Column:
    return F.array(*columns).cast("array<int>")


def _nodes(column: int, low: Column, high: Column, levels: int) -> list[Column]:
    """Dyadic nodes, at most two of a level and else null, that together make up ``low <= i < high``."""
    made = []
    for level in range(levels + 1):
        first, end = F.shiftright(low + ((1 << level) - 1), level), F.shiftright(high, level)
        for odd, node in ((first, first), (end, end - 1)):
            held = (first < end) & (odd % 2 == 1)
            made.append(F.when(held, F.struct(F.lit(column).alias("c"), F.lit(level).alias("level"), node.alias("node"))))
    return made


def _anywhere() -> Column:
    """Node of the rules without a range."""
    return F.struct(F.lit(-1).alias("c"), F.lit(0).alias("level"), F.lit(0).alias("node"))


def _of(name: str):
    """Whether a range is one of the column's."""
    return lambda r: r["name"] == F.lit(name)


def filed_rules(rules: DataFrame, bounds: DataFrame, filters: list[str], prices: list[str], levels: int) -> DataFrame:
    """Rules that can give a bid, under the nodes of their narrowest range: ``lows`` to ``highs`` per filter column."""
    joined = rules.join(bounds, "scope", "left")
    lows, highs, counts = [], [], []
    for i, name in enumerate(filters):
        known = F.coalesce(f"b{i}", F.array().cast("array<double>"))
        own = F.filter("ranges", _of(name))
        start, end = F.array_max(F.transform(own, lambda r: r["start"])), F.array_min(F.transform(own, lambda r: r["end"]))
        lows.append(F.when(start.isNull(), 0).otherwise(_interval(known, start, levels)))
        highs.append(F.when(end.isNull(), F.size(known) + 1).otherwise(_interval(known, end, levels)))
        counts.append(F.size(known) + 1)
    percent = F.nanvl(F.col("change").try_cast("double"), F.lit(None).cast("double"))
    usable = F.col("change").isin("no change", "cpc/ratio") | percent.isNotNull()
    shown = {"lows": _ints(lows), "highs": _ints(highs), "counts": _ints(counts)}
    placed = joined.filter(F.col("price").isin(prices) & usable).withColumns(shown)
    placed = placed.filter(F.forall(F.arrays_zip("lows", "highs"), lambda r: r["lows"] < r["highs"]))
    widths = [
        F.when(F.col("highs")[i] - F.col("lows")[i] < F.col("counts")[i],
               F.struct((F.col("highs")[i] - F.col("lows")[i]).alias("width"), F.lit(i).alias("c")))
        for i in range(len(filters))
    ]
    narrowest = F.array_min(F.array(*widths))["c"] if widths else F.lit(None).cast("int")
    placed = placed.withColumn("by", narrowest)
    nodes = F.array(F.when(F.col("by").isNull(), _anywhere()))
    for i in range(len(filters)):
        own = F.array(*_nodes(i, F.col("lows")[i], F.col("highs")[i], levels))
        nodes = F.when(F.col("by") == i, own).otherwise(nodes)
    at = F.explode(F.filter(nodes, lambda n: n.isNotNull())).alias("at")
    price = F.array_position(F.array(*map(F.lit, prices)), F.col("price")).cast("int").alias("place")
    kept = ["number", "portfolios", "lows", "highs", "price", "change"]
    return placed.select("scope", at, *kept, price).select("scope", "at.*", *kept, "place")


#: What rows must agree in to take the same rule.
ALIKE = ["account_name", "__portfolio", "__own", "__all", "__priced"]


def first_rules(alike: DataFrame, filed: DataFrame, n_filters: int, levels: int) -> DataFrame:
    """The first rule of every combination of ``ALIKE``, as ``__rule``; combinations without one are left out."""
    scopes = F.array(
        F.struct(F.col("account_name").alias("scope"), F.col("__own").alias("i")),
        F.struct(F.lit(EVERY).alias("scope"), F.col("__all").alias("i")),
    )
    asked = alike.withColumn("__s", F.explode(scopes)).select(*ALIKE, "__s.scope", F.col("__s.i").alias("__i"))
    nodes = [
        F.struct(F.lit(c).alias("c"), F.lit(level).alias("level"), F.shiftright(F.col("__i")[c], level).alias("node"))
        for c in range(n_filters)
        for level in range(levels + 1)
    ]
    asked = asked.withColumn("__at", F.explode(F.array(_anywhere(), *nodes))).select(*ALIKE, "scope", "__i", "__at.*")
    met = asked.join(filed, ["scope", "c", "level", "node"])
    listed = (F.size("portfolios") == 0) | F.array_contains("portfolios", F.col("__portfolio"))
    ranges = F.arrays_zip("lows", "highs", "__i")
    inside = F.forall(ranges, lambda r: (r["lows"] <= r["__i"]) & (r["__i"] < r["highs"]))
    met = met.filter(listed & inside & F.get("__priced", F.col("place") - 1))
    return met.groupBy(*ALIKE).agg(F.min(F.struct("number", "price", "change")).alias("__rule"))


def _value(name: str) -> Column:
    """A filter column as rules see it: a number, null read as 0."""
    return F.coalesce(F.col(f"`{name}`").try_cast("double"), F.lit(0.0))


def with_intervals(df: DataFrame, bounds: DataFrame, filters: list[str], prices: list[str], levels: int) -> DataFrame:
    """Rows with the columns of ``ALIKE`` and ``__used``, the filter columns of the row's rules."""
    everyone, own = bounds.filter(F.col("scope") == EVERY), bounds.filter(F.col("scope") != EVERY)
    # One row, whatever the data: the bounds of the rules for every account.
    everyone = everyone.select(F.lit(1).alias("__one"), F.struct("*").alias("__e"))
    rows = df.withColumn("__one", F.lit(1)).join(F.broadcast(everyone), "__one", "left")
    rows = rows.join(own.select(F.col("scope").alias("account_name"), F.struct("*").alias("__o")), "account_name", "left")
    none = F.array().cast("array<double>")

    def numbers(side: str) -> Column:
        return _ints([_interval(F.coalesce(f"{side}.b{i}", none), _value(f), levels) for i, f in enumerate(filters)])

    unused = F.array().cast("array<string>")
    priced = [F.col(f"`{p}`").try_cast("double").isNotNull() for p in prices]
    return rows.select(
        *[f"`{c}`" for c in df.columns],
        F.lower(F.trim(F.coalesce(F.col("portfolio_name"), F.lit("")))).alias("__portfolio"),
        numbers("__o").alias("__own"),
        numbers("__e").alias("__all"),
        F.array(*priced).cast("array<boolean>").alias("__priced"),
        F.concat(F.coalesce("__o.used", unused), F.coalesce("__e.used", unused)).alias("__used"),
    )


def _bid(rule: Column, prices: list[str], ratio: Column) -> Column:
    """Bid that a rule suggests for the row."""
    price = F.lit(None).cast("double")
    for name in prices:
        price = F.when(rule["price"] == name, F.col(f"`{name}`").try_cast("double")).otherwise(price)
    percent = rule["change"].try_cast("double")
    return (
        F.when(rule["change"] == "no change", price)
        .when(rule["change"] == "cpc/ratio", F.when(ratio > 0, price / ratio).otherwise(price))
        .otherwise(price * (1 + percent / 100.0))
    )


def price_rows(df: DataFrame, rules_df: DataFrame) -> DataFrame:
    """Add ``suggested_bid`` of the first rule, in order, that gives the row a non-null bid.

    Bounds are ``[start, end)``; columns the report lacks do not filter. Columns that the
    row's rules filter by come back as the rules saw them: numbers, null read as 0. ``df`` is
    read twice, for the combinations that occur and for the result, each time only the columns
    needed there; hand in stored rows, or what is cheap to make of them.
    """
    rules, _ = stored(rule_rows(rules_df), "rules")
    filters, prices = _named(rules, df.columns)
    bounds, small = stored(_bounds(rules, filters), "bounds")
    most = F.greatest(F.lit(0), *[F.size(f"b{i}") for i in range(len(filters))]) if filters else F.lit(0)
    most = bounds.agg(F.max(most)).first()[0] or 0
    if most > MAX_BOUNDS:
        raise ValueError(f"{most} bounds of one account on one column, more than {MAX_BOUNDS}")
    levels = most.bit_length() + 1
    known = F.broadcast(bounds) if small else bounds
    rows = with_intervals(df, known, filters, prices, levels)
    (filed,) = size_checked(filed_rules(rules, bounds, filters, prices, levels))
    (best,) = size_checked(first_rules(rows.select(*ALIKE).distinct(), filed, len(filters), levels))
    priced = join_null_safe(rows, best, ALIKE)
    priced = priced.withColumn("suggested_bid", _bid(F.col("__rule"), prices, F.col(RATIO)))
    shown = [_as_seen(df, c).alias(c) if c in filters else F.col(f"`{c}`") for c in df.columns]
    return priced.select(*shown, "suggested_bid")


def _as_seen(df: DataFrame, name: str) -> Column:
    column, kind = F.col(f"`{name}`"), df.schema[name].dataType
    number = column if isinstance(kind, T.NumericType) else column.try_cast("double")
    zero = F.lit(0).cast(kind) if isinstance(kind, T.NumericType) else F.lit(0.0)
    return F.when(F.array_contains("__used", name), F.coalesce(number, zero)).otherwise(number)


def acos_ratio(digits: int | None = 2) -> Column:
    """ACOS against target: x/0 is infinity, 0/0 and null targets are null."""
    acos, target = F.col("ACOS_last_14_days").cast("double"), F.col("target_acos").cast("double")
    value = F.when((target == 0) & (acos > 0), F.lit(float("inf"))).otherwise(
        F.try_divide(acos, target)
    )
    if digits is None:
        return value
    return F.when(value == float("inf"), value).otherwise(F.bround(value, digits))


def suggest_bids(
    df: DataFrame,
    rules_df: DataFrame,
    account: str | None = None,
    ratio_digits: int | None = 2,
    bid_digits: int | None = 1,
    shown_digits: int | None = 1,
) -> DataFrame:
    """Keyword report with ``suggested_bid`` and ``Acos_ratio``.

    With ``account`` only that tenant's rows and rules are used. Rounding is half-even.
    """
    if account is not None:
        df = df.filter(F.col("account_name") == account)
        rules_df = rules_df.filter(F.col("account_name") == account)
    priced = price_rows(df.withColumn(RATIO, acos_ratio(ratio_digits)), rules_df)
    if bid_digits is not None:
        priced = priced.withColumn("suggested_bid", F.bround("suggested_bid", bid_digits))
    if shown_digits is not None:
        shown = F.when(F.col(RATIO) == float("inf"), F.col(RATIO)).otherwise(
            F.bround(RATIO, shown_digits)
        )
        priced = priced.withColumn(RATIO, shown)
    return priced


def bid_coverage(df: DataFrame) -> DataFrame:
    """(with_bid, total): how many rows got a suggestion."""
    return df.agg(F.count("suggested_bid").alias("with_bid"), F.count(F.lit(1)).alias("total"))
