"""Brand names and the BD / BA / GENERIC strategy of keywords and campaigns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adloom.functions.labels import NOT_APPLICABLE, extract_asin
from adloom.operators.joins import size_checked, spread_nulls, stored

#: Names that an account may have for every row to be tried with all of them.
MAX_TRIED = 64


def _known(df: DataFrame, column: str) -> DataFrame:
    """(account_name, value): the distinct values that an account has in a column."""
    return df.filter(F.col(column).isNotNull()).select("account_name", F.col(column).alias("value")).distinct()


def own_asins(competitors: DataFrame) -> DataFrame:
    """(account_name, our_asins) of the account's own products."""
    return _known(competitors, "our_asins").withColumnRenamed("value", "our_asins")


def _folded(text: Column) -> Column:
    """Text with A-Z as a-z, for matching whatever the case."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brand_names(df: DataFrame, brand_col: str, aliases: dict[str, str] | None = None) -> DataFrame:
    """Distinct (account_name, name) of the account's brands, blank names left out.

    ``aliases`` shortens long brand names first.
    """
    names = _known(df, brand_col).withColumnRenamed("value", "name")
    for long, short in (aliases or {}).items():
        names = names.withColumn("name", F.replace("name", F.lit(long), F.lit(short)))
    return names.filter("name != ''").distinct()


def account_brands(competitors: DataFrame, aliases: dict[str, str] | None = None) -> DataFrame:
    """(account_name, name, own): own and rival brand names, one row per name."""
    own = brand_names(competitors, "our_brand_name", aliases).withColumn("own", F.lit(True))
    rival = brand_names(competitors, "competitor_brand_name").withColumn("own", F.lit(False))
    return own.unionByName(rival)


#: Names and lengths of :func:`name_index`.
BrandIndex = tuple[DataFrame, DataFrame]


def name_index(brands: DataFrame) -> BrandIndex:
    """Names to look up by account and hash, and per account the lengths names have.

    (account_name, __hash, __name, __own, __rival) has one row per folded name, and
    (account_name, __sizes, __has_own, __has_rival) one per account.
    """
    folded = brands.select("account_name", _folded(F.col("name")).alias("__name"), "own")
    kinds = [F.bool_or(F.col("own")).alias("__own"), F.bool_or(~F.col("own")).alias("__rival")]
    names = folded.groupBy("account_name", "__name").agg(*kinds)
    sizes = folded.groupBy("account_name").agg(
        F.array_sort(F.collect_set(F.length("__name"))).alias("__sizes"),
        F.bool_or(F.col("own")).alias("__has_own"),
        F.bool_or(~F.col("own")).alias("__has_rival"),
    )
    return names.withColumn("__hash", F.xxhash64("__name")), sizes


def keyword_parts(words: DataFrame, sizes: DataFrame) -> DataFrame:
    """Distinct keywords of accounts with names, once per part that is as long as any name; null if there is none.

    A keyword has at most as many parts of one length as characters, however many
    names there are.
    """
    text = _folded(F.col("keyword"))
    fitting = F.filter("__sizes", lambda n: n <= F.length(text))
    starts = lambda n: F.sequence(F.lit(1), F.length(text) - n + 1)
    parts = F.flatten(F.transform(fitting, lambda n: F.transform(starts(n), lambda i: F.substr(text, i, n))))
    held = words.select("account_name", "keyword").distinct().join(sizes, "account_name")
    return held.select(
        "account_name", "keyword", "__has_own", "__has_rival", F.explode_outer(F.array_distinct(parts)).alias("__part")
    )


def brand_flags(words: DataFrame, index: BrandIndex) -> DataFrame:
    """(account_name, keyword, bd_brand, ba_brand) of distinct keywords whose account has brands.

    Names are matched literally, whatever the case, as parts of the keyword: its parts of the
    lengths that names have are looked up in an index of the names, so the work grows with
    the keyword's length and not with the number of names. A flag is null where the
    account has no brand of that kind or the keyword is null. Matches are folded into two
    flags before the shuffle, so an account with many keywords or many names is never gathered.
    """
    names, sizes = index
    parts = keyword_parts(words, sizes).withColumn("__hash", F.xxhash64("__part"))
    same = F.col("__part") == F.col("__name")
    met = parts.join(names, ["account_name", "__hash"], "left").groupBy("account_name", "keyword").agg(
        F.bool_or("__has_own").alias("__has_own"),
        F.bool_or("__has_rival").alias("__has_rival"),
        F.coalesce(F.bool_or(same & F.col("__own")), F.lit(False)).alias("__own"),
        F.coalesce(F.bool_or(same & F.col("__rival")), F.lit(False)).alias("__rival"),
    )
    known = F.col("keyword").isNotNull()
    return met.select(
        "account_name",
        "keyword",
        F.when(known & F.col("__has_own"), F.col("__own")).alias("bd_brand"),
        F.when(known & F.col("__has_rival"), F.col("__rival")).alias("ba_brand"),
    )


def tried_names(names: DataFrame) -> DataFrame | None:
    """(account_name, __own, __rival): an account's folded names as two arrays; none if they are too many to be tried.

    No account has more than ``MAX_TRIED`` and the arrays are within the bound of a broadcast.
    """
    per_account = names.groupBy("account_name").agg(F.count(F.lit(1)).alias("n"))
    if (per_account.agg(F.max("n")).first()[0] or 0) > MAX_TRIED:
        return None
    kinds = [F.collect_list(F.when(F.col(kind), F.col("__name"))).alias(kind) for kind in ("__own", "__rival")]
    arrays, small = stored(names.groupBy("account_name").agg(*kinds), "names")
    return F.broadcast(arrays) if small else None


def with_brand_flags(fact: DataFrame, index: BrandIndex) -> DataFrame:
    """Add ``bd_brand`` and ``ba_brand``; see :func:`brand_flags` for what they say.

    Where accounts have few names every row is tried with its account's, and the fact is
    neither read twice nor dealt out. Else names are looked up once per distinct keyword
    of an account: the flags are stored and broadcast if their size allows it; beyond that
    they are joined by shuffle, and as a table of their own leave a hot keyword of the fact to be split.
    """
    few = tried_names(index[0])
    if few is None:
        (flags,) = size_checked(brand_flags(fact, index))
        flagged = fact.join(flags, ["account_name", "keyword"], "left")
    else:
        known = fact.join(few, "account_name", "left").withColumn("__text", _folded(F.col("keyword")))

        def flag(kind: str) -> Column:
            met = F.exists(kind, lambda name: F.contains("__text", name))
            return F.when(F.col("keyword").isNotNull() & (F.size(kind) > 0), met)

        flagged = known.withColumns({"bd_brand": flag("__own"), "ba_brand": flag("__rival")})
    return flagged.select(*[f"`{c}`" for c in fact.columns], "bd_brand", "ba_brand")


def classify_strategy(fact: DataFrame, asins: DataFrame, index: BrandIndex) -> DataFrame:
    """Add ``strategy``: BD for own products and brands, BA for others', else GENERIC.

    A missing brand leaves its flag null, which never decides a case by itself.
    """
    own = asins.select(
        F.col("account_name").alias("__acc"), F.col("our_asins").alias("__asin")
    )
    keyed = with_brand_flags(fact, index).withColumn("__found", extract_asin("keyword"))
    # Most keywords name no product; their null key must not pile up in one task.
    key = spread_nulls(F.col("__found"), F.col("keyword"), F.col("search_term"), F.col("date"))
    joined = keyed.withColumn("__key", key).join(
        own, (F.col("account_name") == F.col("__acc")) & (F.col("__key") == F.col("__asin")), "left"
    )
    return joined.withColumn(
        "strategy",
        F.when(F.col("__asin").isNotNull() | F.col("bd_brand"), "BD")
        .when(F.col("ba_brand") | F.col("__found").isNotNull(), "BA")
        .otherwise("GENERIC"),
    ).drop("bd_brand", "ba_brand", "__found", "__key", "__acc", "__asin")


def strategy_from(fact: DataFrame, competitors: DataFrame, aliases=None) -> DataFrame:
    asins, *index = size_checked(own_asins(competitors), *name_index(account_brands(competitors, aliases)))
    return classify_strategy(fact, asins, tuple(index))


def campaign_strategy(fact: DataFrame) -> DataFrame:
    """(campaign_id, strategy_camp): the strategy all rows share, GENERIC once any row has it."""
    lowest, highest = F.min("strategy"), F.max("strategy")
    mixed = F.when(lowest == highest, lowest).otherwise(NOT_APPLICABLE)
    generic = F.bool_or(F.col("strategy") == "GENERIC")
    return fact.groupBy(F.col("campaignId").alias("campaign_id")).agg(
        F.when(generic, "GENERIC").otherwise(mixed).alias("strategy_camp")
    )
