"""Pseudonymised copies of one tenant."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adloom.functions.text import word_pattern
from adloom.operators.joins import join_null_safe, size_checked
from adloom.session import materialize

# (column, label prefix, parent columns)
Level = tuple[str, str, tuple[str, ...]]


def _q(names) -> list[str]:
    return [f"`{n}`" for n in names]


def replace_word(df: DataFrame, word: str, replacement: str = "Dummy") -> DataFrame:
    """Replace a whole word, whatever its case, in every text column."""
    pattern = word_pattern(word)
    return df.select(
        *[
            F.regexp_replace(F.col(f"`{f.name}`"), pattern, replacement).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def _chains(levels: list[Level]) -> list[list[Level]]:
    """Levels grouped into root-to-leaf chains: each level's parents are the chain so far."""
    chains: list[list[Level]] = []
    for level in levels:
        home = next((c for c in chains if tuple(x[0] for x in c) == tuple(level[2])), None)
        if home is not None:
            home.append(level)
        elif not level[2]:
            chains.append([level])
        else:
            raise ValueError(f"no chain of levels ends in the parents of {level[0]!r}")
    return chains


def _label(chain: list[Level], depth: int, rank: Column) -> Column:
    """Label of a level; null if its value or any parent's is null."""
    known = F.lit(True)
    for name, _, _ in chain[:depth]:
        known = known & F.col(f"`{name}`").isNotNull()
    return F.when(known, F.concat(F.lit(chain[depth - 1][1]), rank.cast("string"))).alias(f"__label_{depth}")


def _level_ranks(chunked: DataFrame, chain: list[Level], depth: int) -> DataFrame:
    """Label of each value path of length ``depth`` in a path table of any size.

    ``chunked`` is range-partitioned by the whole path and ``__chunk`` numbers its
    ranges. A rank is the number of values in earlier chunks plus the position
    inside the chunk, so no task orders more than one chunk.
    """
    path = [level[0] for level in chain[:depth]]
    parents, name = path[:-1], path[-1]
    firsts = chunked.groupBy(*_q(path)).agg(F.min("__chunk").alias("__chunk"))
    counts = firsts.groupBy(*_q(parents), "__chunk").agg(F.count(F.lit(1)).alias("__n"))
    earlier = Window.partitionBy(*_q(parents)).orderBy("__chunk")
    before = F.sum("__n").over(earlier.rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.withColumn("__before", F.coalesce(before, F.lit(0))).drop("__n")
    inside = Window.partitionBy(*_q(parents), "__chunk").orderBy(F.col(f"`{name}`").asc_nulls_first())
    ranked = firsts.withColumn("__pos", F.row_number().over(inside))
    ranked = join_null_safe(ranked, counts, [*parents, "__chunk"], "inner")
    return ranked.select(*_q(path), _label(chain, depth, F.col("__before") + F.col("__pos")))


def label_map(df: DataFrame, chain: list[Level], partitions: int | None = None) -> DataFrame:
    """Every distinct value path of the chain with the labels of all its levels.

    A null value counts in the numbering but has no label, and neither have its
    children. The sorted paths are stored, so their ranges cannot shift between the
    passes that number them; the labels are stored too and broadcast if their
    measured size allows it.
    """
    path = [level[0] for level in chain]
    partitions = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col(c).asc_nulls_first() for c in _q(path)]
    ranges = df.select(*_q(path)).distinct().repartitionByRange(partitions, *order)
    chunked = materialize(ranges.withColumn("__chunk", F.spark_partition_id()), "paths")
    out = chunked.drop("__chunk")
    for depth in range(1, len(chain) + 1):
        out = join_null_safe(out, _level_ranks(chunked, chain, depth), path[:depth], "inner")
    (labels,) = size_checked(out)
    return labels


def pseudonymize(df: DataFrame, levels: list[Level], partitions: int | None = None) -> DataFrame:
    """Replace names by numbered labels; numbering restarts under each parent."""
    for chain in _chains(levels):
        path = [level[0] for level in chain]
        joined = join_null_safe(df, label_map(df, chain, partitions), path, "inner")
        renamed = {name: F.col(f"__label_{i}") for i, name in enumerate(path, 1)}
        df = joined.select(
            *[renamed[c].alias(c) if c in renamed else F.col(f"`{c}`") for c in df.columns]
        )
    return df


def scale_measures(df: DataFrame, columns: list[str], factor: int = 5, cast: str | None = None) -> DataFrame:
    def scaled(name: str) -> Column:
        column = F.col(f"`{name}`")
        return (column.cast(cast) if cast else column) * factor

    return df.withColumns({c: scaled(c) for c in columns})


@dataclass(frozen=True)
class MaskSpec:
    """How a report is masked.

    ``tenant_column`` selects the rows; ``recompute`` derives ratios from the
    scaled measures.
    """

    levels: list[Level]
    measures: list[str] = field(default_factory=list)
    tenant_column: str = "ACCOUNT NAME"
    replacement: str = "Dummy"
    cast: str | None = None
    recompute: object = None


def tenant_rows(df: DataFrame, tenant: str, spec: MaskSpec) -> DataFrame:
    """Rows of the tenant; the equality reaches the scan behind them."""
    return df.filter(F.col(f"`{spec.tenant_column}`") == tenant)


def masked_copy(df: DataFrame, tenant: str, spec: MaskSpec, factor: int = 5) -> DataFrame:
    """Rows of the tenant with its name replaced, names numbered and measures scaled.

    The tenant's rows are stored once; numbering and labelling read that table, so
    the report behind them runs once however many name columns are masked.
    """
    rows = materialize(tenant_rows(df, tenant, spec), "tenant")
    masked = pseudonymize(replace_word(rows, tenant, spec.replacement), spec.levels)
    if spec.measures:
        masked = scale_measures(masked, spec.measures, factor, spec.cast)
    return spec.recompute(masked) if spec.recompute else masked


def masked_union(df: DataFrame, tenant: str, spec: MaskSpec, factor: int = 5) -> DataFrame:
    """Real rows plus the masked copy, which is made of the tenant's stored rows."""
    masked = masked_copy(df, tenant, spec, factor)
    real = df.select(
        *[F.col(f"`{f.name}`").cast(masked.schema[f.name].dataType).alias(f.name) for f in df.schema.fields]
    )
    return real.unionByName(masked)
