"""Line dedup by a fixed-depth tree of log templates, in DataFrame expressions only.

A line's tokens are parted by blanks. Where at most half of them have a digit, runs of
digits become the field ``<*>``; other lines, such as rows of numbers, addresses or
sentences written without blanks, stand for themselves. The tree's levels are the number of
tokens and the first ``DEPTH`` of them. A template is either a whole masked line or, in a
leaf, what its lines have in common: a token is constant where ``min_docs`` and a fifth of
the leaf's distinct lines have it, or more than half, and a variable field otherwise.
Lines with the same constants in the same places, ``MIN_SAME`` percent of their tokens or
more and none of them with a field, belong to one template, so a leaf has as many as its
lines fall into. Templates found in ``min_docs`` documents or more are dropped from all
documents but the first, so no content is lost altogether.

Lines are exchanged as hashes; only leaves that could hold a general template are
read once more as text. Counts are partial sums per document and template, so a
line that a third of all documents have is no hot key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adloom.operators.joins import size_checked
from adloom.session import materialize

DEPTH = 4
MIN_SAME = 70
#: A frequent token is one that this part of a leaf's distinct lines have in a place.
FREQUENT = 5
FIELD = "<*>"


def _masked(lines: Column) -> Column:
    """Each line with its tokens parted by one space, and its digits as fields unless most tokens have some.

    Done inside the array, so that each step runs once a line and only where it changes it.
    """
    blanks = "[ \\t\\x0B\\f\\r]"
    odd = "  |[\\t\\x0B\\f\\r]|^ | $"
    plain = F.transform(
        lines, lambda x: F.when(x.rlike(odd), F.trim(F.regexp_replace(x, f"{blanks}+", " "))).otherwise(x)
    )
    field = FIELD.replace("*", "\\*")

    def masked(x: Column) -> Column:
        tokens = F.length(x) - F.length(F.replace(x, F.lit(" "))) + 1
        with_digits = F.regexp_count(x, F.lit("[0-9][^ ]*"))
        return F.when(2 * with_digits <= tokens, F.regexp_replace(x, "[0-9]+", field)).otherwise(x)

    return F.transform(plain, lambda x: F.when(x.rlike("[0-9]"), masked(x)).otherwise(x))


def _row_key(df: DataFrame, id_col: str, text: str) -> Column:
    return F.xxhash64(df[f"`{id_col}`"].cast("long"), df[f"`{text}`"])


def _lines(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """One row per line that holds a token."""
    rows = df.select(
        _row_key(df, id_col, text).alias("r"),
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.posexplode(_masked(F.split(F.col(f"`{text}`"), "\n", -1))).alias("at", "line"),
    ).filter("line != ''")
    n = (F.length("line") - F.length(F.replace(F.col("line"), F.lit(" "))) + 1).alias("n")
    rows = rows.select("*", n)
    leaf = F.xxhash64("n", F.substring_index("line", " ", DEPTH)).alias("leaf")
    return rows.select("r", "doc_id", "at", "line", "n", F.xxhash64("line").alias("h"), leaf)


def _recurring(lines: DataFrame, key: str, min_docs: int) -> DataFrame:
    """Templates of ``min_docs`` documents or more, with the first of them (rows without an id last)."""
    per = lines.groupBy(key, "r").agg(F.min("doc_id").alias("doc_id"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "r")).getField("r").alias("first")
    found = per.groupBy(key).agg(F.count(F.lit(1)).alias("docs"), first)
    return found.filter(F.col("docs") >= min_docs).select(key, "first")


def _general(text_lines: DataFrame, lines: DataFrame, exact: DataFrame, min_docs: int) -> DataFrame:
    """``(h, leaf, template)`` of the masked lines that have enough constants."""
    rest = lines.filter(F.col("n") > DEPTH).join(exact, "h", "left_anti")
    (leaves,) = size_checked(_recurring(rest, "leaf", min_docs).select("leaf"))
    kept = text_lines.filter(F.col("n") > DEPTH).join(leaves, "leaf", "left_semi").join(exact, "h", "left_anti")
    kept = materialize(kept.select("leaf", "h", "n", "line").dropDuplicates(["leaf", "h"]), "template-lines")
    tokens = kept.select("leaf", "h", "n", F.posexplode(F.split("line", " ")).alias("at", "token"))
    sizes = kept.groupBy("leaf").agg(F.count(F.lit(1)).alias("lines"))
    counts = tokens.groupBy("leaf", "at", "token").agg(F.count(F.lit(1)).alias("c")).join(sizes, "leaf")
    c, all_lines = F.col("c"), F.col("lines")
    frequent = ((c >= min_docs) & (FREQUENT * c >= all_lines)) | (2 * c > all_lines)
    constants = counts.filter(frequent).select("leaf", "at", "token")
    same = tokens.join(constants, ["leaf", "at", "token"], "left_semi").groupBy("leaf", "h", "n").agg(
        F.count_if(~F.contains("token", F.lit(FIELD))).alias("same"),
        F.array_sort(F.collect_list(F.struct("at", "token"))).alias("constants"),
    )
    template = F.xxhash64("leaf", "constants").alias("template")
    return same.filter(100 * F.col("same") >= MIN_SAME * F.col("n")).select("leaf", "h", template)


def dropped_lines(df: DataFrame, id_col: str = "doc_id", text: str = "text", min_docs: int = 5) -> DataFrame:
    """``(r, at)`` of every line to drop: row key and line number from 0."""
    read = _lines(df, id_col, text)
    lines = materialize(read.drop("line"), "template-hashes")
    (exact,) = size_checked(_recurring(lines, "h", min_docs))
    general = materialize(_general(read, lines, exact.select("h"), min_docs), "template-general")
    members = lines.join(general, ["leaf", "h"])
    (templates,) = size_checked(_recurring(members, "template", min_docs))
    once = lines.join(exact, "h").filter("r != first").select("r", "at")
    more = members.join(templates, "template").filter("r != first").select("r", "at")
    return once.union(more)


def drop_templates(df: DataFrame, id_col: str = "doc_id", text: str = "text", min_docs: int = 5) -> DataFrame:
    """The rows without lines of recurring templates, with ``n_lines`` and ``n_dropped`` added.

    Lines are parted by line feeds. A line without a token is never dropped, and the other
    lines keep their order and form; a row whose lines all go keeps an empty text. Null
    stays null with 0 lines, empty text is one line. The document that keeps a template is
    that with the smallest id, rows without an id last. Rows of the same id and text are
    one document and get the same result; of the same id but other text, several. Other
    columns are kept, those of the added names replaced; an empty table gives no rows.
    """
    gone = dropped_lines(df, id_col, text, min_docs).groupBy("r").agg(F.collect_set("at").alias("gone"))
    (gone,) = size_checked(gone)
    added = ["n_lines", "n_dropped"]
    # Columns of the table may have any name; what is joined to them takes another one.
    row, at = (_unused(df, name) for name in ("row", "gone"))
    gone = gone.withColumnsRenamed({"r": row, "gone": at})
    lines = F.split(df[f"`{text}`"], "\n", -1)
    out = df.join(gone, _row_key(df, id_col, text) == gone[row], "left")
    left = F.array_join(F.filter(lines, lambda _, i: ~F.array_contains(at, i)), "\n")
    texts = F.when(F.col(at).isNull(), df[f"`{text}`"]).otherwise(left)
    return out.select(
        *[texts.alias(c) if c == text else df[f"`{c}`"] for c in df.columns if c not in added],
        F.when(df[f"`{text}`"].isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.coalesce(F.size(at), F.lit(0)).cast("long").alias("n_dropped"),
    )


def _unused(df: DataFrame, name: str) -> str:
    """``name`` with as many underscores before it as keep it apart from the table's columns."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name = "_" + name
    return name
