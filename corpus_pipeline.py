"""The corpus pipeline: five stages from raw documents to pieces, each on all that its predecessor kept.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last return
the columns of ``documents``. ``run`` writes each stage's result as Parquet to the shared
folder and reads it again for the next, which cuts the lineage: a lost executor costs a
re-read of the last table, not a re-run.

Null, empty and blank texts have no words, so the base rules reject them in the first stage;
a stage that gets them all the same keeps them as they are. Very long texts are read whole.
Rows that repeat an id are judged by their own texts; extra columns pass through all stages
but the last.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adloom.llm.decontaminate import drop_contaminated
from adloom.llm.jaccard import near_duplicates
from adloom.llm.linecrf import fit_lines, judge_lines
from adloom.llm.pieces import encode_nbest, piece_scores
from adloom.llm.templates import drop_templates
from adloom.operators.joins import size_checked
from adloom.session import materialize, reach_workers

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Documents from which on a line template recurs.
TEMPLATE_DOCS = 5


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and whose words are mostly content by the line model (10)."""
    reach_workers(spark)
    model = fit_lines(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    judged = judge_lines(docs, model)
    return judged.filter("kept").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines of templates that recur across documents; the first document keeps them (2)."""
    left = drop_templates(docs, min_docs=TEMPLATE_DOCS).select(*docs.columns)
    return left.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("long"))


def near_duplicate_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 5-word shingles at 0.8: that with the smallest id (9).

    Rows that repeat an id are told apart by nothing else; they go if all of them are linked to
    a smaller id. Rows without an id stay.
    """
    reach_workers(spark)
    groups = near_duplicates(docs, k=5, num=80, den=100).filter("doc_id is not null")
    gone = groups.groupBy("doc_id").agg(F.bool_and(F.expr("doc_id != component_id")).alias("gone"))
    (gone,) = size_checked(gone.filter("gone").select("doc_id"))
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark item (8)."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of every document, of its two best segmentations: the ids of the best and the scores of both (4).

    Scores are log-probabilities of the pieces in the documents that are left.
    """
    reach_workers(spark)
    path = public_tokenizers.path("piece_bpe_32k.model")
    found = encode_nbest(docs, path, n=2, keep="nbest", scores=piece_scores(docs, path))
    ids = F.get("nbest", F.lit(0))["ids"].alias("ids")
    return found.select("doc_id", "lang", "source", "n_pieces", "scores", "round_trip", ids)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicate_documents),
    ("benchmark decontamination", benchmark_decontamination),
    ("SentencePiece encoding and decoding", sentencepiece),
]

#: The line model and the pieces can't be expressed in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
