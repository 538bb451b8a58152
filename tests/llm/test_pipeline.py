import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
sys.path.insert(0, str(Path(__file__).parents[2]))
public_tokenizers = pytest.importorskip("public_tokenizers")
import test_decontaminate  # noqa: E402
import test_templates  # noqa: E402
from brute import jaccard_components  # noqa: E402

import corpus_pipeline  # noqa: E402
from adloom.llm.pieces import PieceModel  # noqa: E402

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def pairs(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=repr)


def staged(spark, df):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, df, SF).persist()
        yield name, df, out
        df = out


def compare(spark, docs):
    """Each stage against a plain version on all that its predecessor kept."""
    seen = []
    for name, before, after in staged(spark, docs):
        seen.append(name)
        rows = pairs(before)
        if name == "line dedup":
            want = sorted(((d, t) for d, t, _, _ in test_templates.brute(rows, corpus_pipeline.TEMPLATE_DOCS)), key=repr)
            assert pairs(after) == want
        elif name == "n-gram Jaccard join":
            least = {}
            for doc, _, component in jaccard_components(rows, 5, 80, 100):
                least.setdefault(doc, []).append(component)
            want = [r for r in rows if r[0] is None or any(c >= r[0] for c in least[r[0]])]
            assert pairs(after) == want
        elif name == "benchmark decontamination":
            items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
            bad = {d for d, *_ in test_decontaminate.brute(rows, items, 80, 100) if d is not None}
            assert pairs(after.filter("doc_id is not null")) == [r for r in rows if r[0] is not None and r[0] not in bad]
        elif name.startswith("SentencePiece"):
            model = PieceModel(public_tokenizers.path("piece_bpe_32k.model"))
            got = sorted((r["doc_id"], model.decode(np.array(r["ids"], np.int64))) for r in after.filter("doc_id >= 0").collect())
            assert got == sorted((d, t or "") for d, t in rows if d is not None)
            continue
        assert after.columns == COLUMNS
    assert seen == [n for n, _ in corpus_pipeline.STAGES]
    return seen


def test_stages_on_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    compare(spark, docs)
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in corpus_pipeline.quality_rules(spark, docs, SF).collect()}
    words = {r["doc_id"]: len(r["text"].split()) for r in docs.collect()}
    good = [d for d, q in labels.items() if q == 1 and words[d] >= 50]
    assert sum(d in kept for d in good) >= 0.98 * len(good)
    assert sum(d not in kept for d, q in labels.items() if q == 0) >= 0.9 * sum(q == 0 for q in labels.values())


def test_stages_with_odd_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    own = docs.limit(40).collect()
    rows = [tuple(r) for r in own] + [tuple(own[3]), (None, own[4]["text"], None, None, None), (None, None, "x", "y", 0)]
    rows += [(9001, None, None, None, None), (9002, "", "", "", 0), (9003, own[5]["text"], "en", "s", 1), (9003, "other " * 70, "e", "s", 1)]
    compare(spark, spark.createDataFrame(rows, docs.schema))


def test_run_and_empty(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "lang", "source", "n_pieces", "scores", "round_trip", "ids"]
    assert 0 < out.count() and out.filter("not round_trip").count() == 0
    empty = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).collect() == []
