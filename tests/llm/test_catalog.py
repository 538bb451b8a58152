"""The registered queries against their SQL, and the folder's place in the package."""

import ast
from pathlib import Path

import duckdb
import pytest

pytest.importorskip("public_tokenizers")
import __spark_entry__ as contract  # noqa: E402
from adloom.fixtures import TABLES  # noqa: E402
from adloom.llm import catalog  # noqa: E402
from check import compare  # noqa: E402

SF = "/root/testdata/sf0.001"
ROOT = Path(__file__).parents[2]


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_matches_sql(spark, con, name):
    result = compare(spark, con, name, catalog.QUERIES[name], catalog.SQL[name], SF)
    assert ": ok," in result, result


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.SQL)))
def test_query_gives_rows(spark, name):
    assert catalog.QUERIES[name](spark, SF).count() > 0


def test_all_operators_and_the_pipeline_are_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in catalog.QUERIES)
    assert numbers == list(range(1, 14)) and "pipeline" in contract.queries()


def test_nothing_else_imports_this_folder():
    for path in ROOT.joinpath("adloom").rglob("*.py"):
        if path.parent.name != "llm":
            for node in ast.walk(ast.parse(path.read_text())):
                names = [a.name for a in node.names] if isinstance(node, ast.Import) else [getattr(node, "module", None) or ""]
                assert not any(n.startswith("adloom.llm") for n in names), path


@pytest.mark.parametrize("name", ["op2_line_dedup", "op8_benchmark_decontamination"])
def test_native_queries_run_no_python(spark, name):
    plan = catalog.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "InArrow"))
