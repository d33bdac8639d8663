"""The driver contract, and every registered query against its SQL."""

import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from docloom.plans import catalogue

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))
import check  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
HAVE_DATA = Path(FOLDER).exists()
needs_data = pytest.mark.skipif(not HAVE_DATA, reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in check.TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


#: Not expressible in SQL: tested against plain Python (test_tokens.py).
WITHOUT_SQL = {"chunk_tokens"}


def test_every_query_has_sql():
    assert set(catalogue.SQL) == set(catalogue.QUERIES) - WITHOUT_SQL
    assert set(catalogue.QUERIES) <= set(entry.queries())


@needs_data
def test_entry(spark):
    rows = entry.entry(spark)
    assert rows.count() > 200 and "chunk_id" in rows.columns


@needs_data
@pytest.mark.slow
@pytest.mark.parametrize("name", catalogue.SQL)
def test_query_equals_sql(spark, con, name):
    n, m, equal, _, _, note = check.compare(spark, con, FOLDER, name)
    assert equal and not note, f"{n} <> {m} {note}"


@needs_data
@pytest.mark.parametrize("name", ["chunks", "fragments", "boundary_share", "page_boilerplate", "top_k", "rank_fragments"])
def test_plans_have_no_cross_join(spark, name):
    plan = entry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@needs_data
def test_scan_reads_needed_columns_only(spark):
    plan = entry.queries()["token_buckets"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<text:string>" in plan


@needs_data
def test_chunking_does_not_repeat_work(spark):
    """One split and one fold: nothing derived is computed again for a filter."""
    plan = entry.queries()["chunks"](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("aggregate(") <= 3
