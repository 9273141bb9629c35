"""Every registered query against its SQL in DuckDB, at the smallest scale."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import check  # noqa: E402

import __spark_entry__ as entry  # noqa: E402

SLOW = {"grid_search", "cv_evaluate", "regressors"}


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for t in check.TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", [n for n in entry.queries() if n not in SLOW])
def test_query(spark, con, sf_dir, name):
    text, _, ok = check.compare(spark, con, name, sf_dir)
    assert ok, text


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_oracles_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name, joins", [("date_features", 0), ("counts_by_period", 0), ("value_counts", 0), ("standard_scale", 2)])
def test_queries_join_only_the_sources_they_ask_for(spark, sf_dir, name, joins):
    plan = entry.queries()[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == joins, plan
