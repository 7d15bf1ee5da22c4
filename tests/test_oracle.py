"""Every registered query against its DuckDB SQL twin on the smallest tables."""

import math
from collections import Counter
from pathlib import Path

import duckdb
import pytest

from conftest import SF_SMALL

import __spark_entry__ as E
from strata.plans.catalog import QUERIES
from strata.plans.inspect import physical_plan
from strata.session import release_scratch

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v.isoformat() if hasattr(v, "isoformat") else v


def _bag(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in records)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{Path(SF_SMALL) / t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.queries()) and set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    rel = con.sql(E.oracle_sql()[name])
    want = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert _bag(df.columns, got) == _bag(rel.columns, want)
    # every registered query stays in the JVM: no Python evaluation in its plan
    plan = physical_plan(df)
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                 "PythonUDF", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan, (name, node)
    release_scratch(spark)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["Year", "Product_Category", "Product_Sub_Category", "Customer_ID",
                          "customer_name", "Profit"]
    assert df.count() > 0
