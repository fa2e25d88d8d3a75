"""Every registered query against its SQL in DuckDB on the smallest tables."""

import math

import duckdb
import pytest

from sigilgraph.plans import catalog
from sigilgraph.sources.adapter import DRIVER_TABLES

SF = "/root/testdata/sf0.001"
QUERIES, SQL = catalog.queries(), catalog.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in DRIVER_TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def norm(v):
    if isinstance(v, float):
        return "None" if math.isnan(v) else f"{v:.9g}"
    return str(v)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    ours = QUERIES[name](spark, SF)
    rows = sorted(tuple(norm(r[c]) for c in sorted(ours.columns)) for r in ours.collect())
    cursor = duck.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    at = [names.index(c) for c in sorted(names)]
    theirs = sorted(tuple(norm(r[k]) for k in at) for r in cursor.fetchall())
    assert sorted(ours.columns) == sorted(names)
    assert rows == theirs and rows


def test_no_cross_product(spark):
    for name in ("J2_attributed_to", "J4_cooccurrence", "J9_family", "R1_event_relations", "E2_campaign_rollup"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_queries_without_sql_run(spark):
    for name in set(QUERIES) - set(SQL):
        assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
