"""Every registered query against its DuckDB twin on the smallest scale (rows, columns, values)."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from enrollspark.oracle import oracle_sql
from enrollspark.plans.queries import QUERIES

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]
NAMES = sorted(QUERIES)


def _norm(v):
    return "\0" if v is None else str(v)


def _canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t + '.parquet')}')")
    return con


def test_every_query_has_an_oracle():
    assert set(oracle_sql()) == set(QUERIES)
    assert set(QUERIES) <= set(E.queries()) and set(oracle_sql()) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = df.collect()
    res = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _canon(rows, df.columns) == _canon(orows, ocols)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["rec_type", "SBSB_ID", "REC_NUM", "EFF_DT", "STATE_ID"]
    assert df.count() == 332


SHUFFLE_JOIN_QUERIES = ["extract_records", "with_registration", "state_after_change", "state_deleted_keys",
                        "cob_top5", "maintenance_code", "state_scaffold", "member_timeline"]


@pytest.fixture()
def no_broadcast(spark):
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("name", SHUFFLE_JOIN_QUERIES)
def test_query_matches_oracle_with_shuffle_joins(spark, duck, no_broadcast, name):
    """The plans a large input gets (every join a shuffle join) give the same rows."""
    df = E.queries()[name](spark, SF_SMALL)
    assert "BroadcastHashJoin" not in df._jdf.queryExecution().executedPlan().toString()
    rows = df.collect()
    res = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert _canon(rows, df.columns) == _canon(res.fetchall(), ocols)
