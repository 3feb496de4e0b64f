"""Every registered query against its DuckDB oracle on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as E
from tools.check_oracles import TABLES, rows_of

from conftest import SF_SMALL
from loanweave.plans.catalog import QUERIES as CATALOG

QUERIES = E.queries()
ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle_or_is_rows_only():
    assert set(ORACLES) <= set(QUERIES)
    # Queries of the optional training-data subpackage are tested with it.
    assert set(CATALOG) <= set(ORACLES)  # every library query has one


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    cols, recs = df.columns, [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLES[name])
    ocols, orecs = [d[0] for d in cur.description], cur.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert len(recs) == len(orecs)
    assert rows_of(cols, recs) == rows_of(ocols, orecs)


@pytest.mark.parametrize("name", ["payload_schema", "schema_drift"])
def test_rows_only_queries_run(spark, name):
    rows = QUERIES[name](spark, SF_SMALL).collect()
    assert rows


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["loan_id", "loan_uuid"]
