"""Every query against its oracle on a perturbed copy of the smallest tables:
sub-second ship times, half-cent amounts, NULLs in eight line columns, NULL
and duplicate-status events, malformed / fractional / array event props.  The driver's tables never
contain these, so this keeps the Spark side and the SQL side honest about
NULL ordering, rounding, truncation and malformed JSON."""

import os
import tempfile

import duckdb
import pytest

import __spark_entry__ as E
from tools.check_oracles import TABLES, rows_of

from conftest import SF_SMALL

PERTURB = {
    "lineitem": """SELECT * REPLACE (
        CASE WHEN l_orderkey % 61 = 0 THEN NULL
             WHEN l_orderkey % 7 = 0 THEN l_shipdate + INTERVAL '13:05:07.25'
             ELSE l_shipdate END AS l_shipdate,
        CASE WHEN l_orderkey % 5 = 0 THEN 0.045 ELSE l_tax END AS l_tax,
        CASE WHEN l_orderkey % 11 = 0 THEN l_extendedprice + 0.005
             ELSE l_extendedprice END AS l_extendedprice,
        CASE WHEN l_orderkey % 31 = 0 THEN NULL ELSE l_discount END AS l_discount,
        CASE WHEN l_orderkey % 37 = 0 THEN NULL ELSE l_suppkey END AS l_suppkey,
        CASE WHEN l_orderkey % 41 = 0 THEN NULL ELSE l_linestatus END AS l_linestatus,
        CASE WHEN l_orderkey % 43 = 0 THEN NULL ELSE l_partkey END AS l_partkey,
        CASE WHEN l_orderkey % 47 = 0 THEN NULL ELSE l_linenumber END AS l_linenumber,
        CASE WHEN l_orderkey % 53 = 0 THEN NULL ELSE l_returnflag END AS l_returnflag,
        CASE WHEN l_orderkey % 59 = 0 THEN NULL ELSE l_quantity END AS l_quantity)""",
    "events": """SELECT * REPLACE (
        CASE WHEN event_id % 13 = 0 THEN NULL ELSE ts END AS ts,
        CASE WHEN event_id % 17 = 0 THEN 'petitioned' ELSE event_type END AS event_type,
        CASE WHEN event_id % 19 = 0 THEN '{"k": oops'
             WHEN event_id % 23 = 0 THEN '{"k": 12.7}'
             WHEN event_id % 29 = 0 THEN '[1, 2]' ELSE props END AS props)""",
    "part": """SELECT * REPLACE (
        CASE WHEN p_partkey % 3 = 0 THEN 1.005 ELSE p_retailprice END AS p_retailprice)""",
}


@pytest.fixture(scope="module")
def edge_dir():
    d = tempfile.mkdtemp(prefix="edge-tables-")
    con = duckdb.connect()
    for t in TABLES:
        src = f"{SF_SMALL}/{t}.parquet"
        if not os.path.exists(src):
            continue
        q = PERTURB.get(t, "SELECT *")
        con.execute(f"COPY ({q} FROM read_parquet('{src}')) TO '{d}/{t}.parquet' (FORMAT parquet)")
    return d


@pytest.fixture(scope="module")
def con(edge_dir):
    c = duckdb.connect()
    for t in TABLES:
        p = f"{edge_dir}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle_on_edge_data(spark, con, edge_dir, name):
    df = E.queries()[name](spark, edge_dir)
    cols, recs = df.columns, [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    ocols, orecs = [d[0] for d in cur.description], cur.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert len(recs) == len(orecs)
    assert rows_of(cols, recs) == rows_of(ocols, orecs)
