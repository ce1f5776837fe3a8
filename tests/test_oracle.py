"""Every registered query against its DuckDB oracle at sf0.01."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import compare, duck  # noqa: E402

from conftest import SF_DIR  # noqa: E402

QUERIES = E.queries()
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    df = QUERIES[key](spark, SF_DIR)
    rows = [tuple(r) for r in df.collect()]
    if key not in ORACLE:
        assert len(rows) > 0
        return
    cur = con.execute(ORACLE[key])
    msg = compare(rows, df.columns, cur.fetchall(), [d[0] for d in cur.description])
    assert msg is None, msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "total_revenue" in df.columns
