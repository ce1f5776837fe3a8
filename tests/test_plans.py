"""Plan shape of every registered query (scale guards, not values).

No query may pair rows without a key: no cartesian product and no
nested-loop join anywhere in the physical plan, subqueries included.
"""

import pytest

import __spark_entry__ as E

from conftest import SMALL_SF_DIR

QUERIES = E.queries()

# Physical operators that pair rows without an equi-key.
PAIRING = ("CartesianProduct", "BroadcastNestedLoopJoin")


def plan_text(df):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_pairing_joins(spark, key):
    plan = plan_text(QUERIES[key](spark, SMALL_SF_DIR))
    found = [op for op in PAIRING if op in plan]
    assert not found, f"{key} plans {found}"


def test_flagship_scans_are_pruned(spark):
    """The flagship reads only the columns it uses from the fact scans."""
    plan = plan_text(E.entry(spark))
    li = [ln for ln in plan.splitlines() if ln.startswith("ReadSchema:") and "l_orderkey" in ln]
    assert li, "lineitem scan not found"
    assert all("l_comment" not in ln and "l_shipinstruct" not in ln for ln in li)
