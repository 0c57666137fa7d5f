"""Every registered query against its SQL, on the smallest tables; none may use Python workers."""

import os
import sys

import pytest

from shiftloom.queries import oracle_sql, queries
from tests.conftest import plan

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

SF_DIR = os.environ.get("SHIFTLOOM_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not there")


@pytest.fixture(scope="module")
def tables():
    pytest.importorskip("duckdb")
    from check_oracle import connect

    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_equals_its_sql(spark, tables, name):
    from check_oracle import difference

    df = queries()[name](spark, SF_DIR)
    text = plan(df)
    assert not any(node in text for node in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "InPandas", "CartesianProduct", "NestedLoopJoin"))
    assert difference(df, tables, oracle_sql()[name]) is None


def test_every_query_has_sql():
    assert set(oracle_sql()) == set(queries()) and len(queries()) > 100


def test_driver_entry(spark):
    import __spark_entry__ as entry

    assert set(queries()) <= set(entry.queries())  # the llm queries come on top where they are installed
    assert entry.FLAGSHIP in entry.queries()
