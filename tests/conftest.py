import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shiftloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", cores=8, **{"spark.sql.shuffle.partitions": "4", "spark.ui.showConsoleProgress": "false"})
    yield session
    session.stop()


def rows(df, *order):
    """Rows as plain tuples, in the order of the given columns (all of them by default)."""
    def key(r):
        return tuple((r[c] is not None, r[c]) for c in (order or df.columns))

    return [tuple(r) for r in sorted(df.collect(), key=key)]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
