"""Every registered query against its SQL twin, and the shape of its plan."""

import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry_module  # noqa: E402
from tests.conftest import FOLDER  # noqa: E402
from tidemark.queries.all import REGISTRY  # noqa: E402
from tools.check_queries import rows_of  # noqa: E402


@pytest.mark.parametrize("name", list(REGISTRY))
def test_matches_sql(name, spark, duck):
    q = REGISTRY[name]
    df = q.run(spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython"):
        assert unwanted not in plan
    ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = duck.execute(q.sql)
    theirs = rows_of([d[0] for d in result.description], result.fetchall())
    assert ours == theirs


def test_entry_points(spark):
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
    assert entry_module.entry(spark).count() > 0
