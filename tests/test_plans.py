"""Plan audit of every batch query of the library: no cross joins, no nested
loop joins, no Python evaluation inside tasks, and text scans read only
the columns they use."""

import pytest

import __spark_entry__ as E
from moodlake.plans.catalog import queries as library_queries
from tests.conftest import SF_SMALL

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


@pytest.mark.parametrize("name", sorted(n for n in library_queries() if not n.startswith("stream_")))
def test_plan_has_no_forbidden_operators(spark, name):
    plan = E.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not [k for k in FORBIDDEN if k in plan]


def test_text_is_not_read_when_unused(spark):
    plan = E.queries()["genre_counts"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "text" not in [c.strip() for line in plan.splitlines() if "ReadSchema" in line
                          for c in line.split("ReadSchema: struct<")[1].split(">")[0].replace(":", ",").split(",")]
