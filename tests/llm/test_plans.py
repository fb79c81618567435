"""How the queries run: the native ones without Python, the others over Arrow batches."""

import pytest

from tidewright.llm import queries

PYTHON = ("ArrowEvalPython", "MapInPandas", "MapInArrow", "FlatMapGroups", "BatchEvalPython", "PythonDataSource", "FlatMapCoGroups")


@pytest.mark.parametrize("name", ["op4_decontaminate", "op10_licenses"])
def test_native_queries_have_no_python(spark, name):
    ran = []
    frame = queries.QUERIES[name](spark, "/root/testdata/sf0.001")
    ran.append(frame._jdf.queryExecution().executedPlan().toString())
    frame.collect()
    ran.append(frame._jdf.queryExecution().executedPlan().toString())
    assert not any(p in plan for p in PYTHON for plan in ran)
