"""Every registered query: against its SQL in DuckDB, or for having rows; and the plans of some."""

import pytest

import __spark_entry__ as contract
from oracle import DATA, connect, differences
from tidewright.operators import ordered, windows
from tidewright.plans import all_queries

FOLDER = f"{DATA}/sf0.001"
PYTHON = ("ArrowEvalPython", "MapInPandas", "MapInArrow", "FlatMapGroups", "BatchEvalPython", "PythonDataSource")
USES_PYTHON = {
    "udf_map", "udf_filter", "udtf_flatmap", "udaf_reduce", "udaf_aggregate", "udwf_process", "udwf_process_time",
    "rolling_reduce", "wf_process_avg", "wf_process_context", "sink_custom", "sink_output_format",
    "src_generator_parallel", "src_generator_rich",
}


@pytest.fixture(scope="session")
def db():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, db, name):
    df = contract.queries()[name](spark, FOLDER)
    sql = contract.oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert differences(df, db, sql) == []
    if name in all_queries() and name not in USES_PYTHON:
        assert not any(p in plan(df) for p in PYTHON), "runs in the JVM"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_entry(spark):
    assert contract.entry(spark).columns == ["word", "count"]


def test_every_oracle_has_its_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def run(spark, name):
    return plan(contract.queries()[name](spark, FOLDER))


def test_filters_and_columns_reach_the_scan(spark):
    assert "GreaterThan(value,8.0)" in run(spark, "filter_compare")
    assert "ReadSchema: struct<event_id:bigint,value:double>" in run(spark, "filter_compare")
    assert "StringContains(url,example.com)" in run(spark, "filter_contains")
    assert "ReadSchema: struct<text:string>" in run(spark, "wordcount_batch")


@pytest.mark.parametrize("name", ["wordcount_batch", "win_tumbling_time_all", "win_tumbling_time_keyed", "win_sliding_time_all", "window_max", "keyby_selector"])
def test_rows_are_combined_before_the_one_shuffle(spark, name):
    text = run(spark, name)
    assert text.count("Exchange") == 1 and "partial_" in text


@pytest.mark.parametrize("keys", [[], ["event_type"]])
def test_windows_over_rows_are_sliced(spark, keys):
    """Of the two windows, one is over the rows of a slice and one over the table of slices."""
    events = spark.read.parquet(f"{FOLDER}/events.parquet").select("event_id", "event_type", "user_id")
    out = windows.numbered(events, "event_id", keys, rows_per_slice=50)
    over = [line for line in plan(out).splitlines() if "Window [" in line]
    assert len(over) == 2
    assert sum("__slice0" in line and "event_id" in line for line in over) == 1
    assert sum("__of___slice0" in line for line in over) == 1


CUT = [
    "rolling_sum", "rolling_min", "rolling_max", "rolling_minby", "rolling_maxby", "rolling_reduce", "sink_output_format",
    "win_session_all", "win_session_keyed", "win_tumbling_count_all", "win_tumbling_count_keyed", "win_sliding_count_all",
    "win_sliding_count_keyed", "wf_process_context", "wf_process_avg", "wm_periodic_custom", "wm_punctuated_custom",
    "wm_aligned_parallel", "wm_idle_source", "late_drop", "late_allowed", "late_side_output", "state_value_ttl",
    "state_value_sum", "savepoint_resume", "state_broadcast_enrich",
]


@pytest.mark.parametrize("name", CUT)
def test_query_over_slices(spark, db, monkeypatch, name):
    """The same results when nearly every group is too large for a task."""
    monkeypatch.setattr(ordered, "ROWS_FLOOR", 15)
    monkeypatch.setattr(ordered, "ROWS_CEILING", 40)
    df = contract.queries()[name](spark, FOLDER)
    assert differences(df, db, contract.oracle_sql()[name]) == []
