"""Plan shape: no nested-loop joins, cartesian products or Python UDFs in any query, and
the keep-first-per-key operators get a partial top-1 before their shuffle."""

import pytest

import __spark_entry__ as E
from fieldlens.operators import keys
from fieldlens.sources import tables

FORBIDDEN = ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython", "PythonUDF")
ROOT = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", sorted(k for k in E.queries() if not k.startswith("stream_")))
def test_no_nested_loop_or_python(spark, key):
    plan = E.queries()[key](spark, ROOT)._jdf.queryExecution().executedPlan().toString()
    assert not [p for p in FORBIDDEN if p in plan]


def test_top1_is_limited_before_shuffle(spark):
    li = tables.load_table(spark, ROOT, "lineitem")
    df = keys.distinct_on(li, ["l_orderkey"], [("l_linenumber", "desc")])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2  # partial (map side) and final


def test_scan_pruned_and_pushed(spark):
    e = tables.load_table(spark, ROOT, "events", ["event_id", "ts"])
    import datetime as dt
    df = tables.window_scan(e, "ts", dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 17))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plan


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_one_scan_for_all_column_tests(spark, root):
    from fieldlens.operators import quality
    df = spark.read.parquet(f"{root}/customer.parquet")
    checks = quality.dq_column_checks(df, "customer", not_null=["c_custkey", "c_name", "c_nationkey"], unique=["c_custkey"])
    assert _plan(checks).count("FileScan") == 1
    assert {(r.test, r.status) for r in checks.collect()} == {("not_null", "pass"), ("unique", "pass")}


def test_sweeps_read_orders_alone(spark, root):
    from fieldlens.plans import queries as Q
    for q in (Q.q_reconcile_weekly, Q.q_week_chunks):
        plan = _plan(q(spark, root))
        assert plan.count("FileScan") == 1 and "SortMergeJoin" not in plan


def test_units_are_counted_without_expand(spark, root):
    from fieldlens.plans import queries as Q
    assert "Expand" not in _plan(Q.q_labour_hours(spark, root))
    assert "Expand" not in _plan(Q.q_scheduling_summary(spark, root))


def test_no_shared_folder_is_an_error_off_one_machine():
    import pytest

    from fieldlens import session

    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "spark://host:7077"}.get(key, default)

    class Context:
        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError):
        session.ensure_checkpoint_dir(Session())
