"""Steps over all lines of all legs: what is sorted, and how often rows are dealt."""

import re

from fieldlens.operators import crew
from fieldlens.sources import roles, tables


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _below_last_exchange(plan: str) -> str:
    return plan[plan.rindex("Exchange"):]


def test_no_scan_task_sorts_its_lines_for_the_current_revision(spark, root):
    plan = _plan(roles.current_revisions(spark, root))
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1
    assert "Sort" not in _below_last_exchange(plan)


def test_stage_rows_hold_no_derived_columns(spark, root):
    rows = roles.stage_rows(spark, root)
    assert not {"pickup_time", "clear_time", "source_database", "market"} & set(rows.columns)
    assert sorted(roles.stage_columns(spark, root, rows).collect()) == sorted(roles.stage_times(spark, root).collect())


def test_crew_steps_deal_their_rows_once(spark, root, tmp_path):
    link = roles.crew_link(spark, root)
    assert re.search(r"Exchange hashpartitioning\(l_orderkey#\d+L, \d+\)", _plan(link))  # by leg alone, for the distinct and the join
    rc = crew.run_crew(roles.stage_times(spark, root), link, crew.crew_seats(
        roles.crew_shifts(spark, root, link), roles.cost_centers(spark, root), roles.users(spark, root), roles.valid_cost_centers(spark)))
    rc.write.parquet(f"{tmp_path}/run_crew")
    stored = spark.read.parquet(f"{tmp_path}/run_crew")
    assert _plan(crew.shift_metrics(stored).drop("total_run_numbers")).count("Exchange hashpartitioning") == 1


def test_partitions_follow_the_table(spark, root, tmp_path):
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert tables.parts_of(spark, root, "lineitem") == least
    (tmp_path / "lineitem.parquet").write_bytes(b"0" * ((least + 3) << 20))
    assert tables.parts_of(spark, str(tmp_path), "lineitem", mb=1) == least + 3
