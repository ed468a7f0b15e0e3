"""Physical-plan properties the design relies on at scale."""

import contextlib
import io

import numpy as np
import pytest

import __spark_entry__ as entry_mod
from conftest import SF_CHECK
from pinwheel.operators import kcenter, objective
from pinwheel.sources import tables


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def test_popularity_plan_is_pruned_partial_and_top_n(spark):
    plan = _plan(entry_mod.queries()["popularity_top_h"](spark, SF_CHECK))
    assert "TakeOrderedAndProject" in plan
    assert "partial_count" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double,l_returnflag:string>" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_country_filter_reaches_the_scan(spark):
    plan = _plan(entry_mod.queries()["popularity_report"](spark, SF_CHECK))
    assert "EqualTo(n_name,NATION_1)" in plan


@pytest.mark.parametrize("name", ["objective_partitioned", "objective_partitioned_many", "objective_distinct_many"])
def test_objectives_filter_before_the_shuffle(spark, name):
    """Whatever z: what falls short of the bound stays in its task, the rest is combined first."""
    plan = _plan(entry_mod.queries()[name](spark, SF_CHECK))
    head = plan[:plan.index("\n\n(1)")] if "\n\n(1)" in plan else plan
    assert "Filter" in head and head.index("Exchange") < head.rindex("Filter") and "Window" not in head


def test_filters_do_not_parse_lines_again(spark):
    """A filter reads the parsed columns; pushed below the parser it would split the line per mention."""
    df = entry_mod.queries()["tx_filter_country"](spark, SF_CHECK)
    filters = [line for line in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Filter" in line]
    assert any("NATION_2" in line for line in filters)
    assert not any("try_cast" in line or "split(" in line or "RLIKE" in line or "_t#" in line for line in filters)


def test_initial_guess_has_no_nested_loop(spark):
    plan = _plan(entry_mod.queries()["initial_guess_many"](spark, SF_CHECK))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_ball_queries_have_no_cross_join(spark):
    for name in ["ball_members", "ball_weights", "heaviest_ball"]:
        plan = _plan(entry_mod.queries()[name](spark, SF_CHECK))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_solution_covers_all_but_z(spark):
    for table in (tables.points_supplier, tables.points_customer):
        pts = table(spark, SF_CHECK)
        res = kcenter.kcenter_outliers(pts, 4, 6, 0.0)
        centers = np.array([r["coords"] for r in res.centers.collect()])
        coords = np.array([r["coords"] for r in pts.collect()])
        d = np.min(np.sqrt(((coords[:, None, :] - centers[None, :, :]) ** 2).sum(-1)), axis=1)
        assert (d > 3 * res.final_guess * (1 + 1e-12)).sum() <= 6
        o1 = objective.objective_value(objective.objective_distinct(pts, res.centers, 6))
        o3 = objective.objective_value(objective.objective_points(pts, res.centers, 6))
        assert o1 <= o3
