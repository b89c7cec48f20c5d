"""Every registered query against its SQL twin, and what its plan must not hold."""

import compare
import pytest

import workload.oracle
import workload.queries

import __spark_entry__ as entry_point

QUERIES = workload.queries.QUERIES
SQL = workload.oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return compare.connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_as_sql(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name != "grouped_map":
        assert "Python" not in plan and "InPandas" not in plan
    assert compare.difference(df.toPandas(), duck.execute(SQL[name]).df()) is None


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


def test_day_range_reaches_the_scan(spark, sf_dir):
    plan = QUERIES["time_range_scan"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(ts," in plan and "LessThanOrEqual(ts," in plan and "props" not in plan


def test_turbines_without_marks_are_left_out(spark, sf_dir, monkeypatch):
    named = workload.queries.QUERIES["turbine_sets"]
    before = {r.wtg_id for r in named(spark, sf_dir).collect()}
    gone, real = min(before), workload.queries.view

    def view(spark, sf, name):
        rows = real(spark, sf, name)
        return rows.where(rows["wtg_id"] != gone) if name == "telemetry_10m" else rows

    monkeypatch.setattr(workload.queries, "view", view)
    assert {r.wtg_id for r in named(spark, sf_dir).collect()} == before - {gone}
