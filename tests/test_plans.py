"""Registered queries: DuckDB oracle agreement at sf0.001 and plan shape."""
import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def registry():
    import __spark_entry__ as E
    return E.queries(), E.oracle_sql()


def test_every_oracle_has_a_query(registry):
    qs, sql = registry
    assert set(sql) <= set(qs) and len(qs) >= 50


def test_oracle_agreement(spark, registry):
    from oracle_check import duck, rows_of, type_diffs
    qs, sql = registry
    con = duck(SF)
    bad = []
    for name in sorted(sql):
        df = qs[name](spark, SF)
        s_rows = [tuple(r) for r in df.collect()]
        cur = con.execute(sql[name])
        d_cols = [d[0] for d in cur.description]
        d_rows = cur.fetchall()
        if sorted(df.columns) != sorted(d_cols) or rows_of(df.columns, s_rows) != rows_of(d_cols, d_rows):
            bad.append(name)
        elif type_diffs(df.dtypes, cur.description):
            bad.append(f"{name}: {type_diffs(df.dtypes, cur.description)}")
    assert bad == []


def test_entry_smoke(spark):
    import __spark_entry__ as E
    out = E.entry(spark)
    assert out.count() == 2 and "accuracy" in out.columns


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark, registry):
    qs, _ = registry
    plan = qs["q_history"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,value:double>" in plan


def test_hot_key_paths_avoid_single_partition(spark, registry):
    qs, _ = registry
    for name in ("q_sensor_clean", "q_rule_cleanse", "q_value_changes", "q_latest", "q_history"):
        assert "SinglePartition" not in _plan(qs[name](spark, SF)), name


def test_keep_first_is_an_aggregation_not_a_window(spark, registry):
    qs, _ = registry
    plan = _plan(qs["q_sensor_clean"](spark, SF))
    assert "min_by" in plan and "Window" not in plan and "HashAggregate" in plan
