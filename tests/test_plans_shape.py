"""What the physical plans must and must not contain."""

import time

import pytest
from conftest import TABLES
from pyspark.sql import functions as F

from tidyloom.operators.ordered import difference_to_previous
from tidyloom.queries import QUERIES
from tidyloom.queries.registry import in_year, table
from tidyloom.settings import BORDERS_PER_PARTITION

# Results of a fixed size may pass one task; nothing may be compared pairwise or leave the JVM.
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"]


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_pairwise_joins_and_no_python(spark, name):
    plan = plan_of(QUERIES[name](spark, TABLES))
    assert [bad for bad in FORBIDDEN if bad in plan] == []


def test_filters_reach_the_scan(spark):
    plan = plan_of(table(spark, TABLES, "orders").where(in_year("o_orderdate", 1997)).groupBy("o_custkey").count())
    assert "GreaterThanOrEqual(o_orderdate,1997-01-01" in plan and "LessThan(o_orderdate,1" in plan


def test_only_needed_columns_are_read(spark):
    plan = plan_of(QUERIES["q_sum_by_status"](spark, TABLES))
    assert "ReadSchema: struct<o_totalprice:double,o_orderpriority:string>" in plan


def test_top_of_group_is_cut_before_the_shuffle(spark):
    plan = plan_of(QUERIES["q_lowest5"](spark, TABLES))
    assert plan.count("WindowGroupLimit") == 2 and plan.index("Final") < plan.index("Exchange hashpartitioning") < plan.index("Partial")


def test_split_running_total_has_no_single_task_window(spark, split):
    from pyspark.sql import functions as F

    from tidyloom.operators.ordered import running_sum

    frame = running_sum(spark.range(1000).withColumn("x", F.col("id")), [], [F.col("id")], F.col("x"), "total")
    plan = plan_of(frame)
    # The one window left works on one row for each range, not on the table.
    assert "SinglePartition" not in plan.split("BroadcastExchange")[0]
    assert frame.agg(F.max("total")).first()[0] == 999 * 1000 // 2


@pytest.mark.parametrize("name", ["q_unbooked_seats", "q_scaffold_month"])
def test_grids_are_dealt_out_and_their_keys_not_broadcast(spark, name):
    plan = plan_of(QUERIES[name](spark, TABLES))
    assert "REPARTITION_BY_NUM" in plan
    assert [line for line in plan.splitlines() if "BroadcastHashJoin [_block" in line] == []


def test_plans_do_not_grow_with_the_number_of_borders(spark):
    # 14 steps of search; each of them tripled the work of planning.
    spark.conf.set(BORDERS_PER_PARTITION, str(1 << 12))
    try:
        frame = difference_to_previous(spark.range(100).withColumn("key", F.col("id") % 3), ["key"], [F.col("id")], F.col("id"), "step")
        began = time.time()
        plan_of(frame)
        assert time.time() - began < 20
        assert frame.where("step = 3").count() == 97 and frame.where("step is null").count() == 3
    finally:
        spark.conf.unset(BORDERS_PER_PARTITION)
