"""Plan-shape checks: no Python UDFs, no global windows, pruning, one scan where promised."""

import os
import re

import pytest
from pyspark.sql import functions as F

from paths import SF_SMALL
from salesmart.plans.catalog import MARTS, Inputs


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(MARTS))
def test_marts_have_no_python_udf_and_no_window(spark, key):
    plan = plan_text(MARTS[key](spark, SF_SMALL))
    assert not re.search(r"PythonUDF|BatchEvalPython|ArrowEvalPython", plan)
    assert "Window" not in plan, "first-row flags are aggregates, not windows"
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_headcount_reads_users_once(spark):
    """Both branches read one aggregate; when it runs, its exchange is made once and reused."""
    execution = Inputs(spark, SF_SMALL).p7()._jdf.queryExecution()
    execution.toRdd().count()
    final = execution.executedPlan().toString().split("== Initial Plan ==")[0]
    assert len(re.findall(r"customer\.parquet", final)) == 1


def test_lookup_salts_null_keys(spark):
    plan = plan_text(Inputs(spark, SF_SMALL).p8())
    assert "_fact_salt" in plan and "_dim_salt" in plan
    assert "(_fact_salt = 0)" not in plan, "salt must stay a join key, not a folded filter"


def test_snapshot_day_filter_prunes_date_partitions(spark, scratch):
    """On the stored, date-partitioned snapshot the day-5 filter becomes a partition filter."""
    inputs = Inputs(spark, SF_SMALL)
    path = os.path.join(scratch, "daily_personnel")
    inputs.snapshot().write.partitionBy("date").parquet(path)
    stored = spark.read.parquet(path)
    plan = plan_text(stored.where(F.dayofmonth("date") == 5).select("id"))
    assert re.search(r"PartitionFilters: \[[^\]]*dayofmonth", plan)


def test_scan_prunes_columns(spark):
    plan = plan_text(Inputs(spark, SF_SMALL).p8())
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
    orders_scans = [s for s in scans if "o_orderkey" in s]
    assert orders_scans and all("o_comment" not in s for s in orders_scans)
    assert all(len(s.split(",")) <= 6 for s in scans)


def test_the_deal_marts_two_branches_compute_the_staff_once(spark):
    from salesmart.plans.catalog import queries
    df = queries()["mart_dm_sales_staff_deals"](spark, SF_SMALL)
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    final = execution.executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("partial_collect_set") == 1
