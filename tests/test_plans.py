"""Plan-shape guards for every registered query (the properties that matter at scale)."""

import re

import pytest

import __spark_entry__ as E

from conftest import SF001

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_no_cartesian_or_nested_loop(spark, name):
    plan = _plan(E.queries()[name](spark, SF001))
    for bad in FORBIDDEN:
        assert bad not in plan, f"{name} plans a {bad}"


def test_scans_are_pruned_and_filters_pushed(spark):
    df = E.queries()["scan_select"](spark, SF001)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string,"
                     r"o_orderdate:timestamp(_ntz)?>", plan)
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in plan


def test_current_dim_filter_reaches_parquet(spark, tmp_path):
    dim = spark.createDataFrame([(1, True), (2, False)], "k int, is_current boolean")
    dim.write.parquet(str(tmp_path / "d"))
    from tidewater.sources.tables import read_table
    from pyspark.sql import functions as F
    plan = _plan(read_table(spark, str(tmp_path / "d")).filter(F.col("is_current")))
    assert "EqualTo(is_current,true)" in plan


def test_violations_are_told_apart_by_numbers(spark):
    """Ids are made of the two numbers after the dedupe, not carried through its shuffle as text."""
    from tidewater.plans import standin as S
    plan = _plan(S.silver_violations(spark, SF001))
    assert "hashpartitioning(l_orderkey" in plan and "hashpartitioning(inspection_id" not in plan


def test_scratch_and_gold_tables_are_compressed(spark, tmp_path):
    from tidewater.session import stored
    from tidewater.sinks import write_table
    df = spark.range(5)
    assert all(".zstd." in f for f in stored(df, "t").inputFiles())
    assert all(".zstd." in f for f in spark.read.parquet(write_table(df, str(tmp_path / "t"))).inputFiles())
