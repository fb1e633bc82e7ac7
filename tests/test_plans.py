"""Plan-shape checks: the properties that make the operators hold at scale, plus the
report smoke test (typed, ordered, five rows, CSV written)."""

import glob
import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_mod
from tessera.operators.reports import class_report
from tessera.plans.export_frame import export_frame
from tessera.sinks.writers import write_csv_report

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_report_rows_and_their_csv(spark, tmp_dir):
    frame = spark.createDataFrame(
        [("A*01", "I", 2000, 10, 18)] * 3 + [("A*02", "I", 1998, 1, 10)] * 2 + [("A*02", "I", 1998, 1, 11)]
        + [("B*01", "I", 1997, 1, 9), ("C*01", "II", 2001, 1, 9), (None, "I", 2001, None, None)],
        "mhc_restriction_name string, mhc_restriction_class string, reference_date int, epitope_starting_position int, "
        "epitope_ending_position int")
    report = class_report(frame, "I", 1998, 5)
    expected = [("A*01", 3, 9.0), ("A*02", 3, 10.3), (None, 1, None)]
    assert [tuple(r) for r in report.collect()] == expected
    out = os.path.join(tmp_dir, "report")
    write_csv_report(report, out, order_by=[F.desc("assays"), F.asc_nulls_last("mhc_restriction_name")])
    back = spark.read.schema(report.schema).option("header", True).csv(out)
    assert sorted(map(repr, map(tuple, back.collect()))) == sorted(map(repr, expected))


def test_single_file_report_keeps_the_tasks_before_it(spark, tmp_dir):
    out = os.path.join(tmp_dir, "one")
    write_csv_report(spark.range(0, 1000, 1, 8).toDF("k"), out, single_file=True, order_by=["k"])
    assert len(glob.glob(out + "/*.csv")) == 1
    assert [r.k for r in spark.read.schema("k long").option("header", True).csv(out).collect()] == list(range(1000))


def test_quality_report_reads_each_table_once(spark):
    plan = _plan(entry_mod.queries()["quality_checks"](spark, SF))
    assert plan.count("FileScan") == 2


def test_lineitem_shuffles_once_without_a_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(export_frame(spark, SF))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.count("Exchange") == 2  # one for each side of the join


def test_scratch_tables_are_released(spark):
    from tessera.session import path_exists, release_scratch, scratch_path

    path = scratch_path(spark, "t")
    spark.range(3).write.parquet(path)
    assert release_scratch(spark) >= 1
    assert not path_exists(spark, path)


def test_reduction_is_one_partial_aggregate_and_one_shuffle(spark):
    plan = _plan(entry_mod.queries()["reduced_table"](spark, SF))
    assert "partial_mode" in plan and "partial_collect_set" in plan
    # one exchange for the grain (plus the small-scan spreading exchange)
    assert plan.count("Exchange hashpartitioning(sequence") == 1
    assert "SortMergeJoin" not in plan


def test_best_per_key_limits_before_the_shuffle(spark):
    plan = _plan(entry_mod.queries()["best_per_key"](spark, SF))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_report_is_take_ordered(spark):
    plan = _plan(entry_mod.queries()["class_report"](spark, SF))
    assert "TakeOrderedAndProject" in plan


def test_lookup_filter_reaches_the_scan(spark, tmp_dir):
    from tessera.operators.ranking import exact_lookup
    from tessera.plans.epitope_table import reduced_table
    from tessera.sinks.writers import write_reduced_table

    red = write_reduced_table(reduced_table(spark, SF), os.path.join(tmp_dir, "red"))
    plan = _plan(exact_lookup(red, "sequence", "SMALLRING"))
    assert "PushedFilters: [IsNotNull(sequence), EqualTo(sequence,SMALLRING)]" in plan


def test_distance_kernel_runs_once(spark):
    plan = _plan(entry_mod.queries()["fuzzy_join"](spark, SF))
    assert plan.count("ArrowEvalPython") == 1
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
