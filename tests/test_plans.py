"""Plans that must hold at scale."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from veriframe.operators import logs, row_checks as rc, sensors, sets
from veriframe.operators.distinct import check_unique
from veriframe.operators.profile import metric, profile
from veriframe.operators.transform import DAY, create_views, daily_sum
from veriframe.plans import standins as st
from veriframe.sources.publish import REGISTER, write_registered
from veriframe.sources.tables import load, write_partitioned


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def large(spark):
    """Plans as for tables whose size rules out a broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("key", sorted(queries()))
def test_no_cross_join_and_no_python(spark, sf, large, key):
    text = plan(queries()[key](spark, sf))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "PythonRDD"):
        assert word not in text


def test_row_checks_share_one_pass(spark, sf):
    lineitem = load(spark, sf, "lineitem")
    text = plan(rc.run_row_checks(lineitem, [
        rc.no_null("l_tax"), rc.value_range("l_quantity", 1, 50), rc.allowed_values("l_returnflag", ["A"]),
        rc.constant("l_discount"), rc.row_rule("r", F.col("l_tax") >= 0),
    ]))
    assert text.count("FileScan") == 1 and "SortAggregate" not in text
    assert "ReadSchema: struct<l_quantity:double,l_discount:double,l_tax:double,l_returnflag:string>" in text


def test_filters_reach_the_scan(spark, sf):
    orders = load(spark, sf, "orders")
    text = plan(logs.where_equal(orders, {"o_orderstatus": "F", "o_custkey": 7}).select("o_orderkey"))
    assert "EqualTo(o_orderstatus,F)" in text and "EqualTo(o_custkey,7)" in text


def test_newest_rows_are_reduced_before_the_shuffle(spark, sf):
    rows = sensors.latest_sensor(st.sensor_log(spark, sf), dt.date(2024, 1, 1), dt.date(2024, 1, 31))
    assert "row_number(), 1, Partial" in plan(rows)


def test_the_gate_needs_no_sort(spark, sf):
    text = plan(sensors.gate(st.sensor_log(spark, sf), dt.date(2024, 1, 1), dt.date(2024, 1, 31)))
    assert "Sort" not in text and "partial_max" in text


def test_sets_compare_in_one_shuffle(spark, sf):
    events = st.events(spark, sf)
    text = plan(sets.compare_sets(events.select("day"), events.select("day"), ["day"]))
    assert text.count("Exchange") == 1 and "Join" not in text


def test_uniqueness_counts_before_the_shuffle(spark, sf):
    text = plan(check_unique(load(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"]))
    assert "partial_count(1)" in text and "Expand" not in text


def test_mutual_information_has_no_join(spark, sf):
    assert "Join" not in plan(profile(load(spark, sf, "orders"), [metric("MutualInformation", "o_orderstatus", "o_orderpriority")]))


def test_quantiles_stay_apart_from_plain_metrics(spark, sf):
    text = plan(profile(load(spark, sf, "orders"), [metric("Mean", "o_totalprice"), metric("ApproxQuantiles-0.25", "o_totalprice")]))
    assert text.count("FileScan") == 2 and "ObjectHashAggregate" in text
    assert any("HashAggregate" in line and "avg" in line and "Object" not in line for line in text.splitlines())


def test_monthly_views_prune_partitions(spark, sf, large, tmp_path):
    path = str(tmp_path / "out")
    write_partitioned(daily_sum(st.transactions(spark, sf)), path, [DAY])
    spark.read.parquet(path).createOrReplaceTempView("pruned_output")
    names = create_views(spark, "pruned_output", temporary=True)
    for kind in ("technical_monthly", "business_monthly"):
        view = spark.table(names[kind])
        assert "dynamicpruning" in plan(view)
        view.collect()
        # The pruning survives adaptive planning, and the join sits below the aggregate.
        final = plan(view).split("== Initial Plan ==")[0]
        assert "SubqueryBroadcast dynamicpruning" in final
        if kind == "business_monthly":
            assert final.index("HashAggregate") < final.index("BroadcastHashJoin")


def test_monthly_views_take_month_ends_from_the_register(spark, sf, tmp_path):
    path = str(tmp_path / "out")
    write_registered(daily_sum(st.transactions(spark, sf)), path, [DAY])
    spark.read.parquet(path).createOrReplaceTempView("registered_output")
    names = create_views(spark, "registered_output", temporary=True, days=f"parquet.`{path}/{REGISTER}`")
    ends = {(d.year, d.month): d for d in sorted(p[0] for p in spark.read.parquet(path).select(DAY).distinct().collect())}.values()
    for kind in ("technical_monthly", "business_monthly"):
        view = spark.table(names[kind])
        assert {r[DAY] for r in view.select(DAY).distinct().collect()} == set(ends)
        view.collect()
        # the table is scanned once, with run-time pruning; the month ends are read from the register
        final = plan(view).split("== Initial Plan ==")[0]
        scans = [line for line in final.splitlines() if "FileScan" in line and REGISTER not in line]
        assert all("dynamicpruning" in line for line in scans)


def test_distinct_metrics_of_five_columns_scan_once(spark, sf):
    columns = ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate")
    text = plan(profile(load(spark, sf, "orders"), [metric(n, c) for c in columns for n in ("CountDistinct", "Uniqueness")]))
    assert text.count("FileScan") == 1
