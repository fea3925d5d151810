from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from veriframe.operators import row_checks as rc
from veriframe.operators.distinct import check_constant_by, check_unique, duplicates
from veriframe.operators.results import assertion_rows
from veriframe.operators.verdict import RESULT_COLUMNS
from veriframe.plans.suite import run_suite

NAN = float("nan")


def frame(spark, values, kind="double"):
    return spark.createDataFrame([(v,) for v in values], f"a {kind}")


def status(df):
    return [(r.status, r.violations) for r in df.collect()]


@pytest.mark.parametrize("values, expected", [
    ([], ("pass", 0)), ([1.0], ("pass", 0)), ([NAN], ("pass", 0)), ([None, 1.0, None], ("fail", 2)),
])
def test_no_null(spark, values, expected):
    assert status(rc.run_row_checks(frame(spark, values), [rc.no_null("a")])) == [expected]


@pytest.mark.parametrize("values, expected", [
    ([], ("fail", 1)), ([None, None], ("pass", 0)), ([1.0, 1.0], ("pass", 0)), ([1.0, None], ("fail", 1)),
    ([1.0, 2.0], ("fail", 1)), ([NAN, NAN], ("pass", 0)), ([NAN, 1.0], ("fail", 1)),
])
def test_constant(spark, values, expected):
    assert status(rc.run_row_checks(frame(spark, values), [rc.constant("a")])) == [expected]


@pytest.mark.parametrize("values, expected", [
    (["x", "x"], ("pass", 0)), (["x", "y"], ("fail", 1)), ([None, "x"], ("fail", 1)), ([], ("fail", 1)),
])
def test_constant_text(spark, values, expected):
    assert status(rc.run_row_checks(frame(spark, values, "string"), [rc.constant("a")])) == [expected]


@pytest.mark.parametrize("values, expected", [
    ([], ("error", 0)), ([None], ("error", 0)), ([1.0, 5.0, None], ("pass", 0)),
    ([0.5, 5.0], ("fail", 1)), ([2.0, NAN], ("fail", 1)), ([0.0, 6.0], ("fail", 2)),
])
def test_range(spark, values, expected):
    assert status(rc.run_row_checks(frame(spark, values), [rc.value_range("a", 1, 5)])) == [expected]


def test_range_bounds_of_other_types(spark):
    money = frame(spark, [Decimal("1.50"), Decimal("9.99")], "decimal(10,2)")
    assert status(rc.run_row_checks(money, [rc.value_range("a", Decimal("1.5"), Decimal("9.99"))])) == [("pass", 0)]
    days = frame(spark, [dt.date(2024, 1, 1), dt.date(2024, 1, 9)], "date")
    check = rc.value_range("a", dt.date(2024, 1, 2), dt.date(2024, 1, 9))
    assert status(rc.run_row_checks(days, [check])) == [("fail", 1)]


@pytest.mark.parametrize("values, exclude_null, expected", [
    (["x", None], True, ("pass", 0)), (["x", None], False, ("fail", 1)), (["x", "z", "z"], True, ("fail", 2)),
    ([], True, ("pass", 0)),
])
def test_allowed_values(spark, values, exclude_null, expected):
    check = rc.allowed_values("a", ["x", "y"], exclude_null)
    assert status(rc.run_row_checks(frame(spark, values, "string"), [check])) == [expected]


def test_allowed_values_with_null_listed(spark):
    check = rc.allowed_values("a", ["x", None], exclude_null=False)
    assert status(rc.run_row_checks(frame(spark, ["x", None], "string"), [check])) == [("pass", 0)]


def test_rule_counts_an_unknown_answer_as_violation(spark):
    check = rc.row_rule("positive", F.col("a") > 0)
    assert status(rc.run_row_checks(frame(spark, [1.0, None, -1.0]), [check])) == [("fail", 2)]


def test_some_message_is_literal(spark):
    lines = frame(spark, ["100% done", "a.b"], "string")
    found = rc.run_row_checks(lines, [rc.some_message("a", ["a.b"]), rc.some_message("a", ["axb"]),
                                      rc.some_message("a", ["10.%"], regex=True), rc.some_message("a", ["10.%"])])
    assert [r.status for r in found.collect()] == ["pass", "fail", "pass", "fail"]


def test_grouped_checks(spark):
    df = spark.createDataFrame([("g", 1.0), ("g", None), ("h", 9.0)], "k string, a double")
    found = rc.run_row_checks(df, [rc.no_null("a"), rc.value_range("a", 1, 5)], ["k"]).collect()
    assert {(r.k, r.check, r.status) for r in found} == {
        ("g", "no_null", "fail"), ("g", "value_range", "pass"), ("h", "no_null", "pass"), ("h", "value_range", "fail"),
    }
    assert {r.group_key for r in found} == {'{"k":"g"}', '{"k":"h"}'}


@pytest.mark.parametrize("values, expected", [
    ([], ("pass", 0)), ([None], ("pass", 0)), ([None, None], ("fail", 1)), ([1.0, 2.0], ("pass", 0)),
    ([1.0, 1.0, 1.0], ("fail", 2)), ([NAN, NAN], ("fail", 1)),
])
def test_unique(spark, values, expected):
    assert status(check_unique(frame(spark, values), "a")) == [expected]


def test_a_column_called_n(spark):
    df = frame(spark, [1.0, 1.0, 2.0]).withColumnRenamed("a", "n")
    assert status(check_unique(df, "n")) == [("fail", 1)]


def test_duplicates_keep_hot_values_whole(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("a"))
    assert [tuple(r) for r in duplicates(df, "a").collect()] == [(0, 10_000)]


def test_constant_by_group(spark):
    df = spark.createDataFrame([("g", "x"), ("g", "x"), ("h", "x"), ("h", None)], "k string, a string")
    found = check_constant_by(df, "a", ["k"])
    assert {(r.k, r.status, r.violations) for r in found.collect()} == {("g", "pass", 0), ("h", "fail", 1)}


def test_suite_has_one_schema_and_error_rows(spark):
    df = frame(spark, [1.0, None])
    suite = run_suite(df, [
        rc.no_null("a"), rc.no_null("missing"), rc.value_range("a", 0, 2),
        ("unique", lambda t: check_unique(t, "a")), ("broken", lambda t: check_unique(t, "nope")),
    ])
    assert suite.columns == RESULT_COLUMNS
    found = {(r.check, r.target): r for r in suite.collect()}
    assert found["no_null", "a"].status == "fail"
    assert found["no_null", "missing"].status == "error" and "missing" in found["no_null", "missing"].observed
    assert found["value_range", "a"].status == "pass"
    assert found["value_range", "a"].params == '{"high":"2","low":"0"}'
    assert found["unique", "a"].status == "pass"
    assert found["broken", "*"].status == "error"


def test_suite_lets_other_failures_through(spark):
    def explode(_):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        run_suite(frame(spark, [1.0]), [("x", explode)])


def test_assertion_report(spark):
    report = assertion_rows(run_suite(frame(spark, [1.0, None]), [
        rc.no_null("a"), rc.value_range("a", 0, 2), rc.no_null("gone"),
    ]), "Area").collect()
    found = {(r.assertions, r.assertion_result[:30]) for r in report}
    assert ("value_range", "Success") in found
    assert ("no_null", "AssertionError: no_null of a f") in found
    assert any("gone" in r.assertion_result and not r.assertion_result.startswith("Assertion") for r in report)
