from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veriframe.operators import sets
from veriframe.operators.registry import (
    check_feature_service, check_feature_services, check_feature_view, columns_frame,
)

D = dt.date


def texts(spark, values, name="v"):
    return spark.createDataFrame([(v,) for v in values], f"{name} string")


@pytest.mark.parametrize("actual, expected, mode, status", [
    (["a", "a", "b"], ["a", "b"], sets.EXACT, "pass"), (["a"], ["a", "b"], sets.EXACT, "fail"),
    (["a", "b"], ["a"], sets.SUPERSET, "pass"), (["a", "b"], ["a"], sets.SUBSET, "fail"),
    ([], [], sets.EXACT, "pass"), ([None], [None], sets.EXACT, "pass"), ([None], [], sets.EXACT, "fail"),
])
def test_check_sets(spark, actual, expected, mode, status):
    assert sets.check_sets(texts(spark, actual), texts(spark, expected), "v", mode=mode).first().status == status


def test_values_in_frame(spark):
    df, allowed = texts(spark, ["a", "b", "b", None]), texts(spark, ["a"], "w")
    assert sets.check_values_in(df, "v", allowed).first().violations == 1
    assert sets.check_values_in(df, "v", allowed, exclude_null=False).first().violations == 2
    both = texts(spark, ["a", "b", None], "w")
    assert sets.check_values_in(df, "v", both, exclude_null=False).first().status == "pass"


def test_schema_ignores_order_and_top_nullability_only(spark):
    actual = T.StructType([
        T.StructField("b", T.StringType(), False), T.StructField("a", T.ArrayType(T.StringType(), True)),
    ])
    same = {"a": T.ArrayType(T.StringType(), True), "b": T.StringType()}
    assert {r.status for r in sets.check_schema(spark, actual, same).collect()} == {"pass"}
    nested = {"a": T.ArrayType(T.StringType(), False), "b": T.StringType(), "c": T.LongType()}
    found = {r.column: r.status for r in sets.check_schema(spark, actual, nested).collect()}
    assert found == {"a": "fail", "b": "pass", "c": "fail"}


@pytest.mark.parametrize("days, start, end, status, missing", [
    ([D(2024, 1, 1), D(2024, 1, 2)], D(2024, 1, 1), D(2024, 1, 2), "pass", 0),
    ([D(2024, 1, 1), D(2024, 1, 3), None], D(2024, 1, 1), D(2024, 1, 3), "fail", 1),
    ([], D(2024, 1, 2), D(2024, 1, 1), "pass", 0), ([], D(2024, 1, 1), D(2024, 1, 1), "fail", 1),
    ([D(2023, 1, 1)], D(2024, 1, 1), D(2024, 1, 1), "fail", 1),
])
def test_date_coverage(spark, days, start, end, status, missing):
    df = spark.createDataFrame([(d,) for d in days], "d date")
    found = sets.check_date_coverage(df, "d", start, end).first()
    assert (found.status, found.violations) == (status, missing)


def test_date_gaps(spark, rows):
    data = [("a", D(2024, 1, 2)), ("a", D(2024, 1, 2)), ("a", D(2024, 1, 5)), ("b", D(2023, 1, 1)), ("c", None)]
    df = spark.createDataFrame(data, "k string, d date")
    whole = (D(2024, 1, 1), D(2024, 1, 5), 5)
    assert rows(sets.date_gaps(df, "d", ["k"], D(2024, 1, 1), D(2024, 1, 5))) == [
        ("a", D(2024, 1, 1), D(2024, 1, 1), 1), ("a", D(2024, 1, 3), D(2024, 1, 4), 2),
        ("b", *whole), ("c", *whole),
    ]


def test_equality_is_a_multiset(spark):
    nan = float("nan")
    left = spark.createDataFrame([(1, nan), (2, None), (2, None)], "a int, b double")
    right = spark.createDataFrame([(2, None), (1, nan), (2, None)], "a int, b double")
    assert sets.check_equality(left, right).first().status == "pass"
    found = sets.check_equality(left, right.limit(2)).first()
    assert (found.status, found.violations) == ("fail", 1)


def test_equality_sees_schema(spark):
    left = spark.createDataFrame([(1, 2)], "a int, b int")
    assert sets.check_equality(left, left.select("b", "a")).first().target == "schema"
    strict = spark.createDataFrame([(1, 2)], T.StructType([
        T.StructField("a", T.IntegerType(), False), T.StructField("b", T.IntegerType())]))
    assert sets.check_equality(left, strict).first().status == "pass"
    assert sets.check_equality(left, strict, nullability=True).first().status == "fail"


@pytest.mark.parametrize("seed", range(4))
def test_reconcile_laws(spark, seed):
    rng = random.Random(seed)

    def some():
        data = [(rng.choice([None, 1, 2, 3]), rng.choice(["x", "y", None])) for _ in range(rng.randint(0, 60))]
        return spark.createDataFrame(data, "a int, b string")

    a, b = some(), some()
    assert sets.reconcile(a, a).count() == 0
    only_left = sum(max(r.left_rows - r.right_rows, 0) for r in sets.reconcile(a, b).collect())
    only_right = sum(max(r.right_rows - r.left_rows, 0) for r in sets.reconcile(a, b).collect())
    assert only_left == a.exceptAll(b).count() and only_right == b.exceptAll(a).count()
    kept = sets.membership(a, "a", b.select("a")).count()
    assert kept + a.join(b.select("a").distinct(), "a", "left_anti").count() == a.count()


def test_feature_registry(spark):
    registry = spark.createDataFrame(
        [("v1", "id", "entity"), ("v1", "x", "feature"), ("v2", "id", "entity"), ("v2", "y", "feature")],
        "view string, column string, role string",
    )
    services = spark.createDataFrame([("s", "v1"), ("s", "v2")], "service string, view string")
    table = spark.createDataFrame([(1, 2, 3)], "id int, x int, y int")
    found = check_feature_view(registry, columns_frame(table), "v1").where("in_actual <> in_expected").collect()
    assert [tuple(r) for r in found] == [("y", True, False)]
    service = check_feature_service(registry, services, columns_frame(table), "s")
    assert service.where("in_actual <> in_expected").count() == 0 and service.count() == 3
    named = columns_frame(table).selectExpr("'s' AS service", "column")
    assert check_feature_services(registry, services, named).first().status == "pass"


ODD_ROWS = [(1, None, 0.0, ("a", None), [1, None]), (None, 1, -0.0, (None, "a"), [None, 1]), (1, None, float("nan"), None, []), (None, None, None, ("a", None), None)]
ODD_SCHEMA = "a int, b int, x double, s struct<p: string, q: string>, l array<int>"


@pytest.mark.parametrize("buckets", [1, 4, 4096])
def test_reconcile_by_digests_equals_counting(spark, buckets):
    draw = random.Random(buckets)
    left = [draw.choice(ODD_ROWS) for _ in range(60)] + [(k, k % 3, k / 7, ("p", str(k)), [k]) for k in range(200)]
    right = [draw.choice(ODD_ROWS) for _ in range(55)] + [(k, k % 3, k / 7, ("p", str(k)), [k]) for k in range(203) if k != 50] + [left[-1]]
    plain = lambda row: repr(row).replace("-0.0", "0.0")
    counts = {k: (sum(plain(r) == k for r in left), sum(plain(r) == k for r in right)) for k in {plain(r) for r in left + right}}
    frames = [spark.createDataFrame(rows, ODD_SCHEMA) for rows in (left, right)]
    found = {plain((r.a, r.b, r.x, tuple(r.s) if r.s else None, list(r.l) if r.l is not None else None)): (r.left_rows, r.right_rows)
             for r in sets.reconcile(*frames, buckets=buckets).collect()}
    assert found == {k: v for k, v in counts.items() if v[0] != v[1]}


def test_compensating_changes_in_one_bucket_are_found(spark):
    left = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "k int, v int")
    for rows in ([(1, 20), (2, 10), (3, 30)], [(1, 10), (1, 10), (3, 30)], [(1, 11), (2, 19), (3, 30)]):
        right = spark.createDataFrame(rows, "k int, v int")
        assert sets.differing_buckets(left, right, ["k", "v"], 1) == [0]
        assert sets.check_equality(left, right).first().status == "fail"
    assert sets.differing_buckets(left, left.orderBy(F.desc("k")), ["k", "v"], 1) == []


def test_equal_tables_are_not_compared_row_by_row(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    plan = sets.reconcile(orders, orders.repartition(5))._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan
    assert sets.check_equality(orders, orders.repartition(5)).first().status == "pass"


def test_date_gaps_of_long_ranges_cross_numbers(spark):
    start, end = D(2023, 1, 1), D(2024, 12, 31)
    size, draw = (end - start).days + 1, random.Random(4)
    held = {k: set(draw.sample(range(size), n)) for k, n in (("a", 5), ("b", 400), ("c", size), ("d", 0))}
    held["e"] = set(range(size)) - {0, 62, 63, 64, 125, 126, size - 1}
    data = [(k, start + dt.timedelta(days=d)) for k, days in held.items() for d in days] + [("d", None)]
    found = {}
    for r in sets.date_gaps(spark.createDataFrame(data, "k string, day date"), "day", ["k"], start, end).collect():
        found.setdefault(r.k, []).append(((r.gap_start - start).days, (r.gap_end - start).days, r.days))
    for k, days in held.items():
        edges = sorted(days | {-1, size})
        assert sorted(found.get(k, [])) == [(a + 1, b - 1, b - a - 1) for a, b in zip(edges, edges[1:]) if b - a > 1]
