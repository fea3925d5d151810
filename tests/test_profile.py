from __future__ import annotations

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from veriframe.operators import anomaly
from veriframe.operators.metrics import (
    check_metric_date_list, check_metric_dates, check_profile_metrics, check_repository, latest_metrics,
)
from veriframe.operators.profile import histogram_counts, metric, profile
from veriframe.operators.transform import DAY, KEY, SUM_COLUMN, daily_sum
from veriframe.sources import generator as gen
from veriframe.sources import metrics as repository
from veriframe.sources.metrics import fold_metrics, read_documents, read_metrics, write_metrics

LOAD_DATE = dt.date(2023, 8, 31)


def values(df):
    return {(r.instance, r.name): r.value for r in df.collect()}


def test_metrics_of_a_small_column(spark):
    df = spark.createDataFrame([(1.0, "x"), (2.0, "x"), (3.0, "y"), (None, None)], "a double, b string")
    names = ["Completeness", "Mean", "Sum", "StandardDeviation", "Minimum", "Maximum", "ApproxQuantiles-0.25",
             "ApproxQuantiles-0.75", "CountDistinct", "Distinctness", "Uniqueness", "UniqueValueRatio"]
    found = values(profile(df, [metric("Size"), *[metric(n, "a") for n in names], metric("Uniqueness", "b")]))
    assert found["*", "Size"] == 4 and found["a", "Completeness"] == 0.75
    assert (found["a", "Mean"], found["a", "Sum"], found["a", "Minimum"], found["a", "Maximum"]) == (2, 6, 1, 3)
    assert found["a", "StandardDeviation"] == pytest.approx(math.sqrt(2 / 3))
    assert (found["a", "ApproxQuantiles-0.25"], found["a", "ApproxQuantiles-0.75"]) == (1, 3)
    assert (found["a", "CountDistinct"], found["a", "Distinctness"], found["a", "UniqueValueRatio"]) == (3, 1, 1)
    assert found["b", "Uniqueness"] == pytest.approx(1 / 3)


@pytest.mark.parametrize("data", [[], [(None, None)]])
def test_every_requested_metric_yields_a_row(spark, data):
    df = spark.createDataFrame(data, "a double, b double")
    wanted = [metric("Size"), metric("Mean", "a"), metric("CountDistinct", "a"), metric("Uniqueness", "a"),
              metric("Correlation", "a", "b"), metric("MutualInformation", "a", "b"), metric("ApproxQuantiles-0.25", "a")]
    found = values(profile(df, wanted))
    assert set(found) == {(m.instance, m.name) for m in wanted}
    assert found["a", "Mean"] is None and found["a", "CountDistinct"] == 0


def test_mean_of_a_decimal_is_exact(spark):
    df = spark.createDataFrame([("0.01",), ("0.02",), ("0.04",)], "a string").withColumn("a", F.col("a").cast("decimal(18,2)"))
    assert values(profile(df, [metric("Mean", "a")]))["a", "Mean"] == 0.07 / 3


def test_histogram(spark):
    df = spark.createDataFrame([("x",), ("x",), (None,), ("y",)], "a string")
    found = {r.name: r.value for r in profile(df, [metric("Histogram", "a")]).collect()}
    assert found == {
        "Histogram.bins": 3, "Histogram.abs.x": 2, "Histogram.abs.y": 1, "Histogram.abs.NullValue": 1,
        "Histogram.ratio.x": 0.5, "Histogram.ratio.y": 0.25, "Histogram.ratio.NullValue": 0.25,
    }
    by = spark.createDataFrame([("g", "x"), ("g", "y"), ("h", "x")], "k string, a string")
    assert {(r.k, r.a, r.row_share) for r in histogram_counts(by, "a", ["k"]).collect()} == {
        ("g", "x", 0.5), ("g", "y", 0.5), ("h", "x", 1.0),
    }
    unnamed = by.unionByName(spark.createDataFrame([(None, "x"), (None, "z")], by.schema))
    assert histogram_counts(unnamed, "a", ["k"]).where("k IS NULL AND row_share = 0.5").count() == 2


@pytest.mark.parametrize("seed", range(3))
def test_mutual_information(spark, seed):
    rng = random.Random(seed)
    data = [(rng.choice("abc"), rng.choice("xy")) for _ in range(200)]
    total, joint, left, right = len(data), {}, {}, {}
    for a, b in data:
        joint[a, b] = joint.get((a, b), 0) + 1
        left[a] = left.get(a, 0) + 1
        right[b] = right.get(b, 0) + 1
    expected = sum(n / total * math.log(n * total / (left[a] * right[b])) for (a, b), n in joint.items())
    df = spark.createDataFrame([*data, (None, "x"), ("a", None)], "a string, b string")
    assert values(profile(df, [metric("MutualInformation", "a", "b")]))["a,b", "MutualInformation"] == pytest.approx(expected)


def last_day(spark, size=100):
    """The profiled output of the generated table's last day."""
    output = daily_sum(gen.source_table(spark, size, LOAD_DATE))
    return output.where(F.col(DAY) == F.lit(LOAD_DATE))


def test_profile_names_of_the_generated_day(spark):
    ids = [f"11{10 ** 9 + n}" for n in range(3, 80, 4)]
    pairs = (SUM_COLUMN, KEY)
    wanted = [metric("Size"), metric("Histogram", KEY), metric("CountDistinct", KEY), metric("Uniqueness", KEY),
              metric("UniqueValueRatio", KEY), metric("Distinctness", SUM_COLUMN),
              metric("MutualInformation", *pairs), metric("Correlation", SUM_COLUMN, SUM_COLUMN)]
    found = profile(last_day(spark), wanted)
    names = {r.name for r in found.where(F.col("instance") == KEY).collect()}
    assert names == {"Histogram.bins", "CountDistinct", "Uniqueness", "UniqueValueRatio"} | {
        f"Histogram.{kind}.{i}" for kind in ("abs", "ratio") for i in ids
    }
    others = values(found)
    assert others[KEY, "CountDistinct"] == 20 and others[SUM_COLUMN, "Distinctness"] == 0.05
    # These go missing in other profilers; here they keep their rows.
    assert others["*", "Size"] == 20
    assert (",".join(pairs), "MutualInformation") in others
    assert (f"{SUM_COLUMN},{SUM_COLUMN}", "Correlation") in others


def stamped(df, day, moment):
    return df.select("*", F.lit(day).alias("date"), F.lit("t").alias("table_name"), F.lit(moment).cast("bigint").alias("dataset_date"))


def test_repository_round_trip_splits_large_keys(spark, tmp_path):
    metrics = stamped(profile(last_day(spark), [metric("Size"), metric("Histogram", KEY)]), "2023-08-31", 5)
    path = str(tmp_path / "repo")
    write_metrics(metrics.withColumn("dataset_date", F.lit(4).cast("bigint")).limit(1), path, ["date", "table_name"])
    for _ in range(2):
        write_metrics(metrics, path, ["date", "table_name"])
    assert read_documents(spark, path, ["date", "table_name"]).count() > 3
    back = read_metrics(spark, path, ["date", "table_name"])
    assert back.where("dataset_date = 4").count() == 1
    back = back.where("dataset_date = 5")
    assert back.count() == metrics.count()
    assert {tuple(r) for r in back.select(sorted(back.columns)).collect()} == {
        tuple(r) for r in metrics.select(sorted(back.columns)).collect()
    }


TAGS = ["date", "table_name"]


def repository_rows(spark, data):
    return spark.createDataFrame(
        [("Column", "c", name, float(value), moment, day, table) for name, value, moment, day, table in data],
        "entity string, instance string, name string, value double, dataset_date bigint, date string, table_name string")


def kept(spark, path, **more):
    return sorted(((r.name, r.value, r.dataset_date, r.date, r.table_name) for r in read_metrics(spark, path, TAGS, **more).collect()), key=str)


def test_repository_keeps_the_newest_write_of_each_run_through_folds(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(repository, "LOG_WRITES", 3)
    path, draw, expected = str(tmp_path / "repo"), random.Random(1), {}
    for step in range(8):
        runs = {(draw.choice([1, 2]), draw.choice(["2024-01-05", "2024-02-06", "2024-02-07", None]), draw.choice(["t", "u", None])) for _ in range(3)}
        data = [(name, step, *run) for run in runs for name in draw.sample(["Mean", "Sum", "Size"], 2)]
        for run in runs:
            expected[run] = [r for r in data if r[2:] == run]
        write_metrics(repository_rows(spark, data), path, TAGS)
        assert kept(spark, path) == sorted((r for rows in expected.values() for r in rows), key=str)
    parts = {p.parent for p in (tmp_path / "repo" / "fold").rglob("part-*.json")}
    assert len(list((tmp_path / "repo" / "log").iterdir())) <= 5
    assert len({(p.parent.name, p.name) for p in parts}) <= 9 and all(len(list(p.glob("part-*.json"))) == 1 for p in parts)
    january = sorted((r for run, rows in expected.items() if run[1] == "2024-01-05" for r in rows), key=str)
    assert kept(spark, path, months=["2024-01"]) == january


@pytest.mark.parametrize("lost", ["log", "fold"])
def test_repository_outlives_a_writer_that_dies(spark, tmp_path, monkeypatch, lost):
    path = str(tmp_path / "repo")
    write_metrics(repository_rows(spark, [("Mean", 1, 1, "2024-01-05", "t")]), path, TAGS)
    fold_metrics(spark, path, TAGS)
    write_metrics(repository_rows(spark, [("Mean", 2, 1, "2024-01-05", "t")]), path, TAGS)
    good = kept(spark, path)
    if lost == "log":  # the documents are there, the list of runs is not
        repository.metric_documents(repository_rows(spark, [("Mean", 9, 1, "2024-01-05", "t")]), TAGS).write.json(f"{path}/log/number=99")
    else:  # the new generation is there, the manifest is not
        folder = repository._Folder(spark, path, TAGS)
        folder.log().select("resultKey", "analyzerContext", F.lit("2024-01").alias("fold_month"), F.lit("t").alias("fold_table_name")).write.partitionBy(
            "fold_month", "fold_table_name").json(f"{path}/fold/number=99")
    assert kept(spark, path) == good == [("Mean", 2.0, 1, "2024-01-05", "t")]
    for _ in range(2):
        fold_metrics(spark, path, TAGS)
        assert kept(spark, path) == good
    write_metrics(repository_rows(spark, [("Sum", 3, 2, "2024-01-05", "t")]), path, TAGS)
    fold_metrics(spark, path, TAGS)
    assert kept(spark, path) == sorted([*good, ("Sum", 3.0, 2, "2024-01-05", "t")], key=str)


def test_profile_metric_check_reads_the_repository_once(spark, tmp_path):
    path = str(tmp_path / "repo")
    write_metrics(repository_rows(spark, [("Mean", 1, 1, "2024-01-05", "t")]), path, TAGS)
    plan = check_profile_metrics(read_metrics(spark, path, TAGS), {"c": ["Mean"]})._jdf.queryExecution().toString()
    assert "FileScan json" not in plan


def test_repository_reads_one_json_array(spark, tmp_path):
    path = tmp_path / "result.json"
    path.write_text("""[
      {"resultKey": {"dataSetDate": 1700000000000, "tags": {"date": "2023-08-30", "table_name": "t"}},
       "analyzerContext": {"metricMap": [
         {"analyzer": {"analyzerName": "Maximum", "column": "c"},
          "metric": {"metricName": "DoubleMetric", "entity": "Column", "instance": "c", "name": "Maximum", "value": 1.0}},
         {"analyzer": {"analyzerName": "Minimum", "column": "c"},
          "metric": {"metricName": "DoubleMetric", "entity": "Column", "instance": "c", "name": "Minimum", "value": 1.0}}]}}]""")
    found = read_metrics(spark, str(path), ["date", "table_name"], multi_line=True)
    seed = gen.metric_history_seed(spark, "c", dt.date(2023, 8, 30), "t", 1700000000000)
    assert {tuple(r) for r in found.select(seed.columns).collect()} == {tuple(r) for r in seed.collect()}


def metric_rows(spark, data):
    return spark.createDataFrame(data, "date string, dataset_date bigint, instance string, name string")


def test_profile_metrics_use_the_newest_run_of_the_date(spark):
    metrics = metric_rows(spark, [
        ("d1", 1, "c", "Mean"), ("d1", 2, "c", "Sum"), ("d1", 2, "c", "Size"), ("d2", 9, "c", "Mean"),
    ])
    assert {r.name for r in latest_metrics(metrics).where("date = 'd1'").collect()} == {"Sum", "Size"}

    def verdict(names, day="d1", instance="c"):
        return check_profile_metrics(metrics, {instance: names}, day).first()

    assert verdict(["Sum", "Size"]).status == "pass"
    assert (verdict(["Sum"]).unexpected, verdict(["Sum", "Size", "x"]).missing) == (1, 1)
    assert verdict([], instance="other").status == "pass" and verdict(["Sum"], instance="other").status == "fail"
    assert verdict([], day="d3").status == "pass" and verdict(["Sum"], day="d3").status == "fail"
    every = {r.date: r.status for r in check_profile_metrics(metrics, {"c": ["Mean"]}).collect()}
    assert every == {"d1": "fail", "d2": "pass"}
    assert check_repository(metrics).first().status == "pass"
    assert check_repository(metrics.limit(0)).first().status == "error"


def test_metric_dates(spark):
    metrics = metric_rows(spark, [("d1", 1, "c", "Mean"), ("d2", 1, "c", "Mean")])
    assert check_metric_dates(metrics, spark.createDataFrame([("d1",)], "date string")).first().status == "pass"
    assert check_metric_dates(metrics, spark.createDataFrame([("d3",)], "date string")).first().status == "fail"


def test_metric_date_list(spark):
    metrics = spark.createDataFrame([("['a', 'b']",), ("['b', 'a', 'a']",), ("['a']",), ("a",)], "dt_list string")
    found = {r.dt_list: r.status for r in check_metric_date_list(metrics, ["a", "b"]).collect()}
    assert found == {"['a', 'b']": "pass", "['b', 'a', 'a']": "pass", "['a']": "fail", "a": "error"}


def day_metrics(spark, pairs):
    return spark.createDataFrame([(d, "c", "Mean", float(v)) for d, v in pairs], "day date, instance string, name string, value double")


def test_lookback_counts_days_not_rows(spark):
    metrics = day_metrics(spark, [(dt.date(2024, 1, 1), 1), (dt.date(2024, 1, 2), 3), (dt.date(2024, 1, 6), 2)])
    found = {r.day.day: (r.reference, r.is_ready) for r in anomaly.against_lookback(metrics, 3, absolute=2).collect()}
    assert found == {1: (None, None), 2: (1.0, True), 6: (None, None)}


def test_month_end_and_history(spark):
    metrics = day_metrics(spark, [(dt.date(2024, 1, 31), 10), (dt.date(2024, 2, 5), 11), (dt.date(2024, 3, 5), 11)])
    found = {r.day.month: r.is_ready for r in anomaly.against_month_end(metrics, relative=0.1).collect()}
    assert found == {1: None, 2: True, 3: None}
    history = anomaly.against_history(metrics.where("month(day) = 3"), metrics.where("month(day) < 3"), absolute=0.4)
    assert (history.first().reference, history.first().is_ready) == (10.5, False)


def test_distinct_metrics_of_overlapping_sets(spark):
    data = [("x", 1, "a"), ("x", 1, "b"), ("x", None, "b"), ("y", 2, None), (None, None, None)]
    df = spark.createDataFrame(data, "g string, n int, t string")
    asked = [("n",), ("t",), ("n", "t"), ("t", "n"), ("g", "n")]

    def found(rows):
        return {(r["instance"], *[r[c] for c in rows.columns if c == "g"]): r["value"] for r in rows.collect()}

    wanted = [metric("CountDistinct", *c) for c in asked]
    assert found(profile(df, wanted)) == {("n",): 2, ("t",): 2, ("n,t",): 2, ("t,n",): 2, ("g,n",): 2}
    assert found(profile(df.limit(0), wanted)) == {(",".join(c),): 0 for c in asked}
    assert found(profile(df, wanted[:4], ["g"])) == {
        ("n", "x"): 1, ("t", "x"): 2, ("n,t", "x"): 2, ("t,n", "x"): 2, ("n", "y"): 1, ("t", "y"): 0, ("n,t", "y"): 0, ("t,n", "y"): 0,
        ("n", None): 0, ("t", None): 0, ("n,t", None): 0, ("t,n", None): 0}


@pytest.mark.parametrize("seed", range(2))
def test_exact_quantiles_of_odd_values(spark, seed):
    draw = random.Random(seed)
    odd = [float("nan"), float("inf"), float("-inf"), 0.0, -0.0, 5e-324, -1.5, 1e300, None]
    data = [(draw.choice(["a", "b", None]), draw.choice([*odd, draw.gauss(0, 1e6), draw.gauss(0, 1)])) for _ in range(700)] + [("none", None)]
    shares = (0.0, 0.25, 0.5, 0.999, 1.0)
    wanted = [metric(f"ApproxQuantiles-{s}", "x") for s in shares]

    def slow(rows, share):
        held = sorted((v for v in rows if v is not None), key=lambda v: (math.isnan(v), v))
        return held[max(1, math.ceil(share * len(held))) - 1] if held else None

    def plain(value):
        return "NaN" if value is not None and math.isnan(value) else value

    df = spark.createDataFrame(data, "g string, x double")
    found = {(r.g, r.name): plain(r.value) for r in profile(df, wanted, ["g"], exact=True).collect()}
    assert found == {(g, f"ApproxQuantiles-{s}"): plain(slow([x for k, x in data if k == g], s)) for g in ("a", "b", None, "none") for s in shares}
    whole = {r.name: plain(r.value) for r in profile(df, wanted, exact=True).collect()}
    assert whole == {f"ApproxQuantiles-{s}": plain(slow([x for _, x in data], s)) for s in shares}
    counted = df.groupBy("g", "x").agg(F.count("*").alias("n"))
    assert {r.name: plain(r.value) for r in profile(counted, wanted, exact=True, weight="n").collect()} == whole
    assert [r.value for r in profile(df.limit(0), wanted, exact=True).collect()] == [None] * len(shares)


def test_nan_is_above_every_quantile_of_the_rest(spark):
    df = spark.createDataFrame([(float(k),) for k in range(10)] + [(float("nan"),)] * 2, "x double")
    found = values(profile(df, [metric("ApproxQuantiles-0.25", "x"), metric("ApproxQuantiles-0.75", "x")], exact=True))
    assert found == {("x", "ApproxQuantiles-0.25"): 2.0, ("x", "ApproxQuantiles-0.75"): 8.0}


def test_counted_metrics_of_weighted_rows(spark):
    df = spark.createDataFrame([("x", 1), ("x", 1), ("x", None), ("y", 2), (None, 2), ("y", 2)], "a string, b int")
    wanted = [metric("CountDistinct", "a"), metric("Uniqueness", "b"), metric("MutualInformation", "a", "b"), metric("Histogram", "a"), metric("Histogram", "b")]
    counted = df.groupBy("a", "b").agg(F.count("*").alias("n"))
    assert values(profile(counted, wanted, weight="n")) == pytest.approx(values(profile(df, wanted)))
    with pytest.raises(ValueError):
        profile(counted, [metric("Mean", "b")], weight="n")
