"""The running mean of a metric's history."""

from __future__ import annotations


from veriframe.sources import history


def metrics(spark, values):
    return spark.createDataFrame([("c", name, value) for name, value in values], "instance string, name string, value double")


def means(spark, path):
    return {r["name"]: (r.n, r.reference) for r in history.history_means(spark, path).collect()}


def test_runs_add_up_and_a_repeated_run_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "h")
    assert means(spark, path) == {}
    history.append_history(metrics(spark, [("Mean", 1.0), ("Mean", 2.0), ("Sum", None)]), path, 7)
    assert means(spark, path) == {"Mean": (2, 1.5)}
    history.append_history(metrics(spark, [("Mean", 6.0), ("Sum", 4.0)]), path, 8)
    assert means(spark, path) == {"Mean": (3, 3.0), "Sum": (1, 4.0)}
    history.append_history(metrics(spark, [("Mean", 3.0)]), path, 7)
    assert means(spark, path) == {"Mean": (2, 4.5), "Sum": (1, 4.0)}
    history.append_history(metrics(spark, []), path, 8)
    assert means(spark, path) == {"Mean": (1, 3.0)}
    assert len(list((tmp_path / "h" / "totals").iterdir())) <= 2


def test_a_writer_that_dies_before_the_totals_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "h")
    history.append_history(metrics(spark, [("Mean", 1.0)]), path, 1)
    metrics(spark, []).selectExpr("instance", "name", "1L as n", "99.0D as total").write.parquet(f"{path}/parts/run=2/number=2")
    assert means(spark, path) == {"Mean": (1, 1.0)}
    history.append_history(metrics(spark, [("Mean", 3.0)]), path, 1)
    assert means(spark, path) == {"Mean": (1, 3.0)}
    history.append_history(metrics(spark, [("Mean", 5.0)]), path, 2)
    assert means(spark, path) == {"Mean": (2, 4.0)}
