from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from veriframe.functions import text, time
from veriframe.operators import logs, results, runs, sensors
from veriframe.sources.files import split_log_lines
from veriframe.sources.runs import flatten_tasks, read_runs, run_records

LOG = "run string, task string, seq int, dt_list array<string>"


def log_frame(spark, data):
    return spark.createDataFrame(data, LOG)


def test_log_dates_use_the_newest_row_and_see_repeats(spark):
    log = log_frame(spark, [
        ("1", "t", 1, ["2024-01-01"]), ("1", "t", 2, ["2024-01-01", "2024-01-02"]),
        ("2", "t", 1, ["2024-01-01", "2024-01-01"]), ("4", "t", 1, None), ("5", "t", 1, []), ("6", "t", 1, []),
        ("7", "t", 1, ["2024-01-01"]),
    ])
    table = spark.createDataFrame(
        [(r, "t", dt.date(2024, 1, d)) for r, d in (("1", 1), ("1", 2), ("1", 2), ("2", 1), ("3", 1), ("4", 1), ("6", 1))],
        "run string, task string, dl_data_dt date",
    )
    found = logs.check_log_dates(log, table, ["run", "task"], [F.col("seq").desc()]).collect()
    assert {r.run: (r.status, r.mismatches) for r in found} == {
        "1": ("pass", 0), "2": ("fail", 1), "3": ("error", 1), "4": ("error", 1),
        "5": ("pass", 0), "6": ("fail", 1), "7": ("fail", 1),
    }


def test_latest_rows_reduce_before_the_shuffle(spark):
    plan = logs.latest_rows(spark.range(9).selectExpr("id % 2 AS k", "id"), ["k"], [F.col("id").desc()])
    assert "WindowGroupLimit" in plan._jdf.queryExecution().executedPlan().toString()
    assert {tuple(r) for r in plan.collect()} == {(0, 8), (1, 7)}


def test_typed_literals(spark):
    df = spark.createDataFrame([(1, dt.date(2024, 1, 1)), (2, None)], "a bigint, d date")
    assert logs.where_equal(df, {"a": "1", "d": "2024-01-01"}).count() == 1


def record_log(spark):
    return spark.createDataFrame(
        [("p", 1, "old", ("1", None), ["x"]), ("p", 2, "new", ("1", None), ["x"]), ("q", 1, None, ("2", "3"), None)],
        "prdct string, seq int, sts string, v struct<major: string, minor: string>, l array<string>",
    )


def test_log_record(spark):
    order = [F.col("seq").desc()]
    found = logs.check_log_record(
        record_log(spark), {"prdct": "p"}, {"sts": "new", "v": {"major": "1", "minor": None}, "l": ["y"]}, order
    ).collect()
    assert {r.column: r.status for r in found} == {"sts": "pass", "v": "pass", "l": "fail"}
    nothing = logs.check_log_record(record_log(spark), {"prdct": "z"}, {"sts": "new"}, order).collect()
    assert [r.status for r in nothing] == ["error"]
    null = logs.check_log_record(record_log(spark), {"prdct": "q"}, {"sts": None}, order).collect()
    assert [r.status for r in null] == ["pass"]


@pytest.mark.parametrize("keyword, hits", [("50%", 1), ("it's", 1), ("5_%", 0), ("z", 0)])
def test_array_keyword_is_literal(spark, keyword, hits):
    log = spark.createDataFrame(
        [("r", [("50% of it's",), (None,)]), ("r", []), ("r", None)], "run string, cstm_val array<struct<val: string>>"
    )
    found = logs.check_array_keyword(log, ["run"], "cstm_val", keyword).first()
    assert (found.hits, found.status) == (hits, "pass" if hits else "fail")


def test_error_keyword(spark):
    log = spark.createDataFrame([("1", "DeequAuditError: x"), ("1", None), ("2", None)], "run string, err_msg string")
    found = logs.check_error_keyword(log, ["run"], "DeequAuditError").collect()
    assert {r.run: r.status for r in found} == {"1": "pass", "2": "fail"}


def test_log_lines(spark, rows):
    lines = spark.createDataFrame([("2024-01-01T00:00:00.0000 hello",), ("short",), ("",)], "value string")
    assert rows(split_log_lines(lines)) == [("", ""), ("2024-01-01T00:00:00.0000", " hello"), ("short", "")]


def test_message_hits_per_message(spark):
    lines = spark.createDataFrame([("a.b",), ("axb",), (None,)], "m string")
    assert [tuple(r) for r in logs.message_hits(lines, "m", ["a.b", "no"]).collect()] == [("pass", "a.b", 1), ("pass", "no", 0)]
    assert logs.message_hits(lines, "m", ["a.b"], regex=True).first().hits == 2
    assert logs.message_hits(lines, "m", ["none"]).first().status == "fail"


TASKS = (
    "job_id bigint, run_id bigint, run_name string, task_run_id bigint, task_key string, life_cycle_state string, "
    "result_state string, state_message string, start_time bigint, end_time bigint, setup_duration bigint, "
    "execution_duration bigint"
)


def task_rows(spark):
    def task(run, number, key, life, result, message=None):
        return (9, run, "name", number, key, life, result, message, 1_700_000_000, 1_700_000_000_500, 1500, 125)

    return spark.createDataFrame([
        task(1, 10, "a", "TERMINATED", "SUCCESS"), task(1, 11, "b", "TERMINATED", "SUCCESS"),
        task(2, 20, "a", "TERMINATED", "FAILED", "boom"), task(2, 21, "b", "SKIPPED", "UPSTREAM_FAILED"),
        task(2, 22, "c", "SKIPPED", "UPSTREAM_FAILED"),
        task(3, 30, "a", "RUNNING", None), task(3, 31, "b", "TERMINATED", "FAILED"),
    ], TASKS)


def test_task_states(spark):
    tasks = task_rows(spark)
    assert {r.run_id: (r.status, r.not_successful) for r in runs.check_tasks_complete(tasks).collect()} == {
        1: ("pass", 0), 2: ("fail", 3), 3: ("fail", 2),
    }
    assert runs.failed_tasks(tasks).where("task_run_id = 20").first().message == (
        "Result status of task_key:a, run_id:20, FAILED, boom."
    )
    skipped = runs.check_downstream_skipped(tasks, ["b", "c", "x"]).collect()
    assert {r.run_id: (r.status, r.present, r.missing) for r in skipped} == {
        1: ("fail", 1, 2), 2: ("pass", 2, 1), 3: ("fail", 1, 2),
    }


def test_run_terminated(spark):
    state = spark.createDataFrame(
        [(1, "n", "TERMINATED"), (2, "n", "TERMINATED"), (3, "n", "RUNNING"), (4, "n", None)],
        "run_id bigint, run_name string, life_cycle_state string",
    )
    found = {r.run_id: r for r in runs.check_run_terminated(state, task_rows(spark)).collect()}
    assert {k: r.status for k, r in found.items()} == {1: "pass", 2: "fail", 3: "fail", 4: "fail"}
    assert found[3].message == "Result life cycle state of run_name:n, run_id:3 is RUNNING."
    assert found[2].message.startswith("Result status of task_key:a, run_id:20, FAILED, boom. Result status of task_key:b")


def test_log_counts(spark):
    tasks = task_rows(spark).where("run_id = 1")
    url = "adb-77.3.example.net"
    log = spark.createDataFrame(
        [("9", "1", f"{url}/?o=77#job/9/run/10", "a"), ("9", "1", f"{url}/?o=77#job/9/run/99", "b")],
        "parent_id string, parent_run_id string, job_uri string, task_nm string",
    )
    found = logs.check_log_counts(log, tasks, url).collect()
    assert {r.task_nm: (r.log_rows, r.status) for r in found} == {"a": (1, "pass"), "b": (0, "fail")}
    named = logs.check_log_counts(log, tasks, url, tasks=["a", "zz"]).collect()
    assert {r.task_nm: (r.log_rows, r.status) for r in named} == {"a": (1, "pass"), "zz": (None, "error")}


def test_run_documents(spark, tmp_path):
    path = tmp_path / "run.json"
    path.write_text('{"job_id": 9, "run_id": 1, "run_name": "n", "state": {"life_cycle_state": "TERMINATED"},\n'
                    ' "start_time": 1700000000000, "execution_duration": 2000,\n'
                    ' "tasks": [{"task_key": "a", "run_id": 10, "state": {"result_state": "SUCCESS"}},'
                    ' {"task_key": "b", "run_id": 11, "state": {"life_cycle_state": "RUNNING"}}]}')
    documents = read_runs(spark, str(path), multi_line=True)
    tasks = flatten_tasks(documents)
    assert {(r.task_key, r.result_state) for r in tasks.collect()} == {("a", "SUCCESS"), ("b", None)}
    # A single-task run has no run duration, so its execution duration counts.
    info = runs.run_information(run_records(documents)).first()
    assert info.workflow_execution_duration == 2.0


def test_results_carry_run_or_marker(spark):
    verdicts = spark.createDataFrame([(1, "pass")], "run_id bigint, status string")
    without = results.with_run(verdicts, None, {"data_size": 100}).first()
    assert (without.workflow_name, without.test_param) == ("skip", '{"data_size":"100"}')
    assert without.workflow_start_time is None
    timing = runs.task_durations(task_rows(spark)).first()
    assert (timing.setup_duration, timing.execution_duration) == (1.5, 0.125)


def test_parameter_matrix(spark):
    base = spark.createDataFrame([(1,), (2,)], "job int")
    found = results.parameter_matrix(base, {"cluster": ["A", "B"], "size": [100, 200]})
    assert found.count() == 8 and found.select("test_param").distinct().count() == 4
    assert results.parameter_matrix(base, {"size": []}).count() == 0


@pytest.mark.parametrize("epoch, expected", [
    (1_700_000_000, "2023-11-14 22:13:20"), (1_700_000_000_123, "2023-11-14 22:13:20.123"),
    (1_700_000_000_123_457, "2023-11-14 22:13:20.123457"), (17, "2023-11-14 22:13:20"),
    (1_700_000_000_123_456_789, "2023-11-14 22:13:20.123456"), (0, "1970-01-01 00:00:00"),
])
def test_epochs(spark, epoch, expected):
    df = spark.createDataFrame([(epoch,)], "e bigint").select(time.epoch_to_timestamp(F.col("e")).cast("string"))
    assert df.first()[0] == expected


def test_load_date(spark):
    df = spark.createDataFrame([("-skip", "-skip"), ("2023-08-31", "-skip"), ("2023-08-31", "2023-08-31")], "s string, e string")
    given, today = F.lit("2023-08-31").cast("date"), F.lit("2024-05-10").cast("date")
    found = [r[0] for r in df.select(time.resolve_load_date(F.col("s"), F.col("e"), given, today)).collect()]
    assert found == [dt.date(2024, 5, 8), dt.date(2024, 5, 8), dt.date(2023, 8, 31)]


def test_text_lists(spark):
    df = spark.createDataFrame([("['a', 'b']",), ('["a"]',), ("[]",), ("nope",)], "t string")
    found = [r[0] for r in df.select(text.text_list("t")).collect()]
    assert found[:3] == [["a", "b"], ["a"], []] and found[3] is None
    assert df.select(text.list_text(F.array(F.lit("a"), F.lit("b")))).first()[0] == "['a', 'b']"


def sensor_frame(spark):
    def row(rule, ready, seq, day=1, pipeline="p", run="1"):
        return (run, pipeline, dt.date(2024, 1, day), rule, ready, dt.datetime(2024, 2, 1, 0, 0, seq))

    return spark.createDataFrame([
        row("a", False, 1), row("a", True, 2), row("b", True, 1), row("b", None, 1, day=2), row("a", True, 1, day=2),
        row("c", False, 1, pipeline="q"), row("c", False, 1, pipeline="q"), row("z", True, 1, day=9),
    ], "parent_run_id string, upstrm_pl string, dt date, snsr_rule string, is_ready boolean, result_ts timestamp")


def test_gate_reads_the_newest_result(spark):
    found = sensors.gate(sensor_frame(spark), dt.date(2024, 1, 1), dt.date(2024, 1, 2)).collect()
    assert {(r.upstrm_pl, r.dt.day): (r.rules, r.is_ready) for r in found} == {
        ("p", 1): (2, True), ("p", 2): (2, False), ("q", 1): (1, False),
    }
    assert {r.message for r in found} == {None, "Sensor module detected not-ready prerequisite tasks"}


def test_gate_at_the_same_moment_is_not_ready(spark):
    both = sensor_frame(spark).where("upstrm_pl = 'p' AND dt = '2024-01-02'").withColumn("result_ts", F.lit("2024-02-01").cast("timestamp"))
    both = both.unionByName(both.withColumn("is_ready", ~F.col("is_ready")))
    found = sensors.gate(both, dt.date(2024, 1, 1), dt.date(2024, 1, 2)).first()
    assert (found.rules, found.not_ready) == (2, 2)


def test_sensor_rules_ignore_unknown_flags_and_repeats(spark):
    found = sensors.check_sensor_rules(sensor_frame(spark), ["c"], ["upstrm_pl"]).collect()
    assert {r.upstrm_pl: (r.status, r.missing, r.unexpected) for r in found} == {"p": ("fail", 1, 1), "q": ("pass", 0, 0)}


def test_sensor_dates(spark):
    expected = spark.createDataFrame([("p", "2024-01-01"), ("p", "2024-01-02"), ("q", "2024-01-01")], "upstrm_pl string, date string")
    found = sensors.check_sensor_dates(sensor_frame(spark), expected, ["upstrm_pl"]).collect()
    assert {r.upstrm_pl: (r.status, r.unexpected) for r in found} == {"p": ("fail", 1), "q": ("pass", 0)}


def test_results_append(spark, tmp_path):
    path = str(tmp_path / "results")
    verdicts = runs.check_tasks_complete(task_rows(spark))
    for _ in range(2):
        results.append_results(verdicts, path)
    assert spark.read.parquet(path).count() == 6


def test_gate_counts_rules_that_never_reported(spark):
    keys = "upstrm_pl string, dt date, snsr_rule string"
    required = spark.createDataFrame([("p", dt.date(2024, 1, d), "r") for d in (1, 2, 3)], keys)
    sensor = spark.createDataFrame(
        [("p", dt.date(2024, 1, 1), "r", True, dt.datetime(2024, 1, 4), "x")], f"{keys}, is_ready boolean, result_ts timestamp, parent_run_id string"
    )
    found = {r.dt.day: r.is_ready for r in sensors.gate(sensor, dt.date(2024, 1, 1), dt.date(2024, 1, 3), required).collect()}
    assert found == {1: True, 2: False, 3: False}
    rules = sensors.check_sensor_rules(sensor, ["r"], ["upstrm_pl", "dt"], True, required).collect()
    assert sorted((r.dt.day, r.status) for r in rules) == [(1, "pass"), (2, "fail"), (3, "fail")]


def test_expected_keys_without_a_log_row_fail(spark):
    log = spark.createDataFrame([("a", "disk full")], "run string, err_msg string")
    expected = spark.createDataFrame([("a",), ("b",)], "run string")
    found = logs.check_error_keyword(log, ["run"], "full", expected=expected).collect()
    assert sorted((r.run, r.hits, r.status) for r in found) == [("a", 1, "pass"), ("b", 0, "fail")]


def test_runs_without_the_listed_tasks_fail(spark):
    tasks = spark.createDataFrame([(1, "t", "SKIPPED", "UPSTREAM_FAILED")], "run_id long, task_key string, life_cycle_state string, result_state string")
    found = runs.check_downstream_skipped(tasks, ["t"], spark.range(1, 3).withColumnRenamed("id", "run_id")).collect()
    assert sorted((r.run_id, r.missing, r.status) for r in found) == [(1, 0, "pass"), (2, 1, "fail")]
