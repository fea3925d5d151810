"""The scenarios end to end: generate, transform, audit, profile, judge, gate, check."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veriframe.operators import audit, sensors
from veriframe.operators.anomaly import against_history
from veriframe.operators.logs import check_array_keyword, check_error_keyword, check_log_dates
from veriframe.operators.profile import metric, profile
from veriframe.operators.sets import check_schema
from veriframe.operators.transform import DAY, KEY, SUM_COLUMN, create_views, daily_sum
from veriframe.sources import generator as gen
from veriframe.sources import publish, tables

LOAD_DATE = dt.date(2023, 8, 31)
RULES = [audit.id_rule(), audit.Rule("broken_field", "key.val = 1", optional=True)]


def output_of(spark, spec, size=100):
    source = gen.source_table(spark, size, LOAD_DATE, spec)
    return daily_sum(source.where(F.col(DAY) == F.lit(LOAD_DATE)), F.lit("2023-09-01 00:00:00").cast("timestamp"))


def test_success(spark, tmp_path):
    path = str(tmp_path / "out")
    record = audit.audited_write(output_of(spark, gen.success_spec()), RULES, path, "daily").first()
    assert (record.job_sts, record.err_msg, record.violations, record.dt_list) == ("SUCCESS", None, 0, ["2023-08-31"])
    assert record.dt_list_text == "['2023-08-31']"
    assert "broken_field" in record.cstm_val[0].val

    written = spark.read.parquet(path)
    assert written.count() == 20
    declared = {KEY: T.StringType(), SUM_COLUMN: T.IntegerType(), DAY: T.DateType(), "dl_load_ts": T.TimestampType()}
    assert {r.status for r in check_schema(spark, written.schema, declared).collect()} == {"pass"}


def test_audit_failure_writes_nothing(spark, tmp_path):
    path = str(tmp_path / "out")
    output = output_of(spark, gen.audit_failure_spec())
    record = audit.audited_write(output, RULES, path, "daily")
    assert audit.published(spark, path, output.schema).count() == 0
    assert not (tmp_path / "out").exists()
    log = record.withColumn("parent_run_id", F.lit("1"))
    assert check_error_keyword(log, ["parent_run_id"], "DeequAuditError").first().status == "pass"
    assert check_array_keyword(log, ["parent_run_id"], "cstm_val", "key").first().status == "pass"


def test_failed_audit_keeps_earlier_output(spark, tmp_path):
    path = str(tmp_path / "out")
    audit.audited_write(output_of(spark, gen.success_spec()), RULES, path, "daily")
    audit.audited_write(output_of(spark, gen.audit_failure_spec()), RULES, path, "daily")
    assert spark.read.parquet(path).where("uc_id LIKE '11%'").count() == 20


def test_audit_of_nothing(spark):
    empty = output_of(spark, gen.success_spec()).limit(0)
    record = audit.audit_record(empty, RULES, "daily").first()
    assert (record.job_sts, record.rows, record.dt_list) == ("SUCCESS", 0, [])


@pytest.mark.parametrize("spec, ready", [(gen.success_spec(), True), (gen.anomaly_failure_spec(100), False)])
def test_anomaly_gate(spark, spec, ready):
    history = gen.metric_history_seed(spark, SUM_COLUMN, dt.date(2023, 8, 30), "agg", 1700000000000)
    today = profile(output_of(spark, spec), [metric("Minimum", SUM_COLUMN), metric("Maximum", SUM_COLUMN)], [DAY])
    judged = against_history(today.withColumnRenamed(DAY, "day"), history)
    results = sensors.sensor_results(judged, "1", "daily_sum").withColumn("result_ts", F.current_timestamp())
    rules = [
        f"AnomalyConstraint(Mean(value,Some(name='{name}' and instance='{SUM_COLUMN}')))" for name in ("Minimum", "Maximum")
    ]
    check = sensors.check_sensor_rules(results, rules, ["upstrm_pl"], ready=ready)
    assert check.first().status == "pass"
    gate = sensors.gate(results, LOAD_DATE, LOAD_DATE).first()
    assert (gate.rules, gate.is_ready) == (2, ready)
    assert gate.message == (None if ready else "Sensor module detected not-ready prerequisite tasks")


def test_log_dates_of_a_written_output(spark, tmp_path):
    path = str(tmp_path / "out")
    record = audit.audited_write(output_of(spark, gen.success_spec()), RULES, path, "daily")
    log = record.select(F.col("task_nm").alias("task"), "dt_list", F.lit(1).alias("seq"))
    table = spark.read.parquet(path).select(F.lit("daily").alias("task"), DAY)
    assert check_log_dates(log, table, ["task"], [F.col("seq").desc()]).first().status == "pass"


def test_sum_beyond_int_raises(spark):
    source = spark.createDataFrame([("a", 2 ** 31 - 1, LOAD_DATE), ("a", 1, LOAD_DATE)], "uc_id string, transactions int, dl_data_dt date")
    with pytest.raises(Exception, match="outside INT"):
        daily_sum(source).collect()


def test_persistent_views(spark):
    tables.create_database(spark, "vf_views")
    output = daily_sum(gen.source_table(spark, 100, LOAD_DATE))
    tables.save_partitioned_table(output, "vf_views.agg", [DAY])
    names = create_views(spark, "vf_views.agg")
    counts = {kind: spark.table(name).count() for kind, name in names.items()}
    assert counts == {"technical": 100, "technical_monthly": 40, "business": 100, "business_monthly": 40}
    assert spark.table(names["business"]).columns == ["customer_id", DAY, "daily_transactions"]
    for name in reversed(names.values()):
        spark.sql(f"DROP VIEW {name}")
    tables.drop_table(spark, "vf_views", "agg")
    tables.drop_database(spark, "vf_views")


def test_rule_warnings(spark):
    df = spark.createDataFrame([(1,)], "a int")
    usable, warnings = audit.resolve(df, [audit.Rule("ok", "a > 0"), audit.Rule("text", "a + 1"), audit.Rule("gone", "b.val > 0")])
    assert [r.name for r in usable] == ["ok"] and [w[0] for w in warnings] == ["text", "gone"]


@pytest.mark.parametrize("rules", [[], [audit.Rule("gone", "no_such_column > 0")]])
def test_an_audit_without_answers_publishes_nothing(spark, tmp_path, rules):
    path = str(tmp_path / "out")
    output = output_of(spark, gen.success_spec())
    assert audit.audited_write(output, rules, path, "daily").first().job_sts == "FAILED"
    assert audit.published(spark, path, output.schema).count() == 0


def days_of(spark, path):
    found = {r[DAY]: r["count"] for r in spark.read.parquet(path).groupBy(DAY).count().collect()}
    assert set(found) - {None} <= {r.day for r in publish.loaded_days(spark, path).collect()}
    return found


def load_of(spark, days, size):
    return spark.range(size).select(
        F.format_string("11%010d", "id").alias(KEY), F.lit(1).alias(SUM_COLUMN),
        F.element_at(F.array(*[F.lit(d).cast("date") for d in days]), (F.col("id") % len(days) + 1).cast("int")).alias(DAY))


@pytest.mark.parametrize("dies", ["before the audit", "before the switch", "at the first rename", "within the switch"])
def test_a_lost_driver_publishes_all_or_nothing(spark, tmp_path, monkeypatch, dies):
    path, rules = str(tmp_path / "out"), [audit.id_rule()]
    first, second = [dt.date(2024, 1, 1), dt.date(2024, 1, 2), None], [dt.date(2024, 1, 2), dt.date(2024, 1, 3), None]
    audit.audited_write(load_of(spark, first, 30), rules, path, "load")
    before = {d: 10 for d in first}
    assert days_of(spark, path) == before

    class Lost(Exception):
        pass

    def lost(*args, **more):
        raise Lost

    with monkeypatch.context() as patch:
        if dies == "before the audit":
            patch.setattr(audit, "audit_record", lost)
        elif dies == "before the switch":
            patch.setattr(audit, "switch", lost)
        else:
            names, real = iter([dies == "within the switch"]), publish._path

            def path_of(session, name):
                if name.startswith(f"{path}/{DAY}=") and not next(names, False):
                    raise Lost
                return real(session, name)

            patch.setattr(publish, "_path", path_of)
        with pytest.raises(Lost):
            audit.audited_write(load_of(spark, second, 60), rules, path, "load")
    publish.recover(spark, path)
    after = {dt.date(2024, 1, 1): 10, dt.date(2024, 1, 2): 20, dt.date(2024, 1, 3): 20, None: 20}
    assert days_of(spark, path) == (before if dies == "before the audit" else after)
    assert not (tmp_path / "out" / publish.STAGING).exists()
    audit.audited_write(load_of(spark, second, 60), rules, path, "load")
    assert days_of(spark, path) == after


def test_a_partition_set_aside_comes_back_with_the_load(spark, tmp_path):
    path = str(tmp_path / "out")
    day = dt.date(2024, 1, 2)
    audit.audited_write(load_of(spark, [day], 5), [audit.id_rule()], path, "load")
    staged = publish.stage(load_of(spark, [day], 7), path, DAY)
    publish.approve(spark, staged)
    (tmp_path / "out" / publish.STAGING / staged.rsplit("/", 1)[1] / publish.ASIDE).mkdir()
    (tmp_path / "out" / f"{DAY}={day}").rename(f"{staged}/{publish.ASIDE}/{DAY}={day}")
    publish.recover(spark, path)
    assert days_of(spark, path) == {day: 7}


def test_the_register_merges_its_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(publish, "REGISTER_FILES", 3)
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=k) for k in range(9)]
    for day in days:
        publish.register_days(spark, str(tmp_path), [day, days[0], None])
    assert sorted(r.day for r in publish.loaded_days(spark, str(tmp_path)).collect()) == days
    assert len(list((tmp_path / publish.REGISTER).glob("part-*"))) <= 4
