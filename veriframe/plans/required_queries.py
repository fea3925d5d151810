"""Comparison queries with subjects that never reported, and with repeated, surplus and missing dates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from veriframe.functions.time import day_text
from veriframe.operators import logs, runs, sensors
from veriframe.plans import standins as st
from veriframe.plans.registered import query


def _all_runs(spark, folder):
    return st.run_log(spark, folder).select("parent_run_id").distinct()


@query("check_error_keyword_required", f"""
    WITH {st.RUN_LOG}
    SELECT parent_run_id, count(*) FILTER (event_id % 4 = 1 AND contains(err_msg, '5% of ''rows''')) AS hits,
           CASE WHEN hits > 0 THEN 'pass' ELSE 'fail' END AS status
    FROM lg GROUP BY parent_run_id
""")
def check_error_keyword_required(spark, folder):
    """A quarter of the rows reached the log; runs without one fail."""
    arrived = st.run_log(spark, folder).where("event_id % 4 = 1")
    return logs.check_error_keyword(arrived, ["parent_run_id"], "5% of 'rows'", expected=_all_runs(spark, folder))


@query("check_log_array_keyword_required", f"""
    WITH {st.RUN_LOG}
    SELECT parent_run_id, count(*) FILTER (event_id % 4 = 1 AND len(list_filter(cstm_val, lambda x: contains(x, '7% done'))) > 0) AS hits,
           CASE WHEN hits > 0 THEN 'pass' ELSE 'fail' END AS status
    FROM lg GROUP BY parent_run_id
""")
def check_log_array_keyword_required(spark, folder):
    arrived = st.run_log(spark, folder).where("event_id % 4 = 1")
    return logs.check_array_keyword(arrived, ["parent_run_id"], "cstm_val", "7% done", expected=_all_runs(spark, folder))


@query("check_downstream_skipped_required", f"""
    WITH {st.TASK_RUNS},
         l AS (SELECT * FROM tr WHERE task_key IN ('error', 'signup', 'audit')),
         j AS (SELECT r.run_id, l.task_key, l.life_cycle_state, l.result_state FROM (SELECT DISTINCT run_id FROM tr) r LEFT JOIN l ON r.run_id = l.run_id)
    SELECT run_id, count(task_key) AS present,
           count(task_key) FILTER (life_cycle_state <> 'SKIPPED' OR result_state IS DISTINCT FROM 'UPSTREAM_FAILED') AS not_skipped,
           3 - count(DISTINCT task_key) AS missing,
           CASE WHEN present > 0 AND not_skipped = 0 THEN 'pass' ELSE 'fail' END AS status
    FROM j GROUP BY run_id
""")
def check_downstream_skipped_required(spark, folder):
    """Runs without any of the listed tasks fail."""
    tasks = st.task_runs(spark, folder)
    return runs.check_downstream_skipped(tasks, ["error", "signup", "audit"], st.runs(tasks))


RULES = ["rule_0", "rule_1"]


@query("check_sensor_rules_required", f"""
    WITH {st.SENSOR_LOG},
         a AS (SELECT DISTINCT parent_run_id, upstrm_pl, snsr_rule FROM sn WHERE is_ready IS FALSE AND day(dt) % 5 = 0),
         g AS (SELECT DISTINCT parent_run_id, upstrm_pl FROM sn),
         x AS (SELECT parent_run_id, upstrm_pl, unnest({RULES}) AS snsr_rule FROM g),
         j AS (SELECT coalesce(a.parent_run_id, x.parent_run_id) AS parent_run_id, coalesce(a.upstrm_pl, x.upstrm_pl) AS upstrm_pl,
                      a.snsr_rule IS NOT NULL AS found, x.snsr_rule IS NOT NULL AS wanted
               FROM a FULL JOIN x ON a.parent_run_id = x.parent_run_id AND a.upstrm_pl = x.upstrm_pl AND a.snsr_rule = x.snsr_rule)
    SELECT parent_run_id, upstrm_pl, count(*) FILTER (NOT found) AS missing, count(*) FILTER (NOT wanted) AS unexpected,
           CASE WHEN count(*) FILTER (found <> wanted) = 0 THEN 'pass' ELSE 'fail' END AS status
    FROM j GROUP BY parent_run_id, upstrm_pl
""")
def check_sensor_rules_required(spark, folder):
    """One day in five has sensor rows; pipelines that reported on others only miss all of their rules."""
    sensor, by = st.sensor_log(spark, folder), ["parent_run_id", "upstrm_pl"]
    return sensors.check_sensor_rules(sensor.where("day(dt) % 5 = 0"), RULES, by, ready=False, required=sensor.select(*by).distinct())


@query("sensor_gate_required", f"""
    WITH {st.SENSOR_LOG},
         r AS (SELECT DISTINCT upstrm_pl, dt, 'rule_' || CAST(n AS VARCHAR) AS snsr_rule FROM sn, range(4) t(n) WHERE dt BETWEEN DATE '2024-01-01' AND DATE '2024-01-31'),
         l AS (SELECT * FROM sn WHERE dt BETWEEN DATE '2024-01-01' AND DATE '2024-01-31' AND NOT (upstrm_pl = 'click' AND day(dt) = 3)
               QUALIFY row_number() OVER (PARTITION BY upstrm_pl, dt, snsr_rule ORDER BY result_ts DESC, parent_run_id DESC) = 1),
         j AS (SELECT r.upstrm_pl, r.dt, l.is_ready IS TRUE AS ready FROM r LEFT JOIN l ON r.upstrm_pl = l.upstrm_pl AND r.dt = l.dt AND r.snsr_rule = l.snsr_rule)
    SELECT upstrm_pl, dt, count(*) AS rules, count(*) FILTER (NOT ready) AS not_ready, count(*) FILTER (NOT ready) = 0 AS is_ready,
           CASE WHEN count(*) FILTER (NOT ready) > 0 THEN 'Sensor module detected not-ready prerequisite tasks' END AS message
    FROM j GROUP BY upstrm_pl, dt
""")
def sensor_gate_required(spark, folder):
    """Each pipeline and date needs four rules, of which one never reports; one pipeline did not report on a day at all."""
    sensor = st.sensor_log(spark, folder)
    rule = F.explode(F.array(*[F.lit(f"rule_{n}") for n in range(4)])).alias("snsr_rule")
    required = sensor.select("upstrm_pl", "dt").distinct().select("upstrm_pl", "dt", rule)
    return sensors.gate(sensor.where("not (upstrm_pl = 'click' and day(dt) = 3)"), dt.date(2024, 1, 1), dt.date(2024, 1, 31), required)


@query("check_log_dates_edges", f"""
    WITH {st.EVENTS},
         e AS (SELECT CAST(user_id AS VARCHAR) AS parent_run_id, event_type AS task_nm, user_id, day, value FROM ev),
         loaded AS (SELECT DISTINCT parent_run_id, task_nm, day FROM e),
         logged AS (SELECT DISTINCT parent_run_id, task_nm, user_id, day FROM e WHERE value > 1),
         listed AS (SELECT parent_run_id, task_nm, day FROM logged WHERE user_id % 5 <> 0
                    UNION ALL SELECT parent_run_id, task_nm, min(day) FROM logged WHERE user_id % 5 <> 0 AND user_id % 3 = 0 GROUP BY ALL
                    UNION ALL SELECT DISTINCT parent_run_id, task_nm, DATE '2030-01-01' FROM logged WHERE user_id % 5 <> 0 AND user_id % 3 = 1),
         l AS (SELECT parent_run_id, task_nm, day, count(*) AS n FROM listed GROUP BY ALL),
         known AS (SELECT DISTINCT parent_run_id, task_nm FROM listed),
         j AS (SELECT coalesce(t.parent_run_id, l.parent_run_id) AS parent_run_id, coalesce(t.task_nm, l.task_nm) AS task_nm,
                      coalesce(l.n, 0) <> (t.day IS NOT NULL)::INT AS wrong
               FROM loaded t FULL JOIN l ON t.parent_run_id = l.parent_run_id AND t.task_nm = l.task_nm AND t.day = l.day)
    SELECT j.parent_run_id, j.task_nm, count(*) FILTER (wrong) AS mismatches,
           CASE WHEN any_value(known.task_nm) IS NULL THEN 'error' WHEN count(*) FILTER (wrong) = 0 THEN 'pass' ELSE 'fail' END AS status
    FROM j LEFT JOIN known ON j.parent_run_id = known.parent_run_id AND j.task_nm = known.task_nm GROUP BY j.parent_run_id, j.task_nm
""")
def check_log_dates_edges(spark, folder):
    """Newest rows with a repeated date or one that the table lacks, older rows with other dates, keys without a row."""
    keys = ["parent_run_id", "task_nm"]
    user = F.col("parent_run_id").cast("long")
    newest = st.dated_run_log(spark, folder).where(user % 5 != 0).withColumn(
        "dt_list", F.when(user % 3 == 0, F.concat(F.array(F.array_min("dt_list")), "dt_list"))
        .when(user % 3 == 1, F.concat("dt_list", F.array(F.lit("2030-01-01")))).otherwise(F.col("dt_list")))
    older = newest.withColumns({"dt_list": F.array(F.lit("1999-12-31")), "job_strt_dttm": F.expr("job_strt_dttm - interval 1 day")})
    table = st.events(spark, folder).select(
        F.col("user_id").cast("string").alias("parent_run_id"), F.col("event_type").alias("task_nm"), F.col("day").alias("dl_data_dt"))
    return logs.check_log_dates(older.unionByName(newest), table, keys, [F.col("job_strt_dttm").desc()])


@query("check_sensor_dates_missing", f"""
    WITH {st.SENSOR_LOG},
         a AS (SELECT DISTINCT parent_run_id, upstrm_pl, dt FROM sn WHERE day(dt) % 4 <> 0),
         x AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS parent_run_id, event_type AS upstrm_pl, day AS dt FROM ev WHERE value > 2),
         j AS (SELECT coalesce(a.parent_run_id, x.parent_run_id) AS parent_run_id, coalesce(a.upstrm_pl, x.upstrm_pl) AS upstrm_pl,
                      a.dt IS NULL AS missing, x.dt IS NULL AS extra
               FROM a FULL JOIN x ON a.parent_run_id = x.parent_run_id AND a.upstrm_pl = x.upstrm_pl AND a.dt = x.dt)
    SELECT parent_run_id, upstrm_pl, count(*) FILTER (missing) AS missing, count(*) FILTER (extra) AS unexpected,
           CASE WHEN count(*) FILTER (missing OR extra) = 0 THEN 'pass' ELSE 'fail' END AS status
    FROM j GROUP BY parent_run_id, upstrm_pl
""")
def check_sensor_dates_missing(spark, folder):
    """Every fourth day never reached the sensor; other days were not expected."""
    expected = st.events(spark, folder).where("value > 2").select(
        F.col("user_id").cast("string").alias("parent_run_id"), F.col("event_type").alias("upstrm_pl"), day_text(F.col("day")).alias("date"))
    return sensors.check_sensor_dates(st.sensor_log(spark, folder).where("day(dt) % 4 <> 0"), expected, ["parent_run_id", "upstrm_pl"])
