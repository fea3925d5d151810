"""Comparison queries for logs, runs, sensors and text."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from veriframe.functions import text
from veriframe.functions.time import day_text, epoch_to_timestamp, resolve_load_date
from veriframe.operators import logs, results, runs, sensors
from veriframe.operators.anomaly import against_history, against_lookback, against_month_end, against_running
from veriframe.operators.messages import lines_with_messages, message_hits_from
from veriframe.operators.profile import metric, profile
from veriframe.plans import standins as st
from veriframe.plans.registered import query
from veriframe.sources.files import read_log_lines
from veriframe.sources.history import append_history, history_means
from veriframe.sources.runs import flatten_tasks, read_runs
from veriframe.sources.tables import load
from veriframe.sources.workspace import work_dir

def _status(violations: str) -> str:
    return f"CASE WHEN {violations} = 0 THEN 'pass' ELSE 'fail' END"


@query("filter_log_rows", f"""
    WITH {st.RUN_LOG}
    SELECT event_id, parent_run_id, task_nm, job_sts FROM lg
    WHERE prdct = 'product 1' AND task_nm = 'error' AND job_strt_dt = DATE '2024-01-17' AND job_sts = 'FAILED'
""")
def filter_log_rows(spark, folder):
    wanted = {"prdct": "product 1", "task_nm": "error", "job_strt_dt": dt.date(2024, 1, 17), "job_sts": "FAILED"}
    return logs.where_equal(st.run_log(spark, folder), wanted).select("event_id", "parent_run_id", "task_nm", "job_sts")


@query("check_error_keyword", f"""
    WITH {st.RUN_LOG}
    SELECT parent_run_id, count(*) FILTER (contains(err_msg, '5% of ''rows''')) AS hits,
           CASE WHEN hits > 0 THEN 'pass' ELSE 'fail' END AS status
    FROM lg GROUP BY parent_run_id
""")
def check_error_keyword(spark, folder):
    return logs.check_error_keyword(st.run_log(spark, folder), ["parent_run_id"], "5% of 'rows'")


@query("check_log_array_keyword", f"""
    WITH {st.RUN_LOG}
    SELECT parent_run_id, task_nm, count(*) FILTER (len(list_filter(cstm_val, lambda x: contains(x, '9% d'))) > 0) AS hits,
           CASE WHEN hits > 0 THEN 'pass' ELSE 'fail' END AS status
    FROM lg GROUP BY parent_run_id, task_nm
""")
def check_log_array_keyword(spark, folder):
    return logs.check_array_keyword(st.run_log(spark, folder), ["parent_run_id", "task_nm"], "cstm_val", "9% d")


MESSAGES = ["error", "a.b", "the ", "Copyright", "100%"]


@query("check_log_messages", f"""
    WITH m AS (SELECT unnest({MESSAGES}) AS message),
         h AS (SELECT message, (SELECT count(*) FROM documents WHERE contains(text, message)) AS hits FROM m)
    SELECT message, hits, CASE WHEN (SELECT sum(hits) FROM h) > 0 THEN 'pass' ELSE 'fail' END AS status FROM h
""")
def check_log_messages(spark, folder):
    return logs.message_hits(load(spark, folder, "documents"), "text", MESSAGES)


# every run of three words of the benchmark is a message
PHRASES = """
    w AS (SELECT item_id, string_split(text, ' ') AS words FROM benchmark WHERE text IS NOT NULL),
    p AS (SELECT DISTINCT unnest(list_transform(range(1, len(words) - 1), lambda i: array_to_string(words[i:i + 2], ' '))) AS message FROM w)"""


def _phrases(spark, folder):
    words = load(spark, folder, "benchmark").select(F.split("text", " ").alias("words")).where("size(words) >= 3")
    return words.select(F.explode(F.expr("transform(sequence(1, size(words) - 2), i -> array_join(slice(words, i, 3), ' '))")).alias("message"))


@query("check_log_messages_table", f"""
    WITH {PHRASES},
         h AS (SELECT message, (SELECT count(*) FROM documents WHERE contains(text, message)) AS hits FROM p)
    SELECT message, hits, CASE WHEN (SELECT max(hits) FROM h) > 0 THEN 'pass' ELSE 'fail' END AS status FROM h
""")
def check_log_messages_table(spark, folder):
    return message_hits_from(load(spark, folder, "documents"), "text", _phrases(spark, folder))


@query("filter_log_messages_table", f"""
    WITH {PHRASES}
    SELECT doc_id, count(*) AS messages FROM documents JOIN p ON contains(text, message) GROUP BY doc_id
""")
def filter_log_messages_table(spark, folder):
    lines = load(spark, folder, "documents").select("doc_id", "text")
    return lines_with_messages(lines, "text", _phrases(spark, folder)).select("doc_id", "messages")


@query("filter_log_messages", """
    SELECT doc_id FROM documents WHERE regexp_matches(text, 'Copyright|[0-9]{3}-[0-9]{4}|@example')
""")
def filter_log_messages(spark, folder):
    patterns = ["Copyright", "[0-9]{3}-[0-9]{4}", "@example"]
    return load(spark, folder, "documents").where(text.contains_any("text", patterns, regex=True)).select("doc_id")


@query("log_line_split", """
    SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')[1:24] AS time_value,
           strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')[25:] || ' ' || event_type || ' of user ' || CAST(user_id AS VARCHAR) AS message
    FROM events
""")
def log_line_split(spark, folder):
    # The time is 26 characters wide here, so the split falls inside it.
    time = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    line = F.concat(time, F.lit(" "), "event_type", F.lit(" of user "), F.col("user_id").cast("string"))
    path = work_dir(spark, "log-lines")
    load(spark, folder, "events").select(line.alias("value")).write.text(path)
    return read_log_lines(spark, f"{path}/*")


@query("check_log_dates", f"""
    WITH {st.EVENTS},
         loaded AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS parent_run_id, event_type AS task_nm, day FROM ev),
         logged AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS parent_run_id, event_type AS task_nm, day FROM ev WHERE value > 1),
         j AS (SELECT l.parent_run_id, l.task_nm, g.day IS NULL AS missing, g.day IS NOT NULL AS known
               FROM loaded l LEFT JOIN logged g ON l.parent_run_id = g.parent_run_id AND l.task_nm = g.task_nm AND l.day = g.day)
    SELECT parent_run_id, task_nm, count(*) FILTER (missing) AS mismatches,
           CASE WHEN count(*) FILTER (known) = 0 THEN 'error' WHEN count(*) FILTER (missing) = 0 THEN 'pass' ELSE 'fail' END AS status
    FROM j GROUP BY parent_run_id, task_nm
""")
def check_log_dates(spark, folder):
    keys = ["parent_run_id", "task_nm"]
    table = st.events(spark, folder).select(
        F.col("user_id").cast("string").alias("parent_run_id"), F.col("event_type").alias("task_nm"),
        F.col("day").alias("dl_data_dt"),
    )
    order = [F.col("job_strt_dttm").desc()]
    return logs.check_log_dates(st.dated_run_log(spark, folder), table, keys, order)


@query("check_log_counts", f"""
    WITH {st.TASK_RUNS}, {st.LOG_ROWS},
         x AS (SELECT CAST(job_id AS VARCHAR) AS parent_id, CAST(run_id AS VARCHAR) AS parent_run_id,
                      '{st.WORKSPACE}/?o=42#job/' || CAST(job_id AS VARCHAR) || '/run/' ||
                          CAST(min(task_run_id) AS VARCHAR) AS job_uri, task_key AS task_nm
               FROM tr GROUP BY job_id, run_id, task_key)
    SELECT x.parent_id, x.parent_run_id, x.job_uri, x.task_nm, count(lg.event_id) AS log_rows,
           CASE WHEN count(lg.event_id) = 1 THEN 'pass' ELSE 'fail' END AS status
    FROM x LEFT JOIN lg ON x.parent_id = lg.parent_id AND x.parent_run_id = lg.parent_run_id
                       AND x.job_uri = lg.job_uri AND x.task_nm = lg.task_nm
    GROUP BY ALL
""")
def check_log_counts(spark, folder):
    return logs.check_log_counts(st.run_log(spark, folder), st.task_runs(spark, folder), st.WORKSPACE)


@query("check_log_record", f"""
    WITH {st.RUN_LOG},
         newest AS (SELECT * FROM lg QUALIFY row_number() OVER (PARTITION BY parent_id, task_nm ORDER BY job_strt_dttm DESC, event_id DESC) = 1),
         oldest AS (SELECT * FROM lg QUALIFY row_number() OVER (PARTITION BY parent_id, task_nm ORDER BY job_strt_dttm, event_id) = 1),
         p AS (SELECT n.parent_id, n.task_nm, n.job_sts = o.job_sts AS a, n.prdct = o.prdct AS b,
                      n.major = o.major AND n.minor = o.minor AS c, n.prdct AS n_prdct, o.prdct AS o_prdct,
                      n.job_sts AS n_sts, o.job_sts AS o_sts,
                      '{{"major":"' || n.major || '","minor":"' || n.minor || '"}}' AS n_v,
                      '{{"major":"' || o.major || '","minor":"' || o.minor || '"}}' AS o_v
               FROM newest n JOIN oldest o ON n.parent_id = o.parent_id AND n.task_nm = o.task_nm)
    SELECT parent_id, task_nm, 'job_sts' AS "column", CASE WHEN a THEN 'pass' ELSE 'fail' END AS status, n_sts AS actual, o_sts AS expected FROM p
    UNION ALL SELECT parent_id, task_nm, 'prdct', CASE WHEN b THEN 'pass' ELSE 'fail' END, n_prdct, o_prdct FROM p
    UNION ALL SELECT parent_id, task_nm, 'relse_vrsn', CASE WHEN c THEN 'pass' ELSE 'fail' END, n_v, o_v FROM p
""")
def check_log_record(spark, folder):
    log = st.run_log(spark, folder)
    keys = ["parent_id", "task_nm"]
    newest = [F.col("job_strt_dttm").desc(), F.col("event_id").desc()]
    oldest = logs.latest_rows(log, keys, [F.col("job_strt_dttm"), F.col("event_id")])
    return logs.check_log_records(log, oldest, keys, ["job_sts", "prdct", "relse_vrsn"], newest)


@query("run_uri", f"""
    WITH {st.TASK_RUNS}
    SELECT task_run_id, '{st.WORKSPACE}/?o=42#job/' || CAST(job_id AS VARCHAR) || '/run/' || CAST(task_run_id AS VARCHAR) AS job_uri
    FROM tr
""")
def run_uri(spark, folder):
    uri = text.run_uri(F.lit(st.WORKSPACE), F.col("job_id"), F.col("task_run_id"))
    return st.task_runs(spark, folder).select("task_run_id", uri.alias("job_uri"))


@query("epoch_normalize", f"""
    WITH {st.EVENTS}, x AS (
        SELECT event_id, CASE k % 7 WHEN 0 THEN epoch_us(ts) // 1000000 WHEN 1 THEN epoch_us(ts) // 1000
                                    WHEN 2 THEN epoch_us(ts) WHEN 3 THEN epoch_us(ts) // 10000000
                                    WHEN 4 THEN epoch_us(ts) * 10 + 9 WHEN 5 THEN epoch_us(ts) * 100 + 99
                                    ELSE epoch_us(ts) * 1000 + 999 END AS epoch FROM ev)
    SELECT event_id, epoch,
           make_timestamp(CASE WHEN length(CAST(epoch AS VARCHAR)) > 16 THEN epoch_us(ts)
               ELSE epoch * CAST(10 ** (16 - length(CAST(epoch AS VARCHAR))) AS BIGINT) END) AS moment
    FROM x JOIN ev USING (event_id)
""")
def epoch_normalize(spark, folder):
    k, micros = F.col("k") % 7, st.epoch_micros(F.col("ts"))
    divisor = F.when(k == 0, 1_000_000).when(k == 1, 1_000).when(k == 3, 10_000_000).otherwise(1)
    factor = F.when(k == 4, 10).when(k == 5, 100).when(k == 6, 1_000).otherwise(1)
    epoch = F.floor(micros / divisor).cast("bigint") * factor + factor - 1
    rows = st.events(spark, folder).select("event_id", epoch.cast("bigint").alias("epoch"))
    return rows.withColumn("moment", st.utc_ntz(epoch_to_timestamp(F.col("epoch"))))


@query("task_runs_flat", f"""
    WITH {st.TASK_RUNS},
         t AS (SELECT *, unnest([1, 2]) AS part FROM tr)
    SELECT job_id, run_id, run_name, 'TERMINATED' AS run_life_cycle_state,
           task_key || CASE part WHEN 1 THEN '_extract' ELSE '_load' END AS task_key,
           task_run_id * 2 + part - 1 AS task_run_id, life_cycle_state, result_state, state_message,
           start_time, end_time, setup_duration, execution_duration
    FROM t
""")
def task_runs_flat(spark, folder):
    path = work_dir(spark, "run-documents")
    _run_documents(st.task_runs(spark, folder)).write.json(path)
    return flatten_tasks(read_runs(spark, path))


def _run_documents(tasks):
    """Nested run documents with two tasks each."""
    state = F.struct("life_cycle_state", "result_state", "state_message")

    def task(suffix, number):
        return F.struct(
            F.concat("task_key", F.lit(suffix)).alias("task_key"),
            (F.col("task_run_id") * 2 + number).alias("run_id"), state.alias("state"),
            "start_time", "end_time", "setup_duration", "execution_duration",
        )

    return tasks.select(
        "job_id", "run_id", "run_name", F.struct(F.lit("TERMINATED").alias("life_cycle_state")).alias("state"),
        F.array(task("_extract", 0), task("_load", 1)).alias("tasks"),
    )


TASK_VERDICT = """
    tv AS (SELECT run_id, count(*) AS tasks, count(*) FILTER (result_state IS DISTINCT FROM 'SUCCESS') AS not_successful,
                  CASE WHEN count(*) FILTER (result_state IS DISTINCT FROM 'SUCCESS') = 0 THEN 'pass' ELSE 'fail' END AS status
           FROM tr GROUP BY run_id)"""


@query("check_tasks_complete", f"WITH {st.TASK_RUNS}, {TASK_VERDICT} SELECT * FROM tv")
def check_tasks_complete(spark, folder):
    return runs.check_tasks_complete(st.task_runs(spark, folder))


@query("failed_tasks", f"""
    WITH {st.TASK_RUNS}
    SELECT run_id, task_run_id, task_key, result_state,
           'Result status of task_key:' || task_key || ', run_id:' || CAST(task_run_id AS VARCHAR) || ', ' ||
               coalesce(result_state, 'None') || ', ' || coalesce(state_message, 'None') || '.' AS message
    FROM tr WHERE result_state IS DISTINCT FROM 'SUCCESS'
""")
def failed_tasks(spark, folder):
    return runs.failed_tasks(st.task_runs(spark, folder))


@query("check_run_terminated", f"""
    WITH {st.RUNS}, {TASK_VERDICT}
    , bad AS (SELECT run_id, string_agg(m, ' ' ORDER BY m) AS failed FROM (
        SELECT run_id, 'Result status of task_key:' || task_key || ', run_id:' || CAST(task_run_id AS VARCHAR) || ', ' ||
               coalesce(result_state, 'None') || ', ' || coalesce(state_message, 'None') || '.' AS m
        FROM tr WHERE result_state IS DISTINCT FROM 'SUCCESS') GROUP BY run_id)
    SELECT rn.run_id, rn.life_cycle_state, tv.not_successful,
           CASE WHEN rn.life_cycle_state = 'TERMINATED' AND tv.not_successful = 0 THEN 'pass' ELSE 'fail' END AS status,
           CASE WHEN rn.life_cycle_state <> 'TERMINATED' THEN 'Result life cycle state of run_name:' || run_name ||
                ', run_id:' || CAST(rn.run_id AS VARCHAR) || ' is ' || rn.life_cycle_state || '.' ELSE bad.failed END AS message
    FROM rn JOIN tv ON rn.run_id = tv.run_id LEFT JOIN bad ON rn.run_id = bad.run_id
""")
def check_run_terminated(spark, folder):
    tasks = st.task_runs(spark, folder)
    return runs.check_run_terminated(st.runs(tasks), tasks)


@query("check_downstream_skipped", f"""
    WITH {st.TASK_RUNS}
    SELECT run_id, count(*) AS present,
           count(*) FILTER (life_cycle_state <> 'SKIPPED' OR result_state IS DISTINCT FROM 'UPSTREAM_FAILED') AS not_skipped,
           3 - count(DISTINCT task_key) AS missing,
           CASE WHEN not_skipped = 0 THEN 'pass' ELSE 'fail' END AS status
    FROM tr WHERE task_key IN ('error', 'signup', 'audit') GROUP BY run_id
""")
def check_downstream_skipped(spark, folder):
    return runs.check_downstream_skipped(st.task_runs(spark, folder), ["error", "signup", "audit"])


DURATION = """
    run_id, make_timestamp(start_time * 1000) AS start_time, make_timestamp(end_time * 1000) AS end_time,
    round(setup_duration / 1000, 3) AS setup_duration, round(execution_duration / 1000, 3) AS execution_duration"""


@query("task_durations", f"WITH {st.TASK_RUNS} SELECT task_run_id, task_key, {DURATION} FROM tr")
def task_durations(spark, folder):
    rows = runs.task_durations(st.task_runs(spark, folder))
    return _readable(rows, ["start_time", "end_time"], ["setup_duration", "execution_duration"])


def _readable(df, times, durations):
    for name in times:
        df = df.withColumn(name, st.utc_ntz(F.col(name)))
    for name in durations:
        df = df.withColumn(name, F.round(name, 3))
    return df


WORKFLOW = """
    w AS (SELECT run_id, run_name AS workflow_name, make_timestamp(start_time * 1000) AS workflow_start_time,
                 make_timestamp(end_time * 1000) AS workflow_end_time,
                 round(setup_duration / 1000, 3) AS workflow_setup_duration,
                 round(coalesce(run_duration, execution_duration) / 1000, 3) AS workflow_execution_duration FROM rn)"""

WORKFLOW_TIMES = ["workflow_start_time", "workflow_end_time"]
WORKFLOW_DURATIONS = ["workflow_setup_duration", "workflow_execution_duration"]


@query("results_with_run", f"""
    WITH {st.RUNS}, {TASK_VERDICT}, {WORKFLOW}
    SELECT tv.run_id, tasks, not_successful, status, workflow_name, workflow_start_time, workflow_end_time,
           workflow_setup_duration, workflow_execution_duration, '{{"data_size":"100"}}' AS test_param
    FROM tv JOIN w ON tv.run_id = w.run_id
    UNION ALL
    SELECT run_id, tasks, not_successful, status, 'skip', NULL, NULL, NULL, NULL, '{{"data_size":"100"}}' FROM tv
""")
def results_with_run(spark, folder):
    tasks = st.task_runs(spark, folder)
    verdicts = runs.check_tasks_complete(tasks)
    param = {"data_size": 100}
    with_run = results.with_run(verdicts, st.runs(tasks), param)
    rows = with_run.unionByName(results.with_run(verdicts, None, param))
    return _readable(rows, WORKFLOW_TIMES, WORKFLOW_DURATIONS)


@query("timing_rows", f"""
    WITH {st.RUNS}, {WORKFLOW}, d AS (SELECT task_run_id, task_key AS task_name, {DURATION} FROM tr)
    SELECT d.*, w.* EXCLUDE (run_id), CAST(NULL AS VARCHAR) AS test_param, CAST(NULL AS VARCHAR) AS sub_process,
           CAST(NULL AS VARCHAR) AS log_params FROM d JOIN w ON d.run_id = w.run_id
""")
def timing_rows(spark, folder):
    tasks = st.task_runs(spark, folder)
    return _readable(
        results.timing_rows(tasks, st.runs(tasks)), ["start_time", "end_time", *WORKFLOW_TIMES],
        ["setup_duration", "execution_duration", *WORKFLOW_DURATIONS],
    )


@query("param_matrix", """
    SELECT c_custkey AS job_id, cluster, data_size,
           '{"cluster":"' || cluster || '","data_size":"' || CAST(data_size AS VARCHAR) || '"}' AS test_param
    FROM customer, (SELECT unnest(['small', 'large']) AS cluster), (SELECT unnest([100, 300, 900]) AS data_size)
""")
def param_matrix(spark, folder):
    configs = load(spark, folder, "customer").select(F.col("c_custkey").alias("job_id"))
    return results.parameter_matrix(configs, {"cluster": ["small", "large"], "data_size": [100, 300, 900]})


@query("resolve_run_dates", """
    WITH x AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' OR o_orderpriority = '5-LOW' THEN DATE '2001-08-13'
                                       ELSE CAST(o_orderdate AS DATE) END AS load_date FROM orders)
    SELECT o_orderkey, load_date, load_date - 3 AS window_start,
           CAST(date_trunc('month', load_date) AS DATE) - 1 AS month_end FROM x
""")
def resolve_run_dates(spark, folder):
    given = F.to_date("o_orderdate")
    start = F.when(F.col("o_orderstatus") == "P", "-skip").otherwise(day_text(given))
    end = F.when(F.col("o_orderpriority") == "5-LOW", "-skip").otherwise(day_text(given))
    load_date = resolve_load_date(start, end, given, F.lit("2001-08-15").cast("date"))
    return load(spark, folder, "orders").select("o_orderkey", load_date.alias("load_date")).select(
        "o_orderkey", "load_date", F.date_sub("load_date", 3).alias("window_start"),
        F.date_sub(F.trunc("load_date", "MM"), 1).alias("month_end"),
    )


RULES = ["rule_0", "rule_1", "rule_3"]


@query("check_sensor_rules", f"""
    WITH {st.SENSOR_LOG},
         a AS (SELECT DISTINCT parent_run_id, upstrm_pl, snsr_rule FROM sn WHERE is_ready IS FALSE),
         g AS (SELECT DISTINCT parent_run_id, upstrm_pl FROM sn),
         x AS (SELECT parent_run_id, upstrm_pl, unnest({RULES}) AS snsr_rule FROM g),
         j AS (SELECT coalesce(a.parent_run_id, x.parent_run_id) AS parent_run_id, coalesce(a.upstrm_pl, x.upstrm_pl) AS upstrm_pl,
                      a.snsr_rule IS NOT NULL AS found, x.snsr_rule IS NOT NULL AS wanted
               FROM a FULL JOIN x ON a.parent_run_id = x.parent_run_id AND a.upstrm_pl = x.upstrm_pl AND a.snsr_rule = x.snsr_rule)
    SELECT parent_run_id, upstrm_pl, count(*) FILTER (NOT found) AS missing, count(*) FILTER (NOT wanted) AS unexpected,
           {_status('count(*) FILTER (found <> wanted)')} AS status
    FROM j GROUP BY parent_run_id, upstrm_pl
""")
def check_sensor_rules(spark, folder):
    return sensors.check_sensor_rules(st.sensor_log(spark, folder), RULES, ["parent_run_id", "upstrm_pl"], ready=False)


@query("check_sensor_dates", f"""
    WITH {st.SENSOR_LOG},
         a AS (SELECT DISTINCT parent_run_id, upstrm_pl, dt FROM sn),
         x AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS parent_run_id, event_type AS upstrm_pl, day AS dt FROM ev WHERE value > 2),
         j AS (SELECT a.parent_run_id, a.upstrm_pl, x.dt IS NULL AS extra FROM a
               LEFT JOIN x ON a.parent_run_id = x.parent_run_id AND a.upstrm_pl = x.upstrm_pl AND a.dt = x.dt)
    SELECT parent_run_id, upstrm_pl, CAST(0 AS BIGINT) AS missing, count(*) FILTER (extra) AS unexpected,
           {_status('count(*) FILTER (extra)')} AS status
    FROM j GROUP BY parent_run_id, upstrm_pl
""")
def check_sensor_dates(spark, folder):
    expected = st.events(spark, folder).where("value > 2").select(
        F.col("user_id").cast("string").alias("parent_run_id"), F.col("event_type").alias("upstrm_pl"),
        day_text(F.col("day")).alias("date"),
    )
    return sensors.check_sensor_dates(st.sensor_log(spark, folder), expected, ["parent_run_id", "upstrm_pl"])


@query("sensor_gate_latest", f"""
    WITH {st.SENSOR_LOG},
         l AS (SELECT * FROM sn WHERE dt BETWEEN DATE '2024-01-01' AND DATE '2024-01-31'
               QUALIFY row_number() OVER (PARTITION BY upstrm_pl, dt, snsr_rule ORDER BY result_ts DESC, parent_run_id DESC) = 1)
    SELECT upstrm_pl, dt, count(*) AS rules, count(*) FILTER (is_ready IS NOT TRUE) AS not_ready,
           count(*) FILTER (is_ready IS NOT TRUE) = 0 AS is_ready,
           CASE WHEN count(*) FILTER (is_ready IS NOT TRUE) > 0 THEN 'Sensor module detected not-ready prerequisite tasks' END AS message
    FROM l GROUP BY upstrm_pl, dt
""")
def sensor_gate_latest(spark, folder):
    return sensors.gate(st.sensor_log(spark, folder), dt.date(2024, 1, 1), dt.date(2024, 1, 31))


def _day_metrics(df, column):
    """Money as a decimal, so that day sums are exact and the references compare at four digits."""
    exact = df.withColumn(column, F.col(column).cast("decimal(18,2)"))
    wanted = [metric(n, column) for n in ("Minimum", "Maximum", "Sum")]
    return profile(exact, wanted, ["day"]).select("day", "instance", "name", "value")


DAY_METRICS = """
    dm AS (SELECT day, 'value' AS instance, name, value FROM (
               UNPIVOT (SELECT day, min(value) AS "Minimum", max(value) AS "Maximum",
                               CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) AS "Sum" FROM ev GROUP BY day)
               ON "Minimum", "Maximum", "Sum" INTO NAME name VALUE value))"""

LOOKBACK = """
    lb AS (SELECT day, instance, name, value,
                  avg(value) OVER (PARTITION BY instance, name ORDER BY day RANGE BETWEEN INTERVAL 3 DAYS PRECEDING AND INTERVAL 1 DAY PRECEDING) AS reference
           FROM dm)"""


def _judged_sql(source, relative):
    return f"""
    SELECT day, instance, name, round(value, 4) AS value, round(reference, 4) AS reference,
           abs(value - reference) <= {relative} * abs(reference) AS is_ready FROM {source}"""


def _rounded(df):
    return df.withColumn("value", F.round("value", 4)).withColumn("reference", F.round("reference", 4))


@query("anomaly_mean_d3", f"WITH {st.EVENTS}, {DAY_METRICS}, {LOOKBACK} {_judged_sql('lb', 0.2)}")
def anomaly_mean_d3(spark, folder):
    metrics = _day_metrics(st.events(spark, folder), "value")
    return _rounded(against_lookback(metrics, 3, relative=0.2))


ORDER_METRICS = """
    od AS (SELECT CAST(o_orderdate AS DATE) AS day, 'o_totalprice' AS instance, name, value FROM (
               UNPIVOT (SELECT o_orderdate, min(o_totalprice) AS "Minimum", max(o_totalprice) AS "Maximum",
                               CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS "Sum" FROM orders GROUP BY o_orderdate)
               ON "Minimum", "Maximum", "Sum" INTO NAME name VALUE value))"""


def _order_metrics(spark, folder):
    return _day_metrics(load(spark, folder, "orders").withColumn("day", F.to_date("o_orderdate")), "o_totalprice")


@query("anomaly_prev_month_end", f"""
    WITH {ORDER_METRICS},
         pm AS (SELECT a.day, a.instance, a.name, a.value, b.value AS reference
                FROM od a LEFT JOIN od b ON a.name = b.name AND b.day = CAST(date_trunc('month', a.day) AS DATE) - 1)
    {_judged_sql('pm', 0.1)}
""")
def anomaly_prev_month_end(spark, folder):
    return _rounded(against_month_end(_order_metrics(spark, folder), relative=0.1)).drop("month_end")


@query("anomaly_mean_history", f"""
    WITH {ORDER_METRICS},
         h AS (SELECT a.day, a.instance, a.name, a.value,
                      (SELECT avg(value) FROM od b WHERE b.name = a.name AND b.day < DATE '2001-01-01') AS reference
               FROM od a WHERE a.day >= DATE '2001-01-01')
    {_judged_sql('h', 0.25)}
""")
def anomaly_mean_history(spark, folder):
    metrics = _order_metrics(spark, folder)
    return _rounded(against_history(
        metrics.where("day >= '2001-01-01'"), metrics.where("day < '2001-01-01'"), relative=0.25
    ))


@query("anomaly_mean_running", f"""
    WITH {ORDER_METRICS},
         h AS (SELECT a.day, a.instance, a.name, a.value,
                      (SELECT avg(value) FROM od b WHERE b.name = a.name AND b.day < DATE '2001-01-01') AS reference
               FROM od a WHERE a.day >= DATE '2001-01-01')
    {_judged_sql('h', 0.25)}
""")
def anomaly_mean_running(spark, folder):
    """The history comes in three runs, of which one came with other values first."""
    metrics, path = _order_metrics(spark, folder), work_dir(spark, "history")
    second = metrics.where("day >= '1997-01-01' and day < '1999-01-01'")
    append_history(metrics.where("day < '1997-01-01'"), path, 1)
    append_history(second.where("name <> 'Sum'").withColumn("value", F.col("value") + 1000), path, 2)
    append_history(metrics.where("day >= '1999-01-01' and day < '2001-01-01'"), path, 3)
    append_history(second, path, 2)
    return _rounded(against_running(metrics.where("day >= '2001-01-01'"), history_means(spark, path), relative=0.25))


@query("sensor_results", f"""
    WITH {st.EVENTS}, {DAY_METRICS}, {LOOKBACK}
    SELECT '7' AS parent_run_id, 'daily' AS upstrm_pl, day AS dt,
           'AnomalyConstraint(Mean(value,Some(name=''' || name || ''' and instance=''' || instance || ''')))' AS snsr_rule,
           abs(value - reference) <= 0.2 * abs(reference) AS is_ready FROM lb
""")
def sensor_results(spark, folder):
    judged = against_lookback(_day_metrics(st.events(spark, folder), "value"), 3, relative=0.2)
    return sensors.sensor_results(judged, "7", "daily")
