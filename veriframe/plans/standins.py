"""Frames shaped like the checked tables, built from the test tables.

Each function has a SQL twin in capitals, for the comparison queries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veriframe.functions.text import run_uri
from veriframe.functions.time import day_text
from veriframe.sources.tables import load

WORKSPACE = "adb-42.7.example.net"


def utc_ntz(value: Column) -> Column:
    """A timestamp as its UTC wall clock, whatever the session's zone."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), value.cast("timestamp_ntz"))


def epoch_micros(ts: Column) -> Column:
    """Microseconds since 1970 of a zone-less timestamp."""
    days = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("bigint")
    seconds = days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60
    return seconds * 1000000 + (F.extract(F.lit("SECOND"), ts) * 1000000).cast("bigint")


def events(spark: SparkSession, folder: str) -> DataFrame:
    """Events with their day and the number inside their properties."""
    return load(spark, folder, "events").select(
        "event_id", "user_id", "event_type", "value", "ts",
        F.to_date("ts").alias("day"),
        F.get_json_object("props", "$.k").try_cast("bigint").alias("k"),
    )


EVENTS = """
    ev AS (
        SELECT event_id, user_id, event_type, value, ts, CAST(ts AS DATE) AS day,
               CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k
        FROM events
    )"""


def transactions(spark: SparkSession, folder: str, prefix: str = "11") -> DataFrame:
    """Source rows: id, number of transactions, day."""
    return events(spark, folder).select(
        F.concat(F.lit(prefix), (F.lit(10 ** 9) + F.col("user_id")).cast("string")).alias("uc_id"),
        F.col("k").cast("int").alias("transactions"), F.col("day").alias("dl_data_dt"),
    )


TRANSACTIONS = EVENTS + """,
    tx AS (
        SELECT '11' || CAST(1000000000 + user_id AS VARCHAR) AS uc_id, k AS transactions, day AS dl_data_dt
        FROM ev
    )"""


def task_runs(spark: SparkSession, folder: str) -> DataFrame:
    """One task run per event, five to a run."""
    k, error = F.col("k"), F.col("event_type") == "error"
    start = F.floor(epoch_micros(F.col("ts")) / 1000).cast("bigint")
    milliseconds = F.round(F.col("value") * 1000).cast("bigint")
    run = F.floor(F.col("event_id") / 5).cast("bigint")
    return events(spark, folder).select(
        (run % 10).alias("job_id"), run.alias("run_id"),
        F.concat(F.lit("job "), (run % 10).cast("string")).alias("run_name"),
        F.col("event_id").alias("task_run_id"), F.col("event_type").alias("task_key"),
        F.when(error & (k < 60), "SKIPPED").when(k == 99, "RUNNING").otherwise("TERMINATED").alias("life_cycle_state"),
        F.when(error & (k < 60), "UPSTREAM_FAILED").when(k == 99, None)
        .when(error, "FAILED").otherwise("SUCCESS").alias("result_state"),
        F.when(k % 10 != 0, F.concat(F.lit("code "), k.cast("string"))).alias("state_message"),
        start.alias("start_time"), (start + milliseconds).alias("end_time"),
        (k * 10).alias("setup_duration"), milliseconds.alias("execution_duration"),
    )


TASK_RUNS = EVENTS + """,
    tr AS (
        SELECT (event_id // 5) % 10 AS job_id, event_id // 5 AS run_id,
               'job ' || CAST((event_id // 5) % 10 AS VARCHAR) AS run_name,
               event_id AS task_run_id, event_type AS task_key,
               CASE WHEN event_type = 'error' AND k < 60 THEN 'SKIPPED'
                    WHEN k = 99 THEN 'RUNNING' ELSE 'TERMINATED' END AS life_cycle_state,
               CASE WHEN event_type = 'error' AND k < 60 THEN 'UPSTREAM_FAILED'
                    WHEN k = 99 THEN NULL WHEN event_type = 'error' THEN 'FAILED'
                    ELSE 'SUCCESS' END AS result_state,
               CASE WHEN k % 10 <> 0 THEN 'code ' || CAST(k AS VARCHAR) END AS state_message,
               epoch_us(ts) // 1000 AS start_time,
               epoch_us(ts) // 1000 + CAST(round(value * 1000) AS BIGINT) AS end_time,
               k * 10 AS setup_duration, CAST(round(value * 1000) AS BIGINT) AS execution_duration
        FROM ev
    )"""


def runs(task_rows: DataFrame) -> DataFrame:
    """Run records over task runs; every fifth run has no run duration."""
    run = F.col("run_id")
    return task_rows.groupBy("job_id", "run_id", "run_name").agg(
        F.min("start_time").alias("start_time"), F.max("end_time").alias("end_time"),
        F.sum("setup_duration").alias("setup_duration"),
        F.sum("execution_duration").alias("execution_duration"),
    ).select(
        "*",
        F.when(run % 7 == 0, "INTERNAL_ERROR").otherwise("TERMINATED").alias("life_cycle_state"),
        F.when(run % 5 != 0, F.col("end_time") - F.col("start_time")).alias("run_duration"),
    )


RUNS = TASK_RUNS + """,
    rn AS (
        SELECT job_id, run_id, run_name, min(start_time) AS start_time, max(end_time) AS end_time,
               CAST(sum(setup_duration) AS BIGINT) AS setup_duration,
               CAST(sum(execution_duration) AS BIGINT) AS execution_duration,
               CASE WHEN run_id % 7 = 0 THEN 'INTERNAL_ERROR' ELSE 'TERMINATED' END AS life_cycle_state,
               CASE WHEN run_id % 5 <> 0 THEN max(end_time) - min(start_time) END AS run_duration
        FROM tr GROUP BY job_id, run_id, run_name
    )"""


def run_log(spark: SparkSession, folder: str) -> DataFrame:
    """Log rows, one per event: some point at a wrong run, some have no custom values."""
    k, error = F.col("k"), F.col("event_type") == "error"
    run = F.floor(F.col("event_id") / 5).cast("bigint")
    logged_run = F.when(k < 80, F.col("event_id")).otherwise(F.col("event_id") - 1)
    value = F.struct(F.concat(F.lit("rule "), k.cast("string"), F.lit("% done")).alias("val"))
    kind = F.struct(F.col("event_type").alias("val"))
    return events(spark, folder).select(
        "event_id", "value",
        (run % 10).cast("string").alias("parent_id"), run.cast("string").alias("parent_run_id"),
        F.col("event_type").alias("task_nm"),
        F.concat(F.lit("product "), (k % 3).cast("string")).alias("prdct"),
        run_uri(F.lit(WORKSPACE), run % 10, logged_run).alias("job_uri"),
        F.when(error, "FAILED").otherwise("SUCCESS").alias("job_sts"),
        F.when(error, F.concat(F.lit("DeequAuditError: "), k.cast("string"), F.lit("% of 'rows' broken")))
        .alias("err_msg"),
        F.col("day").alias("job_strt_dt"), F.col("ts").alias("job_strt_dttm"),
        F.struct((k % 4).cast("string").alias("major"), (k % 2).cast("string").alias("minor")).alias("relse_vrsn"),
        F.when(k % 5 == 1, F.array().cast("array<struct<val:string>>"))
        .when(k % 5 > 1, F.array(value, kind)).alias("cstm_val"),
    )


LOG_ROWS = f"""
    lg AS (
        SELECT event_id, value, CAST((event_id // 5) % 10 AS VARCHAR) AS parent_id,
               CAST(event_id // 5 AS VARCHAR) AS parent_run_id, event_type AS task_nm,
               'product ' || CAST(k % 3 AS VARCHAR) AS prdct,
               '{WORKSPACE}/?o=42#job/' || CAST((event_id // 5) % 10 AS VARCHAR) || '/run/' ||
                   CAST(CASE WHEN k < 80 THEN event_id ELSE event_id - 1 END AS VARCHAR) AS job_uri,
               CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS job_sts,
               CASE WHEN event_type = 'error'
                    THEN 'DeequAuditError: ' || CAST(k AS VARCHAR) || '% of ''rows'' broken' END AS err_msg,
               day AS job_strt_dt, ts AS job_strt_dttm,
               CAST(k % 4 AS VARCHAR) AS major, CAST(k % 2 AS VARCHAR) AS minor,
               CASE WHEN k % 5 = 1 THEN CAST([] AS VARCHAR[])
                    WHEN k % 5 > 1 THEN ['rule ' || CAST(k AS VARCHAR) || '% done', event_type] END AS cstm_val
        FROM ev
    )"""

RUN_LOG = EVENTS + "," + LOG_ROWS


def sensor_log(spark: SparkSession, folder: str) -> DataFrame:
    """Sensor rows, one per event; the flag is unknown for some."""
    k = F.col("k")
    return events(spark, folder).select(
        F.col("user_id").cast("string").alias("parent_run_id"), F.col("event_type").alias("upstrm_pl"),
        F.col("day").alias("dt"), F.concat(F.lit("rule_"), (k % 3).cast("string")).alias("snsr_rule"),
        F.when(k % 7 != 0, F.col("value") < 100).alias("is_ready"), F.col("ts").alias("result_ts"),
    )


SENSOR_LOG = EVENTS + """,
    sn AS (
        SELECT CAST(user_id AS VARCHAR) AS parent_run_id, event_type AS upstrm_pl, day AS dt,
               'rule_' || CAST(k % 3 AS VARCHAR) AS snsr_rule,
               CASE WHEN k % 7 <> 0 THEN value < 100 END AS is_ready, ts AS result_ts
        FROM ev
    )"""


def labelled_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with their labels, null where there is none."""
    documents = load(spark, folder, "documents").select("doc_id", "lang", "source", "n_chars")
    return documents.join(load(spark, folder, "labels"), "doc_id", "left")


LABELLED = """
    ld AS (
        SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    )"""


def dated_run_log(spark: SparkSession, folder: str) -> DataFrame:
    """Log rows per user and task with the dates they loaded.

    The date list has at most one entry per calendar day.
    """
    days = events(spark, folder).where("value > 1").groupBy("user_id", "event_type", "day").agg(F.max("ts").alias("ts"))
    return days.groupBy("user_id", "event_type").agg(
        F.array_sort(F.collect_list(day_text(F.col("day")))).alias("dt_list"), F.max("ts").alias("job_strt_dttm")
    ).select(
        F.col("user_id").cast("string").alias("parent_run_id"), F.col("event_type").alias("task_nm"),
        "dt_list", "job_strt_dttm",
    )
