"""Comparison queries for audits, the transform, its views, generated tables and streams."""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import functions as F

from veriframe.operators import audit
from veriframe.operators.sets import check_date_coverage
from veriframe.operators.profile import metric
from veriframe.operators.transform import DAY, LOADED, SUM_COLUMN, create_views, daily_sum
from veriframe.operators.verdict import union_all
from veriframe.plans import standins as st
from veriframe.plans.registered import query
from veriframe.sources import generator as gen
from veriframe.sources.publish import loaded_days, write_registered
from veriframe.sources.tables import load
from veriframe.sources.workspace import work_dir
from veriframe.streaming.daily_sum import read_days, read_output, run_daily_sum
from veriframe.streaming.partials import read_stream
from veriframe.streaming.metrics import read_metrics, run_metrics
from veriframe.streaming.profile import read_profile, run_profile
from veriframe.streaming.sensor import read_sensor, run_sensor

FIRST_LOAD, SECOND_LOAD = "2024-02-01 06:00:00", "2024-02-02 06:00:00"


def _loaded(moment):
    return F.lit(moment).cast("timestamp_ntz")


ORDER_RULES = [
    audit.Rule("price", "o_totalprice BETWEEN 1000 AND 480000"),
    audit.Rule("priority", "o_orderpriority RLIKE '^[1-4]-[A-Z]'"),
    audit.Rule("status", "length(o_orderstatus) = 1 AND o_orderstatus IN ('F', 'O', 'P')"),
]


@query("audit_rules", """
    WITH o AS (SELECT CAST(o_orderdate AS DATE) AS day, o_totalprice BETWEEN 1000 AND 480000 AS price,
                      regexp_matches(o_orderpriority, '^[1-4]-[A-Z]') AS priority,
                      length(o_orderstatus) = 1 AND o_orderstatus IN ('F', 'O', 'P') AS status FROM orders),
         v AS (SELECT day, 'price' AS rule, count(*) FILTER (NOT price) AS violations FROM o GROUP BY day
               UNION ALL SELECT day, 'priority', count(*) FILTER (NOT priority) FROM o GROUP BY day
               UNION ALL SELECT day, 'status', count(*) FILTER (NOT status) FROM o GROUP BY day)
    SELECT day, rule, violations, CASE WHEN violations = 0 THEN 'pass' ELSE 'fail' END AS status FROM v
""")
def audit_rules(spark, folder):
    orders = load(spark, folder, "orders").withColumn("day", F.to_date("o_orderdate"))
    return audit.audit(orders, ORDER_RULES, ["day"])


@query("audit_warnings", """
    SELECT 'priority' AS rule, count(*) FILTER (NOT regexp_matches(o_orderpriority, '^[1-4]-[A-Z]')) AS violations,
           'fail' AS status FROM orders
    UNION ALL SELECT 'status', 0, 'pass'
    UNION ALL SELECT 'unknown_field', NULL, 'warning'
    UNION ALL SELECT 'not_boolean', NULL, 'warning'
""")
def audit_warnings(spark, folder):
    orders = load(spark, folder, "orders")
    rules = [
        *ORDER_RULES[1:], audit.Rule("unknown_field", "o_payload.val > 1"),
        audit.Rule("not_boolean", "length(o_orderstatus)"),
    ]
    usable, warnings = audit.resolve(orders, rules)
    raised = spark.createDataFrame([(name,) for name, _ in warnings], "rule string").select(
        "rule", F.lit(None).cast("bigint").alias("violations"), F.lit("warning").alias("status")
    )
    return audit.audit(orders, usable).unionByName(raised)


@query("audit_gate", f"""
    WITH {st.TRANSACTIONS}, o AS (SELECT uc_id, dl_data_dt, sum(transactions) AS s FROM tx GROUP BY ALL),
         d AS (SELECT list_sort(list_distinct(list(strftime(dl_data_dt, '%Y-%m-%d')))) AS days FROM o),
         t AS (SELECT '[''' || array_to_string(days, ''', ''') || ''']' AS dt_list_text FROM d)
    SELECT 'clean' AS output, 'SUCCESS' AS job_sts, NULL AS err_msg, count(*) AS "rows", 0 AS violations,
           (SELECT dt_list_text FROM t) AS dt_list_text, count(*) AS published FROM o
    UNION ALL
    SELECT 'broken', 'FAILED', 'DeequAuditError: ' || CAST(count(*) AS VARCHAR) || ' rule violations', count(*), count(*),
           (SELECT dt_list_text FROM t), 0 FROM o
    UNION ALL
    SELECT 'unanswered', 'FAILED', 'DeequAuditError: 0 rule violations, not answered: gone, text', count(*), 0,
           (SELECT dt_list_text FROM t), 0 FROM o
""")
def audit_gate(spark, folder):
    rules = [audit.id_rule(), audit.Rule("not_negative", f"{SUM_COLUMN} >= 0")]
    outcomes = []
    unanswered = [audit.Rule("gone", "no_such_column > 0"), audit.Rule("text", "uc_id")]
    for name, prefix, rules in (("clean", gen.GOOD_PREFIX, rules), ("broken", gen.BAD_PREFIX, rules), ("unanswered", gen.GOOD_PREFIX, unanswered)):
        output = daily_sum(st.transactions(spark, folder, prefix), _loaded(FIRST_LOAD))
        path = work_dir(spark, f"output-{name}")
        record = audit.audited_write(output, rules, path, "daily_sum")
        rows = audit.published(spark, path, output.schema).agg(F.count(F.lit(1))).scalar()
        outcomes.append(record.select(
            F.lit(name).alias("output"), "job_sts", "err_msg", "rows", "violations", "dt_list_text",
            rows.alias("published"),
        ))
    return union_all(outcomes)


@query("daily_sum", f"""
    WITH {st.TRANSACTIONS}
    SELECT uc_id, CAST(sum(transactions) AS INTEGER) AS {SUM_COLUMN}, dl_data_dt, TIMESTAMP '2024-02-01 06:00:00' AS dl_load_ts
    FROM tx GROUP BY uc_id, dl_data_dt
""")
def daily_sum_query(spark, folder):
    return daily_sum(st.transactions(spark, folder), _loaded(FIRST_LOAD))


OUTPUT = st.TRANSACTIONS + f""",
    output AS (
        SELECT uc_id, CAST(sum(transactions) AS INTEGER) AS {SUM_COLUMN}, dl_data_dt,
               TIMESTAMP '2024-02-01 06:00:00' AS dl_load_ts FROM tx GROUP BY uc_id, dl_data_dt
        UNION ALL
        SELECT uc_id, CAST(sum(transactions * 2) AS INTEGER), dl_data_dt, TIMESTAMP '2024-02-02 06:00:00'
        FROM tx WHERE dl_data_dt >= DATE '2024-01-20' GROUP BY uc_id, dl_data_dt
    ),
    month_days AS (SELECT max(dl_data_dt) AS dl_data_dt FROM output GROUP BY date_trunc('month', dl_data_dt)),
    business AS (
        SELECT uc_id AS customer_id, dl_data_dt, {SUM_COLUMN} AS daily_transactions FROM output
        QUALIFY row_number() OVER (PARTITION BY uc_id, dl_data_dt ORDER BY dl_load_ts DESC) = 1
    )"""


def _view(spark, folder, kind):
    """One of the four views over an output with two loads."""
    source = st.transactions(spark, folder)
    again = source.where("dl_data_dt >= '2024-01-20'").withColumn("transactions", F.col("transactions") * 2)
    path = work_dir(spark, "view-output")
    write_registered(daily_sum(source, _loaded(FIRST_LOAD)).unionByName(daily_sum(again, _loaded(SECOND_LOAD))), path, [DAY])
    table = "output_" + path.rsplit("-", 1)[-1]
    schema = f"uc_id string, {SUM_COLUMN} int, {LOADED} timestamp_ntz, {DAY} date"
    spark.read.schema(schema).parquet(path).createOrReplaceTempView(table)
    loaded_days(spark, path).createOrReplaceTempView(f"{table}_days")
    return spark.table(create_views(spark, table, temporary=True, days=f"{table}_days")[kind])


@query("view_technical", f"WITH {OUTPUT} SELECT * FROM output")
def view_technical(spark, folder):
    return _view(spark, folder, "technical")


@query("view_technical_monthly", f"WITH {OUTPUT} SELECT * FROM output WHERE dl_data_dt IN (SELECT dl_data_dt FROM month_days)")
def view_technical_monthly(spark, folder):
    return _view(spark, folder, "technical_monthly")


@query("view_business", f"WITH {OUTPUT} SELECT * FROM business")
def view_business(spark, folder):
    return _view(spark, folder, "business")


@query("view_business_monthly", f"WITH {OUTPUT} SELECT * FROM business WHERE dl_data_dt IN (SELECT dl_data_dt FROM month_days)")
def view_business_monthly(spark, folder):
    return _view(spark, folder, "business_monthly")


LOAD_DATE = dt.date(2023, 8, 31)


def _ids(spark, folder, table, key):
    return load(spark, folder, table).select(F.col(key).alias("id"))


def _generated_sql(prefix, low, transactions, distinct=""):
    main = "o_orderkey" + (f" % {distinct}" if distinct else "")
    end = "c_custkey" + (f" % {distinct}" if distinct else "")
    return f"""
        SELECT '{prefix}' || CAST({low} + {main} AS VARCHAR) AS uc_id, {transactions} AS transactions,
               CAST(DATE '2023-08-28' + CAST(o_orderkey % 4 AS INTEGER) AS DATE) AS dl_data_dt FROM orders
        UNION ALL
        SELECT '{prefix}' || CAST({low} + {end} AS VARCHAR), {transactions}, DATE '2023-07-31' FROM customer"""


def _generated(spark, folder, spec):
    return gen.source_rows(
        _ids(spark, folder, "orders", "o_orderkey"), _ids(spark, folder, "customer", "c_custkey"), LOAD_DATE, spec
    )


@query("gen_source_table", _generated_sql("11", 10 ** 9, 1))
def gen_source_table(spark, folder):
    return _generated(spark, folder, gen.success_spec())


@query("gen_audit_failure", _generated_sql("07", 10 ** 5, 1))
def gen_audit_failure(spark, folder):
    return _generated(spark, folder, gen.audit_failure_spec())


@query("gen_duplicates", _generated_sql("11", 10 ** 9, 5, "10"))
def gen_duplicates(spark, folder):
    return _generated(spark, folder, gen.anomaly_failure_spec(100))


@query("gen_weighted", """
    WITH a AS (SELECT o_orderkey AS id, (o_orderkey + 1) % 2147483647 * 48271 % 2147483647 AS f FROM orders),
         h AS (SELECT id, f * (f % 65521 + 1) % 2147483647 AS h FROM a)
    SELECT '11' || CAST(1000000000 + id AS VARCHAR) AS uc_id, CAST(1000000000 + id AS VARCHAR) AS cust_key,
           CASE WHEN h % 10 < 4 THEN 'A' ELSE 'B' END AS line_key, 1 AS transactions,
           CAST(DATE '2023-08-28' + CAST(id % 4 AS INTEGER) AS DATE) AS dl_data_dt FROM h
""")
def gen_weighted(spark, folder):
    ids = _ids(spark, folder, "orders", "o_orderkey")
    return gen.slice_rows(ids, gen.success_spec(wide=True), gen.window_start(LOAD_DATE), gen.WINDOW_DAYS)


def _event_stream(spark, folder):
    return read_stream(spark, folder, "events").select("user_id", "event_type", "value", "props", F.to_date("ts").alias("day"))


#: Batches of the piecewise stream, and rows of one of its files, about: a task reads whole files, so what it holds doesn't grow with the table.
BATCHES, FILE_ROWS = 3, 50_000


def _piecewise(spark, folder):
    """The event stream in several batches that each hold rows of most days, in files of bounded size."""
    path, events = work_dir(spark, "pieces"), load(spark, folder, "events")
    files = max(1, math.ceil(events.count() / (BATCHES * FILE_ROWS)))
    events.repartition(BATCHES * files, "event_id").write.parquet(f"{path}/events.parquet")
    return read_stream(spark, path, "events", files_per_batch=files).select("user_id", "event_type", "value", "props", F.to_date("ts").alias("day"))


DAILY_STREAM = f"""
    WITH {st.TRANSACTIONS}, o AS (SELECT uc_id, dl_data_dt, CAST(sum(transactions) AS INTEGER) AS s FROM tx GROUP BY ALL)
    SELECT o.uc_id, o.s AS class_source_product_sum_transactions_val_dly_v1,
           o.s + coalesce(p.s, 0) AS class_source_product_added_transactions_val_dly_v1, o.dl_data_dt
    FROM o LEFT JOIN o p ON p.uc_id = o.uc_id AND p.dl_data_dt = o.dl_data_dt - 1
"""


@query("stream_daily_sum", DAILY_STREAM)
def stream_daily_sum(spark, folder):
    return _daily_stream(spark, _event_stream(spark, folder)).drop(LOADED)


@query("stream_daily_sum_batches", DAILY_STREAM)
def stream_daily_sum_batches(spark, folder):
    return _daily_stream(spark, _piecewise(spark, folder)).drop(LOADED)


@query("stream_date_coverage", """
    WITH x AS (SELECT CAST(unnest(generate_series(DATE '2024-01-01', DATE '2024-01-31', INTERVAL 1 DAY)) AS DATE) AS day),
         g AS (SELECT day FROM x WHERE day NOT IN (SELECT CAST(ts AS DATE) FROM events))
    SELECT 'dl_data_dt' AS target, count(*) AS violations, CAST(min(day) AS VARCHAR) AS observed,
           CASE WHEN count(*) = 0 THEN 'pass' ELSE 'fail' END AS status FROM g
""")
def stream_date_coverage(spark, folder):
    """Coverage of the sink, from the days that the stream has registered."""
    path = _run_daily_stream(spark, _piecewise(spark, folder))
    return check_date_coverage(read_days(spark, path), DAY, dt.date(2024, 1, 1), dt.date(2024, 1, 31)).select("target", "violations", "observed", "status")


def _run_daily_stream(spark, events):
    source = events.select(
        F.concat(F.lit("11"), (F.lit(10 ** 9) + F.col("user_id")).cast("string")).alias("uc_id"),
        F.get_json_object("props", "$.k").try_cast("int").alias("transactions"), F.col("day").alias(DAY),
    )
    path = work_dir(spark, "stream-daily-sum")
    run_daily_sum(source, path, f"{path}/checkpoint")
    return path


def _daily_stream(spark, events):
    return read_output(spark, _run_daily_stream(spark, events))


@query("stream_profile", f"""
    WITH {st.EVENTS}
    SELECT day, 'value' AS instance, name, round(value, 6) AS value FROM (
        UNPIVOT (SELECT day, count(*)::DOUBLE AS "Size", count(value) / count(*) AS "Completeness", avg(value) AS "Mean",
                        sum(value) AS "Sum", stddev_pop(value) AS "StandardDeviation", min(value) AS "Minimum",
                        max(value) AS "Maximum" FROM ev GROUP BY day)
        ON "Size", "Completeness", "Mean", "Sum", "StandardDeviation", "Minimum", "Maximum" INTO NAME name VALUE value)
""")
def stream_profile(spark, folder):
    path = work_dir(spark, "stream-profile")
    run_profile(_event_stream(spark, folder), "value", "day", path, f"{path}/checkpoint")
    return read_profile(spark, path).withColumn("value", F.round("value", 6))


STREAMED = [
    metric("Size"), metric("Mean", "value"), metric("StandardDeviation", "value"), metric("Completeness", "value"),
    metric("Correlation", "value", "user_id"), metric("CountDistinct", "user_id"), metric("Uniqueness", "user_id"), metric("Distinctness", "user_id"),
    metric("UniqueValueRatio", "user_id", "event_type"), metric("Histogram", "event_type"), metric("MutualInformation", "user_id", "event_type"),
    metric("ApproxQuantiles-0.25", "value"), metric("ApproxQuantiles-0.75", "value"),
]


@query("stream_profile_metrics", f"""
    WITH {st.EVENTS},
    d AS (SELECT day, count(*)::DOUBLE AS n, avg(value) AS mean, stddev_pop(value) AS sd, count(value) / count(*) AS filled, corr(value, user_id) AS r,
                 quantile_disc(value, 0.25) AS q1, quantile_disc(value, 0.75) AS q3 FROM ev GROUP BY day),
    u AS (SELECT day, user_id, count(*) AS c FROM ev GROUP BY ALL), ud AS (SELECT day, count(*)::DOUBLE AS v, count(*) FILTER (c = 1) AS one, sum(c) AS n FROM u GROUP BY day),
    p AS (SELECT day, user_id, event_type, count(*) AS c FROM ev GROUP BY ALL), pd AS (SELECT day, count(*) FILTER (c = 1) / count(*) AS ratio FROM p GROUP BY day),
    t AS (SELECT day, event_type, count(*) AS c FROM ev GROUP BY ALL),
    mi AS (SELECT p.day, sum(p.c / d.n * ln(p.c * d.n / (u.c * t.c))) AS value
           FROM p JOIN u USING (day, user_id) JOIN t USING (day, event_type) JOIN d USING (day) GROUP BY p.day)
    SELECT day, entity, instance, name, round(value, 6) AS value FROM (
        SELECT day, 'Dataset' AS entity, '*' AS instance, 'Size' AS name, n AS value FROM d
        UNION ALL SELECT day, 'Column', 'value', unnest(['Mean', 'StandardDeviation', 'Completeness', 'ApproxQuantiles-0.25', 'ApproxQuantiles-0.75']),
                         unnest([mean, sd, filled, q1, q3]) FROM d
        UNION ALL SELECT day, 'Multicolumn', 'value,user_id', 'Correlation', r FROM d
        UNION ALL SELECT day, 'Column', 'user_id', unnest(['CountDistinct', 'Uniqueness', 'Distinctness']), unnest([v, one / n, v / n]) FROM ud
        UNION ALL SELECT day, 'Multicolumn', 'user_id,event_type', 'UniqueValueRatio', ratio FROM pd
        UNION ALL SELECT day, 'Multicolumn', 'user_id,event_type', 'MutualInformation', value FROM mi
        UNION ALL SELECT day, 'Column', 'event_type', 'Histogram.bins', count(*) FROM t GROUP BY day
        UNION ALL SELECT day, 'Column', 'event_type', 'Histogram.abs.' || event_type, c FROM t
        UNION ALL SELECT day, 'Column', 'event_type', 'Histogram.ratio.' || event_type, c / n FROM t JOIN d USING (day))
""")
def stream_profile_metrics(spark, folder):
    """All kinds of metrics from the states of several batches."""
    path = work_dir(spark, "stream-metrics")
    run_metrics(_piecewise(spark, folder), STREAMED, "day", path, f"{path}/checkpoint")
    return read_metrics(spark, path, STREAMED).withColumn("value", F.round("value", 6))


@query("stream_sensor", f"""
    WITH {st.EVENTS},
         dm AS (SELECT day, name, value FROM (
             UNPIVOT (SELECT day, min(value) AS "Minimum", max(value) AS "Maximum" FROM ev GROUP BY day)
             ON "Minimum", "Maximum" INTO NAME name VALUE value)),
         lb AS (SELECT day, name, value, 'daily_d3' AS upstrm_pl,
                       avg(value) OVER (PARTITION BY name ORDER BY day RANGE BETWEEN INTERVAL 3 DAYS PRECEDING AND INTERVAL 1 DAY PRECEDING) AS reference
                FROM dm
                UNION ALL
                SELECT a.day, a.name, a.value, 'daily_m1', b.value
                FROM dm a LEFT JOIN dm b ON a.name = b.name AND b.day = CAST(date_trunc('month', a.day) AS DATE) - 1)
    SELECT '7' AS parent_run_id, upstrm_pl, day AS dt,
           'AnomalyConstraint(Mean(value,Some(name=''' || name || ''' and instance=''value'')))' AS snsr_rule,
           abs(value - reference) <= 0.5 * abs(reference) AS is_ready FROM lb
""")
def stream_sensor(spark, folder):
    path = work_dir(spark, "stream-sensor")
    run_sensor(_event_stream(spark, folder), "value", "day", path, f"{path}/checkpoint", "7", "daily")
    return read_sensor(spark, path)


@query("stream_sensor_daily", f"""
    WITH {st.EVENTS},
         dm AS (SELECT day, name, value FROM (
             UNPIVOT (SELECT day, min(value) AS "Minimum", max(value) AS "Maximum" FROM ev GROUP BY day)
             ON "Minimum", "Maximum" INTO NAME name VALUE value))
    SELECT '7' AS parent_run_id, 'daily_d1' AS upstrm_pl, a.day AS dt,
           'AnomalyConstraint(Mean(value,Some(name=''' || a.name || ''' and instance=''value'')))' AS snsr_rule,
           abs(a.value - b.value) <= 0.5 * abs(b.value) AS is_ready
    FROM dm a LEFT JOIN dm b ON a.name = b.name AND b.day = a.day - 1
""")
def stream_sensor_daily(spark, folder):
    path = work_dir(spark, "stream-sensor-daily")
    run_sensor(_piecewise(spark, folder), "value", "day", path, f"{path}/checkpoint", "7", "daily", lookback=1, month_end=False)
    return read_sensor(spark, path)
