"""Comparison queries for written files, catalog tables and saved results."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from veriframe.operators import row_checks as rc
from veriframe.operators import sets
from veriframe.operators.arrival import check_file_absent, check_file_present, check_table_absent
from veriframe.operators.distinct import check_unique
from veriframe.operators.results import append_results, assertion_rows, with_run
from veriframe.operators.verdict import union_all
from veriframe.plans import standins as st
from veriframe.plans.registered import query
from veriframe.plans.suite import run_suite
from veriframe.sources.files import list_files
from veriframe.sources.tables import create_database, drop_database, drop_table, load, save_partitioned_table, write_partitioned
from veriframe.sources.workspace import work_dir


def _by_day(spark, folder):
    """Events written into one folder a day."""
    path = work_dir(spark, "landing")
    write_partitioned(st.events(spark, folder).select("event_id", "user_id", "day"), path, ["day"])
    return path


@query("file_rows", """
    SELECT 'day=' || CAST(CAST(ts AS DATE) AS VARCHAR) AS name, count(*) AS "rows", 0 AS unlisted, 0 AS unread FROM events GROUP BY ALL
""")
def file_rows(spark, folder):
    """The listing of a folder against the files that its rows come from."""
    path = _by_day(spark, folder)
    below = "([^/]+)/([^/]+)$"

    def named(column):
        return [F.regexp_extract(column, below, n).alias(alias) for n, alias in ((1, "name"), (2, "file"))]

    read = spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count(F.lit(1)).alias("held"))
    listed = list_files(spark, path, recursive=True).select(*named("path"), F.lit(True).alias("there"))
    both = read.select(*named("path"), "held").join(listed, ["name", "file"], "full")
    return both.groupBy("name").agg(
        F.sum("held").alias("rows"), F.count_if(F.col("there").isNull()).cast("int").alias("unlisted"),
        F.count_if(F.col("held").isNull()).cast("int").alias("unread"),
    )


@query("check_file_landing", """
    SELECT 'several' AS "case", 'fail' AS status, CAST(count(DISTINCT CAST(ts AS DATE)) AS VARCHAR) AS observed FROM events
    UNION ALL SELECT 'expected', 'pass', CAST(count(DISTINCT CAST(ts AS DATE)) AS VARCHAR) FROM events
    UNION ALL SELECT 'missing', 'error', 'missing path' UNION ALL SELECT 'gone', 'pass', 'gone'
    UNION ALL SELECT 'still there', 'fail', 'exists' UNION ALL SELECT 'one', 'pass', '1'
""")
def check_file_landing(spark, folder):
    path, nowhere, single = _by_day(spark, folder), work_dir(spark, "nowhere"), work_dir(spark, "single")
    load(spark, folder, "orders").write.parquet(f"{single}/orders.parquet")
    days = st.events(spark, folder).select("day").distinct().count()
    cases = {
        "several": check_file_present(spark, path), "expected": check_file_present(spark, path, expected=days),
        "missing": check_file_present(spark, nowhere), "one": check_file_present(spark, single),
        "gone": check_file_absent(spark, nowhere), "still there": check_file_absent(spark, path),
    }
    return union_all([v.select(F.lit(name).alias("case"), "status", "observed") for name, v in cases.items()])


@query("table_lifecycle", """
    SELECT 'before' AS step, 'pass' AS status, 'absent' AS observed UNION ALL SELECT 'saved', 'fail', 'exists'
    UNION ALL SELECT 'dropped', 'pass', 'absent'
    UNION ALL SELECT 'files stay', 'pass', CAST(count(*) AS VARCHAR) FROM events
""")
def table_lifecycle(spark, folder):
    path = work_dir(spark, "lifecycle")
    database = "veriframe_" + path.rsplit("-", 1)[-1]
    name = f"{database}.events_by_day"
    create_database(spark, database)
    try:
        steps = {"before": check_table_absent(spark, name)}
        save_partitioned_table(st.events(spark, folder).select("event_id", "user_id", "day"), name, ["day"], path)
        steps["saved"] = check_table_absent(spark, name)
        drop_table(spark, database, "events_by_day")
        steps["dropped"] = check_table_absent(spark, name)
    finally:
        drop_table(spark, database, "events_by_day")
        drop_database(spark, database)
    rows = spark.read.parquet(path).agg(F.lit("files stay").alias("step"), F.lit("pass").alias("status"), F.count(F.lit(1)).cast("string").alias("observed"))
    return union_all([v.select(F.lit(step).alias("step"), "status", "observed") for step, v in steps.items()]).unionByName(rows)


EVENTS_BY_DAY = {"event_id": T.LongType(), "user_id": T.StringType(), "day": T.DateType(), "props": T.StringType()}


@query("check_table_schema", """
    SELECT * FROM (VALUES ('event_id', 'bigint', 'bigint', 'pass'), ('user_id', 'string', 'bigint', 'fail'),
        ('day', 'date', 'date', 'pass'), ('props', 'string', NULL, 'fail')) v("column", expected_type, actual_type, status)
    WHERE EXISTS (SELECT 1 FROM events)
""")
def check_table_schema(spark, folder):
    return sets.check_schema(spark, spark.read.parquet(_by_day(spark, folder)).schema, EVENTS_BY_DAY)


@query("assertion_results_saved", """
    WITH w AS (SELECT DISTINCT 'job ' || CAST(event_id // 5 % 10 AS VARCHAR) AS workflow_name FROM events WHERE event_id // 5 = 1
               UNION ALL SELECT 'skip'),
         a AS (SELECT 'value_range' AS assertions, max(l_quantity) <= 60 AS success, false AS names_column FROM lineitem
               UNION ALL SELECT 'no_null', false, true UNION ALL SELECT 'unique', false, true)
    SELECT workflow_name, 'Lineitem' AS test_area, assertions, success, names_column FROM w CROSS JOIN a
""")
def assertion_results_saved(spark, folder):
    """Results of a run and of no run in one table; two checks name columns that are not there."""
    suite = run_suite(load(spark, folder, "lineitem"), [
        rc.value_range("l_quantity", 0, 60), rc.no_null("no_such_column"),
        ("unique", lambda df: check_unique(df, "no_such_column")),
    ])
    run = st.runs(st.task_runs(spark, folder)).where("run_id = 1")
    path = work_dir(spark, "results")
    for of in (run, None):
        append_results(with_run(assertion_rows(suite, "Lineitem"), of), path)
    result = F.col("assertion_result")
    return spark.read.parquet(path).select(
        "workflow_name", "test_area", "assertions", (result == "Success").alias("success"), result.contains("no_such_column").alias("names_column"))
