"""Comparison queries for the table checks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from veriframe.operators import row_checks as rc
from veriframe.operators import sets
from veriframe.operators.arrival import check_arrivals
from veriframe.operators.distinct import check_constant_by, check_unique, duplicates
from veriframe.operators.registry import check_feature_services, check_feature_views
from veriframe.operators.results import assertion_rows, with_run
from veriframe.operators.verdict import union_all
from veriframe.plans import standins as st
from veriframe.plans.registered import query
from veriframe.plans.suite import run_suite
from veriframe.sources.files import list_entries
from veriframe.sources.tables import (
    list_partitions, load, rows_frame, save_partitioned_table, write_partitioned,
)
from veriframe.sources.workspace import work_dir

START, END = dt.date(2024, 1, 1), dt.date(2024, 1, 31)

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def _status(violations: str) -> str:
    return f"CASE WHEN {violations} = 0 THEN 'pass' ELSE 'fail' END"


@query("check_suite", f"""
    WITH v AS (
        SELECT 'value_range' AS "check", 'l_quantity' AS target,
               count(*) FILTER (l_quantity < 1 OR l_quantity > 50) AS violations FROM lineitem
        UNION ALL
        SELECT 'allowed_values', 'l_returnflag', count(*) FILTER (l_returnflag NOT IN ('A', 'N', 'R')) FROM lineitem
        UNION ALL
        SELECT 'no_null', 'l_orderkey', count(*) FILTER (l_orderkey IS NULL) FROM lineitem
        UNION ALL
        SELECT 'constant', 'l_linestatus', CASE WHEN count(DISTINCT l_linestatus) = 1 THEN 0 ELSE 1 END FROM lineitem
        UNION ALL
        SELECT 'unique', 'l_orderkey,l_linenumber', CAST(sum(n - 1) AS BIGINT)
        FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)
    )
    SELECT "check", target, violations, {_status('violations')} AS status FROM v
""")
def check_suite(spark, folder):
    lineitem = load(spark, folder, "lineitem")
    return run_suite(lineitem, [
        rc.value_range("l_quantity", 1, 50),
        rc.allowed_values("l_returnflag", ["A", "N", "R"]),
        rc.no_null("l_orderkey"),
        rc.constant("l_linestatus"),
        ("unique", lambda df: check_unique(df, ["l_orderkey", "l_linenumber"])),
    ]).select("check", "target", "violations", "status")


@query("assertion_results", """
    SELECT 'value_range' AS assertions, '{"high":"60","low":"0"}' AS log_params, 'Success' AS assertion_result,
           'Lineitem' AS test_area, 'skip' AS workflow_name FROM lineitem HAVING max(l_quantity) <= 60
    UNION ALL
    SELECT 'no_null', '{}', 'Success', 'Lineitem', 'skip' FROM lineitem HAVING count(*) = count(l_orderkey)
    UNION ALL
    SELECT 'row_rule', '{"target":"*"}', 'AssertionError: row_rule of shipped_by_r found ' ||
           CAST(count(*) FILTER (l_returnflag <> 'R') AS VARCHAR) || ' expected 0', 'Lineitem', 'skip' FROM lineitem
    UNION ALL
    SELECT 'unique', '{"columns":"[''l_orderkey'']"}', 'AssertionError: unique of l_orderkey found ' ||
           CAST(count(DISTINCT l_orderkey) AS VARCHAR) || ' distinct', 'Lineitem', 'skip' FROM lineitem
""")
def assertion_results(spark, folder):
    suite = run_suite(load(spark, folder, "lineitem"), [
        rc.value_range("l_quantity", 0, 60), rc.no_null("l_orderkey"),
        rc.row_rule("shipped_by_r", F.col("l_returnflag") == "R"),
        ("unique", lambda df: check_unique(df, "l_orderkey")),
    ])
    return with_run(assertion_rows(suite, "Lineitem"), None).select(
        "test_area", "assertions", "log_params", "assertion_result", "workflow_name"
    )


@query("check_no_null", f"""
    WITH {st.LABELLED}, v AS (
        SELECT lang, 'quality' AS target, count(*) FILTER (quality IS NULL) AS violations FROM ld GROUP BY lang
        UNION ALL SELECT lang, 'toxic', count(*) FILTER (toxic IS NULL) FROM ld GROUP BY lang
        UNION ALL SELECT lang, 'doc_id', count(*) FILTER (doc_id IS NULL) FROM ld GROUP BY lang
    )
    SELECT lang, target, violations, {_status('violations')} AS status FROM v
""")
def check_no_null(spark, folder):
    rows = st.labelled_documents(spark, folder)
    checks = [rc.no_null("quality"), rc.no_null("toxic"), rc.no_null("doc_id")]
    return rc.run_row_checks(rows, checks, ["lang"]).select("lang", "target", "violations", "status")


@query("check_unique", f"""
    WITH {st.LABELLED}, v AS (
        SELECT 'l_orderkey,l_linenumber' AS target, CAST(sum(n - 1) AS BIGINT) AS violations
        FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)
        UNION ALL
        SELECT 'o_orderkey', CAST(sum(n - 1) AS BIGINT) FROM (SELECT count(*) AS n FROM orders GROUP BY o_orderkey)
        UNION ALL
        SELECT 'quality', CAST(sum(n - 1) AS BIGINT) FROM (SELECT count(*) AS n FROM ld GROUP BY quality)
    )
    SELECT target, violations, {_status('violations')} AS status FROM v
""")
def check_unique_query(spark, folder):
    return union_all([
        check_unique(load(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"]),
        check_unique(load(spark, folder, "orders"), "o_orderkey"),
        check_unique(st.labelled_documents(spark, folder), "quality"),
    ]).select("target", "violations", "status")


@query("duplicate_values", """
    SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
    GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
""")
def duplicate_values(spark, folder):
    found = duplicates(load(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])
    return found.withColumnRenamed("row_count", "n")


@query("check_constant", f"""
    WITH {st.LABELLED}, v AS (
        SELECT l_returnflag AS part, 'l_linestatus' AS target, count(DISTINCT l_linestatus) - 1 AS violations
        FROM lineitem GROUP BY l_returnflag
        UNION ALL
        SELECT lang, 'quality', count(DISTINCT coalesce(quality, -1)) - 1 FROM ld GROUP BY lang
        UNION ALL
        SELECT 'all', 'l_returnflag', CASE WHEN count(DISTINCT l_returnflag) = 1 THEN 0 ELSE 1 END FROM lineitem
    )
    SELECT part, target, violations, {_status('violations')} AS status FROM v
""")
def check_constant(spark, folder):
    lineitem = load(spark, folder, "lineitem")
    documents = st.labelled_documents(spark, folder)
    whole = rc.run_row_checks(lineitem, [rc.constant("l_returnflag")]).withColumn("part", F.lit("all"))
    names = ["part", "target", "violations", "status"]
    return union_all([
        check_constant_by(lineitem, "l_linestatus", ["l_returnflag"]).withColumnRenamed("l_returnflag", "part").select(*names),
        check_constant_by(documents, "quality", ["lang"]).withColumnRenamed("lang", "part").select(*names),
        whole.select(*names),
    ])


@query("check_range", f"""
    WITH v AS (
        SELECT l_returnflag, 'l_quantity' AS target,
               count(*) FILTER (l_quantity < 1 OR l_quantity > 50) AS violations FROM lineitem GROUP BY ALL
        UNION ALL
        SELECT l_returnflag, 'l_discount', count(*) FILTER (l_discount < 0 OR l_discount > 0.05)
        FROM lineitem GROUP BY ALL
        UNION ALL
        SELECT l_returnflag, 'shipped',
               count(*) FILTER (l_shipdate < DATE '1996-01-01' OR l_shipdate > DATE '2000-12-31')
        FROM lineitem GROUP BY ALL
    )
    SELECT l_returnflag, target, violations, {_status('violations')} AS status FROM v
""")
def check_range(spark, folder):
    rows = load(spark, folder, "lineitem").select(
        "l_returnflag", "l_quantity", "l_discount", F.to_date("l_shipdate").alias("shipped")
    )
    checks = [
        rc.value_range("l_quantity", 1, 50), rc.value_range("l_discount", 0, 0.05),
        rc.value_range("shipped", dt.date(1996, 1, 1), dt.date(2000, 12, 31)),
    ]
    return rc.run_row_checks(rows, checks, ["l_returnflag"]).select("l_returnflag", "target", "violations", "status")


@query("check_allowed_values", f"""
    WITH {st.LABELLED}, v AS (
        SELECT 'lang' AS target, count(*) FILTER (lang NOT IN ('en', 'de')) AS violations FROM ld
        UNION ALL SELECT 'quality', count(*) FILTER (quality NOT IN (0, 1)) FROM ld
        UNION ALL SELECT 'toxic', count(*) FILTER (toxic IS NULL OR toxic NOT IN (0)) FROM ld
    )
    SELECT target, violations, {_status('violations')} AS status FROM v
""")
def check_allowed_values(spark, folder):
    checks = [
        rc.allowed_values("lang", ["en", "de"]), rc.allowed_values("quality", [0, 1]),
        rc.allowed_values("toxic", [0], exclude_null=False),
    ]
    return rc.run_row_checks(st.labelled_documents(spark, folder), checks).select("target", "violations", "status")


@query("check_values_in_frame", f"""
    WITH v AS (
        SELECT 'l_orderkey' AS target, count(DISTINCT l_orderkey) AS violations, CAST(count(*) AS VARCHAR) AS observed
        FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')
        UNION ALL
        SELECT 'l_suppkey', count(DISTINCT l_suppkey), CAST(count(*) AS VARCHAR)
        FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier)
    )
    SELECT target, violations, observed, {_status('violations')} AS status FROM v
""")
def check_values_in_frame(spark, folder):
    lineitem = load(spark, folder, "lineitem")
    finished = load(spark, folder, "orders").where("o_orderstatus <> 'P'").select("o_orderkey")
    return union_all([
        sets.check_values_in(lineitem, "l_orderkey", finished),
        sets.check_values_in(lineitem, "l_suppkey", load(spark, folder, "supplier").select("s_suppkey")),
    ]).select("target", "violations", "observed", "status")


# Declared types of lineitem; l_tax is declared wrongly and l_comment does not exist.
LINEITEM = {
    "l_orderkey": T.LongType(), "l_partkey": T.LongType(), "l_suppkey": T.LongType(),
    "l_linenumber": T.IntegerType(), "l_quantity": T.DoubleType(), "l_extendedprice": T.DoubleType(),
    "l_discount": T.DoubleType(), "l_tax": T.FloatType(), "l_returnflag": T.StringType(),
    "l_linestatus": T.StringType(), "l_shipdate": T.TimestampNTZType(), "l_comment": T.StringType(),
}


@query("check_schema", """
    WITH s("column", expected_type, actual_type) AS (VALUES
        ('l_orderkey', 'bigint', 'bigint'), ('l_partkey', 'bigint', 'bigint'), ('l_suppkey', 'bigint', 'bigint'),
        ('l_linenumber', 'int', 'int'), ('l_quantity', 'double', 'double'),
        ('l_extendedprice', 'double', 'double'), ('l_discount', 'double', 'double'),
        ('l_tax', 'float', 'double'), ('l_returnflag', 'string', 'string'), ('l_linestatus', 'string', 'string'),
        ('l_shipdate', 'timestamp_ntz', 'timestamp_ntz'), ('l_comment', 'string', NULL))
    SELECT "column", expected_type, actual_type,
           CASE WHEN expected_type = actual_type THEN 'pass' ELSE 'fail' END AS status,
           (SELECT count(*) FROM lineitem) AS covered_rows
    FROM s
""")
def check_schema(spark, folder):
    lineitem = load(spark, folder, "lineitem")
    rows = lineitem.agg(F.count(F.lit(1))).scalar()
    return sets.check_schema(spark, lineitem.schema, LINEITEM).withColumn("covered_rows", rows)


@query("partition_listing", "SELECT DISTINCT CAST(ts AS DATE) AS day FROM events")
def partition_listing(spark, folder):
    return _with_table(spark, folder, lambda table: list_partitions(spark, table, "day"))


@query("check_partitions", """
    WITH d AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events),
         x AS (SELECT CAST(unnest(generate_series(DATE '2024-01-01', DATE '2024-02-02', INTERVAL 1 DAY)) AS DATE) AS day)
    SELECT *, CASE WHEN missing = 0 THEN 'pass' ELSE 'fail' END AS status
    FROM (SELECT (SELECT count(*) FROM x WHERE day NOT IN (SELECT day FROM d)) AS missing,
                 (SELECT count(*) FROM d WHERE day NOT IN (SELECT day FROM x)) AS unexpected)
""")
def check_partitions(spark, folder):
    expected = sets.day_range(spark, START, dt.date(2024, 2, 2))
    return _with_table(spark, folder, lambda table: sets.check_partitions(spark, table, expected, "day"))


def _with_table(spark, folder, use):
    """Events as an external partitioned table while its partitions are listed.

    The listing is a catalog command, so its rows are there before the drop.
    """
    path = work_dir(spark, "events-by-day")
    table = "veriframe_" + path.rsplit("-", 1)[-1]
    rows = st.events(spark, folder).select("event_id", "user_id", "value", "day")
    save_partitioned_table(rows, table, ["day"], path)
    try:
        return use(table)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


@query("partitioned_write_roundtrip", """
    SELECT CAST(ts AS DATE) AS day, count(*) AS n, round(sum(CASE WHEN CAST(ts AS DATE) >= DATE '2024-01-20'
           THEN value * 2 ELSE value END), 4) AS total
    FROM events GROUP BY 1
""")
def partitioned_write_roundtrip(spark, folder):
    rows = st.events(spark, folder).select("event_id", "value", "day")
    path = work_dir(spark, "roundtrip")
    write_partitioned(rows, path, ["day"])
    # The second write replaces its own days only.
    write_partitioned(rows.where("day >= '2024-01-20'").withColumn("value", F.col("value") * 2), path, ["day"])
    return spark.read.schema("event_id bigint, value double, day date").parquet(path).groupBy("day").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total")
    )


@query("check_date_coverage", """
    WITH x AS (SELECT CAST(unnest(generate_series(DATE '2024-01-01', DATE '2024-01-31', INTERVAL 1 DAY)) AS DATE) AS day),
         g AS (SELECT day FROM x WHERE day NOT IN (SELECT CAST(ts AS DATE) FROM events))
    SELECT 'ts' AS target, count(*) AS violations, CAST(min(day) AS VARCHAR) AS observed,
           CASE WHEN count(*) = 0 THEN 'pass' ELSE 'fail' END AS status FROM g
""")
def check_date_coverage(spark, folder):
    return sets.check_date_coverage(load(spark, folder, "events"), "ts", START, END).select(
        "target", "violations", "observed", "status"
    )


@query("date_gaps_by_user", """
    WITH x AS (SELECT CAST(unnest(generate_series(DATE '2024-01-01', DATE '2024-01-31', INTERVAL 1 DAY)) AS DATE) AS day),
         u AS (SELECT DISTINCT user_id FROM events),
         e AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events),
         miss AS (SELECT u.user_id, x.day FROM u, x
                  WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.user_id = u.user_id AND e.day = x.day)),
         isl AS (SELECT user_id, day,
                        day - CAST(row_number() OVER (PARTITION BY user_id ORDER BY day) AS INTEGER) AS island FROM miss)
    SELECT user_id, min(day) AS gap_start, max(day) AS gap_end, count(*) AS days FROM isl GROUP BY user_id, island
""")
def date_gaps_by_user(spark, folder):
    return sets.date_gaps(load(spark, folder, "events"), "ts", ["user_id"], START, END)


EDITED = "CASE WHEN l_returnflag = 'R' AND l_quantity = 50 THEN 0 ELSE l_tax END"


@query("check_equality", f"""
    WITH a AS (SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag, l_tax FROM lineitem),
         b AS (SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag, {EDITED} AS l_tax FROM lineitem),
         v AS (SELECT (SELECT count(*) FROM (FROM a EXCEPT ALL FROM b)) AS lost,
                      (SELECT count(*) FROM (FROM b EXCEPT ALL FROM a)) AS added)
    SELECT 'edited' AS pair, lost + added AS violations,
           CAST(lost AS VARCHAR) || ' only left, ' || CAST(added AS VARCHAR) || ' only right' AS observed,
           {_status('lost + added')} AS status FROM v
    UNION ALL
    SELECT 'same', 0, '0 only left, 0 only right', 'pass'
""")
def check_equality(spark, folder):
    names = ["l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_tax"]
    left = load(spark, folder, "lineitem").select(*names)
    right = left.withColumn("l_tax", F.expr(EDITED).cast("double"))
    pairs = {"edited": sets.check_equality(left, right), "same": sets.check_equality(left, left)}
    return union_all([
        v.select(F.lit(name).alias("pair"), "violations", "observed", "status") for name, v in pairs.items()
    ])


@query("reconcile_diff", """
    WITH a AS (SELECT o_custkey, o_orderstatus, CAST(o_orderdate AS DATE) AS day FROM orders),
         b AS (SELECT o_custkey, o_orderstatus, CAST(o_orderdate AS DATE) AS day FROM orders
               WHERE o_orderpriority <> '5-LOW'
               UNION ALL
               SELECT o_custkey, o_orderstatus, CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_totalprice > 400000),
         l AS (SELECT *, count(*) AS n FROM a GROUP BY ALL),
         r AS (SELECT *, count(*) AS n FROM b GROUP BY ALL)
    SELECT coalesce(l.o_custkey, r.o_custkey) AS o_custkey, coalesce(l.o_orderstatus, r.o_orderstatus) AS o_orderstatus,
           coalesce(l.day, r.day) AS day, coalesce(l.n, 0) AS left_rows, coalesce(r.n, 0) AS right_rows
    FROM l FULL JOIN r ON l.o_custkey = r.o_custkey AND l.o_orderstatus = r.o_orderstatus AND l.day = r.day
    WHERE coalesce(l.n, 0) <> coalesce(r.n, 0)
""")
def reconcile_diff(spark, folder):
    orders = load(spark, folder, "orders").withColumn("day", F.to_date("o_orderdate"))
    copy = orders.where("o_orderpriority <> '5-LOW'").unionByName(orders.where("o_totalprice > 400000"))
    return sets.reconcile(orders, copy, ["o_custkey", "o_orderstatus", "day"])


@query("filter_membership", """
    SELECT o_orderkey, o_custkey FROM orders
    WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
""")
def filter_membership(spark, folder):
    building = load(spark, folder, "customer").where("c_mktsegment = 'BUILDING'").select("c_custkey")
    return sets.membership(load(spark, folder, "orders"), "o_custkey", building).select("o_orderkey", "o_custkey")


REGISTRY = """
    registry AS (
        SELECT DISTINCT p_brand AS "view", p_name AS "column" FROM part
        UNION SELECT DISTINCT p_brand, 'p_partkey' FROM part
    )"""


@query("check_feature_view", f"""
    WITH {REGISTRY},
         present AS (SELECT DISTINCT p_brand AS "view", p_name AS "column" FROM part
                     WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 40)
                     UNION SELECT DISTINCT p_brand, 'p_partkey' FROM part WHERE p_size < 50),
         j AS (SELECT coalesce(r."view", p."view") AS "view", r."column" IS NOT NULL AS wanted,
                      p."column" IS NOT NULL AS found
               FROM registry r FULL JOIN present p ON r."view" = p."view" AND r."column" = p."column")
    SELECT "view", count(*) FILTER (NOT found) AS missing, count(*) FILTER (NOT wanted) AS unexpected,
           {_status("count(*) FILTER (found <> wanted)")} AS status
    FROM j GROUP BY "view"
""")
def check_feature_view(spark, folder):
    part, registry = _registry(spark, folder)
    sold = load(spark, folder, "lineitem").where("l_quantity > 40").select(F.col("l_partkey").alias("p_partkey"))
    columns = part.join(sold.distinct(), "p_partkey", "left_semi").select(
        F.col("p_brand").alias("view"), F.col("p_name").alias("column")
    ).unionByName(part.where("p_size < 50").select(F.col("p_brand").alias("view"), F.lit("p_partkey").alias("column")))
    return check_feature_views(registry, columns)


@query("check_feature_service", f"""
    WITH {REGISTRY},
         wanted AS (SELECT DISTINCT p_type AS service, "column" FROM part JOIN registry ON "view" = p_brand),
         present AS (SELECT DISTINCT p_type AS service, p_name AS "column" FROM part
                     UNION SELECT DISTINCT p_type, 'p_type' FROM part),
         j AS (SELECT coalesce(w.service, p.service) AS service, w."column" IS NOT NULL AS wanted,
                      p."column" IS NOT NULL AS found
               FROM wanted w FULL JOIN present p ON w.service = p.service AND w."column" = p."column")
    SELECT service, count(*) FILTER (NOT found) AS missing, count(*) FILTER (NOT wanted) AS unexpected,
           {_status("count(*) FILTER (found <> wanted)")} AS status
    FROM j GROUP BY service
""")
def check_feature_service(spark, folder):
    part, registry = _registry(spark, folder)
    services = part.select(F.col("p_type").alias("service"), F.col("p_brand").alias("view")).distinct()
    service = F.col("p_type").alias("service")
    columns = part.select(service, F.col("p_name").alias("column")).unionByName(
        part.select(service, F.lit("p_type").alias("column"))
    )
    return check_feature_services(registry, services, columns)


def _registry(spark, folder):
    part = load(spark, folder, "part")
    view = F.col("p_brand").alias("view")
    registry = part.select(view, F.col("p_name").alias("column"), F.lit("feature").alias("role")).unionByName(
        part.select(view, F.lit("p_partkey").alias("column"), F.lit("entity").alias("role"))
    )
    return part, registry


@query("file_listing", " UNION ALL ".join(
    f"SELECT '{t}.parquet' AS name, count(*) > 0 AS filled FROM {t}" for t in TABLES
))
def file_listing(spark, folder):
    return list_entries(spark, folder, "*.parquet").select("name", (F.col("bytes") > 0).alias("filled"))


@query("check_file_arrival", " UNION ALL ".join(
    f"SELECT '{t}.parquet' AS name, CAST(count(*) > 0 AS BIGINT) AS arrived, 'pass' AS status FROM {t}" for t in TABLES
) + " UNION ALL SELECT 'returns.parquet', 0, 'fail'")
def check_file_arrival(spark, folder):
    expected = rows_frame(spark, [(f"{t}.parquet",) for t in [*TABLES, "returns"]], "name string")
    return check_arrivals(list_entries(spark, folder, "*.parquet"), expected)
