"""Comparison queries for profile metrics and the metrics repository."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from veriframe.functions.text import list_text
from veriframe.functions.time import day_text
from veriframe.operators.metrics import check_metric_date_list, check_metric_dates, check_profile_metrics, check_repository
from veriframe.operators.profile import histogram_counts, metric, profile
from veriframe.operators.sets import day_range
from veriframe.operators.verdict import union_all
from veriframe.plans import standins as st
from veriframe.plans.registered import query
from veriframe.sources.metrics import fold_metrics, read_documents, read_metrics, write_metrics
from veriframe.sources.tables import load
from veriframe.sources.workspace import work_dir


def _rounded(metrics, digits=6):
    return metrics.withColumn("value", F.round("value", digits))


@query("profile_size", " UNION ALL ".join(
    f"SELECT '{t}' AS target, 'Dataset' AS entity, '*' AS instance, 'Size' AS name, CAST(count(*) AS DOUBLE) AS value FROM {t}"
    for t in ("orders", "lineitem", "events", "documents")
))
def profile_size(spark, folder):
    return union_all([
        profile(load(spark, folder, t), [metric("Size")]).withColumn("target", F.lit(t))
        for t in ("orders", "lineitem", "events", "documents")
    ])


@query("profile_completeness", f"""
    WITH {st.LABELLED}
    SELECT source, 'Column' AS entity, instance, 'Completeness' AS name, round(value, 6) AS value
    FROM (SELECT source, 'quality' AS instance, count(quality) / count(*) AS value FROM ld GROUP BY source
          UNION ALL SELECT source, 'toxic', count(toxic) / count(*) FROM ld GROUP BY source
          UNION ALL SELECT source, 'n_chars', count(n_chars) / count(*) FROM ld GROUP BY source)
""")
def profile_completeness(spark, folder):
    wanted = [metric("Completeness", c) for c in ("quality", "toxic", "n_chars")]
    return _rounded(profile(st.labelled_documents(spark, folder), wanted, ["source"]))


NUMERIC = ("Mean", "Sum", "StandardDeviation", "Minimum", "Maximum")


def _numeric_sql(column):
    return f"""
        SELECT l_returnflag, '{column}' AS instance, name, value FROM (
            UNPIVOT (SELECT l_returnflag, CAST(sum(CAST({column} AS DECIMAL(18, 2))) AS DOUBLE) / count({column}) AS "Mean",
                            CAST(sum(CAST({column} AS DECIMAL(18, 2))) AS DOUBLE) AS "Sum",
                            stddev_pop({column}) AS "StandardDeviation", min({column}) AS "Minimum",
                            max({column}) AS "Maximum"
                     FROM lineitem GROUP BY l_returnflag)
            ON "Mean", "Sum", "StandardDeviation", "Minimum", "Maximum" INTO NAME name VALUE value)"""


@query("profile_numeric", f"""
    SELECT l_returnflag, 'Column' AS entity, instance, name, round(value, 4) AS value
    FROM ({_numeric_sql('l_quantity')} UNION ALL {_numeric_sql('l_extendedprice')} UNION ALL {_numeric_sql('l_discount')})
""")
def profile_numeric(spark, folder):
    # As decimals the sums are exact, whatever the order in which tasks add them up.
    columns = ("l_quantity", "l_extendedprice", "l_discount")
    lineitem = load(spark, folder, "lineitem").withColumns({c: F.col(c).cast("decimal(18,2)") for c in columns})
    return _rounded(profile(lineitem, [metric(n, c) for c in columns for n in NUMERIC], ["l_returnflag"]), 4)


QUANTILE_COLUMNS = ("l_quantity", "l_discount", "l_linenumber")


@query("profile_quantiles", " UNION ALL ".join(
    f"""SELECT 'Column' AS entity, '{c}' AS instance, unnest(['ApproxQuantiles-0.25', 'ApproxQuantiles-0.75']) AS name,
               unnest([quantile_disc({c}, 0.25), quantile_disc({c}, 0.75)])::DOUBLE AS value FROM lineitem"""
    for c in QUANTILE_COLUMNS
))
def profile_quantiles(spark, folder):
    # With few distinct values the approximate quantiles are the exact ones.
    names = ("ApproxQuantiles-0.25", "ApproxQuantiles-0.75")
    return profile(load(spark, folder, "lineitem"), [metric(n, c) for n in names for c in QUANTILE_COLUMNS])


CONTINUOUS = {"lineitem": "l_extendedprice", "orders": "o_totalprice"}


@query("profile_quantiles_continuous", " UNION ALL ".join(
    f"""SELECT 'Column' AS entity, '{c}' AS instance, unnest(['ApproxQuantiles-0.25', 'ApproxQuantiles-0.75']) AS name,
               unnest([quantile_disc({c}, 0.25), quantile_disc({c}, 0.75)])::DOUBLE AS value FROM {t}"""
    for t, c in CONTINUOUS.items()
))
def profile_quantiles_continuous(spark, folder):
    names = ("ApproxQuantiles-0.25", "ApproxQuantiles-0.75")
    return union_all([profile(load(spark, folder, t), [metric(n, c) for n in names], exact=True) for t, c in CONTINUOUS.items()])


@query("profile_quantiles_by_group", """
    SELECT l_returnflag, 'Column' AS entity, c AS instance, 'ApproxQuantiles-' || s AS name, v AS value FROM (
        SELECT l_returnflag, unnest(['l_extendedprice', 'l_extendedprice', 'l_extendedprice', 'l_discount']) AS c, unnest(['0.01', '0.5', '0.999', '0.5']) AS s,
               unnest([quantile_disc(l_extendedprice, 0.01), quantile_disc(l_extendedprice, 0.5), quantile_disc(l_extendedprice, 0.999), quantile_disc(l_discount, 0.5)])::DOUBLE AS v
        FROM lineitem GROUP BY l_returnflag)
""")
def profile_quantiles_by_group(spark, folder):
    wanted = [metric(f"ApproxQuantiles-{s}", "l_extendedprice") for s in ("0.01", "0.5", "0.999")] + [metric("ApproxQuantiles-0.5", "l_discount")]
    return profile(load(spark, folder, "lineitem"), wanted, ["l_returnflag"], exact=True)


@query("profile_count_distinct", """
    SELECT 'Column' AS entity, 'o_custkey' AS instance, 'CountDistinct' AS name, CAST(count(DISTINCT o_custkey) AS DOUBLE) AS value FROM orders
    UNION ALL
    SELECT 'Column', 'o_orderpriority', 'CountDistinct', CAST(count(DISTINCT o_orderpriority) AS DOUBLE) FROM orders
    UNION ALL
    SELECT 'Multicolumn', 'o_custkey,o_orderstatus', 'CountDistinct',
           CAST(count(DISTINCT (o_custkey, o_orderstatus)) AS DOUBLE) FROM orders
""")
def profile_count_distinct(spark, folder):
    return profile(load(spark, folder, "orders"), [
        metric("CountDistinct", "o_custkey"), metric("CountDistinct", "o_orderpriority"),
        metric("CountDistinct", "o_custkey", "o_orderstatus"),
    ])


DISTINCT_FAMILY = ("CountDistinct", "Distinctness", "Uniqueness", "UniqueValueRatio")


def _family_sql(instance, entity, counts):
    return f"""
        SELECT '{entity}' AS entity, '{instance}' AS instance, name, value FROM (
            UNPIVOT (SELECT CAST(count(*) AS DOUBLE) AS "CountDistinct", count(*) / sum(n) AS "Distinctness",
                            count(*) FILTER (n = 1) / sum(n) AS "Uniqueness",
                            count(*) FILTER (n = 1) / count(*) AS "UniqueValueRatio" FROM ({counts}))
            ON "CountDistinct", "Distinctness", "Uniqueness", "UniqueValueRatio" INTO NAME name VALUE value)"""


@query("profile_distinct_family", f"""
    WITH {st.LABELLED}
    SELECT entity, instance, name, round(value, 6) AS value FROM (
        {_family_sql('o_custkey', 'Column', 'SELECT count(*) AS n FROM orders GROUP BY o_custkey')}
        UNION ALL {_family_sql('l_orderkey,l_linenumber', 'Multicolumn',
                               'SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber')}
        UNION ALL {_family_sql('quality', 'Column',
                               'SELECT count(*) AS n FROM ld WHERE quality IS NOT NULL GROUP BY quality')})
""")
def profile_distinct_family(spark, folder):
    def family(df, *columns):
        return profile(df, [metric(n, *columns) for n in DISTINCT_FAMILY])

    return _rounded(union_all([
        family(load(spark, folder, "orders"), "o_custkey"),
        family(load(spark, folder, "lineitem"), "l_orderkey", "l_linenumber"),
        family(st.labelled_documents(spark, folder), "quality"),
    ]))


@query("profile_histogram", f"""
    WITH {st.LABELLED},
         c AS (SELECT coalesce(CAST(quality AS VARCHAR), 'NullValue') AS v, count(*) AS n FROM ld GROUP BY 1),
         o AS (SELECT o_orderpriority AS v, count(*) AS n FROM orders GROUP BY 1)
    SELECT 'Column' AS entity, 'quality' AS instance, 'Histogram.bins' AS name, CAST(count(*) AS DOUBLE) AS value FROM c
    UNION ALL SELECT 'Column', 'quality', 'Histogram.abs.' || v, n FROM c
    UNION ALL SELECT 'Column', 'quality', 'Histogram.ratio.' || v, round(n / (SELECT sum(n) FROM c), 6) FROM c
    UNION ALL SELECT 'Column', 'o_orderpriority', 'Histogram.bins', count(*) FROM o
    UNION ALL SELECT 'Column', 'o_orderpriority', 'Histogram.abs.' || v, n FROM o
    UNION ALL SELECT 'Column', 'o_orderpriority', 'Histogram.ratio.' || v, round(n / (SELECT sum(n) FROM o), 6) FROM o
""")
def profile_histogram(spark, folder):
    return _rounded(union_all([
        profile(st.labelled_documents(spark, folder), [metric("Histogram", "quality")]),
        profile(load(spark, folder, "orders"), [metric("Histogram", "o_orderpriority")]),
    ]))


@query("profile_histogram_by_day", f"""
    WITH {st.EVENTS}, c AS (SELECT day, event_type, count(*) AS n FROM ev GROUP BY ALL)
    SELECT day, event_type, n, round(n / sum(n) OVER (PARTITION BY day), 6) AS ratio FROM c
""")
def profile_histogram_by_day(spark, folder):
    counts = histogram_counts(st.events(spark, folder), "event_type", ["day"])
    return counts.select("day", "event_type", F.col("row_count").alias("n"), F.round("row_share", 6).alias("ratio"))


@query("profile_correlation", """
    SELECT 'Multicolumn' AS entity, 'l_quantity,l_extendedprice' AS instance, 'Correlation' AS name,
           round(corr(l_quantity, l_extendedprice), 9) AS value FROM lineitem
    UNION ALL
    SELECT 'Multicolumn', 'l_discount,l_tax', 'Correlation', round(corr(l_discount, l_tax), 9) FROM lineitem
""")
def profile_correlation(spark, folder):
    return _rounded(profile(load(spark, folder, "lineitem"), [
        metric("Correlation", "l_quantity", "l_extendedprice"), metric("Correlation", "l_discount", "l_tax"),
    ]), 9)


def _information_sql(table, a, b):
    return f"""
        SELECT '{a},{b}' AS instance, sum(p.n / t.n * ln(p.n * t.n / (ma.n * mb.n))) AS value
        FROM (SELECT {a}, {b}, count(*)::DOUBLE AS n FROM {table} WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY ALL) p
        JOIN (SELECT {a}, count(*)::DOUBLE AS n FROM {table} WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY ALL) ma USING ({a})
        JOIN (SELECT {b}, count(*)::DOUBLE AS n FROM {table} WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY ALL) mb USING ({b}),
        (SELECT count(*)::DOUBLE AS n FROM {table} WHERE {a} IS NOT NULL AND {b} IS NOT NULL) t"""


@query("profile_mutual_information", f"""
    WITH {st.LABELLED}
    SELECT 'Multicolumn' AS entity, instance, 'MutualInformation' AS name, round(value, 8) AS value
    FROM ({_information_sql('orders', 'o_orderstatus', 'o_orderpriority')}
          UNION ALL {_information_sql('ld', 'lang', 'quality')}
          UNION ALL {_information_sql('events', 'user_id', 'event_type')})
""")
def profile_mutual_information(spark, folder):
    return _rounded(union_all([
        profile(load(spark, folder, "orders"), [metric("MutualInformation", "o_orderstatus", "o_orderpriority")]),
        profile(st.labelled_documents(spark, folder), [metric("MutualInformation", "lang", "quality")]),
        profile(load(spark, folder, "events"), [metric("MutualInformation", "user_id", "event_type")]),
    ]), 8)


# Epoch milliseconds of two profiler runs.
FIRST_RUN, SECOND_RUN = 1_700_000_000_000, 1_700_000_060_000


def _repository(spark, folder):
    """Order metrics of two profiler runs per order month, written and read back."""
    orders = load(spark, folder, "orders").withColumn("date", F.date_format("o_orderdate", "yyyy-MM"))
    first = profile(orders, [metric("Size"), metric("Mean", "o_totalprice")], ["date"])
    second = profile(orders, [
        metric("Size"), metric("Minimum", "o_totalprice"), metric("Maximum", "o_totalprice"),
        metric("Completeness", "o_totalprice"),
    ], ["date"])
    path = work_dir(spark, "repository")
    both = first.withColumn("dataset_date", F.lit(FIRST_RUN)).unionByName(
        second.withColumn("dataset_date", F.lit(SECOND_RUN))
    )
    write_metrics(both.withColumn("table_name", F.lit("orders")), path, ["date", "table_name"])
    return path


def _second_table(spark, folder, path):
    """Metrics of another table, written by a run of the same moment."""
    events = load(spark, folder, "lineitem").withColumn("date", F.date_format("l_shipdate", "yyyy-MM"))
    sizes = profile(events, [metric("Size")], ["date"]).withColumn("dataset_date", F.lit(FIRST_RUN))
    write_metrics(sizes.withColumn("table_name", F.lit("lineitem")), path, ["date", "table_name"])


REPOSITORY = f"""
    mo AS (SELECT strftime(o_orderdate, '%Y-%m') AS date, o_totalprice AS p FROM orders),
    repo AS (
        SELECT 'Dataset' AS entity, '*' AS instance, 'Size' AS name, count(*)::DOUBLE AS value,
               {FIRST_RUN}::BIGINT AS dataset_date, date FROM mo GROUP BY date
        UNION ALL SELECT 'Column', 'o_totalprice', 'Mean', avg(p), {FIRST_RUN}, date FROM mo GROUP BY date
        UNION ALL SELECT 'Dataset', '*', 'Size', count(*), {SECOND_RUN}, date FROM mo GROUP BY date
        UNION ALL SELECT 'Column', 'o_totalprice', 'Minimum', min(p), {SECOND_RUN}, date FROM mo GROUP BY date
        UNION ALL SELECT 'Column', 'o_totalprice', 'Maximum', max(p), {SECOND_RUN}, date FROM mo GROUP BY date
        UNION ALL SELECT 'Column', 'o_totalprice', 'Completeness', 1.0, {SECOND_RUN}, date FROM mo GROUP BY date
    )"""


@query("metrics_repository_scan", f"""
    WITH {REPOSITORY}
    SELECT entity, instance, name, round(value, 4) AS value, dataset_date, date, 'orders' AS table_name FROM repo
""")
def metrics_repository_scan(spark, folder):
    return _rounded(read_metrics(spark, _repository(spark, folder), ["date", "table_name"]), 4)


@query("metrics_repository_folded", f"""
    WITH {REPOSITORY},
         s AS (SELECT * FROM repo WHERE dataset_date = {SECOND_RUN} UNION ALL
               SELECT entity, instance, name, CASE name WHEN 'Mean' THEN value + 1 ELSE value END, dataset_date, date FROM repo WHERE dataset_date = {FIRST_RUN}
               UNION ALL SELECT 'Column', 'o_totalprice', 'Sum', sum(p), {SECOND_RUN} + 60000, date FROM mo GROUP BY date)
    SELECT entity, instance, name, round(value, 4) AS value, dataset_date, date, 'orders' AS table_name FROM s
""")
def metrics_repository_folded(spark, folder):
    """Two runs folded, one of them then replaced and another added in the log, folded again and added to."""
    path, tags = _repository(spark, folder), ["date", "table_name"]
    fold_metrics(spark, path, tags)
    first = read_metrics(spark, path, tags).where(F.col("dataset_date") == FIRST_RUN)
    write_metrics(first.withColumn("value", F.col("value") + F.when(F.col("name") == "Mean", 1).otherwise(0)), path, tags)
    fold_metrics(spark, path, tags)
    orders = load(spark, folder, "orders").withColumn("date", F.date_format("o_orderdate", "yyyy-MM"))
    third = profile(orders, [metric("Sum", "o_totalprice")], ["date"])
    write_metrics(third.withColumn("dataset_date", F.lit(SECOND_RUN + 60000)).withColumn("table_name", F.lit("orders")), path, tags)
    return _rounded(read_metrics(spark, path, tags), 4)


@query("metrics_repository_write", f"""
    WITH {REPOSITORY}
    SELECT dataset_date, date, 'orders' AS table_name, instance, count(*) AS documents, count(*) AS metrics
    FROM repo GROUP BY dataset_date, date, instance
    UNION ALL
    SELECT DISTINCT {FIRST_RUN}::BIGINT, strftime(l_shipdate, '%Y-%m'), 'lineitem', '*', 1, 1 FROM lineitem
""")
def metrics_repository_write(spark, folder):
    path = _repository(spark, folder)
    _second_table(spark, folder, path)
    documents = read_documents(spark, path, ["date", "table_name"])
    entries = F.col("analyzerContext.metricMap")
    return documents.groupBy(
        F.col("resultKey.dataSetDate").alias("dataset_date"), F.col("resultKey.tags.date").alias("date"),
        F.col("resultKey.tags.table_name").alias("table_name"), entries[0].metric.instance.alias("instance"),
    ).agg(F.count(F.lit(1)).alias("documents"), F.sum(F.size(entries)).alias("metrics"))


@query("check_repository", """
    SELECT name AS repository, status FROM (VALUES ('written', 'pass'), ('empty', 'error')) v(name, status)
    WHERE EXISTS (SELECT 1 FROM orders)
""")
def check_repository_query(spark, folder):
    metrics = read_metrics(spark, _repository(spark, folder), ["date", "table_name"])
    frames = {"written": metrics, "empty": metrics.where(F.col("date") == "1800-01")}
    return union_all([check_repository(f).select(F.lit(n).alias("repository"), "status") for n, f in frames.items()])


EXPECTED_METRICS = {"o_totalprice": ["Minimum", "Maximum", "Completeness", "Mean"], "*": ["Size"], "o_custkey": []}


@query("check_profile_metrics", f"""
    WITH {REPOSITORY},
         latest AS (SELECT * FROM repo QUALIFY dataset_date = max(dataset_date) OVER (PARTITION BY date)),
         d AS (SELECT DISTINCT date FROM repo),
         w AS (SELECT date, 'o_totalprice' AS instance, unnest(['Minimum', 'Maximum', 'Completeness', 'Mean']) AS name FROM d
               UNION ALL SELECT date, '*', 'Size' FROM d),
         j AS (SELECT coalesce(a.date, w.date) AS date, coalesce(a.instance, w.instance) AS instance,
                      a.name IS NOT NULL AS found, w.name IS NOT NULL AS wanted
               FROM latest a FULL JOIN w ON a.date = w.date AND a.instance = w.instance AND a.name = w.name)
    SELECT date, instance, count(*) FILTER (NOT found) AS missing, count(*) FILTER (NOT wanted) AS unexpected,
           CASE WHEN count(*) FILTER (found <> wanted) = 0 THEN 'pass' ELSE 'fail' END AS status
    FROM j GROUP BY date, instance
    UNION ALL SELECT date, 'o_custkey', 0, 0, 'pass' FROM d
""")
def check_profile_metrics_query(spark, folder):
    metrics = read_metrics(spark, _repository(spark, folder), ["date", "table_name"])
    return check_profile_metrics(metrics, EXPECTED_METRICS)


@query("check_metric_dates", f"""
    WITH {REPOSITORY},
         d AS (SELECT DISTINCT date FROM repo),
         x AS (SELECT DISTINCT strftime(unnest(generate_series(DATE '1995-01-01', DATE '2001-12-31', INTERVAL 1 DAY)), '%Y-%m') AS date)
    SELECT *, CASE WHEN missing = 0 THEN 'pass' ELSE 'fail' END AS status
    FROM (SELECT (SELECT count(*) FROM x WHERE date NOT IN (SELECT date FROM d)) AS missing,
                 (SELECT count(*) FROM d WHERE date NOT IN (SELECT date FROM x)) AS unexpected)
""")
def check_metric_dates_query(spark, folder):
    days = day_range(spark, dt.date(1995, 1, 1), dt.date(2001, 12, 31))
    expected = days.select(F.date_format("day", "yyyy-MM").alias("date")).distinct()
    metrics = read_metrics(spark, _repository(spark, folder), ["date", "table_name"])
    return check_metric_dates(metrics, expected)


WANTED_DAYS = [f"2024-01-{d:02d}" for d in range(1, 31)]


@query("check_metric_date_list", f"""
    WITH {st.EVENTS},
         m AS (SELECT user_id, list_sort(list_distinct(list(strftime(day, '%Y-%m-%d')))) AS days FROM ev GROUP BY user_id),
         t AS (SELECT '[''' || array_to_string(days, ''', ''') || ''']' AS dt_list, count(*) AS records,
                      any_value(days) AS days FROM m GROUP BY 1)
    SELECT dt_list, records, len(list_filter({WANTED_DAYS}, lambda x: NOT list_contains(days, x))) AS missing,
           len(list_filter(days, lambda x: NOT list_contains({WANTED_DAYS}, x))) AS unexpected,
           CASE WHEN missing + unexpected = 0 THEN 'pass' ELSE 'fail' END AS status
    FROM t
""")
def check_metric_date_list_query(spark, folder):
    # One list per user, at most one entry per calendar day.
    lists = st.events(spark, folder).groupBy("user_id").agg(F.array_sort(F.collect_set(day_text(F.col("day")))).alias("d"))
    return check_metric_date_list(lists.select(list_text("d").alias("dt_list")), WANTED_DAYS)
