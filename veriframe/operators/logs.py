"""Checks on append-only run logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from veriframe.functions.text import contains, contains_any, run_uri
from veriframe.functions.time import day_text
from veriframe.operators.verdict import ERROR, FAIL, PASS


def where_equal(df: DataFrame, values: dict) -> DataFrame:
    """Rows equal to every given value; each literal takes the column's own type."""
    types = dict(df.dtypes)
    for column, value in values.items():
        df = df.where(F.col(column) == F.lit(value).cast(types[column]))
    return df


def latest_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row per key in a stated order.

    Spark keeps one candidate per key in every task before the shuffle, so a
    key with many rows does not gather in one place.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def compare_log_dates(
    log: DataFrame, table: DataFrame, keys: Sequence[str], order: Sequence[Column],
    date_column: str = "dl_data_dt", list_column: str = "dt_list",
) -> DataFrame:
    """Dates of the newest log row against the distinct dates of the table, per key.

    A log row also yields one row without a date, which shows that it is there
    even when its list is empty.
    """
    zero, one = F.lit(0), F.lit(1)
    dates = F.concat(F.array(F.lit(None).cast("string")), list_column)
    logged = latest_rows(log, keys, order).select(*keys, F.posexplode(dates).alias("_at", "date")).select(
        *keys, "date", F.least("_at", one).alias("in_log"), zero.alias("in_table"), one.alias("has_log")
    )
    loaded = table.select(
        *keys, day_text(F.col(date_column)).alias("date"), zero.alias("in_log"), one.alias("in_table"),
        zero.alias("has_log"),
    )
    return logged.unionByName(loaded).groupBy(*keys, "date").agg(
        F.sum("in_log").alias("in_log"), F.max("in_table").alias("in_table"), F.max("has_log").alias("has_log")
    )


def check_log_dates(
    log: DataFrame, table: DataFrame, keys: Sequence[str], order: Sequence[Column],
    date_column: str = "dl_data_dt", list_column: str = "dt_list",
) -> DataFrame:
    """The newest log row lists each date of the table once; without a list it is an error."""
    compared = compare_log_dates(log, table, keys, order, date_column, list_column)
    mismatch = F.sum((F.col("in_log") != F.col("in_table")).cast("bigint"))
    return compared.groupBy(*keys).agg(mismatch.alias("mismatches"), F.max("has_log").alias("has_log")).select(
        *keys, "mismatches",
        F.when(F.col("has_log") == 0, ERROR).when(F.col("mismatches") == 0, PASS).otherwise(FAIL).alias("status"),
    )


def first_task_runs(task_runs: DataFrame) -> DataFrame:
    """The lowest task run per run and task name."""
    return task_runs.groupBy("job_id", "run_id", "task_key").agg(F.min("task_run_id").alias("task_run_id"))


def expected_log_keys(task_runs: DataFrame, workspace_url: str) -> DataFrame:
    """The four log keys that each task of each run must be logged under."""
    return first_task_runs(task_runs).select(
        F.col("job_id").cast("string").alias("parent_id"),
        F.col("run_id").cast("string").alias("parent_run_id"),
        run_uri(F.lit(workspace_url), F.col("job_id"), F.col("task_run_id")).alias("job_uri"),
        F.col("task_key").alias("task_nm"),
    )


LOG_KEYS = ["parent_id", "parent_run_id", "job_uri", "task_nm"]


def check_log_counts(
    log: DataFrame, task_runs: DataFrame, workspace_url: str, expected_count: int = 1,
    tasks: Sequence[str] | None = None,
) -> DataFrame:
    """Log rows per task against an expected number, zero for tasks that were never logged.

    With ``tasks`` only those names are judged, and a run without one of them
    gets an error row.
    """
    if tasks is not None:
        known = task_runs.where(F.col("task_key").isin(*tasks))
        wanted = task_runs.select("job_id", "run_id").distinct().withColumn(
            "task_key", F.explode(F.array(*[F.lit(t) for t in tasks]))
        )
        unknown = wanted.join(known, ["job_id", "run_id", "task_key"], "left_anti").select(
            F.col("job_id").cast("string").alias("parent_id"), F.col("run_id").cast("string").alias("parent_run_id"),
            F.lit(None).cast("string").alias("job_uri"), F.col("task_key").alias("task_nm"),
            F.lit(None).cast("bigint").alias("log_rows"), F.lit(ERROR).alias("status"),
        )
        return check_log_counts(log, known, workspace_url, expected_count).unionByName(unknown)
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    expected = expected_log_keys(task_runs, workspace_url).select(*LOG_KEYS, one.alias("_task"), zero.alias("_log"))
    logged = log.select(*LOG_KEYS, zero.alias("_task"), one.alias("_log"))
    counted = expected.unionByName(logged).groupBy(*LOG_KEYS).agg(
        F.max("_task").alias("_task"), F.sum("_log").alias("log_rows")
    )
    return counted.where("_task = 1").select(
        *LOG_KEYS, "log_rows", F.when(F.col("log_rows") == expected_count, PASS).otherwise(FAIL).alias("status")
    )


def check_log_records(
    log: DataFrame, expected: DataFrame, keys: Sequence[str], columns: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """Newest log row per key against an expected record: one row per compared column.

    Nulls compare as equal and structs in full. A key without any log row is an error.
    """
    newest = latest_rows(log, keys, order).select(
        *keys, F.lit(True).alias("_found"), F.struct(*columns).alias("_actual")
    )
    wanted = expected.select(*keys, F.struct(*columns).alias("_expected"))
    outcomes = [
        F.struct(
            F.lit(c).alias("column"),
            F.when(F.col("_found").isNull(), ERROR)
            .when(F.col(f"_actual.{c}").eqNullSafe(F.col(f"_expected.{c}")), PASS)
            .otherwise(FAIL).alias("status"),
            _as_text(log, c, f"_actual.{c}").alias("actual"),
            _as_text(log, c, f"_expected.{c}").alias("expected"),
        )
        for c in columns
    ]
    return wanted.join(newest, list(keys), "left").select(*keys, F.inline(F.array(*outcomes)))


def check_log_record(
    log: DataFrame, where: dict, expected: dict, order: Sequence[Column]
) -> DataFrame:
    """One record: the newest row equal to ``where`` against a dict of expected values.

    A struct is expected as a dict of its fields.
    """
    schema = StructType([f for f in log.schema.fields if f.name in expected])
    row = tuple(expected[f.name] for f in schema.fields)
    wanted = log.sparkSession.createDataFrame([row], schema).withColumn("_one", F.lit(1))
    rows = where_equal(log, where).withColumn("_one", F.lit(1))
    columns = list(expected)
    return check_log_records(rows, wanted, ["_one"], columns, order).drop("_one")


def _as_text(df: DataFrame, column: str, path: str) -> Column:
    kind = dict(df.dtypes)[column]
    nested = kind.startswith(("struct", "array", "map"))
    return F.to_json(F.col(path)) if nested else F.col(path).cast("string")


def has_array_keyword(column: str, keyword: str, field: str = "val") -> Column:
    """Some struct of an array holds the keyword; null and empty arrays hold nothing."""
    hit = F.exists(F.col(column), lambda item: contains(item[field], keyword))
    return F.coalesce(hit, F.lit(False))


def check_array_keyword(
    log: DataFrame, keys: Sequence[str], column: str, keyword: str, field: str = "val", expected: DataFrame | None = None
) -> DataFrame:
    """Some row per key holds the keyword in its array; expected keys without a row fail."""
    return _any_hit(log, keys, has_array_keyword(column, keyword, field), expected)


def check_error_keyword(
    log: DataFrame, keys: Sequence[str], keyword: str, column: str = "err_msg", expected: DataFrame | None = None
) -> DataFrame:
    """Some log row of the run holds the keyword in its error text; expected keys without a row fail."""
    return _any_hit(log, keys, F.coalesce(contains(column, keyword), F.lit(False)), expected)


def _any_hit(log: DataFrame, keys: Sequence[str], hit: Column, expected: DataFrame | None) -> DataFrame:
    hits = F.coalesce(F.sum("_hit"), F.lit(0))
    marked = log.select(*keys, hit.cast("bigint").alias("_hit"))
    if expected is not None:
        marked = marked.unionByName(expected.select(*keys, F.lit(0).cast("bigint").alias("_hit")))
    return marked.groupBy(*keys).agg(hits.alias("hits")).select(
        *keys, "hits", F.when(F.col("hits") > 0, PASS).otherwise(FAIL).alias("status")
    )


def message_hits(lines: DataFrame, column: str, messages: Sequence[str], regex: bool = False) -> DataFrame:
    """Lines per message and the overall verdict, in one pass: any hit passes for all."""
    named = [
        F.sum(F.coalesce(contains_any(column, [m], regex), F.lit(False)).cast("bigint")).alias(f"_{i}")
        for i, m in enumerate(messages)
    ]
    hits = [F.coalesce(F.col(f"_{i}"), F.lit(0)) for i in range(len(messages))]
    total = sum(hits[1:], hits[0])
    rows = F.array(*[F.struct(F.lit(m).alias("message"), h.alias("hits")) for m, h in zip(messages, hits)])
    return lines.agg(*named).select(
        F.when(total > 0, PASS).otherwise(FAIL).alias("status"), F.inline(rows)
    )
