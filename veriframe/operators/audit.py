"""Row-rule audits and the fail-closed write behind them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veriframe.functions.text import list_text
from veriframe.functions.time import day_text
from veriframe.operators.row_checks import row_rule, run_row_checks
from veriframe.sources.publish import approve, drop, recover, stage, staged_rows, switch
from veriframe.sources.workspace import work_dir

# Fixed value: keyword of an audit failure in the log.
AUDIT_ERROR = "DeequAuditError"
SUCCEEDED = "SUCCESS"


@dataclass(frozen=True)
class Rule:
    """A named predicate in SQL text; an optional one that the table can't answer only warns."""

    name: str
    predicate: str
    optional: bool = False

    def column(self) -> Column:
        return F.expr(self.predicate)


def id_rule(column: str = "uc_id") -> Rule:
    """Twelve characters starting with 11, 12 or 13."""
    return Rule("id_format", f"length({column}) = 12 AND {column} RLIKE '^1[123]'")


def resolve(df: DataFrame, rules: Sequence[Rule]) -> tuple[list[Rule], list[tuple[str, str]]]:
    """Rules that fit the table, and (name, reason) of those that do not."""
    usable, warnings = [], []
    for rule in rules:
        try:
            kind = df.select(rule.column()).dtypes[0][1]
        except AnalysisException as error:
            warnings.append((rule.name, error.getMessage() or str(error)))
            continue
        if kind == "boolean":
            usable.append(rule)
        else:
            warnings.append((rule.name, f"rule is {kind}, not boolean"))
    return usable, warnings


def audit(df: DataFrame, rules: Sequence[Rule], by: Sequence[str] = ()) -> DataFrame:
    """Violations per rule, and per group when asked, in one pass."""
    checks = [row_rule(r.name, r.column()) for r in rules]
    return run_row_checks(df, checks, by).select(
        *by, F.col("target").alias("rule"), "violations", "status"
    )


def warnings_column(warnings: Sequence[tuple[str, str]]) -> Column:
    """Warnings in the shape of the log's array of ``struct<val>``."""
    items = [F.struct(F.lit(f"{name}: {reason}").alias("val")) for name, reason in warnings]
    return F.array(*items) if items else F.array().cast("array<struct<val:string>>")


def audit_record(
    df: DataFrame, rules: Sequence[Rule], task: str, date_column: str = "dl_data_dt"
) -> DataFrame:
    """One log row about an audit: status, error text, audited dates and warnings.

    A rule that the table can't answer fails the audit unless it is optional, and
    so does an audit without any rule that can be answered.

    The date list is as long as the calendar of the audited output.
    """
    usable, warnings = resolve(df, rules)
    optional = {r.name for r in rules if r.optional}
    unusable = [name for name, _ in warnings if name not in optional]
    if not usable and not unusable:
        unusable = ["no rule"]
    broken = [
        F.coalesce(F.sum((~F.coalesce(r.column(), F.lit(False))).cast("bigint")), F.lit(0))
        for r in usable
    ]
    violations = sum(broken[1:], broken[0]) if broken else F.lit(0)
    per_day = df.groupBy(day_text(F.col(date_column)).alias("day")).agg(
        F.count(F.lit(1)).alias("rows"), violations.cast("bigint").alias("violations")
    )
    failed = (F.col("violations") > 0) | F.lit(bool(unusable))
    reason = F.concat(F.col("violations").cast("string"), F.lit(" rule violations"))
    if unusable:
        reason = F.concat(reason, F.lit(f", not answered: {', '.join(unusable)}"))
    return per_day.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("violations"), F.lit(0)).alias("violations"),
        F.array_sort(F.collect_set("day")).alias("dt_list"),
    ).select(
        F.lit(task).alias("task_nm"),
        F.when(failed, "FAILED").otherwise(SUCCEEDED).alias("job_sts"),
        F.when(failed, F.concat(
            F.lit(f"{AUDIT_ERROR}: "), reason,
        )).alias("err_msg"),
        "rows", "violations", "dt_list", list_text("dt_list").alias("dt_list_text"),
        warnings_column(warnings).alias("cstm_val"),
    )


def audited_write(
    df: DataFrame, rules: Sequence[Rule], path: str, task: str, date_column: str = "dl_data_dt"
) -> DataFrame:
    """Write ``df`` only if the audit succeeds; return the log row either way.

    Each row is written once, into a staging folder of the output in its final
    layout; the audit reads it there, and publishing renames its partitions into
    place. A driver lost before the verdict leaves a load that the next call
    drops, one lost after it a load whose remaining partitions the next call publishes. A load that fails
    its audit is removed.
    """
    spark = df.sparkSession
    recover(spark, path)
    staged = stage(df, path, date_column)
    record_path = work_dir(spark, "audit-record")
    audit_record(staged_rows(spark, staged, df.schema), rules, task, date_column).write.parquet(record_path)
    record = spark.read.parquet(record_path)
    if record.first()["job_sts"] == SUCCEEDED:
        approve(spark, staged)
        switch(spark, staged)
    else:
        drop(spark, staged)
    return record


def published(spark: SparkSession, path: str, schema) -> DataFrame:
    """Rows of an output folder, none when nothing was published yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
