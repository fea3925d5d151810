"""Checks and rules that are answered by one shared aggregate.

A check contributes named measures; any number of checks run in a single pass
over the table, for the whole table or per group.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from veriframe.functions.text import contains_any, params_json
from veriframe.operators.verdict import FAIL, PASS, group_text, status_of, union_all

Measures = dict[str, Column]


@dataclass(frozen=True)
class Outcome:
    status: Column
    violations: Column
    observed: Column
    expected: Column


@dataclass(frozen=True)
class RowCheck:
    """Measures to aggregate and how to read the verdict off them.

    ``extremes_of`` names the column whose minimum and maximum are measured.
    """

    check: str
    target: str
    measures: Measures
    judge: Callable[[Measures], Outcome]
    params: dict = field(default_factory=dict)
    extremes_of: str | None = None


def count_if(condition: Column) -> Column:
    return F.sum(F.coalesce(condition, F.lit(False)).cast("bigint"))


def _rows() -> Column:
    return F.count(F.lit(1))


def _text(value: Column) -> Column:
    return value.cast("string")


def no_null(column: str) -> RowCheck:
    """No row is null. NaN is a value."""
    return RowCheck(
        "no_null", column,
        {"nulls": F.coalesce(F.sum(F.col(column).isNull().cast("bigint")), F.lit(0))},
        lambda m: Outcome(status_of(m["nulls"]), m["nulls"], _text(m["nulls"]), F.lit("0")),
    )


def constant(column: str) -> RowCheck:
    """Exactly one distinct value, null being a value; an empty table fails."""
    value = F.col(column)

    def judge(m: Measures) -> Outcome:
        one_value = (m["present"] == m["rows"]) & m["low"].eqNullSafe(m["high"])
        single = (m["rows"] > 0) & ((m["present"] == 0) | one_value)
        observed = F.concat_ws(" .. ", _text(m["low"]), _text(m["high"]))
        return Outcome(
            F.when(single, PASS).otherwise(FAIL),
            F.when(single, 0).otherwise(1), observed, F.lit("one value"),
        )

    return RowCheck(
        "constant", column,
        {"rows": _rows(), "present": F.count(value), "low": F.min(value), "high": F.max(value)},
        judge, extremes_of=column,
    )


def value_range(
    column: str, low: int | float | Decimal | dt.date, high: int | float | Decimal | dt.date
) -> RowCheck:
    """Every non-null value lies in the closed range; no value at all is an error.

    NaN sorts above every number, so it lies outside.
    """
    value = F.col(column)

    def judge(m: Measures) -> Outcome:
        return Outcome(
            status_of(m["outside"], m["present"] == 0), m["outside"],
            F.concat_ws(" .. ", _text(m["low"]), _text(m["high"])), F.lit(f"{low} .. {high}"),
        )

    return RowCheck(
        "value_range", column,
        {
            "present": F.count(value), "low": F.min(value), "high": F.max(value),
            "outside": F.coalesce(count_if((value < F.lit(low)) | (value > F.lit(high))), F.lit(0)),
        },
        judge, {"low": low, "high": high}, column,
    )


def allowed_values(column: str, values: Sequence, exclude_null: bool = True) -> RowCheck:
    """Every value is in a short list. Long lists: :func:`veriframe.operators.sets.unexpected_values`."""
    value = F.col(column)
    foreign = ~value.isin(*[v for v in values if v is not None])
    if not exclude_null and None not in values:
        foreign = F.coalesce(foreign, F.lit(True))
    return RowCheck(
        "allowed_values", column,
        {"foreign": F.coalesce(count_if(foreign), F.lit(0))},
        lambda m: Outcome(
            status_of(m["foreign"]), m["foreign"], _text(m["foreign"]),
            F.lit(", ".join(map(str, values))),
        ),
        {"values": list(values), "exclude_null": exclude_null},
    )


def row_rule(name: str, predicate: Column, target: str = "*") -> RowCheck:
    """A boolean rule per row; a null answer counts as a violation."""
    broken = ~F.coalesce(predicate, F.lit(False))
    return RowCheck(
        "row_rule", name,
        {"broken": F.coalesce(F.sum(broken.cast("bigint")), F.lit(0))},
        lambda m: Outcome(status_of(m["broken"]), m["broken"], _text(m["broken"]), F.lit("0")),
        {"target": target},
    )


def some_row(name: str, predicate: Column, target: str = "*") -> RowCheck:
    """At least one row satisfies the predicate."""
    return RowCheck(
        "some_row", name,
        {"hits": F.coalesce(count_if(predicate), F.lit(0))},
        lambda m: Outcome(
            F.when(m["hits"] > 0, PASS).otherwise(FAIL),
            F.when(m["hits"] > 0, 0).otherwise(1), _text(m["hits"]), F.lit(">= 1"),
        ),
        {"target": target},
    )


def some_message(column: str, messages: list[str], regex: bool = False) -> RowCheck:
    """At least one row holds any of the messages."""
    return some_row(" | ".join(messages), contains_any(column, messages, regex), column)


def run_row_checks(df: DataFrame, checks: Sequence[RowCheck], group_by: Sequence[str] = ()) -> DataFrame:
    """Result rows of all checks from one aggregate over ``df``.

    With ``group_by`` there is one row per check and group. Extremes of text
    have an aggregate of their own, as they would take all others out of
    generated code; per group, text goes better through
    :func:`veriframe.operators.distinct.check_constant_by`.
    """
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, (StringType, BinaryType))}
    plain = [c for c in checks if c.extremes_of not in text]
    textual = [c for c in checks if c.extremes_of in text]
    return union_all([_measure(df, part, list(group_by)) for part in (plain, textual) if part])


def _measure(df: DataFrame, checks: Sequence[RowCheck], group_by: list[str]) -> DataFrame:
    named, outcomes = [], []
    for i, check in enumerate(checks):
        columns = {}
        for name, measure in check.measures.items():
            alias = f"_{i}_{name}"
            named.append(measure.alias(alias))
            columns[name] = F.col(alias)
        outcome = check.judge(columns)
        outcomes.append(
            F.struct(
                F.lit(check.check).alias("check"),
                F.lit(check.target).alias("target"),
                group_text(group_by).alias("group_key"),
                outcome.status.alias("status"),
                outcome.violations.cast("bigint").alias("violations"),
                outcome.observed.cast("string").alias("observed"),
                outcome.expected.cast("string").alias("expected"),
                params_json(check.params).alias("params"),
            )
        )
    measured = df.groupBy(*group_by).agg(*named) if group_by else df.agg(*named)
    return measured.select(*group_by, F.inline(F.array(*outcomes)))
