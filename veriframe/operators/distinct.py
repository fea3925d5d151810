"""Uniqueness and distinct counts: one grouped count per column set."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veriframe.operators.verdict import group_text, verdict_columns

Columns = str | Sequence[str]


def _names(columns: Columns) -> list[str]:
    return [columns] if isinstance(columns, str) else list(columns)


def value_counts(df: DataFrame, columns: Columns, weight: str | None = None) -> DataFrame:
    """Rows per distinct value; map-side partial counts absorb hot values. ``weight`` names how many rows a row stands for."""
    rows = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return df.groupBy(*_names(columns)).agg(rows.alias("row_count"))


def counts_by_set(df: DataFrame, sets: Sequence[tuple[Sequence[str], Sequence[str]]], by: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """``*by, set_number, filled, row_count``: rows per distinct value of several column sets, from one scan.

    A set is ``(columns, required)``; rows where a required column is null, or one of the columns, are counted
    together with ``filled`` false. What is shuffled for a value is the number of its
    set and 128 bits of hash, however wide and many the columns are.
    """
    def tagged(number: int, columns: Sequence[str], required: Sequence[str]) -> Column:
        present = all_present([*columns, *required])
        halves = [F.when(present, F.xxhash64(F.lit(seed), *columns)).alias(name) for seed, name in ((1, "one"), (2, "other"))]
        return F.struct(F.lit(number).alias("set_number"), *halves)

    rows = [F.lit(1).cast("long").alias("row_count") if weight is None else F.col(weight).alias("row_count")]
    narrow = df.select(*by, *rows, F.inline(F.array(*[tagged(n, *s) for n, s in enumerate(sets)])))
    counted = narrow.groupBy(*by, "set_number", "one", "other").agg(F.sum("row_count").alias("row_count"))
    return counted.select(*by, "set_number", F.col("one").isNotNull().alias("filled"), "row_count")


def duplicates(df: DataFrame, columns: Columns) -> DataFrame:
    """Values that occur more than once, with their row count."""
    return value_counts(df, columns).where(F.col("row_count") > 1)


def check_unique(df: DataFrame, columns: Columns) -> DataFrame:
    """Rows equal distinct rows; null is one value, so two nulls fail."""
    names = _names(columns)
    surplus = F.coalesce(F.sum(F.col("row_count") - 1), F.lit(0))
    return value_counts(df, names).agg(
        surplus.alias("surplus"), F.count(F.lit(1)).alias("distinct")
    ).select(
        *verdict_columns(
            "unique", ",".join(names), F.col("surplus"),
            observed=F.concat(F.col("distinct").cast("string"), F.lit(" distinct")),
            params={"columns": names},
        )
    )


def distinct_measures(counted: Column) -> dict[str, Column]:
    """The four distinct metrics over the rows of a frame of value counts that are ``counted``."""
    total = F.sum(F.when(counted, F.col("row_count")))
    values = F.count(F.when(counted, F.lit(1)))
    single = F.count(F.when(counted & (F.col("row_count") == 1), F.lit(1)))
    return {
        "CountDistinct": values.cast("double"),
        "Distinctness": F.try_divide(values.cast("double"), total.cast("double")),
        "Uniqueness": F.try_divide(single.cast("double"), total.cast("double")),
        "UniqueValueRatio": F.try_divide(single.cast("double"), values.cast("double")),
    }


def all_present(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def check_constant_by(df: DataFrame, column: str, by: Sequence[str]) -> DataFrame:
    """Exactly one distinct value per group, null being a value.

    Grouped text columns go through value counts: a grouped minimum of text
    would sort every row.
    """
    values = value_counts(df, [*by, column]).groupBy(*by).agg((F.count(F.lit(1)) - 1).alias("more"))
    return values.select(
        *by,
        *verdict_columns(
            "constant", column, F.col("more"), observed=F.col("more") + 1, expected=F.lit(1),
            group_key=group_text(list(by)),
        ),
    )
