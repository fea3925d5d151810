"""Column profile metrics as one long frame: entity, instance, name, value.

Metrics that are plain aggregates share one pass over the table, quantiles
another: their sketches would take the plain ones out of generated code. Exact
quantiles take four. Distinct metrics and mutual information of all columns
share one pass of narrow grouped counts, histograms another. Every requested
metric yields a row; a metric that is undefined for the data holds null.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veriframe.operators.distinct import counts_by_set, distinct_measures, value_counts
from veriframe.operators.quantiles import exact_quantiles
from veriframe.operators.verdict import union_all
from veriframe.sources.workspace import written

# Metric names.
SCALAR = {"Size", "Completeness", "Mean", "Sum", "StandardDeviation", "Minimum", "Maximum"}
DISTINCT = {"CountDistinct", "Distinctness", "Uniqueness", "UniqueValueRatio"}
PAIR = {"Correlation", "MutualInformation"}
QUANTILE = "ApproxQuantiles-"
NULL_BIN = "NullValue"

# Rank error of quantiles is rows / accuracy.
QUANTILE_ACCURACY = 10_000


@dataclass(frozen=True)
class Metric:
    """One requested metric: a name and the column, or columns, it is about."""

    name: str
    columns: tuple[str, ...] = ()

    @property
    def instance(self) -> str:
        return ",".join(self.columns) or "*"

    @property
    def entity(self) -> str:
        return {0: "Dataset", 1: "Column"}.get(len(self.columns), "Multicolumn")


def metric(name: str, *columns: str) -> Metric:
    return Metric(name, columns)


def profile(
    df: DataFrame, metrics: Sequence[Metric], by: Sequence[str] = (),
    accuracy: int = QUANTILE_ACCURACY, exact: bool = False, weight: str | None = None,
) -> DataFrame:
    """All requested metrics, for the whole table or per group of ``by``.

    ``exact`` asks for exact quantiles: of each share the least value that at least
    this share of the rows does not exceed. ``weight`` names a column that tells how
    many rows a row stands for; histograms, distinct metrics, mutual information and exact quantiles
    take it, other metrics are refused then.
    """
    fused, sketched, counted, binned, frames = [], [], [], [], []
    for m in metrics:
        if m.name in SCALAR or m.name == "Correlation":
            fused.append(m)
        elif m.name.startswith(QUANTILE):
            sketched.append(m)
        elif m.name in DISTINCT or m.name == "MutualInformation":
            counted.append(m)
        elif m.name == "Histogram":
            binned.append(m)
        else:
            raise ValueError(f"unknown metric {m.name}")
    if weight and (fused or sketched and not exact):
        raise ValueError(f"no weight for {[m.name for m in fused] or QUANTILE}")
    if exact and sketched:
        frames.append(_quantiles(df, sketched, by, weight))
        sketched = []
    frames += [_fused(df, wanted, by, accuracy) for wanted in (fused, sketched) if wanted]
    if counted:
        frames.append(_counted(df, counted, by, weight))
    if binned:
        frames.append(histograms(df, [m.columns[0] for m in binned], by, weight))
    return union_all(frames)


def scalar_measure(m: Metric, accuracy: int = QUANTILE_ACCURACY, exact: bool = False) -> Column:
    """The aggregate behind one scalar metric, as a double.

    ``exact`` is for decimal columns: their mean is the exact sum over the
    count, where an average would round to a few more digits than the scale.
    """
    if m.name == "Size":
        return F.count(F.lit(1)).cast("double")
    if m.name == "Correlation":
        return _correlation(*m.columns)
    column = F.col(m.columns[0])
    if m.name.startswith(QUANTILE):
        share = float(m.name[len(QUANTILE):])
        return F.percentile_approx(column, F.lit(share), F.lit(accuracy)).cast("double")
    measure = {
        "Completeness": lambda: F.count(column) / F.count(F.lit(1)),
        "Mean": lambda: F.sum(column).cast("double") / F.count(column) if exact else F.avg(column),
        "Sum": lambda: F.sum(column),
        "StandardDeviation": lambda: F.stddev_pop(column),
        "Minimum": lambda: F.min(column),
        "Maximum": lambda: F.max(column),
    }[m.name]
    return measure().cast("double")


def _correlation(first: str, second: str) -> Column:
    """Pearson correlation; null when a column has no spread, where ``corr`` divides by zero."""
    a, b = F.col(first), F.col(second)
    spread = F.stddev_pop(F.when(b.isNotNull(), a)) * F.stddev_pop(F.when(a.isNotNull(), b))
    return F.try_divide(F.covar_pop(a, b), spread)


def _row(m: Metric, value: Column) -> Column:
    return F.struct(
        F.lit(m.entity).alias("entity"), F.lit(m.instance).alias("instance"),
        F.lit(m.name).alias("name"), value.alias("value"),
    )


def _long(df: DataFrame, metrics: Sequence[Metric], measures: Sequence[Column], by: Sequence[str]) -> DataFrame:
    named = [measure.alias(f"_{i}") for i, measure in enumerate(measures)]
    wide = df.groupBy(*by).agg(*named) if by else df.agg(*named)
    rows = F.array(*[_row(m, F.col(f"_{i}")) for i, m in enumerate(metrics)])
    return wide.select(*by, F.inline(rows))


def _fused(df: DataFrame, metrics: Sequence[Metric], by: Sequence[str], accuracy: int) -> DataFrame:
    decimals = {name for name, kind in df.dtypes if kind.startswith("decimal")}
    measures = [scalar_measure(m, accuracy, bool(decimals.intersection(m.columns))) for m in metrics]
    return _long(df, metrics, measures, by)


def _share(m: Metric) -> float:
    return float(m.name[len(QUANTILE):])


def _quantiles(df: DataFrame, metrics: Sequence[Metric], by: Sequence[str], weight: str | None) -> DataFrame:
    wanted: dict[str, list[float]] = {}
    for m in metrics:
        shares = wanted.setdefault(m.columns[0], [])
        shares += [_share(m)] * (_share(m) not in shares)
    found = exact_quantiles(df, wanted, by, weight)
    names = F.lit(None).cast("string")
    for m in metrics:
        names = F.when((F.col("column") == m.columns[0]) & (F.col("share") == _share(m)), m.name).otherwise(names)
    return found.select(*by, F.lit("Column").alias("entity"), F.col("column").alias("instance"), names.alias("name"), "value")


def _counted(df: DataFrame, metrics: Sequence[Metric], by: Sequence[str], weight: str | None) -> DataFrame:
    """Distinct metrics and mutual information. Nulls are left out, and so is their share of the denominator."""
    sets: list[tuple[tuple[str, ...], tuple[str, ...]]] = []

    def number(columns: tuple[str, ...], required: tuple[str, ...] = ()) -> int:
        if (columns, required) not in sets:
            sets.append((columns, required))
        return sets.index((columns, required))

    def rows_of(*of_set) -> Column:
        return F.col("filled") & (F.col("set_number") == number(*of_set))

    measures = [
        _information(*(rows_of(c, m.columns) for c in (m.columns, m.columns[:1], m.columns[1:]))) if m.name == "MutualInformation"
        else distinct_measures(rows_of(m.columns))[m.name] for m in metrics]
    return _long(counts_by_set(df, sets, by, weight), metrics, measures, by)


def _information(pair: Column, first: Column, second: Column) -> Column:
    """Mutual information in nats from the counts of pairs and of both sides, over rows where both are present.

    Written with entropies, ``ln N + (S_ab - S_a - S_b) / N`` where ``S`` sums
    ``c * ln c`` over the counts, so no marginal is joined back to the pairs.
    """
    count = F.col("row_count")
    weighted = count * F.log(count.cast("double"))
    total = F.sum(F.when(pair, count))
    spread = F.sum(F.when(pair, weighted).when(first | second, -weighted))
    return F.log(total.cast("double")) + spread / total


def mutual_information(df: DataFrame, first: str, second: str, by: Sequence[str] = ()) -> DataFrame:
    """Mutual information of two columns."""
    return _counted(df, [Metric("MutualInformation", (first, second))], by, None)


def histogram_counts(df: DataFrame, column: str, by: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """Rows and share per distinct value; null is a bin of its own. The counts are written, so the table is read once."""
    counts = written(value_counts(df, [*by, column], weight), "bins")
    if by:
        totals = counts.groupBy(*by).agg(F.sum("row_count").alias("total"))
        for name in by:
            totals = totals.withColumnRenamed(name, f"_{name}")
        # Null-safe, so that a group without a value keeps its bins.
        same = [counts[name].eqNullSafe(totals[f"_{name}"]) for name in by]
        shares = counts.join(totals, same).select(*counts.columns, (F.col("row_count") / F.col("total")).alias("row_share"))
    else:
        total = counts.agg(F.sum("row_count")).scalar()
        shares = counts.withColumn("row_share", F.col("row_count") / total)
    return shares


def histograms(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """Bins, and one absolute and one relative metric per distinct value of each column, all from one scan.

    The bin of a null is ``NullValue``; a text that spells this name, or its escape, is told apart by a backslash.
    """
    def bin_name(column: str) -> Column:
        text = F.col(column).cast("string")
        return F.coalesce(F.when(text.rlike(rf"^\\*{NULL_BIN}$"), F.concat(F.lit("\\"), text)).otherwise(text), F.lit(NULL_BIN))

    rows = [F.lit(1).cast("long").alias("row_count") if weight is None else F.col(weight).alias("row_count")]
    binned = df.select(*by, *rows, F.inline(F.array(*[F.struct(F.lit(c).alias("instance"), bin_name(c).alias("bin")) for c in columns])))
    counts = written(binned.groupBy(*by, "instance", "bin").agg(F.sum("row_count").alias("row_count")), "bins")
    place = [*by, "instance"]
    totals = counts.groupBy(*place).agg(F.sum("row_count").alias("total"), F.count(F.lit(1)).alias("bins"))

    def row(name: Column, measure: Column) -> Column:
        return F.struct(name.alias("name"), measure.cast("double").alias("value"))

    same = [F.col(f"c.{name}").eqNullSafe(F.col(f"t.{name}")) for name in place]
    per_value = counts.alias("c").join(totals.alias("t"), same).select(
        *[f"c.{name}" for name in place],
        F.inline(F.array(
            row(F.concat(F.lit("Histogram.abs."), F.col("bin")), F.col("row_count")),
            row(F.concat(F.lit("Histogram.ratio."), F.col("bin")), F.col("row_count") / F.col("total")))))
    bins = totals.select(*place, F.inline(F.array(row(F.lit("Histogram.bins"), F.col("bins")))))
    if not by:  # an empty table has no bin, but its metric
        named = df.sparkSession.createDataFrame([(c,) for c in columns], "instance string")
        bins = named.join(bins, "instance", "left").select(
            "instance", F.lit("Histogram.bins").alias("name"), F.coalesce("value", F.lit(0.0)).alias("value"))
    return bins.unionByName(per_value).select(*by, F.lit("Column").alias("entity"), "instance", "name", "value")
