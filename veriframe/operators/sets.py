"""Set, date, schema and equality checks.

Sets are compared in one grouped pass over the tagged union of both sides.
Map-side aggregation reduces each side to its distinct values first, so a
value that holds a large share of the rows costs nothing extra.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DoubleType, FloatType, MapType, StructField, StructType

from veriframe.functions.time import day_range
from veriframe.operators.verdict import verdict_columns
from veriframe.sources.tables import list_partitions

EXACT, SUBSET, SUPERSET = "exact", "subset", "superset"


def compare_sets(actual: DataFrame, expected: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values of both sides with the side they occur on. Nulls are equal."""
    left = actual.select(*columns, F.lit(True).alias("in_actual"), F.lit(False).alias("in_expected"))
    right = expected.select(*columns, F.lit(False).alias("in_actual"), F.lit(True).alias("in_expected"))
    return left.unionByName(right).groupBy(*columns).agg(
        F.max("in_actual").alias("in_actual"), F.max("in_expected").alias("in_expected")
    )


def check_sets(
    actual: DataFrame, expected: DataFrame, column: str, by: Sequence[str] = (), mode: str = EXACT
) -> DataFrame:
    """Missing and unexpected values per group, with the verdict.

    ``superset`` ignores unexpected values, ``subset`` ignores missing ones.
    """
    compared = compare_sets(actual, expected, [*by, column])
    missing = F.coalesce(F.sum((~F.col("in_actual")).cast("bigint")), F.lit(0))
    unexpected = F.coalesce(F.sum((~F.col("in_expected")).cast("bigint")), F.lit(0))
    measures = [missing.alias("missing"), unexpected.alias("unexpected")]
    counted = compared.groupBy(*by).agg(*measures) if by else compared.agg(*measures)
    violations = {
        EXACT: F.col("missing") + F.col("unexpected"),
        SUPERSET: F.col("missing"),
        SUBSET: F.col("unexpected"),
    }[mode]
    return counted.select(
        *by, "missing", "unexpected", F.when(violations == 0, "pass").otherwise("fail").alias("status")
    )


def unexpected_values(
    df: DataFrame, column: str, allowed: DataFrame, exclude_null: bool = True
) -> DataFrame:
    """Distinct values outside an expected frame, with their rows.

    Values are counted before the anti join, so only distinct values meet it.
    """
    known = allowed.select(F.col(allowed.columns[0]).alias("_known")).distinct()
    if exclude_null:
        # Plain equality lets the join reuse the partitioning of the counts.
        values = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))
        return values.join(known, values[column] == known["_known"], "left_anti")
    values = df.groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))
    return values.join(known, values[column].eqNullSafe(known["_known"]), "left_anti")


def check_values_in(
    df: DataFrame, column: str, allowed: DataFrame, exclude_null: bool = True
) -> DataFrame:
    """Distinct values are a subset of an expected frame of any size."""
    return unexpected_values(df, column, allowed, exclude_null).agg(
        F.count(F.lit(1)).alias("values"), F.coalesce(F.sum("row_count"), F.lit(0)).alias("rows")
    ).select(
        *verdict_columns("values_in", column, F.col("values"), observed=F.col("rows"))
    )


def check_schema(spark: SparkSession, actual: StructType, expected: dict) -> DataFrame:
    """One row per column name of either side; column order and top-level nullability are ignored.

    Types compare in full, nested nullability included. Metadata only.
    """
    found = {f.name: f.dataType for f in actual.fields}
    rows = []
    for name in sorted({*found, *expected}):
        left, right = expected.get(name), found.get(name)
        rows.append((
            name, left and left.simpleString(), right and right.simpleString(),
            "pass" if left is not None and left == right else "fail",
        ))
    return spark.createDataFrame(
        rows, "column string, expected_type string, actual_type string, status string"
    )


def check_partitions(
    spark: SparkSession, table: str, expected: DataFrame, column: str = "dl_data_dt",
    data_type: str = "date",
) -> DataFrame:
    """Every expected partition is listed; more partitions may exist."""
    return check_sets(list_partitions(spark, table, column, data_type), expected, column, mode=SUPERSET)


def missing_days(df: DataFrame, column: str, start: dt.date, end: dt.date) -> DataFrame:
    """Days of the closed range without a row."""
    loaded = df.select(F.col(column).cast("date").alias("day")).where(F.col("day").between(start, end)).distinct()
    return day_range(df.sparkSession, start, end).join(loaded, "day", "left_anti")


def check_date_coverage(df: DataFrame, column: str, start: dt.date, end: dt.date) -> DataFrame:
    """Every day of the closed range occurs; a range that ends before it starts passes."""
    gaps = missing_days(df, column, start, end)
    return gaps.agg(F.count(F.lit(1)).alias("missing"), F.min("day").alias("first")).select(
        *verdict_columns(
            "date_coverage", column, F.col("missing"), observed=F.col("first"),
            params={"start": start, "end": end},
        )
    )


def date_gaps(
    df: DataFrame, column: str, by: Sequence[str], start: dt.date, end: dt.date
) -> DataFrame:
    """Missing day ranges per group: first day, last day and length of each gap.

    Each group is one bit a day, 63 days to a number, which every task or-merges
    before the shuffle; gaps are read off the bits, so no day is ever a row and
    nothing is sorted. Groups without a day in the range are one gap.
    """
    size = max(0, (end - start).days + 1)
    numbers = max(1, -(-size // DAY_BITS))
    held = day_bits(df, column, by, start, end).select(*by, F.array(*[F.col(f"bits{k}") for k in range(numbers)]).alias("bits"))
    return bit_gaps(held, by, start, size)


#: Days in one number of a bitmap.
DAY_BITS = 63


def day_bits(df: DataFrame, column: str, by: Sequence[str], start: dt.date, end: dt.date) -> DataFrame:
    """``*by, bits0, bits1, ...``: one bit for each day of the closed range on which a group has a row."""
    size = max(0, (end - start).days + 1)
    offset = F.datediff(F.col(column).cast("date"), F.lit(start))
    place = F.when(offset.between(0, size - 1), offset)
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(place, F.lit(DAY_BITS)))
    words = [
        F.coalesce(F.bit_or(F.when(F.floor(place / DAY_BITS) == k, bit)), F.lit(0).cast("bigint")).alias(f"bits{k}")
        for k in range(max(1, -(-size // DAY_BITS)))]
    return df.groupBy(*by).agg(*words) if by else df.agg(*words)


def bit_gaps(held: DataFrame, by: Sequence[str], start: dt.date, size: int) -> DataFrame:
    """Runs of zero bits among the first ``size`` of the array ``bits``."""
    def missing(day: Column) -> Column:
        word = F.element_at("bits", (F.floor(day / DAY_BITS) + 1).cast("int"))
        return F.call_function("shiftright", word, (day % DAY_BITS).cast("int")).bitwiseAND(F.lit(1)) == 0

    days = F.sequence(F.lit(0), F.lit(size - 1)) if size else F.array().cast("array<int>")
    first = F.filter(days, lambda d: missing(d) & ((d == 0) | ~missing(F.greatest(d - 1, F.lit(0)))))
    last = F.filter(days, lambda d: missing(d) & ((d == size - 1) | ~missing(F.least(d + 1, F.lit(max(size - 1, 0))))))
    runs = held.select(*by, F.inline(F.arrays_zip(first.alias("first"), last.alias("last"))).alias("first", "last"))
    return runs.select(
        *by, F.date_add(F.lit(start), F.col("first")).alias("gap_start"), F.date_add(F.lit(start), F.col("last")).alias("gap_end"),
        (F.col("last") - F.col("first") + 1).cast("bigint").alias("days"))


#: Buckets of the digests: at most so many rows leave a task, and come to the driver.
BUCKETS = 4096


def _row_hash(df: DataFrame, names: Sequence[str], seed: int) -> Column:
    """A hash of a row that tells nulls apart by their column; both zeros are one, nested values count by their JSON."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    values = []
    for name in names:
        column = F.col(name)
        if isinstance(kinds[name], (StructType, ArrayType, MapType)):
            column = F.to_json(F.struct(column), {"ignoreNullFields": "false"})
        elif isinstance(kinds[name], (DoubleType, FloatType)):
            column = column + F.lit(0.0).cast(kinds[name])
        values += [column, column.isNull()]
    return F.xxhash64(F.lit(seed), *values)


def bucket_digests(df: DataFrame, names: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """``bucket, rows`` and four sums over the rows' hashes: equal multisets have equal digests, in whatever order.

    Two independent 64-bit hashes are added up in halves, which fit a long for two
    billion rows of a bucket. A row's bucket is drawn from a third hash.
    """
    halves = [h for seed in (1, 2) for h in _halves(_row_hash(df, names, seed))]
    bucket = F.pmod(_row_hash(df, names, 3), F.lit(buckets)).cast("int")
    rows = df.select(bucket.alias("bucket"), *[h.alias(f"sum{k}") for k, h in enumerate(halves)])
    return rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("rows"), *[F.sum(f"sum{k}").alias(f"sum{k}") for k in range(len(halves))])


def _halves(hashed: Column) -> list[Column]:
    return [F.shiftrightunsigned(hashed, 32), hashed.bitwiseAND(F.lit((1 << 32) - 1))]


def differing_buckets(left: DataFrame, right: DataFrame, names: Sequence[str], buckets: int = BUCKETS) -> list[int]:
    """Buckets whose digests differ; only digests are shuffled, and at most ``buckets`` numbers come to the driver."""
    measures = ["rows", *[f"sum{k}" for k in range(4)]]
    minus = bucket_digests(right, names, buckets).select("bucket", *[(-F.col(m)).alias(m) for m in measures])
    both = bucket_digests(left, names, buckets).unionByName(minus).groupBy("bucket").agg(*[F.sum(m).alias(m) for m in measures])
    unequal = reduce(lambda a, b: a | b, [F.col(m) != 0 for m in measures])
    return sorted(r[0] for r in both.where(unequal).select("bucket").collect())


def reconcile(left: DataFrame, right: DataFrame, columns: Sequence[str] | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Rows whose number of copies differs, with the copies on each side.

    A multiset comparison: null equals null and NaN equals NaN. Digests of
    ``buckets`` buckets are compared first, at once; only rows of buckets that differ are compared as
    they are, in one shuffle that carries both sides, reduced to distinct rows by
    each task. Both frames must give the same rows when read twice. Two different buckets pass for
    equal with a probability of about 2^-100.
    """
    names = list(columns or left.columns)
    unequal = differing_buckets(left, right, names, buckets)
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")

    def kept(side: DataFrame) -> DataFrame:
        if 2 * len(unequal) > buckets:  # most rows stay: hashing them again would cost more than it saves
            return side.select(*names)
        bucket = F.pmod(_row_hash(side, names, 3), F.lit(buckets)).cast("int")
        return side.select(*names).where(bucket.isin(unequal) if unequal else F.lit(False))

    tagged = kept(left).select(*names, one.alias("_l"), zero.alias("_r")).unionByName(
        kept(right).select(*names, zero.alias("_l"), one.alias("_r"))
    )
    return (
        tagged.groupBy(*names)
        .agg(F.sum("_l").alias("left_rows"), F.sum("_r").alias("right_rows"))
        .where(F.col("left_rows") != F.col("right_rows"))
    )


def schema_shape(schema: StructType, nullability: bool) -> list:
    return [(f.name, f.dataType if nullability else _nullable(f.dataType), f.nullable if nullability else None) for f in schema.fields]


def _nullable(kind: DataType) -> DataType:
    """The type with every nested field, element and value nullable."""
    if isinstance(kind, StructType):
        return StructType([StructField(f.name, _nullable(f.dataType)) for f in kind.fields])
    if isinstance(kind, ArrayType):
        return ArrayType(_nullable(kind.elementType))
    if isinstance(kind, MapType):
        return MapType(_nullable(kind.keyType), _nullable(kind.valueType))
    return kind


def check_equality(left: DataFrame, right: DataFrame, nullability: bool = False) -> DataFrame:
    """Equal schemas in order, and equal rows as a multiset.

    Saved tables read back nullable, at every level, so nullability counts only on request.
    """
    if schema_shape(left.schema, nullability) != schema_shape(right.schema, nullability):
        return left.sparkSession.range(1).select(
            *verdict_columns(
                "equality", "schema", F.lit(1),
                observed=F.lit(right.schema.simpleString()), expected=F.lit(left.schema.simpleString()),
            )
        )
    surplus = F.col("left_rows") - F.col("right_rows")
    return reconcile(left, right).agg(
        F.coalesce(F.sum(F.greatest(surplus, F.lit(0))), F.lit(0)).alias("lost"),
        F.coalesce(F.sum(F.greatest(-surplus, F.lit(0))), F.lit(0)).alias("added"),
    ).select(
        *verdict_columns(
            "equality", "rows", F.col("lost") + F.col("added"),
            observed=F.concat(F.col("lost").cast("string"), F.lit(" only left, "),
                              F.col("added").cast("string"), F.lit(" only right")),
        )
    )


def membership(df: DataFrame, column: str, members: DataFrame) -> DataFrame:
    """Rows whose value occurs in a frame of members."""
    keys = members.select(F.col(members.columns[0]).alias(column)).distinct()
    return df.join(keys, column, "left_semi")
