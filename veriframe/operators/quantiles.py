"""Exact quantiles of many columns and groups by radix selection.

A double is read as a 64-bit integer of the same order. Each round counts the rows
by the next 16 bits, for the columns and groups that still need it, and keeps
the one bucket that holds the wanted rank; after four rounds the bits are the
value. A round is one scan and one count of at most 65,536 buckets a column and group, pre-aggregated
in every task: no sort of the data, no sketch, no task that sees a whole column.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veriframe.sources.workspace import written

BITS, ROUNDS = 16, 4


def order_key(value: Column) -> Column:
    """A long that orders as the double does: both zeros are one, NaN comes last, null stays null."""
    bits = F.java_method(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), value.cast("double") + F.lit(0.0)).cast("long")
    return F.when(value.isNotNull(), F.when(bits < 0, bits.bitwiseXOR(F.lit((1 << 63) - 1))).otherwise(bits))


def from_order_key(key: Column) -> Column:
    bits = F.when(key < 0, key.bitwiseXOR(F.lit((1 << 63) - 1))).otherwise(key)
    return F.when(key.isNotNull(), F.java_method(F.lit("java.lang.Double"), F.lit("longBitsToDouble"), bits).cast("double"))


def _same(left: str, right: str, names: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{n}").eqNullSafe(F.col(f"{right}.{n}")) for n in names])


def exact_quantiles(df: DataFrame, wanted: Mapping[str, Sequence[float]], by: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """``*by, column, share, value``: of each column the least value that at least a share of its rows does not exceed.

    ``wanted`` gives the shares of each column, ``weight`` how many rows a row
    stands for. Nulls are left out, NaN is the largest value. Every group has its
    rows, with a null value where a column has none; without groups an empty table has them too.
    ``df`` is read four times and must give the same rows each time.
    """
    columns = list(wanted)
    groups = [f"by{k}" for k in range(len(by))]
    keys = df.select(
        *[F.col(c).alias(g) for c, g in zip(by, groups)], F.lit(1).cast("long").alias("rows") if weight is None else F.col(weight).cast("long").alias("rows"),
        F.inline(F.array(*[F.struct(F.lit(k).alias("of"), order_key(F.col(c)).alias("key")) for k, c in enumerate(columns)])))
    place = [*groups, "of"]

    first = written(
        keys.groupBy(*place, F.shiftright("key", 64 - BITS).alias("digit")).agg(F.sum("rows").alias("rows")), "digits")
    totals = first.where("digit is not null").groupBy(*place).agg(F.sum("rows").alias("total"))
    shares = F.element_at(F.array(*[F.array(*[F.lit(float(s)) for s in wanted[c]]) for c in columns]), F.col("of") + 1)
    states = totals.select(*place, "total", F.explode(shares).alias("share")).select(
        *place, "share", F.lit(0).cast("long").alias("prefix"), F.greatest(F.lit(1).cast("long"), F.ceil(F.col("share") * F.col("total"))).alias("rank"))
    counts = first.where("digit is not null").withColumn("prefix", F.lit(0).cast("long"))
    for done in range(ROUNDS):
        if done:
            known = states.select(*place, "prefix").distinct()
            shift = 64 - BITS * done
            open_keys = keys.where("key is not null").withColumn("prefix", F.shiftright("key", shift)).alias("k").join(
                known.alias("s"), _same("k", "s", [*place, "prefix"]), "left_semi")
            digit = F.shiftright("key", shift - BITS).bitwiseAND(F.lit((1 << BITS) - 1)).alias("digit")
            counts = open_keys.groupBy(*place, "prefix", digit).agg(F.sum("rows").alias("rows"))
        upto = F.sum("rows").over(Window.partitionBy(*place, "prefix").orderBy("digit"))
        placed = counts.withColumn("upto", upto).alias("c").join(states.alias("s"), _same("c", "s", [*place, "prefix"]))
        states = written(
            placed.where("upto >= rank and upto - rows < rank").select(
                *[f"s.{p}" for p in place], "share", (F.col("s.prefix") * (1 << BITS) + F.col("digit")).alias("prefix"),
                (F.col("rank") - F.col("upto") + F.col("rows")).alias("rank")), "ranks")
    found = states.select(*groups, "of", "share", from_order_key(F.col("prefix")).alias("value"))
    all_of = [F.struct(F.lit(k).alias("of"), F.lit(c).alias("column"), F.lit(float(s)).alias("share")) for k, c in enumerate(columns) for s in wanted[c]]
    there = first.select(*groups).distinct() if by else df.sparkSession.range(1).select()
    named = there.select(*groups, F.inline(F.array(*all_of)))
    return named.alias("n").join(found.alias("f"), _same("n", "f", [*place, "share"]), "left").select(
        *[F.col(f"n.{g}").alias(c) for c, g in zip(by, groups)], "n.column", "n.share", "value")
