"""The daily sum transform and the views over its output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Output column names.
SUM_COLUMN = "class_source_product_sum_transactions_val_dly_v1"
ADDED_COLUMN = "class_source_product_added_transactions_val_dly_v1"
KEY, DAY, LOADED = "uc_id", "dl_data_dt", "dl_load_ts"


def daily_sum(source: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """Sum of transactions per key and day, as INT.

    Partial sums leave each task, so a key or day with many rows is cheap. A
    sum beyond INT raises instead of wrapping.
    """
    total = F.sum("transactions")
    return source.groupBy(KEY, DAY).agg(total.alias("_sum")).select(
        KEY, as_int(F.col("_sum")).alias(SUM_COLUMN), DAY,
        (F.current_timestamp() if loaded_at is None else loaded_at).alias(LOADED),
    )


def as_int(total: Column) -> Column:
    fits = total.between(-(2 ** 31), 2 ** 31 - 1)
    return F.when(fits | total.isNull(), total.try_cast("int")).otherwise(
        F.raise_error(F.lit("daily sum is outside INT"))
    )


TECHNICAL = "SELECT * FROM {table}"

# Rows of each month's last loaded day. The month ends are broadcast whatever the
# table's size: they hold one date per calendar month, 120,000 at the very most.
# That carries the join below a view's aggregate, and together with the filter on
# the day, which is always true, lets Spark prune partitions at run time. With a
# register of loaded days the table's other partitions are not opened at all.
MONTHLY = """
    SELECT /*+ BROADCAST(m) */ v.* FROM {view} v
    LEFT SEMI JOIN (
        SELECT max({day}) AS dl_data_dt FROM {days}
        WHERE {day} >= DATE '0001-01-01' GROUP BY trunc({day}, 'MM')
    ) m ON v.dl_data_dt = m.dl_data_dt
"""

# Business names without load metadata, newest load of a key and day. A grouped
# maximum keeps one candidate per task and needs no sort.
BUSINESS = """
    SELECT uc_id AS customer_id, dl_data_dt,
           max_by(class_source_product_sum_transactions_val_dly_v1,
                  coalesce(dl_load_ts, TIMESTAMP '0001-01-01 00:00:00')) AS daily_transactions
    FROM {table} GROUP BY uc_id, dl_data_dt
"""


def view_queries(table: str, prefix: str = "", days: str | None = None) -> dict[str, str]:
    """SQL text of the four views; the monthly ones read the daily ones, and their month ends from ``days`` if there is one."""
    names = view_names(table, prefix)
    months = {"days": days or table, "day": "day" if days else "dl_data_dt"}
    return {
        names["technical"]: TECHNICAL.format(table=table),
        names["technical_monthly"]: MONTHLY.format(view=names["technical"], **months),
        names["business"]: BUSINESS.format(table=table),
        names["business_monthly"]: MONTHLY.format(view=names["business"], **months),
    }


def view_names(table: str, prefix: str = "") -> dict[str, str]:
    base = prefix or table.split(".")[-1]
    database = "" if prefix or "." not in table else table.split(".")[0] + "."
    return {
        "technical": f"{database}tech_view_{base}",
        "technical_monthly": f"{database}monthly_tech_view_{base}",
        "business": f"{database}bsns_view_{base}",
        "business_monthly": f"{database}monthly_bsns_view_{base}",
    }


def create_views(spark: SparkSession, table: str, temporary: bool = False, days: str | None = None) -> dict[str, str]:
    """Create the four views over a table and return their names.

    ``days`` names a table, view or ``parquet.`folder` `` with the column ``day``, such as the
    register that publishing keeps; without it the month ends come from a scan of the table.
    """
    kind = "TEMPORARY VIEW" if temporary else "VIEW"
    for name, query in view_queries(table, days=days).items():
        spark.sql(f"CREATE OR REPLACE {kind} {name} AS {query}")
    return view_names(table)
