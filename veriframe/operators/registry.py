"""Feature registry checks."""

from __future__ import annotations

from pyspark.sql import DataFrame

from veriframe.operators.sets import check_sets, compare_sets
from veriframe.sources.registry import service_columns, view_columns


def columns_frame(df: DataFrame) -> DataFrame:
    """Column names of a frame as rows."""
    return df.sparkSession.createDataFrame([(c,) for c in df.columns], "column string")


def check_feature_view(registry: DataFrame, columns: DataFrame, view: str) -> DataFrame:
    """Columns of a table against the entity and feature columns of one view."""
    return compare_sets(columns, view_columns(registry, view).select("column"), ["column"])


def check_feature_views(registry: DataFrame, columns: DataFrame) -> DataFrame:
    """The same for every view at once; ``columns`` holds (view, column)."""
    return check_sets(columns, view_columns(registry), "column", ["view"])


def check_feature_service(
    registry: DataFrame, services: DataFrame, columns: DataFrame, service: str
) -> DataFrame:
    """Columns of a table against the union of a service's views."""
    wanted = service_columns(registry, services, service).select("column")
    return compare_sets(columns, wanted, ["column"])


def check_feature_services(registry: DataFrame, services: DataFrame, columns: DataFrame) -> DataFrame:
    """The same for every service at once; ``columns`` holds (service, column)."""
    return check_sets(columns, service_columns(registry, services), "column", ["service"])
