"""Feature registry held in two tables.

``feature_view_columns(view, column, role)`` lists the entity and feature
columns of each view; ``feature_service_views(service, view)`` lists the views
a service projects.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def view_columns(registry: DataFrame, view: str | None = None) -> DataFrame:
    """Distinct (view, column) pairs, for one view or all."""
    rows = registry if view is None else registry.where(F.col("view") == view)
    return rows.select("view", "column").distinct()


def service_columns(registry: DataFrame, services: DataFrame, service: str | None = None) -> DataFrame:
    """Distinct (service, column) pairs; a column shared by two views counts once."""
    rows = services if service is None else services.where(F.col("service") == service)
    pairs = rows.select("service", "view").distinct()
    return pairs.join(view_columns(registry), "view").select("service", "column").distinct()
