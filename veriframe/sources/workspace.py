"""Shared scratch space for written intermediates."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"

_local_base: str | None = None


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's shared checkpoint folder.

    Only a local master may fall back to a temporary folder: on a cluster the
    executors would each see their own.
    """
    return f"{_base(spark).rstrip('/')}/veriframe/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that :func:`work_dir` named and this library wrote."""
    if "/veriframe/" not in path:
        raise ValueError(f"{path} is no scratch folder")
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def _base(spark: SparkSession) -> str:
    global _local_base
    configured = spark.conf.get(SETTING, None)
    if configured:
        return configured
    if not re.match(r"local($|\[)", spark.sparkContext.master):
        raise RuntimeError(f"set {SETTING} to a folder that every executor can reach")
    if _local_base is None:
        _local_base = tempfile.mkdtemp(prefix="veriframe-")
    return _local_base


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame, written to the shared scratch space and read again: what several readers of a small result share."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
