"""Helpers of the text operators: written intermediates, small batches, name-safe columns."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from veriframe.sources.workspace import work_dir

#: Characters of text that a Python worker handles at once.
BATCH_CHARS = 4_000_000


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame, written below the shared folder and read again: a cut in the lineage
    that every executor can reach and that a lost executor does not take along."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], text: str, size: int = BATCH_CHARS) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Runs of whole rows with about ``size`` characters of text (one row at least), and their texts; null is empty."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        start, held, texts = 0, 0, []
        for row in range(batch.num_rows):
            value = column[row].as_py() or ""
            texts.append(value)
            held += len(value)
            if held >= size:
                yield batch.slice(start, row + 1 - start), texts
                start, held, texts = row + 1, 0, []
        if texts:
            yield batch.slice(start, len(texts)), texts


def with_columns(batch: pa.RecordBatch, more: dict[str, pa.Array]) -> pa.RecordBatch:
    """The batch with further columns at its end."""
    return pa.RecordBatch.from_arrays([*batch.columns, *more.values()], names=[*batch.schema.names, *more])


def numbered(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The frame with its columns named ``c0``, ``c1`` and so on, and the new name of each: no working column can clash with them."""
    names = {c: f"c{k}" for k, c in enumerate(df.columns)}
    return df.toDF(*names.values()), names
