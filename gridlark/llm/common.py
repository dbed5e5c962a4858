"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridlark.sources.tables import read_table

__all__ = ["batches", "columns", "gapless", "large_binary", "read_table", "text_bytes"]


def columns(batch: pa.RecordBatch) -> list[list]:
    """The columns of a record batch as Python lists."""
    return [column.to_pylist() for column in batch.columns]


def batches(df: DataFrame, function: Callable[..., dict | None], schema: str, broadcast=None) -> DataFrame:
    """``function(column lists..., broadcast value)`` on each Arrow batch; gives new columns by name.

    It runs where the rows are: no shuffle, and a lost task is simply run again.
    """

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        extra = [] if broadcast is None else [broadcast.value]
        for batch in parts:
            out = function(*columns(batch), *extra)
            if out is not None:
                yield pa.RecordBatch.from_pydict(out, schema=arrow)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema))
    return df.mapInArrow(run, schema)


def text_bytes(name: str = "text") -> Column:
    """A text column as UTF-8 bytes."""
    return F.col(name).cast("binary").alias(name)


def large_binary(arrays: list[np.ndarray]) -> list[bytes]:
    """Arrays as raw bytes."""
    return [np.ascontiguousarray(a).tobytes() for a in arrays]


def gapless(df: DataFrame, key: str, draw: str, rows: int, name: str, per_bucket: int = 200_000) -> DataFrame:
    """Number the rows of each ``key`` from 0 without gaps, in an order given by the hash ``draw``.

    A key is split into buckets of its draws, so that even a key with all rows is never
    sorted in one task: bucket sizes are counted first, then rows are numbered inside
    their bucket and shifted by the rows of the buckets before it. ``draw`` should be
    distinct per row; equal draws are numbered in any order.
    """
    buckets = max(1, -(-rows // per_bucket))
    bucket = f"{name}_bucket"
    df = df.withColumn(bucket, F.pmod(F.col(draw), F.lit(buckets)))
    before = Window.partitionBy(key).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    sizes = df.groupBy(key, bucket).agg(F.count("*").alias("bucket_rows"))
    offsets = sizes.select(key, bucket, F.coalesce(F.sum("bucket_rows").over(before), F.lit(0)).alias("bucket_start"))
    inside = F.row_number().over(Window.partitionBy(key, bucket).orderBy(draw)) - 1
    numbered = df.withColumn(name, inside.cast("long")).join(offsets, [key, bucket])
    return numbered.withColumn(name, F.col(name) + F.col("bucket_start")).drop(bucket, "bucket_start")


def fresh(spark: SparkSession, value):
    """A broadcast variable; callers check the size of ``value`` first."""
    return spark.sparkContext.broadcast(value)
