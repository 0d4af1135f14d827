"""Helpers of the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..workspace import Workspace, shared_folder, small_batches  # noqa: F401

#: White space and words of all contracts, as regular expressions for Spark.
SPACE = r"[ \t-\r]+"
WORD = r"[^ \t-\r]+"


def space(spark: SparkSession, name: str) -> Workspace:
    """A new place for one call's tables, under the cluster's shared folder."""
    return Workspace(spark, f"{name}-{uuid.uuid4().hex}")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_folder(spark)}/lexigraph/{spark.conf.get('spark.app.id')}/{name}-{uuid.uuid4().hex[:12]}"


def text_or_empty(column: str | Column = "text") -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def running_sums(rows: DataFrame, order: list[Column], sums: dict[str, str], work: Workspace) -> DataFrame:
    """``rows`` with, for each ``new: old`` of ``sums``, the sum of ``old`` over all rows before.

    The order must be total. Rows are dealt out by range and sorted within their task; only
    one total for each range meets in one place, so no task ever holds all rows.
    """
    spark = rows.sparkSession
    keys = [f"__k{i}" for i in range(len(order))]
    keyed = rows.select("*", *(c.alias(k) for c, k in zip(order, keys)))
    parts = keyed.repartitionByRange(shuffle_partitions(spark), *keys).withColumn(
        "__part", F.spark_partition_id()
    )
    stored = work.write(parts, "ranges")
    totals = stored.groupBy("__part").agg(*(F.sum(old).alias(f"__t_{new}") for new, old in sums.items()))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each range: bounded by the number of shuffle partitions.
    starts = totals.select(
        "__part", *(F.coalesce(F.sum(f"__t_{n}").over(before), F.lit(0)).alias(f"__t_{n}") for n in sums)
    )
    within = Window.partitionBy("__part").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    return (
        stored.join(F.broadcast(starts), "__part")
        .withColumns(
            {
                n: F.col(f"__t_{n}") + F.coalesce(F.sum(old).over(within), F.lit(0))
                for n, old in sums.items()
            }
        )
        .drop("__part", *keys, *(f"__t_{n}" for n in sums))
    )


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut to so many rows, which bounds what is built from them."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
