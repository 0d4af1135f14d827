"""Top-k cuts, full rankings and normalization of result lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scores import min_max, significant
from ..workspace import Workspace

# Scores are compared, and tested for a zero range, at twelve significant digits, so that the
# order in which a sum was taken never decides, however small the scores are. Ties go to the
# smaller document id.


def top_k(scored: DataFrame, k: int, by: str = "score", digits: int | None = None) -> DataFrame:
    """The ``k`` best rows per query, with ``rank`` from 1; ``digits`` rounds absolutely instead.

    Spark limits each group before the shuffle as well, so a query that matches every
    document sends ``k`` rows per task to its window, not all of them.
    """
    order = Window.partitionBy("query_id").orderBy(F.desc("_key"), "doc_id")
    return (
        scored.withColumn("_key", significant(F.col(by)) if digits is None else F.round(by, digits))
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .drop("_key")
    )


def rank_all(scored: DataFrame, workspace: Workspace, name: str) -> DataFrame:
    """Every row with its ``rank``, however many rows one query has.

    Rows are range-partitioned by the full order, so a query with many results spans
    several slices. A row's rank is its number within its slice plus the rows of the
    earlier slices; only one count per query and slice is brought together.
    """
    slices = workspace.write(
        scored.withColumn("_key", significant(F.col("score")))
        .repartitionByRange("query_id", F.desc("_key"), "doc_id")
        .withColumn("slice", F.spark_partition_id()),
        name,
    )
    before = Window.partitionBy("query_id").orderBy("slice").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = (
        slices.groupBy("query_id", "slice")
        .agg(F.count("*").alias("n"))
        .select(
            "query_id", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")
        )
    )
    within = Window.partitionBy("query_id", "slice").orderBy(F.desc("_key"), "doc_id")
    return (
        slices.withColumn("number", F.row_number().over(within))
        .join(offsets, ["query_id", "slice"])
        .withColumn("rank", (F.col("number") + F.col("offset")).cast("bigint"))
        .drop("_key", "slice", "number", "offset")
    )


def min_max_normalize(
    ranked: DataFrame, score: str = "score", on_zero_range: str = "zero", cut: bool = True
) -> DataFrame:
    """Scale each query's scores to [0, 1].

    A list whose scores are all equal becomes zeros, or stays as it is with
    ``on_zero_range="keep"``. Other columns are carried along. Lists that have not been
    ``cut`` to a top k are aggregated and joined, so that no list meets in one task.
    """
    if not cut:
        ends = ranked.groupBy("query_id").agg(F.min(score).alias("_low"), F.max(score).alias("_high"))
        scaled = min_max(F.col(score), F.col("_low"), F.col("_high"), on_zero_range)
        return ranked.join(ends, "query_id").withColumn(score, scaled).drop("_low", "_high")
    whole = Window.partitionBy("query_id")
    scaled = min_max(
        F.col(score), F.min(score).over(whole), F.max(score).over(whole), on_zero_range
    )
    return ranked.withColumn(score, scaled)
