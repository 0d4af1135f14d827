"""Values for a given list of ids, one row per entry of the list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pagerank_of(ids: DataFrame, pagerank: DataFrame) -> DataFrame:
    """``ids(pos, doc_id)`` with PageRank; a page outside the link graph has 0."""
    ranks = pagerank.withColumnRenamed("id", "doc_id")
    return (
        ids.join(ranks, "doc_id", "left")
        .select("pos", "doc_id", F.coalesce("pagerank", F.lit(0.0)).alias("pagerank"))
        .orderBy("pos")
    )


def pageviews_of(ids: DataFrame, views: DataFrame) -> DataFrame:
    """``ids(pos, doc_id)`` with page views; a page nobody viewed has 0."""
    return (
        ids.join(views, "doc_id", "left")
        .select("pos", "doc_id", F.coalesce("views", F.lit(0)).alias("views"))
        .orderBy("pos")
    )
