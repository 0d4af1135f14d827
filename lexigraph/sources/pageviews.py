"""Page views of a month, counted from an event log by id or from a stored log by title."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VIEW_LOG = "title STRING, day DATE, views BIGINT, month STRING"


def monthly_views(events: DataFrame, month: str) -> DataFrame:
    """``(doc_id, views)`` of the month that starts on ``month`` (``YYYY-MM-01``)."""
    start = F.lit(month).cast("timestamp_ntz")
    return (
        events.filter(
            (F.col("event_type") == "view")
            & (F.col("ts") >= start)
            & (F.col("ts") < F.lit(month).cast("date") + F.expr("INTERVAL 1 MONTH"))
        )
        .groupBy(F.get_json_object("props", "$.k").cast("bigint").alias("doc_id"))
        .agg(F.count("*").alias("views"))
    )


def _name(title):
    """A title as view logs and pages both can spell it: logs join words by underscores."""
    return F.replace(title, F.lit("_"), F.lit(" "))


def write_log(views: DataFrame, path: str) -> None:
    """Store ``views(title, ts)`` as counts by day, one folder for each month.

    Counts are summed before the shuffle, so a page viewed very often is no large group.
    """
    by_day = views.groupBy(
        F.date_format("ts", "yyyy-MM").alias("month"), F.to_date("ts").alias("day"), "title"
    ).agg(F.count("*").alias("views"))
    by_day.write.partitionBy("month").parquet(path)


def views_by_title(spark: SparkSession, path: str, first: str, last: str) -> DataFrame:
    """``(name, views)`` from the months ``first`` to ``last`` (``YYYY-MM``); other folders stay closed."""
    log = spark.read.schema(VIEW_LOG).parquet(path)
    return (
        log.filter(F.col("month").between(first, last))
        .groupBy(_name(F.col("title")).alias("name"))
        .agg(F.sum("views").alias("views"))
    )


def views_of_pages(views: DataFrame, titles: DataFrame) -> DataFrame:
    """``(doc_id, views)`` of ``views(name, views)``, by ``titles(doc_id, title)``.

    Of pages with the same title the one with the smallest id has the views. Titles no page has
    are left out. Both sides have a title once, so no title is a large group.
    """
    first = titles.groupBy(_name(F.col("title")).alias("name")).agg(F.min("doc_id").alias("doc_id"))
    return first.join(views, "name").select("doc_id", "views")
