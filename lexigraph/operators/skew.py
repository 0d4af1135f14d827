"""Equi-joins whose key may be held by a large share of the big side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS_PER_TASK = 2_000_000
MAX_HOT_KEYS = 10_000


def hot_keys(counted: DataFrame, key: str, rows: str, rows_per_task: int = ROWS_PER_TASK):
    """``(key, parts)`` for the keys to be split, or None when there are none.

    ``rows`` is each key's number of rows on the big side. The threshold is at least a
    ten-thousandth of all rows, so no more than ``MAX_HOT_KEYS`` keys can pass it: the
    result may be broadcast whatever the data.
    """
    total, top = counted.agg(F.sum(rows), F.max(rows)).first()
    threshold = max(rows_per_task, (total or 0) // MAX_HOT_KEYS)
    if (top or 0) <= threshold:
        return None
    return counted.filter(F.col(rows) > threshold).select(
        key, F.ceil(F.col(rows) / threshold).cast("int").alias("parts")
    )


def spread_join(
    big: DataFrame, small: DataFrame, key: str, spread_by: str, hot: DataFrame | None
) -> DataFrame:
    """``big`` inner join ``small`` on ``key``; the rows of hot keys go to several tasks.

    ``hot`` comes from :func:`hot_keys`. Rows of a hot key are divided by the hash of
    ``spread_by``; the matching row of ``small`` is repeated once per part.
    """
    if hot is None:
        return big.join(small, key)
    hot = F.broadcast(hot)
    part = F.coalesce(F.pmod(F.xxhash64(spread_by), F.col("parts")), F.lit(0)).cast("int")
    last = F.coalesce(F.col("parts"), F.lit(1)) - 1
    divided = big.join(hot, key, "left").withColumn("part", part).drop("parts")
    repeated = (
        small.join(hot, key, "left")
        .withColumn("part", F.explode(F.sequence(F.lit(0), last)))
        .drop("parts")
    )
    return divided.join(repeated, [key, "part"]).drop("part")
