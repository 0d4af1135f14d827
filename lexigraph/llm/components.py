"""Connected components of links between long identifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.skew import ROWS_PER_TASK, hot_keys, spread_join
from ..workspace import Workspace


def _ordered(a: str, b: str) -> list:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _look_up(rows: DataFrame, small: DataFrame, key: str, spread_by: str, rows_per_task: int) -> DataFrame:
    """``rows`` (stored) inner join ``small``, which has each key once; hubs go to several tasks."""
    if rows.count() <= rows_per_task:
        return rows.join(small, key)
    counted = rows.groupBy(key).agg(F.count("*").alias("rows"))
    return spread_join(rows, small, key, spread_by, hot_keys(counted, key, "rows", rows_per_task))


def components(links: DataFrame, work: Workspace, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``node, root`` for every end of ``links (a, b)``; the root is the smallest node reachable.

    Each round hooks every node to its smallest neighbour, shortens the chains by pointer
    jumping and contracts the links; at least half of the nodes that still have links are
    gone after each. All state is written to the shared folder, so that a lost executor
    costs one step; nothing but counts reaches the driver. The hub of a star or of a giant
    component is a key of very many rows: beyond ``rows_per_task`` such keys are divided.
    """
    left = work.write(links.filter("a <> b").select(*_ordered("a", "b")).distinct(), "links")
    rounds: list[DataFrame] = []
    while not left.isEmpty():
        both = left.union(left.select("b", "a"))
        near = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
        parent = work.write(near.select("node", F.least("node", "root").alias("root")), "hooked")
        while True:
            up = parent.select(F.col("node").alias("root"), F.col("root").alias("next"))
            jumped = work.write(_look_up(parent, up, "root", "node", rows_per_task).select("node", "root", "next"), "jumped")
            parent = jumped.select("node", F.col("next").alias("root"))
            if jumped.filter("root <> next").isEmpty():
                break
        rounds.append(parent)
        for end, other in (("a", "b"), ("b", "a")):
            at = parent.select(F.col("node").alias(end), "root")
            left = _look_up(left, at, end, other, rows_per_task).select(F.col("root").alias(end), other)
            left = work.write(left, "contracted")
        left = work.write(left.filter("a <> b").select(*_ordered("a", "b")).distinct(), "links")
    if not rounds:
        return left.select(F.col("a").alias("node"), F.col("b").alias("root"))
    labels = rounds[0]
    for parent in rounds[1:]:
        up = parent.select(F.col("node").alias("root"), F.col("root").alias("next"))
        # Roots that got no further parent are their own, so that no row is lost.
        last = labels.select("root").distinct().join(up.select("root"), "root", "left_anti").select("root", F.col("root").alias("next"))
        labels = _look_up(labels, up.union(last), "root", "node", rows_per_task).select("node", F.col("next").alias("root"))
        labels = work.write(labels, "labels")
    return labels
