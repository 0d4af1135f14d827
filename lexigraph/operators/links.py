"""The link graph and PageRank."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..workspace import Workspace
from .skew import ROWS_PER_TASK, hot_keys

RESET = 0.15
ITERATIONS = 6


def edges(links: DataFrame) -> DataFrame:
    """Distinct ``(src, dst)``; self-links stay."""
    return links.select("src", "dst").distinct()


def vertices(edge_rows: DataFrame) -> DataFrame:
    """Every endpoint of an edge with its number of out-links."""
    ends = edge_rows.select(
        F.inline(
            F.array(
                F.struct(F.col("src").alias("id"), F.lit(1).alias("out")),
                F.struct(F.col("dst").alias("id"), F.lit(0).alias("out")),
            )
        )
    )
    return ends.groupBy("id").agg(F.sum("out").alias("outdeg"))


def _step(out_edges: DataFrame, ranks: DataFrame, key: list[str], reset: float) -> DataFrame:
    """One iteration: ``ranks(id, outdeg, parts, r)`` with new ``r``; the edges are read once.

    ``out_edges`` is bucketed by the key, so that only the ranks and the partially summed
    messages are shuffled.
    """
    shares = ranks.filter(F.col("outdeg") > 0).select(
        F.col("id").alias("src"), "parts", (F.col("r") / F.col("outdeg")).alias("share")
    )
    if "part" in key:
        shares = shares.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    received = out_edges.join(shares.drop("parts"), key).select(
        F.col("dst").alias("id"), "share", F.lit(0).cast("bigint").alias("outdeg"), F.lit(0).alias("parts")
    )
    kept = ranks.select("id", F.lit(0.0).alias("share"), "outdeg", "parts")
    return (
        received.unionByName(kept)
        .groupBy("id")
        .agg(
            (F.lit(reset) + (1 - reset) * F.sum("share")).alias("r"),
            F.max("outdeg").alias("outdeg"),
            F.max("parts").alias("parts"),
        )
    )


def pagerank(
    edge_rows: DataFrame,
    workspace: Workspace,
    iterations: int = ITERATIONS,
    reset: float = RESET,
    name: str = "pagerank",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """``(id, pagerank)``, scaled so that the ranks sum to the number of vertices.

    Edges are written once, bucketed and sorted by source, below the shared folder; every
    iteration joins them once and writes its ranks there. A source with very many out-links is
    divided by target into several parts, its rank repeated for each.
    """
    spark = edge_rows.sparkSession
    edge_rows = workspace.write(edge_rows, f"{name}/edges")
    nodes = workspace.write(vertices(edge_rows), f"{name}/vertices")
    hot = hot_keys(nodes.withColumnRenamed("id", "src"), "src", "outdeg", rows_per_task)
    key = ["src"] if hot is None else ["src", "part"]
    if hot is None:
        parted, ranks = edge_rows, nodes.withColumn("parts", F.lit(1))
    else:
        hot = F.broadcast(workspace.write(hot, f"{name}/hot"))
        part = F.coalesce(F.pmod(F.xxhash64("dst"), F.col("parts")), F.lit(0)).cast("int")
        parted = edge_rows.join(hot, "src", "left").withColumn("part", part).drop("parts")
        ranks = nodes.join(hot.withColumnRenamed("src", "id"), "id", "left").withColumn(
            "parts", F.coalesce("parts", F.lit(1))
        )
    n_parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-edge_rows.count() // rows_per_task))
    path = workspace.fresh(f"{name}/edges_by_source")
    table = "edges_" + path.rpartition("-")[2]
    # Repartitioned first, so that each bucket is one file.
    (
        parted.repartition(n_parts, *key)
        .write.bucketBy(n_parts, *key)
        .sortBy(*key)
        .option("path", path)
        .saveAsTable(table)
    )
    out_edges = spark.table(table)
    ranks = ranks.withColumn("r", F.lit(1.0))
    for i in range(1, iterations + 1):
        ranks = workspace.write(_step(out_edges, ranks, key, reset), f"{name}/ranks_{i}")
    # The files stay below the shared folder; only the name goes.
    spark.sql(f"DROP TABLE {table}")
    totals = ranks.agg(F.count("*").alias("n"), F.sum("r").alias("r")).first()
    scale = totals["n"] / totals["r"] if totals["n"] else 1.0
    return ranks.select("id", (F.col("r") * scale).alias("pagerank"))
