"""Exact BM25 top-k over blocks of postings with maxima.

Documents are divided into ranges of ids, the same ones for every term. A block holds a term's
postings in one range, with the largest ``tf`` and the smallest ``doc_len`` among them, between
which BM25's part is largest, whatever its constants are. Summed over a query's terms, these
parts bound the score of any document in the range. The ranges of the highest bounds are scored
first; their k-th score is a threshold, and of the others only ranges whose bound reaches it are
read. What is left out cannot be among the first k, so the result is that of scoring all postings.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scores import bm25_part
from ..workspace import COMPRESSION, Workspace
from .index import Index
from .ranking import top_k
from .skew import ROWS_PER_TASK, hot_keys, spread_join

DOCS_PER_RANGE = 128
# Bounds and scores are sums in different orders; a bound this much lower still counts as reached.
SLACK = 1e-9


@dataclass(frozen=True)
class Blocks:
    """``(term, range, df, max_tf, min_len, n, postings)``, ordered by term and range."""

    rows: DataFrame

    @property
    def bounds(self) -> DataFrame:
        """The blocks without their postings, which are not read."""
        return self.rows.drop("postings")


def block_postings(
    index: Index, workspace: Workspace, name: str, docs_per_range: int = DOCS_PER_RANGE, rows_per_task: int = ROWS_PER_TASK
) -> Index:
    """The index with its postings stored in blocks as well, over which ``bm25`` then runs.

    Ranges have equal widths, by the number of documents between the smallest and the largest id.
    """
    spark = index.doc_stats.sparkSession
    low, high, n_docs = index.doc_stats.agg(F.min("doc_id"), F.max("doc_id"), F.count("*")).first()
    width = 1 if not n_docs else max(1, (high - low + 1) * docs_per_range // n_docs)
    n_rows = index.kept_terms().agg(F.sum("df")).first()[0] or 0
    n_parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_rows // rows_per_task))
    blocks = (
        index.all_postings()
        .withColumn("range", F.floor((F.col("doc_id") - F.lit(low or 0)) / width).cast("bigint"))
        # The one shuffle: ranges of (term, range) keep each block whole, so that grouping needs no other.
        .repartitionByRange(n_parts, "term", "range")
        .groupBy("term", "range")
        .agg(
            F.first("df").alias("df"),
            F.max("tf").alias("max_tf"),
            F.min("doc_len").alias("min_len"),
            F.count("*").alias("n"),
            F.sort_array(F.collect_list(F.struct("doc_id", "tf", "doc_len"))).alias("postings"),
        )
        .sortWithinPartitions("term", "range")
    )
    return replace(index, blocks=Blocks(workspace.write(blocks, f"{name}/blocks", COMPRESSION)))


def range_bounds(index: Index, queries, small: bool, avgdl: float, k1: float, b: float) -> DataFrame:
    """``(query_id, term, range, qtf, bound)`` for each block of a query's term.

    A part below zero, of a term in more documents than the index counts, is bounded by zero.
    """
    rows = queries.rows.select("query_id", "term", "qtf")
    bounds = index.blocks.bounds
    if queries.few_terms is not None:
        met = bounds.filter(F.col("term").isin(queries.few_terms)).join(F.broadcast(rows), "term")
    elif small:
        met = bounds.join(F.broadcast(rows), "term")
    else:
        met = spread_join(bounds, rows, "term", "range", hot_keys(index.kept_terms(), "term", "df"))
    part = F.col("qtf") * bm25_part(F.col("max_tf"), F.col("min_len"), index.idf(), avgdl, k1, b)
    return met.select("query_id", "term", "range", "qtf", F.greatest(part, F.lit(0.0)).alias("bound"))


def _scores(index: Index, chosen: DataFrame, avgdl: float, k1: float, b: float) -> DataFrame:
    """Scores of all documents in ``chosen(query_id, term, range, qtf)``."""
    part = F.col("qtf") * bm25_part(F.col("tf"), F.col("doc_len"), index.idf(), avgdl, k1, b)
    return (
        index.blocks.rows.select("term", "range", "df", "postings")
        .join(chosen, ["term", "range"])
        .select("query_id", "qtf", "df", F.inline("postings"))
        .groupBy("query_id", "doc_id")
        .agg(F.sum(part).alias("score"))
    )


def best(
    index: Index, queries, workspace: Workspace, k: int, small: bool, avgdl: float, k1: float, b: float
) -> DataFrame:
    """``(query_id, doc_id, score)``: a superset of each query's first ``k``, all scored in full."""
    met = workspace.write(range_bounds(index, queries, small, avgdl, k1, b), "block_max/met")
    ranges = met.groupBy("query_id", "range").agg(F.sum("bound").alias("bound"))
    order = Window.partitionBy("query_id").orderBy(F.desc("bound"), "range")
    # Each range has a document at least, so those of the k best bounds hold k documents, and
    # likely the best ones; a threshold from fewer ranges would be much lower.
    leading = ranges.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k).select("query_id", "range")
    leading = workspace.write(leading, "block_max/leading")
    first = workspace.write(
        _scores(index, met.join(leading, ["query_id", "range"]).select("query_id", "term", "range", "qtf"), avgdl, k1, b),
        "block_max/first",
    )
    threshold = (
        top_k(first, k).filter(F.col("rank") == k).select("query_id", (F.col("score") - F.abs("score") * SLACK).alias("least"))
    )
    # A query without k documents so far has had all its ranges scored.
    open_ranges = (
        ranges.join(leading, ["query_id", "range"], "left_anti")
        .join(threshold, "query_id")
        .filter(F.col("bound") >= F.col("least"))
        .select("query_id", "range")
    )
    rest = met.join(open_ranges, ["query_id", "range"]).select("query_id", "term", "range", "qtf")
    rest = workspace.write(rest, "block_max/rest")
    return first.unionByName(_scores(index, rest, avgdl, k1, b))
