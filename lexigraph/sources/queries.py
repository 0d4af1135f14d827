"""Query tables and relevance judgements made from benchmark passages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators.analyze import spread
from ..operators.skew import hot_keys, spread_join
from ..workspace import Workspace


# Rows of a word and a number.
BROADCAST_ROWS = 500_000


def read_benchmark(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(schemas.BENCHMARK).parquet(f"{folder}/benchmark.parquet")


def passage_queries(benchmark: DataFrame) -> DataFrame:
    """Two queries per passage: the whole passage (even id) and its longest word (odd id)."""
    words = F.split("text", r"\s+")
    longest = F.array_max(
        F.transform(words, lambda w: F.struct(F.char_length(w).alias("n"), w.alias("w")))
    )["w"]
    both = F.array(
        F.struct((F.col("item_id") * 2).alias("query_id"), F.col("text").alias("query")),
        F.struct((F.col("item_id") * 2 + 1).alias("query_id"), longest.alias("query")),
    )
    return benchmark.select(F.inline(both))


def passage_relevance(
    benchmark: DataFrame, docs: DataFrame, workspace: Workspace, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """``qrels(query_id, doc_id)``: documents whose text contains the whole passage.

    A document that contains a passage contains the words inside it, so each passage is
    looked up by the rarest of its inner words, and only the documents found that way are
    read in full. Passages of fewer than three words have no inner word and are compared
    with every text.
    """
    words = F.split("text", r"\s+")
    inner = benchmark.select(
        "item_id",
        F.explode(F.array_distinct(F.slice(words, 2, F.greatest(F.size(words) - 2, F.lit(0))))).alias("word"),
    ).filter("word <> ''")
    inner = workspace.write(inner, "queries/inner_words")
    wanted = inner.select("word").distinct()
    few = inner.count() <= broadcast_rows
    doc_words = spread(docs.select("id", "text")).select(
        F.col("id").alias("doc_id"), F.explode(F.array_distinct(F.split("text", r"\s+"))).alias("word")
    )
    # The texts are taken apart once; what is left of them are the wanted words.
    met_words = workspace.write(doc_words.join(F.broadcast(wanted) if few else wanted, "word", "left_semi"), "queries/doc_words")
    df = met_words.groupBy("word").agg(F.count("*").alias("df"))
    rarest = inner.join(df, "word").groupBy("item_id").agg(F.min_by("word", F.struct("df", "word")).alias("word"))
    if few:
        met = met_words.join(F.broadcast(rarest), "word")
    else:
        keyed = workspace.write(rarest, "queries/rarest_words")
        picked = df.join(keyed.select("word").distinct(), "word", "left_semi")
        met = spread_join(met_words, keyed, "word", "doc_id", hot_keys(picked, "word", "df"))
    passages = benchmark.withColumnRenamed("text", "passage")
    candidates = workspace.write(met.join(passages, "item_id").select("doc_id", "item_id", "passage"), "queries/candidates")
    texts = docs.select(F.col("id").alias("doc_id"), "text")
    pairs = texts.join(candidates, "doc_id").filter(F.contains("text", "passage")).select("item_id", "doc_id")
    short = passages.join(inner, "item_id", "left_anti").filter("passage IS NOT NULL")
    if not short.isEmpty():
        # A given query set against all texts.
        pairs = pairs.union(texts.join(short, F.contains("text", "passage")).select("item_id", "doc_id"))
    return pairs.select(
        F.explode(F.array(F.col("item_id") * 2, F.col("item_id") * 2 + 1)).alias("query_id"),
        "doc_id",
    )
