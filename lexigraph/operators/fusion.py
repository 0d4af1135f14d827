"""Weighted sums of result lists, the routed search and its titles."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import search as S
from .index import Index
from .ranking import top_k

# The fusion weights of the reference, as numerator and denominator. A score
# is multiplied and then divided, as there, which rounds differently from one factor.
ONE_WORD = {"title": (10, 20), "anchor": (10, 20)}
BASE = {"title": (7, 16), "body": (1, 16), "anchor": (7, 16)}
BASE_SHARE = (1, 10)
TITLE_GRAM_SHARE = (9, 10)
BODY_GRAM_BONUS = (1, 10)
NOTEBOOK = {"title": (7, 16), "body": (1, 16)}
SEARCH_RESULTS = 30
NOTEBOOK_RESULTS = 100

# Sums of sixteenths end on the digit that rounding to six places cuts at; ten places do
# not meet them, and sums of numbers below one are still far more exact than that.
FUSED_DIGITS = 10


@dataclass(frozen=True)
class SearchIndexes:
    title: Index
    title_grams: Index
    title_query_grams: Index
    body: Index
    body_grams: Index
    anchor: Index


def times(score: Column, weight: tuple[int, int]) -> Column:
    return score * weight[0] / weight[1]


def weighted(scored: DataFrame, weight: tuple[int, int]) -> DataFrame:
    return scored.select("query_id", "doc_id", times(F.col("score"), weight).alias("part"))


def fuse(lists: Sequence[DataFrame]) -> DataFrame:
    """Sum of already weighted lists; a document missing from a list adds nothing.

    A list has a document once per query. The lists are added in the order given, so the
    sum does not depend on which row a shuffle delivers first.
    """
    tagged = [part.withColumn("list", F.lit(i)) for i, part in enumerate(lists)]
    parts = [
        F.coalesce(F.sum(F.when(F.col("list") == i, F.col("part"))), F.lit(0.0))
        for i in range(len(lists))
    ]
    rows = reduce(DataFrame.unionByName, tagged)
    return rows.groupBy("query_id", "doc_id").agg(reduce(Column.__add__, parts).alias("score"))


def fuse_one_word(ix: SearchIndexes, batch: S.QueryBatch) -> DataFrame:
    return fuse(
        [
            weighted(S.title_coverage(ix.title, batch), ONE_WORD["title"]),
            weighted(S.anchor_count(ix.anchor, batch), ONE_WORD["anchor"]),
        ]
    )


def fuse_base(ix: SearchIndexes, batch: S.QueryBatch) -> DataFrame:
    return fuse(
        [
            weighted(S.title_coverage(ix.title, batch), BASE["title"]),
            weighted(S.bm25(ix.body, batch), BASE["body"]),
            weighted(S.anchor_count(ix.anchor, batch), BASE["anchor"]),
        ]
    )


def _gram_parts(ix: SearchIndexes, batch: S.QueryBatch, use_body_score: bool) -> list[DataFrame]:
    titles = S.title_gram_jaccard(ix.title_grams, ix.title_query_grams, batch)
    bodies = S.body_grams(ix.body_grams, batch)
    if not use_body_score:
        bodies = bodies.withColumn("score", F.lit(1.0))
    return [weighted(titles, TITLE_GRAM_SHARE), weighted(bodies, BODY_GRAM_BONUS)]


def fuse_multi_word(
    ix: SearchIndexes, batch: S.QueryBatch, use_body_score: bool = False
) -> DataFrame:
    """Base fusion and title grams, plus the same bonus for every body-gram result.

    ``use_body_score`` weighs the bonus by the body-gram score instead.
    """
    base = weighted(fuse_base(ix, batch), BASE_SHARE)
    return fuse([base, *_gram_parts(ix, batch, use_body_score)])


def search(
    ix: SearchIndexes,
    batch: S.QueryBatch,
    titles: DataFrame,
    k: int = SEARCH_RESULTS,
    use_body_score: bool = False,
) -> DataFrame:
    """Route each query by its number of tokens and return titled results.

    One token: title and anchor. More: the multi-word fusion. None: no rows. Both routes
    read the title and anchor lists, so each list is scored once for all queries and only
    its weight depends on the route. The other lists hold what multi-token queries match.
    """
    route = batch.info.select("query_id", "n_tokens")
    one = F.col("n_tokens") == 1

    def routed(scored: DataFrame, several: tuple[int, int], alone: tuple[int, int]) -> DataFrame:
        score = F.col("score")
        part = F.when(one, times(score, alone)).otherwise(times(score, several))
        return _with_route(scored, route, batch).select("query_id", "doc_id", part.alias("part"))

    # A one-token query has no grams; its body list is dropped before scoring.
    multi = S.TermTable(batch.terms.rows.filter(F.col("n_tokens") > 1))
    base = fuse(
        [
            routed(S.title_coverage(ix.title, batch), BASE["title"], ONE_WORD["title"]),
            weighted(S.bm25(ix.body, batch, queries=multi), BASE["body"]),
            routed(S.anchor_count(ix.anchor, batch), BASE["anchor"], ONE_WORD["anchor"]),
        ]
    )
    fused = fuse(
        [routed(base, BASE_SHARE, (1, 1)), *_gram_parts(ix, batch, use_body_score)]
    )
    return attach_titles(top_k(fused, k, digits=FUSED_DIGITS), titles, batch.n_queries * k)


def _with_route(scored: DataFrame, route: DataFrame, batch: S.QueryBatch) -> DataFrame:
    if batch.n_queries <= S.BROADCAST_ROWS:
        route = F.broadcast(route)
    return scored.join(route, "query_id")


def attach_titles(ranked: DataFrame, titles: DataFrame, max_rows: int) -> DataFrame:
    """Add titles; ids become strings. ``max_rows`` bounds the size of ``ranked``."""
    if max_rows <= S.BROADCAST_ROWS:
        ranked = F.broadcast(ranked)
    return titles.join(ranked, "doc_id").select(
        "query_id", "rank", F.col("doc_id").cast("string").alias("doc_id"), "title", "score"
    )


def fuse_notebook(
    title: Index, body: Index, batch: S.QueryBatch, titles: DataFrame, k: int = NOTEBOOK_RESULTS
) -> DataFrame:
    """Unnormalized cosine on title and body."""
    fused = fuse(
        [
            weighted(S.cosine(title, batch, normalize=False), NOTEBOOK["title"]),
            weighted(S.cosine(body, batch, normalize=False), NOTEBOOK["body"]),
        ]
    )
    return attach_titles(top_k(fused, k, digits=FUSED_DIGITS), titles, batch.n_queries * k)
