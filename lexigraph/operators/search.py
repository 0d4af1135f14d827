"""Scoring a whole table of queries against the indexes."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import tokens
from ..functions.scores import BM25_B, BM25_K, bm25_part, ratio
from ..workspace import Workspace
from . import block_max
from .analyze import QUERY, UNSTEMMED, Profile, counts
from .index import Index, squared_norms
from .ranking import min_max_normalize, rank_all, top_k
from .skew import hot_keys, spread_join

# A query-term row is bounded: two tokens of at most 49 characters of four bytes, joiners
# included, and a few numbers, 450 bytes in all. Larger batches are joined by a shuffle.
BROADCAST_BYTES = 100_000_000
BROADCAST_ROWS = BROADCAST_BYTES // 450
# Up to this many distinct terms are sent to the Parquet scan as an IN filter.
PUSHDOWN_TERMS = 10
# Hits of documents that are scored in one task.
HITS_PER_TASK = 10_000_000
# Postings are dealt by document if each is hit by so many queries, on average.
HITS_PER_POSTING = 2


@dataclass(frozen=True)
class TermTable:
    """A stored ``(query_id, term, ...)`` table of counted size."""

    rows: DataFrame

    @cached_property
    def size(self) -> int:
        return self.rows.count()

    @cached_property
    def few_terms(self) -> list[str] | None:
        found = self.rows.select("term").distinct().limit(PUSHDOWN_TERMS + 1).collect()
        return [r["term"] for r in found] if len(found) <= PUSHDOWN_TERMS else None


class QueryBatch:
    """``queries(query_id, query)`` taken apart once.

    ``info``   ``(query_id, n_tokens, n_chars)`` of queries with at least one token
    ``terms``  stemmed terms with their number of repeats
    ``grams``  distinct adjacent pairs
    ``words``  unstemmed words that contract searches look up
    """

    def __init__(
        self, queries: DataFrame, workspace: Workspace, name: str = "batch", profile: Profile = QUERY
    ):
        self.workspace = workspace
        self.name = name
        self.profile = profile
        stored = workspace.write(
            counts(
                queries.filter(F.char_length("query") > 0)
                .withColumn("terms", F.expr(profile.words("query")))
                .withColumn("words", F.expr(UNSTEMMED.indexed(UNSTEMMED.words("query"))))
                .select(
                    "query_id",
                    F.char_length("query").alias("n_chars"),
                    F.size("terms").alias("n_tokens"),
                    F.size("words").alias("n_words"),
                    F.array_distinct(F.expr(tokens.grams("terms"))).alias("grams"),
                    "terms",
                    "words",
                ),
                "terms",
                "words",
            ),
            f"{name}/analyzed",
        )
        self.analyzed = stored
        self.info = stored.filter(F.col("n_tokens") > 0).select("query_id", "n_tokens", "n_chars")

    def _table(self, df: DataFrame, kind: str) -> TermTable:
        return TermTable(self.workspace.write(df, f"{self.name}/{kind}"))

    @cached_property
    def n_queries(self) -> int:
        return self.analyzed.count()

    @cached_property
    def terms(self) -> TermTable:
        return self._table(
            self.analyzed.select("query_id", "n_chars", "n_tokens", F.inline("terms")).withColumnRenamed(
                "tf", "qtf"
            ),
            "terms",
        )

    @cached_property
    def grams(self) -> TermTable:
        return self._table(
            self.analyzed.select(
                "query_id", "n_tokens", F.size("grams").alias("n_grams"), F.explode("grams").alias("term")
            ),
            "grams",
        )

    @cached_property
    def words(self) -> TermTable:
        return self._table(
            self.analyzed.select("query_id", "n_words", F.inline("words")).withColumnRenamed("tf", "qtf"),
            "words",
        )

    @cached_property
    def counted_terms(self) -> TermTable:
        """Terms left after the second stop-word filter, with the query's sum of squares."""
        rows = self.analyzed.select(
            "query_id",
            "n_chars",
            F.filter("terms", lambda t: ~t["term"].isin(list(self.profile.index_stop_words))).alias("terms"),
        )
        squares = F.aggregate(
            F.transform("terms", lambda t: t["tf"].cast("bigint") * t["tf"]),
            F.lit(0).cast("bigint"),
            lambda a, b: a + b,
        )
        return self._table(
            rows.withColumn("sum_qtf2", squares)
            .select("query_id", "n_chars", "sum_qtf2", F.inline("terms"))
            .withColumnRenamed("tf", "qtf"),
            "counted_terms",
        )


def hits(index: Index, queries: TermTable, by_doc: DataFrame | None = None, by_document: bool = False) -> DataFrame:
    """Query terms joined to their postings; terms the index lacks fall out.

    Few terms reach the scan as a filter, more of them open the files that hold them, and a table
    too large to broadcast meets postings bucketed by term, where the index has them.
    ``by_doc(doc_id, ...)`` and lengths of another build are joined on the way. ``by_document`` says
    that the hits of a document are summed: its postings meet before they are repeated for every query.
    """
    rows, small = queries.rows, queries.size <= BROADCAST_ROWS
    tables = [t for t in (index.other_lengths, by_doc) if t is not None]
    if index.segmented:
        kept = index.kept_terms().select("term", "df")
        rows = kept.join(F.broadcast(rows) if small else rows, "term")
    few = queries.few_terms is not None
    if not few and not small and index.buckets is not None:
        return _with_documents(_bucketed_hits(index, rows), tables)
    if few:
        postings = index.postings.filter(F.col("term").isin(queries.few_terms))
    else:
        postings = index.postings_of(queries.rows.select("term")) if small else index.postings
    # Where no term is asked for twice, the hits are no more than the postings.
    repeated = not few or queries.size > len(queries.few_terms)
    if repeated and (tables or by_document and small and not index.segmented):
        postings = _with_documents(_dealt_by_document(index, postings, queries, small, bool(tables)), tables)
    if few or small:
        found = postings.join(F.broadcast(rows), "term")
    else:
        found = spread_join(postings, rows, "term", "doc_id", hot_keys(index.kept_terms(), "term", "df"))
    found = index.live(found)
    return found if repeated else _with_documents(found, tables)


def _with_documents(found: DataFrame, tables: list[DataFrame]) -> DataFrame:
    for table in tables:
        found = found.join(table, "doc_id")
    return found


def _dealt_by_document(index: Index, postings: DataFrame, queries: TermTable, small: bool, always: bool) -> DataFrame:
    """Postings of query terms in parts by document, each of so many hits.

    Tables of documents are joined here, before a posting is repeated for every query that has its
    term: they grow with the corpus, so that past a broadcast each hit would be shuffled and sorted. The
    hits of a document stay in its part, where their sum needs no other shuffle. Unless ``always`` they
    are dealt only where that shuffles fewer rows, postings instead of hits.
    """
    asked = queries.rows.groupBy("term").agg(F.count("*").alias("asked"))
    met = index.kept_terms().select("term", "df").join(F.broadcast(asked) if small else asked, "term")
    n_hits, n_postings = met.agg(F.sum(F.col("df") * F.col("asked")), F.sum("df")).first()
    if not always and (n_hits or 0) < HITS_PER_POSTING * (n_postings or 0):
        return postings
    if small:
        postings = postings.join(F.broadcast(asked.select("term")), "term", "left_semi")
    n_parts = max(int(postings.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-(n_hits or 0) // HITS_PER_TASK))
    return postings.repartition(n_parts, "doc_id")


def _bucketed_hits(index: Index, rows: DataFrame) -> DataFrame:
    """Only the query terms are shuffled, into the buckets of the stored postings."""
    buckets = index.buckets
    key, rows = ["term"], rows.select([c for c in rows.columns if c != "df"])
    if buckets.hot is not None:
        key = ["term", "part"]
        last = F.coalesce("parts", F.lit(1)) - 1
        rows = rows.join(F.broadcast(buckets.hot), "term", "left").withColumn("part", F.explode(F.sequence(F.lit(0), last))).drop("parts")
    placed = rows.repartition(buckets.n, *key).hint("merge")
    return rows.sparkSession.table(buckets.table).join(placed, key).drop("part")


def _sum_scores(parts: DataFrame) -> DataFrame:
    return parts.groupBy("query_id", "doc_id").agg(F.sum("part").alias("score"))


def cosine(
    index: Index,
    batch: QueryBatch,
    norms: DataFrame | None = None,
    k: int = 100,
    normalize: bool = True,
) -> DataFrame:
    """Dot product of tf-idf weights; with ``normalize`` divided by the lengths and scaled.

    The query weight divides by the characters of the raw query. ``norms`` is the stored
    ``(doc_id, norm2)`` table of the index.
    """
    idf = index.idf()
    query_weight = F.col("qtf") / F.col("n_chars") * idf
    doc_weight = F.col("tf") / F.col("doc_len") * idf
    if normalize and norms is None:
        norms = squared_norms(index)
    found = hits(index, batch.counted_terms, norms if normalize else None, by_document=True)
    parts = found.withColumn("part", query_weight * doc_weight)
    if not normalize:
        return top_k(_sum_scores(parts), k)
    scored = (
        parts.groupBy("query_id", "doc_id")
        .agg(F.sum("part").alias("dot"), F.max(F.col("sum_qtf2") * F.col("norm2")).alias("square"))
        .select("query_id", "doc_id", ratio(F.col("dot"), F.sqrt("square")).alias("score"))
    )
    return min_max_normalize(top_k(scored, k))


def bm25(
    index: Index,
    batch: QueryBatch,
    k: int = 100,
    avgdl: float | None = None,
    k1: float = BM25_K,
    b: float = BM25_B,
    queries: TermTable | None = None,
) -> DataFrame:
    """BM25 with idf = log2(N / df); a repeated query word counts each time.

    An index with blocks reads those alone that may hold one of the first ``k``.
    """
    avgdl = index.avgdl if avgdl is None else avgdl
    queries = queries or batch.terms
    if index.blocks is not None:
        scored = block_max.best(index, queries, batch.workspace, k, queries.size <= BROADCAST_ROWS, avgdl, k1, b)
    else:
        part = F.col("qtf") * bm25_part(F.col("tf"), F.col("doc_len"), index.idf(), avgdl, k1, b)
        scored = _sum_scores(hits(index, queries, by_document=True).withColumn("part", part))
    return min_max_normalize(top_k(scored, k))


def title_coverage(index: Index, batch: QueryBatch, k: int = 150) -> DataFrame:
    """Share of the title's raw words that query tokens cover."""
    part = F.col("qtf") * F.col("tf") / F.col("raw_words")
    return min_max_normalize(top_k(_sum_scores(hits(index, batch.terms).withColumn("part", part)), k))


def title_gram_jaccard(
    grams: Index, query_profile_grams: Index, batch: QueryBatch, k: int = 150
) -> DataFrame:
    """Matched grams over the union of the query's and the title's gram sets.

    The title's set is taken under the query profile, which keeps shorter words than the
    index does; its size rides on the postings and its overlap with the query comes from a
    second index.
    """
    matched = hits(grams, batch.grams).select(
        "query_id", "doc_id", "tf", F.lit(0).alias("common"), "n_grams", "n_title_grams"
    )
    common = hits(query_profile_grams, batch.grams).select(
        "query_id", "doc_id", F.lit(0).alias("tf"), F.lit(1).alias("common"), "n_grams", "n_title_grams"
    )
    union = F.max(F.col("n_grams") + F.col("n_title_grams")) - F.sum("common")
    scored = (
        matched.unionByName(common)
        .groupBy("query_id", "doc_id")
        .agg(F.sum("tf").alias("tf"), union.alias("size"))
        .filter(F.col("tf") > 0)
        .select("query_id", "doc_id", (F.col("tf") / F.col("size")).alias("score"))
    )
    return min_max_normalize(top_k(scored, k))


def anchor_count(index: Index, batch: QueryBatch, k: int = 150) -> DataFrame:
    """Occurrences of query tokens in the anchor text of a page."""
    part = (F.col("qtf") * F.col("tf")).cast("double")
    return min_max_normalize(top_k(_sum_scores(hits(index, batch.terms).withColumn("part", part)), k))


def body_grams(index: Index, batch: QueryBatch, by_count: int = 150, k: int = 100) -> DataFrame:
    """Cut by the number of matched grams, then by their share of the body."""
    scored = (
        hits(index, batch.grams)
        .groupBy("query_id", "doc_id")
        .agg(
            F.sum(F.col("tf") / F.col("doc_len")).alias("score"),
            F.count("*").alias("matched"),
        )
    )
    first = top_k(scored, by_count, by="matched").drop("rank")
    return min_max_normalize(top_k(first, k))


def body_cosine(
    index: Index, batch: QueryBatch, norms: DataFrame | None = None, k: int = 100
) -> DataFrame:
    """Plain cosine of unstemmed tf-idf vectors."""
    norms = squared_norms(index) if norms is None else norms
    weight = F.col("qtf") / F.col("n_words") * index.idf()
    words = batch.words.rows
    if batch.words.size <= BROADCAST_ROWS:
        words = F.broadcast(words)
    known = index.kept_terms().join(words, "term")
    lengths = known.groupBy("query_id").agg(F.sum(F.pow(weight, F.lit(2.0))).alias("query2"))
    part = weight * (F.col("tf") / F.col("doc_len") * index.idf())
    dots = (
        hits(index, batch.words, norms)
        .withColumn("part", part)
        .groupBy("query_id", "doc_id")
        .agg(F.sum("part").alias("dot"), F.max("norm2").alias("norm2"))
    )
    if batch.n_queries <= BROADCAST_ROWS:
        lengths = F.broadcast(lengths)
    scored = dots.join(lengths, "query_id").select(
        "query_id",
        "doc_id",
        ratio(F.col("dot"), F.sqrt("query2") * F.sqrt("norm2")).alias("score"),
    )
    return top_k(scored, k)


def word_match(index: Index, batch: QueryBatch, name: str) -> DataFrame:
    """All documents with a query word, by the number of distinct query words."""
    found = hits(index, batch.words).groupBy("query_id", "doc_id").agg(
        F.count("*").alias("score")
    )
    return rank_all(found, batch.workspace, f"{batch.name}/{name}")
