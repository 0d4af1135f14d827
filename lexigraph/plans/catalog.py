"""Every operator as a query over the test tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import tokens
from ..functions.stem import stem_array
from ..operators import evaluation, fusion, links, lookup, search
from ..operators import index as ix
from ..operators.analyze import INDEX, QUERY, Profile, positions, spread
from ..operators.block_max import block_postings
from ..operators.build import IndexSet
from ..operators.ranking import min_max_normalize, rank_all
from ..operators.search import QueryBatch
from ..operators.segments import SegmentedIndex
from ..functions.scores import REFERENCE_AVGDL
from ..sources import corpus as corpora
from ..sources import pages as page_source
from ..sources import queries as query_source
from ..sources.pageviews import monthly_views, views_by_title, views_of_pages, write_log
from ..workspace import Workspace

DIGITS = 9
VIEW_MONTH = "2024-01-01"


class Tables:
    """What the queries over one folder share; each part is built on first use."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self.workspace = Workspace(spark, folder)

    @cached_property
    def corpus(self) -> corpora.Corpus:
        return corpora.documents_corpus(self.spark, self.folder, self.workspace)

    @cached_property
    def indexes(self) -> IndexSet:
        return IndexSet(self.corpus, self.workspace)

    @cached_property
    def extended(self) -> tuple[IndexSet, QueryBatch]:
        """Indexes and queries stemmed by the extended rules."""
        index, query = replace(INDEX, extended=True), replace(QUERY, extended=True)
        queries = query_source.passage_queries(self.benchmark)
        return (
            IndexSet(self.corpus, self.workspace, profile=index, query_profile=query),
            QueryBatch(queries, self.workspace, "extended_batch", query),
        )

    @cached_property
    def other_build(self) -> IndexSet:
        """Bodies and web pages, read with two-letter words and without stop words."""
        pages = page_source.parse_pages(self.read("pages", schemas.PAGES))
        more = pages.select((-1 - F.col("page_id")).alias("id"), "title", "text")
        wider = corpora.Corpus(self.corpus.docs.unionByName(more), self.corpus.links)
        return IndexSet(wider, self.workspace, profile=Profile(min_chars=2, stop_words=(), index_stop_words=()))

    @cached_property
    def segmented(self) -> SegmentedIndex:
        """The bodies, added in batches; two thirds of them replace or follow earlier versions.

        The first batch has a third of the bodies, the titles of another third in place of their
        bodies, and web pages that are removed again.
        """
        def third(rows: DataFrame, k: int) -> DataFrame:
            return rows.filter(F.pmod("doc_id", F.lit(3)) == k)

        body, title = (self.indexes.flat(c).select("doc_id", "term", "tf", "doc_len") for c in ("body", "title"))
        bodies, titles = self.indexes.doc_stats("body"), self.indexes.doc_stats("title")
        stray = third(title, 0).withColumn("doc_id", -1 - F.col("doc_id"))
        strays = third(titles, 0).withColumn("doc_id", -1 - F.col("doc_id"))
        index = SegmentedIndex.open(self.spark, self.workspace.fresh("segments"), "body")
        index = index.append(
            third(body, 0).unionByName(third(title, 1)).unionByName(stray),
            third(bodies, 0).unionByName(third(titles, 1)).unionByName(strays),
        )
        index = index.remove(strays.unionByName(third(titles, 1)))
        index = index.append(third(body, 1), third(bodies, 1))
        return index.append(third(body, 2), third(bodies, 2))

    @cached_property
    def stored_corpus(self) -> corpora.Corpus:
        """The corpus as files of several folders, among others that are no part of it."""
        root = self.workspace.fresh("stored_corpus")
        nested = corpora.with_anchor_text(self.corpus)
        for k in range(3):
            nested.filter(F.pmod("id", F.lit(3)) == k).write.parquet(f"{root}/part_{k}")
        stray = nested.select((F.col("id") + 1_000_000).alias("id"), "title", "text", "anchor_text")
        for name in ("stray", "bucket_title", "bucket_body"):
            stray.write.parquet(f"{root}/{name}")
        self.benchmark.write.json(f"{root}/notes")
        return corpora.scan(self.spark, root, "*.parquet", exclude=["stray"], exclude_prefixes=["bucket_"])

    @cached_property
    def benchmark(self) -> DataFrame:
        return query_source.read_benchmark(self.spark, self.folder)

    @cached_property
    def batch(self) -> QueryBatch:
        return QueryBatch(query_source.passage_queries(self.benchmark), self.workspace)

    @cached_property
    def qrels(self) -> DataFrame:
        return self.workspace.write(
            query_source.passage_relevance(self.benchmark, self.corpus.docs, self.workspace),
            "queries/qrels",
        )

    @cached_property
    def results(self) -> DataFrame:
        found = fusion.search(self.indexes.for_search, self.batch, self.corpus.titles())
        return self.workspace.write(
            found.withColumn("doc_id", F.col("doc_id").cast("bigint")), "queries/results"
        )

    @cached_property
    def edges(self) -> DataFrame:
        return links.edges(self.corpus.links)

    @cached_property
    def pagerank(self) -> DataFrame:
        return self.workspace.write(
            links.pagerank(self.edges, self.workspace), "pagerank/final"
        )

    @cached_property
    def ids(self) -> DataFrame:
        """A list to look values up for: backwards, every third id again, with unknown ids."""
        ids = self.corpus.docs.select(F.col("id").alias("doc_id"))
        again = ids.filter("doc_id % 3 = 0").select("doc_id", (-F.col("doc_id") * 10 + 1).alias("pos"))
        unknown = ids.select((-7 - F.col("doc_id")).alias("doc_id"), (-F.col("doc_id") * 10 + 2).alias("pos"))
        return ids.withColumn("pos", -F.col("doc_id") * 10).unionByName(again).unionByName(unknown)

    def read(self, table: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{table}.parquet")


_OPEN: dict[tuple[str, str], Tables] = {}


def tables(spark: SparkSession, folder: str) -> Tables:
    key = (spark.conf.get("spark.app.id"), folder)
    if key not in _OPEN:
        _OPEN[key] = Tables(spark, folder)
    return _OPEN[key]


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build: Callable[[Tables], DataFrame]):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(tables(spark, folder))

    run.__doc__ = build.__doc__
    QUERIES[build.__name__] = run
    return build


def _round(df: DataFrame, *columns: str, digits: int = DIGITS) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _fused(df: DataFrame) -> DataFrame:
    return _round(df, "score", digits=fusion.FUSED_DIGITS)


def _ranked(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    return _round(df.select("query_id", "doc_id", "rank", "score"), "score", digits=digits)


# Scans, sources, sinks


@query
def corpus_scan(t: Tables) -> DataFrame:
    nested = corpora.with_anchor_text(t.stored_corpus)
    anchors = F.transform("anchor_text", lambda a: F.concat_ws(":", a["id"].cast("string"), a["text"]))
    return nested.select(
        "id", "title", "text", F.coalesce(F.array_join(anchors, "|"), F.lit("")).alias("anchors")
    )


@query
def field_projection(t: Tables) -> DataFrame:
    title, body, anchor = (
        t.corpus.field(f).withColumn("field", F.lit(f)) for f in ("title", "body", "anchor")
    )
    return title.unionByName(body).unionByName(anchor)


@query
def page_parse(t: Tables) -> DataFrame:
    parsed = page_source.parse_pages(t.read("pages", schemas.PAGES))
    return parsed.select("page_id", "title", "text", F.size("anchors").alias("n_links"))


@query
def page_link_parse(t: Tables) -> DataFrame:
    return page_source.page_links(page_source.parse_pages(t.read("pages", schemas.PAGES)))


@query
def index_round_trip(t: Tables) -> DataFrame:
    built = t.indexes.index("body")
    root = t.workspace.fresh("round_trip")
    ix.write_index(built, root, "body")
    return ix.read_index(t.spark, root, "body").postings.select("term", "doc_id", "tf", "df", "doc_len")


@query
def index_after_adding(t: Tables) -> DataFrame:
    """Postings of the bodies over twenty documents, from an index that was added to and removed from."""
    return t.segmented.read(20).all_postings().select("term", "doc_id", "tf", "df", "doc_len")


@query
def statistics_after_adding(t: Tables) -> DataFrame:
    """Document and collection frequencies, added up over segments and removals."""
    return t.segmented.read().term_stats


@query
def bm25_after_adding(t: Tables) -> DataFrame:
    return _ranked(search.bm25(t.segmented.read(20), t.batch))


@query
def bm25_after_merge(t: Tables) -> DataFrame:
    """The same search when all segments were written as one."""
    return _ranked(search.bm25(t.segmented.merge().read(20), t.batch))


@query
def body_search_stored(t: Tables) -> DataFrame:
    """The contract's body search over an index that was stored and read again."""
    root = t.workspace.fresh("stored_words")
    ix.write_index(t.indexes.index("body_words"), root, "body_words")
    return _ranked(search.body_cosine(ix.read_index(t.spark, root, "body_words"), t.batch))


@query
def stats_from_other_build(t: Tables) -> DataFrame:
    """Body postings scored with lengths, size and norms of a build of more and longer texts."""
    other = t.other_build
    mixed = t.indexes.index("body").with_stats_of(other.index("body"), same_component=True)
    by_bm25 = _ranked(search.bm25(mixed, t.batch)).withColumn("model", F.lit("bm25"))
    by_cosine = _ranked(search.cosine(mixed, t.batch, other.norms("body"))).withColumn("model", F.lit("cosine"))
    return by_bm25.unionByName(by_cosine)


# Text


def _body(t: Tables) -> DataFrame:
    return spread(t.corpus.field("body"))


@query
def tokens_index_profile(t: Tables) -> DataFrame:
    return positions(_body(t), tokens.tokens("text", tokens.INDEX_MIN_CHARS))


@query
def tokens_query_profile(t: Tables) -> DataFrame:
    return positions(_body(t), tokens.tokens("text", tokens.QUERY_MIN_CHARS))


@query
def stopword_filter_pre(t: Tables) -> DataFrame:
    return positions(_body(t), tokens.without(tokens.tokens("text")))


@query
def stem_vocabulary(t: Tables) -> DataFrame:
    """Each distinct word of the bodies, as the query profile reads them, and its stem."""
    return _vocabulary(t, extended=False)


@query
def stem_vocabulary_extended(t: Tables) -> DataFrame:
    return _vocabulary(t, extended=True)


def _vocabulary(t: Tables, extended: bool) -> DataFrame:
    words = positions(_body(t), tokens.tokens("text", tokens.QUERY_MIN_CHARS))
    stem = stem_array("array(word)", extended=extended)
    return (
        words.select(F.col("term").alias("word"))
        .distinct()
        .withColumn("stem", F.expr(f"{stem}[0]"))
    )


@query
def stopword_filter_post(t: Tables) -> DataFrame:
    return positions(_body(t), INDEX.indexed(INDEX.words("text")))


@query
def bigrams(t: Tables) -> DataFrame:
    """The set of adjacent pairs of each body."""
    arrays = _body(t).withColumn("words", F.expr(INDEX.words("text")))
    return arrays.select(
        "doc_id", F.explode(F.array_distinct(F.expr(tokens.grams("words")))).alias("gram")
    )


@query
def bigram_index_title(t: Tables) -> DataFrame:
    return t.indexes.index("title_grams").postings.select("term", "doc_id", "tf", "df")


@query
def title_index_min_df(t: Tables) -> DataFrame:
    """The title index over the threshold of twenty documents."""
    return t.indexes.index("title", 20).postings.select("term", "doc_id", "tf", "df", "doc_len")


@query
def bigram_index_body(t: Tables) -> DataFrame:
    return t.indexes.index("body_grams").postings.select("term", "doc_id", "tf", "df")


@query
def title_word_count(t: Tables) -> DataFrame:
    return t.corpus.field("title").select(
        "doc_id", F.expr(tokens.raw_word_count("text")).alias("raw_words")
    )


# Index


@query
def term_frequency(t: Tables) -> DataFrame:
    return t.indexes.flat("body").select("doc_id", "term", "tf")


@query
def term_frequency_anchor(t: Tables) -> DataFrame:
    return t.indexes.flat("anchor")


@query
def query_term_frequency(t: Tables) -> DataFrame:
    return t.batch.counted_terms.rows.select("query_id", "term", "qtf")


@query
def doc_length(t: Tables) -> DataFrame:
    return t.indexes.doc_stats("body")


@query
def posting_lists(t: Tables) -> DataFrame:
    lists = ix.posting_lists(t.indexes.index("body").postings)
    pairs = F.transform("postings", lambda p: F.concat_ws(":", p["doc_id"], p["tf"]))
    return lists.select("term", "part", F.array_join(pairs, " ").alias("postings"))


@query
def posting_lookup(t: Tables) -> DataFrame:
    """The posting lists of every term of the query table."""
    return search.hits(t.indexes.index("body"), t.batch.terms).select("query_id", "term", "doc_id", "tf")


@query
def document_frequency(t: Tables) -> DataFrame:
    return t.indexes.index("body").term_stats.select("term", "df")


@query
def collection_frequency(t: Tables) -> DataFrame:
    return t.indexes.index("body").term_stats


@query
def min_df_filter(t: Tables) -> DataFrame:
    return t.indexes.index("body").postings.select("term", "doc_id", "tf")


@query
def corpus_stats(t: Tables) -> DataFrame:
    fields = []
    for f in ("title", "body", "anchor"):
        fields.append(ix.corpus_statistics(t.indexes.doc_stats(f)).withColumn("field", F.lit(f)))
    return _round(fields[0].unionByName(fields[1]).unionByName(fields[2]), "avgdl")


@query
def title_map(t: Tables) -> DataFrame:
    return t.corpus.titles()


@query
def doc_norms(t: Tables) -> DataFrame:
    return _round(t.indexes.norms("body"), "norm2")


@query
def tf_idf(t: Tables) -> DataFrame:
    return _round(ix.tf_idf(t.indexes.index("body")), "weight")


# Scoring


@query
def cosine_search(t: Tables) -> DataFrame:
    return _ranked(search.cosine(t.indexes.index("body"), t.batch, t.indexes.norms("body")))


@query
def cosine_unnormalized(t: Tables) -> DataFrame:
    return _ranked(search.cosine(t.indexes.index("body"), t.batch, normalize=False), digits=11)


@query
def bm25_search(t: Tables) -> DataFrame:
    return _ranked(search.bm25(t.indexes.index("body"), t.batch))


@query
def bm25_blocks(t: Tables) -> DataFrame:
    """BM25 over blocks of postings whose maxima tell which of them can hold a result."""
    return _ranked(search.bm25(block_postings(t.indexes.index("body"), t.workspace, "body"), t.batch))


@query
def bm25_fixed_avgdl(t: Tables) -> DataFrame:
    """BM25 with a given mean length instead of the index's own."""
    return _ranked(search.bm25(t.indexes.index("body"), t.batch, avgdl=REFERENCE_AVGDL))


@query
def bm25_extended_stems(t: Tables) -> DataFrame:
    indexes, batch = t.extended
    return _ranked(search.bm25(indexes.index("body"), batch))


@query
def bm25_all_terms(t: Tables) -> DataFrame:
    """BM25 over an index without a document-frequency threshold."""
    return _ranked(search.bm25(t.indexes.index("body", 0), t.batch))


@query
def title_coverage(t: Tables) -> DataFrame:
    return _ranked(search.title_coverage(t.indexes.index("title"), t.batch))


@query
def title_bigram_jaccard(t: Tables) -> DataFrame:
    set_ = t.indexes
    return _ranked(
        search.title_gram_jaccard(set_.index("title_grams"), set_.index("title_query_grams"), t.batch)
    )


@query
def anchor_count(t: Tables) -> DataFrame:
    return _ranked(search.anchor_count(t.indexes.index("anchor"), t.batch))


@query
def body_bigram(t: Tables) -> DataFrame:
    found = search.body_grams(t.indexes.index("body_grams"), t.batch)
    return _round(found.select("query_id", "doc_id", "rank", "score", "matched"), "score")


@query
def body_search_contract(t: Tables) -> DataFrame:
    set_ = t.indexes
    return _ranked(search.body_cosine(set_.index("body_words"), t.batch, set_.norms("body_words")))


@query
def title_search_contract(t: Tables) -> DataFrame:
    return search.word_match(t.indexes.index("title_words"), t.batch, "title_match")


@query
def anchor_search_contract(t: Tables) -> DataFrame:
    return search.word_match(t.indexes.index("anchor_words"), t.batch, "anchor_match")


def _view_scores(t: Tables) -> DataFrame:
    """Keys by day and number of events, result lists with ties and single rows."""
    events = t.read("events", schemas.EVENTS)
    per_day = events.groupBy(
        F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date")).cast("bigint").alias("query_id"),
        F.get_json_object("props", "$.k").cast("bigint").alias("doc_id"),
    ).agg(F.count("*").cast("double").alias("score"))
    return rank_all(per_day, t.workspace, "view_scores").withColumn("rank", F.col("rank").cast("int"))


@query
def minmax_zero(t: Tables) -> DataFrame:
    return _ranked(min_max_normalize(_view_scores(t), cut=False))


@query
def minmax_keep(t: Tables) -> DataFrame:
    return _ranked(min_max_normalize(_view_scores(t), on_zero_range="keep", cut=False))


# Fusion


@query
def fuse_one_word(t: Tables) -> DataFrame:
    return _fused(fusion.fuse_one_word(t.indexes.for_search, t.batch))


@query
def fuse_base(t: Tables) -> DataFrame:
    return _fused(fusion.fuse_base(t.indexes.for_search, t.batch))


@query
def fuse_multi_word(t: Tables) -> DataFrame:
    return _fused(fusion.fuse_multi_word(t.indexes.for_search, t.batch))


@query
def fuse_notebook(t: Tables) -> DataFrame:
    set_ = t.indexes
    found = fusion.fuse_notebook(
        set_.index("title"), set_.index("body"), t.batch, t.corpus.titles()
    )
    return _fused(found)


@query
def search_results(t: Tables) -> DataFrame:
    return _fused(fusion.search(t.indexes.for_search, t.batch, t.corpus.titles()))


QUERIES["search"] = QUERIES.pop("search_results")


@query
def search_extended_stems(t: Tables) -> DataFrame:
    indexes, batch = t.extended
    return _fused(fusion.search(indexes.for_search, batch, t.corpus.titles()))


# Links


@query
def link_edges(t: Tables) -> DataFrame:
    return t.edges


@query
def link_vertices(t: Tables) -> DataFrame:
    return links.vertices(t.edges)


@query
def pagerank(t: Tables) -> DataFrame:
    return _round(t.pagerank, "pagerank")


def _links_of_long_texts(t: Tables) -> DataFrame:
    """Links of documents of 1,000 characters and more: shorter ones link to nothing."""
    long = t.corpus.docs.filter(F.char_length("text") >= 1000).select(F.col("id").alias("src"))
    return links.edges(t.corpus.links.join(long, "src", "left_semi"))


@query
def pagerank_sinks(t: Tables) -> DataFrame:
    """PageRank of a graph with pages that link to nothing, whose ranks are scaled at the end."""
    found = links.pagerank(_links_of_long_texts(t), t.workspace, name="pagerank_sinks")
    return _round(found, "pagerank")


@query
def page_graph(t: Tables) -> DataFrame:
    """Links of web pages, resolved against the page's address."""
    return page_source.page_edges(page_source.parse_pages(t.read("pages", schemas.PAGES)))


@query
def pagerank_ranked(t: Tables) -> DataFrame:
    """Pages by descending PageRank."""
    rows = t.pagerank.select(F.lit(0).alias("query_id"), F.col("id").alias("doc_id"), F.col("pagerank").alias("score"))
    ranked = rank_all(rows, t.workspace, "pagerank_ranked")
    return _round(ranked.select("rank", F.col("doc_id").alias("id"), F.col("score").alias("pagerank")), "pagerank")


@query
def pagerank_lookup(t: Tables) -> DataFrame:
    return _round(lookup.pagerank_of(t.ids, t.pagerank), "pagerank")


@query
def pageview_lookup(t: Tables) -> DataFrame:
    views = monthly_views(t.read("events", schemas.EVENTS), VIEW_MONTH)
    return lookup.pageviews_of(t.ids, views)


@query
def pageviews_by_title(t: Tables) -> DataFrame:
    """Views of pages from a log that knows titles only, spelled with underscores."""
    events = t.read("events", schemas.EVENTS).filter(F.col("event_type") == "view")
    seen = events.select("ts", F.get_json_object("props", "$.k").cast("bigint").alias("doc_id"))
    log = seen.join(t.corpus.titles(), "doc_id").select(F.replace("title", F.lit(" "), F.lit("_")).alias("title"), "ts")
    path = t.workspace.fresh("view_log")
    write_log(log, path)
    month = VIEW_MONTH[:7]
    return views_of_pages(views_by_title(t.spark, path, month, month), t.corpus.titles())


# Evaluation


@query
def relevance(t: Tables) -> DataFrame:
    return t.qrels


@query
def precision_at_5(t: Tables) -> DataFrame:
    return _round(evaluation.precision_at(t.results, t.qrels), "precision")


@query
def recall(t: Tables) -> DataFrame:
    return _round(evaluation.recall(t.results, t.qrels), "recall")


@query
def f1_at_30(t: Tables) -> DataFrame:
    return _round(evaluation.f1_at(t.results, t.qrels), "f1")


@query
def average_precision(t: Tables) -> DataFrame:
    return _round(evaluation.average_precision(t.results, t.qrels), "average_precision")


@query
def benchmark_mean(t: Tables) -> DataFrame:
    means = evaluation.benchmark_mean(t.results, t.qrels)
    return _round(means, "precision_at_5", "recall", "f1_at_30", "map_at_30")
