"""Scores of a five-document corpus worked out by hand."""

from math import log2, sqrt

import pytest
from pyspark.sql import functions as F

from lexigraph import schemas
from lexigraph.operators import fusion, search
from lexigraph.operators import index as ix
from lexigraph.operators.build import IndexSet
from lexigraph.operators.ranking import min_max_normalize, top_k
from lexigraph.operators.search import QueryBatch, TermTable, hits
from lexigraph.sources import corpus as corpora
from lexigraph.sources.corpus import scan
from lexigraph.sources.queries import passage_relevance
from lexigraph.workspace import Workspace

DOCS = [
    (1, "Solar power", "solar power plants store solar heat", [(2, "Wind power")]),
    (2, "Wind (power)", "wind power and solar power", [(1, "solar plants"), (3, "heat storage")]),
    (3, "Heat storage", "plants store heat", [(1, "solar")]),
    (4, "---", "", []),
    (5, "Solar power", "power grid", [(5, "power grid")]),
]
QUERIES = [
    (1, "solar power"),
    (2, "solar"),
    (3, ""),
    (4, "zzz qqq"),
    (5, "the of and"),
    (6, "power power grid"),
    (7, "grid"),
]
N = 5


@pytest.fixture(scope="module")
def ws(spark):
    return Workspace(spark, "five documents")


@pytest.fixture(scope="module")
def corpus(spark, ws):
    rows = [(i, t, b, [{"id": d, "text": x} for d, x in links]) for i, t, b, links in DOCS]
    path = ws.fresh("stored")
    spark.createDataFrame(rows, schemas.CORPUS).repartition(2).write.mode("overwrite").parquet(path)
    return corpora.scan(spark, path, glob="*.parquet")


@pytest.fixture(scope="module")
def indexes(corpus, ws):
    return IndexSet(corpus, ws, min_df={})


@pytest.fixture(scope="module")
def batch(spark, ws):
    return QueryBatch(spark.createDataFrame(QUERIES, schemas.QUERIES), ws)


def of(df, query_id, column="score"):
    rows = df.filter(F.col("query_id") == query_id).orderBy("rank").collect()
    return [(r["doc_id"], pytest.approx(r[column], abs=1e-6)) for r in rows]


def min_max(scores):
    low, high = min(scores.values()), max(scores.values())
    scaled = {d: (s - low) / (high - low) if high > low else 0.0 for d, s in scores.items()}
    return sorted(scaled.items(), key=lambda x: (-x[1], x[0]))


IDF = {"solar": log2(N / 2), "power": log2(N / 3), "grid": log2(N / 1)}
LEN = {1: 6, 2: 4, 3: 3, 4: 0, 5: 2}


def test_stop_words_are_dropped_from_lengths(indexes):
    got = {r["doc_id"]: r["doc_len"] for r in indexes.index("body").doc_stats.collect()}
    assert got == LEN
    assert indexes.index("body").avgdl == pytest.approx(3.0)


def test_unknown_term_has_no_postings(indexes):
    assert ix.lookup(indexes.index("body"), "zzz").collect() == []
    assert [tuple(r) for r in ix.lookup(indexes.index("body"), "solar").collect()] == [(1, 2), (2, 1)]


def test_bm25(indexes, batch):
    def part(term, tf, doc):
        return IDF[term] * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * LEN[doc] / 3.0))

    got = search.bm25(indexes.index("body"), batch)
    expected = min_max(
        {
            1: part("solar", 2, 1) + part("power", 1, 1),
            2: part("solar", 1, 2) + part("power", 2, 2),
            5: part("power", 1, 5),
        }
    )
    assert of(got, 1) == expected
    repeated = min_max(
        {
            1: 2 * part("power", 1, 1),
            2: 2 * part("power", 2, 2),
            5: 2 * part("power", 1, 5) + part("grid", 1, 5),
        }
    )
    assert of(got, 6) == repeated


def test_one_hit_list_scores_zero(indexes, batch):
    assert of(search.bm25(indexes.index("body"), batch), 7) == [(5, 0.0)]


def test_empty_unknown_and_stop_word_queries_have_no_rows(corpus, indexes, batch):
    got = fusion.search(indexes.for_search, batch, corpus.titles())
    assert got.filter(F.col("query_id").isin(3, 4, 5)).count() == 0


def test_cosine(indexes, batch):
    weights = {
        1: {"solar": 2 / 6, "power": 1 / 6},
        2: {"solar": 1 / 4, "power": 2 / 4},
        5: {"power": 1 / 2},
    }
    norms = {r["doc_id"]: r["norm2"] for r in ix.squared_norms(indexes.index("body")).collect()}
    assert norms[5] == pytest.approx((log2(5 / 3) / 2) ** 2 + (log2(5) / 2) ** 2)
    dots = {
        d: sum(IDF[t] / len("solar power") * w * IDF[t] for t, w in ws.items())
        for d, ws in weights.items()
    }
    got = search.cosine(indexes.index("body"), batch, normalize=False)
    assert of(got, 1) == sorted(dots.items(), key=lambda x: -x[1])
    expected = min_max({d: s / sqrt(2 * norms[d]) for d, s in dots.items()})
    assert of(search.cosine(indexes.index("body"), batch), 1) == expected


def test_title_coverage_counts_empty_pieces(indexes, batch):
    # "Wind (power)" splits into "Wind", "", "power", "".
    expected = min_max({1: 1.0, 5: 1.0, 2: 1 / 4})
    assert of(search.title_coverage(indexes.index("title"), batch), 1) == expected


def test_title_gram_jaccard(indexes, batch):
    got = search.title_gram_jaccard(
        indexes.index("title_grams"), indexes.index("title_query_grams"), batch
    )
    assert of(got, 1) == [(1, 0.0), (5, 0.0)]


def test_anchor_count(indexes, batch):
    # Links into 1: "solar plants", "solar"; into 2: "Wind power"; into 5: "power grid".
    assert of(search.anchor_count(indexes.index("anchor"), batch), 1) == [(1, 1.0), (2, 0.0), (5, 0.0)]


def test_body_grams(indexes, batch):
    # "solar power" stands in 1 and 2; in 2 across the dropped "and".
    got = search.body_grams(indexes.index("body_grams"), batch)
    assert of(got, 1) == [(2, 1.0), (1, 0.0)]
    assert of(got, 1, "matched") == [(2, 1), (1, 1)]


def test_contract_searches_count_distinct_words(indexes, batch):
    got = search.word_match(indexes.index("title_words"), batch, "titles")
    assert of(got, 1) == [(1, 2), (5, 2), (2, 1)]
    assert of(got, 6) == [(1, 1), (2, 1), (5, 1)]


def test_body_cosine(indexes, batch):
    got = of(search.body_cosine(indexes.index("body_words"), batch), 2)
    w = 2 / 6 * IDF["solar"]
    norm = sqrt(
        w**2
        + (1 / 6 * IDF["power"]) ** 2
        + 3 * (1 / 6 * log2(N / 2)) ** 2
    )
    assert dict(got)[1] == pytest.approx(w / norm, abs=1e-6)


def test_fusion_and_routing(corpus, indexes, batch):
    got = fusion.search(indexes.for_search, batch, corpus.titles()).withColumn(
        "doc_id", F.col("doc_id").cast("int")
    )
    title = dict(of(search.title_coverage(indexes.index("title"), batch), 2))
    anchor = dict(of(search.anchor_count(indexes.index("anchor"), batch), 2))
    assert set(dict(of(got, 2))) == set(title) | set(anchor)
    base = {r["doc_id"]: r["score"] for r in fusion.fuse_base(indexes.for_search, batch).filter("query_id = 1").collect()}
    grams = dict(of(search.body_grams(indexes.index("body_grams"), batch), 1))
    expected = {d: s / 10 + (0.1 if d in grams else 0.0) for d, s in base.items()}
    assert of(got, 1) == sorted(expected.items(), key=lambda x: (-round(x[1], fusion.FUSED_DIGITS), x[0]))


def test_both_fusions_equal_the_routed_search(corpus, indexes, batch):
    one = fusion.fuse_one_word(indexes.for_search, batch).join(batch.info.filter("n_tokens = 1"), "query_id")
    more = fusion.fuse_multi_word(indexes.for_search, batch).join(batch.info.filter("n_tokens > 1"), "query_id")
    whole = top_k(one.unionByName(more).select("query_id", "doc_id", "score"), 30)
    routed = fusion.search(indexes.for_search, batch, corpus.titles())
    key = lambda r: (r["query_id"], int(r["doc_id"]), r["rank"], round(r["score"], 9))
    assert sorted(map(key, whole.collect())) == sorted(map(key, routed.collect()))


def test_title_map_keeps_duplicate_titles(corpus):
    assert corpus.titles().filter(F.col("title") == "Solar power").count() == 2


def test_stored_index_reads_back(spark, indexes, ws):
    built = indexes.index("body")
    root = ws.fresh("copy")
    ix.write_index(built, root, "body")
    again = ix.read_index(spark, root, "body")
    assert again.n_docs == N and again.avgdl == built.avgdl
    assert built.postings.exceptAll(again.postings).count() == 0
    assert again.term_stats.filter("cf < df").count() == 0


def test_min_df_is_exclusive(indexes):
    kept = {r["term"] for r in indexes.index("body", 1).postings.select("term").distinct().collect()}
    assert kept == {"solar", "power", "plant", "store", "heat"}


def test_stats_of_another_build(indexes):
    mixed = indexes.index("body").with_stats_of(indexes.index("title"))
    query = mixed.postings.sparkSession.createDataFrame([(1, "power")], "query_id BIGINT, term STRING")
    found = hits(mixed, TermTable(query))
    assert {r["doc_id"]: r["doc_len"] for r in found.collect()}[1] == 2
    # The join with the lengths stands above the one with the query terms.
    plan = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
    joins = [line for line in plan if "Join Inner" in line]
    assert "doc_id" in joins[0] and "term" in joins[1]


def test_posting_lists_are_cut_into_ordered_parts(indexes):
    lists = ix.posting_lists(indexes.index("body").postings, ids_per_part=2)
    found = {}
    for r in lists.orderBy("term", "part").collect():
        ids = [p["doc_id"] for p in r["postings"]]
        assert ids == sorted(ids)
        found.setdefault(r["term"], []).extend(ids)
    assert found["power"] == [1, 2, 5]
    assert lists.columns == ["term", "part", "postings"]


def test_small_scores_are_ranked_as_they_are(spark):
    scores = [3e-8, 1e-8, 2e-8, 2e-8 * (1 + 1e-15), 0.0]
    df = spark.createDataFrame([(1, i, s) for i, s in enumerate(scores)], "query_id BIGINT, doc_id BIGINT, score DOUBLE")
    cut = top_k(df, 5)
    assert [r["doc_id"] for r in cut.orderBy("rank").collect()] == [0, 2, 3, 1, 4]
    low = min_max_normalize(cut.filter("doc_id < 2"))
    assert sorted(r["score"] for r in low.collect()) == [0.0, 1.0]
    assert sorted(r["score"] for r in min_max_normalize(cut, cut=False).collect())[-1] == 1.0


def test_scan_leaves_out_other_files(spark, ws):
    root = ws.fresh("many")
    for name, doc_id in (("part_a", 1), ("part_b", 2), ("stray", 3), ("bucket_x", 4)):
        row = [(doc_id, "t", "x", [(7, "a")])]
        spark.createDataFrame(row, schemas.CORPUS).write.parquet(f"{root}/{name}")
    spark.createDataFrame([(1,)], "x INT").write.json(f"{root}/notes")
    corpus = scan(spark, root, "*.parquet", exclude=["stray"], exclude_prefixes=["bucket_"])
    assert sorted(r["id"] for r in corpus.docs.collect()) == [1, 2]
    assert sorted((r["src"], r["dst"]) for r in corpus.links.collect()) == [(1, 7), (2, 7)]
    assert len(scan(spark, root, "*.parquet").docs.collect()) == 4


@pytest.mark.parametrize("broadcast_rows", [500_000, 0])
def test_relevance_of_short_and_odd_passages(spark, ws, broadcast_rows):
    texts = ["one two three four", "xone two threey", "two", "", "one two  three", "four one two three"]
    docs = spark.createDataFrame(list(enumerate(texts)), "id BIGINT, text STRING")
    passages = ["one two three", "two", "one two", "four", "nothing here at all", "two three four five"]
    benchmark = spark.createDataFrame(list(enumerate(passages)), "item_id BIGINT, text STRING")
    found = {(r["query_id"], r["doc_id"]) for r in passage_relevance(benchmark, docs, ws, broadcast_rows).collect()}
    assert found == {(2 * i + k, d) for i, p in enumerate(passages) for d, t in enumerate(texts) if p in t for k in (0, 1)}

