"""Metrics and lookups worked out by hand."""

import pytest
from pyspark.sql import functions as F

from lexigraph.operators import evaluation, lookup
from lexigraph.sources.pageviews import monthly_views
from lexigraph.sources.pages import page_links, parse_pages
from lexigraph.sources.queries import passage_relevance
from lexigraph.workspace import Workspace


@pytest.fixture
def judged(spark):
    results = spark.createDataFrame(
        [(1, d, r) for r, d in enumerate([7, 8, 9], 1)] + [(2, d, r) for r, d in enumerate(range(10, 17), 1)],
        "query_id BIGINT, doc_id BIGINT, rank INT",
    )
    qrels = spark.createDataFrame(
        [(1, 7), (1, 9), (1, 99), (2, 16), (3, 5)], "query_id BIGINT, doc_id BIGINT"
    )
    return results, qrels


def by_query(df):
    return {r[0]: pytest.approx(r[1]) for r in df.collect()}


def test_metrics(judged):
    assert by_query(evaluation.precision_at(*judged)) == {1: 2 / 3, 2: 0.0, 3: 0.0}
    assert by_query(evaluation.recall(*judged)) == {1: 2 / 3, 2: 1.0, 3: 0.0}
    assert by_query(evaluation.f1_at(*judged)) == {1: 2 / 3, 2: 2 / 8, 3: 0.0}
    assert by_query(evaluation.average_precision(*judged)) == {1: (1 + 2 / 3) / 2, 2: 1 / 7, 3: 0.0}


def test_mean_counts_queries_without_results(judged):
    row = evaluation.benchmark_mean(*judged).first()
    assert row["n_queries"] == 3
    assert row["recall"] == pytest.approx((2 / 3 + 1) / 3)


def test_lookups_keep_order_and_fill_gaps(spark):
    ids = spark.createDataFrame([(0, 5), (1, 1), (2, 8)], "pos BIGINT, doc_id BIGINT")
    ranks = spark.createDataFrame([(1, 0.5), (5, 1.5)], "id BIGINT, pagerank DOUBLE")
    assert [r["pagerank"] for r in lookup.pagerank_of(ids, ranks).collect()] == [1.5, 0.5, 0.0]


def test_views_of_one_month(spark):
    events = spark.sql(
        """SELECT * FROM VALUES
        (TIMESTAMP_NTZ'2021-08-01 00:00:00', 'view', '{"k": 5}'),
        (TIMESTAMP_NTZ'2021-08-31 23:59:59', 'view', '{"k": 5}'),
        (TIMESTAMP_NTZ'2021-09-01 00:00:00', 'view', '{"k": 5}'),
        (TIMESTAMP_NTZ'2021-08-02 00:00:00', 'click', '{"k": 5}') AS t(ts, event_type, props)"""
    )
    ids = spark.createDataFrame([(0, 5), (1, 6)], "pos BIGINT, doc_id BIGINT")
    views = monthly_views(events, "2021-08-01")
    assert [r["views"] for r in lookup.pageviews_of(ids, views).collect()] == [2, 0]


def test_page_parsing(spark):
    html = (
        "<html><title>A &amp; B</title><body><a href=\"/x\">one\n two</a>"
        "<article><h1>Head</h1><p>Text &lt;here&gt;<br>more</article><a href=\"/y\"><b>z</b></a></body></html>"
    )
    pages = spark.createDataFrame([(1, "u", html), (2, "v", "no markup")], "page_id BIGINT, url STRING, html STRING")
    first, second = parse_pages(pages).orderBy("page_id").collect()
    assert (first["title"], first["text"]) == ("A & B", "Head Text <here> more")
    assert (second["title"], second["text"], second["anchors"]) == ("", "", [])
    assert [tuple(r) for r in page_links(parse_pages(pages)).collect()] == [(1, 0, "/x", "one two"), (1, 1, "/y", "z")]


def test_relevance_is_whole_passage_containment(spark):
    docs = spark.createDataFrame(
        [(1, "xx one two three yy"), (2, "one two\nthree"), (3, "zone two threefold"), (4, "two")],
        "id BIGINT, text STRING",
    )
    passages = spark.createDataFrame([(10, "one two three")], "item_id BIGINT, text STRING")
    got = passage_relevance(passages, docs, Workspace(spark, "relevance test"))
    assert sorted(map(tuple, got.collect())) == [(20, 1), (20, 3), (21, 1), (21, 3)]


@pytest.mark.parametrize(
    "href,url",
    [
        ("/a/b", "https://x.org/a/b"),
        ("c.html?q=1#top", "https://x.org/d/c.html?q=1"),
        ("../up", "https://x.org/up"),
        ("../../../far", "https://x.org/far"),
        ("./same", "https://x.org/d/same"),
        ("a/./b/../c/", "https://x.org/d/a/c/"),
        ("..", "https://x.org/"),
        ("//y.net/p/../q", "https://y.net/q"),
        ("//y.net", "https://y.net"),
        ("http://z.com/a#b", "http://z.com/a"),
        ("mailto:a@b.c", "mailto:a@b.c"),
        ("?page=2", "https://x.org/d/e.html?page=2"),
        ("#here", "https://x.org/d/e.html?old=1"),
        ("", "https://x.org/d/e.html?old=1"),
    ],
)
def test_links_are_resolved(spark, href, url):
    from lexigraph.sources.pages import resolve

    row = spark.createDataFrame([(href, "https://x.org/d/e.html?old=1#f")], "href STRING, base STRING")
    assert row.select(resolve(F.col("href"), F.col("base"))).first()[0] == url


def test_page_edges_name_the_page(spark):
    from lexigraph.sources.pages import page_edges, parse_pages

    rows = [(1, "http://s/a/", '<a href="b">x</a><a href="/a/b#z">y</a><a href="mailto:q@r">z</a>'), (2, "http://s/a/b#t", "<a href='../none'>x</a>"), (3, "http://s/a/b", None)]
    pages = spark.createDataFrame(rows, "page_id BIGINT, url STRING, html STRING")
    got = sorted(tuple(r) for r in page_edges(parse_pages(pages)).collect())
    assert got == [(1, "http://s/a/b", 2), (2, "http://s/none", None)]
