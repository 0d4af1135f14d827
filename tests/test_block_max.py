"""Top-k over blocks with maxima: the same rows as scoring everything, from fewer postings."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lexigraph.operators import block_max, search
from lexigraph.operators.block_max import block_postings
from lexigraph.operators.index import build_index, write_statistics
from lexigraph.operators.search import QueryBatch
from lexigraph.workspace import Workspace

QUERIES = ["alpha beta", "alpha", "beta beta gamma", "gamma delta unknown", "rare alpha", "unknown", "delta"]


@pytest.fixture(scope="module")
def ws(spark):
    return Workspace(spark, "block tests")


@pytest.fixture(scope="module")
def batch(spark, ws):
    rows = spark.createDataFrame(list(enumerate(QUERIES)), "query_id BIGINT, query STRING")
    return QueryBatch(rows, ws, "blocks")


def index_of(spark, ws, docs):
    flat = [(i, t, n, sum(c.values())) for i, c in docs.items() for t, n in c.items()]
    lengths = spark.createDataFrame([(i, sum(c.values())) for i, c in docs.items()], "doc_id BIGINT, doc_len INT")
    root = ws.fresh("index")
    write_statistics(lengths, root, "body")
    flat = spark.createDataFrame(flat, "doc_id BIGINT, term STRING, tf INT, doc_len INT")
    return build_index(flat, root, "body", "body", 0)


def corpus(n, seed, first=-50, step=3):
    """Mostly long texts with a word once, a few short ones about it; ids with gaps, equal scores."""
    rng = random.Random(seed)
    docs = {}
    for i in range(n):
        c = Counter(rng.choices(["alpha", "beta", "gamma", "delta"], k=rng.randrange(4)))
        if rng.random() < 0.03:
            c[rng.choice(["alpha", "beta", "gamma"])] += rng.randrange(5, 9)
        else:
            c["filler"] += rng.choice((40, 60))
        if i % 97 == 0:
            c["rare"] += 1
        docs[first + step * i] = c
    return docs


def rows(found):
    return [
        (r.query_id, r.doc_id, r["rank"], pytest.approx(r.score, abs=1e-12))
        for r in found.orderBy("query_id", "rank").collect()
    ]


@pytest.mark.parametrize("k, width", [(1, 4), (10, 16), (5000, 1)])
def test_same_rows_as_all_postings(spark, ws, batch, k, width):
    index = index_of(spark, ws, corpus(900, seed=k))
    whole = rows(search.bm25(index, batch, k=k))
    assert whole and rows(search.bm25(block_postings(index, ws, "b", width), batch, k=k)) == whole


def test_other_constants_and_lengths(spark, ws, batch):
    index = index_of(spark, ws, corpus(400, seed=2))
    blocks = block_postings(index, ws, "b", 8)
    for given in ({"avgdl": 3.0}, {"k1": 0.4, "b": 1.0}, {"b": 0.0}):
        assert rows(search.bm25(blocks, batch, k=7, **given)) == rows(search.bm25(index, batch, k=7, **given))
    # Blocks know the lengths of their own build only.
    assert blocks.with_stats_of(index).blocks is None


def test_fewer_postings_are_scored(spark, ws, batch):
    index = block_postings(index_of(spark, ws, corpus(6000, seed=3)), ws, "b", 16)
    found = block_max.best(index, batch.terms, ws, 10, True, index.avgdl, 1.5, 0.75)
    scored = {r.query_id: r.n for r in found.groupBy("query_id").agg(F.count("*").alias("n")).collect()}
    every = search.hits(index, batch.terms).groupBy("query_id").agg(F.count_distinct("doc_id").alias("n"))
    every = {r.query_id: r.n for r in every.collect()}
    assert scored.keys() == every.keys()
    assert all(scored[q] >= min(10, n) for q, n in every.items())
    assert scored[1] < every[1] / 4 and sum(scored.values()) < sum(every.values()) / 2


def test_bounds_do_not_read_postings(spark, ws, batch):
    index = block_postings(index_of(spark, ws, corpus(100, seed=4)), ws, "b", 16)
    bounds = block_max.range_bounds(index, batch.terms, True, index.avgdl, 1.5, 0.75)
    plan = bounds._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema" not in plan or "postings:array" not in plan
    assert "max_tf" in plan and "postings#" not in plan


def test_large_query_tables_and_no_documents(spark, ws, batch, monkeypatch):
    index = index_of(spark, ws, corpus(300, seed=5))
    whole = rows(search.bm25(index, batch, k=10))
    monkeypatch.setattr(search, "BROADCAST_ROWS", 0)
    assert rows(search.bm25(block_postings(index, ws, "b", 8), batch, k=10)) == whole
    nothing = index_of(spark, ws, {})
    assert rows(search.bm25(block_postings(nothing, ws, "b"), batch, avgdl=1.0)) == []
