"""Adding to and removing from an index, opening only the files of wanted terms, bucketed postings."""

import random
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lexigraph.operators import index as ix
from lexigraph.operators import search
from lexigraph.operators.index import bucket_postings, build_index, squared_norms, write_statistics
from lexigraph.operators.search import TermTable
from lexigraph.operators.segments import SegmentedIndex
from lexigraph.workspace import Workspace

FLAT = "doc_id BIGINT, term STRING, tf INT, doc_len INT"


@pytest.fixture(scope="module")
def ws(spark):
    return Workspace(spark, "segment tests")


def documents(ids, seed=0):
    rng = random.Random(seed)
    return {i: Counter(rng.choice("abcdefgh") * rng.choice((1, 2)) for _ in range(rng.randrange(9))) for i in ids}


def tables(spark, docs):
    rows = [(i, t, n, sum(c.values())) for i, c in docs.items() for t, n in c.items()]
    return spark.createDataFrame(rows, FLAT), spark.createDataFrame([(i, sum(c.values())) for i, c in docs.items()], "doc_id BIGINT, doc_len INT")


def contents(index):
    return {
        "postings": sorted(map(tuple, index.all_postings().select("term", "doc_id", "tf", "df", "doc_len").collect())),
        "term_stats": sorted(map(tuple, index.term_stats.select("term", "df", "cf").collect())),
        "doc_stats": sorted(map(tuple, index.doc_stats.select("doc_id", "doc_len").collect())),
        "corpus": tuple(index.corpus_stats.select("n_docs", "avgdl").first()),
    }


def expected(docs, min_df=0):
    df, cf = Counter(t for c in docs.values() for t in c), Counter()
    for c in docs.values():
        cf.update(c)
    lengths = {i: sum(c.values()) for i, c in docs.items()}
    return {
        "postings": sorted((t, i, n, df[t], lengths[i]) for i, c in docs.items() for t, n in c.items() if df[t] > min_df),
        "term_stats": sorted((t, df[t], cf[t]) for t in df),
        "doc_stats": sorted(lengths.items()),
        "corpus": (len(docs), sum(lengths.values()) / len(docs)),
    }


def files(root):
    return {str(p): (p.stat().st_mtime_ns, p.stat().st_size) for p in Path(root.removeprefix("file:")).rglob("*") if p.is_file()}


def test_add_remove_and_merge(spark, ws):
    root = ws.fresh("changes")
    first, second, third = documents(range(40)), documents(range(100, 130), 1), documents(range(10, 15), 2)
    one = SegmentedIndex.open(spark, root, "body").append(*tables(spark, first))
    assert contents(one.read(2)) == expected(first, 2)
    before = files(root)
    two = one.append(*tables(spark, second))
    assert contents(two.read()) == expected(first | second)
    # 10 to 14 are replaced, 20 goes, 999 was never there.
    three = two.remove(spark.createDataFrame([(i,) for i in (10, 11, 12, 13, 14, 20, 20, 999)], "doc_id BIGINT"))
    left = {i: c for i, c in (first | second).items() if i not in (10, 11, 12, 13, 14, 20)}
    assert contents(three.read()) == expected(left)
    four = three.append(*tables(spark, third))
    assert contents(four.read(3)) == expected(left | third, 3)
    # A document that came back goes again.
    flat = tables(spark, {i: third[i] for i in (10, 11)})[0]
    five = four.remove(spark.createDataFrame([(10,), (11,)], "doc_id BIGINT"), flat)
    now = {i: c for i, c in (left | third).items() if i not in (10, 11)}
    assert contents(five.read()) == expected(now)
    merged = five.merge()
    assert contents(merged.read()) == expected(now) and len(merged.entries) == 1
    after = files(root)
    assert all(after[p] == v for p, v in before.items())
    # Every version can still be read, also by a new reader.
    assert contents(SegmentedIndex.open(spark, root, "body", 2).read()) == expected(first | second)
    assert contents(SegmentedIndex.open(spark, root, "body").read()) == expected(now)


def test_two_writers_of_one_version(spark, ws):
    index = SegmentedIndex.open(spark, ws.fresh("writers"), "body")
    index.append(*tables(spark, documents(range(3))))
    with pytest.raises(Exception, match="(?i)exist"):
        index.append(*tables(spark, documents(range(3, 6))))
    with pytest.raises(ValueError):
        SegmentedIndex.open(spark, index.root, "title")


def test_searches_of_a_segmented_index(spark, ws):
    docs = documents(range(60), 5)
    root = ws.fresh("plain")
    flat, stats = tables(spark, docs)
    write_statistics(stats, root, "body")
    plain = build_index(flat, root, "body", "body", 4)
    halves = [{i: c for i, c in docs.items() if i % 2 == k} for k in (0, 1)]
    grown = SegmentedIndex.open(spark, ws.fresh("grown"), "body").append(*tables(spark, halves[0])).append(*tables(spark, halves[1])).read(4)
    queries = TermTable(spark.createDataFrame([(1, "a", 1), (1, "bb", 2), (2, "zz", 1), (2, "c", 1)], "query_id BIGINT, term STRING, qtf INT"))
    columns = ["query_id", "term", "doc_id", "tf", "df", "doc_len"]
    rows = lambda index: sorted(map(tuple, search.hits(index, queries).select(columns).collect()))
    assert rows(plain) == rows(grown) != []
    norms = lambda index: {r.doc_id: round(r.norm2, 9) for r in squared_norms(index).collect()}
    assert norms(plain) == norms(grown)
    # The statistics are read for the query's terms; no posting is shuffled.
    plan = search.hits(grown, queries)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "CartesianProduct" not in plan


def many_terms(spark, n=400):
    return spark.range(n * 6).select(
        F.format_string("t%04d", F.col("id") % n).alias("term"), F.col("id").alias("doc_id"), F.lit(1).alias("tf"), F.lit(1).alias("doc_len")
    )


def test_only_the_files_of_wanted_terms_are_read(spark, ws):
    flat, root = many_terms(spark), ws.fresh("directory")
    hot = spark.range(500).select(F.lit("t0200").alias("term"), (F.col("id") + 10_000).alias("doc_id"), F.lit(1).alias("tf"), F.lit(1).alias("doc_len"))
    flat = flat.unionByName(hot)
    write_statistics(flat.select("doc_id", "doc_len"), root, "body")
    index = build_index(flat, root, "body", "body", 0, rows_per_task=60)
    every = len(index.postings.inputFiles())
    assert every >= ix.DIRECTORY_FILES
    wanted = [f"t{i:04d}" for i in range(0, 30)] + ["t0200", "nothing", "", "zzz"]
    queries = TermTable(spark.createDataFrame([(1, t) for t in wanted], "query_id BIGINT, term STRING"))
    opened = index.postings_of(queries.rows.select("term"))
    # 30 terms of 6 postings fill 3 files of 60 and touch 2 more; the hot term fills 8.
    assert len(opened.inputFiles()) <= 20 < every
    found = search.hits(index, queries)
    assert len(found.inputFiles()) < every
    assert sorted(map(tuple, found.select("term", "doc_id").collect())) == sorted(
        map(tuple, flat.filter(F.col("term").isin(wanted)).select("term", "doc_id").collect())
    )
    # Terms for every file: the files' ends were read for nothing.
    many = TermTable(ws.write(flat.select(F.lit(1).alias("query_id"), "term").distinct(), "every_term"))
    fresh = ix.read_index(spark, root, "body")
    assert search.hits(fresh, many).count() == flat.count() and "directory" not in vars(fresh)
    none = TermTable(spark.createDataFrame([(1, f"x{i}") for i in range(20)], "query_id BIGINT, term STRING"))
    assert search.hits(index, none).count() == 0


def test_large_batches_meet_bucketed_postings(spark, ws, monkeypatch):
    flat, root = many_terms(spark), ws.fresh("buckets")
    hot = spark.range(700).select(F.lit("t0007").alias("term"), (F.col("id") + 10_000).alias("doc_id"), F.lit(1).alias("tf"), F.lit(1).alias("doc_len"))
    flat = flat.unionByName(hot)
    write_statistics(flat.select("doc_id", "doc_len"), root, "body")
    index = build_index(flat, root, "body", "body", 0)
    queries = TermTable(spark.createDataFrame([(q, f"t{(q * 7) % 500:04d}") for q in range(300)], "query_id BIGINT, term STRING"))
    columns = ["query_id", "term", "doc_id", "tf", "df", "doc_len"]
    want = sorted(map(tuple, search.hits(index, queries).select(columns).collect()))
    monkeypatch.setattr(search, "BROADCAST_ROWS", 0)
    for rows_per_task in (100, 2_000_000):
        stored = bucket_postings(index, ws, "bucket_test", rows_per_task)
        assert (stored.buckets.hot is None) == (rows_per_task == 2_000_000)
        found = search.hits(stored, queries)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "Bucketed: true" in plan and "SortMergeJoin" in plan
        # Only the query terms are shuffled: above the scan of the postings there is no exchange.
        assert plan.count("Exchange hashpartitioning") == 1
        assert sorted(map(tuple, found.select(columns).collect())) == want
        spark.sql(f"DROP TABLE {stored.buckets.table}")


def test_a_stored_index_knows_its_threshold(spark, ws):
    docs = documents(range(30), 3)
    root = ws.fresh("threshold")
    flat, stats = tables(spark, docs)
    write_statistics(stats, root, "body")
    built = build_index(flat, root, "words", "body", 6, profile="plain words")
    ix.write_index(built, root, "copy")
    again = ix.read_index(spark, root, "copy")
    assert (again.min_df, again.component, again.profile) == (6, "body", "plain words")
    assert contents(again) == contents(built)
    assert {r["term"] for r in again.kept_terms().collect()} < {r["term"] for r in again.term_stats.collect()}
    other = ix.Index(*(getattr(built, t) for t in ("postings", "term_stats", "doc_stats", "corpus_stats")), component="title")
    with pytest.raises(ValueError):
        built.with_stats_of(other, same_component=True)


@pytest.mark.parametrize("name", ["a", "data/a", "pages 1", "a+b %41", "same/same"])
def test_scan_leaves_out_what_it_is_told(spark, tmp_path, name):
    from lexigraph.sources.corpus import scan

    root = tmp_path / name
    rows = spark.sql("SELECT 1L AS id, 'a' AS title, 'b' AS text, array(struct(2L AS id, 'c' AS text)) AS anchor_text")
    for folder in ("keep", "stray", "bucket_title", "keep2/stray", "with blank"):
        rows.write.parquet(str(root / folder))
    count = lambda **kw: scan(spark, str(root), "*.parquet", **kw).docs.count()
    assert count() == 5
    assert count(exclude=["stray"], exclude_prefixes=["bucket_"]) == 3
    assert count(exclude=["with blank", "a", "data", name.rpartition("/")[2]]) == 4
    assert scan(spark, str(root) + "/", exclude=["keep"], exclude_prefixes=["keep2"]).links.count() == 3
