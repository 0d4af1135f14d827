"""The plans and the paths that only large or skewed data takes."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from lexigraph import schemas
from lexigraph.operators import index as ix
from lexigraph.operators import links, search
from lexigraph.operators.analyze import spread
from lexigraph.operators.block_max import block_postings
from lexigraph.operators.index import build_index, write_statistics
from lexigraph.operators.ranking import min_max_normalize, rank_all, top_k
from lexigraph.operators.search import TermTable
from lexigraph.operators.segments import SegmentedIndex
from lexigraph.operators.skew import hot_keys, spread_join
from lexigraph.plans.catalog import QUERIES
from lexigraph.workspace import Workspace
from lexigraph.workspace import settings as session_settings

FOLDER = "/root/testdata/sf0.001"
FEW = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


@pytest.fixture(scope="module")
def ws(spark):
    return Workspace(spark, "scale tests")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def skewed(spark, n=300):
    """A third of the rows have one key."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("t"), F.col("id") % 40)).alias("term"),
        F.col("id").alias("doc_id"),
        F.lit(1).alias("tf"),
    )


def test_spread_join_equals_plain_join(spark):
    big = skewed(spark)
    small = big.groupBy("term").agg(F.count("*").alias("df"))
    hot = hot_keys(small, "term", "df", rows_per_task=20)
    assert [r["parts"] for r in hot.collect()] == [5]
    spread = spread_join(big, small, "term", "doc_id", hot)
    plain = big.join(small, "term").select(spread.columns)
    assert spread.exceptAll(plain).count() == 0 and spread.count() == plain.count()


def test_no_hot_keys_below_the_threshold(spark):
    counted = skewed(spark).groupBy("term").agg(F.count("*").alias("df"))
    assert hot_keys(counted, "term", "df") is None


def test_index_of_skewed_terms(spark, ws):
    flat = skewed(spark)
    lengths = flat.select("doc_id", F.lit(1).alias("doc_len"))
    root = ws.fresh("skew")
    write_statistics(lengths, root, "body")
    plain = build_index(flat, root, "plain", "body", min_df=5)
    spread = build_index(flat, root, "spread", "body", min_df=5, rows_per_task=10)
    assert plain.postings.exceptAll(spread.postings).count() == 0
    assert plain.postings.count() == spread.postings.count()


def test_large_batches_are_joined_by_shuffle(spark, ws, monkeypatch):
    flat = skewed(spark)
    root = ws.fresh("hits")
    write_statistics(flat.select("doc_id", F.lit(1).alias("doc_len")), root, "body")
    index = build_index(flat, root, "x", "body", 0)
    queries = spark.createDataFrame([(1, "hot"), (2, "t1"), (2, "zzz")], "query_id BIGINT, term STRING")
    small = search.hits(index, TermTable(queries))
    assert "BroadcastHashJoin" in plan_of(small)
    assert "In(term" in plan_of(small)
    monkeypatch.setattr(search, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(search, "hot_keys", lambda *a: hot_keys(*a, rows_per_task=20))
    large = search.hits(index, TermTable(queries)).select(small.columns)
    expected = sum(i % 3 == 0 or i % 40 == 1 for i in range(300))
    assert small.exceptAll(large).count() == 0 and small.count() == large.count() == expected


@pytest.mark.parametrize("name", ["bm25_search", "title_coverage", "anchor_count", "search"])
def test_search_plans(spark, name):
    plan = plan_of(QUERIES[name](spark, FOLDER))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "WindowGroupLimit" in plan and "BroadcastHashJoin" in plan


def test_lookup_reaches_the_scan(spark):
    from lexigraph.operators.index import lookup
    from lexigraph.plans.catalog import tables

    plan = plan_of(lookup(tables(spark, FOLDER).indexes.index("body"), "them"))
    assert "EqualTo(term,them)" in plan


def test_counting_terms_needs_no_shuffle(spark):
    from lexigraph.operators.analyze import forward_rows
    from lexigraph.plans.catalog import tables

    assert "Exchange" not in plan_of(forward_rows(tables(spark, FOLDER).corpus.field("body")))


def test_rank_all_equals_row_number(spark, ws):
    scored = spark.range(500).select(
        F.when(F.col("id") < 400, 1).otherwise(2).cast("bigint").alias("query_id"),
        F.col("id").alias("doc_id"),
        (F.col("id") * 7 % 5).alias("score"),
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")
    expected = scored.withColumn("rank", F.row_number().over(order).cast("bigint"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = rank_all(scored, ws, "ranked")
        assert spark.read.parquet(f"{ws.root}/ranked-*").select("slice").distinct().count() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert expected.exceptAll(got.select(expected.columns)).count() == 0


SCORES = st.lists(
    st.tuples(st.integers(0, 2), st.integers(0, 30), st.integers(0, 4)),
    min_size=1,
    max_size=30,
    unique_by=lambda r: r[:2],
)


@FEW
@given(SCORES, st.integers(1, 6))
def test_top_k_and_min_max(spark, rows, k):
    df = spark.createDataFrame(
        [(q, d, float(s)) for q, d, s in rows], "query_id BIGINT, doc_id BIGINT, score DOUBLE"
    )
    full = {q: sorted((-s, d) for p, d, s in rows if p == q)[:k] for q in range(3)}
    cut = top_k(df.repartition(3), k)
    got = {q: [] for q in range(3)}
    for r in cut.orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((-r["score"], r["doc_id"]))
    assert got == full
    assert all(0 <= r["score"] <= 1 for r in min_max_normalize(cut).collect())
    kept = min_max_normalize(cut, on_zero_range="keep").collect()
    for r in kept:
        scores = {s for s, _ in full[r["query_id"]]}
        if len(scores) == 1:
            assert r["score"] == -scores.pop()


EDGES = {
    ((1, 2), (2, 3), (1, 3)): [0.5927389478883675, 0.8446530007409236, 1.5626080513707088],
    ((1, 2), (2, 3), (3, 1), (1, 3), (3, 3)): [0.8486976052246095, 0.5132009907226562, 1.6381014040527342],
}


@pytest.mark.parametrize("rows_per_task", [2_000_000, 1])
@pytest.mark.parametrize("edges", list(EDGES))
def test_pagerank(spark, ws, edges, rows_per_task):
    df = spark.createDataFrame(list(edges) * 2, "src BIGINT, dst BIGINT")
    got = links.pagerank(links.edges(df), ws, rows_per_task=rows_per_task, name="pr_test")
    ranks = [r["pagerank"] for r in got.orderBy("id").collect()]
    assert ranks == pytest.approx(EDGES[edges], abs=1e-12)
    assert sum(ranks) == pytest.approx(3)


def test_an_iteration_reads_the_edges_once_and_unshuffled(spark, ws, monkeypatch):
    plans = []
    step = links._step
    monkeypatch.setattr(links, "_step", lambda *a: plans.append(plan_of(step(*a))) or step(*a))
    df = spark.range(3000).select((F.col("id") % 300).alias("src"), (F.col("id") % 77).alias("dst"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        links.pagerank(links.edges(df), ws, name="pr_plan")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(plans) == 6
    for plan in plans:
        assert plan.count("SortMergeJoin") == 1 and "Bucketed: true" in plan
        # The shares and the summed messages are shuffled, the edges are not.
        assert plan.count("Exchange hashpartitioning") == 2
    assert not spark.sparkContext._jsc.getPersistentRDDs()


def test_stored_schemas_parse(spark):
    for name in ("CORPUS", "QUERIES", "DOCUMENTS", "PAGES", "BENCHMARK", "EVENTS"):
        assert spark.createDataFrame([], getattr(schemas, name)).columns


def rows_by_task(df):
    return sorted(r["n"] for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect())


def one_row_group(spark, ws, n, words=30):
    """A file of one row group and many splits."""
    path = ws.fresh("row_group")
    text = F.concat_ws(" ", *(F.sha2(F.concat_ws("-", F.col("id"), F.lit(k)), 256) for k in range(words)))
    spark.range(n).select(F.col("id").alias("doc_id"), text.alias("text")).coalesce(1).write.parquet(path)
    return spark.read.parquet(path)


def test_text_of_one_row_group_is_divided(spark, ws, monkeypatch):
    """One task read a whole row group, however many splits the file had."""
    splits = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(splits)
    try:
        spark.conf.set(splits, "100000")
        docs = one_row_group(spark, ws, 2_000)
        cores = spark.sparkContext.defaultParallelism
        assert docs.rdd.getNumPartitions() > cores and rows_by_task(docs)[-1] == 2_000
        divided = spread(docs)
        assert rows_by_task(divided)[-1] <= 2_000 // cores + 10
        assert divided.exceptAll(docs).isEmpty() and divided.count() == 2_000
        monkeypatch.setattr("lexigraph.operators.analyze.DOCS_PER_TASK", 100)
        assert rows_by_task(spread(docs))[-1] <= 100 + 20
        # Already even: read as it is, and so is an empty table.
        even = spark.read.parquet(ws.write(docs.repartition(4 * cores), "even").inputFiles()[0].rpartition("/")[0])
        assert "Exchange" not in plan_of(spread(even)) and spread(docs.limit(0)).count() == 0
    finally:
        spark.conf.set(splits, before)


def test_few_terms_do_not_shuffle_postings(spark, ws, monkeypatch):
    flat = skewed(spark)
    kept = ix.term_statistics(flat).filter("df > 5").select("term", "df")
    few = ix.with_df(flat, kept, kept.count())
    assert "BroadcastHashJoin" in plan_of(few) and "SortMergeJoin" not in plan_of(few)
    monkeypatch.setattr(ix, "BROADCAST_TERMS", 0)
    many = ix.with_df(flat, kept, kept.count(), rows_per_task=20).select(few.columns)
    assert few.exceptAll(many).isEmpty() and many.exceptAll(few).isEmpty()


def test_blocks_take_one_shuffle(spark, ws):
    flat = skewed(spark).withColumn("doc_len", F.lit(1))
    root = ws.fresh("blocks")
    write_statistics(flat.select("doc_id", "doc_len"), root, "body")
    index = build_index(flat, root, "x", "body", 0)
    written = []

    class Spy(Workspace):
        def write(self, df, *names):
            written.append(plan_of(df))
            return super().write(df, *names)

    blocks = block_postings(index, Spy(spark, "spy"), "x").blocks.rows
    assert written[0].count("Exchange rangepartitioning") == written[0].count("Exchange") == 1
    assert blocks.groupBy("term", "range").count().filter("count > 1").isEmpty()
    assert blocks.select(F.sum("n")).first()[0] == 300


def test_segments_are_cut_by_words(spark, ws):
    """The parts of a segment grew with its rows: their number was fixed."""
    flat = skewed(spark)
    lengths = flat.select("doc_id", F.lit(1).alias("doc_len"))
    index = SegmentedIndex(spark, ws.fresh("segments"), "body", rows_per_task=10).append(flat, lengths)
    n_files = len(spark.read.parquet(f"{index.entries[0].path}/postings").inputFiles())
    assert n_files > 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert index.read().all_postings().select("term", "doc_id").exceptAll(flat.select("term", "doc_id")).isEmpty()


def test_postings_take_one_shuffle(spark, ws):
    """Many terms were joined by a shuffle before the postings were put in order by another."""
    flat = skewed(spark).withColumn("doc_len", F.lit(1))
    for rows_per_task, hot in ((2_000_000, None), (20, [("hot", 5, 100)])):
        found = ix.hot_terms(flat, rows_per_task)
        assert (found and [tuple(r) for r in found.collect()]) == hot
        postings = ix.counted_postings(flat, 8, rows_per_task)
        plan = plan_of(postings)
        assert plan.count("Exchange rangepartitioning") == 1 and "SortMergeJoin" not in plan and "hashpartitioning" not in plan
        expected = flat.join(ix.term_statistics(flat), "term")
        columns = ["term", "doc_id", "tf", "doc_len", "df"]
        assert postings.select(columns).exceptAll(expected.select(columns)).isEmpty() and postings.count() == 300
        sums = postings.groupBy("term").agg(F.sum("cf").alias("cf"))
        assert sums.exceptAll(expected.select("term", "cf").distinct()).isEmpty()


def test_index_below_the_threshold(spark, ws):
    """Readers do not open the postings of terms below the threshold; statistics have them."""
    flat = skewed(spark)
    for name, rows, kept in (("some", flat, 1), ("none", flat.filter("term <> 'hot'"), 0), ("empty", flat.limit(0), 0)):
        root = ws.fresh("threshold")
        write_statistics(rows.select("doc_id", F.lit(1).alias("doc_len")), root, "body")
        for rows_per_task in (2_000_000, 20):
            index = build_index(rows, root, name, "body", min_df=50, rows_per_task=rows_per_task)
            assert index.postings.columns == ["term", "doc_id", "tf", "df"]
            assert index.postings.select("term").distinct().count() == kept == index.kept_terms().count()
            stats = ix.term_statistics(rows)
            assert index.term_stats.exceptAll(stats).isEmpty() and index.term_stats.count() == stats.count()


def test_lengths_meet_postings_before_queries(spark, ws):
    """Lengths too many to broadcast were joined to every hit, which shuffled and sorted all of them."""
    flat = skewed(spark).withColumn("doc_len", F.lit(1))
    built = []
    for name, rows in (("own", flat), ("other", flat.withColumn("doc_len", F.col("doc_id") + 7))):
        root = ws.fresh(name)
        write_statistics(rows.select("doc_id", "doc_len").distinct(), root, "body")
        built.append(build_index(rows, root, name, "body", 0))
    asked = flat.select("term").distinct().crossJoin(spark.range(3).withColumnRenamed("id", "query_id"))
    queries = TermTable(ws.write(asked.withColumn("qtf", F.lit(1)), "asked"))
    with session_settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        found = search.hits(built[0].with_stats_of(built[1]), queries)
        expected = flat.drop("doc_len").join(asked, "term").withColumn("doc_len", F.col("doc_id") + 7)
        columns = expected.columns
        assert found.select(columns).exceptAll(expected).isEmpty() and found.count() == 900
        scored = found.groupBy("query_id", "doc_id").agg(F.sum("doc_len"))
        plan = plan_of(scored)
        assert plan.index("SortMergeJoin [doc_id") > plan.index("BroadcastHashJoin [term")
        assert "hashpartitioning(query_id" not in plan


def test_even_text_of_large_splits_is_divided(spark, ws, monkeypatch):
    """Splits of even sizes were read whole, so that the longest task grew with them."""
    docs = spark.range(2_000).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"))
    assert rows_by_task(spread(docs))[-1] == -(-2_000 // spark.sparkContext.defaultParallelism)
    monkeypatch.setattr("lexigraph.operators.analyze.DOCS_PER_TASK", 50)
    divided = spread(docs)
    assert rows_by_task(divided)[-1] <= 60 and divided.exceptAll(docs).isEmpty() and divided.count() == 2_000


def test_postings_are_sorted_once(spark, ws):
    """Two windows of different orders sorted and buffered each posting twice."""
    plan = plan_of(ix.counted_postings(skewed(spark), 8))
    assert plan.count("Sort [") == plan.count("+- Window [") == 1


def test_only_wanted_kinds_are_counted(spark, ws):
    """Pairs and unstemmed words were counted and stored for indexes of terms, too."""
    from lexigraph.operators.build import IndexSet
    from lexigraph.plans.catalog import tables

    indexes = IndexSet(tables(spark, FOLDER).corpus, ws)
    assert indexes.index("body").postings.columns == ["term", "doc_id", "tf", "df", "doc_len"]
    assert indexes.forward("body", ("terms",)).columns == ["doc_id", "doc_len", "terms"]
    every = indexes.forward("body")
    assert every.columns == ["doc_id", "doc_len", "terms", "grams", "words"] and indexes.forward("body", ("grams",)) is every
    assert indexes.flat("body").exceptAll(every.select("doc_id", "doc_len", F.inline("terms")).select("doc_id", "doc_len", "term", "tf")).isEmpty()
    assert indexes.doc_stats("body").columns == ["doc_id", "doc_len"]


def test_one_row_is_stored_of_a_term_below_the_threshold(spark, ws):
    """All postings of such terms were written, though only their statistics are read."""
    flat = skewed(spark).withColumn("doc_len", F.lit(1))
    root = ws.fresh("below")
    write_statistics(flat.select("doc_id", "doc_len"), root, "body")
    index = build_index(flat, root, "x", "body", min_df=50)
    stored = spark.read.parquet(ix.table_path(root, "postings", "x"))
    below = stored.filter("kept = 0")
    assert below.count() == index.term_stats.filter("df <= 50").count() == 40
    assert below.filter("doc_id IS NOT NULL OR tf IS NOT NULL OR doc_len IS NOT NULL").isEmpty()
    assert index.term_stats.exceptAll(ix.term_statistics(flat)).isEmpty()
    assert index.postings.exceptAll(flat.filter("term = 'hot'").select("term", "doc_id", "tf", F.lit(100).cast("bigint"), "doc_len")).isEmpty()


def test_known_sizes_spare_passes_over_postings(spark, ws, monkeypatch):
    """Postings were counted, and searched for frequent terms, by passes of their own."""
    from lexigraph.operators.build import IndexSet
    from lexigraph.plans.catalog import tables

    indexes = IndexSet(tables(spark, FOLDER).corpus, ws)
    for name in ("body", "title_query_grams"):
        assert indexes._sizes(name) == (indexes.flat(name).count(), 200)
    flat = skewed(spark)
    monkeypatch.setattr(ix, "hot_terms", lambda *a: pytest.fail("there can be none"))
    few = ix.counted_postings(flat, 8, 300, most=300)
    expected = flat.join(ix.term_statistics(flat), "term").select("term", "doc_id", "df")
    assert few.select(expected.columns).exceptAll(expected).isEmpty() and few.count() == 300


def test_hits_are_summed_where_documents_meet(spark, ws):
    """Every hit was shuffled, though each posting is hit by many queries."""
    flat = skewed(spark).withColumn("doc_len", F.lit(1))
    root = ws.fresh("summed")
    write_statistics(flat.select("doc_id", "doc_len"), root, "body")
    index = build_index(flat, root, "x", "body", 0)
    for n_queries, dealt in ((1, False), (3, True)):
        asked = flat.select("term").distinct().crossJoin(spark.range(n_queries).withColumnRenamed("id", "query_id"))
        queries = TermTable(ws.write(asked.withColumn("qtf", F.lit(1)), "asked"))
        found = search.hits(index, queries, by_document=True)
        scored = found.groupBy("query_id", "doc_id").agg(F.sum("tf"))
        plan = plan_of(scored)
        assert ("hashpartitioning(query_id" in plan) != dealt and ("hashpartitioning(doc_id" in plan) == dealt
        expected = flat.join(asked, "term").select("term", "doc_id", "query_id")
        assert found.select(expected.columns).exceptAll(expected).isEmpty() and found.count() == 300 * n_queries


def test_words_of_other_ends_are_their_stems():
    import re

    from lexigraph.functions.stem import STEMMED_END, stem

    stems = ["nation", "relat", "hopp", "conting", "sky", "agre", "digit", "abli"]
    words = [s + e for s in stems for e in "abcdefghijklmnopqrstuvwxyz09_éß"]
    kept = [w for w in words if not re.search(STEMMED_END, w)]
    assert len(kept) > 100 and all(stem(w, extended) == w for w in kept for extended in (False, True))
