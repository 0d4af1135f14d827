import hashlib
import re

from pyspark.sql import functions as F

from lexigraph.llm.exact_dedup import ExactDedup, digest_of, exact_dedup


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r.text or ""), []).append(r.doc_id)
    found = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        sha = hashlib.sha256(text.encode()).hexdigest()
        found += [(i, keep, len(ids), i == keep, sha) for i in ids]
    return sorted(found, key=str)


def result(df):
    return sorted(map(tuple, df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=str)


def test_odd_rows(docs, empty):
    out = exact_dedup(docs)
    assert result(out) == brute(docs.collect())
    assert {"part", "parts", "digest", "n"} <= set(out.columns)
    assert exact_dedup(empty).collect() == []


def test_equal_digests_are_told_apart_by_their_bytes(docs):
    """With a digest of no bits every row hits; full texts decide."""
    out = exact_dedup(docs, digest=lambda t: F.substring(digest_of(t), 1, 0))
    assert [r[:4] for r in result(out)] == [r[:4] for r in brute(docs.collect())] or sorted(
        r[:4] for r in map(lambda x: tuple(map(str, x)), result(out))
    ) == sorted(r[:4] for r in map(lambda x: tuple(map(str, x)), brute(docs.collect())))


def test_state_outlives_a_batch(spark, documents):
    dedup = ExactDedup(spark)
    first, second = documents.filter("doc_id % 2 = 1"), documents.filter("doc_id % 2 = 0")
    dedup.admit(first, F.lit("one"))
    assert result(dedup.decide(first)) == brute(first.collect())
    again = ExactDedup(spark, dedup.root)
    again.admit(second, F.lit("two"))
    assert result(again.decide(documents)) == brute(documents.collect())
    assert {r.locator for r in again.state().select("locator").distinct().collect()} == {"one", "two"}


def test_hot_digest(spark):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, "same").otherwise(F.col("id").cast("string")).alias("text"))
    dedup = ExactDedup(spark)
    dedup.admit(docs)
    assert result(dedup.decide(docs, rows_per_task=100)) == brute(docs.collect())


def test_no_state_store_stays_open(spark, documents):
    """Stores stayed in the executor's memory until the next maintenance, one for each partition."""
    module = spark._jvm.java.lang.Class.forName("org.apache.spark.sql.execution.streaming.state.StateStore$")
    loaded = module.getDeclaredField("loadedProviders")
    loaded.setAccessible(True)
    stores = loaded.get(module.getField("MODULE$").get(None))
    before = stores.size()
    dedup = ExactDedup(spark)
    dedup.admit(documents)
    assert stores.size() <= before
    assert result(dedup.decide(documents)) == brute(documents.collect())
