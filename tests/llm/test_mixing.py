import hashlib
import re
from collections import Counter
from math import floor, isclose

import pytest
from pyspark.sql import functions as F

from lexigraph.llm import mixing as M


def fill(sizes, most=3, cycle=3):
    """Targets by sharing the excess again and again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % cycle + 1 for i, s in enumerate(order)}
    capped: set = set()
    while True:
        free = [s for s in order if s not in capped]
        left = sum(sizes.values()) - sum(most * sizes[s] for s in capped)
        target = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if target[s] > most * sizes[s]}
        if not over:
            return {s: most * sizes[s] for s in capped} | target
        capped |= over


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def check(docs):
    rows = M.mixing_plan(docs).collect()
    sizes = Counter()
    for r in docs.collect():
        sizes[r.source] += words(r.text)
    target = fill(dict(sizes))
    for r in rows:
        rate = target[r.source] / sizes[r.source] if sizes[r.source] else 0
        digest = hashlib.md5((r.text or "").encode()).hexdigest()
        u = int(hashlib.md5(f"mix|{'' if r.doc_id is None else r.doc_id}|{digest}".encode()).hexdigest()[:13], 16) / 2**52
        copies = floor(rate) + (u < rate - floor(rate))
        assert isclose(r.target, target[r.source], rel_tol=1e-9, abs_tol=1e-9)
        assert (r.source_size, r.copies, r.taken) == (sizes[r.source], copies, words(r.text) * copies)
    return rows


@pytest.mark.parametrize("sizes", [{"a": 1, "b": 1, "c": 1}, {"a": 1, "b": 1000, "c": 3, None: 50, "d": 2}, {"x": 5}, {"a": 0, "b": 9, "c": 1}])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source STRING, source_size BIGINT")
    found = {r.source: r.target for r in M.source_targets(df).collect()}
    want = fill(sizes)
    assert all(isclose(found[s], want[s], abs_tol=1e-9) for s in sizes)
    assert isclose(sum(found.values()), sum(sizes.values()), abs_tol=1e-6)


def test_odd_rows(docs, empty):
    rows = check(docs)
    assert len(rows) == docs.count()
    out = M.mix(docs)
    assert out.columns == docs.columns
    assert out.count() == sum(r.copies for r in rows)
    assert M.mixing_plan(empty).collect() == [] == M.mix(empty).collect()


def test_whole_table(documents):
    check(documents)
    taken = M.mixing_plan(documents).groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("w"))
    total = taken.agg(F.sum("t").alias("t"), F.sum("w").alias("w")).first()
    assert abs(total.t / total.w - 1) < 0.25


@pytest.mark.parametrize("doc_id", [None, 7])
def test_rows_without_or_with_the_same_identifier_draw_apart(spark, doc_id):
    rows = [(doc_id, f"word{i} b c d", "a") for i in range(1500)] + [(i, "w " * 6, "b") for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, source STRING")
    taken = {r.source: r for r in M.mixing_plan(docs).groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("w")).collect()}
    assert abs(taken["a"].t / taken["a"].w - 1) < 0.06


def test_many_sources_are_joined(documents, monkeypatch):
    want = sorted((r.doc_id, r.copies) for r in M.mixing_plan(documents).collect())
    monkeypatch.setattr(M, "BROADCAST_SOURCES", 0)
    assert sorted((r.doc_id, r.copies) for r in M.mixing_plan(documents).collect()) == want
