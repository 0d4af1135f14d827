import re
from itertools import combinations

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexigraph.llm import simhash as S
from lexigraph.llm.common import space
from lexigraph.llm.components import components


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(nodes, linked):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def brute(rows):
    prints = [(r.doc_id, brute_fingerprint(r.text)) for r in rows]
    values = sorted({p for _, p in prints})
    root = roots(values, [(a, b) for a, b in combinations(values, 2) if (a ^ b).bit_count() <= 4])
    first = {}
    for doc_id, p in prints:
        if doc_id is not None:
            first[root[p]] = min(first.get(root[p], doc_id), doc_id)
    return sorted(((d, p, first.get(root[p])) for d, p in prints), key=str)


def result(df):
    return sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in df.collect()), key=str)


@settings(deadline=None)
@given(st.text(alphabet="aB \t\nÉé☃x", max_size=80))
def test_fingerprint(text):
    assert S.fingerprint(text) % (1 << 64) == brute_fingerprint(text)


@settings(deadline=None)
@given(st.sets(st.integers(0, 63), max_size=4), st.integers(0, 2**64 - 1))
def test_every_pair_within_the_radius_meets_at_every_level(bits, value):
    other = value
    for b in bits:
        other ^= 1 << b
    free = list(range(64))
    for _ in range(3):
        met = [rest for mask, rest in S.tables(free) if (value ^ other) & mask == 0]
        assert met
        free = max(met, key=len)
    assert len(free) <= 8


def test_keys_keep_about_half_of_the_positions():
    assert all(30 <= len(rest) <= 34 for _, rest in S.tables(list(range(64))))


def test_forest_spans():
    rng = np.random.default_rng(1)
    fps = np.unique(rng.integers(0, 1 << 12, 300)).astype(np.int64)
    pairs = [(c, int(x)) for c, others in S.forest(fps, 2) for x in others]
    assert all((a ^ b).bit_count() <= 2 for a, b in pairs)
    values = fps.tolist()
    true = [(a, b) for a, b in combinations(values, 2) if (a ^ b).bit_count() <= 2]
    assert roots(values, pairs) == roots(values, true) and len(pairs) == len(values) - len(set(roots(values, true).values()))


@pytest.mark.parametrize("most", [2, S.BUCKET])
def test_whole_table(documents, most):
    assert result(S.near_duplicates(documents, most=most)) == brute(documents.collect())


def test_odd_rows(docs, empty):
    assert result(S.near_duplicates(docs)) == brute(docs.collect())
    kept = S.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(d) for d, _, c in brute(docs.collect()) if d == c)
    assert S.near_duplicates(empty).collect() == [] == S.keep_one(empty).collect()


def test_dense_buckets_are_split(spark):
    """400 fingerprints within a few bits of each other, in buckets of at most 20."""
    rng = np.random.default_rng(3)
    values = np.unique([int(sum(1 << int(b) for b in rng.choice(64, 3, replace=False))) for _ in range(400)]).astype(np.uint64).view(np.int64).tolist()
    found = S.links(spark.createDataFrame([(v,) for v in values], "fp BIGINT"), most=20).collect()
    pairs = [(r.a, r.b) for r in found]
    mask = (1 << 64) - 1
    assert all(((a & mask) ^ (b & mask)).bit_count() <= 4 for a, b in pairs)
    true = [(a, b) for a, b in combinations(values, 2) if ((a & mask) ^ (b & mask)).bit_count() <= 4]
    assert roots(values, pairs) == roots(values, true)


def test_components_of_long_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(200, i) for i in range(201, 260)] + [(300, 299), (299, 300), (5, 5)]
    df = spark.createDataFrame(links, "a BIGINT, b BIGINT")
    found = {r.node: r.root for r in components(df, space(spark, "test")).collect()}
    nodes = {n for link in links for n in link} - {5}
    assert found == roots(nodes, [x for x in links if x[0] != x[1]])
    assert components(df.filter("false"), space(spark, "test")).collect() == []


def test_hubs_are_divided(spark):
    """Stars, a long chain and a second star joined to it; every key of more than 50 rows is hot."""
    links = [(0, i) for i in range(1, 400)] + [(i, i + 1) for i in range(1000, 1300)] + [(5000, i) for i in range(6000, 6300)] + [(1300, 6299), (9, 8)]
    df = spark.createDataFrame(links, "a BIGINT, b BIGINT")
    want = roots({n for link in links for n in link}, links)
    assert {r.node: r.root for r in components(df, space(spark, "test"), rows_per_task=50).collect()} == want
