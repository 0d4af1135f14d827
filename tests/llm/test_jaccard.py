import re
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from lexigraph.llm import jaccard as J
from lexigraph.llm import simhash
from lexigraph.llm.common import space


def brute_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {" ".join(words[i : i + 5]) for i in range(len(words) - 4)} or {" ".join(words)}


def brute(rows):
    """Component of every ``(doc_id, text)`` by all pairs."""
    sets = [brute_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
            parent[find(b)] = find(a)
    first = {}
    for k, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            first[find(k)] = min(first.get(find(k), doc_id), doc_id)
    return sorted(((d, first.get(find(k))) for k, (d, _) in enumerate(rows)), key=str)


def result(df):
    return sorted(((r.doc_id, r.component_id) for r in df.collect()), key=str)


@pytest.mark.parametrize("block", [2, J.BLOCK])
def test_whole_table(documents, block):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert result(J.near_duplicates(documents, block)) == brute(rows)


def test_stage_keeps_one_of_each_component(spark, documents, folder):
    letters = documents.filter(F.col("text").rlike(r"\p{L}"))
    want = {d for d, c in brute([(r.doc_id, r.text) for r in letters.collect()]) if d == c}
    assert {r.doc_id for r in P.near_dedup(spark, letters, folder).collect()} == want


def test_pairs_from_four_fifths_on(spark, folder):
    """Pairs of 108 shingles at 0.8 and just above are joined, those just below are not."""
    rng = np.random.default_rng(5)
    rows = []
    for pair in range(200):
        words = [f"w{n}" for n in rng.integers(0, 1 << 40, 112)]
        cut = 10 + pair % 4
        # The similarity is 108 - cut of 108 + cut.
        rows += [(2 * pair, " ".join(words)), (2 * pair + 1, " ".join(words[cut:] + [f"x{n}" for n in rng.integers(0, 1 << 40, cut)]))]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    kept = {r.doc_id for r in P.near_dedup(spark, docs, folder).collect()}
    for pair in range(200):
        shared, cut = 108 - (10 + pair % 4), 10 + pair % 4
        assert 2 * pair in kept and (2 * pair + 1 in kept) == (5 * shared < 4 * (108 + cut))


def test_candidates_share_a_key():
    rng = np.random.default_rng(7)
    met = [0, 0]
    for _ in range(500):
        values = rng.integers(0, 1 << 63, 100, dtype=np.uint64)
        a, b = values[:90], values[10:]
        met[0] += bool((J.bands(np.unique(a)) == J.bands(np.unique(b))).any())
        met[1] += bool((J.bands(np.unique(a[:45])) == J.bands(np.unique(b))).any())
    assert met[0] == 500 > met[1]


def test_groups_and_odd_rows(spark, docs, empty):
    rng = np.random.default_rng(9)
    base = [f"w{n}" for n in rng.integers(0, 1000, 120)]
    chain = [(100 + k, " ".join(base[k * 2 :] + base[: k * 2])) for k in range(40)]
    many = spark.createDataFrame(chain + [(None, "a b"), (None, None), (7, "a  B"), (9, "")], "doc_id BIGINT, text STRING")
    rows = [(r.doc_id, r.text) for r in many.collect()]
    for block in (3, J.BLOCK):
        assert result(J.near_duplicates(many, block)) == brute(rows)
    assert result(J.near_duplicates(docs)) == brute([(r.doc_id, r.text) for r in docs.collect()])
    kept = simhash.keep_one(docs, J.near_duplicates)
    assert kept.columns == docs.columns and simhash.keep_one(empty, J.near_duplicates).collect() == []


def test_stages_after_near_dedup(spark, documents, folder):
    """The stages after near-dedup on what it keeps."""
    work, docs = space(spark, "test"), documents
    for name, stage in P.STAGES[:4]:
        docs = work.write(stage(spark, docs, folder), name)
    rows = P.pieces(spark, docs, folder).collect()
    assert len(rows) == docs.count() and all(r.n_pieces == len(r.piece_ids) for r in rows)


def test_simhash_links_are_candidates_and_checked(spark):
    """Texts of one fingerprint or of near ones are found without MinHash keys; dissimilar ones are not linked."""
    rng = np.random.default_rng(11)
    words = [f"w{n}" for n in rng.integers(0, 1 << 40, 400)]
    texts = [" ".join(words), " ".join(words[:-1] + ["x"]), " ".join(words) + " y", " ".join(words[::-1])]
    fps = [simhash.fingerprint(t, J.SHINGLE) for t in texts]
    assert all(((fp ^ fps[0]) & ((1 << 64) - 1)).bit_count() <= simhash.RADIUS // 2 for fp in fps[:3])
    # The last text is not similar, whatever its fingerprint says.
    rows = [(k, k, fp) for k, fp in enumerate([*fps[:3], fps[0]])]
    nodes = spark.createDataFrame(rows, "node BIGINT, text_key BIGINT, fp BIGINT")
    found = J.covered(nodes, spark.createDataFrame(list(enumerate(texts)), "text_key BIGINT, text STRING"), space(spark, "test"))
    linked = {frozenset((r.a, r.b)) for r in found.collect()}
    assert linked == {frozenset((0, 1)), frozenset((0, 2))} or linked == {frozenset((0, 1)), frozenset((1, 2))}
    assert not any(3 in pair for pair in linked)


@pytest.mark.parametrize("fps", [(0, 0, 0), (0, 1, 2)])
@pytest.mark.parametrize("block", [1, J.BLOCK])
def test_every_pair_within_the_radius_is_checked(spark, fps, block):
    """Two similar texts, linked to each other's fingerprints by way of a dissimilar text in the forest."""
    rng = np.random.default_rng(13)
    words = [f"w{n}" for n in rng.integers(0, 1 << 40, 100)]
    texts = [" ".join(words[::-1]), " ".join(words), " ".join(words) + " y"]
    nodes = spark.createDataFrame([(k, k, fp) for k, fp in enumerate(fps)], "node BIGINT, text_key BIGINT, fp BIGINT")
    found = J.covered(nodes, spark.createDataFrame(list(enumerate(texts)), "text_key BIGINT, text STRING"), space(spark, "test"), block)
    assert {frozenset((r.a, r.b)) for r in found.collect()} == {frozenset((1, 2))}


def test_buckets_inside_a_known_component_are_left_alone(spark):
    """Of three similar texts two are known to be linked; the third still joins them."""
    words = [f"w{n}" for n in range(100)]
    texts = [" ".join(words), " ".join(words) + " x", " ".join(words) + " y", "a b c d e f"]
    rows = [(k, k, 0, J.bands(J.shingles(t)).tolist()) for k, t in enumerate(texts)]
    nodes = spark.createDataFrame(rows, "node BIGINT, text_key BIGINT, fp BIGINT, bands ARRAY<BIGINT>")
    texts = spark.createDataFrame(list(enumerate(texts)), "text_key BIGINT, text STRING")

    def ends(*known):
        known = spark.createDataFrame(known, "node BIGINT, root BIGINT")
        return {x for r in J.links(nodes, texts, space(spark, "test"), known=known).collect() for x in (r.a, r.b)}

    assert 2 in ends((0, 0), (1, 0)) and ends((0, 0), (1, 0), (2, 0)) == set()
