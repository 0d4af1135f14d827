import hashlib
import random
import zlib

import pytest
from lexigraph.llm import prefix_trie, queries
from pyspark.sql import functions as F

SCHEMA = "conv_id BIGINT, turn BIGINT, role STRING, text STRING"


def sequences(rows):
    """Conversations' (role, text) lists in order."""
    out = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            key = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            out.setdefault(conv, []).append((turn is not None, turn or 0, key, (role, text)))
    return {c: [t[-1] for t in sorted(v)] for c, v in out.items()}


def brute(convs):
    """One row for each distinct prefix."""
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    words = lambda p: len([w for w in p[-1][1].replace("\t", " ").replace("\n", " ").split(" ") if w]) if p else 0
    out = []
    for p, m in members.items():
        below = [q for q in members if q[: len(p)] == p]
        children = [q for q in below if len(q) == len(p) + 1]
        leaves = [q for q in below if not any(len(r) == len(q) + 1 and r[: len(q)] == q for r in below)]
        ends = ",".join(str(c) for c in sorted(m) if len(convs[c]) == len(p))
        parent = min(members[p[:-1]]) if p else None
        saved = sum((len(members[q]) - 1) * words(q) for q in below)
        out.append((min(m), len(p), parent, len(m), len(children), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def result(df):
    columns = [c.split()[0] for c in prefix_trie.NODE.split(", ")]
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    out = []
    for c in range(220):
        same = [("user", "hello there"), ("assistant", "hi what\tcan I do")][: rng.randrange(3)]
        turns = same + [(rng.choice(["user", "assistant", None]), rng.choice(["a b", "", None, "c d e"])) for _ in range(rng.randrange(5))]
        if c % 4 == 0:
            turns = [("user", "copy"), ("assistant", "of many"), ("user", "times")]
        out += [(c * 3 - 50, i, *t) for i, t in enumerate(turns)]
    out += [(None, 0, "user", "nobody's"), (9999, None, "user", "no number"), (9999, -5, None, None), (9999, 3, "x", "tie"), (9999, 3, "x", "other tie"), (9998, 1, "x", "twice"), (9998, 1, "x", "twice")]
    return out


@pytest.mark.parametrize("shards", [1, 5, 40])
def test_against_brute_force(spark, rows, shards):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(shards))
    try:
        df = spark.createDataFrame(rows, SCHEMA).withColumn("id", F.lit("x")).withColumn("turns", F.lit(1)).withColumn("digest", F.lit(None))
        assert result(prefix_trie.shared_prefixes(df.repartition(3))) == brute(sequences(rows))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_borrowed_heads(spark, rows):
    conv = F.col("conv_id")
    found = prefix_trie.shared_prefixes(spark.createDataFrame(rows, SCHEMA), (F.crc32(conv.cast("string")) % 4).cast("int"), conv - conv % 20, most=3)
    own = sequences(rows)
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        source = c - (c % 20 if c >= 0 else -(-c % 20))
        rebuilt[c] = own.get(source, [])[:h] + turns[h:]
    assert any(not t for t in rebuilt.values())
    assert result(found) == brute(rebuilt)


def test_odd_tables(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    assert prefix_trie.shared_prefixes(df.filter("false")).count() == 0
    assert prefix_trie.shared_prefixes(df.filter("conv_id IS NULL")).count() == 0
    one = [r for r in rows if r[0] == 9999]
    assert result(prefix_trie.shared_prefixes(spark.createDataFrame(one, SCHEMA))) == brute(sequences(one))


def test_one_long_conversation_and_one_hot_turn(spark):
    rows = [(1, i, "user", str(i % 7)) for i in range(3000)] + [(c, 0, "user", "hot") for c in range(2, 2000)]
    got = {(r.conv_id, r.depth): r for r in prefix_trie.shared_prefixes(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(got) == 3002
    assert got[1, 0].n_convs == 1999 and got[1, 0].n_leaves == 2 and got[2, 1].n_convs == 1998
    ids = ",".join(map(str, range(2, 2000)))
    assert got[2, 1].ends_sha256 == hashlib.sha256(ids.encode()).hexdigest()


def test_tree_is_balanced_and_ordered():
    tree = prefix_trie.TernaryTree()
    rows = [([i, i + 1], [1, 1]) for i in range(1023)]
    nodes = tree.insert_balanced(rows)
    order = tree.in_order()
    assert [tree.turn[n] for n in order if tree.parent[n] == 0] == list(range(1023))
    assert len(set(nodes)) == 1023 and len(order) == 2047

    def height(at):
        return 0 if at < 0 else 1 + max(height(tree.lo[at]), height(tree.hi[at]))

    assert height(tree.eq[0]) == 10


def test_query(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    own, rebuilt = sequences(rows), {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    assert result(queries.op11_prefix_trie(spark, folder)) == brute(rebuilt)
