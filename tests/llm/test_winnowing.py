import hashlib
import random
import zlib

from lexigraph.llm import queries, winnowing
from pyspark.sql import functions as F


def chosen(text, gram, window):
    """Brute force: (position, hash) of every window's minimum, rightmost of equal ones."""
    text = text or ""
    if not text:
        return []
    code = lambda s: zlib.crc32(s.encode("utf-32-be", "surrogatepass"))
    if len(text) < gram:
        return [(0, code(text))]
    values = [code(text[i : i + gram]) for i in range(len(text) - gram + 1)]
    picks = []
    for start in range(max(1, len(values) - window + 1)):
        part = values[start : start + window]
        at = max(start + i for i, v in enumerate(part) if v == min(part))
        if not picks or picks[-1][0] != at:
            picks.append((at, values[at]))
    return picks


def texts():
    rng = random.Random(1)
    yield from ["", None, "a", "ab" * 40, "a" * 700, "\U0001f600é" * 90, "x" * 15, "y" * 16, "z" * 46, "z" * 47, "q" * 48]
    for n in (17, 40, 47, 48, 63, 64, 65, 500, 5000):
        yield "".join(rng.choice("abcdefgh ß日\U0001f600") for _ in range(n))
        yield "".join(rng.choice("ab") for _ in range(n))


def test_against_brute_force(spark):
    rows = list(enumerate(texts()))
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    for gram, window, part, piece in ((16, 32, 1000, 64), (16, 32, winnowing.PART, winnowing.PIECE), (4, 8, 50, 7), (1, 1, 9, 2), (5, 3, 64, 64)):
        packed = docs.withColumn("p", F.expr(winnowing.packed("text", gram, window, part, piece)))
        got = {r.doc_id: [(f.position, f.hash) for f in r.f] for r in packed.select("doc_id", winnowing.fingerprints("p").alias("f")).collect()}
        assert got == {i: chosen(t, gram, window) for i, t in rows}, (gram, window, part, piece)


def test_match_guarantee(spark):
    rng = random.Random(2)
    passage = "".join(rng.choice("abcdefghij ") for _ in range(winnowing.GRAM + winnowing.WINDOW - 1))
    noise = lambda n: "".join(rng.choice("klmnopqrst ") for _ in range(n))
    rows = [(i, noise(i * 37) + passage + noise(400 - i)) for i in range(12)]
    found = winnowing.winnow(spark.createDataFrame(rows, "doc_id BIGINT, text STRING")).collect()
    shared = set.intersection(*({f.hash for f in r.fingerprints} for r in found))
    assert shared
    for r in found:
        place = {f.hash: f.position for f in r.fingerprints}
        assert all(0 <= place[h] - r.doc_id * 37 < winnowing.WINDOW for h in shared)


def brute(rows):
    """Next document, edited text and likeness of (doc_id, text), by sorting all rows."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = {}
    for i, (doc_id, text) in enumerate(order):
        text, follow = text or "", order[(i + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + follow[:half]
        sets = [{h for _, h in chosen(t, winnowing.GRAM, winnowing.WINDOW)} for t in (text, edited, follow)]
        like = [len(sets[0] & s) / len(sets[0] | s) if sets[0] | s else 1.0 for s in sets[1:]]
        out[doc_id] = (len(text), edited, *like)
    return out


def test_edits_against_brute_force(spark):
    rng = random.Random(3)
    rows = [(i * 7 - 300, "".join(rng.choice("abcde ") for _ in range(rng.randrange(200)))) for i in range(300)] + [(None, "the last one"), (5000, None)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(5)
    got = {r.row.doc_id: (r.n_chars, r.edited, r.near_edited, r.near_next) for r in winnowing.edited_likeness(docs).collect()}
    assert got == brute(rows)


def test_many_rows_of_one_identifier(spark):
    rows = [(7, "same text of many rows")] * 90 + [(7, f"other {i}") for i in range(60)] + [(None, "none")] * 80 + [(1, "one"), (9, "nine")]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(6)
    found = winnowing.with_next(docs.select("doc_id", "text"), ["row.text"], bucket_rows=10).select("row.*", "next.text").toDF("doc_id", "text", "follow")
    got = found.collect()
    assert len(got) == len(rows)
    count = lambda texts: {t: sum(x == t for x in texts) for t in set(texts)}
    # Every row follows exactly one other.
    assert count([r.follow for r in got]) == count([t for _, t in rows])
    assert [r.follow for r in got if r.doc_id == 1] == ["none"]
    assert sum(r.follow == "none" for r in got if r.doc_id is None) == 79


def test_odd_rows(docs, empty):
    found = winnowing.edited_likeness(docs).select("row.*", "n_chars", "near_edited", "near_next").collect()
    assert len(found) == docs.count()
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)
    assert winnowing.edited_likeness(empty).count() == 0
    alone = winnowing.edited_likeness(docs.filter("doc_id = 1")).collect()
    assert [r.near_next for r in alone] == [1.0]
    columns = docs.withColumnRenamed("n", "fingerprints").withColumnRenamed("part", "next")
    assert "fingerprints" in winnowing.winnow(columns).columns and winnowing.winnow(columns).count() == docs.count()


def test_query(spark, folder, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    want = brute(rows)
    found = queries.op12_winnowing(spark, folder).collect()
    assert len(found) == len(rows)
    for r in found:
        n, edited, near_edited, near_next = want[r.doc_id]
        assert (r.n_chars, r.edited_sha256, r.near_edited, r.near_next) == (n, hashlib.sha256(edited.encode()).hexdigest(), near_edited, near_next)


def test_no_python(spark, folder):
    plan = queries.op12_winnowing(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
