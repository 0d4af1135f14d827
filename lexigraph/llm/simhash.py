"""SimHash near-duplicates by covering locality-sensitive hashing.

A text's fingerprint has 64 bits, each the majority of that bit over the XXH64 hashes of its
word shingles. Fingerprints at most ``RADIUS`` = 4 bits apart are linked. To find them, every
bit position gets a non-zero vector of 5 bits, and each of the 31 non-zero vectors v gives
one table, whose key keeps the positions with odd <vector, v>. The vectors of any four
positions lie in a hyperplane, so some v leaves out all four: two fingerprints within the
radius share a key in at least one table, always.

Keys keep about half of the bits. In a bucket of a few thousand fingerprints all distances
are computed in one task, which emits a spanning forest of the true links. Larger buckets
are dealt out again by the same construction over the positions their key leaves free,
until at most eight positions (256 fingerprints) are free; nothing is cut off.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.skew import hot_keys, spread_join
from .common import space, small_batches, text_or_empty
from .components import components

RADIUS = 4
SHINGLE = 4
SEED = 42
#: Shingles hashed at a time, which bounds the memory of very long texts.
CHUNK = 200_000
#: Fingerprints of a bucket that one task compares with each other.
BUCKET = 4_096

BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)
LANES = (np.arange(8) * 256).astype(np.int64)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The signed 64-bit fingerprint; null and texts without words give 0."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    width = min(shingle, len(words))
    first, last = starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist()
    digest, counts = xxhash.xxh64_digest, np.zeros(2048, np.int64)
    for at in range(0, len(first), CHUNK):
        spans = zip(first[at : at + CHUNK], last[at : at + CHUNK])
        packed = b"".join([digest(joined[a:b], SEED) for a, b in spans])
        lanes = np.frombuffer(packed, np.uint8).reshape(-1, 8) + LANES
        counts += np.bincount(lanes.ravel(), minlength=2048)
    ones = (counts.reshape(8, 256) @ BITS).ravel()
    return int(np.packbits(ones * 2 > len(first)).view(">i8")[0])


def with_fingerprints(docs: DataFrame, name: str = "fp", shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with the fingerprint of ``text`` as a long column."""

    @F.pandas_udf("long")
    def of(texts):
        return texts.map(lambda t: fingerprint(t, shingle))

    return docs.withColumn(name, of("text"))


def hexadecimal(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def tables(free: list[int]) -> list[tuple[int, list[int]]]:
    """``(mask, positions still free)`` of each of the 31 tables over the ``free`` positions.

    A mask also keeps every position that was not free. Up to 16 positions get vectors with a
    first component of 1, so that every table keeps about half of them at least; more
    positions share all 31 vectors evenly.
    """
    few = len(free) <= 16
    vectors = [16 + i % 16 if few else 1 + i % 31 for i in range(len(free))]
    found = []
    for v in range(1, 32):
        rest = [p for p, x in zip(free, vectors) if (x & v).bit_count() % 2 == 0]
        mask = ((1 << 64) - 1) ^ sum(1 << p for p in rest)
        found.append((mask - (1 << 64) if mask >> 63 else mask, rest))
    return found


def forest(fps: np.ndarray, radius: int = RADIUS) -> list[tuple[int, np.ndarray]]:
    """Stars ``(centre, others)`` that make up a spanning forest of the links between ``fps``."""
    left, stars = fps.view(np.uint64), []
    while len(left) > 1:
        front, left = [left[0]], left[1:]
        while front and len(left):
            head = front.pop()
            near = np.bitwise_count(left ^ head) <= radius
            if near.any():
                reached = left[near]
                stars.append((int(head.view(np.int64)), reached.view(np.int64)))
                front.extend(reached)
                left = left[~near]
    return stars


def _compare(radius: int, most: int):
    """Links within each bucket of sorted rows; the rows of larger buckets come back to be split."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(path, a, b):
            columns = [pa.array(x, pa.int64()) for x in (path, a, b)]
            return pa.RecordBatch.from_arrays(columns, ["path", "a", "b"])

        def split(fps):
            return batch(np.full(len(fps), now[0]), [None] * len(fps), fps)

        now, held, count, stars, waiting = None, [], 0, [], 0

        def flush():
            nonlocal stars, waiting
            if stars:
                a = np.concatenate([np.full(len(x), c) for c, x in stars])
                yield batch([None] * len(a), a, np.concatenate([x for _, x in stars]))
            stars, waiting = [], 0

        def close():
            nonlocal waiting
            if 2 <= count <= most:
                new = forest(np.concatenate(held), radius)
                stars.extend(new)
                waiting += sum(len(x) for _, x in new)
                if waiting > 10_000:
                    yield from flush()

        for rows in batches:
            if not rows.num_rows:
                continue
            path, key, fps = (rows.column(c).to_numpy() for c in ("path", "key", "fp"))
            starts = np.concatenate([[0], np.flatnonzero((path[1:] != path[:-1]) | (key[1:] != key[:-1])) + 1])
            stops = np.append(starts[1:], len(fps))
            # Most buckets have one member; only the first and last may go on in another batch.
            many = stops - starts > 1
            many[[0, -1]] = True
            for a, b in zip(starts[many].tolist(), stops[many].tolist()):
                if (path[a], key[a]) != now:
                    yield from close()
                    now, held, count = (path[a], key[a]), [], 0
                if count <= most < count + b - a:
                    yield from map(split, held)
                    held = []
                count += b - a
                if count > most:
                    yield split(fps[a:b])
                else:
                    held.append(fps[a:b])
        yield from close()
        yield from flush()

    return run


def links(fps: DataFrame, radius: int = RADIUS, most: int = BUCKET, work=None) -> DataFrame:
    """``a, b``: links whose components are those of all pairs within the radius.

    ``fps`` has distinct values in ``fp``. A level deals every fingerprint to its buckets;
    buckets with more than ``most`` members go on to the next level, over free positions only.
    """
    if radius > RADIUS:
        raise ValueError("31 tables cover a radius of four at most")
    spark = fps.sparkSession
    work = work or space(spark, "simhash_links")
    free, rows, found = {0: list(range(64))}, fps.select("fp", F.lit(0).cast("bigint").alias("path")), []
    while free:
        # One mask for each table and path: 31, then at most 31 * 31 and 31 * 31 * 31.
        deals = {p: [(32 * p + i, *t) for i, t in enumerate(tables(at), 1)] for p, at in free.items()}
        below = {to: rest for row in deals.values() for to, _, rest in row}
        masks = spark.createDataFrame(
            [(p, [(to, mask) for to, mask, _ in row]) for p, row in deals.items()],
            "path BIGINT, tables ARRAY<STRUCT<to: BIGINT, mask: BIGINT>>",
        )
        dealt = rows.join(F.broadcast(masks), "path").select("fp", F.explode("tables").alias("t"))
        keyed = dealt.select("fp", F.col("t.to").alias("path"), F.col("fp").bitwiseAND(F.col("t.mask")).alias("key"))
        placed = keyed.repartition("path", "key").sortWithinPartitions("path", "key")
        # The last level leaves eight positions free, 256 fingerprints for a bucket.
        limit = most if max(map(len, below.values())) > 8 else 1 << 62
        out = work.write(placed.mapInArrow(_compare(radius, limit), "path BIGINT, a BIGINT, b BIGINT"), "compared")
        found.append(out.filter("path IS NULL").select("a", "b"))
        rows = out.filter("path IS NOT NULL").select(F.col("b").alias("fp"), "path")
        free = {r["path"]: below[r["path"]] for r in rows.select("path").distinct().collect()}
    return reduce(DataFrame.union, found)


def near_duplicates(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE, most: int = BUCKET) -> DataFrame:
    """``doc_id, text_key, fp, component_id`` for every row of ``docs``; the key is a text's hash.

    The component's identifier is the smallest ``doc_id`` reachable by links, null only if no
    document of the component has one. Null and empty texts have fingerprint 0 and link like
    any other; an empty table gives no rows; columns beyond ``doc_id`` and ``text`` are ignored.
    """
    work = space(docs.sparkSession, "simhash")
    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    with small_batches(docs.sparkSession):
        prints = with_fingerprints(own, shingle=shingle).select("doc_id", F.xxhash64("text").alias("text_key"), "fp")
        prints = work.write(prints, "fingerprints")
    nodes = work.write(prints.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")), "distinct")
    roots = components(links(nodes, radius, most, work), work).withColumnRenamed("node", "fp")
    placed = work.write(
        nodes.join(roots, "fp", "left").select("fp", "first", "n", F.coalesce("root", "fp").alias("root")), "placed"
    )
    least = placed.groupBy("root").agg(F.min("first").alias("component_id"), F.sum("n").alias("n"))
    classes = spread_join(placed.drop("n"), least.drop("n"), "root", "fp", hot_keys(placed.groupBy("root").agg(F.count("*").alias("n")), "root", "n"))
    classes = work.write(classes.select("fp", "component_id"), "classes")
    return spread_join(prints, classes, "fp", "doc_id", hot_keys(nodes, "fp", "n")).select(
        "doc_id", "text_key", "fp", "component_id"
    )


def keep_one(docs: DataFrame, find=near_duplicates, **parameters) -> DataFrame:
    """The rows of ``docs`` whose ``doc_id`` is the smallest of its component.

    ``find`` gives ``doc_id, text_key, component_id`` of every row. Documents without an identifier stay only if their component has none with one.
    """
    found = find(docs, **parameters)
    first = found.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(
        F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")
    )
    same = docs["doc_id"].cast("bigint").eqNullSafe(first["__id"]) & (F.xxhash64(text_or_empty(docs["text"])) == first["__key"])
    return docs.join(first, same, "left_semi")
