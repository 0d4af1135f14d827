"""Near-duplicate vectors by randomised-rotation binary codes.

Unit vectors are turned by random rotations fixed by a seed; the signs of the turned
components are their code. A vector also stores the correction factor <code, vector>, the
inner product of the turned vector with its scaled signs. For a code and another, uncoded
vector, <code, other> / <code, vector> is an unbiased estimate of <vector, other>, and its
error stays below ``EPSILON * sqrt((1 - f^2) / f^2 / (D - 1))`` but with vanishing
probability. Pairs whose upper bound reaches the threshold are computed again exactly, in
double precision; only exact values link.

Candidates share a key, that is ``k`` consecutive bits of the code, in one of ``L`` tables.
Two vectors at the threshold agree in a bit with probability 1 - angle / pi; ``k`` grows with
the logarithm of the number of vectors, so that buckets stay small, and ``L`` is chosen so
that such a pair shares a key with probability ``RECALL`` (closer pairs more often). Buckets
of many vectors are compared in blocks, each pair of blocks a group of its own; nothing is
cut off. A pair that meets in several tables counts in the first. What is dealt to a bucket is
the vector, in single precision where that is exact, and the bits of the tables before it; the
code is the first of these bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import acos, ceil, log, log2, pi

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.skew import hot_keys, spread_join
from .common import space
from .components import components

THRESHOLD = 0.9
RECALL = 0.995
EPSILON = 4.0
SEED = 7
#: Vectors of a bucket that are compared in one group.
BLOCK = 4_096
#: Rows of a block's comparison held at a time.
ROWS = 256
BROADCAST_BUCKETS = 500_000


def plan_tables(n: int, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[int, int]:
    """Bits of a key and number of tables for ``n`` vectors."""
    bits = min(30, max(8, ceil(log2(max(n, 1) / 8)))) if n > 8 else 8
    agree = 1 - acos(threshold) / pi
    return bits, ceil(-log(1 - recall) / agree**bits)


class Rotations:
    """Random rotations of one dimension, made from the seed in each Python worker."""

    _made: dict[tuple[int, int, int], Rotations] = {}

    def __init__(self, dim: int, count: int, seed: int):
        rng = np.random.default_rng([seed, dim])
        turns = [np.linalg.qr(rng.standard_normal((dim, dim)))[0] for _ in range(count)]
        self.first, self.all = turns[0], np.hstack(turns)

    @classmethod
    def of(cls, dim: int, bits: int, seed: int) -> Rotations:
        key = (dim, -(-bits // dim), seed)
        if key not in cls._made:
            cls._made[key] = cls(*key)
        return cls._made[key]


def packed(vector: np.ndarray) -> bytes:
    """The bytes of a vector behind a letter: ``f`` for floats, if they hold it exactly, or ``d``."""
    short = vector.astype("<f4")
    return b"f" + short.tobytes() if (short == vector).all() else b"d" + vector.astype("<f8").tobytes()


def unpacked(raw: list[bytes]) -> np.ndarray:
    """The vectors, all of one length, in double precision, one a row."""
    return np.stack([np.frombuffer(r, "<f4" if r[:1] == b"f" else "<f8", offset=1) for r in raw]).astype("<f8")


def table_keys(signs: np.ndarray, tables: int, bits: int) -> np.ndarray:
    """The keys of the first ``tables`` tables from packed sign bits, one row a vector."""
    powers = (1 << np.arange(bits)).astype(np.int32)
    out = np.empty((len(signs), tables), np.int32)
    for a in range(0, len(signs), ROWS):
        wide = np.unpackbits(signs[a : a + ROWS], axis=1)[:, : tables * bits]
        out[a : a + ROWS] = wide.reshape(len(wide), tables, bits).astype(np.int32) @ powers
    return out


def _code(bits: int, tables: int, seed: int):
    """Keys of all tables, the signs that they and the code are made of, and the code's correction factor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            ids, dims = rows.column("id"), rows.column("dim").to_numpy()
            raw = rows.column("vec").to_pylist()
            for dim in np.unique(dims):
                mine = np.flatnonzero(dims == dim)
                vectors = unpacked([raw[i] for i in mine])
                turns = Rotations.of(int(dim), bits * tables, seed)
                unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
                turned = unit @ turns.all
                signs = np.packbits(turned[:, : max(bits * tables, int(dim))] > 0, axis=1)
                keys = table_keys(signs, tables, bits)
                factor = np.abs(turned[:, :dim]).sum(axis=1) / np.sqrt(dim)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(mine)),
                        pa.array(np.full(len(mine), dim), pa.int32()),
                        rows.column("vec").take(pa.array(mine)),
                        pa.array([s.tobytes() for s in signs], pa.binary()),
                        pa.array(factor),
                        rows.column("mult").take(pa.array(mine)),
                        pa.FixedSizeListArray.from_arrays(pa.array(keys.ravel()), tables).cast(pa.list_(pa.int32())),
                    ],
                    ["id", "dim", "vec", "signs", "factor", "mult", "keys"],
                )

    return run


def scaled(vector: np.ndarray) -> np.ndarray:
    """The vector times the power of two that brings its largest component to 0.5 up to 1.

    Exact, so no cosine changes, and squares neither overflow nor vanish.
    """
    return np.ldexp(vector, -np.frexp(np.abs(vector).max())[1])


def linked(vectors: np.ndarray, codes: np.ndarray, factors: np.ndarray, threshold: float, seed: int, split: int = 0):
    """Pairs ``(i, j)``, i < j, with exact cosine at the threshold or above.

    With ``split``, only pairs of a row before it with one from it on.
    """
    n, dim = vectors.shape
    norms = np.linalg.norm(vectors, axis=1)
    unit = vectors / norms[:, None]
    turned = (unit @ Rotations.of(dim, dim, seed).first).astype(np.float32) if dim > 1 else unit.astype(np.float32)
    signs = (np.unpackbits(codes, axis=1)[:, :dim].astype(np.float32) * 2 - 1) / np.float32(np.sqrt(dim))
    error = (EPSILON * np.sqrt(np.maximum(0, 1 - factors**2) / factors**2 / max(1, dim - 1))).astype(np.float32)
    factors = factors.astype(np.float32)
    for a in range(0, split or n, ROWS):
        b = min(a + ROWS, split or n)
        low = split or a
        forth = signs[a:b] @ turned[low:].T / factors[a:b, None] + error[a:b, None]
        back = turned[a:b] @ signs[low:].T / factors[None, low:] + error[None, low:]
        maybe = np.minimum(forth, back) >= threshold
        if not split:
            maybe &= np.arange(low, n)[None, :] > np.arange(a, b)[:, None]
        i, j = np.nonzero(maybe)
        i, j = i + a, j + low
        for at in range(0, len(i), 1 << 16):
            p, q = i[at : at + (1 << 16)], j[at : at + (1 << 16)]
            cosine = np.einsum("ij,ij->i", vectors[p], vectors[q]) / (norms[p] * norms[q])
            keep = cosine >= threshold
            yield p[keep], q[keep]


def _compare(threshold: float, seed: int, bits: int):
    """``a, b`` of a spanning forest of each group's links; ``a, n`` counts of links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def group(table: int, split: int, rows: pa.Table):
            ids, sides = rows.column("id").to_numpy(), rows.column("side").to_numpy()
            order = np.argsort(sides, kind="stable")
            rows, ids, sides = rows.take(pa.array(order)), ids[order], sides[order]
            dim = rows.column("dim")[0].as_py()
            vectors = unpacked(rows.column("vec").to_pylist())
            codes = np.frombuffer(b"".join(rows.column("signs").to_pylist()), np.uint8).reshape(len(ids), -1)
            keys = table_keys(codes, table, bits) if table else None
            mult, factors = rows.column("mult").to_numpy(), rows.column("factor").to_numpy()
            split = int((sides == 0).sum()) if split else 0
            if split == len(ids):
                return
            counts, parent, edges = np.zeros(len(ids), np.int64), np.arange(len(ids)), []
            assert vectors.shape[1] == dim

            def find(x: int) -> int:
                while parent[x] != x:
                    parent[x] = parent[parent[x]]
                    x = parent[x]
                return x

            for i, j in linked(vectors, codes, factors, threshold, seed, split):
                first = ~(keys[i] == keys[j]).any(axis=1) if table else np.ones(len(i), bool)
                i, j = i[first], j[first]
                counts += np.bincount(i, mult[j], len(ids)).astype(np.int64) + np.bincount(j, mult[i], len(ids)).astype(np.int64)
                # Links within one tree already are left out before the slower walk.
                roots = parent[parent[i]] != parent[parent[j]]
                for x, y in zip(i[roots].tolist(), j[roots].tolist()):
                    p, q = find(x), find(y)
                    if p != q:
                        parent[max(p, q)] = min(p, q)
                        edges.append((ids[x], ids[y]))
            some = np.flatnonzero(counts)
            a = [*(x for x, _ in edges), *ids[some].tolist()]
            b = [*(y for _, y in edges), *[None] * len(some)]
            n = [*[None] * len(edges), *counts[some].tolist()]
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (a, b, n)], ["a", "b", "n"])

        now, held = None, []

        def close():
            if now and sum(r.num_rows for r in held) > 1:
                yield from group(now[0] >> 32, now[1] != now[2], pa.Table.from_batches(held))

        for rows in batches:
            if not rows.num_rows:
                continue
            marks = np.column_stack([rows.column(c).to_numpy() for c in ("bucket", "low", "high")])
            cuts = np.flatnonzero((marks[1:] != marks[:-1]).any(axis=1)) + 1
            starts, stops = [0, *cuts.tolist()], [*cuts.tolist(), rows.num_rows]
            for k, (a, b) in enumerate(zip(starts, stops)):
                key = tuple(marks[a].tolist())
                if key != now:
                    yield from close()
                    now, held = key, []
                if b - a > 1 or k in (0, len(starts) - 1):
                    held.append(rows.slice(a, b - a))
        yield from close()

    return run


def near_duplicates(
    vectors: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, block: int = BLOCK, seed: int = SEED
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row of ``vectors (vec_id, embedding)``.

    ``n_links`` counts the other vectors with a cosine at the threshold or above among those
    that share a key; ``component_id`` is the smallest ``vec_id`` reachable. Vectors that are
    null, empty, zero or hold null or non-finite components link with nothing, and so do
    vectors of different lengths. Equal vectors, and such as differ by a power of two,
    are compared once, with their number; components may have any magnitude. A null
    ``vec_id`` has no component of its own. Other columns are ignored.
    """
    spark = vectors.sparkSession
    work = space(spark, "vectors")
    values = F.transform("embedding", lambda x: x.cast("double"))
    fine = F.col("embedding").isNotNull() & F.forall(
        values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    ) & F.exists(values, lambda x: x != 0)

    def as_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            vec = [None if v is None else packed(scaled(np.asarray(v, "<f8"))) for v in rows.column("v").to_pylist()]
            yield pa.RecordBatch.from_arrays([rows.column("vec_id"), pa.array(vec, pa.binary())], ["vec_id", "vec"])

    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.when(fine, values).alias("v"))
    rows = work.write(rows.mapInArrow(as_bytes, "vec_id BIGINT, vec BINARY"), "rows")
    nodes = work.write(
        rows.filter("vec IS NOT NULL AND vec_id IS NOT NULL").groupBy("vec").agg(F.min("vec_id").alias("id"), F.count("*").alias("mult")), "nodes"
    )
    n = nodes.count()
    bits, tables = plan_tables(n, threshold, recall)
    width = F.when(F.substring("vec", 1, 1) == F.lit(b"f"), 4).otherwise(8)
    sized = nodes.select("id", ((F.octet_length("vec") - 1) / width).cast("int").alias("dim"), "vec", "mult")
    kinds = "id BIGINT, dim INT, vec BINARY, signs BINARY, factor DOUBLE, mult BIGINT, keys ARRAY<INT>"
    coded = work.write(sized.mapInArrow(_code(bits, tables, seed), kinds), "coded")
    # The table in the upper half; vectors of another length get another bucket.
    bucket = F.shiftleft(F.col("table").cast("bigint"), 32) + F.pmod(F.xxhash64("dim", "key"), F.lit(1 << 32))
    own = coded.select("id", "dim", "vec", "signs", "factor", "mult", F.posexplode("keys").alias("table", "key"))
    # The code and the bits of the tables before this one.
    needed = F.expr(f"substring(signs, 1, cast(ceil(greatest(table * {bits}, dim) / 8) as int))")
    dealt = own.withColumn("bucket", bucket).withColumn("signs", needed)
    slim = coded.select("dim", F.posexplode("keys").alias("table", "key")).select(bucket.alias("bucket"))
    large = slim.groupBy("bucket").agg(F.count("*").alias("n")).filter(F.col("n") > block)
    large = work.write(large.select("bucket", F.ceil(F.col("n") / block).cast("int").alias("parts")), "large")
    if large.count() <= BROADCAST_BUCKETS:
        large = F.broadcast(large)
    part = F.pmod(F.xxhash64("id"), F.coalesce("parts", F.lit(1))).cast("int")
    placed = (
        dealt.drop("table", "key")
        .join(large, "bucket", "left")
        .withColumn("part", part)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)))
        .withColumns({"low": F.least("part", "other"), "high": F.greatest("part", "other")})
        .withColumn("side", (F.col("part") != F.col("low")).cast("int"))
        .drop("part", "other", "parts")
    )
    grouped = placed.repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high")
    found = work.write(grouped.mapInArrow(_compare(threshold, seed, bits), "a BIGINT, b BIGINT, n BIGINT"), "compared")
    counts = found.filter("n IS NOT NULL").groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("n"))
    roots = components(found.filter("n IS NULL").select("a", "b"), work).withColumnRenamed("node", "id")
    facts = (
        nodes.join(counts, "id", "left")
        .join(roots, "id", "left")
        .select("vec", "mult", (F.coalesce("n", F.lit(0)) + F.col("mult") - 1).alias("n_links"), F.coalesce("root", "id").alias("component_id"))
    )
    facts = work.write(facts, "facts")
    known = rows.filter("vec IS NOT NULL AND vec_id IS NOT NULL")
    result = spread_join(known, facts.drop("mult"), "vec", "vec_id", hot_keys(facts, "vec", "mult")).drop("vec")
    alone = rows.filter("vec IS NULL OR vec_id IS NULL").select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    result = result.select("vec_id", "n_links", "component_id").union(alone)
    return result.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
