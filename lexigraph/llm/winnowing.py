"""Document fingerprints by winnowing.

A text's k-grams are runs of ``GRAM`` code points. The hash of a run is its CRC-32: the run's
code points, as four bytes each, are a polynomial over GF(2), and its remainder modulo a fixed
polynomial is the hash. Such remainders roll: ``crc(a + b)`` is ``crc(a)`` shifted by the length
of ``b``, a linear map, plus ``crc(b)``, and the SQL of this operator computes them that way. Here
each run's remainder is taken at once, as the JVM does it in a few cycles. Of every ``WINDOW``
neighbouring hashes the smallest is kept, of equal ones the rightmost, with its position. Hash
and position share one long integer, which makes the smallest integer the wanted choice.

Guarantees: two texts that share ``GRAM + WINDOW - 1`` code points in a row share a
fingerprint, at the matching positions; a match shorter than ``GRAM`` is never reported, but
for equal hashes of different runs (one pair in four thousand million).

Everything is one expression of built-in functions. A text is encoded in parts of ``PART``
windows and worked on in pieces of ``PIECE`` windows, which overlap by a window and a run, so
that the arrays at work stay small however long the text is; every window lies in one piece,
and the choice is the same as for the text in one.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import shuffle_partitions

GRAM = 16
WINDOW = 32
PART = 32768
PIECE = 512
#: Hashes are below 2 ** 32, positions below 2 ** 31: together below 2 ** 63.
PLACES = 2**31
#: A quarter of all hashes are small; of ten thousand windows one has none.
SMALL = PLACES << 30
#: Neighbouring documents in one bucket, about.
BUCKET_ROWS = 4096


def _let(name: str, value: str, body: str) -> str:
    """SQL text of ``body`` with ``name`` bound to ``value``, evaluated once."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def _runs(start: str, stop: str, gram: int, last: str) -> str:
    """Hash and place of the runs ``start`` to ``stop`` of the encoded part ``b``.

    Smaller for smaller hashes, then for later positions; ``last`` is the place of run 0, and
    places fall as positions rise.
    """
    return f"transform(sequence({start}, {stop}), i -> crc32(substring(b, 4 * i + 1, {4 * gram})) * {PLACES}L + ({last} - i))"


def _choices(window: int) -> str:
    """The minima of all windows of the array ``v``, in order, one for each change.

    A fold keeps the smallest of the last ``window`` values. Only small hashes can take its place
    while it is there, so the fold visits those alone; if the smallest has left the window by then,
    the places from there on are looked at one by one, and the window is searched when it lost its
    smallest. While there was no small hash yet, all places are looked at.
    """
    low = PLACES - 1
    first = f"(get(v, 0) & {low}L)"

    def at(x: str) -> str:
        return f"cast({first} - ({x} & {low}L) AS INT)"

    put = "struct({0} AS least, array_append(r.chosen, {0}) AS chosen)"
    searched = _let("m", f"array_min(transform(sequence(e - {window - 1}, e), i -> get(v, i)))", put.format("m"))
    start = f"CASE WHEN s.least < {SMALL}L THEN {at('s.least')} + {window} ELSE {window} END"
    walk = f"""aggregate(sequence({start}, {{end}}), s, (r, e) -> CASE
        WHEN get(v, e) < r.least THEN {put.format("get(v, e)")}
        WHEN e - {at("r.least")} >= {window} THEN {searched}
        ELSE r END)"""
    ending = "size(v) - 1"
    return _let(
        "m",
        f"array_min(slice(v, 1, {window}))",
        f"""aggregate(filter(v, x -> x < {SMALL}L), struct(m AS least, array(m) AS chosen), (s, x) -> CASE
          WHEN (s.least & {low}L) - (x & {low}L) >= {window} OR s.least >= {SMALL}L THEN {walk.format(end=at("x"))}
          WHEN x < s.least THEN struct(x AS least, array_append(s.chosen, x) AS chosen)
          ELSE s END,
          s -> CASE WHEN {start} <= {ending} THEN {walk.format(end=ending)}.chosen ELSE s.chosen END)""",
    )


def packed(text: str, gram: int = GRAM, window: int = WINDOW, part: int = PART, piece: int = PIECE) -> str:
    """SQL text: the chosen hashes and positions of a text column, packed, in text order.

    A text of fewer than ``gram`` code points has one fingerprint, the hash of all of it at
    position 0; one with fewer than ``window`` runs has one, the smallest; the empty text none.
    """
    if gram < 1 or window < 1:
        raise ValueError("gram and window are at least 1")
    last = f"length(b) div 4 - {gram}"
    runs = _runs(f"q * {piece}", f"least(q * {piece} + {piece + window - 2}, {last})", gram, "o")
    pieces = f"flatten(transform(sequence(0, ({last} - {window - 1}) div {piece}), q -> {_let('v', runs, _choices(window))}))"
    taken = f"substring(t, cast(p * {part} + 1 AS INT), {part + window + gram - 2})"
    parts = _let("o", f"{PLACES - 1}L - p * {part}L", _let("b", f"encode({taken}, 'UTF-32')", pieces))
    windows = f"n - {gram + window - 2}"
    body = f"""CASE
      WHEN n = 0 THEN cast(array() AS ARRAY<BIGINT>)
      WHEN n < {gram} THEN array(crc32(encode(t, 'UTF-32')) * {PLACES}L + {PLACES - 1}L)
      WHEN {windows} <= 1 THEN array(array_min({_let("b", "encode(t, 'UTF-32')", _runs("0", last, gram, f"{PLACES - 1}L"))}))
      ELSE array_distinct(flatten(transform(sequence(0, cast(({windows} - 1) div {part} AS INT)), p -> {parts}))) END"""
    return _let("t", f"coalesce({text}, '')", _let("n", "char_length(t)", body))


def hashes(column: str) -> Column:
    """The hashes of a packed fingerprint, in text order, repeats included."""
    return F.expr(f"transform({column}, x -> shiftright(x, 31))")


def fingerprints(column: str) -> Column:
    """``array<struct<hash, position>>`` of a packed fingerprint."""
    return F.expr(
        f"transform({column}, x -> struct(shiftright(x, 31) AS hash, {PLACES - 1}L - (x & {PLACES - 1}L) AS position))"
    )


def likeness(a: str, b: str) -> Column:
    """Shared hashes over all hashes of two fingerprints' distinct hashes, 1.0 for two empty ones."""
    shared = F.size(F.array_intersect(a, b))
    every = F.size(a) + F.size(b) - shared
    return F.when(every == 0, 1.0).otherwise(shared / every)


def winnow(docs: DataFrame, text: str = "text", gram: int = GRAM, window: int = WINDOW, name: str = "fingerprints") -> DataFrame:
    """``docs`` with ``name``, an array of (hash, position); a column of that name is replaced.

    A row's result depends on its text only: equal texts and repeated rows have equal
    fingerprints, null counts as empty and has none. No shuffle and no Python.
    """
    others = [F.col(f"`{c}`") for c in docs.columns if c != name]
    chosen = docs.select(*others, F.expr(packed(f"`{text}`", gram, window)).alias("__packed"))
    return chosen.withColumn(name, fingerprints("__packed")).drop("__packed")


def _bucket_of(key: Column, starts: list) -> Column:
    """The number of ``starts``, sorted, that are not above ``key``: a binary search."""
    if not starts:
        return F.lit(0)
    bounds = F.array(*(F.struct(*(F.lit(v).cast(t) for v, t in zip(s, ("boolean", "bigint", "bigint", "bigint")))) for s in starts))
    steps = F.array(*(F.lit(1 << b) for b in reversed(range(len(starts).bit_length()))))
    return F.aggregate(steps, F.lit(0), lambda at, step: at + F.when(F.get(bounds, at + step - 1) <= key, step).otherwise(0))


def with_next(docs: DataFrame, columns: list[str], bucket_rows: int = BUCKET_ROWS, made=None) -> DataFrame:
    """``docs`` with ``next``, a struct of ``columns`` of the document that follows.

    Order: descending ``doc_id``, null last; rows of one ``doc_id`` by their text's hash. After
    the last comes the first. Rows are dealt to buckets of neighbours, by bounds that Spark's
    range partitioner finds over the keys alone; many rows of one ``doc_id`` fill several
    buckets. Texts are shuffled once: the first row of a bucket goes to the bucket before it as
    well. ``made(rows)`` may add columns to each row once it has arrived; they may be in ``columns``.
    """
    spark = docs.sparkSession
    # Of equal rows any may come first; their number only spreads them over buckets.
    place = F.struct(
        F.col("doc_id").isNull().alias("none"),
        F.coalesce(F.bitwise_not(F.col("doc_id").cast("bigint")), F.lit(0).cast("bigint")).alias("id"),
        F.xxhash64(F.col("text")).alias("hash"),
    )
    key = F.struct("place.none", "place.id", "place.hash", F.col("number"))
    placed = docs.select(F.struct(*docs.columns).alias("row"), place.alias("place"), F.monotonically_increasing_id().alias("number"))
    keys = placed.select("place", key.alias("key"))
    n_rows = docs.count()
    n_buckets = max(1, min(n_rows // 2, max(4 * shuffle_partitions(spark), -(-n_rows // bucket_rows))))
    ranges = keys.repartitionByRange(n_buckets, "key").groupBy(F.spark_partition_id().alias("part"))
    # One row for each bucket.
    found = sorted(tuple(r[0]) for r in ranges.agg(F.min("key")).select("min(key)").collect())
    starts = found[1:]
    last = len(starts)
    before = F.when(F.col("bucket") == 0, last).otherwise(F.col("bucket") - 1)
    firsts = F.array(*(F.struct(F.lit(f[0]), F.lit(f[1]).cast("bigint"), F.lit(f[2]).cast("bigint")) for f in found))
    first = F.get(firsts, F.col("bucket")) == F.col("place") if found else F.lit(False)
    dealt = placed.select("row", "place", "number", _bucket_of(key, starts).alias("bucket")).select(
        "row", "place", "number",
        F.inline(
            F.when(first, F.array(F.struct(F.col("bucket"), F.lit(0).alias("visit")), F.struct(before.alias("bucket"), F.lit(1).alias("visit"))))
            .otherwise(F.array(F.struct(F.col("bucket"), F.lit(0).alias("visit"))))
        ),
    )
    arrived = dealt.repartition(max(shuffle_partitions(spark), math.ceil(len(found) / 4)), "bucket")
    arrived = arrived if made is None else made(arrived)
    order = Window.partitionBy("bucket").orderBy("visit", "place", "number")
    following = F.lead(F.struct(*(F.col(c).alias(c.split(".")[-1]) for c in columns))).over(order)
    return arrived.withColumn("next", following).filter("visit = 0").drop("bucket", "visit", "place", "number")


def edited_likeness(docs: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """How far fingerprints follow an edit.

    ``row`` (a struct of all columns of ``docs``), ``n_chars`` (code points), ``edited`` (the
    text whose last half is replaced by the beginning of the next document), the packed
    fingerprints ``own`` and ``changed``, and ``near_edited`` and ``near_next``, their likeness
    to each other and to the next document's.

    Null texts are empty; an empty text has no fingerprint and is like another empty one only.
    Repeated rows follow each other; of one row alone the next is itself; an empty table gives
    no rows. Extra columns stay within ``row``, whatever their names.
    """
    text = F.coalesce(F.col("row.text"), F.lit(""))

    def made(rows: DataFrame) -> DataFrame:
        rows = rows.withColumn("own", F.expr(packed("row.text", gram, window))).withColumn("body", text)
        return rows.withColumn("hashes", F.array_distinct(hashes("own")))

    rows = with_next(docs, ["body", "hashes"], made=made)
    rows = rows.withColumn("n_chars", F.char_length("body").cast("bigint"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    kept = F.substring(F.col("body"), F.lit(1), (F.col("n_chars") - half).cast("int"))
    rows = rows.withColumn("edited", F.concat(kept, F.substring(F.col("next.body"), F.lit(1), half)))
    rows = rows.withColumn("changed", F.expr(packed("edited", gram, window)))
    rows = rows.withColumn("new_hashes", F.array_distinct(hashes("changed")))
    return rows.select(
        "row", "n_chars", "edited", "own", "changed",
        likeness("hashes", "new_hashes").alias("near_edited"), likeness("hashes", "next.hashes").alias("near_next"),
    )


def written(column: str) -> Column:
    """A packed fingerprint's hashes as one string of hexadecimal numbers."""
    return F.expr(f"array_join(transform({column}, x -> lower(hex(shiftright(x, 31)))), ' ')")
