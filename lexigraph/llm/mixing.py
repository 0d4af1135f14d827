"""Mixing sources to target weights.

Sources share the corpus by weight. A source's target stops at a multiple of its size, and
what it cannot take is shared again by weight among the others. A source's repetition rate
is target / size; each of its documents is emitted floor(rate) times, and once more if a
hash of its identifier and text falls below the fraction.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.skew import hot_keys, spread_join
from .common import WORD, running_sums, space, text_or_empty

SEED = "mix"
MOST_REPEATS = 3.0
CYCLE = 3
#: More sources than this are joined by shuffle.
BROADCAST_SOURCES = 100_000


def source_targets(sizes: DataFrame, most: float = MOST_REPEATS, cycle: int = CYCLE) -> DataFrame:
    """``source, source_size, weight, target, rate`` from ``source, source_size``.

    Weights run 1, 2, ..., ``cycle`` over the sources in code point order, null last. With
    sources in order of size / weight, the capped ones come first: for each source the share
    of one unit of weight is worked out as if all before it were capped, and the first
    source that stays below its cap sets the share of all that follow.
    """
    work = space(sizes.sparkSession, "mixing")
    order = [F.col("source").isNull(), F.col("source")]
    ranked = running_sums(sizes.withColumn("one", F.lit(1).cast("bigint")), order, {"place": "one"}, work)
    weighed = ranked.withColumn("weight", (F.col("place") % cycle + 1).cast("bigint"))
    fullness = F.col("source_size") / F.col("weight")
    summed = running_sums(weighed, [fullness, *order], {"size_before": "source_size", "weight_before": "weight"}, work)
    summed = work.write(summed, "sources")
    total = summed.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight"))
    level = (F.col("size") - most * F.col("size_before")) / (F.col("weight_total") - F.col("weight_before"))
    with_total = summed.crossJoin(F.broadcast(total.select("size", F.col("weight").alias("weight_total"))))
    # One row: the share of one unit of weight beyond the capped sources.
    free = with_total.filter(most * F.col("source_size") >= level * F.col("weight"))
    share = free.agg(F.min_by(level, F.struct(fullness, *order)).alias("share"))
    target = F.least(most * F.col("source_size"), F.coalesce("share", F.lit(float("inf"))) * F.col("weight"))
    return (
        summed.crossJoin(F.broadcast(share))
        .withColumn("target", F.when(F.col("source_size") > 0, target).otherwise(F.lit(0.0)))
        .select(
            "source", "source_size", "weight", "target",
            F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)).alias("rate"),
        )
    )


def draw(seed: str = SEED) -> Column:
    """A number in [0, 1) from the seed, ``doc_id`` and ``__digest``; the same on every run and engine."""
    digest = F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("|"), F.col("__digest")))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def mixing_plan(docs: DataFrame, seed: str = SEED, most: float = MOST_REPEATS, cycle: int = CYCLE) -> DataFrame:
    """``docs`` with ``size, source_size, target, rate, copies, taken``; those names are replaced.

    ``size`` counts words (null text: 0), ``taken`` is ``size * copies``. Null sources are one
    source, the last. Rows without identifier, or with the same one, draw by their texts; only
    rows equal in both share a draw. An empty table gives no rows; a source without words has target and rate 0.
    """
    added = ["size", "source_size", "target", "rate", "copies", "taken"]
    own = [c for c in docs.columns if c not in added]
    key = F.when(F.col("source").isNull(), "").otherwise(F.concat(F.lit("="), F.col("source")))
    rows = docs.select(
        F.struct(*own).alias("__row"),
        "doc_id",
        key.alias("__key"),
        F.col("source").alias("__source"),
        F.regexp_count(text_or_empty(), F.lit(WORD)).cast("bigint").alias("size"),
        F.md5(text_or_empty()).alias("__digest"),
    )
    sizes = rows.groupBy(F.col("__source").alias("source")).agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    work = space(docs.sparkSession, "mixing_sizes")
    sizes = work.write(sizes, "sizes")
    targets = source_targets(sizes.select("source", "source_size"), most, cycle)
    plan = targets.select(key.alias("__key"), "source_size", "target", "rate")
    counted = sizes.select(key.alias("__key"), "rows")
    if sizes.count() <= BROADCAST_SOURCES:
        joined = rows.join(F.broadcast(plan), "__key")
    else:
        joined = spread_join(rows, plan, "__key", "doc_id", hot_keys(counted, "__key", "rows"))
    whole = F.floor("rate")
    return (
        joined.withColumn("copies", (whole + F.when(draw(seed) < F.col("rate") - whole, 1).otherwise(0)).cast("bigint"))
        .withColumn("taken", F.col("size") * F.col("copies"))
        .select("__row.*", *added)
    )


def mix(docs: DataFrame, seed: str = SEED, most: float = MOST_REPEATS, cycle: int = CYCLE) -> DataFrame:
    """The mixed documents, repeats included, with the columns of ``docs``."""
    plan = mixing_plan(docs.select(F.struct(*docs.columns).alias("__doc"), "doc_id", "source", "text"), seed, most, cycle)
    repeats = F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))
    return plan.select("__doc", repeats.alias("__copy")).select("__doc.*")
