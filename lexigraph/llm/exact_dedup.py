"""Exact deduplication with keyed streaming state.

Documents enter a digest log: identifier, SHA-256 of the normalised text and a locator of
the content. A Structured Streaming query reads the log and keeps one state row for each
digest in RocksDB, without expiry: the smallest identifier, its locator and the number of
rows. Further batches of documents meet the same state. A digest that more than one row
has is confirmed on the full bytes of all its texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.skew import ROWS_PER_TASK, hot_keys, spread_join
from .common import SPACE, scratch, shuffle_partitions, text_or_empty

#: Many small stores need not set aside disk space before they use it. A store is closed when its
#: task is done: an executor holds as many as it has cores, not one for each of its partitions.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
}
#: Digests of 32 bytes; more of them are joined by shuffle.
BROADCAST_DIGESTS = 500_000
LOG = "doc_id BIGINT, digest BINARY, locator STRING"


def normalised(text: str | Column = "text") -> Column:
    """The text, null as empty, with every run of white space replaced by one space."""
    return F.regexp_replace(text_or_empty(text), SPACE, " ")


def digest_of(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


class ExactDedup:
    """Deduplicates all documents admitted so far.

    ``admit`` may be called again with further documents, also by a later application that
    names the same ``root``. Identifiers are ``doc_id``; null identifiers count as larger
    than all others. ``digest`` may be replaced in tests to provoke equal digests.
    """

    def __init__(self, spark: SparkSession, root: str | None = None, digest=digest_of):
        self.spark = spark
        self.root = root or scratch(spark, "exact_dedup")
        self.digest = digest

    def admit(self, docs: DataFrame, locator: Column | None = None) -> None:
        """Append documents to the digest log and fold the log's new files into the state."""
        where = F.lit(None) if locator is None else locator
        rows = docs.select(
            F.col("doc_id").cast("bigint").alias("doc_id"),
            self.digest(normalised()).alias("digest"),
            where.cast("string").alias("locator"),
        )
        rows.write.mode("append").parquet(f"{self.root}/log")
        log = self.spark.readStream.schema(LOG).parquet(f"{self.root}/log")
        first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "locator"))
        state = log.groupBy("digest").agg(first.alias("first"), F.count("*").alias("n"))
        before = {key: self.spark.conf.get(key, None) for key in STATE}
        for key, value in STATE.items():
            self.spark.conf.set(key, value)
        try:
            query = (
                state.writeStream.format("noop")
                .outputMode("update")
                .option("checkpointLocation", f"{self.root}/state")
                .trigger(availableNow=True)
                .start()
            )
            query.awaitTermination()
        finally:
            for key, value in before.items():
                self.spark.conf.unset(key) if value is None else self.spark.conf.set(key, value)

    def state(self) -> DataFrame:
        """``digest, keep_id, locator, group_size`` as the state store holds them."""
        stored = self.spark.read.format("statestore").load(f"{self.root}/state")
        first, n = (F.col("value").getField(f) for f in stored.schema["value"].dataType.names)
        return stored.select(
            "key.digest", first["doc_id"].alias("keep_id"), first["locator"].alias("locator"), n.alias("group_size")
        )

    def decide(self, docs: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
        """``docs`` (all that were admitted) with ``keep_id, group_size, kept, text_sha256, locator``.

        Of equal texts the row with the smallest ``doc_id`` is kept. Repeated rows of that
        identifier are all marked kept. Columns of ``docs`` with these names are replaced.
        """
        added = ["keep_id", "group_size", "kept", "text_sha256", "locator"]
        own = [c for c in docs.columns if c not in added]
        rows = docs.select(
            F.struct(*own).alias("__row"), F.col("doc_id").cast("bigint").alias("doc_id"), normalised().alias("__text")
        ).withColumn("__digest", self.digest(F.col("__text")))
        state = self.state().withColumnRenamed("digest", "__digest")
        hits = state.filter("group_size > 1").select("__digest")
        if hits.count() <= BROADCAST_DIGESTS:
            hits = F.broadcast(hits)
        # Smallest and largest text of a digest are equal if, and only if, all its texts are;
        # every task sends one row for a digest, however many copies there are.
        checked = (
            rows.select("__digest", "__text")
            .join(hits, "__digest", "left_semi")
            .groupBy("__digest")
            .agg((F.min("__text") != F.max("__text")).alias("differ"))
        )
        mixed = checked.filter("differ").select("__digest")
        decided = spread_join(
            rows.drop("__text"), state, "__digest", "doc_id", hot_keys(state, "__digest", "group_size", rows_per_task)
        )
        if not mixed.isEmpty():
            decided = self._split(rows, decided, mixed)
        return decided.select(
            "__row.*", "keep_id", "group_size",
            F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
            F.lower(F.hex("__digest")).alias("text_sha256"),
            "locator",
        )

    def _split(self, rows: DataFrame, decided: DataFrame, mixed: DataFrame) -> DataFrame:
        """Group the rows of digests that stand for different texts by the texts themselves."""
        odd = rows.join(mixed, "__digest", "left_semi")
        groups = odd.groupBy("__text").agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id"))["doc_id"].alias("keep_id"),
            F.count("*").alias("group_size"),
        )
        apart = odd.join(groups, "__text").withColumn("locator", F.lit(None).cast("string"))
        return decided.join(mixed, "__digest", "left_anti").unionByName(apart.drop("__text"))


def exact_dedup(docs: DataFrame, locator: Column | None = None, digest=digest_of) -> DataFrame:
    """Decide one table of documents; see :class:`ExactDedup`. Empty tables give no rows."""
    dedup = ExactDedup(docs.sparkSession, digest=digest)
    dedup.admit(docs, locator)
    return dedup.decide(docs)
