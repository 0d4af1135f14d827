"""Indexes that documents are added to and removed from.

An index is a list of segments, each a small index of its own that is written once and never
changed. Adding documents writes one more segment, at the cost of the new documents alone.
Removing documents writes their identifiers, and what they contributed to the statistics. A
reader adds up the segments' statistics and leaves out postings of removed documents after it
has met the query's terms. ``merge`` writes all segments as one.

Below the root:

``segment-*/``    ``postings(term, doc_id, tf, ...)``, ordered by term and document; ``term_stats``;
                  ``doc_stats``
``removal-*/``    ``ids(doc_id)`` and ``term_stats`` of the documents that are gone
``manifest/``     one folder for each version, a row for each segment and removal in it

A version is added by writing its folder, which fails if another writer made the same one first.
Older versions stay readable.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..workspace import COMPRESSION
from .index import Index, term_statistics
from .skew import ROWS_PER_TASK

ENTRY = "kind STRING, number BIGINT, path STRING, n_docs BIGINT, n_words BIGINT, n_rows BIGINT"
SEGMENT, REMOVAL = "segment", "removal"


@dataclass(frozen=True)
class Entry:
    """A segment, or the removal of documents from all segments up to ``number``."""

    kind: str
    number: int
    path: str
    n_docs: int
    n_words: int
    n_rows: int


@dataclass(frozen=True)
class SegmentedIndex:
    """One version of a segmented index; every change gives the next version."""

    spark: SparkSession
    root: str
    component: str
    version: int = 0
    entries: tuple[Entry, ...] = ()
    rows_per_task: int = ROWS_PER_TASK

    @classmethod
    def open(cls, spark: SparkSession, root: str, component: str, version: int | None = None) -> SegmentedIndex:
        """The latest version below ``root``, or a given one; empty if there is none yet."""
        index = cls(spark, root, component)
        try:
            said = spark.read.schema(f"{ENTRY}, component STRING, version BIGINT").parquet(f"{root}/manifest")
        except AnalysisException:
            return index
        latest = said.agg(F.max("version")).first()[0] if version is None else version
        rows = said.filter(F.col("version") == latest).orderBy("number", "kind").collect()
        if any(r["component"] != component for r in rows):
            raise ValueError(f"{root} does not index {component!r}")
        return replace(index, version=latest or 0, entries=tuple(Entry(*(r[c] for c in Entry.__dataclass_fields__)) for r in rows))

    @property
    def segments(self) -> list[Entry]:
        return [e for e in self.entries if e.kind == SEGMENT]

    @property
    def removals(self) -> list[Entry]:
        return [e for e in self.entries if e.kind == REMOVAL]

    def _next(self, entries: tuple[Entry, ...]) -> SegmentedIndex:
        version = self.version + 1
        rows = [(*(getattr(e, c) for c in Entry.__dataclass_fields__), self.component) for e in entries]
        table = self.spark.createDataFrame(rows, f"{ENTRY}, component STRING").coalesce(1)
        table.write.mode("error").parquet(f"{self.root}/manifest/version={version}")
        return replace(self, version=version, entries=entries)

    def _path(self, kind: str) -> str:
        return f"{self.root}/{kind}-{uuid.uuid4().hex[:12]}"

    def _read(self, entry: Entry, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{entry.path}/{table}")

    def append(self, flat: DataFrame, doc_stats: DataFrame) -> SegmentedIndex:
        """Add the documents of ``doc_stats(doc_id, doc_len)`` with their ``flat(doc_id, term, tf, ...)`` terms.

        Only the new documents are read, shuffled and written. Their identifiers must not be in
        the index, unless they were removed before.
        """
        path = self._path(SEGMENT)
        doc_stats.select("doc_id", "doc_len").write.parquet(f"{path}/doc_stats")
        size = self.spark.read.parquet(f"{path}/doc_stats").agg(F.count("*"), F.coalesce(F.sum("doc_len"), F.lit(0))).first()
        others = [c for c in flat.columns if c not in ("term", "doc_id", "tf")]
        # A document has at most as many postings as words, so no part grows with the batch.
        n_parts = max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), -(-size[1] // self.rows_per_task))
        # One shuffle: a segment keeps no document frequencies, so nothing is joined first.
        ordered = flat.select("term", "doc_id", "tf", *others).repartitionByRange(n_parts, "term", "doc_id")
        ordered.sortWithinPartitions("term", "doc_id").write.option("compression", COMPRESSION).parquet(f"{path}/postings")
        postings = self.spark.read.parquet(f"{path}/postings")
        term_statistics(postings).write.parquet(f"{path}/term_stats")
        number = 1 + max((e.number for e in self.entries), default=0)
        return self._next((*self.entries, Entry(SEGMENT, number, path, size[0], size[1], postings.count())))

    def remove(self, ids: DataFrame, flat: DataFrame | None = None) -> SegmentedIndex:
        """Take the documents of ``ids(doc_id)`` out of all segments so far; unknown ids are ignored.

        Their terms are taken off the statistics. They come from ``flat(doc_id, term, tf)``, the stored
        forward rows of exactly these documents as they were indexed, or else from a pass over the postings.
        """
        if not self.segments:
            return self
        path = self._path(REMOVAL)
        wanted = ids.select("doc_id").distinct()
        # Only documents that are there, so that every one is taken off once.
        self.read().doc_stats.join(wanted, "doc_id", "left_semi").write.parquet(f"{path}/ids")
        gone = self.spark.read.parquet(f"{path}/ids")
        size = gone.agg(F.count("*"), F.coalesce(F.sum("doc_len"), F.lit(0))).first()
        if flat is None:
            now = self.read()
            flat = now.live(now.postings)
        gone_ids = F.broadcast(gone.select("doc_id")) if size[0] <= 1_000_000 else gone.select("doc_id")
        term_statistics(flat.join(gone_ids, "doc_id", "left_semi")).write.parquet(f"{path}/term_stats")
        number = max(e.number for e in self.segments)
        return self._next((*self.entries, Entry(REMOVAL, number, path, size[0], size[1], 0)))

    def read(self, min_df: int = 0) -> Index:
        """The index as it is now. Document frequencies, N and lengths are sums over the entries.

        Nothing is written. Terms of ``min_df`` documents or fewer, which adding and removing can
        change, are left out when their postings are met.
        """
        if not self.segments:
            raise ValueError(f"{self.root} has no segment yet")
        postings, doc_stats, counts = None, None, None
        for e in self.segments:
            own = self._read(e, "postings").withColumn("segment", F.lit(e.number).cast("bigint"))
            docs = self._read(e, "doc_stats").withColumn("segment", F.lit(e.number).cast("bigint"))
            postings = own if postings is None else postings.unionByName(own)
            doc_stats = docs if doc_stats is None else doc_stats.unionByName(docs)
        for e in self.entries:
            sign = 1 if e.kind == SEGMENT else -1
            stats = self._read(e, "term_stats").select("term", (sign * F.col("df")).alias("df"), (sign * F.col("cf")).alias("cf"))
            counts = stats if counts is None else counts.unionByName(stats)
        removed = None
        for e in self.removals:
            gone = self._read(e, "ids").select("doc_id", F.lit(e.number).cast("bigint").alias("upto"))
            removed = gone if removed is None else removed.unionByName(gone)
        term_stats = counts.groupBy("term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf")).filter("df > 0")
        signed = [(1 if e.kind == SEGMENT else -1, e) for e in self.entries]
        n_docs, n_words = (sum(s * getattr(e, c) for s, e in signed) for c in ("n_docs", "n_words"))
        size = [(n_docs, n_words / n_docs if n_docs else None)]
        index = Index(
            postings,
            term_stats,
            doc_stats,
            self.spark.createDataFrame(size, "n_docs BIGINT, avgdl DOUBLE"),
            min_df=min_df,
            component=self.component,
            segmented=True,
            removed=removed,
            n_removed=sum(e.n_docs for e in self.removals),
        )
        return replace(index, doc_stats=index.live(doc_stats))

    def merge(self) -> SegmentedIndex:
        """All segments written as one, range by range of terms, without what was removed."""
        if not self.segments:
            return self
        now = self.read()
        n_rows = sum(e.n_rows for e in self.segments)
        path = self._path(SEGMENT)
        now.doc_stats.write.parquet(f"{path}/doc_stats")
        n_parts = max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), -(-n_rows // self.rows_per_task))
        live = now.live(now.postings).repartitionByRange(n_parts, "term", "doc_id")
        live.sortWithinPartitions("term", "doc_id").write.parquet(f"{path}/postings")
        postings = self.spark.read.parquet(f"{path}/postings")
        now.term_stats.write.parquet(f"{path}/term_stats")
        size = self.spark.read.parquet(f"{path}/doc_stats").agg(F.count("*"), F.coalesce(F.sum("doc_len"), F.lit(0))).first()
        number = 1 + max(e.number for e in self.entries)
        return self._next((Entry(SEGMENT, number, path, size[0], size[1], postings.count()),))
