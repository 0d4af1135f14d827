"""Inverted indexes as Parquet tables.

An index under a root folder is four tables, each a ``field=<name>`` partition of its kind:

``postings``      ``(term, doc_id, tf, df, doc_len, ...)``, ordered by term and document
``term_stats``    ``(term, df, cf)`` of every term, also of those below the df threshold
``doc_stats``     ``(doc_id, doc_len)``, with a row for empty documents
``corpus_stats``  one row ``(n_docs, avgdl)``
``manifest``      one row: what was indexed and over which threshold; ``read_index`` obeys it

Postings are stored in two folders, ``kept=1`` with the terms over the df threshold and ``kept=0``
with one row for each of the others (or for each part of a divided one), from which their statistics
come; readers open the first only.

Several indexes of one component (its words, its two-word grams) share the last two.

A posting repeats its term's ``df`` (constant within a run of the sort order, so it takes
next to no space) and its document's length. Scoring therefore needs one join, query terms
to postings, and none to statistics that grow with the corpus.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import cached_property
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..workspace import COMPRESSION, Workspace, settings
from .skew import ROWS_PER_TASK, hot_keys, spread_join

if TYPE_CHECKING:
    from .block_max import Blocks

MANIFEST = "component STRING, statistics STRING, min_df BIGINT, profile STRING"
# From this many files on, a query table opens only those that hold its terms.
DIRECTORY_FILES = 32
# ... unless it has so many terms for each file, which leave hardly a file out.
TERMS_PER_FILE = 4
# Removed identifiers are broadcast up to this many, of eight bytes each.
BROADCAST_REMOVED = 2_000_000
# One in so many documents tells which terms have so many postings that they are divided.
SAMPLED = 64
# Both folders are written at a time, not sorted by folder first. A term's rows stay in a list
# up to so many; the sorter that takes more has memory pages of its own for each term.
WRITING = {"spark.sql.maxConcurrentOutputFileWriters": "2", "spark.sql.windowExec.buffer.in.memory.threshold": "65536"}
# Terms of an index with their document frequency, two words of 49 characters of four bytes at most.
BROADCAST_TERMS = 200_000


@dataclass(frozen=True)
class Index:
    postings: DataFrame
    term_stats: DataFrame
    doc_stats: DataFrame
    corpus_stats: DataFrame
    min_df: int = 0
    # What was indexed ("body") and a description of how its text became words.
    component: str | None = None
    profile: str = ""
    # Document lengths of another build, joined to the postings of query terms only.
    other_lengths: DataFrame | None = None
    # An index of several segments: postings carry no df, as it changes with every segment, and
    # ``removed(doc_id, upto)`` takes a document out of the segments up to a number.
    segmented: bool = False
    removed: DataFrame | None = None
    n_removed: int = 0
    # Postings bucketed by term, for query tables too large to broadcast.
    buckets: Buckets | None = None
    # Postings in blocks with maxima (``block_max``), for top-k searches.
    blocks: Blocks | None = None

    @cached_property
    def _corpus(self):
        return self.corpus_stats.first()

    @property
    def n_docs(self) -> int:
        return self._corpus["n_docs"]

    @property
    def avgdl(self) -> float:
        return self._corpus["avgdl"]

    def idf(self):
        """log2(N / df) over the postings' columns."""
        return F.log2(F.lit(float(self.n_docs)) / F.col("df"))

    def kept_terms(self) -> DataFrame:
        return self.term_stats.filter(F.col("df") > self.min_df)

    def live(self, postings: DataFrame) -> DataFrame:
        """``postings`` without those of documents that were removed later."""
        if not self.segmented:
            return postings
        if self.removed is not None:
            gone = F.broadcast(self.removed) if self.n_removed <= BROADCAST_REMOVED else self.removed
            gone = gone.withColumnRenamed("doc_id", "gone_id")
            postings = postings.join(gone, (F.col("doc_id") == F.col("gone_id")) & (F.col("segment") <= F.col("upto")), "left_anti")
        return postings.drop("segment")

    def all_postings(self) -> DataFrame:
        """Every posting over the threshold, with its term's document frequency."""
        if not self.segmented:
            return self.postings
        kept = self.kept_terms().select("term", "df")
        return with_df(self.live(self.postings), kept, kept.count())

    def with_stats_of(self, other: Index, same_component: bool = False) -> Index:
        """The same postings with the document lengths and size of another build.

        ``same_component`` refuses statistics of another field, by the indexes' manifests.
        """
        if same_component and self.component != other.component:
            raise ValueError(f"statistics of {other.component!r} do not fit an index of {self.component!r}")
        return replace(
            self,
            postings=self.postings.drop("doc_len"),
            doc_stats=other.doc_stats,
            corpus_stats=other.corpus_stats,
            other_lengths=other.doc_stats.select("doc_id", "doc_len"),
            buckets=None,
            blocks=None,
        )

    @cached_property
    def n_files(self) -> int:
        return sum("/kept=0/" not in f for f in self.postings.inputFiles())

    @cached_property
    def directory(self) -> DataFrame | None:
        """One row ``files``: an array of (first term, last term, path), ascending; None for few files.

        Files are ranges of terms, so the array is sorted by both ends. It grows with the files,
        not with the postings; terms are read once to make it.
        """
        if self.segmented or self.n_files < DIRECTORY_FILES:
            return None
        # The ends of strings are found by sorting, so terms are counted first, which hashes rows. The
        # filter drops none; without it Spark leaves the counting out.
        path = F.col("_metadata.file_path").alias("path")
        held = self.postings.groupBy(path, "term").agg(F.count("*").alias("n")).filter("n > 0")
        ends = held.groupBy("path").agg(F.min("term").alias("first"), F.max("term").alias("last"))
        rows = ends.agg(F.sort_array(F.collect_list(F.struct("first", "last", "path"))).alias("files")).collect()
        return self.postings.sparkSession.createDataFrame(rows, "files ARRAY<STRUCT<first: STRING, last: STRING, path: STRING>>")

    def postings_of(self, terms: DataFrame) -> DataFrame:
        """The postings in the files that may hold ``terms(term)``; other files are not opened."""
        if self.segmented or self.n_files < DIRECTORY_FILES:
            return self.postings
        many = TERMS_PER_FILE * self.n_files
        if terms.distinct().limit(many).count() == many:
            return self.postings
        below = _count_sorted("files", lambda f: f["last"] < F.col("term"))
        upto = _count_sorted("files", lambda f: f["first"] <= F.col("term"))
        met = terms.distinct().crossJoin(F.broadcast(self.directory)).select(F.slice("files", below + 1, F.greatest(upto - below, F.lit(0))).alias("met"))
        paths = [r[0] for r in met.select(F.explode("met.path")).distinct().collect()]
        spark = self.postings.sparkSession
        if not paths:
            return self.postings.limit(0)
        return spark.read.schema(self.postings.schema).parquet(*sorted(paths))


def _count_sorted(array: str, holds) -> Column:
    """The number of leading elements for which ``holds``, by bisection of a sorted array."""
    steps = F.array(*(F.lit(1 << b) for b in reversed(range(24))))
    return F.aggregate(
        steps,
        F.lit(0),
        lambda at, step: at + F.when((at + step <= F.size(array)) & holds(F.get(F.col(array), at + step - 1)), step).otherwise(0),
    )


@dataclass(frozen=True)
class Buckets:
    """Postings stored in ``n`` buckets by term; hot terms are divided by ``part`` as well."""

    table: str
    n: int
    hot: DataFrame | None


def bucket_postings(index: Index, workspace: Workspace, name: str, rows_per_task: int = ROWS_PER_TASK) -> Index:
    """The index with its postings bucketed, so that large query tables meet them unshuffled.

    A term with very many postings is divided by document over several buckets, and a query term
    is repeated for each of its parts.
    """
    postings = index.all_postings()
    spark = postings.sparkSession
    kept = index.kept_terms()
    n_rows, hot = kept.agg(F.sum("df")).first()[0] or 0, hot_keys(kept, "term", "df", rows_per_task)
    key = ["term"] if hot is None else ["term", "part"]
    if hot is not None:
        hot = workspace.write(hot, f"{name}/hot")
        part = F.coalesce(F.pmod(F.xxhash64("doc_id"), F.col("parts")), F.lit(0)).cast("int")
        postings = postings.join(F.broadcast(hot), "term", "left").withColumn("part", part).drop("parts")
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_rows // rows_per_task))
    path = workspace.fresh(f"{name}/postings_by_term")
    table = "postings_" + path.rpartition("-")[2]
    # Repartitioned first, so that each bucket is one file.
    postings.repartition(n, *key).write.bucketBy(n, *key).sortBy(*key).option("path", path).saveAsTable(table)
    return replace(index, buckets=Buckets(table, n, hot))


def flatten(forward: DataFrame, counts: str, *carried: str) -> DataFrame:
    """``(doc_id, *carried, term, tf)`` from a stored forward table.

    The outer form keeps Spark from repeating the array expression in a pushed-down size
    filter.
    """
    return forward.select("doc_id", *carried, F.inline_outer(counts)).filter(
        F.col("term").isNotNull()
    )


def with_df(flat: DataFrame, kept: DataFrame, n_kept: int, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``flat`` inner join ``kept(term, df)``, which is broadcast unless it is large."""
    if n_kept <= BROADCAST_TERMS:
        return flat.join(F.broadcast(kept), "term")
    return spread_join(flat, kept, "term", "doc_id", hot_keys(kept, "term", "df", rows_per_task))


def term_statistics(flat: DataFrame) -> DataFrame:
    return flat.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("cf"))


def corpus_statistics(doc_stats: DataFrame) -> DataFrame:
    return doc_stats.agg(F.count("*").alias("n_docs"), F.avg("doc_len").alias("avgdl"))


def table_path(root: str, table: str, name: str) -> str:
    return f"{root}/{table}/field={name}"


def write_statistics(doc_stats: DataFrame, root: str, component: str) -> None:
    """Store document lengths, and the size and mean length of the component."""
    path = table_path(root, "doc_stats", component)
    doc_stats.select("doc_id", "doc_len").write.mode("overwrite").parquet(path)
    stored = doc_stats.sparkSession.read.parquet(path)
    corpus_statistics(stored).write.mode("overwrite").parquet(
        table_path(root, "corpus_stats", component)
    )


def hot_terms(flat: DataFrame, rows_per_task: int) -> DataFrame | None:
    """``(term, parts, all)`` of terms with more than ``rows_per_task`` rows of ``flat``, or None.

    A sample of documents tells which may be, as this only divides work; ``all``, the number of
    their rows, is counted over every row.
    """
    sample = 1 if rows_per_task < SAMPLED * SAMPLED else SAMPLED
    seen = flat.filter(F.pmod(F.xxhash64("doc_id"), F.lit(sample)) == 0).groupBy("term").agg(F.count("*").alias("n"))
    likely = hot_keys(seen, "term", "n", rows_per_task // sample * 3 // 4)
    if likely is None:
        return None
    counted = flat.join(F.broadcast(likely.select("term")), "term", "left_semi").groupBy("term").agg(F.count("*").alias("all"))
    counted = counted.filter(F.col("all") > rows_per_task)
    # Bounded like the list of likely terms; collected, so that it is counted once.
    rows = [(r["term"], -(-r["all"] // rows_per_task), r["all"]) for r in counted.collect()]
    if not rows:
        return None
    return flat.sparkSession.createDataFrame(rows, "term STRING, parts INT, all BIGINT")


def counted_postings(flat: DataFrame, n_parts: int, rows_per_task: int = ROWS_PER_TASK, most: int | None = None) -> DataFrame:
    """``flat`` with ``df``, in ranges of terms, sorted by term and document.

    The one shuffle of the postings brings a term's rows together, which counts them there; ``cf`` is
    the sum of their ``tf`` in the first of them and null in the others. Terms with very many rows are
    divided over several tasks: they were counted before, and each of their parts has a ``cf``. There are
    none if no term has more than ``most`` rows and these are few.
    """
    hot = None if most is not None and most <= rows_per_task else hot_terms(flat, rows_per_task)
    key = ["term"]
    if hot is not None:
        part = F.coalesce(F.pmod(F.xxhash64("doc_id"), F.col("parts")), F.lit(0)).cast("int")
        flat, key = flat.join(F.broadcast(hot), "term", "left").withColumn("part", part).drop("parts"), ["term", "part"]
    rows = flat.repartitionByRange(n_parts, *key)
    # Both windows have the order of the files, so that rows are sorted once and pass one window.
    ordered = Window.partitionBy(*key).orderBy("doc_id")
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    df = F.count(F.lit(1)).over(whole)
    rows = rows.withColumns(
        {
            "cf": F.when(F.row_number().over(ordered) == 1, F.sum("tf").over(whole)),
            "df": df if hot is None else F.coalesce("all", df),
        }
    )
    return rows.drop("all", "part").sortWithinPartitions("term", "doc_id")


def build_index(
    flat: DataFrame,
    root: str,
    name: str,
    component: str,
    min_df: int = 20,
    rows_per_task: int = ROWS_PER_TASK,
    profile: str = "",
    n_rows: int | None = None,
    most: int | None = None,
) -> Index:
    """Write the index of ``flat(doc_id, term, tf, ...)`` and read it back.

    Terms in ``min_df`` documents or fewer are left out of the postings that are read. Other columns of
    ``flat`` (document lengths, for example) go into the postings unchanged. The
    statistics of ``component`` must have been written before. ``n_rows``, the rows of ``flat``, and
    ``most``, which no term has more rows than, spare a pass over it where the caller knows them.
    """
    spark = flat.sparkSession
    path = table_path(root, "postings", name)
    n_rows = flat.count() if n_rows is None else n_rows
    n_parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_rows // rows_per_task))
    postings = counted_postings(flat, n_parts, rows_per_task, most).withColumn("kept", (F.col("df") > min_df).cast("int"))
    others = [c for c in flat.columns if c not in ("term", "doc_id", "tf")]
    # Of a term below the threshold nothing is read but its statistics.
    kept = F.col("kept") == 1
    postings = postings.filter(kept | F.col("cf").isNotNull()).withColumns({c: F.when(kept, F.col(c)) for c in ("doc_id", "tf", *others)})
    written = postings.select("term", "doc_id", "tf", "df", *others, "cf", "kept").write.option("compression", COMPRESSION).mode("overwrite")
    # Without any row no folder would tell the columns.
    with settings(spark, WRITING):
        (written.partitionBy("kept") if n_rows else written).parquet(path)
    # A term's first row tells both; only divided terms have several.
    first = spark.read.parquet(path).filter("cf IS NOT NULL").select("term", "df", "cf")
    once, divided = first.filter(F.col("df") <= rows_per_task), first.filter(F.col("df") > rows_per_task)
    stats = once.unionByName(divided.groupBy("term").agg(F.first("df").alias("df"), F.sum("cf").alias("cf")))
    stats.write.option("compression", COMPRESSION).mode("overwrite").parquet(table_path(root, "term_stats", name))
    _write_manifest(spark, root, name, component, component, min_df, profile)
    return read_index(spark, root, name)


def _write_manifest(spark: SparkSession, root: str, name: str, component: str | None, statistics: str, min_df: int, profile: str) -> None:
    row = spark.createDataFrame([(component, statistics, min_df, profile)], MANIFEST)
    row.coalesce(1).write.mode("overwrite").parquet(table_path(root, "manifest", name))


def write_index(index: Index, root: str, name: str, rows_per_task: int = ROWS_PER_TASK) -> None:
    """Store an index that is already in table form, with the threshold it was built over."""
    postings = index.all_postings()
    spark = postings.sparkSession
    n_rows = index.kept_terms().agg(F.sum("df")).first()[0] or 0
    n_parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_rows // rows_per_task))
    postings.repartitionByRange(n_parts, "term", "doc_id").sortWithinPartitions("term", "doc_id").write.mode(
        "overwrite"
    ).parquet(table_path(root, "postings", name))
    for table in ("term_stats", "doc_stats", "corpus_stats"):
        getattr(index, table).write.mode("overwrite").parquet(table_path(root, table, name))
    _write_manifest(spark, root, name, index.component, name, index.min_df, index.profile)


def read_index(spark: SparkSession, root: str, name: str) -> Index:
    """An index as it was stored: its manifest names its statistics, threshold and component."""
    said = spark.read.schema(MANIFEST).parquet(table_path(root, "manifest", name)).first()
    postings = spark.read.parquet(table_path(root, "postings", name))
    return Index(
        postings.filter("kept = 1").drop("kept", "cf") if "kept" in postings.columns else postings,
        spark.read.parquet(table_path(root, "term_stats", name)),
        spark.read.parquet(table_path(root, "doc_stats", said["statistics"])),
        spark.read.parquet(table_path(root, "corpus_stats", said["statistics"])),
        min_df=said["min_df"],
        component=said["component"],
        profile=said["profile"],
    )


def lookup(index: Index, term: str) -> DataFrame:
    """One posting list; no rows for an unknown term. The filter reaches the Parquet scan."""
    return index.live(index.postings.filter(F.col("term") == term)).select("doc_id", "tf").orderBy("doc_id")


def posting_lists(postings: DataFrame, ids_per_part: int = 100_000) -> DataFrame:
    """``(term, part, postings)``; a term's parts, in order, are its list in document order.

    A part holds the documents of one range of ids, ``part * ids_per_part`` and up, so that no
    group grows with the corpus.
    """
    return (
        postings.withColumn("part", F.floor(F.col("doc_id") / ids_per_part).cast("bigint"))
        .groupBy("term", "part")
        .agg(F.sort_array(F.collect_list(F.struct("doc_id", "tf"))).alias("postings"))
    )


def squared_norms(index: Index) -> DataFrame:
    """Sum over a document's postings of ((tf / doc_len) * log2(N / df)) squared."""
    weight = F.col("tf") / F.col("doc_len") * index.idf()
    return index.all_postings().groupBy("doc_id").agg(F.sum(F.pow(weight, F.lit(2.0))).alias("norm2"))


def tf_idf(index: Index) -> DataFrame:
    return index.all_postings().select("term", "doc_id", (F.col("tf") * index.idf()).alias("weight"))
