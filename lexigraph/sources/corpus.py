"""Corpora: documents with a title, a body and links that carry anchor text."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..workspace import Workspace


# File paths without a host are written with one slash or three, depending on who writes them.
SCHEME = r"^([A-Za-z][A-Za-z0-9+.-]*):/+"


@dataclass(frozen=True)
class Corpus:
    """``docs(id, title, text)`` and ``links(src, dst, text)``.

    ``stored_titles(id, title)`` spares readers of titles the text they were derived from.
    """

    docs: DataFrame
    links: DataFrame
    stored_titles: DataFrame | None = None

    def field(self, name: str) -> DataFrame:
        """``(doc_id, text)`` of one component.

        Title and body have one row per document. The anchor component has one row per
        link, under the id of the page the link points to.
        """
        if name == "title":
            return self.titles().withColumnRenamed("title", "text")
        if name == "body":
            return self.docs.select(F.col("id").alias("doc_id"), "text")
        if name == "anchor":
            return self.links.select(F.col("dst").alias("doc_id"), "text")
        raise ValueError(f"no component {name!r}")

    def titles(self) -> DataFrame:
        stored = self.docs if self.stored_titles is None else self.stored_titles
        return stored.select(F.col("id").alias("doc_id"), "title")


def _below(root: str):
    """The path of each row's file below ``root``, split into its components.

    Spark gives paths as URIs, so both sides are decoded. A ``+`` in a path is no blank.
    """
    def decoded(path):
        return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))

    path = F.regexp_replace(F.col("_metadata.file_path"), SCHEME, "$1:/")
    return F.split(F.substr(decoded(path), F.length(decoded(F.lit(root))) + 2), "/")


def resolved(spark: SparkSession, root: str) -> str:
    """``root`` as an encoded URI with one slash after the scheme and none at the end."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    full = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path)
    return re.sub(SCHEME, r"\1:/", full.toUri().toString()).rstrip("/")


def scan(
    spark: SparkSession,
    root: str,
    glob: str | None = None,
    exclude: Sequence[str] = (),
    exclude_prefixes: Sequence[str] = (),
) -> Corpus:
    """Read a corpus stored as many files below ``root``.

    ``glob`` keeps only the files whose name matches. Files and folders right below ``root``
    are left out if their name is in ``exclude`` or begins with one of ``exclude_prefixes``;
    Spark drops such files before it opens them. Names are compared as they are on disk, blanks
    and percent signs included; equal names further down are not meant.
    """
    reader = spark.read.schema(schemas.CORPUS).option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    rows = reader.parquet(root)
    name = F.get(_below(resolved(spark, root)), F.lit(0))
    if exclude:
        rows = rows.filter(~name.isin(list(exclude)))
    for prefix in exclude_prefixes:
        rows = rows.filter(~name.startswith(prefix))
    links = rows.select(F.col("id").alias("src"), F.explode("anchor_text").alias("a")).select(
        "src", F.col("a.id").alias("dst"), F.col("a.text").alias("text")
    )
    return Corpus(rows.select("id", "title", "text"), links)


def title_of(text):
    """The first sentence of the first line."""
    return F.regexp_extract(text, r"^[^.!?\n]*", 0)


def documents_corpus(spark: SparkSession, folder: str, workspace: Workspace) -> Corpus:
    """A corpus over the ``documents`` table.

    Every document links to document ``(7 * id + 3) mod n``, with that document's title as
    the anchor, and to the first document of its own source, with the source's name in front
    of the title.
    """
    documents = spark.read.schema(schemas.DOCUMENTS).parquet(f"{folder}/documents.parquet")
    docs = documents.select(F.col("doc_id").alias("id"), title_of(F.col("text")).alias("title"), "text")
    stored_titles = workspace.write(docs.select("id", "title"), "corpus/titles")

    n_docs = documents.count()
    linking = documents.select("doc_id", "source")
    titles = stored_titles.withColumnRenamed("id", "dst")
    onward = (
        linking.select(
            F.col("doc_id").alias("src"), ((F.col("doc_id") * 7 + 3) % n_docs).alias("dst")
        )
        .join(titles, "dst")
        .select("src", "dst", F.col("title").alias("text"))
    )
    # One row per source. Written first, so that the join below sees its true size and
    # broadcasts it only when it is small.
    homes = workspace.write(
        documents.groupBy("source").agg(F.min("doc_id").alias("dst")).join(titles, "dst"),
        "corpus/homes",
    )
    homeward = linking.join(homes, "source").select(
        F.col("doc_id").alias("src"),
        "dst",
        F.concat_ws(" ", "source", "title").alias("text"),
    )
    links = workspace.write(onward.unionByName(homeward), "corpus/links")
    return Corpus(docs, links, stored_titles)


def with_anchor_text(corpus: Corpus) -> DataFrame:
    """The corpus as one table, its links nested under the page they leave."""
    nested = (
        corpus.links.groupBy(F.col("src").alias("id"))
        .agg(F.array_sort(F.collect_list(F.struct(F.col("dst").alias("id"), "text"))).alias("anchor_text"))
    )
    return corpus.docs.join(nested, "id", "left")
