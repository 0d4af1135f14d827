"""Builds the indexes of a corpus, each on first use."""

from __future__ import annotations

from collections.abc import Sequence
from functools import cache, cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import tokens
from ..sources.corpus import Corpus
from ..workspace import COMPRESSION, Workspace, small_batches
from .analyze import INDEX, KINDS, QUERY, Profile, forward_rows, merge_pieces, spread
from .fusion import SearchIndexes
from .index import Index, build_index, flatten, squared_norms, write_statistics

# index name -> (component, counted column, columns carried into the postings)
LAYOUT = {
    "title": ("title", "terms", ("doc_len", "raw_words")),
    "title_grams": ("title", "grams", ("doc_len", "n_title_grams")),
    "title_query_grams": ("title", "query_grams", ("doc_len", "n_title_grams")),
    "title_words": ("title", "words", ("doc_len",)),
    "body": ("body", "terms", ("doc_len",)),
    "body_grams": ("body", "grams", ("doc_len",)),
    "body_words": ("body", "words", ("doc_len",)),
    "anchor": ("anchor", "terms", ()),
    "anchor_words": ("anchor", "words", ()),
}

# Body terms and grams of more than 20 documents are indexed, title grams and anchors of any.
# An index of titles over the same threshold is built with ``index("title", 20)``.
MIN_DF = {"body": 20, "body_grams": 20, "body_words": 20}


class IndexSet:
    """The indexes of one corpus under one workspace.

    A component's text is read and tokenized into a stored forward table with the counts of the
    kinds that are asked for; the inverted indexes are made from it. A search has all its kinds in one
    table, another kind that is asked for later takes a table of its own.
    """

    def __init__(
        self,
        corpus: Corpus,
        workspace: Workspace,
        min_df: dict[str, int] | None = None,
        profile: Profile = INDEX,
        query_profile: Profile = QUERY,
    ):
        self.profile = profile
        self.query_profile = query_profile
        self.corpus = corpus
        self.workspace = workspace
        self.min_df = MIN_DF if min_df is None else min_df
        self.root = workspace.fresh("index")
        self._stored: dict[str, list[tuple[set[str], DataFrame]]] = {}
        self.index = cache(self._index)
        self.norms = cache(self._norms)
        self.statistics = cache(
            lambda component: write_statistics(self.doc_stats(component), self.root, component)
        )

    def forward(self, component: str, kinds: Sequence[str] = KINDS) -> DataFrame:
        """A stored forward table with the counts of ``kinds`` at least."""
        stored = self._stored.setdefault(component, [])
        for held, table in stored:
            if held.issuperset(kinds):
                return table
        # Anchors come in pieces, which are merged once.
        kinds = KINDS if component == "anchor" else kinds
        stored.append((set(kinds), self._forward(component, kinds)))
        return stored[-1][1]

    def _forward(self, component: str, kinds: Sequence[str]) -> DataFrame:
        docs = spread(self.corpus.field(component))
        query_profile = None
        if component == "title":
            # A title's two numbers of its own are in every index.
            docs = docs.withColumn("raw_words", F.expr(tokens.raw_word_count("text")))
            query_profile = self.query_profile
        rows = forward_rows(docs, self.profile, query_profile, kinds)
        with small_batches(rows.sparkSession):
            stored = self.workspace.write(rows, f"forward/{component}", COMPRESSION)
        if component == "anchor":
            ids = self.corpus.docs.select(F.col("id").alias("doc_id"))
            stored = self.workspace.write(merge_pieces(stored, ids), "forward/anchor_merged", COMPRESSION)
        return stored

    def flat(self, name: str) -> DataFrame:
        """``(doc_id, term, tf, ...)``: term frequencies before any threshold."""
        component, kind, carried = LAYOUT[name]
        forward = self.forward(component, () if kind == "query_grams" else (kind,))
        if component == "anchor":
            return forward.filter(F.col("kind") == kind).select("doc_id", "term", "tf")
        return flatten(forward, kind, *carried)

    def doc_stats(self, component: str) -> DataFrame:
        stored = self._stored.get(component)
        forward = stored[0][1] if stored else self.forward(component, ("terms",))
        if component == "anchor":
            return forward.filter(F.col("kind") == "doc_len").select(
                "doc_id", F.col("tf").alias("doc_len")
            )
        return forward.select("doc_id", "doc_len")

    def _index(self, name: str, min_df: int | None = None) -> Index:
        flat = self.flat(name)
        threshold = self.min_df.get(name, 0) if min_df is None else min_df
        stored_as = name if min_df is None else f"{name}_over_{min_df}"
        component = LAYOUT[name][0]
        self.statistics(component)
        n_rows, most = self._sizes(name)
        return build_index(
            flat, self.root, stored_as, component, threshold, profile=str(self.profile), n_rows=n_rows, most=most
        )

    def _sizes(self, name: str) -> tuple[int | None, int | None]:
        """The rows of ``flat(name)`` and what no term of it has more of: documents, each of which counts a term once."""
        component, kind, _ = LAYOUT[name]
        if component == "anchor":
            # Merged pieces are rows already.
            return None, None
        forward = self.forward(component, () if kind == "query_grams" else (kind,))
        # Of the arrays only their numbers are read.
        return forward.agg(F.sum(F.greatest(F.size(F.col(f"{kind}.tf")), F.lit(0)))).first()[0] or 0, forward.count()

    def _norms(self, name: str) -> DataFrame:
        return self.workspace.write(squared_norms(self.index(name)), f"norms/{name}")

    @cached_property
    def for_search(self) -> SearchIndexes:
        for component in ("title", "body"):
            self.forward(component, ("terms", "grams"))
        return SearchIndexes(
            *(
                self.index(n)
                for n in ("title", "title_grams", "title_query_grams", "body", "body_grams", "anchor")
            )
        )
