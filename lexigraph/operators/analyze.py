"""From text to counted terms, one row per document and no shuffle."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import stopwords, tokens
from ..functions.stem import STEMMED_END, stem, stem_array


@dataclass(frozen=True)
class Profile:
    """How text becomes words.

    ``stop_words`` are dropped before stemming and do not count towards a document's
    length. ``index_stop_words`` are dropped after stemming: they count towards the length
    but are not indexed. ``extended`` picks the stemmer's extended rules.
    """

    min_chars: int = tokens.INDEX_MIN_CHARS
    stem: bool = True
    extended: bool = False
    stop_words: Sequence[str] = stopwords.ENGLISH
    index_stop_words: Sequence[str] = stopwords.ALL

    def plain_words(self, text: str) -> str:
        """SQL text of the unstemmed words of a text column."""
        return tokens.without(tokens.tokens(text, self.min_chars), self.stop_words)

    def stemmed(self, words: str) -> str:
        return stem_array(words, self.min_chars < 3, self.extended) if self.stem else words

    def words(self, text: str) -> str:
        return self.stemmed(self.plain_words(text))

    def indexed(self, words: str) -> str:
        return tokens.without(words, self.index_stop_words)


INDEX = Profile()
QUERY = Profile(min_chars=tokens.QUERY_MIN_CHARS)
UNSTEMMED = Profile(stem=False)

# Text is divided anew if the largest split has so many times its share of a core's rows, ...
UNEVEN = 1.5
# ... into tasks of so many documents at most.
DOCS_PER_TASK = 10_000


def _run_starts(ordered: str) -> Column:
    """Positions at which a new value begins in a sorted array column."""
    last = F.size(ordered) - 1
    starts = F.filter(
        F.sequence(F.lit(0), last),
        lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1)),
    )
    return F.when(last >= 0, starts).otherwise(F.array().cast("array<int>"))


def _run_lengths(ordered: str, starts: str) -> Column:
    end = F.size(ordered)
    return F.transform(
        starts,
        lambda start, i: F.struct(
            F.get(ordered, start).alias("term"),
            (F.coalesce(F.get(starts, i + 1), end) - start).alias("tf"),
        ),
    )


def counts(df: DataFrame, *arrays: str) -> DataFrame:
    """Replace array columns by ``ARRAY<STRUCT<term, tf>>`` of their distinct members.

    Each array is sorted and its runs are measured, so a long document costs n log n and
    leaves its row only as counts. The three projections stay apart: a lambda must read the sorted array, not
    sort it again for every element.
    """
    df = df.withColumns({name: F.sort_array(name) for name in arrays})
    df = df.withColumns({f"{name}_starts": _run_starts(name) for name in arrays})
    df = df.withColumns({name: _run_lengths(name, f"{name}_starts") for name in arrays})
    return df.drop(*(f"{name}_starts" for name in arrays))


def spread(docs: DataFrame) -> DataFrame:
    """Divide text whose splits leave cores idle.

    Analysis is bound by CPU. Splits are ranges of bytes, but one of them reads a Parquet row group
    whole: a large file of few row groups has many splits, of which few have rows. So the rows of
    each split are counted, which reads footers only. Input that is evenly divided is analyzed
    where it is read, unshuffled, unless its splits are so large that a task would grow with them.
    """
    cores = docs.sparkSession.sparkContext.defaultParallelism
    splits = docs.groupBy(F.spark_partition_id().alias("split")).agg(F.count("*").alias("n"))
    total, largest = splits.agg(F.sum("n"), F.max("n")).first()
    if largest is None or largest <= min(2 * DOCS_PER_TASK, UNEVEN * total / cores):
        return docs
    return docs.repartition(max(cores, -(-total // DOCS_PER_TASK)))


# What of a text can be counted.
KINDS = ("terms", "grams", "words")
COUNTS = "ARRAY<STRUCT<term: STRING, tf: INT>>"
# Words analyzed at a time, which bounds what a worker holds; a longer document is analyzed alone.
WORDS_PER_SLICE = 200_000


class _Words:
    """Numbered words of a slice of documents: ``row`` and ``word`` of each occurrence, in order."""

    def __init__(self, lists: pa.ListArray, profile: Profile):
        coded = lists.flatten().dictionary_encode()
        self.n_rows = len(lists)
        self.row = np.repeat(np.arange(self.n_rows), pc.fill_null(pc.list_value_length(lists), 0).to_numpy())
        self.plain, self.word = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        made = self.plain
        if profile.stem:
            # Words of other ends are their own stems.
            met = pc.match_substring_regex(made, STEMMED_END)
            stems = [stem(w, profile.extended) for w in made.filter(met).to_pylist()]
            made = pc.replace_with_mask(made, met, pa.array(stems, pa.string()))
        made = made.dictionary_encode()
        self.stems = made.dictionary
        self.stem = made.indices.to_numpy(zero_copy_only=False).astype(np.int64)[self.word]

    def _lists(self, key: np.ndarray, size: int, terms) -> pa.ListArray:
        """Counts of ``row * size + number``, the numbers spelled by ``terms``."""
        key, tf = np.unique(key, return_counts=True)
        ends = np.cumsum(np.bincount(key // size, minlength=self.n_rows))
        offsets = pa.array(np.concatenate([[0], ends]), pa.int32())
        values = [terms(key % size), pa.array(tf, pa.int32())]
        return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(values, ["term", "tf"]))

    def counts(self, numbers: np.ndarray, names: pa.Array, stop_words: Sequence[str]) -> pa.ListArray:
        kept = ~pc.is_in(names, value_set=pa.array(stop_words, pa.string())).to_numpy(zero_copy_only=False)[numbers]
        return self._lists((self.row * max(len(names), 1) + numbers)[kept], max(len(names), 1), lambda n: names.take(pa.array(n)))

    def kind(self, name: str, stop_words: Sequence[str]) -> pa.ListArray:
        if name == "grams":
            return self.grams()
        numbers, names = (self.stem, self.stems) if name == "terms" else (self.word, self.plain)
        return self.counts(numbers, names, stop_words)

    def grams(self) -> pa.ListArray:
        """Adjacent pairs of stems."""
        n, inside = max(len(self.stems), 1), self.row[1:] == self.row[:-1]
        key = ((self.row[:-1] * n + self.stem[:-1]) * n + self.stem[1:])[inside]

        def spelled(pairs):
            first, second = (self.stems.take(pa.array(x)) for x in (pairs // n, pairs % n))
            return pc.binary_join_element_wise(first, second, " ")

        return self._lists(key, n * n, spelled)


def _slices(rows: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Parts of so many words at most, or of one document."""
    size = pc.fill_null(pc.list_value_length(rows.column(column)), 0).to_numpy()
    before, start = 0, 0
    for at, n in enumerate(size.tolist()):
        if at > start and before + n > WORDS_PER_SLICE:
            yield rows.slice(start, at - start)
            before, start = 0, at
        before += n
    if rows.num_rows:
        yield rows.slice(start)


def forward_rows(
    docs: DataFrame, profile: Profile = INDEX, query_profile: Profile | None = None, kinds: Sequence[str] = KINDS
) -> DataFrame:
    """``(doc_id, doc_len, terms, grams, words)`` for ``docs(doc_id, text)``, or those of ``kinds`` only.

    ``terms`` and ``grams`` count the stemmed words and adjacent pairs that ``profile``
    indexes, ``words`` the unstemmed words. Every other column of ``docs`` but the text is kept.
    With ``query_profile`` the distinct pairs under that profile are added as ``query_grams``, each
    counted once, and their number as ``n_title_grams``.

    Text is cut into words by Spark's expressions. A slice of documents is then counted as arrays of
    numbers, and each of its distinct words is stemmed once.
    """
    others = [f for f in docs.schema.fields if f.name != "text"]
    texts = {"_plain": profile} | ({"_asked": query_profile} if query_profile else {})
    rows = docs.select(
        *(f.name for f in others),
        F.size(F.expr(profile.plain_words("text"))).alias("doc_len"),
        *(F.expr(p.plain_words("text")).alias(name) for name, p in texts.items()),
    )
    kept = [*(f.name for f in others), "doc_len"]
    schema = T.StructType([*others, T.StructField("doc_len", T.IntegerType())])
    wanted = [k for k in KINDS if k in kinds]
    schema = T.StructType([*schema.fields, *(T.StructField(k, T.DataType.fromDDL(COUNTS)) for k in wanted)])
    if query_profile:
        schema = T.StructType([*schema.fields, *T.StructType.fromDDL(f"query_grams {COUNTS}, n_title_grams INT").fields])

    def analyzed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch, "_plain"):
                own = _Words(part.column("_plain"), profile)
                made = [own.kind(k, profile.index_stop_words) for k in wanted]
                if query_profile:
                    lists = part.column("_asked")
                    grams = _Words(lists, query_profile).grams()
                    once = pa.array(np.ones(len(grams.values), np.int32))
                    once = pa.StructArray.from_arrays([grams.values.field("term"), once], ["term", "tf"])
                    made.append(pa.ListArray.from_arrays(grams.offsets, once))
                    made.append(pc.if_else(pc.is_valid(lists), pc.list_value_length(grams), None))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), *made], schema.names)

    return rows.mapInArrow(analyzed, schema)


def merge_pieces(forward: DataFrame, all_ids: DataFrame) -> DataFrame:
    """Add up the rows of documents that came in several pieces, one column at a time.

    Counts were taken within each piece, so a page with very many pieces arrives here
    pre-aggregated and is combined map-side again. Returns flat rows
    ``(doc_id, kind, term, tf)`` with kind ``terms`` or ``words``, and lengths under
    kind ``doc_len``; ids of ``all_ids`` without pieces get a length of zero.
    """
    tagged = None
    for kind in ("terms", "words"):
        part = forward.select("doc_id", F.inline_outer(kind)).filter(F.col("term").isNotNull())
        part = part.select("doc_id", F.lit(kind).alias("kind"), "term", "tf")
        tagged = part if tagged is None else tagged.unionByName(part)
    lengths = forward.select(
        "doc_id",
        F.lit("doc_len").alias("kind"),
        F.lit("").alias("term"),
        F.col("doc_len").alias("tf"),
    )
    empty = all_ids.select(
        "doc_id", F.lit("doc_len").alias("kind"), F.lit("").alias("term"), F.lit(0).alias("tf")
    )
    return (
        tagged.unionByName(lengths)
        .unionByName(empty)
        .groupBy("doc_id", "kind", "term")
        .agg(F.sum("tf").cast("int").alias("tf"))
    )


def positions(docs: DataFrame, words: str) -> DataFrame:
    """``(doc_id, pos, term)`` of an array in SQL text over ``docs``."""
    return docs.select("doc_id", F.posexplode(F.expr(words)).alias("pos", "term"))
