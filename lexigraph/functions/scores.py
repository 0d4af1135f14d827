"""Score terms as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# BM25's constants, and the mean body length of the reference's corpus.
BM25_K = 1.5
BM25_B = 0.75
REFERENCE_AVGDL = 341.0890174848911

# Sums taken in another order differ in the sixteenth digit; scores are compared at fewer.
SIGNIFICANT = 12


def bm25_part(tf: Column, doc_len: Column, idf: Column, avgdl: float, k: float, b: float) -> Column:
    length = (1 - b) + doc_len * b / avgdl
    return idf * (tf * (k + 1)) / (tf + length * k)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division where an empty denominator means an empty numerator."""
    return F.when(denominator > 0, numerator / denominator).otherwise(F.lit(0.0))


def significant(score: Column, digits: int = SIGNIFICANT) -> Column:
    """The score at so many significant digits, however small it is."""
    size = F.floor(F.log10(F.abs(score)))
    unit = F.pow(F.lit(10.0), size)
    return F.when(score == 0, F.lit(0.0)).otherwise(F.round(score / unit, digits - 1) * unit)


def min_max(score: Column, low: Column, high: Column, on_zero_range: str = "zero") -> Column:
    """(score - low) / (high - low); ends with the same significant digits count as equal."""
    flat = F.lit(0.0) if on_zero_range == "zero" else score
    return F.when(significant(high) == significant(low), flat).otherwise((score - low) / (high - low))
