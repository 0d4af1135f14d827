"""Token and two-word-gram arrays.

A document's tokens live in one array column, so counting, lengths and adjacency need no
shuffle: everything about one document is computed in the row that holds its text.

The functions take and return SQL text. An expression of this size is one call to the JVM
that way; built node by node it took seconds before any job started.
"""

from __future__ import annotations

from collections.abc import Sequence

from .stopwords import ENGLISH

# Java's \w is ASCII only, so the word class is spelled out. \x27 is the apostrophe.
_WORD = r"[\p{L}\p{N}_]"

INDEX_MIN_CHARS = 3
QUERY_MIN_CHARS = 2


def token_pattern(min_chars: int) -> str:
    """A word of ``min_chars`` to 25 characters; ``'`` and ``-`` may join them."""
    return rf"[#@\p{{L}}\p{{N}}_](?:[\x27\-]?{_WORD}){{{min_chars - 1},24}}"


def tokens(text: str, min_chars: int = INDEX_MIN_CHARS) -> str:
    return f"regexp_extract_all(lower({text}), r'{token_pattern(min_chars)}', 0)"


def without(words: str, stop_words: Sequence[str] = ENGLISH) -> str:
    if not stop_words:
        return words
    listed = ", ".join("'" + w.replace("\\", "\\\\").replace("'", "\\'") + "'" for w in stop_words)
    return f"filter({words}, w -> w NOT IN ({listed}))"


def grams(words: str) -> str:
    """Adjacent pairs of a column, repeats kept."""
    n = f"greatest(size({words}) - 1, 0)"
    return (
        f"zip_with(slice({words}, 1, {n}), slice({words}, 2, {n}), (a, b) -> concat_ws(' ', a, b))"
    )


def raw_word_count(text: str) -> str:
    """Pieces left after non-word characters become spaces; empty pieces count."""
    return rf"size(split(regexp_replace({text}, r'[^\p{{L}}\p{{N}}_]', ' '), ' ', -1))"
