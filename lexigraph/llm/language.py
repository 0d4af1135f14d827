"""Language identification by cross-parsing entropy.

For every language a suffix automaton is built over a bounded sample of labelled running text. A
document is parsed greedily into the longest phrases that occur in that sample, across words;
the fewer phrases it takes, the closer the text is to the language. The phrase count is
normalised as ``phrases * log2(sample size) / characters``, an estimate of the cross entropy in
bits per character, and the language with the smallest estimate wins.

Texts are lower-cased and read as runs of letters with a space between. The whole text counts,
however long; it is parsed in blocks of ``BLOCK`` characters, a phrase ends with its block, and the
blocks of a batch of texts advance side by side, one character a step.

Fitting reads passages of at most ``PASSAGE`` characters, each at a place drawn by the text's
hash, out of at most ``SAMPLE_ROWS`` texts of each language (every second one of twice as many, the
others set the limit below), up to ``LANGUAGE_CHARS`` characters a
language and ``TOTAL_CHARS`` in all; more languages have smaller samples, none is left out.

Texts of no learned language take more phrases than learned ones. The limit is learned as well:
``FOREIGN_FACTOR`` times the rate below which nearly all labelled texts lie that were not sampled.
"""

from __future__ import annotations

import re
from math import log2

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.skew import hot_keys, spread_join
from .common import space
from .memo import held

SAMPLE_ROWS = 500
PASSAGE = 200
LANGUAGE_CHARS = 40_000
TOTAL_CHARS = 2_000_000
UNKNOWN = "und"
BLOCK = 1024
#: Texts of at least this many characters set the limit for texts of no learned language, and only
#: texts of as many are rejected: shorter ones say too little.
FOREIGN_CHARS = 40
FOREIGN_QUANTILE = 0.99
FOREIGN_FACTOR = 1.9
#: Entries of a transition table that is laid out in full, of four bytes each.
DENSE = 40_000_000

#: Names of languages and a number each; more of them are joined by shuffle.
BROADCAST_LANGUAGES = 100_000

LETTERS = re.compile(r"[^\W\d_]+")


def running_text(text: str | None) -> str:
    """Runs of letters in lower case, with a space around each."""
    words = LETTERS.findall((text or "").lower())
    return f" {' '.join(words)} " if any(ch.isalpha() for w in words for ch in w) else ""


def suffix_automaton(text: str) -> list[dict[str, int]]:
    """Transitions of the smallest automaton that accepts every substring of ``text``."""
    step, link, size, last = [{}], [-1], [0], 0
    for ch in text:
        new = len(step)
        step.append({})
        size.append(size[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and ch not in step[p]:
            step[p][ch] = new
            p = link[p]
        if p >= 0:
            q = step[p][ch]
            if size[q] == size[p] + 1:
                link[new] = q
            else:
                clone = len(step)
                step.append(dict(step[q]))
                size.append(size[p] + 1)
                link.append(link[q])
                while p >= 0 and step[p].get(ch) == q:
                    step[p][ch] = clone
                    p = link[p]
                link[q] = link[new] = clone
        last = new
    return step


def phrases(automaton: list[dict[str, int]], text: str) -> int:
    """Number of longest-match phrases; a character the sample lacks is a phrase of its own."""
    root, count, state = automaton[0], 0, 0
    for ch in text:
        after = automaton[state].get(ch)
        if after is None:
            count += state > 0
            after = root.get(ch)
            if after is None:
                count += 1
                after = 0
        state = after
    return count + (state > 0)


class Parser:
    """Automata of a fitted model, built once in each Python worker.

    One table for all languages holds, for a state and a character, four times the state that
    follows plus the phrases that end: the parse starts again at the root when the sample does not
    go on, and a character that it lacks altogether is a phrase of its own.
    """

    def __init__(self, samples: list[tuple[str, str]]):
        self.languages = [lang for lang, _ in samples]
        self.scale = np.array([log2(max(2, len(text))) for _, text in samples])
        self.codes = np.zeros(0x110000, np.int32)
        alphabet = sorted(set().union(*(text for _, text in samples)))
        self.codes[[ord(c) for c in alphabet]] = np.arange(1, len(alphabet) + 1)
        self.width = len(alphabet) + 1
        automata = [suffix_automaton(text) for _, text in samples]
        self.roots = np.cumsum([0, *map(len, automata)])[:-1].astype(np.int64)
        keys, values = [], []
        for root, steps in zip(self.roots.tolist(), automata):
            for state, step in enumerate(steps):
                base = (root + state) * self.width
                keys.extend(base + int(self.codes[ord(c)]) for c in step)
                values.extend(root + to for to in step.values())
        order = np.argsort(np.array(keys, np.int64))
        self.keys, self.values = np.array(keys, np.int64)[order], np.array(values, np.int64)[order]
        n_states = sum(map(len, automata))
        # From the root, for every language and character; -1 where the sample lacks it.
        cells = self.roots[:, None] * self.width + np.arange(self.width)
        self.first = self._edges(cells)
        self.table = None
        if n_states * self.width <= DENSE:
            table = np.empty((n_states, self.width), np.int32)
            for lang, (root, steps) in enumerate(zip(self.roots.tolist(), automata)):
                missing = self.first[lang] < 0
                again = np.where(missing, root, self.first[lang]) * 4 + missing
                table[root : root + len(steps)] = again + 1
                table[root] = again
            table.ravel()[self.keys] = self.values * 4
            self.table = table.ravel()

    def _edges(self, cells: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.keys, cells), len(self.keys) - 1)
        return np.where(self.keys[at] == cells, self.values[at], -1)

    def _follow(self, states: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Table entries of ``states`` (a row for each language) and ``codes``."""
        cells = states * self.width + codes
        if self.table is not None:
            return self.table[cells]
        found, first = self._edges(cells), self.first[:, codes]
        lost, roots = found < 0, self.roots[:, None]
        return np.where(lost, np.where(first < 0, roots, first) * 4 + (first < 0) + (states != roots), found * 4)

    @classmethod
    def of(cls, key: str, samples: list[tuple[str, str]]) -> Parser:
        return held(("language", key), lambda: cls(samples))

    def counts(self, texts: list[str]) -> np.ndarray:
        """Phrases of each text (rows) by each language (columns)."""
        codes = [self.codes[np.frombuffer(t.encode("utf-32-le", "replace"), np.uint32)] for t in texts]
        blocks = [(i, c[at : at + BLOCK]) for i, c in enumerate(codes) for at in range(0, len(c), BLOCK)]
        blocks.sort(key=lambda b: -len(b[1]))
        total = np.zeros((len(texts), len(self.languages)), np.int64)
        if not blocks:
            return total
        sizes = np.array([len(c) for _, c in blocks])
        # One row for each step; blocks that have ended are at its end and left out.
        steps = np.zeros((sizes[0], len(blocks)), np.int32)
        for k, (_, c) in enumerate(blocks):
            steps[: len(c), k] = c
        states = np.repeat(self.roots[:, None], len(blocks), axis=1)
        found = np.zeros(states.shape, np.int64)
        running = np.searchsorted(-sizes, -np.arange(sizes[0]), side="left")
        for row, k in zip(steps, running):
            entry = self._follow(states[:, :k], row[:k])
            found[:, :k] += entry & 3
            states[:, :k] = entry >> 2
        found += states != self.roots[:, None]
        np.add.at(total, [i for i, _ in blocks], found.T)
        return total

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, float, int]]:
        """Language, score, phrases a character and characters of each text."""
        running = [running_text(t) for t in texts]
        out = []
        for text, counts in zip(running, self.counts(running)):
            if not text:
                out.append((UNKNOWN, 0.0, 1.0, 0))
                continue
            rates = counts * self.scale / len(text)
            order = np.argsort(rates, kind="stable")
            best, second = rates[order[0]], rates[order[1]] if len(order) > 1 else np.inf
            out.append((self.languages[order[0]], float(1 - best / second), float(counts[order[0]] / len(text)), len(text)))
        return out


def held_out() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 1


def _labelled(docs: DataFrame, usable: Column | None) -> DataFrame:
    """Distinct labelled texts as ``lang, h, text``."""
    known = F.col("lang").isNotNull() & F.col("text").isNotNull()
    return docs.filter(known if usable is None else known & usable).select("lang", F.xxhash64("text").alias("h"), "text")


def _drawn(docs: DataFrame, usable: Column | None, turn: int) -> DataFrame:
    """``lang, place, passage`` of every second text of each language's first ones by hash.

    ``turn`` 0 begins with the first, 1 with the second.

    Hashes below a bound that depends on the language's count go on, a few times as many as are
    wanted, so that a frequent language's texts never meet in one task.
    """
    rows = _labelled(docs, usable)
    share = rows.groupBy("lang").agg(F.count("*").alias("n"), F.least(F.lit(1.0), F.lit(8.0 * SAMPLE_ROWS) / F.count("*")).alias("share"))
    share = space(docs.sparkSession, "language_shares").write(share, "shares")
    hot = hot_keys(share, "lang", "n")
    share = share.drop("n")
    spread = (F.pmod(F.col("h"), F.lit(1 << 30)) / float(1 << 30)) <= F.col("share")
    few = share.count() <= BROADCAST_LANGUAGES
    drawn = (rows.join(F.broadcast(share), "lang") if few else spread_join(rows, share, "lang", "h", hot)).filter(spread)
    words = F.array_join(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"), F.lit(1)), " ")
    drawn = drawn.select("lang", "h", words.alias("words")).dropDuplicates(["lang", "h"])
    # A passage begins and ends with whole words.
    room = F.length("words") - PASSAGE
    at = F.when(room > 0, F.pmod(F.col("h"), room.cast("bigint"))).otherwise(0).cast("int")
    piece = F.expr("words").substr(at + 1, F.lit(PASSAGE))
    whole = F.when(room > 0, F.regexp_replace(piece, r"^\S*\s|\s\S*$", "")).otherwise(F.col("words"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h")) - 1
    placed = drawn.select("lang", place.alias("place"), whole.alias("passage"))
    return placed.filter((F.col("place") < 2 * SAMPLE_ROWS) & (F.col("place") % 2 == turn))


def fit(docs: DataFrame, usable: Column | None = None) -> list[tuple[str, str]]:
    """``(language, sample)`` in code point order, from the rows of ``docs`` that are ``usable``.

    Rows without text or ``lang`` teach nothing, equal texts of a language once. Passages are joined
    in the order of their texts' hashes as long as they fit. Empty if no row can be used.
    """
    found: dict[str, list[str]] = {}
    # At most SAMPLE_ROWS passages of PASSAGE characters for each language.
    for row in _drawn(docs, usable, 0).orderBy("lang", "place").toLocalIterator():
        found.setdefault(row["lang"], []).append(row["passage"])
    most = min(LANGUAGE_CHARS, TOTAL_CHARS // max(1, len(found)))
    samples = []
    for lang, passages in sorted(found.items()):
        text = " "
        for passage in passages:
            if passage and len(text) + len(passage) < most:
                text += passage + " "
        samples.append((lang, text))
    return samples


def foreign_rate(docs: DataFrame, samples: list[tuple[str, str]], usable: Column | None = None) -> float:
    """Phrases a character above which a text is of no language of ``samples``.

    Learned from passages of labelled texts that are in no sample, at most ``SAMPLE_ROWS`` a
    language; infinite, so that nothing is rejected, where there is none.
    """
    if not samples:
        return float("inf")
    rows = _drawn(docs, usable, 1).filter(F.length("passage") >= FOREIGN_CHARS)
    passages = [r["passage"] for r in rows.toLocalIterator()]
    if not passages:
        return float("inf")
    rates = [rate for _, _, rate, _ in Parser(samples).predict(passages)]
    return FOREIGN_FACTOR * float(np.quantile(rates, FOREIGN_QUANTILE))


def identify(docs: DataFrame, samples: list[tuple[str, str]]) -> DataFrame:
    """``docs`` with ``lang_pred, score, rate, letters``; columns of these names are replaced.

    ``lang_pred`` is a language of ``samples``, or ``und`` (score 0, rate 1) if the text is null
    or has no letter, or nothing was learned. ``score`` is 1 - best / second best estimate; ties
    go to the language first in code point order. ``rate`` is phrases a character, ``letters``
    the characters that were parsed. Repeated rows and empty tables are no special case.
    """
    own = [c for c in docs.columns if c not in ("lang_pred", "score", "rate", "letters")]
    rows = docs.select(F.struct(*own).alias("__row"), F.col("text").alias("__text"))
    if not samples:
        nothing = (F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(1.0).alias("rate"), F.lit(0).cast("bigint").alias("letters"))
        return rows.select("__row.*", *nothing)
    model = docs.sparkSession.sparkContext.broadcast(samples)
    key = str(hash(tuple(samples)))

    @F.pandas_udf("lang_pred string, score double, rate double, letters bigint")
    def predict(texts: pd.Series) -> pd.DataFrame:
        found = Parser.of(key, model.value).predict(texts.tolist())
        return pd.DataFrame(found, columns=["lang_pred", "score", "rate", "letters"])

    return rows.withColumn("__found", predict("__text")).select("__row.*", "__found.*")


def is_foreign(limit: float) -> Column:
    """True for identified texts, long enough to tell, that are of no learned language."""
    return (F.col("letters") >= FOREIGN_CHARS) & (F.col("rate") > limit)
