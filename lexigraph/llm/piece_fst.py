"""SentencePiece encoding and decoding as weighted finite-state transduction.

Three transducers are compiled from a model file. The normaliser maps a space to the mark
U+2581 and puts one before the text. The lexicon is a trie of all pieces with failure arcs
(Aho and Corasick), which lists the pieces at every position while it reads each character once. Byte fallback has an arc for every other character, emitting the ids of
its UTF-8 bytes. Composing them with a text gives a lattice of positions and arcs, and the
encoding is its shortest path in the tropical semiring.

For unigram models an arc weighs its piece's negative score. A pair-merge model does not
minimise a sum of scores; its encodings are exactly the paths on which every two neighbours
are stable, that is, merging their joined text gives these two pieces back. A second
transducer, whose states are pieces, therefore weighs a stable pair 0 and any other infinity.
Prefixes of an encoding are encodings, so one state for each position has a finite weight, and the
path of weight 0 is found depth first.

Where no piece has two neighbouring characters side by side, no arc crosses: before a mark, behind
a run of letters. Texts are cut there, and the shortest path of each part is remembered.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from .common import slices
from .memo import SpanMemo, held

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, PAIR_MERGE = 1, 2
#: What a character outside the alphabet costs in a unigram model, beyond any piece.
FALLBACK = 1e4
#: Pairs of pieces whose stability is remembered.
MOST_PAIRS = 200_000
#: Texts encoded at a time: their parts and places are many times as large as the texts.
SLICE = 64


def fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and raw values of one message of a model file."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(message):
        number, kind = divmod(varint(), 8)
        if kind == 0:
            yield number, varint()
        else:
            size = varint() if kind == 2 else 8 if kind == 1 else 4
            yield number, message[at : at + size]
            at += size


class Transducer:
    """The compiled model; one for each Python worker and file."""

    def __init__(self, model: bytes):
        self.pieces: list[str] = []
        self.scores: list[float] = []
        self.kinds: list[int] = []
        self.model, self.prefix, squeeze, charsmap = UNIGRAM, True, True, b""
        for number, value in fields(model):
            if number == 1:
                piece, score, kind = "", 0.0, NORMAL
                for n, v in fields(value):
                    if n == 1:
                        piece = v.decode()
                    elif n == 2:
                        score = struct.unpack("<f", v)[0]
                    elif n == 3:
                        kind = v
                self.pieces.append(piece)
                self.scores.append(score)
                self.kinds.append(kind)
            elif number == 2:
                self.model = dict(fields(value)).get(3, UNIGRAM)
            elif number == 3:
                rules = dict(fields(value))
                charsmap, self.prefix = rules.get(2, b""), bool(rules.get(3, 1))
                squeeze = bool(rules.get(4, 1))
        if self.model not in (UNIGRAM, PAIR_MERGE) or charsmap or squeeze:
            raise ValueError("only unigram and pair-merge models without character rules are compiled")
        self.ids = {p: i for i, p in enumerate(self.pieces) if self.kinds[i] in (NORMAL, USER)}
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if self.kinds[i] == BYTE}
        self.unknown = self.kinds.index(UNKNOWN)
        self.alphabet = {ch for p in self.ids for ch in p}
        self.sizes, self.names = [len(p) for p in self.pieces], list(self.pieces)
        self.singles = {p for p in self.ids if len(p) == 1}
        if self.model == PAIR_MERGE:
            # Pieces that merging never gives back whole are on no path. Characters that occur in
            # pieces only merge like pieces; their numbers follow the pieces'.
            self.made = {i: m for p, i in self.ids.items() if (m := self._merges(p)) is not None}
            for ch in sorted(self.alphabet - self.singles):
                self.made[len(self.names)] = []
                self.names.append(ch)
                self.sizes.append(1)
        else:
            self.made = dict.fromkeys(self.ids.values(), [])
        number = {self.names[i]: i for i in self.made}
        #: The longest shorter piece that a piece begins with.
        self.shorter = [-1] * len(self.names)
        for p, i in number.items():
            self.shorter[i] = next((j for k in range(len(p) - 1, 0, -1) if (j := number.get(p[:k])) is not None), -1)
        self.lexicon = ahocorasick.Automaton()
        for p, i in number.items():
            self.lexicon.add_word(p, i)
        self.lexicon.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.parts = self._cuts()
        self.memo = SpanMemo(lambda parts: [self.path(p) for p in parts])
        self.text_of = [self._bytes_of(i) for i in range(len(self.pieces))]

    @classmethod
    def of(cls, path: str) -> Transducer:
        def load() -> Transducer:
            with open(path, "rb") as file:
                return cls(file.read())

        return held(("pieces", path), load)

    def _cuts(self) -> re.Pattern:
        """Cuts between neighbours that no piece has side by side, which no arc can cross.

        Marks begin a part, a run of letters ends one, and so does a character that no piece goes on
        after (a digit, in many models). Each of the three is used only if the pieces allow it.
        """
        pairs = {p[k : k + 2] for p in self.ids for k in range(len(p) - 1)}
        if any(b == MARK != a for a, b in pairs):
            return re.compile(r"(?s).+")
        letters = {c for c in self.alphabet if c.isalpha()}
        if any(a in letters and b not in letters for a, b in pairs):
            letters = set()
        final = self.alphabet - {a for a, _ in pairs} - letters - {MARK}
        # Control characters that are no piece's are parts of their own.
        apart = {c for c in "\n\r\t" if c not in self.alphabet}

        def chars(found: set[str]) -> str:
            return "".join(map(re.escape, sorted(found)))

        ends = [f"[{chars(x)}]{times}" for x, times in ((final, ""), (letters, "+")) if x]
        end = f"(?:{'|'.join(ends)})?" if ends else ""
        alone = f"[{chars(apart)}]|" if apart else ""
        return re.compile(f"{alone}(?s:(?=.)){MARK}*[^{MARK}{chars(apart | letters | final)}]*{end}")

    def _bytes_of(self, i: int) -> bytes:
        if self.kinds[i] == BYTE:
            return bytes([int(self.pieces[i][3:5], 16)])
        if self.kinds[i] == CONTROL:
            return b""
        return " ⁇ ".encode() if self.kinds[i] == UNKNOWN else self.pieces[i].replace(MARK, " ").encode()

    def normalise(self, text: str) -> str:
        if not text:
            return ""
        return (MARK if self.prefix else "") + text.replace(" ", MARK)

    def fallback(self, ch: str) -> list[int]:
        found = [self.bytes.get(b) for b in ch.encode("utf-8", "surrogatepass")]
        return [self.unknown] if None in found else found

    def _merges(self, piece: str) -> list[tuple[float, str, str]] | None:
        """The merges that make a piece, in order: score, first and last part afterwards.

        Best score first and leftmost among equals; None if they do not end with the whole piece.
        """
        parts, done = list(piece), []
        while len(parts) > 1:
            found = [(-self.scores[i], k, i) for k in range(len(parts) - 1) if (i := self.ids.get(parts[k] + parts[k + 1])) is not None]
            if not found:
                return None
            _, k, i = min(found)
            # Scores and texts of the model's own lists, which all merges share.
            parts[k : k + 2] = [self.pieces[i]]
            done.append((self.scores[i], parts[0], parts[-1]))
        return done

    def stable(self, left: int, right: int) -> bool:
        """Weight 0 of the pair transducer: merging the two pieces' text gives them back.

        Both pieces' merges are followed side by side, best score first. The pair is unstable if the
        parts that meet at the border can merge before either of them is taken into a longer one.
        """
        if len(self.pairs) > MOST_PAIRS:
            self.pairs.clear()
        lefts, rights = iter(self.made[left]), iter(self.made[right])
        a, b = self.names[left][-1], self.names[right][0]
        ids, scores = self.ids.get, self.scores
        to_left, to_right = next(lefts, None), next(rights, None)
        known = True
        while True:
            joined = ids(a + b)
            # At equal scores the leftmost merge comes first.
            if joined is not None and (to_left is None or scores[joined] > to_left[0]) and (to_right is None or scores[joined] >= to_right[0]):
                known = False
                break
            if to_left is not None and (to_right is None or to_left[0] >= to_right[0]):
                a, to_left = to_left[2], next(lefts, None)
            elif to_right is not None:
                b, to_right = to_right[1], next(rights, None)
            else:
                break
        self.pairs[left << 32 | right] = known
        return known

    def path(self, part: str) -> list[int]:
        """Shortest path over one normalised part."""
        return self._merge_path(part) if self.model == PAIR_MERGE else self._score_path(part)

    def _merge_path(self, part: str) -> list[int]:
        """The path of stable pairs, searched depth first and longest piece first.

        All its weights are zero, so no path is shorter. A position from which no path goes on is
        never tried again, as the path to a position is unique.
        """
        n, sizes, shorter, known = len(part), self.sizes, self.shorter, self.pairs.get
        # Pieces come by their end; of those with one start the last is the longest.
        longest = {last - sizes[i]: i for last, i in self.lexicon.iter(part)}
        path: list[int] = []
        dead: set[int] = set()
        at, left, i = 0, -1, longest.get(-1, -1)
        while at < n:
            while i >= 0:
                to = at + sizes[i]
                if to not in dead:
                    if left < 0:
                        break
                    ok = known(left << 32 | i)
                    if self.stable(left, i) if ok is None else ok:
                        break
                i = shorter[i]
            if i < 0 and at - 1 not in longest and at + 1 not in dead:
                # A character outside the alphabet.
                to = at + 1
            elif i < 0:
                dead.add(at)
                if not path:
                    raise ValueError("no stable path: the model's pieces are not closed under merging")
                i = path.pop()
                at -= sizes[i] if i >= 0 else 1
                i = shorter[i] if i >= 0 else -1
                left = path[-1] if path else -1
                continue
            path.append(i)
            at, left, i = to, i, longest.get(to - 1, -1)
        return path if min(path, default=0) >= 0 and max(path, default=0) < len(self.pieces) else self._spelled(part, path)

    def _spelled(self, part: str, path: list[int]) -> list[int]:
        """Output of a path with characters that are no pieces."""
        ids: list[int] = []
        at = 0
        for i in path:
            ids.extend([i] if 0 <= i < len(self.pieces) else self.fallback(part[at]))
            at += self.sizes[i] if i >= 0 else 1
        return ids

    def _score_path(self, part: str) -> list[int]:
        n, sizes, scores = len(part), self.sizes, self.scores
        ending: list[list[int]] = [[] for _ in range(n + 1)]
        for last, i in self.lexicon.iter(part):
            ending[last + 1].append(i)
        cost, came = [0.0] * (n + 1), [-1] * (n + 1)
        for at in range(1, n + 1):
            arcs = [(cost[at - sizes[i]] - scores[i], at - sizes[i], i) for i in ending[at]]
            if part[at - 1] not in self.singles:
                arcs.append((cost[at - 1] + FALLBACK, at - 1, -1))
            cost[at], _, came[at] = min(arcs)
        path, at = [], n
        while at:
            path.append(came[at])
            at -= sizes[came[at]] if came[at] >= 0 else 1
        return self._spelled(part, path[::-1])

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        return self.memo.batch([self.parts.findall(self.normalise(t)) for t in texts])

    def decode(self, ids: list[int]) -> str:
        """The inverse transduction; bytes that are not UTF-8 become replacement characters."""
        text = b"".join(map(self.text_of.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text

    def expected(self, text: str) -> str:
        """What a text decodes to: the mark itself reads as a space."""
        return text.replace(MARK, " ")


def encode_documents(docs: DataFrame, model: str) -> DataFrame:
    """``docs`` with ``piece_ids`` (array of int); a column of that name is replaced.

    Null and empty texts have no pieces. ``model`` is a path that every executor can read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fst = Transducer.of(model)
        for rows in slices(batches, SLICE):
            encoded = fst.encode_all([t or "" for t in rows.column(at).to_pylist()])
            yield pa.RecordBatch.from_arrays([*rows.columns, _lists(encoded)], names)

    own = docs.select(*(F.col(f"`{c}`") for c in docs.columns if c != "piece_ids"))
    at, names = own.columns.index("text"), [*own.columns, "piece_ids"]
    return own.mapInArrow(run, StructType([*own.schema.fields, StructField("piece_ids", ArrayType(IntegerType()))]))


def _lists(encoded: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, encoded)])
    flat = np.concatenate([*encoded, np.zeros(0, np.int32)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))


def decode_documents(docs: DataFrame, model: str, column: str = "piece_ids", name: str = "decoded") -> DataFrame:
    """``docs`` with the text of its ids; null ids give null."""

    @F.pandas_udf("string")
    def text(ids):
        fst = Transducer.of(model)
        return ids.map(lambda x: None if x is None else fst.decode(x.tolist()))

    return docs.withColumn(name, text(column))


def round_trip(docs: DataFrame, model: str) -> DataFrame:
    """``doc_id, n_pieces, piece_ids, round_trip``: encoded, decoded again and compared in one pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fst = Transducer.of(model)
        for rows in slices(batches, SLICE):
            texts = [t or "" for t in rows.column("text").to_pylist()]
            encoded = fst.encode_all(texts)
            same = [fst.decode(x.tolist()) == fst.expected(t) for x, t in zip(encoded, texts)]
            sizes = pa.array(list(map(len, encoded)), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), sizes, _lists(encoded), pa.array(same)],
                ["doc_id", "n_pieces", "piece_ids", "round_trip"],
            )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id BIGINT, n_pieces BIGINT, piece_ids ARRAY<INT>, round_trip BOOLEAN")
