"""Token identifiers in compressed binary blocks, coded with range asymmetric numeral systems.

One table of symbol frequencies, counted over all documents and scaled to a power of two, is
shared by all blocks. A block holds the tokens of consecutive documents. Token i belongs to
lane i mod K; every lane is a coder state of its own and all lanes write into one stream of
32-bit words, so that a step codes K tokens with array arithmetic. Every ``STEPS`` steps the
states and the stream position are noted: from each such checkpoint decoding can start, on
its own, and each stretch between checkpoints has a checksum.

File format, little endian. A store is a folder of Parquet files in ascending document order
with one row per block: ``start`` (tokens before it), ``n_tokens``, ``block``; the
frequencies are in ``frequencies`` beside it. A block is::

    magic "RANS" | u32 lanes | u32 steps a stretch | u64 tokens | u32 documents | u32 stretches | u32 words
    documents x (u8 known, i64 doc_id, u64 tokens)
    stretches x (u64 word position, u32 crc32 of the stretch's ids as u32, lanes x u64 state)
    words x u32
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shuffle_partitions, small_batches, space, text_or_empty
from .memo import SpanMemo, held

END_ID = 1
#: Table slots for each symbol, as a power of two; tables of few symbols have 2 ** 16.
SLOT_BITS = 2
LOWEST = np.uint64(1 << 31)
LANES = 1024
STEPS = 128
#: Tokens after which a block is closed; a longer document has a block of its own.
BLOCK_TOKENS = 1 << 20
MAGIC = b"RANS"
HEAD = struct.Struct("<4sIIQIII")
#: Texts that are only cut at white space: Python's split also cuts at four separators that are
#: no white space in Unicode, some letters' lower case is not one letter, and special tokens
#: stand between bars.
ODD = re.compile("[\x1c-\x1f\u0130\u0250-\U0010ffff]")
SPACES = re.compile(r"[^\S\x1c-\x1f]+")
#: A full stop or comma that ends a word after another mark: the tokenizer keeps them together.
RUN = re.compile(r"[.,][ \n](?<![a-z0-9ß-öø-ÿ]..)")
#: Lower-case letters, then marks that neither join letters nor are special.
PLAIN = re.compile(r"([a-zß-öø-ÿ]+)([!-&(-/:;=?@\[-`{}~]{0,4})")
#: How a byte-level vocabulary writes the bytes of such letters.
BYTE_LETTERS = {b: 256 + 33 + b - 127 for b in range(127, 161)} | {173: 256 + 67}
PROBES = ("the", "x", "tokenization", "straße", "ñandú", "àâæçèéêëîïôœùûüÿ".replace("œ", ""))
DOCUMENT = np.dtype([("known", "u1"), ("doc_id", "<i8"), ("tokens", "<u8")])


class Frequencies:
    """Scaled frequencies of the symbols that occur, with what coding needs."""

    def __init__(self, ids: np.ndarray, counts: np.ndarray):
        order = np.argsort(ids)
        self.ids = ids[order].astype(np.int64)
        self.bits = bits = max(16, len(ids).bit_length() + SLOT_BITS)
        self.places = np.zeros(int(self.ids[-1]) + 1 if len(ids) else 0, np.int32)
        self.places[self.ids] = np.arange(len(ids))
        self.scaled = self._scale(counts[order].astype(np.float64), 1 << bits)
        self.freq = self.scaled.astype(np.uint64)
        self.first = (np.cumsum(self.scaled) - self.scaled).astype(np.uint64)
        self.slots = np.repeat(np.arange(len(self.ids), dtype=np.int32), self.scaled)

    @staticmethod
    def _scale(counts: np.ndarray, total: int) -> np.ndarray:
        """Integers of sum ``total``, none below 1, close to the counts' proportions."""
        if not len(counts):
            return np.zeros(0, np.int64)
        if len(counts) > total:
            raise ValueError("more symbols than the table has slots")
        scaled = np.maximum(1, np.floor(counts * (total / counts.sum()))).astype(np.int64)
        while (over := int(scaled.sum()) - total) > 0:
            # Take from the largest entries, in proportion, never below 1.
            spare = scaled - 1
            cut = np.minimum(spare, np.ceil(spare * (over / spare.sum())).astype(np.int64))
            order = np.argsort(-cut, kind="stable")
            fits = np.cumsum(cut[order]) <= over
            scaled[order[fits]] -= cut[order[fits]]
            if not fits.any():
                scaled[order[0]] -= over
        scaled[np.argmax(scaled)] += total - int(scaled.sum())
        return scaled

    def symbols(self, ids: np.ndarray) -> np.ndarray:
        return self.places[ids]


def encode(table: Frequencies, ids: np.ndarray, lanes: int, steps: int) -> tuple[np.ndarray, list]:
    """The word stream and, for each stretch, ``(word position, crc32, states)``."""
    bits = np.uint64(table.bits)
    low, half = np.uint64(0xFFFFFFFF), np.uint64(32)
    symbols = table.symbols(ids)
    n_steps = -(-len(ids) // lanes)
    states = np.full(lanes, LOWEST, np.uint64)
    out: list[np.ndarray] = []
    marks: list[tuple[int, np.ndarray]] = []
    # Backwards, as the decoder reads the last word written first.
    for step in range(n_steps - 1, -1, -1):
        now = symbols[step * lanes : (step + 1) * lanes]
        x, f = states[: len(now)], table.freq[now]
        full = x >= ((LOWEST >> bits) << half) * f
        if full.any():
            out.append((x[full] & low).astype("<u4"))
            x = np.where(full, x >> half, x)
        whole = x // f
        states[: len(now)] = (whole << bits) + (x - whole * f) + table.first[now]
        if step % steps == 0:
            marks.append((len(out), states.copy()))
    sizes = np.cumsum([0] + [len(w) for w in out])
    words = np.concatenate(out[::-1]) if out else np.zeros(0, "<u4")
    stretches = []
    for k, (pieces, x) in enumerate(marks[::-1]):
        part = ids[k * steps * lanes : (k + 1) * steps * lanes].astype("<u4")
        stretches.append((int(sizes[-1] - sizes[pieces]), zlib.crc32(part.tobytes()), x))
    return words, stretches


def decode_stretch(table: Frequencies, words: np.ndarray, at: int, states: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` ids from one checkpoint on."""
    lanes, bits = len(states), np.uint64(table.bits)
    mask, half = np.uint64((1 << table.bits) - 1), np.uint64(32)
    states, out = states.copy(), np.empty(n, np.int64)
    for a in range(0, n, lanes):
        size = min(lanes, n - a)
        x = states[:size]
        slot = x & mask
        symbol = table.slots[slot.astype(np.int64)]
        out[a : a + size] = symbol
        x = table.freq[symbol] * (x >> bits) + slot - table.first[symbol]
        need = x < LOWEST
        k = int(need.sum())
        if k:
            x[need] = (x[need] << half) | words[at : at + k]
            at += k
        states[:size] = x
    return table.ids[out]


def pack(table: Frequencies, doc_ids: list, sizes: list[int], ids: np.ndarray, lanes: int = LANES, steps: int = STEPS) -> bytes:
    """One block. Small blocks use fewer lanes, as every lane costs a state."""
    while lanes > 1 and lanes * 64 > len(ids):
        lanes //= 2
    words, stretches = encode(table, ids, lanes, steps)
    docs = np.zeros(len(sizes), DOCUMENT)
    docs["known"] = [d is not None for d in doc_ids]
    docs["doc_id"] = [d or 0 for d in doc_ids]
    docs["tokens"] = sizes
    head = HEAD.pack(MAGIC, lanes, steps, len(ids), len(docs), len(stretches), len(words))
    marks = b"".join(struct.pack("<QI", at, crc) + x.astype("<u8").tobytes() for at, crc, x in stretches)
    return head + docs.tobytes() + marks + words.tobytes()


def unpack(table: Frequencies, block: bytes) -> tuple[list, np.ndarray, np.ndarray]:
    """``doc_ids, sizes, ids`` of a block; raises ValueError if a checksum does not hold."""
    magic, lanes, steps, tokens, n_docs, n_stretches, n_words = HEAD.unpack_from(block)
    if magic != MAGIC:
        raise ValueError("not a token block")
    docs = np.frombuffer(block, DOCUMENT, n_docs, HEAD.size)
    at, mark = HEAD.size + docs.nbytes, 12 + 8 * lanes
    words = np.frombuffer(block, "<u4", n_words, at + n_stretches * mark).astype(np.uint64)
    ids, width = np.empty(tokens, np.int64), steps * lanes
    for k in range(n_stretches):
        place, crc = struct.unpack_from("<QI", block, at + k * mark)
        states = np.frombuffer(block, "<u8", lanes, at + k * mark + 12).astype(np.uint64)
        part = decode_stretch(table, words, place, states, min(width, tokens - k * width))
        if zlib.crc32(part.astype("<u4").tobytes()) != crc:
            raise ValueError(f"checksum of stretch {k} does not hold")
        ids[k * width : k * width + len(part)] = part
    doc_ids = [int(d) if known else None for known, d in zip(docs["known"], docs["doc_id"])]
    return doc_ids, docs["tokens"].astype(np.int64), ids


class Tokens:
    """A tokenizers file with its words' ids remembered; one for each Python worker.

    The vocabularies used here drop white space before cutting texts, so a text's ids are
    those of its pieces between white space, one after the other.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.memo = SpanMemo(self._many, most=1_300_000, values=16_000_000)
        self.model = self.tokenizer.model
        self.tails: dict[str, list[int]] = {}
        # Only vocabularies of this kind take words of letters as they are.
        self.direct = all(self._word(w) == self._encode(w) for w in PROBES)

    def _encode(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _word(self, word: str) -> list[int]:
        """Ids of lower-case Latin letters, which need no normalising and no cutting."""
        text = word if word.isascii() else word.encode().decode("latin-1").translate(BYTE_LETTERS)
        return [t.id for t in self.model.tokenize(text)]

    def _many(self, words: list[str]) -> list[list[int]]:
        """Plain words, letters and then perhaps marks, are cut where the tokenizer cuts them."""
        if not self.direct:
            return [self._encode(w) for w in words]
        found = []
        for word in words:
            m = PLAIN.fullmatch(word)
            if not m:
                found.append(self._encode(word))
                continue
            ids = self._word(m[1])
            if m[2]:
                if m[2] not in self.tails:
                    self.tails[m[2]] = self._encode(m[2])
                ids = ids + self.tails[m[2]]
            found.append(ids)
        return found

    @classmethod
    def of(cls, path: str) -> Tokens:
        return held(("tokenizer", path), lambda: cls(path))

    def batch(self, texts: list[str]) -> list[np.ndarray]:
        return self.memo.batch([self._words(t) for t in texts])

    @staticmethod
    def _words(text: str) -> list[str]:
        """Pieces whose ids, one after the other, are the text's; fewer forms are better."""
        if "<|" in text or ODD.search(text):
            return SPACES.split(text)
        text = text.lower()
        if not RUN.search(text):
            text = text.replace(". ", " . ").replace(", ", " , ").replace(".\n", " .\n")
        return text.split()


def tokenize(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """``doc_id, n_tokens, ids``: ids are 32-bit little endian, compressed, the end id last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tokens, press = Tokens.of(tokenizer), zstandard.ZstdCompressor(level=1)
        for rows in batches:
            ids = [np.append(x, end_id) for x in tokens.batch(rows.column("text").to_pylist())]
            ids = [x.astype("<u2" if x.max() < 1 << 16 else "<u4") for x in ids]
            packed = [x.dtype.str[-1].encode() + press.compress(x.tobytes()) for x in ids]
            sizes = pa.array([len(x) for x in ids], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), sizes, pa.array(packed, pa.binary())], ["doc_id", "n_tokens", "ids"]
            )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, "doc_id BIGINT, n_tokens BIGINT, ids BINARY")


def unpress(packed: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(packed[1:]), f"<u{packed[:1].decode()}")


def count_symbols(tokens: DataFrame) -> DataFrame:
    """``id, n`` over all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << 16, np.int64)
        for rows in batches:
            ids = np.concatenate([unpress(b) for b in rows.column("ids").to_pylist()] or [np.zeros(0, np.int64)])
            new = np.bincount(ids, minlength=len(counts))
            new[: len(counts)] += counts
            counts = new
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], ["id", "n"])

    return tokens.select("ids").mapInArrow(run, "id BIGINT, n BIGINT").groupBy("id").agg(F.sum("n").alias("n"))


def write_store(docs: DataFrame, tokenizer: str, path: str, end_id: int = END_ID, block_tokens: int = BLOCK_TOKENS) -> None:
    """Tokenize ``docs`` and write their ids to ``path`` in ascending ``doc_id`` order.

    Null identifiers come first, rows of one identifier in the order of their ids. Null and
    empty texts are the end id alone. An empty table writes a store without blocks.
    """
    spark = docs.sparkSession
    work = space(spark, "tokens")
    with small_batches(spark):
        tokens = work.write(tokenize(docs, tokenizer, end_id), "tokens")
        # At most one row for each entry of the vocabulary.
        counts = count_symbols(tokens).toPandas()
    spark.createDataFrame(counts, "id BIGINT, n BIGINT").coalesce(1).write.parquet(f"{path}/frequencies")
    shared = spark.sparkContext.broadcast((counts["id"].to_numpy(), counts["n"].to_numpy()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Frequencies(*shared.value)
        doc_ids, sizes, held, local, size = [], [], [], 0, 0

        def close():
            nonlocal doc_ids, sizes, held, local, size
            block = pack(table, doc_ids, sizes, np.concatenate(held))
            row = pa.RecordBatch.from_arrays(
                [pa.array([local]), pa.array([size]), pa.array([block], pa.binary())], ["local", "n_tokens", "block"]
            )
            doc_ids, sizes, held, local, size = [], [], [], local + size, 0
            return row

        for rows in batches:
            for doc_id, n, packed in zip(*(rows.column(c).to_pylist() for c in ("doc_id", "n_tokens", "ids"))):
                if held and size + n > block_tokens:
                    yield close()
                doc_ids.append(doc_id)
                sizes.append(n)
                held.append(unpress(packed))
                size += n
        if held:
            yield close()

    placed = tokens.repartitionByRange(shuffle_partitions(spark), "doc_id").sortWithinPartitions("doc_id", "ids")
    with small_batches(spark):
        blocks = placed.mapInArrow(run, "local BIGINT, n_tokens BIGINT, block BINARY")
        numbered = blocks.select(F.spark_partition_id().alias("part"), "local", "n_tokens", "block")
        numbered.write.option("compression", "uncompressed").parquet(f"{path}/blocks")


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """``start, n_tokens, block`` of a store; a block's start counts all tokens before it."""
    blocks = spark.read.parquet(f"{path}/blocks")
    totals = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    # One row for each range of documents, as many as shuffle partitions.
    offsets, start = [], 0
    for row in totals.orderBy("part").collect():
        offsets.append((row["part"], start))
        start += row["n"]
    before = F.broadcast(spark.createDataFrame(offsets, "part INT, before BIGINT"))
    return blocks.join(before, "part").select((F.col("before") + F.col("local")).alias("start"), "n_tokens", "block")


def read_store(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` (and ``ids``) of every document of a store."""
    table = spark.read.parquet(f"{path}/frequencies").toPandas()
    shared = spark.sparkContext.broadcast((table["id"].to_numpy(), table["n"].to_numpy()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Frequencies(*shared.value)
        for rows in batches:
            for start, block in zip(rows.column("start").to_pylist(), rows.column("block")):
                doc_ids, sizes, ids = unpack(table, block.as_py())
                ends = np.cumsum(sizes)
                flat = ids.astype("<u4")
                parts = [flat[a:b] for a, b in zip(ends - sizes, ends)]
                columns = {
                    "doc_id": pa.array(doc_ids, pa.int64()),
                    "start": pa.array(start + ends - sizes),
                    "n_tokens": pa.array(sizes),
                    "ids_crc32": pa.array([zlib.crc32(x.tobytes()) for x in parts], pa.int64()),
                }
                if with_ids:
                    columns["ids"] = pa.array([x.astype(np.int32) for x in parts], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_pydict(columns)

    kinds = "doc_id BIGINT, start BIGINT, n_tokens BIGINT, ids_crc32 BIGINT" + ", ids ARRAY<INT>" * with_ids
    return read_blocks(spark, path).mapInArrow(run, kinds)
