import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lexigraph.llm import token_store as T
from lexigraph.llm.common import scratch

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@settings(deadline=None, max_examples=200)
@given(st.lists(st.text(max_size=60), max_size=5))
def test_ids_are_those_of_whole_texts(texts):
    found = T.Tokens.of(PATH).batch(texts)
    whole = Tokenizer.from_file(PATH) if not hasattr(test_ids_are_those_of_whole_texts, "t") else test_ids_are_those_of_whole_texts.t
    test_ids_are_those_of_whole_texts.t = whole
    assert [x.tolist() for x in found] == [whole.encode(t, add_special_tokens=False).ids for t in texts]


@settings(deadline=None, max_examples=60)
@given(st.lists(st.integers(0, 40), min_size=1, max_size=4000), st.sampled_from([1, 4, 64, 1024]), st.integers(1, 5))
def test_round_trip(ids, lanes, steps):
    ids = np.array(ids, np.int64) ** 3
    values, counts = np.unique(ids, return_counts=True)
    table = T.Frequencies(values, counts)
    assert int(table.scaled.sum()) == 1 << table.bits and table.scaled.min() >= 1
    block = T.pack(table, [None, 7], [len(ids) - 1, 1], ids, lanes, steps)
    doc_ids, sizes, back = T.unpack(table, block)
    assert doc_ids == [None, 7] and sizes.tolist() == [len(ids) - 1, 1] and back.tolist() == ids.tolist()


def test_stretches_decode_on_their_own_and_checksums_hold():
    ids = np.random.default_rng(0).geometric(0.05, 40_000)
    table = T.Frequencies(*np.unique(ids, return_counts=True))
    words, stretches = T.encode(table, ids, 64, 100)
    assert len(stretches) == 7
    at, crc, states = stretches[3]
    part = T.decode_stretch(table, words.astype(np.uint64), at, states, 6400)
    assert part.tolist() == ids[3 * 6400 : 4 * 6400].tolist() and zlib.crc32(part.astype("<u4").tobytes()) == crc
    block = bytearray(T.pack(table, [1], [len(ids)], ids))
    block[-4000] ^= 255
    with pytest.raises(ValueError):
        T.unpack(table, bytes(block))


def expected(rows, tokenizer):
    found, start = [], 0
    encoded = [(r.doc_id, np.array(tokenizer.encode(r.text or "", add_special_tokens=False).ids + [1], "<u4")) for r in rows]
    for doc_id, ids in sorted(encoded, key=lambda x: (x[0] is not None, x[0] or 0)):
        found.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return found


def test_store(spark, documents, tokenizer):
    path = scratch(spark, "test_store")
    T.write_store(documents, PATH, path, block_tokens=5_000)
    rows = T.read_store(spark, path, with_ids=True).collect()
    assert sorted(map(tuple, (r[:4] for r in rows))) == expected(documents.collect(), tokenizer)
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in rows)


def test_odd_rows(spark, docs, empty, tokenizer):
    path = scratch(spark, "test_store")
    T.write_store(docs, PATH, path)
    rows = T.read_store(spark, path).collect()
    assert sorted(r.n_tokens for r in rows) == sorted(x[2] for x in expected(docs.collect(), tokenizer))
    starts = sorted((r.start, r.n_tokens) for r in rows)
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:]))
    path = scratch(spark, "test_store")
    T.write_store(empty, PATH, path)
    assert T.read_store(spark, path).collect() == []
