import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexigraph.llm import piece_fst as P

PATH = public_tokenizers.path("piece_bpe_32k.model")
FST = P.Transducer.of(PATH)
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)


@settings(deadline=None, max_examples=500)
@given(st.text(alphabet="aabcdeinst  \n\t▁éñß日本☃𝒳'.,!01-_", max_size=60))
def test_ids_are_those_of_the_library(text):
    ids = FST.encode(text).tolist()
    assert ids == LIBRARY.encode(text)
    assert FST.decode(ids) == text.replace("▁", " ")


@settings(deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    text = text.replace("\x00", "")
    assert FST.encode(text).tolist() == LIBRARY.encode(text)


@given(st.lists(st.integers(0, 255), max_size=12))
def test_decoding_any_bytes(values):
    ids = [FST.bytes[v] for v in values]
    raw = bytes(values).decode("utf-8", "replace")
    assert FST.decode(ids) == (raw[1:] if raw.startswith(" ") else raw)


def test_whole_table(documents):
    rows = P.round_trip(documents, PATH).join(documents, "doc_id").collect()
    assert len(rows) == documents.count()
    for r in rows:
        assert r.piece_ids == LIBRARY.encode(r.text) and r.n_pieces == len(r.piece_ids) and r.round_trip


def test_odd_rows(docs, empty):
    encoded = P.encode_documents(docs, PATH)
    assert encoded.columns == [*docs.columns, "piece_ids"]
    rows = P.decode_documents(encoded, PATH).collect()
    assert all(r.decoded == (r.text or "") and r.piece_ids == LIBRARY.encode(r.text or "") for r in rows)
    assert all(r.round_trip for r in P.round_trip(docs, PATH).collect())
    assert P.round_trip(empty, PATH).collect() == [] == P.encode_documents(empty, PATH).collect()


def _varint(n):
    out = b""
    while True:
        n, low = n >> 7, n & 127
        out += bytes([low | (128 if n else 0)])
        if not n:
            return out


def _message(number, payload):
    return _varint(number * 8 + 2) + _varint(len(payload)) + payload


def _model(kind, pieces, squeeze=0):
    import struct

    body = b"".join(
        _message(1, _message(1, p.encode()) + _varint(2 * 8 + 5) + struct.pack("<f", s) + _varint(3 * 8) + _varint(t))
        for p, s, t in pieces
    )
    return body + _message(2, _varint(3 * 8) + _varint(kind)) + _message(3, _varint(4 * 8) + _varint(squeeze))


def test_unigram_takes_the_cheapest_path():
    pieces = [("<unk>", 0, P.UNKNOWN), ("▁", -2, 1), ("a", -3, 1), ("b", -3, 1), ("ab", -5, 1), ("▁a", -4, 1), ("ba", -1, 1)]
    fst = P.Transducer(_model(P.UNIGRAM, pieces))
    assert [fst.pieces[i] for i in fst.encode("abab")] == ["▁a", "ba", "b"]
    assert [fst.pieces[i] for i in fst.encode("a?")] == ["▁a", "<unk>"]
    with pytest.raises(ValueError):
        P.Transducer(_model(P.UNIGRAM, pieces, squeeze=1))


def test_merges_share_the_strings_of_the_model():
    """Every merge held strings and a score of its own, in every worker."""
    pieces = [("<unk>", 0.0, 2), ("a", -10.5, 1), ("b", -11.5, 1), ("ab", -1.5, 1), ("abab", -2.5, 1)]
    fst = P.Transducer(_model(P.PAIR_MERGE, pieces))
    merges = fst.made[fst.ids["abab"]]
    assert [(s, a, b) for s, a, b in merges] == [(-1.5, "ab", "b"), (-1.5, "ab", "ab"), (-2.5, "abab", "abab")]
    own = {id(x) for x in (*fst.pieces, *fst.scores)}
    assert all(id(s) in own and id(a) in own for s, a, _ in merges)
