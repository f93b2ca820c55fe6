import cases
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from martlet.llm import pieces
from martlet.llm.piece_model import Backend, ModelFile

PATH = public_tokenizers.path("piece_bpe_32k.model")
BACKEND, LIBRARY = pieces.load(PATH)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=40) | st.text(alphabet="ab ▁\n\té漢😀<s>0x", max_size=40))
def test_parity(text):
    text = text.encode("utf-8", "ignore").decode().replace("\0", "")
    ids = BACKEND.encode([text])[0].tolist()
    assert ids == LIBRARY.encode(text)
    assert BACKEND.decode([np.array(ids, np.int64)])[0] == LIBRARY.decode(ids)


def test_ids_that_make_no_text():
    start = next(i for i, (t, _, _) in enumerate(BACKEND.file.pieces) if t == "<0xC3>")
    assert BACKEND.decode([np.array([start])]) == ["\ufffd"]


def _message(number, payload):
    def varint(n):
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])
    return varint(number << 3 | 2) + varint(len(payload)) + payload


def unigram_model():
    """A unigram model file: scored pieces, byte pieces, a normaliser that trims spaces."""
    import struct
    words = ["▁", "▁the", "the", "he", "▁he", "a", "b", "c", "t", "h", "e", "▁ab", "bc", "abc"]
    items = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    items += [(w, -1.5 - 0.37 * i, 1) for i, w in enumerate(words)]
    items += [(f"<0x{i:02X}>", -20.0, 6) for i in range(256)]
    out = b""
    for text, score, kind in items:
        out += _message(1, _message(1, text.encode()) + b"\x15" + struct.pack("<f", score) + bytes([0x18, kind]))
    return out + _message(2, b"\x18\x01\x98\x02\x01") + _message(3, b"\x18\x01\x20\x01\x28\x01")


@pytest.mark.parametrize("text", ["the abc", " a  b ", "", "hehe the the", "abcabc bc ab", "zé"])
def test_unigram_scores(text):
    data = unigram_model()
    backend = Backend(data)
    library = sentencepiece.SentencePieceProcessor(model_proto=data)
    assert ModelFile.parse(data).kind == 1 and ModelFile.parse(data).drop_extra_spaces
    ids = backend.encode([text])[0].tolist()
    assert ids == library.encode(text)
    assert backend.decode([np.array(ids, np.int64)])[0] == library.decode(ids)


def test_documents(spark):
    docs = cases.frame(spark)
    got = pieces.encode(docs, PATH)
    rows = got.collect()
    assert len(rows) == len(cases.rows()) and all(r["parity"] and r["round_trip"] for r in rows)
    back = {r["doc_id"]: r["text"] for r in pieces.decode(got, PATH).collect()}
    for r in cases.rows():
        assert back[r[0]] == (r[1] or "")
    assert pieces.encode(docs.limit(0), PATH).collect() == []
