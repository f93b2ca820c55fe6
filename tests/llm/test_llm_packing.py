import itertools
import zlib
from collections import defaultdict

import cases
import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from martlet.llm.packing import hilbert_key, pack, sequences
from martlet.llm.tokens import TokenIds

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_hilbert_neighbours_are_one_step_apart():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
        key = hilbert_key(cells, bits)
        assert sorted(key) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(key)], axis=0)).sum(1) == 1).all()


CODER = TokenIds(PATH)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("abYZ09 '’.,!\t\n\x0b\x1c\x85\xa0éÉßŒİſŁ×÷ªµΣς́漢½😀<|>sdtlrevm"),
               max_size=40) | st.text(max_size=20))
def test_cached_ids_equal_the_library(text):
    text = text.encode("utf-8", "ignore").decode()
    ids = np.array(CODER.tokenizer.encode(text, add_special_tokens=False).ids, CODER.width)
    assert CODER.encode([text])[0] == ids.tobytes()


def test_pieces_cover_every_id_once(spark):
    rows = cases.rows()
    pieces = pack(cases.frame(spark), PATH, length=256)
    got = pieces.collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    for doc, text in {(r[0], r[1]) for r in rows}:
        ids = np.array(CODER.tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        times = sum(1 for r in rows if r[0] == doc)
        own = by_doc[doc]
        assert sum(r["length"] for r in own) == times * len(ids)
        for r in own:
            piece = ids[r["start"]:r["start"] + r["length"]].tobytes()
            assert r["doc_tokens"] == len(ids) and r["ids"] == piece
            assert r["ids_crc32"] == zlib.crc32(piece)
    used = {}
    for s, own in by_sequence.items():
        own.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in own] == [sum(x["length"] for x in own[:i]) for i in range(len(own))]
        used[s] = sum(r["length"] for r in own)
    assert sorted(used) == list(range(len(used)))
    assert all(n == 256 for s, n in used.items() if s != max(used))
    padded = {r["sequence_id"]: r for r in sequences(pieces, 256).collect()}
    last = max(used)
    assert padded[last]["used"] == used[last]
    assert len(padded[last]["ids"]) in (256, used[last])


def test_neighbours_on_the_curve_are_alike(spark):
    data = [(i, cases.words(cases.EN if i % 2 else cases.DE, 60, i), "x", "s", 1, "", 0, "")
            for i in range(200)]
    order = [r["doc_id"] for r in pack(cases.frame(spark, data), PATH, length=64).orderBy(
        "sequence_id", "offset").where("start = 0").collect()]
    changes = sum(a % 2 != b % 2 for a, b in zip(order, order[1:]))
    assert changes < 60  # of 199; by chance about 100


def test_empty(spark):
    assert pack(cases.frame(spark, []), PATH).collect() == []
