import math
import re
from collections import Counter

import cases
import numpy as np
import pytest

from martlet.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def cut(text):
    return TERM.findall((text or "").translate(UPPER))


def brute(docs, items, k=20):
    bags = [(d, cut(t)) for d, t in docs]
    n, length = sum(bool(w) for _, w in bags), sum(len(w) for _, w in bags)
    df = Counter(t for _, w in bags for t in set(w))
    out = []
    for item, text in items.items():
        asked, scores = Counter(cut(text)), []
        for doc, words in bags:
            tf = Counter(words)
            if words:
                m = 75 + 25 * len(words) * n // length
                scores.append((sum(
                    q * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                    * (10**9 * tf[t] // (1000 * tf[t] + 12 * m))
                    for t, q in asked.items() if tf[t]), doc))
        best = sorted((x for x in scores if x[0] > 0),
                      key=lambda x: (-x[0], x[1] is None, x[1] or 0))[:k]
        out += [(item, i + 1, doc, s) for i, (s, doc) in enumerate(best)]
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


def got(spark, docs, items, k=20):
    frame = spark.createDataFrame(docs, "doc_id long, text string, rank int, score string")
    asked = spark.createDataFrame(items, "item_id long, text string, n string")
    rows = lexical.search(frame.repartition(3), asked, k=k).collect()
    return sorted(map(tuple, rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


ITEMS = [
    (1, "The people have been there, THE other", ""), (2, None, ""), (3, "!!! ...", ""), (4, "nowherefound", ""),
    (5, "Über 日本語 changedword one one one", ""), (6, cases.words(cases.EN, 3000, 9), ""),
    (1, "The people have been there, THE other", "x"), (7, "zebra", ""), (7, "and", ""), (None, "one two", ""),
]


@pytest.mark.parametrize("k", [20, 2])
def test_equals_brute_force(spark, k):
    docs = [(r[0], r[1], 0, "") for r in cases.rows()] + [(100 + i, "one two", 0, "") for i in range(30)]
    least = {}
    for item, text, _ in ITEMS:
        least[item] = min(least.get(item, text or ""), text or "")
    assert got(spark, docs, ITEMS, k) == brute([d[:2] for d in docs], least, k)


def test_blocks_tiles_and_digits(spark, monkeypatch):
    """Many blocks, narrow tiles and short digits give the same scores."""
    docs = [(i, cases.words(cases.EN + cases.DE, 30, i), 0, "") for i in range(120)]
    items = [(i, cases.words(cases.EN + cases.DE, 12, 1000 + i), "") for i in range(25)]
    whole = got(spark, docs, items)
    assert whole == brute([d[:2] for d in docs], {i: t for i, t, _ in items})
    monkeypatch.setattr(lexical, "ITEM_BYTES", 300)
    blocks = list(lexical._item_blocks(spark.createDataFrame(items, "item_id long, text string, n string")))
    assert len(blocks) > 5 and sum(map(len, blocks)) == 25
    assert all(len(b) == 1 or sum(len(t.encode()) for _, t in b) <= 300 for b in blocks)
    block = lexical.Block.of([(i, t) for i, t, _ in items])
    weights = np.arange(len(block.vocabulary)) * 10**7 + 1
    monkeypatch.setattr(lexical, "WIDTH", 5)
    groups = lexical._tiles(block, weights)
    dense = np.zeros((25, len(weights)), np.int64)
    for tiles in groups:
        for tile in tiles:
            assert len(tile.columns) <= 5
            for d, digit in enumerate(tile.digits()):
                assert digit.max() < 2**lexical.DIGIT
                dense[np.ix_(tile.items, tile.columns)] += digit.astype(np.int64) << (lexical.DIGIT * d)
    expected = np.zeros_like(dense)
    expected[block.counts[:, 0], block.counts[:, 1]] = block.counts[:, 2] * weights[block.counts[:, 1]]
    assert (dense == expected).all()
    assert 2**11 * (2**lexical.DIGIT - 1) * 10**6 < 2**53


def test_empty_tables(spark):
    assert got(spark, [], ITEMS) == []
    assert got(spark, [(1, "one", 0, "")], []) == []
    assert got(spark, [(1, None, 0, ""), (2, "...", 0, "")], ITEMS) == []
