"""The corpus pipeline against a version in plain Python, on awkward rows."""

import random
import re
import tempfile
import zlib

import cases
import corpus_pipeline
import numpy as np
import public_tokenizers
from test_llm_exact_dedup import brute as brute_exact
from test_llm_jaccard_join import brute as brute_near

import __spark_entry__
from martlet.llm import surrogates
from martlet.llm.queries import PII_KEY
from martlet.llm.tokens import TokenIds

EXTRA = [
    (900, "Write to jo.12@mail.example.com now", "en", "s", 1, "", 0, ""),
    (901, "Write  to jo.12@mail.example.com now", "en", "s", 1, "", 0, ""),
    (902, "12345", "en", "s", 1, "", 0, ""),
]


def plain(rows):
    rows = [r for r in rows if any(c.isalpha() for c in r[1] or "")]
    kept = {(v[0], v[4]): r for r, v in zip(rows, [brute_one(rows, r) for r in rows]) if v[3]}
    rows = list(kept.values())
    near = brute_near(rows)
    rows = [r for r in rows if r[0] is None or near[r[0]][1] == r[0]]
    out = {}
    for r in rows:
        given = {(m.kind, surrogates.base(m.canon)): surrogates.surrogate(m.kind, surrogates.base(m.canon), PII_KEY)
                 for m in surrogates.find(r[1])}
        out[r[0]] = surrogates.replace(r[1], given)[0]
    return out


def brute_one(rows, row):
    return next(v for v in brute_exact(rows) if v == one(rows, row))


def one(rows, row):
    import hashlib
    import re
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    same = [r[0] for r in rows if norm(r[1]) == norm(row[1])]
    known = [i for i in same if i is not None]
    keep = min(known) if known else None
    return (row[0], keep, len(same), row[0] == keep, hashlib.sha256(norm(row[1]).encode()).hexdigest())


def test_stages_in_order_with_their_columns(spark):
    folder = tempfile.mkdtemp(prefix="martlet-test-")
    rows = cases.rows() + EXTRA
    docs = cases.frame(spark, rows)
    columns = docs.columns
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        stage(spark, docs, folder).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if i < 4:
            assert docs.columns == columns, name
    want = plain(rows)
    assert {r["doc_id"]: r["text"] for r in before.collect()} == want
    assert before.count() == len(want)
    coder = TokenIds(public_tokenizers.path("word_bpe_49k.json"))
    got = {}
    for r in docs.orderBy("doc_id", "start").collect():
        got[r["doc_id"]] = got.get(r["doc_id"], b"") + r["ids"]
    for doc, text in want.items():
        ids = np.array(coder.tokenizer.encode(text, add_special_tokens=False).ids + [1], "<u4")
        assert got[doc] == ids.tobytes()


def test_run_reads_documents(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.count() > 0 and __spark_entry__.queries()["pipeline"] is corpus_pipeline.run


def test_empty_table(spark):
    folder = tempfile.mkdtemp(prefix="martlet-test-")
    spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(0).write.parquet(
        f"{folder}/documents.parquet")
    assert corpus_pipeline.run(spark, folder).collect() == []


def brute_stage(rows):
    """Ids that stay: shingles of five words, similarity 0.8 or more."""
    sets = {}
    for r in rows:
        found = re.findall(r"[^\x20\x09-\x0D]+", r[1].lower())
        sets[r[0]] = {tuple(found[i:i + 5]) for i in range(max(1, len(found) - 4))}
    least = {i: i for i in sets}
    for _ in sets:  # until nothing moves
        before = dict(least)
        for a in sets:
            for b in sets:
                if 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]):
                    least[a] = least[b] = min(least[a], least[b])
        if least == before:
            break
    return {i for i in sets if least[i] == i}


def test_near_duplicates_of_five_words_and_eight_tenths(spark):
    rng = random.Random(11)
    base = [f"v{i}" for i in range(100)]
    edited = base[:]
    edited[30], edited[70] = "changed", "edited"  # 86 of 106 shingles of five words
    texts = [" ".join(base), " ".join(edited), "a b c d", "a b c e", "a b c d e f g h", "a b c d e f g x"]
    for group, size in enumerate((8, 12, 16, 30, 60, 150, 300)):
        words = [f"w{group}x{rng.randrange(400)}" for _ in range(size)]
        for _ in range(14):
            copy = words[:]
            for _ in range(rng.randrange(1 + max(1, size // 25))):
                copy[rng.randrange(size)] = f"e{rng.randrange(10**6) if rng.random() < .7 else 7}"
            texts.append(" ".join(copy[:size - rng.choice((0, 0, 1, size // 12))]))
    order = list(range(len(texts)))
    rng.shuffle(order)
    rows = [(i, texts[k], "en", "s", 1, "", 0, "") for i, k in enumerate(order)]
    got = corpus_pipeline.near_duplicates(spark, cases.frame(spark, rows), "")
    want = brute_stage(rows)
    assert {r["doc_id"] for r in got.collect()} == want
    assert not {order.index(0), order.index(1)} <= want and len(want) < len(rows)


def test_documents_stay_where_no_language_can_be_learned(spark):
    texts = ["some words", "日本語", None, "", "12 !", "more of them"]
    held_out = next(i for i in range(100, 200) if zlib.crc32(str(i).encode()) % 4 == 2)
    for last in ((50, None), (held_out, "en")):
        rows = [(i, t, None, "s", 1, "", 0, "") for i, t in enumerate(texts)] + [
            (last[0], "the last", last[1], "s", 1, "", 0, "")]
        got = corpus_pipeline.language_id(spark, cases.frame(spark, rows), "").collect()
        assert sorted(r["doc_id"] for r in got) == [0, 1, 5, last[0]]
