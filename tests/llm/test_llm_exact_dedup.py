import hashlib
import re
from collections import defaultdict

import cases
import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from martlet.llm.cqf import QuotientFilter
from martlet.llm.exact_dedup import exact_dedup


def brute(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "") for r in rows]
    ids = defaultdict(list)
    for r, n in zip(rows, norm):
        ids[n].append(r[0])
    out = []
    for r, n in zip(rows, norm):
        known = [i for i in ids[n] if i is not None]
        keep = min(known) if known else None
        out.append((r[0], keep, len(ids[n]), r[0] == keep, hashlib.sha256(n.encode()).hexdigest()))
    return sorted(out, key=str)


def test_equals_brute_force(spark):
    got = exact_dedup(cases.frame(spark)).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    assert sorted(map(tuple, got), key=str) == brute(cases.rows())


def test_empty(spark):
    assert exact_dedup(cases.frame(spark, [])).collect() == []


def test_hot_group_and_shared_fingerprint_parts(spark):
    data = [(i, "same text" if i % 3 == 0 else f"text {i}", "en", "s", 1, "", 0, "") for i in range(600)]
    got = {r["doc_id"]: r for r in exact_dedup(cases.frame(spark, data)).collect()}
    assert got[597]["keep_id"] == 0 and got[0]["group_size"] == 200 and got[0]["kept"]
    assert got[1]["group_size"] == 1 and sum(r["kept"] for r in got.values()) == 401


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**64 - 1) | st.integers(0, 20), max_size=60), max_size=5))
def test_filters_merge_without_loss(parts):
    filters = [QuotientFilter.from_bytes(QuotientFilter.build(np.array(p, np.uint64)).to_bytes())
               for p in parts]
    whole = QuotientFilter().merge(*filters)
    keys, counts = np.unique(np.array([x for p in parts for x in p], np.uint64), return_counts=True)
    assert (whole.keys == keys).all() and (whole.counts == counts).all()
