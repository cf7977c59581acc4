import random
import re

import numpy as np
import pyarrow as pa
from conftest_llm import prose

from sportlake.llm.minhash import BANDS, ROWS, band_keys, near_duplicates, signature
from sportlake.llm.tables import components
from sportlake.llm.words import shingle_sets


def expected(rows, length, percent):
    sets = []
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
        n = min(length, len(words))
        sets.append({tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    ids = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            ids[find(i)] = min(doc, ids.get(find(i), doc))
    return sorted(
        ((d, len(s), ids.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))),
        key=repr,
    )


def got(frame):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in frame.collect()), key=repr)


def edited(text, share, seed):
    draw = random.Random(seed)
    return " ".join(w if draw.random() > share else prose(draw.random(), 1) for w in text.split())


def test_equals_all_pairs(frame):
    base = prose(5, 150)
    # Edits around the threshold make groups whose members are linked to some others only.
    rows = [(i, edited(base, 0.01 * (i % 9), i)) for i in range(120)]
    rows += [(500 + i, prose(900 + i, 5 + i)) for i in range(20)]
    for length in (2, 5):
        found = near_duplicates(frame(rows), length, 80)
        assert got(found) == expected(rows, length, 80)


def test_odd_rows(odd, odd_rows):
    found = near_duplicates(odd, 5).collect()
    want = expected([r[:2] for r in odd_rows], 5, 80)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=repr) == want
    kept = {(r.doc_id, r.kept) for r in found}
    assert {(1, True), (2, False), (3, True), (4, True), (6, False), (None, True)} <= kept


def test_empty(empty):
    assert near_duplicates(empty).collect() == []


def test_signature_estimates_similarity():
    draw = np.random.default_rng(1)
    common = draw.integers(0, 2**63, 800, dtype=np.uint64)
    a = np.concatenate([common, draw.integers(0, 2**63, 100, dtype=np.uint64)])
    b = np.concatenate([common, draw.integers(0, 2**63, 100, dtype=np.uint64)])
    share = (signature(a) == signature(b)).mean()
    assert abs(share - 0.8) < 0.12
    assert len(band_keys(signature(a))) == BANDS and len(signature(a)) == BANDS * ROWS


def test_long_text_in_segments(monkeypatch):
    text = prose(8, 3000)
    whole = list(shingle_sets(pa.array([text, None, ""]), 5))
    monkeypatch.setattr("sportlake.llm.words.SEGMENT", 500)
    parts = list(shingle_sets(pa.array([text, None, ""]), 5))
    assert all((a == b).all() for a, b in zip(whole, parts, strict=True))


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(90, 91), (7, 7)], "a long, b long")
    found = {r.node: r.root for r in components(edges).collect()}
    assert found == {i: 0 for i in range(41)} | {90: 90, 91: 90}
