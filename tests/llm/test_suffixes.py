import hashlib

import numpy as np
from conftest_llm import prose

from sportlake.llm.suffixes import leftmost_smallest, multikey_order, repeated_spans


def expected(rows, length):
    seen, result = {}, []
    data = [(t or "").encode() for _, t in rows]
    for b in data:
        for i in range(len(b) - length + 1):
            seen[b[i : i + length]] = seen.get(b[i : i + length], 0) + 1
    for (doc, _), b in zip(rows, data, strict=True):
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = True
        rest = bytes(np.frombuffer(b, np.uint8)[~gone])
        runs = int((np.diff(np.r_[False, gone].astype(int)) == 1).sum())
        result.append((doc, len(b), int(gone.sum()), runs, hashlib.sha256(rest).hexdigest()))
    return sorted(result, key=repr)


def got(frame):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in frame.collect()), key=repr)


def test_equals_all_windows(frame):
    passage, other = prose(50, 40), prose(51, 30)
    rows = [(i, prose(i, 20) + passage[i % 7 :] + prose(100 + i, 10) + other[: 60 + i]) for i in range(40)]
    rows += [(100, "ab" * 300), (101, "ab" * 100 + "c" + "ab" * 90), (102, passage), (103, passage[:41])]
    rows += [(104, prose(7, 30) * 2)]
    for length in (40, 64):
        assert got(repeated_spans(frame(rows), length)) == expected(rows, length)


def test_odd_rows(odd, odd_rows):
    rows = [r[:2] for r in odd_rows]
    assert got(repeated_spans(odd, 400)) == expected(rows, 400)


def test_segments(frame, monkeypatch):
    monkeypatch.setattr("sportlake.llm.suffixes.SEGMENT", 300)
    rows = [(1, prose(1, 300)), (2, prose(2, 100) + prose(1, 300)[500:900] + prose(3, 90))]
    # Tasks run in other processes; here the helpers that cut a text are compared directly.
    from sportlake.llm.suffixes import _runs

    data = np.frombuffer(rows[0][1].encode(), np.uint8)
    covered = np.zeros(len(data) - 63, int)
    for _, _, _, at, low, high in _runs(data, 64):
        for a, x, y in zip(at, low, high, strict=True):
            covered[x : y + 1] += 1
            assert x <= a and y >= a - 32
    assert (covered == 1).all()
    assert got(repeated_spans(frame(rows), 64)) == expected(rows, 64)


def test_empty(empty):
    assert repeated_spans(empty).collect() == []


def test_multikey_order():
    draw = np.random.default_rng(3)
    words = [draw.integers(0, 5, 60_000), draw.integers(0, 50, 60_000), draw.integers(-9, 9, 60_000)]
    order = multikey_order(words)
    rows = np.stack(words, 1)[order]
    assert (rows == np.stack(words, 1)[np.lexsort(words[::-1])]).all()


def test_leftmost_smallest():
    values = np.array([5, 3, 3, 9, 1, 7, 7, 7, 2], np.uint64) << np.uint64(40)
    assert leftmost_smallest(values, 3).tolist() == [1, 1, 4, 4, 4, 5, 8]


def starts(data, size):
    """How often each string of ``size`` bytes starts in the texts."""
    seen = {}
    for b in data:
        for i in range(len(b) - size + 1):
            seen[b[i : i + size]] = seen.get(b[i : i + size], 0) + 1
    return seen


def test_passages_shorter_than_a_window_are_told(frame):
    texts = {i: prose(500 + i, 150) for i in range(24)}
    for i in range(0, 12, 2):
        words = prose(900 + i, 70).split(" ")
        passage = " ".join(words[: next(n for n in range(51, 71) if len(" ".join(words[:n])) >= 260)])
        assert len(passage.encode()) < 390
        for doc, at in ((i, 200), (i + 1, 330)):
            texts[doc] = texts[doc][:at] + " " + passage + " " + texts[doc][at:]
    found = {r.doc_id: r for r in repeated_spans(frame(list(texts.items())), 400).collect()}
    assert all(r.n_removed == 0 for r in found.values())
    assert {doc for doc, r in found.items() if r.n_shared >= 125} == set(range(12))
    assert all(found[doc].n_shared == 0 for doc in range(12, 24))


def test_shared_bytes_between_gram_and_short(frame):
    passage = prose(70, 60)
    rows = [(i, prose(300 + i, 30) + passage[i : i + 12 + 3 * i] + prose(400 + i, 20)) for i in range(20)]
    rows += [(50, passage[:39]), (51, passage[:40]), (52, "ab" * 100), (53, passage[:25] * 4), (54, None)]
    data = [(t or "").encode() for _, t in rows]
    grams, shorts = starts(data, 20), starts(data, 40)
    found = {r.doc_id: r.n_shared for r in repeated_spans(frame(rows), 64).collect()}
    for (doc, _), b in zip(rows, data, strict=True):
        covered = np.zeros(len(b), bool)
        for i in range(len(b) - 19):
            if grams[b[i : i + 20]] > 1:
                covered[i : i + 20] = True
        assert found[doc] <= covered.sum()
        if any(shorts[b[i : i + 40]] > 1 for i in range(len(b) - 39)):
            assert found[doc] >= 20
    assert found[51] >= 20 and found[54] == 0 and 0 in found.values()


def test_segments_list_each_short_anchor_once(monkeypatch):
    from sportlake.llm import suffixes

    data = np.frombuffer(prose(1, 300).encode(), np.uint8)
    found = []
    for size in (300, 1 << 20):
        monkeypatch.setattr(suffixes, "SEGMENT", size)
        parts = []
        for _, core, _, at, low, _ in suffixes._runs(data, 64, 40):
            own = suffixes._shared(at, low)
            parts.append((at[own], core[own]))
        at, core = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(at)
        found.append((at[order].tolist(), core[order].tolist()))
    assert found[0] == found[1] and len(set(found[0][0])) == len(found[0][0])
