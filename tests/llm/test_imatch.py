import hashlib
import re
from collections import Counter

import xxhash
from conftest_llm import prose

from sportlake.llm import imatch


def edited(rows):
    """(id, text) in descending order, as the next document follows."""
    result = {}
    for (doc, a), (_, b) in zip(rows, rows[1:] + rows[:1], strict=True):
        k = len(a) // 3
        text = a[: len(a) - k] + b[:k]
        result[doc] = (len(a), hashlib.sha256(text.encode()).hexdigest())
    return result


def test_next_document_across_buckets(frame, monkeypatch):
    monkeypatch.setattr(imatch, "BUCKET", 10)
    common = [prose(1000 + i, 1) for i in range(60)]
    rows = [(i * i, " ".join(common[(i * k) % 60] for k in range(1, 40)) + " é😀" * (i % 3)) for i in range(130)]
    found = {r.doc_id: r for r in imatch.compared(frame(rows)).collect()}
    want = edited(sorted(rows, reverse=True))
    assert {d: (r.n_chars, r.edited_sha256) for d, r in found.items()} == want


def test_likeness(frame):
    vocabulary = [prose(5000 + i, 1) + str(i) for i in range(3000)]
    rows = [(i, " ".join(vocabulary[(i * 97 + k * 31) % 3000] for k in range(150))) for i in range(120)]
    rows += [(500 + i, rows[i][1]) for i in range(5)]
    found = {r.doc_id: r for r in imatch.compared(frame(rows)).collect()}
    assert sum(r.near_edited for r in found.values()) > 5 * sum(r.near_next for r in found.values())
    assert all(found[i].fingerprint == found[500 + i].fingerprint for i in range(5))
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found.values())
    prints = {r.doc_id: r.fingerprint for r in imatch.fingerprints(frame(rows)).collect()}
    assert prints == {d: r.fingerprint for d, r in found.items()}


def test_terms_of_one_text_enter_no_lexicon(frame):
    # 240,000 terms that one text has, and a copy of each text with ten more of them.
    words = [f"common{i}" for i in range(500)]
    rows = []
    for i in range(120):
        text = " ".join(words[(i * 37 + k * 11) % 500] for k in range(30))
        own = " ".join(f"own{i}x{k}" for k in range(2000))
        rows += [(i, f"{text} {own}"), (1000 + i, text + "".join(f" typo{i}x{k}" for k in range(10)))]
    prints = {r.doc_id: r.fingerprint for r in imatch.fingerprints(frame(rows)).collect()}
    assert all(prints[i].split(".")[1:] == prints[1000 + i].split(".")[1:] for i in range(120))


def test_odd_rows(odd, empty, frame):
    found = imatch.compared(odd).collect()
    assert len(found) == 11
    by_id = {}
    for r in found:
        by_id.setdefault(r.doc_id, []).append(r)
    assert len(by_id[6]) == 2 and len({r.fingerprint for r in by_id[6]}) == 1
    assert by_id[1][0].fingerprint == by_id[2][0].fingerprint and by_id[3][0].n_chars == 0
    assert by_id[3][0].fingerprint == by_id[4][0].fingerprint == by_id[5][0].fingerprint
    assert imatch.compared(empty).collect() == []
    (alone,) = imatch.compared(frame([(1, "abcdef")])).collect()
    assert alone.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest() and alone.near_next == 1


def hashed(value, seed=42):
    """The hash of a text or a 64-bit number, signed."""
    data = value.encode() if isinstance(value, str) else value.to_bytes(8, "little", signed=True)
    found = xxhash.xxh64_intdigest(data, seed & (1 << 64) - 1)
    return found - (1 << 64) if found >> 63 else found


def terms_of(text):
    return {hashed(w) for w in re.split(r"[\x20\x09-\x0D]+", text.lower()) if w}


def brute_values(texts, counted):
    """For each text the sum over all terms, and the value of each subset that holds terms of it."""
    df = Counter(t for text in counted for t in terms_of(text))
    band = {t for t, n in df.items() if imatch.LEAST <= n <= imatch.LARGEST * len(counted)}
    found = []
    for text in texts:
        sums, terms = {}, terms_of(text)
        for t in terms & band:
            h = hashed(77, hashed(t)) & (1 << 64) - 1
            if h % imatch.OF < imatch.TAKEN:
                subset = (h >> 7) % imatch.LEXICONS
                sums[subset] = sums.get(subset, 0) + t % (1 << 40)
        every = sum(t % (1 << 40) for t in terms) if terms else None
        found.append((every, {s: hashed(v) % (1 << 32) for s, v in sums.items()}))
    return found


def written(value):
    every, sums = value
    whole = "-" if every is None else f"{hashed(every) % (1 << 32):08x}"
    return ".".join([whole, *[f"{s << 32 | v:010x}" for s, v in sorted(sums.items())]])


def alike(a, b):
    if not a[1] and not b[1]:
        return float(a[0] == b[0])
    return len(a[1].items() & b[1].items()) / len(a[1].keys() | b[1].keys())


def test_fingerprints_and_likeness_equal_brute_force(frame, monkeypatch):
    monkeypatch.setattr(imatch, "BUCKET", 30)
    vocabulary = [prose(7000 + i, 1) + str(i % 7) for i in range(900)]
    rows = [(3 * i, " ".join(vocabulary[(i * 53 + k * k) % 900] for k in range(i % 90))) for i in range(240)]
    rows += [(1000 + i, rows[i + 60][1] + " The  tail\tÉ") for i in range(40)]
    rows.sort(reverse=True)
    texts = [t for _, t in rows]
    edits = [a[: len(a) - len(a) // 3] + b[: len(a) // 3] for a, b in zip(texts, texts[1:] + texts[:1], strict=True)]
    own, changed = brute_values(texts, texts), brute_values(edits, texts)
    want = {
        d: (written(a), written(e), alike(a, e), alike(a, b))
        for (d, _), a, e, b in zip(rows, own, changed, own[1:] + own[:1], strict=True)
    }
    found = imatch.compared(frame(rows)).collect()
    names = "fingerprint edited_fingerprint near_edited near_next".split()
    assert {r.doc_id: tuple(r[n] for n in names) for r in found} == want
    assert sum(len(v) > 1 for _, v in own) > 100


def test_rows_without_id_are_parted_too(frame, monkeypatch):
    monkeypatch.setattr(imatch, "BUCKET", 8)
    rows = [(None, prose(i, 9)) for i in range(60)] + [(i, prose(100 + i, 9)) for i in range(5)]
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), 0 if r[0] is not None else hashed(r[1])))
    want = edited([(t, t) for _, t in order])
    found = imatch.compared(frame(rows)).collect()
    assert sorted((r.n_chars, r.edited_sha256) for r in found) == sorted(want.values())
