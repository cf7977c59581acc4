import hashlib
import random
import zlib

import pytest
from conftest_llm import prose

from sportlake.llm.queries import op11_runs
from sportlake.llm.runs import _runs_of, periodic_runs


def brute_runs(words, least=6, times=4):
    """Every maximal stretch of every period, tested against all smaller periods."""
    found = []
    for q in range(1, len(words) // times + 1):
        i = q
        while i < len(words):
            if words[i] != words[i - q]:
                i += 1
                continue
            start = i - q
            while i < len(words) and words[i] == words[i - q]:
                i += 1
            stretch = words[start:i]
            smaller = any(
                all(stretch[k] == stretch[k - p] for k in range(p, len(stretch))) for p in range(1, q)
            )
            if len(stretch) >= max(least, times * q) and not smaller:
                found.append((start, len(stretch), q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def of(texts, **options):
    return _runs_of([[w.encode() for w in t] for t in texts], options.get("least", 6), options.get("times", 4))


@pytest.mark.parametrize("least,times", [(6, 4), (2, 2), (5, 3), (9, 2)])
def test_runs_equal_brute_force(least, times):
    draw = random.Random(least)
    texts = []
    for _ in range(1500):
        text = []
        while len(text) < draw.randint(0, 70):
            block = [draw.choice("abc") for _ in range(draw.randint(1, 7))]
            text += block * draw.choice([1, 1, 2, 3, 4, 5, 9]) + [draw.choice("abcd")] * draw.randint(0, 2)
        texts.append(text)
    assert of(texts, least=least, times=times) == [brute_runs(t, least, times) for t in texts]


def test_runs_within_runs():
    inner = "a b a b a b a b a b x".split()
    text = ["y", *inner * 5, "z"]
    assert of([text]) == [brute_runs(text)] and len(brute_runs(text)) == 6


def test_frequent_windows_stay_sparse():
    word = ["w"] * 200_000
    line = "one two three four five six".split()
    apart = [w for i in range(2000) for w in [*line, f"u{i}"]]
    assert of([word, line * 20_000, apart]) == [[(0, 200_000, 1)], [(0, 120_000, 6)], []]


def test_rows_and_odd_tables(odd, empty, odd_rows):
    rows = sorted(odd_rows, key=repr)
    found = sorted(periodic_runs(odd).collect(), key=lambda r: repr((r.doc_id, r.n_words)))
    assert sorted((r.doc_id or -1, r.n_words) for r in found) == sorted(
        (i or -1, len((t or "").encode().split())) for i, t, *_ in rows
    )
    assert {r.doc_id: r.collapsed for r in found}[3] == ""
    assert periodic_runs(empty).count() == 0
    with pytest.raises(ValueError, match="times"):
        periodic_runs(odd, times=1)


def edited(doc_id, text):
    words = [w.decode() for w in (text or "").encode().split()]
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def wanted(doc_id, text):
    words = edited(doc_id, text)
    runs = brute_runs(words)
    from fractions import Fraction

    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    three = best or (None, None, None)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    milli = 1000 * best[1] // best[2] if best else None
    return (doc_id, len(runs), *three, milli, sha(lines), sha(collapsed(words, runs)))


def test_query_equals_brute_force(spark, frame, tmp_path):
    rows = [(i, prose(i, i % 90)) for i in range(150)]
    rows += [(200 + i, " ".join("ab cd ef gh".split()[: 1 + i % 4] * 9) + "\x1c\n x") for i in range(30)]
    rows += [(300, None), (301, ""), (302, " \t\n"), (303, "  　 x"), (304, "a " * 500), (303, "b " * 7)]
    frame(rows).write.parquet(f"{tmp_path}/documents.parquet")
    found = op11_runs(spark, str(tmp_path))
    names = "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256".split()
    assert found.columns == names
    assert sorted(map(tuple, found.collect()), key=repr) == sorted((wanted(*r) for r in rows), key=repr)
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows) > 5
