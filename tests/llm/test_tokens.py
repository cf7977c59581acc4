import hashlib
import random
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from conftest_llm import prose

from sportlake.llm import tokens
from sportlake.llm.queries import op12_tokens


@pytest.fixture(scope="module")
def aligner():
    return tokens._aligner(f"{tokens.FOLDER}/{tokens.BYTE_LEVEL}", f"{tokens.FOLDER}/{tokens.PIECES}")


ODD_TEXTS = [
    "",
    " ",
    "  two  spaces and\ttab\n\nlines \n x",
    "it's we'll 's 't <|endoftext|> </s> <unk> <0x41>",
    "ünïcode 東京 😀👩‍👩‍👧 नमस्ते \x00 \x1c x y 　z  w \x85v",
    "▁under score ▁",
    "aaaaaaaaaaaaaaaaaaaaaaaaaaaaa 1234567890123 0.5e-10",
    "é ﬁ ① ​﻿ x",
    "     lead",
    "trail     ",
    "\n",
    "((((((((((((((((((((((((([[[[[[[[[[[[{{{{{{{{{{{{;;;;;;;;;;;;;;;;;;======",
]


def byte_offsets(entries, ids):
    ends, at = [], 0
    for i in ids:
        at += len(entries[i])
        ends.append(at)
    return ends


def brute(texts, aligner):
    """Whole texts tokenized one by one; all pairs of tokens of each group written out."""
    rows, linked = [], []
    for text in texts:
        groups, links = [], Counter()
        if text:
            (a,), (b,) = aligner.a.encode([text]), aligner.b.encode([text])
            whole = b" " + text.encode()
            if b"".join(aligner.a.entries[i] for i in a) == b"".join(aligner.b.entries[i] for i in b) == whole:
                ends_a, ends_b = byte_offsets(aligner.a.entries, a), byte_offsets(aligner.b.entries, b)
                shared, at, bt = set(ends_a) & set(ends_b), 0, 0
                for i, end in enumerate(ends_a):
                    if end in shared:
                        j = ends_b.index(end, bt)
                        own = a[at : i + 1], b[bt : j + 1]
                        groups.append(own)
                        links.update((x, y) for x in own[0] for y in own[1])
                        at, bt = i + 1, j + 1
        written = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        digest = hashlib.sha256(written.encode()).hexdigest() if groups else ""
        rows.append([sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups), sum(links.values()), digest])
        linked.append(links)
    counts = Counter(pair for links in linked for pair in links)
    best = Counter()
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    for row, links in zip(rows, linked):
        n_best = sum(n for pair, n in links.items() if counts[pair] == best[pair[0]])
        row[4:4] = [n_best, sum(n * counts[pair] for pair, n in links.items())]
    return [tuple(row) for row in rows]


TEXTS = [*ODD_TEXTS, *ODD_TEXTS[:5], *[prose(i, 3 * i) for i in range(25)], None, prose(7, 9000), *["same words here"] * 40]


def test_bytes_of_entries(aligner):
    assert tokens.byte_level_alphabet()["Ġ"] == 32 and sorted(tokens.byte_level_alphabet().values()) == [*range(256)]
    assert aligner.cuts and aligner.b.entries[3] == b"\x00"


def test_pieces_give_the_tokens_of_whole_texts(aligner):
    for text in [t for t in TEXTS if t]:
        for side in (aligner.a, aligner.b):
            pieces = [i for own in side.encode(aligner.pieces(text)) for i in own]
            assert pieces == side.encode([text])[0], text


def test_overlaps_equal_brute_force():
    a = pd.DataFrame({"piece": [0, 0, 0, 1], "start": [0, 3, 4, 10], "end": [3, 4, 10, 15]})
    b = pd.DataFrame({"piece": [0, 0, 1, 1], "start": [0, 5, 10, 12], "end": [5, 10, 12, 15]})
    found = tokens.overlaps(a, b)
    wanted = {
        (i, j)
        for i, x in enumerate(a.itertuples())
        for j, y in enumerate(b.itertuples())
        if x.piece == y.piece and x.start < y.end and y.start < x.end
    }
    assert set(map(tuple, found.to_numpy().tolist())) == wanted and len(found) == len(wanted)


@pytest.mark.parametrize("broadcast", [0, 7, 1 << 18])
def test_query_equals_brute_force(spark, frame, tmp_path, aligner, monkeypatch, broadcast):
    monkeypatch.setattr(tokens.scored, "__defaults__", (broadcast,))
    rows = [(i % 90, text) for i, text in enumerate(TEXTS)] + [(None, "null id")]
    frame(rows).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    found = op12_tokens(spark, str(tmp_path))
    names = "n_a n_b n_groups n_links n_best count_sum groups_sha256".split()
    assert found.columns == ["doc_id", *names]
    wanted = [(i, *r) for (i, _), r in zip(rows, brute([t for _, t in rows], aligner), strict=True)]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(wanted, key=repr)
    assert any(r[3] != r[1] and r[1] != r[2] for r in wanted) and sum(r[1] == 0 for r in wanted) > 3


def test_slices_do_not_matter(aligner):
    texts = pa.array(TEXTS, pa.string())
    whole = tokens.align_texts(texts, aligner)
    parts = [tokens.align_texts(texts.slice(i, 4), aligner) for i in range(0, len(texts), 4)]
    for i, column in enumerate(whole):
        assert [v for part in parts for v in part[i].to_pylist()] == column.to_pylist()
    n_a, n_overlaps, n_links = (np.array(whole[tokens.COLUMNS.index(c)]) for c in ("n_a", "n_overlaps", "n_links"))
    assert (n_overlaps <= n_links).all() and (n_overlaps >= n_a).all()


def test_ranks_give_the_same_tokens(aligner):
    draw = random.Random(3)
    signs = [chr(c) for c in (*range(0x20, 0x7F), 10, *range(0xC0, 0x250))]
    texts = ["".join(draw.choices(signs[:95] if i % 2 else signs, k=draw.randint(1, 60))) for i in range(3000)]
    texts += ["".join(draw.choices("aeinorst' 10.\n", k=40)) for _ in range(3000)]
    for text in texts:
        assert aligner.a.ranked.encode_ordinary(" " + text) == aligner.a.encode([text])[0], text


def test_texts_that_cannot_be_cut(aligner):
    whole = tokens.Aligner(aligner.a, aligner.b)
    whole.cuts = False
    texts = pa.array(TEXTS, pa.string())
    monkey = tokens.ByteLevel.encode_all, tokens.Pieces.encode_all
    try:
        tokens.ByteLevel.encode_all = lambda self, texts, plain: tokens._flat(self.encode(texts))
        tokens.Pieces.encode_all = lambda self, texts, plain: tokens._flat(self.encode(texts))
        found = tokens.align_texts(texts, whole)
    finally:
        tokens.ByteLevel.encode_all, tokens.Pieces.encode_all = monkey
    assert [c.to_pylist() for c in found] == [c.to_pylist() for c in tokens.align_texts(texts, aligner)]


def test_odd_and_empty_tables(odd, empty, odd_rows):
    found = tokens.aligned(odd).collect()
    assert sorted((r.doc_id or -1, r.n_a > 0) for r in found) == sorted((i or -1, bool(t)) for i, t, *_ in odd_rows)
    assert len({r.row for r in found}) == len(odd_rows)
    assert tokens.aligned(empty).count() == 0 and tokens.scored(tokens.aligned(empty)).count() == 0
