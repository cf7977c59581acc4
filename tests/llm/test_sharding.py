import zlib
from collections import Counter, defaultdict

from conftest_llm import prose

from sportlake.llm.sharding import assigned, sharded


def check(found, shards):
    slots = defaultdict(list)
    for r in found:
        slots[r.shard].append(r.slot)
    counts = [len(slots[s]) for s in range(shards)]
    assert max(counts) - min(counts) <= 1 and sum(counts) == len(found)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_linked_documents_meet(frame):
    rows = []
    for g in range(60):
        base = prose(g, 80)
        rows += [(g * 100 + i, " ".join(base.split()[i : 70 + i])) for i in range(5)]
    rows += [(90_000 + i, prose(3, 50)) for i in range(150)]
    found = sharded(frame(rows), 10).collect()
    check(found, 10)
    by_id = {r.doc_id: r.shard for r in found}
    apart = sum(len({by_id[g * 100 + i] for i in range(5)}) - 1 for g in range(60))
    assert apart <= 40  # some 216 if the rows lay at random
    # A third of all rows are copies of one text: they fill shards, not one each.
    most = Counter(by_id[90_000 + i] for i in range(150)).most_common(5)
    assert sum(n for _, n in most) >= 120
    again = sharded(frame(rows[::-1]).repartition(5), 10).collect()
    assert sorted((r.doc_id, r.shard, r.slot) for r in again) == sorted((r.doc_id, r.shard, r.slot) for r in found)


def test_rounds_lower_the_cut(frame):
    rows = []
    for g in range(100):
        words = prose(g, 120).split()
        rows += [(g * 100 + i, " ".join(words[5 * i : 60 + 5 * i])) for i in range(5)]
    rows += [(90_000 + 10 * g + i, prose(500 + g, 40)) for g in range(5) for i in range(10)]  # a fifth of a shard
    # Copies of a text and near ones of it: whole groups must enter.
    rows += [(95_000 + 10 * g + i, "zu " * i + prose(500 + g, 40)) for g in range(5) for i in range(1, 5)]

    def apart(found):
        check(found, 10)
        by_id = {r.doc_id: r.shard for r in found}
        near = sum(len({by_id[g * 100 + i] for i in range(5)}) - 1 for g in range(100))
        copies = [{by_id[90_000 + 10 * g + i] for i in range(10)} for g in range(5)]
        return near + sum(len(c | {by_id[95_000 + 10 * g + i] for i in range(1, 5)}) - 1 for g, c in enumerate(copies))

    before = apart(sharded(frame(rows), 10, rounds=0).collect())
    after = apart(sharded(frame(rows), 10).collect())
    assert after < before * 0.6, (before, after)


def test_odd_rows(odd, empty):
    found = sharded(odd, 4).collect()
    check(found, 4)
    sizes = {r.doc_id: (r.size, r.text_crc32) for r in found}
    assert sizes[3] == sizes[4] == (16, 0)
    assert sizes[8] == (17, zlib.crc32(b"x"))
    check(sharded(odd, 40).collect(), 40)
    assert sharded(empty).collect() == []
    rows = assigned(odd, 4).collect()
    assert len({(r.shard, r.slot) for r in rows}) == 11
    assert assigned(empty).collect() == []
