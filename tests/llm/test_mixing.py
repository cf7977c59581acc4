import re

import pytest
from conftest_llm import prose
from pyspark.sql import functions as F

from sportlake.llm import mixing


def goals(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    full, total = set(), sum(sizes.values())
    while True:
        rest = sum(w for s, w in weight.items() if s not in full)
        rate = (total - sum(3 * sizes[s] for s in full)) / rest if rest else 0
        new = {s for s in names if s not in full and weight[s] * rate > 3 * sizes[s]}
        if not new:
            return {s: 3.0 * sizes[s] if s in full else weight[s] * rate for s in names}
        full |= new


def documents():
    draw = [(i, prose(i, 3 + 17 * i % 90), "en", ("b", "a", "ü", None, "c", "a")[i % 6]) for i in range(200)]
    return draw + [(900, prose(900, 30), "en", "d"), (901, None, "en", "e"), (902, prose(9, 6000), "en", "c")]


def test_targets_and_taken(frame):
    rows = documents()
    sizes = {}
    for _, text, _, source in rows:
        sizes[source] = sizes.get(source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    want = goals(sizes)
    found = mixing.mixed(frame(rows), block=16).collect()
    assert len(found) == len(rows)
    taken = {}
    for r in found:
        assert r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source]
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert all(abs(taken[s] - want[s]) <= 0.5 for s in want)
    again = mixing.mixed(frame(rows[::-1]).repartition(7), block=16).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, found))


def test_stretches_of_the_schedule_keep_the_shares(spark):
    table = spark.createDataFrame([(1, 10_000, 5000.0), (2, 900, 2000.0), (3, 4000, 1000.0)], "sid long, source_size long, target double")
    rows = mixing.schedule(table, 8).orderBy("position").collect()
    own = [r.sid for r in rows]
    for low in range(0, len(own) - 100, 50):
        assert abs(own[low : low + 100].count(1) / 100 - 5 / 8) < 0.07
    assert sum(r.last - r.first for r in rows) == 8000
    assert max(r.last for r in rows if r.sid == 2) == 900


def test_odd_rows(odd, empty):
    found = mixing.mixed(odd, block=4).collect()
    assert len(found) == 11 and {r.doc_id: r.size for r in found if r.doc_id in (3, 4, 5)} == {3: 0, 4: 0, 5: 0}
    assert mixing.mixed(empty).collect() == []
    taken = mixing.applied(odd, block=4)
    assert taken.columns == odd.columns
    assert taken.groupBy("doc_id", "text").count().agg(F.max("count")).first()[0] <= 6
    assert mixing.applied(empty).collect() == []
