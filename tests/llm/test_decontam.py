import random

from conftest_llm import prose

from sportlake.llm import decontam


def least(pattern, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(pattern, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def test_myers_equals_dynamic_programming():
    draw = random.Random(4)
    for _ in range(300):
        pattern = "".join(draw.choices("abc", k=draw.randint(1, 80)))
        text = "".join(draw.choices("abc", k=draw.randint(0, 120)))
        assert decontam.myers(pattern, text)[0] == least(pattern, text)


def edits(text, n, seed):
    draw = random.Random(seed)
    for _ in range(n):
        at = draw.randrange(len(text))
        text = draw.choice([text[:at] + "#" + text[at + 1 :], text[:at] + text[at + 1 :], text[:at] + "#" + text[at:]])
    return text


def test_equals_all_comparisons(spark, frame, monkeypatch):
    monkeypatch.setattr(decontam, "BLOCK_CHARS", 640)  # several passes
    items = [(i, prose(i, 20 + i)) for i in range(9)] + [(50, "too short"), (51, None)]
    rows = []
    for i, text in items[:9]:
        for n in (0, 2, len(text) // 20, len(text) // 10, len(text) // 6):
            rows.append((len(rows), prose(100 + len(rows), 30) + " " + edits(text, n, len(rows)).upper() + "\n x"))
    table = spark.createDataFrame([(i, t, "clash") for i, t in items], "item_id long, text string, doc_id string")
    found = {(r.doc_id, r.item_id): r.distance for r in decontam.contaminated(frame(rows), table, 8).collect()}
    want = {}
    for doc, text in rows:
        for item, own in items[:9]:
            distance = least(decontam.normal(own), decontam.normal(text))
            if distance <= len(decontam.normal(own)) * 8 // 100:
                want[doc, item] = distance
    assert found == want and len(want) > 20


def test_odd_rows(spark, odd, empty):
    schema = "item_id long, text string"
    base = odd.where("doc_id = 1").first().text
    items = spark.createDataFrame([(1, base[40:200]), (1, base[40:200]), (2, ""), (None, base)], schema)
    found = decontam.contaminated(odd, items).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == [(1, 1), (2, 1), (6, 1), (6, 1)]
    assert decontam.contaminated(empty, items).collect() == []
    assert decontam.contaminated(odd, spark.createDataFrame([], schema)).collect() == []


def test_short_items_as_whole_words(spark, frame):
    items = [(1, "What is the capital of  Peru?"), (2, "42"), (3, " \t"), (4, "?"), (5, "peru")]
    table = spark.createDataFrame(items, "item_id long, text string")
    rows = [(1, "so what is the capital of peru? Lima"), (2, "What is the capitol of Peru?"), (3, "it's 42."),
            (4, "a 142 and 421"), (5, "peruvian"), (6, None), (7, "Peru")]
    found = decontam.contaminated(frame(rows), table, 10).collect()
    pairs = {(r.doc_id, r.item_id) for r in found}
    assert pairs == {(1, 1), (1, 4), (1, 5), (2, 4), (2, 5), (3, 2), (7, 5)}
    assert all(r.short and r.distance == 0 for r in found)
    assert {(r.first, r.last) for r in found if (r.doc_id, r.item_id) == (1, 1)} == {(3, 31)}
