from conftest_llm import prose

from sportlake.llm.lines import near_lines, without_near_lines


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def expected(rows, least=20):
    """Rows must have different ids."""
    first = {}
    for doc, text in sorted(rows):
        for k, line in enumerate((text or "").split("\n")):
            first.setdefault(line, (doc, k))
    near = {
        b
        for b in first
        if len(b) >= least
        and any(first[a] < first[b] and len(a) >= least and one_edit(a, b) for a in first if a != b)
    }
    result = {}
    for doc, text in rows:
        lines = [] if text is None else text.split("\n")
        gone = [k for k, x in enumerate(lines) if x and (first[x] != (doc, k) or x in near)]
        result[doc] = (len(lines), gone)
    return result


def got(frame):
    return {r.doc_id: (r.n_lines, r.removed) for r in frame.collect()}


def test_equals_all_pairs(frame):
    lines = [prose(i, 4 + 9 * (i % 5)) for i in range(12)] + ["a" * 30, "page one of this report 7"]
    rows, number = [], 0
    for line in lines:
        variants = [line]
        for at in (0, 1, len(line) // 2, len(line) // 2 + 1, len(line) - 1):
            variants += [line[:at] + "Q" + line[at + 1 :], line[:at] + line[at + 1 :], line[:at] + "Q" + line[at:]]
        variants += [line + "!", "é" + line, line[:-2], "QQ" + line[2:]]
        for v in variants:
            number += 7
            rows.append((number % 1009, f"{prose(number, 6)}\n{v}\n\n{v}"))
    rows += [(2000, None), (2001, ""), (2002, "short\nshort\nshirt\n\n"), (2003, "x" * 19 + "\n" + "x" * 20)]
    assert got(near_lines(frame(rows))) == expected(rows)


def test_three_edits_equal_all_pairs(frame, monkeypatch):
    rows = []
    for i in range(10):
        line = prose(i, 4 + 7 * (i % 3))
        n = len(line)
        variants = [line, "QQQ" + line, line[3:], line[:-3] + "é", line[:9] + "WXY" + line[12:], "Q" + line[1 : n // 2] + line[n // 2 + 1 :] + "Z"]
        variants += ["VVVV" + line, line[:2] + "J" + line[3:8] + "K" + line[8:14] + line[15:], line[:5] + "ABCD" + line[9:]]
        for k, v in enumerate(variants):
            rows.append(((len(rows) * 7) % 1009, f"{prose(900 + len(rows), 6)}\n{v}"))
    by = lambda a, b: abs(len(a) - len(b)) <= 3 and distance(a, b) <= 3
    found = got(near_lines(frame(rows), edits=3))
    monkeypatch.setitem(globals(), "one_edit", by)
    assert found == expected(rows)


def test_long_lines(frame):
    line = prose(77, 5000)
    half = len(line) // 2
    rows = [(1, line), (2, line[:half] + "#" + line[half:]), (3, line[:-1]), (4, "#" + line[:half] + line[half + 1 :])]
    assert got(near_lines(frame(rows))) == expected(rows)


def test_odd_rows(odd, empty):
    found = near_lines(odd).collect()
    assert len(found) == 11
    by_id = {r.doc_id: r for r in found}
    assert by_id[3].n_lines == 0 and by_id[4].n_lines == 1 and by_id[2].removed == [0]
    assert near_lines(empty).collect() == []
    rest = without_near_lines(odd)
    assert rest.columns == odd.columns and rest.count() == 11
    texts = {r.doc_id: r.text for r in rest.collect()}
    assert texts[2] == "" and texts[3] is None and texts[8] == "x"
