import random

import numpy as np
from conftest_llm import prose

from sportlake.llm import language, toxicity


def test_language_held_out(frame):
    letters = {"aa": "aeioulmn", "bb": "zxkqwvgt", "cc": "éàçùsrtp"}
    draw = random.Random(3)

    def text(lang, n):
        return " ".join("".join(draw.choices(letters[lang], k=5)) for _ in range(n))

    rows = [(i, text(lang, 30), lang) for i in range(240) for lang in letters]
    network = language.fit(frame(rows), sample=200)
    tests = [(i, text(lang, n), lang) for i, (lang, n) in enumerate((x, n) for x in letters for n in (8, 60, 4000))]
    found = {r.doc_id: r for r in language.identified(frame(tests), network).collect()}
    assert all(found[i].lang_pred == lang and 0.5 < found[i].score <= 1 for i, _, lang in tests)


def test_tables_equal_filters():
    draw = np.random.default_rng(2)
    windows = draw.integers(0, 256, (5, language.WINDOW), dtype=np.uint8)
    network = language.train(windows, np.array([0, 1, 0, 1, 0]), ["a", "b"], epochs=1)
    tops = []
    for width, weights, offset in zip(language.WIDTHS, network.filters, network.offsets, strict=True):
        e = network.embed[windows]
        m = language.WINDOW - width + 1
        value = np.concatenate([e[:, j : j + m] for j in range(width)], axis=2) @ weights + offset
        tops.append(np.maximum(value.max(axis=1), 0))
    logits = np.concatenate(tops, 1) @ network.out + network.out_offset
    p = np.exp(logits) / np.exp(logits).sum(1, keepdims=True)
    assert np.allclose(network.probabilities(windows), p, atol=1e-4)


def test_language_odd_rows(odd, empty, frame):
    network = language.fit(odd)
    found = language.identified(odd, network).collect()
    assert len(found) == 11
    assert {r.doc_id: r.lang_pred for r in found if r.doc_id in (3, 4, 5)} == {3: "und", 4: "und", 5: "und"}
    assert language.fit(empty) is None
    assert language.identified(empty, None).collect() == []
    none = language.identified(frame([(1, "abc")]), None).collect()
    assert [(r.lang_pred, r.score) for r in none] == [("und", 0.0)]


def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, toxic int, text string")


def test_toxicity_held_out(spark, frame):
    rows = [(i, prose(i, 40) + (" you vile cretin" if i % 4 == 0 else "")) for i in range(400)]
    labels = [(i, int(i % 4 == 0), "clash") for i in range(300)]
    model = toxicity.fit(frame(rows), labelled(spark, labels))
    found = {r.doc_id: r.score for r in toxicity.scored(frame(rows), model).collect()}
    assert all((found[i] >= 0.5) == (i % 4 == 0) for i in range(300, 400))
    assert toxicity.clean(frame(rows), model).count() == 300


def test_toxicity_of_rare_words():
    draw = random.Random(5)

    def spelled(stem, number):
        return stem + "".join(chr(97 + int(d)) for d in str(number))

    def text(i):
        own = [spelled("w", draw.randrange(300)) for _ in range(40)]
        kind = i % 20
        own += [spelled("common", draw.randrange(3))] if kind == 0 else []
        # A second vocabulary: each of its words is in some six texts of those learned from.
        own += draw.sample([spelled("rare", j) for j in range(12)], 2) if kind == 1 else []
        return sorted(set(own)), int(kind < 2), kind

    rows = [text(i) for i in range(1200)]
    known, held = rows[:800], rows[800:]
    model = toxicity.selected([r[0] for r in known], [r[1] for r in known], [[] for _ in known])
    found = [model.score(" ".join(words)) >= 0.5 for words, _, _ in held]
    assert sum(f for f, (_, _, k) in zip(found, held, strict=True) if k == 1) >= 18  # of 20
    assert sum(f for f, (_, _, k) in zip(found, held, strict=True) if k > 1) <= 2


def test_swaps_keep_neutral_mentions_neutral():
    # A term that is in toxic texts only, always beside an insult.
    texts = [["cretin", "muslim", "vile"]] * 30 + [["calm", f"w{i % 9}"] for i in range(90)]
    labels = [1] * 30 + [0] * 90
    mentions = [["muslim"]] * 30 + [[]] * 90
    plain = toxicity.train(texts, labels, mentions, fairness=0.0)
    fair = toxicity.train(texts, labels, mentions, fairness=1.0)
    assert plain.weights["muslim"] > 1
    assert abs(fair.weights.get("muslim", 0.0)) < 0.1
    assert fair.score("A muslim cretin, vile.") > 0.5 > fair.score("The muslim reads.")
    assert abs(fair.score("the muslim reads") - fair.score("the christian reads")) < 0.02


def test_toxicity_odd_rows(spark, odd, empty):
    model = toxicity.fit(odd, labelled(spark, [(1, 1, ""), (3, 0, ""), (None, 1, ""), (4, None, "")]))
    found = toxicity.scored(odd, model).collect()
    assert len(found) == 11 and all(0 <= r.score <= 1 for r in found)
    nothing = toxicity.fit(empty, labelled(spark, []))
    assert nothing.weights == {} and toxicity.scored(empty, nothing).collect() == []
    assert toxicity.clean(odd, model).columns == odd.columns
