import random

import pytest

from sportlake.operators.containment import contained_names, first_contained


def _tables(spark, texts, names):
    return (
        spark.createDataFrame(list(enumerate(texts)), "text_id long, text string"),
        spark.createDataFrame(list(enumerate(names)), "name_id long, name string"),
    )


def _brute(texts, names):
    return {
        (t, n)
        for t, text in enumerate(texts)
        for n, name in enumerate(names)
        if name and name in text
    }


def test_edges(spark):
    long_word = "x" * 40 + "needle-of-more-than-sixteen-letters" + "y" * 40
    texts = ["xAb cdy", "a  b", " ", "", long_word, "Dr. Ana de Silva II", "ana", "de", "É è é"]
    names = [
        "b c", "Ab cd", "a  b", " ", "  ", "", "needle-of-more-than-sixteen-letters",
        "Ana de Silva", "Ana de Silvana", "de ", " de", "na", "è", "a", "Silva II",
    ]
    got = {tuple(r) for r in contained_names(*_tables(spark, texts, names)).collect()}
    assert got == _brute(texts, names)


@pytest.mark.parametrize("seed", range(3))
def test_random_texts(spark, seed):
    rng = random.Random(seed)
    texts = ["".join(rng.choice("ab c") for _ in range(rng.randint(0, 60))) for _ in range(80)]
    names = ["".join(rng.choice("ab c") for _ in range(rng.randint(0, 7))) for _ in range(60)]
    found = contained_names(*_tables(spark, texts, names)).collect()
    assert {tuple(r) for r in found} == _brute(texts, names)
    assert len(found) == len({tuple(r) for r in found})


def test_first_in_order(spark):
    got = first_contained(*_tables(spark, ["ab cd ef", "zz"], ["xx", "cd", "ab"])).collect()
    assert [tuple(r) for r in got] == [(0, 1)]


def test_no_names(spark):
    assert contained_names(*_tables(spark, ["a"], [""])).count() == 0


def test_whole_texts_against_brute_force(spark, sf_dir):
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("doc_id AS text_id", "text")
    names = spark.read.parquet(f"{sf_dir}/benchmark.parquet").selectExpr(
        "item_id AS name_id", "text AS name"
    )
    rows, patterns = texts.collect(), names.collect()
    expected = {(t.text_id, n.name_id) for t in rows for n in patterns if n.name in t.text}
    assert {tuple(r) for r in contained_names(texts, names).collect()} == expected
