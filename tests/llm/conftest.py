import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from conftest_llm import prose  # noqa: E402

SCHEMA = (
    "doc_id long, text string, lang string, source string,"
    " row string, size string, shard string, removed string, class string, words string"
)


@pytest.fixture(scope="session")
def frame(spark):
    """DataFrame of documents from (doc_id, text[, lang[, source]]), with clashing columns."""

    def build(rows):
        rows = [(*r, *[None] * (4 - len(r)), *["x"] * 6) for r in rows]
        return spark.createDataFrame(rows, SCHEMA)

    return build


BASE = prose(1, 200)
ODD = [
    (1, BASE, "en", "b"),
    (2, BASE, "en", "b"),
    (3, None, None, None),
    (4, "", "en", "a"),
    (None, prose(2, 60), "en", "a"),
    (5, " \n\t ", None, None),
    (6, BASE.replace(" ", "  ", 3) + " zu", "en", None),
    (6, BASE.replace(" ", "  ", 3) + " zu", "en", None),
    (7, prose(3, 40_000), "de", "c"),
    (8, "x", "de", "c"),
    (9, "ünïcode 東京 😀 " * 12, "fr", "a"),
]


@pytest.fixture(scope="session")
def odd(frame):
    return frame(ODD)


@pytest.fixture(scope="session")
def odd_rows():
    return list(ODD)


@pytest.fixture(scope="session")
def empty(frame):
    return frame([])
