"""Benchmark passages in texts: pigeonhole pieces, then Myers' bit-parallel edit distance.

An item of n characters may differ from a passage by ``budget = n * percent // 100`` edits.
Cut into budget + 1 pieces, at least one piece must then occur unchanged. All pieces of a
block of items are searched in one pass over a text; around each hit, the item is compared
with the text by Myers' bit-parallel algorithm, which gives the distance of the best
substring. Pieces of one item whose hits lie on nearby diagonals share one comparison.

The benchmark is taken in blocks of at most ``BLOCK_CHARS`` characters, each of which is the
only thing sent to all tasks; more items mean more passes over the texts, not larger blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sportlake.llm.tables import stored

#: Characters of benchmark items that one pass over the texts searches.
BLOCK_CHARS = 4_000_000
#: Shorter items, in characters after normalisation, are found without edits and as whole words only.
LEAST_CHARS = 32

_FOUND = "doc_id bigint, item_id bigint, distance int, first bigint, last bigint, short boolean"


def normal(text: str) -> str:
    """Lower case, white space of any length as one blank."""
    return " ".join(text.lower().split())


def pieces(text: str, budget: int) -> list[tuple[int, str]]:
    """The text cut into budget + 1 pieces of nearly equal length, each with its place."""
    cuts = [len(text) * i // (budget + 1) for i in range(budget + 2)]
    return [(a, text[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def myers(pattern: str, text: str) -> tuple[int, int]:
    """Least edit distance of the pattern to a substring of the text, and its end there."""
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    n = len(pattern)
    every, top = (1 << n) - 1, 1 << (n - 1)
    plus, minus, score = every, 0, n
    best, end = n, 0
    for j, c in enumerate(text):
        equal = masks.get(c, 0)
        down = equal | minus
        across = (((equal & plus) + plus) ^ plus) | equal
        rise = minus | (every & ~(across | plus))
        fall = plus & across
        if rise & top:
            score += 1
        elif fall & top:
            score -= 1
            if score < best:
                best, end = score, j + 1
        rise = rise << 1 & every
        fall = fall << 1 & every
        plus = fall | (every & ~(down | rise))
        minus = rise & down
    return best, end


class _Matcher:
    """Searches the items of one block in texts."""

    def __init__(self, items: list[tuple[int, str]], percent: int):
        self.items, self.machine = [], ahocorasick.Automaton()
        places: dict[str, list[tuple[int, int]]] = {}
        for number, (item_id, text) in enumerate(items):
            budget = len(text) * percent // 100 if len(text) >= LEAST_CHARS else 0
            self.items.append((item_id, text, budget))
            for at, piece in pieces(text, budget):
                places.setdefault(piece, []).append((number, at))
        for piece, found in places.items():
            self.machine.add_word(piece, (len(piece), found))
        self.machine.make_automaton()

    def search(self, text: str) -> list[tuple[int, int, int, int, bool]]:
        """Items in a normalised text: item, distance, first and last character, whether it is short."""
        starts: dict[int, list[int]] = {}
        for end, (size, found) in self.machine.iter(text):
            for number, at in found:
                starts.setdefault(number, []).append(end + 1 - size - at)
        result = []
        for number, near in starts.items():
            item_id, item, budget = self.items[number]
            if len(item) < LEAST_CHARS:
                whole = [at for at in near if _whole_words(text, at, at + len(item))]
                if whole:
                    result.append((item_id, 0, min(whole), min(whole) + len(item), True))
                continue
            best = None
            low = high = None
            for start in [*sorted(near), None]:
                if low is not None and (start is None or start > high + 2 * budget + 1):
                    left = max(0, low - budget)
                    distance, end = myers(item, text[left : high + len(item) + budget])
                    if distance <= budget and (best is None or distance < best[0]):
                        last = left + end
                        best = (distance, max(left, last - len(item)), last)
                    low = None
                if start is not None:
                    low, high = start if low is None else low, start
            if best:
                result.append((item_id, *best, False))
        return result


def _whole_words(text: str, first: int, last: int) -> bool:
    """Whether neither end of a stretch parts a word or number."""
    return not (
        first > 0 and text[first - 1].isalnum() and text[first].isalnum()
        or last < len(text) and text[last - 1].isalnum() and text[last].isalnum()
    )


def _searched(items: list[tuple[int, str]], percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = _Matcher(items, percent)
        for batch in batches:
            rows = [
                (doc, *found)
                for doc, text in zip(*(c.to_pylist() for c in batch.columns), strict=True)
                if text
                for found in matcher.search(normal(text))
            ]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.bool_()]
            names = ["doc_id", "item_id", "distance", "first", "last", "short"]
            arrays = [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return run


def contaminated(docs: DataFrame, items: DataFrame, percent: int = 10) -> DataFrame:
    """Benchmark items that occur in texts: ``doc_id, item_id, distance, first, last, short``.

    ``docs`` has doc_id and text, ``items`` item_id and text; more columns are ignored. Both
    texts are compared in lower case with white space as one blank. A text is contaminated
    if a substring of it is within ``percent`` edits per hundred characters of an item;
    ``distance`` is that of its best substring, ``first`` and ``last`` bound it approximately
    in the normalised text. Items under ``LEAST_CHARS`` characters, marked ``short``, are found only without
    edits and where no word is parted at either end. One row for each row of ``docs`` and each item found.

    Null and empty texts hold nothing; null and blank items are not searched; an empty benchmark finds nothing. Rows repeated in ``docs``
    give repeated rows; an item repeated under one id counts as one for each distinct text.
    """
    spark = docs.sparkSession
    size = F.length("text")
    items = items.select(F.col("item_id").cast("long"), "text").where(size > 0).distinct()
    # Running sum in cells of equal hash, so that no task sorts the whole benchmark.
    items = stored(items.withColumn("cell", F.pmod(F.xxhash64("item_id", "text"), F.lit(64))), "items")
    order = W.partitionBy("cell").orderBy("item_id", "text")
    items = items.withColumn("block", F.floor(F.sum(size).over(order) / F.lit(BLOCK_CHARS // 64)))
    items = stored(items, "blocks")
    blocks = items.groupBy("block").count().orderBy("block").toPandas()["block"].tolist()
    narrow = docs.select(F.col("doc_id").cast("long"), "text").where("text is not null")
    parts = []
    for block in blocks:
        rows = items.where(F.col("block") == block).select("item_id", "text").collect()
        texts = sorted({(r["item_id"], normal(r["text"])) for r in rows}, key=repr)
        texts = [x for x in texts if x[0] is not None and x[1]]
        parts.append(narrow.mapInArrow(_searched(texts, percent), _FOUND))
    if not parts:
        return spark.createDataFrame([], _FOUND)
    return reduce(DataFrame.unionByName, parts)
