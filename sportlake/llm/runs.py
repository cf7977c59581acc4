"""Periodic runs of words: stretches that repeat one period over and over.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q`` apart are
identical) of ``max(least, times * q)`` words or more, which no neighbouring word extends
keeping that period.

The words of a text are read once, in order. A diagonal is a lag at which the words of late
have matched; the sparse set of active diagonals holds where the stretch of each began. A word
is held against those its active lags point to: matches make the diagonal one longer, the
others end, and one that ends long enough gives its run at once. A word's earlier occurrences
open new diagonals. Two rules keep that sparse without losing a run:

* A run matches itself over at least ``width`` words, the least of
  ``max(least, times * q) - q``. So only occurrences whose last ``width`` words agree open a diagonal,
  and only where the word before them differs: else it is open, or was left out by the next rule.
* A diagonal whose stretch would begin where that of an active one begins, with a lag that the
  other's divides, is the same stretch and has the smaller period. So a text that is all one word keeps
  one diagonal, and no run needs a later test of its period.

Each text is worked out within its own task, without a shuffle.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Least words of a run, and least periods in it.
LEAST, TIMES = 6, 4
#: Bytes of texts that are taken together; a longer text is taken alone.
SLICE = 1 << 22
#: A word, as Java's and Python's patterns write it.
BETWEEN = r"[\x20\x09-\x0D]+"

RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def match_width(least: int, times: int) -> int:
    """Words over which any run matches itself at its period, at least."""
    return min(max(least, times * q) - q for q in range(1, least + 1))


def window_ids(codes: np.ndarray, width: int) -> np.ndarray:
    """Equal numbers for equal windows of ``width`` codes; exact, by pairs of shorter windows."""
    ids, have = codes.astype(np.int64), 1
    while have < width:
        step = min(have, width - have)
        pairs = ids[:-step] * (int(ids.max(initial=0)) + 1) + ids[step:]
        ids, have = pd.factorize(pairs)[0].astype(np.int64), have + step
    return ids


def word_runs(
    codes: list[int], windows: list[int], repeated: list[int], least: int, times: int
) -> list[tuple[int, int, int]]:
    """Runs ``(start, length, period)`` of one text, by start and then period.

    ``codes`` are its words as numbers, ``windows`` its windows as numbers, and ``repeated``
    the places, ascending, of the windows that occur more than once.
    """
    n, width = len(codes), len(codes) - len(windows) + 1
    active: dict[int, int] = {}
    lags_from: dict[int, list[int]] = {}
    earlier: dict[int, dict[int, list[int]]] = {}
    found: list[tuple[int, int, int]] = []

    def end(lag: int, at: int) -> None:
        start = active.pop(lag)
        lags_from[start].remove(lag)
        if at - start >= max(least, times * lag):
            found.append((start, at - start, lag))

    upcoming, last = 0, len(windows) - 1
    at = -1
    while True:
        if active:
            at += 1
        elif upcoming < len(repeated):
            at = repeated[upcoming]
        else:
            break
        if at > last:
            break
        word = at + width - 1
        if active:
            mine = codes[word]
            for lag in [lag for lag in active if codes[word - lag] != mine]:
                end(lag, word)
        if upcoming == len(repeated) or repeated[upcoming] != at:
            continue
        upcoming += 1
        before = windows[at - 1] if at else -1
        groups = earlier.setdefault(windows[at], {})
        # A run from ``place`` at lag ``at - place`` must end within the text.
        lowest = -((n - times * at) // (times - 1))
        for other, places in groups.items():
            if other == before:
                continue
            for place in places[bisect_left(places, lowest) :]:
                lag, same = at - place, lags_from.setdefault(place, [])
                if place + least <= n and not any(lag % p == 0 for p in same):
                    same.append(lag)
                    active[lag] = place
        groups.setdefault(before, []).append(at)
    for lag in list(active):
        end(lag, n)
    return sorted(found, key=lambda run: (run[0], run[2]))


def _runs_of(texts: list[list[bytes]], least: int, times: int) -> list[list[tuple[int, int, int]]]:
    """The runs of each of some texts, given as words."""
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    width = match_width(least, times)
    sizes = np.array([len(words) for words in texts])
    words = np.empty(int(sizes.sum()), object)
    words[:] = [word for own in texts for word in own]
    if len(words) < width:
        return found
    codes = pd.factorize(words)[0]
    windows = window_ids(codes, width)
    begins = np.concatenate([[0], np.cumsum(sizes)])
    text = np.repeat(np.arange(len(texts)), sizes)[: len(windows)]
    inside = text == np.repeat(np.arange(len(texts)), sizes)[width - 1 :]
    own = pd.factorize(text * (int(windows.max()) + 1) + windows)[0]
    often = (np.bincount(own[inside], minlength=int(own.max()) + 1) > 1)[own] & inside
    for i in np.unique(text[often]):
        low, high = int(begins[i]), int(begins[i + 1])
        mine = slice(low, high - width + 1)
        repeated = np.flatnonzero(often[mine]).tolist()
        found[i] = word_runs(codes[low:high].tolist(), windows[mine].tolist(), repeated, least, times)
    return found


def _kept(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run contains after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)]


def _slices(column: pa.Array) -> Iterator[list[bytes]]:
    """Texts as bytes, null as empty, together up to ``SLICE`` bytes or one by one."""
    gathered: list[bytes] = []
    size = 0
    for text in column.cast(pa.binary()):
        own = text.as_py() or b""
        if gathered and size + len(own) > SLICE:
            yield gathered
            gathered, size = [], 0
        gathered.append(own)
        size += len(own)
    if gathered:
        yield gathered


def periodic_runs(docs: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` for each row of ``docs`` (doc_id, text, more columns).

    ``runs`` lists ``start`` (number of a word, from 0), ``length`` and ``period`` by start,
    then period; ``collapsed`` joins the words that stay by one space: those that no run
    contains after its first period. Words are runs of bytes other than space and 0x09 to 0x0D.

    Null, empty and blank texts have no words, no runs and an empty ``collapsed``. Rows are
    worked out one by one, so null and repeated ids and repeated rows each give a row; an
    empty table gives none. Runs that overlap are all listed. A text of any length is
    worked out whole, in memory that grows with it. ``times`` is 2 or more.
    """
    if times < 2 or least < times:
        raise ValueError("times must be 2 or more, and least not below it")

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for part in _slices(batch.column(1)):
                texts = [text.split() for text in part]  # bytes part at space and 0x09 to 0x0D
                runs = _runs_of(texts, least, times)
                kept = [b" ".join(_kept(words, own)) for words, own in zip(texts, runs, strict=True)]
                dicts = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in own] for own in runs]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(part)),
                        pa.array([len(words) for words in texts], pa.int64()),
                        pa.array(dicts, pa.list_(_RUN)),
                        pa.array(kept, pa.binary()).cast(pa.string()),
                    ],
                    names=["doc_id", "n_words", "runs", "collapsed"],
                )
                at += len(part)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        found, f"doc_id {kind}, n_words bigint, runs {RUNS}, collapsed string"
    )


def strongest(runs: str) -> Column:
    """The run of most periods, by exact quotients; ties by start, then period; null for none."""
    order = (
        "case when a.length * b.period > b.length * a.period then -1"
        " when a.length * b.period < b.length * a.period then 1"
        " when a.start <> b.start then if(a.start < b.start, -1, 1)"
        " else if(a.period < b.period, -1, if(a.period > b.period, 1, 0)) end"
    )
    return F.expr(f"get(array_sort({runs}, (a, b) -> {order}), 0)")


def listed(runs: str) -> Column:
    """Runs as lines ``start,length,period``."""
    return F.expr(
        f"array_join(transform({runs}, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')"
    )


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` where the texts of a tenth of all ids repeat a block of words to their end.

    With ``h`` the crc32 of the id as text and ``g = h div 10``, texts of ``n`` > 0 words with
    ``h % 10 = 0`` go on from word ``a = g % n`` with the period ``1 + (n - a) div (3 + g % 8)``,
    joined by one space. Other texts, and those without id, stay as they are.
    """
    chosen = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string")).alias("h"))
    words = F.expr(f"filter(split(text, r'{BETWEEN}'), w -> w != '')")
    chosen = chosen.withColumn("words", F.when(F.col("h") % 10 == 0, words))
    chosen = chosen.withColumn("n", F.when(F.size("words") > 0, F.size("words")))
    chosen = chosen.withColumn("a", F.expr("cast(h div 10 % n as int)"))
    chosen = chosen.withColumn("p", F.expr("cast(1 + (n - a) div (3 + h div 10 % 8) as int)"))
    block = "array_repeat(slice(words, a + 1, p), cast(1 + (n - a) div p as int))"
    edited = f"array_join(concat(slice(words, 1, a), slice(flatten({block}), 1, n - a)), ' ')"
    return chosen.select("doc_id", F.when(F.col("n").isNotNull(), F.expr(edited)).otherwise(F.col("text")).alias("text"))
