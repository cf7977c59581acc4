"""Removal of byte strings of a given length that occur more than once, by sorting suffixes.

Every suffix of a corpus cannot be sorted within a small multiple of the input (each would
need a row), so a sparse set stands for all of them. Each window of ``length`` bytes is
represented by the suffix at its anchor, the leftmost smallest hash of ``GRAM`` bytes in it;
equal windows have their anchors at the same place, so nothing is lost. A suffix row stands
for the run of neighbouring windows with one anchor and carries its leading bytes, the
fingerprint of what all windows of the run have in common (``core``) and that of all bytes
of the run (``span``).

Sampled splitters range-partition the rows by leading bytes, core, span and place; each
bucket is sorted locally by multikey quicksort and neighbours are compared. Because the place
breaks ties, one passage in a third of all documents spreads over many buckets; comparing
the first and last rows of the buckets closes the gaps between them. A run without an equal
core has no repeated window, a run with an equal span has repeated windows only; what is left
is cut into runs of ``FINE`` windows and then into single windows, which decide exactly.

The same sort tells passages shorter than a window. The anchors of all strings of ``short``
bytes (winnowing) hold those of the windows, so they join the rows; where the gram at one
occurs elsewhere, its bytes are shared. Any string of ``short`` bytes that occurs again is
noticed, and no string shorter than a gram, which is half of ``short``, ever counts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sportlake.llm.tables import stored
from sportlake.llm.words import mix, powers, text_bytes

#: Windows in a run of the second level, and window starts of a text handled at once.
FINE, SEGMENT = 8, 1 << 20
#: Rows that a bucket of the sort should have; a bucket is sorted in one task's memory.
BUCKET_ROWS = 400_000

_ROWS = "row bigint, lead bigint, core bigint, span bigint, at bigint, lo bigint, hi bigint"


def multikey_order(words: list[np.ndarray]) -> np.ndarray:
    """Order of rows by their words, by multikey quicksort.

    A range is split by one word into less, equal and greater; only the equal part goes on
    to the next word. Short ranges are sorted directly.
    """
    n = len(words[0])
    order = np.arange(n)
    ranges = [(0, n, 0)]
    while ranges:
        low, high, depth = ranges.pop()
        if high - low < 2 or depth == len(words):
            continue
        part = order[low:high]
        if high - low <= 1 << 14:
            order[low:high] = part[np.lexsort([w[part] for w in reversed(words[depth:])])]
            continue
        values = words[depth][part]
        sample = values[:: len(values) // 1024]
        pivot = np.partition(sample, len(sample) // 2)[len(sample) // 2]
        less, more = values < pivot, values > pivot
        equal = ~(less | more)
        a, b = int(less.sum()), int(equal.sum())
        order[low:high] = np.concatenate([part[less], part[equal], part[more]])
        ranges += [(low, low + a, depth), (low + a, low + a + b, depth + 1), (low + a + b, high, depth)]
    return order


class _Text:
    """Fingerprints of any stretch of some bytes, from prefix sums."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        up, self.down = powers(n)
        values = data.astype(np.uint64) + np.uint64(1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values * up[:n], out=self.sums[1:])
        self.data = data

    def prints(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        raw = (self.sums[high] - self.sums[low]) * self.down[low]
        return mix(raw + (high - low).astype(np.uint64))

    def lead(self, at: np.ndarray) -> np.ndarray:
        """The first eight bytes from each place, as numbers in the order of bytes."""
        total = np.zeros(len(at), np.uint64)
        for i in range(8):
            total = (total << np.uint64(8)) | self.data[at + i].astype(np.uint64)
        return (total ^ np.uint64(1 << 63)).view(np.int64)


def leftmost_smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the leftmost smallest of each ``width`` neighbouring values."""
    n = len(values)
    place = np.uint64((1 << 24) - 1)
    packed = (values & ~place) | np.arange(n, dtype=np.uint64)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = packed
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = n - width + 1
    lowest = np.minimum(behind[:windows], ahead[width - 1 : width - 1 + windows])
    return (lowest & place).astype(np.int64)


def _runs(data: np.ndarray, length: int, short: int | None = None) -> Iterator[tuple[np.ndarray, ...]]:
    """Rows (lead, core, span, at, lo, hi) of one text: a row for each anchor.

    With ``short`` its anchors come too. Those that are anchors of no window have no span, and
    ``lo`` and ``hi`` below 0.
    """
    least = short or length
    gram = least // 2
    reach = least - gram
    for base in range(0, len(data) - gram + 1 if len(data) >= least else 0, SEGMENT):
        start = max(0, base - reach)
        own = base - start
        text = _Text(data[start : base + SEGMENT + length - 1])
        places = np.arange(len(text.data) - gram + 1)
        grams = text.prints(places, places + gram)
        low = high = at = np.zeros(0, np.int64)
        if len(text.data) - own >= length:
            anchors = leftmost_smallest(grams[own:], length - gram + 1) + own
            low = np.flatnonzero(np.r_[True, anchors[1:] != anchors[:-1]])
            high = np.r_[low[1:] - 1, len(anchors) - 1]
            at, low, high = anchors[low], low + own, high + own
        span = text.prints(low, high + length).view(np.int64)
        low, high = low + start, high + start
        if short:
            more = np.unique(leftmost_smallest(grams[: own + SEGMENT + reach], reach + 1))
            more = np.setdiff1d(more[(more >= own) & (more < own + SEGMENT)], at)
            none = -1 - (more + start)
            at, span = np.r_[at, more], np.r_[span, np.zeros(len(more), np.int64)]
            low, high = np.r_[low, none], np.r_[high, none]
        yield text.lead(at), grams[at].view(np.int64), span, at + start, low, high


def _shared(at: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Which rows stand for an anchor of the short strings; one that two segments list counts once."""
    return (low < 0) | (at // SEGMENT == low // SEGMENT)


def _batch(rows: list, found: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    counts = [len(x[0]) for x in found]
    columns = [np.concatenate([x[i] for x in found]) for i in range(6)] if found else [[]] * 6
    columns = [np.repeat(np.array(rows, np.int64), counts), *columns]
    names = ["row", "lead", "core", "span", "at", "lo", "hi"]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)


def _anchored(length: int, short: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, cuts = text_bytes(batch.column(1))
            rows, found, size = [], [], 0
            for row, low, high in zip(batch.column(0).to_pylist(), cuts[:-1], cuts[1:], strict=True):
                for part in _runs(data[low:high], length, short):
                    rows.append(row)
                    found.append(part)
                    size += len(part[0])
                if size > 200_000:
                    yield _batch(rows, found)
                    rows, found, size = [], [], 0
            yield _batch(rows, found)

    return run


def _finer(length: int, step: int):
    """Cuts the runs of each text into runs of at most ``step`` windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, cuts = text_bytes(batch.column(1))
            rows, found, size = [], [], 0
            for i, (row, runs) in enumerate(
                zip(batch.column(0).to_pylist(), batch.column(2), strict=True)
            ):
                bytes_ = data[cuts[i] : cuts[i + 1]]
                at, low, high = (runs.values.field(k).to_numpy() for k in ("at", "lo", "hi"))
                order = np.lexsort((at, low))
                for part in _finer_runs(bytes_, at[order], low[order], high[order], length, step):
                    rows.append(row)
                    found.append(part)
                    size += len(part[0])
                if size > 200_000:
                    yield _batch(rows, found)
                    rows, found, size = [], [], 0
            yield _batch(rows, found)

    return run


def _finer_runs(data, at, low, high, length: int, step: int) -> Iterator[tuple[np.ndarray, ...]]:
    # l is the distance of a window's start from its anchor; cells of l are fixed to the anchor.
    first, last = (at - high) // step, (at - low) // step
    counts = last - first + 1
    which = np.repeat(np.arange(len(at)), counts)
    cell = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts) + first[which]
    far = np.minimum((cell + 1) * step - 1, (at - low)[which])
    near = np.maximum(cell * step, (at - high)[which])
    anchor = at[which]
    core_low, core_high = anchor - cell * step, anchor - (cell + 1) * step + 1 + length
    segment = (anchor - far) // SEGMENT
    for s in np.unique(segment):
        mine = np.flatnonzero(segment == s)
        base = max(0, int(s) * SEGMENT - length)
        text = _Text(data[base : (int(s) + 1) * SEGMENT + 3 * length])
        start, end = anchor[mine] - far[mine], anchor[mine] - near[mine]
        salt = cell[mine].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        core = mix(text.prints(core_low[mine] - base, core_high[mine] - base) + salt)
        yield (
            text.lead(anchor[mine] - base),
            core.view(np.int64),
            text.prints(start - base, end + length - base).view(np.int64),
            anchor[mine],
            start,
            end,
        )


def _sorted_bucket(short: bool):
    """Sorts a bucket and keeps the rows whose core has a twin, and the first and last row.

    With ``short`` also those of the short strings' anchors, as rows of their own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        table = pa.Table.from_batches(batches)
        order = multikey_order([table.column(c).to_numpy() for c in ("lead", "core", "span")])
        at, low = (table.column(c).to_numpy()[order] for c in ("at", "lo"))
        found = [_kept(table, order[low >= 0])]
        if short:
            found.append(_kept_short(table, order[_shared(at, low)]))
        for kept, wanted in zip(found, (False, True), strict=False):
            kept = kept.append_column("short", pa.array(np.full(len(kept), wanted)))
            bucket = np.full(len(kept), TaskContext.get().partitionId(), np.int32)
            yield from kept.append_column("bucket", pa.array(bucket)).to_batches(max_chunksize=100_000)

    return run


def _kept(table: pa.Table, order: np.ndarray) -> pa.Table:
    n = len(order)
    lead, core, span = (table.column(c).to_numpy()[order] for c in ("lead", "core", "span"))
    same = (lead[1:] == lead[:-1]) & (core[1:] == core[:-1])
    twin = (np.r_[same, False] | np.r_[False, same])[:n]
    group = np.cumsum(np.r_[False, ~same])[:n]
    same &= span[1:] == span[:-1]
    whole = (np.r_[same, False] | np.r_[False, same])[:n]
    # A core with rows that go on to shorter runs, here or perhaps in the next bucket, also
    # sends one row of each repeated span, which those shorter runs can be equal to.
    mixed = np.zeros(n, bool)
    mixed[group[~whole]] = True
    mixed[group[[0, -1]] if n else []] = True
    onward = ~whole | (mixed[group] & ~np.r_[False, same][:n])
    edge = np.zeros(n, bool)
    edge[[0, -1] if n else []] = True
    keep = np.flatnonzero(twin | edge)
    kept = table.take(pa.array(order[keep]))
    for name, values in (
        ("twin", twin),
        ("whole", whole),
        ("onward", onward),
        ("edge", edge),
    ):
        kept = kept.append_column(name, pa.array(values[keep]))
    return kept


def _kept_short(table: pa.Table, order: np.ndarray) -> pa.Table:
    """Places of the anchors whose gram has a twin; only the first and last row keep lead and core."""
    n = len(order)
    lead, core = (table.column(c).to_numpy()[order] for c in ("lead", "core"))
    same = (lead[1:] == lead[:-1]) & (core[1:] == core[:-1])
    twin = (np.r_[same, False] | np.r_[False, same])[:n]
    edge = np.zeros(n, bool)
    edge[[0, -1] if n else []] = True
    keep = np.flatnonzero(twin | edge)
    row, at = (table.column(c).to_numpy()[order[keep]] for c in ("row", "at"))
    twin, edge, nothing = twin[keep], edge[keep], np.zeros(len(keep), np.int64)
    lead, core = np.where(edge, lead[keep], 0), np.where(edge, core[keep], 0)
    no = np.zeros(len(keep), bool)
    columns = [row, lead, core, nothing, at, nothing, nothing, twin, no, no, edge]
    names = [*table.column_names, "twin", "whole", "onward", "edge"]
    return pa.table([pa.array(c) for c in columns], names=names)


def _sorted(rows: DataFrame, purpose: str, short: bool = False) -> DataFrame:
    rows = stored(rows, purpose)
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(parts, rows.count() // BUCKET_ROWS)
    place = ["lead", "core", "span", "row", "lo"]
    return stored(
        rows.repartitionByRange(parts, *place).mapInArrow(
            _sorted_bucket(short),
            _ROWS + ", twin boolean, whole boolean, onward boolean, edge boolean, short boolean, bucket int",
        ),
        f"{purpose}-sorted",
    )


def _meets(edges: DataFrame, *key: str) -> DataFrame:
    """Keys that lie at the ends of several buckets."""
    return edges.groupBy(*key).agg(F.countDistinct("bucket").alias("n")).where("n > 1").select(*key)


def _twins(found: DataFrame) -> DataFrame:
    """Rows ``row, at, lo, hi, whole, onward`` whose core occurs again.

    ``whole``: their span does too. ``onward``: they are to be compared as shorter runs.
    """
    found = found.where("not short")
    edges = found.where("edge")
    core = _meets(edges, "lead", "core").withColumn("core_meets", F.lit(True))
    span = _meets(edges, "lead", "core", "span").withColumn("span_meets", F.lit(True))
    at_edge = edges.join(core, ["lead", "core"], "left").join(span, ["lead", "core", "span"], "left")
    at_edge = at_edge.where("twin or core_meets").select(
        "row",
        "at",
        "lo",
        "hi",
        F.expr("whole or coalesce(span_meets, false)").alias("whole"),
        F.lit(True).alias("onward"),
    )
    inner = found.where("not edge and twin").select("row", "at", "lo", "hi", "whole", "onward")
    return inner.unionByName(at_edge)


def _shared_bytes(found: DataFrame, gram: int) -> DataFrame:
    """For each ``row`` the bytes ``n_shared`` that grams cover whose anchors have twins."""
    found = found.where("short")
    edges = found.where("edge")
    core = _meets(edges, "lead", "core").withColumn("core_meets", F.lit(True))
    at_edge = edges.join(core, ["lead", "core"], "left").where("twin or core_meets")
    places = found.where("not edge and twin").select("row", "at").unionByName(at_edge.select("row", "at"))
    covered = F.aggregate(
        F.array_sort("places"),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-gram).cast("long").alias("last")),
        lambda s, at: F.struct(
            (s["n"] + F.least(F.lit(gram).cast("long"), at - s["last"])).alias("n"), at.alias("last")
        ),
        lambda s: s["n"],
    )
    return places.groupBy("row").agg(F.collect_list("at").alias("places")).select("row", covered.alias("n_shared"))


def _cut(length: int):
    """Removes the bytes of repeated windows: counts, runs, and digest of what is left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, cuts = text_bytes(batch.column(1))
            removed, runs, spans, digests = [], [], [], []
            for i, windows in enumerate(batch.column(2)):
                own = data[cuts[i] : cuts[i + 1]]
                low, high = (windows.values.field(k).to_numpy() for k in ("lo", "hi"))
                change = np.zeros(len(own) + 1, np.int64)
                np.add.at(change, low, 1)
                np.add.at(change, high + length, -1)
                gone = np.cumsum(change[:-1]) > 0
                turns = np.flatnonzero(np.diff(np.r_[False, gone, False].astype(np.int8)))
                removed.append(int(gone.sum()))
                runs.append(len(turns) // 2)
                spans.append([{"low": int(a), "high": int(b)} for a, b in turns.reshape(-1, 2)])
                digests.append(hashlib.sha256(own[~gone].tobytes()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(removed, pa.int64()),
                    pa.array(runs, pa.int64()),
                    pa.array(spans, pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())]))),
                    pa.array(digests, pa.string()),
                ],
                names=["row", "n_removed", "n_spans", "spans", "kept_sha256"],
            )

    return run


def _key() -> Column:
    return F.xxhash64("doc_id", "text").alias("row")


def repeated_spans(docs: DataFrame, length: int = 400, short: int | None = None) -> DataFrame:
    """Bytes of each row of ``docs`` (doc_id, text, more columns) that repeated strings cover.

    Each byte covered by a string of ``length`` bytes that also starts anywhere else, in the
    same text too, is removed, in every place where the string occurs. Returns ``doc_id,
    n_bytes, n_removed, n_spans, spans, kept_sha256, n_shared``, a row for each row of ``docs``;
    ``spans`` lists the maximal removed runs as byte offsets ``low`` to below ``high``.

    ``n_shared`` tells shorter passages, of which nothing is removed: the bytes of the text covered by
    winnowed strings of ``short`` // 2 bytes that start anywhere else too. A text holding a string of
    ``short`` bytes that does has at least ``short`` // 2 of them. ``short`` is 5/8 of ``length`` unless given
    (250 bytes for 400, some 50 words of four letters), at least 16 and at most ``length``.

    A null text counts as empty; texts shorter than ``length`` lose nothing. Rows repeated
    with equal id and text repeat each other and lose all of a text of ``length`` bytes or
    more. Null ids are allowed. ``length`` must be at least 16.
    """
    short = short or max(16, length * 5 // 8)
    texts = docs.select(_key(), "text")
    anchors = _sorted(texts.mapInArrow(_anchored(length, short), _ROWS), "suffixes", short=True)
    shared = _shared_bytes(anchors, short // 2)
    first = stored(_twins(anchors), "runs")
    opened = first.groupBy("row").agg(
        F.collect_set(F.when(F.col("onward"), F.struct("at", "lo", "hi"))).alias("runs")
    )
    texts = stored(texts.join(opened, "row"), "texts")
    fine = _sorted(texts.where("size(runs) > 0").mapInArrow(_finer(length, FINE), _ROWS), "fine")
    fine = stored(_twins(fine), "fine-runs")
    again = fine.where("onward").groupBy("row").agg(F.collect_set(F.struct("at", "lo", "hi")).alias("runs"))
    windows = _sorted(
        texts.select("row", "text").join(again, "row").mapInArrow(_finer(length, 1), _ROWS), "windows"
    )
    windows = _twins(windows)
    done = (
        first.where("whole")
        .select("row", "lo", "hi")
        .unionByName(fine.where("whole").select("row", "lo", "hi"))
        .unionByName(windows.select("row", "lo", "hi"))
        .groupBy("row")
        .agg(F.collect_set(F.struct("lo", "hi")).alias("windows"))
    )
    cut = (
        texts.select("row", "text")
        .join(done, "row")
        .mapInArrow(
            _cut(length),
            "row bigint, n_removed bigint, n_spans bigint,"
            " spans array<struct<low: bigint, high: bigint>>, kept_sha256 string",
        )
        .dropDuplicates(["row"])
    )
    text = F.coalesce("text", F.lit(""))
    whole = docs.select(
        _key(), "doc_id", F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("sha")
    )
    return whole.join(cut, "row", "left").join(shared, "row", "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0).cast("long")).alias("n_spans"),
        "spans",
        F.coalesce("kept_sha256", "sha").alias("kept_sha256"),
        F.coalesce("n_shared", F.lit(0).cast("long")).alias("n_shared"),
    )
