"""Near duplicates by circulant MinHash, banding, and exact Jaccard on full shingle sets.

Two permutations make all coordinates. The first scatters a shingle over D positions (its
hash, scrambled); the second is a fixed permutation of the D positions that coordinate k
reads shifted circularly by k. The K values a shingle contributes are therefore one run of K
neighbouring entries of a table, and a signature is the minimum over such runs.

With 32 bands of 4 coordinates a pair of similarity 0.8 shares no band with a probability of
5e-8. Texts of equal sets form one class. Within a bucket every class is compared with one
leader, not with all others. Buckets whose classes then still belong to several components
are finished exactly: the classes outside the main one meet all others in blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sportlake.llm.tables import components, stored
from sportlake.llm.words import mix, shingle_sets

#: Positions of the circulant permutation, bands, and coordinates in each band.
POSITIONS, BANDS, ROWS = 1 << 20, 32, 4
_BLOCK = 2048
#: Sets of a side that are compared in one task at a time.
BLOCK = 512


@lru_cache(1)
def _circle() -> np.ndarray:
    """Runs of BANDS * ROWS entries of the second permutation, one for each position."""
    k = BANDS * ROWS
    order = np.random.Generator(np.random.PCG64(20240229)).permutation(POSITIONS)
    table = np.concatenate([order, order[:k]]).astype(np.uint32)
    return sliding_window_view(table, k)


def signature(found: np.ndarray) -> np.ndarray:
    """MinHash coordinates of a set of shingle hashes that is not empty."""
    runs = _circle()
    at = (mix(found ^ np.uint64(0xA5A5A5A5A5A5A5A5)) % np.uint64(POSITIONS)).astype(np.int64)
    lowest = runs[at[:_BLOCK]].min(axis=0)
    for i in range(_BLOCK, len(at), _BLOCK):
        np.minimum(lowest, runs[at[i : i + _BLOCK]].min(axis=0), out=lowest)
    return lowest


def band_keys(coordinates: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band of a signature."""
    total = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in coordinates.reshape(BANDS, ROWS).T.astype(np.uint64):
        total = mix(total * np.uint64(0x9E3779B97F4A7C15) + column)
    return total.view(np.int64)


def set_class(found: np.ndarray) -> int:
    """Number of a shingle set; unequal sets share one by chance only (n^2 / 2^65 pairs)."""
    digest = hashlib.blake2b(found.tobytes(), digest_size=8).digest()
    return int.from_bytes(digest, "little", signed=True)


def _signed(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, classes, bands = [], [], []
            for found in shingle_sets(batch.column(2), length):
                sizes.append(len(found))
                classes.append(set_class(found) if len(found) else None)
                bands.append(band_keys(signature(found)) if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(sizes, pa.int64()),
                    pa.array(classes, pa.int64()),
                    pa.array(bands, pa.list_(pa.int64())),
                ],
                names=["row", "doc_id", "n_shingles", "class", "bands"],
            )

    return run


def _sets(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [x.view(np.int64) for x in shingle_sets(batch.column(1), length)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.list_(pa.int64()))],
                names=["class", "shingles"],
            )

    return run


def _rows(docs: DataFrame) -> DataFrame:
    """Rows by a key of their content; only repeated rows share one."""
    return docs.select(
        F.xxhash64("doc_id", "text").alias("row"), F.col("doc_id").cast("long"), "text"
    )


def _class_sets(docs: DataFrame, classes: DataFrame, length: int) -> DataFrame:
    """Full shingle set of every class, from one text each."""
    texts = (
        _rows(docs)
        .join(classes.select("row", "class"), "row")
        .groupBy("row")
        .agg(F.first("class").alias("class"), F.first("text").alias("text"))
    )
    return texts.select("class", "text").mapInArrow(
        _sets(length), "class bigint, shingles array<bigint>"
    )


def _sizes_fit(left: str, right: str, percent: int):
    """Sets whose sizes alone rule out the similarity need no look at their shingles."""
    return F.least(left, right) * 100 >= F.greatest(left, right) * percent


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those pairs (a, b) whose full sets have the similarity."""
    left = sets.select(F.col("class").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("class").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("sa", "sb"))
    return both.where(common * 100 >= (F.size("sa") + F.size("sb") - common) * percent).select(
        "a", "b"
    )


def _block_links(percent: int):
    """Links between the queries and the other sets of a block."""

    def run(table: pa.Table) -> pa.Table:
        asks = table["query"].to_numpy()
        names, roots = table["class"].to_numpy(), table["root"].to_numpy()
        shingles = table["shingles"].combine_chunks()
        flat, cuts = shingles.values.to_numpy(), shingles.offsets.to_numpy()
        sizes = np.diff(cuts)
        rows = np.repeat(np.arange(len(names)), sizes)
        inner = ~asks[rows]
        order = np.argsort(flat[inner], kind="stable")
        values, owners = flat[inner][order], rows[inner][order]
        found = []
        for q in np.flatnonzero(asks):
            own = flat[cuts[q] : cuts[q + 1]]
            low, high = np.searchsorted(values, own), np.searchsorted(values, own, "right")
            counts = high - low
            places = np.repeat(low - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
            common = np.bincount(owners[places], minlength=len(names))
            linked = (common * 100 >= (sizes[q] + sizes - common) * percent) & (roots != roots[q]) & ~asks
            found += [(names[q], names[m]) for m in np.flatnonzero(linked)]
        a, b = zip(*found, strict=True) if found else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _second_leaders(
    banded: DataFrame, sets: DataFrame, links: DataFrame, roots: DataFrame, percent: int
) -> tuple[DataFrame, DataFrame]:
    """Links within buckets whose classes belong to several components: all links, new roots.

    A component leads a bucket if it has the class with most links there; the members of all
    its buckets form one group and are compared with its best linked class. Members still
    apart from it are then compared with all of the group, block by block: a task gets at
    most ``BLOCK`` sets of each side, counts what they have in common through an index
    of its own, and gives back links only.
    """
    degree = (
        links.select(F.explode(F.array("a", "b")).alias("class")).groupBy("class").agg(F.count("*").alias("links"))
    )
    placed = (
        banded.select("band", "class")
        .join(degree, "class", "left")
        .join(roots.withColumnRenamed("node", "class"), "class", "left")
        .select("band", "class", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "class").alias("root"))
    )
    placed = stored(placed, "placed")
    most = F.max(F.struct("links", "class", "root"))
    # One leader for a component, whatever buckets it dominates.
    heads = placed.groupBy("root").agg(most.getField("class").alias("leader"))
    mixed = (
        placed.groupBy("band")
        .agg(F.min("root").alias("low"), F.max("root").alias("high"), most.getField("root").alias("main"))
        .where("low != high")
        .join(heads, F.col("main") == F.col("root"))
        .select("band", "leader")
    )
    own = (
        placed.join(mixed, "band").where("class != leader").select("leader", "class").distinct()
    )
    lead = sets.select(F.col("class").alias("leader"), F.col("shingles").alias("sl"))
    common = F.size(F.array_intersect("shingles", "sl"))
    own = stored(
        own.join(lead, "leader")
        .join(sets, "class")
        .select("leader", "class", F.size("shingles").alias("n"), F.size("sl").alias("nl"), common.alias("common")),
        "members",
    )
    alike = f"common * 100 >= (n + nl - common) * {percent}"
    found = own.where(alike).select(F.col("class").alias("a"), F.col("leader").alias("b"))
    links = links.unionByName(found)
    trees = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
    roots = stored(components(trees.unionByName(found)), "roots")

    rooted = roots.withColumnRenamed("node", "class")
    lead = roots.select(F.col("node").alias("leader"), F.col("root").alias("main"))
    sized = (
        own.join(rooted, "class", "left")
        .join(lead, "leader", "left")
        .withColumn("root", F.coalesce("root", "class"))
        .withColumn("out", F.col("root") != F.coalesce("main", "leader"))
    )
    groups = (
        sized.groupBy("leader")
        .agg(F.max("out").alias("any_out"), F.count("*").alias("members"), F.sum(F.col("out").cast("int")).alias("outer"))
        .where("any_out and members > 1")
        .select(
            "leader",
            F.expr(f"cast(ceil(members / {BLOCK}D) as int)").alias("inner_blocks"),
            F.expr(f"cast(ceil(outer / {BLOCK}D) as int)").alias("outer_blocks"),
        )
    )
    sized = stored(
        sized.join(groups, "leader").join(sets, "class").select(
            "leader", "class", "root", "out", "inner_blocks", "outer_blocks", "shingles"
        ),
        "apart",
    )
    cell = lambda n: F.pmod(F.xxhash64("class"), F.col(n)).cast("int")
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    inner = sized.select(
        "leader", cell("inner_blocks").alias("i"), spread("outer_blocks").alias("o"), F.lit(False).alias("query"), "class", "root", "shingles"
    )
    outer = sized.where("out").select(
        "leader", spread("inner_blocks").alias("i"), cell("outer_blocks").alias("o"), F.lit(True).alias("query"), "class", "root", "shingles"
    )
    blocks = inner.unionByName(outer).groupBy("leader", "i", "o")
    more = blocks.applyInArrow(_block_links(percent), "a bigint, b bigint")
    more = stored(more, "verified")
    if more.isEmpty():
        return links, roots
    trees = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
    return links.unionByName(more), stored(components(trees.unionByName(more)), "roots")


def near_duplicates(docs: DataFrame, length: int = 5, percent: int = 80) -> DataFrame:
    """Component of near duplicates of every row of ``docs`` (doc_id, text, more columns).

    Two texts are linked if 100 * |common shingles| >= percent * |all their shingles|;
    shingles are ``length`` words. Returns ``doc_id, n_shingles, component_id, kept``, a row
    for each row of ``docs``. ``component_id`` is the smallest doc_id reachable over links.

    Empty and null texts, and texts of white space, have no shingles and are their own
    component. Equal texts are linked by their class and cost one comparison in all. Rows
    without doc_id take part but name no component; where no row of a component has an id,
    ``component_id`` is null. ``kept`` is true for the named row, and false for null ids
    unless the component has no id at all. Rows repeated with one doc_id are kept or
    dropped alike.
    """
    signed, rooted = _rooted(docs, length, percent)
    lowest = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = rooted.join(lowest, "root").select("class", "component_id")
    return (
        signed.join(named, "class", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("class").isNull(), F.col("doc_id"))
            .otherwise(F.col("component_id"))
            .alias("component_id"),
        )
        .withColumn("kept", F.expr("doc_id <=> component_id"))
    )


def deduplicated(docs: DataFrame, length: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` (doc_id, text, more columns) with one row of each component of near duplicates.

    That is the row with the smallest doc_id, null last, ties by a hash of the row; of rows that are equal
    in id and text one stays, whatever their other columns. Rows without words all stay, as nothing links them.
    """
    signed, rooted = _rooted(docs, length, percent)
    place = F.struct(F.col("doc_id").isNull().alias("x"), "doc_id", "row")
    heads = (
        signed.where("class is not null")
        .join(rooted.select("class", "root"), "class")
        .groupBy("root")
        .agg(F.min(place).alias("head"))
        .select("head.row")
    )
    # Repeated rows share a number; only these need to be told apart.
    counts = signed.where("class is not null").groupBy("row").agg((F.count("*") > 1).alias("repeated"))
    heads = heads.join(counts, "row")
    wordless = signed.where("class is null").select("row", F.lit(False).alias("repeated")).distinct()
    number = "row_number"
    while number in docs.columns:
        number += "_"
    chosen = heads.unionByName(wordless).withColumnRenamed("row", number)
    kept = docs.withColumn(number, F.xxhash64("doc_id", "text")).join(chosen.withColumnRenamed("repeated", f"{number}r"), number)
    once = kept.where(~F.col(f"{number}r"))
    again = kept.where(F.col(f"{number}r")).dropDuplicates([number])
    return once.unionByName(again).select(*docs.columns)


def _rooted(docs: DataFrame, length: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Rows with their class, and classes with the root of their component and smallest doc_id."""
    signed = stored(
        _rows(docs).mapInArrow(
            _signed(length),
            "row bigint, doc_id bigint, n_shingles bigint, class bigint, bands array<bigint>",
        ),
        "signed",
    )
    classes = (
        signed.where("class is not null")
        .groupBy("class")
        .agg(
            F.min("doc_id").alias("doc_id"),
            F.min("row").alias("row"),
            F.first("n_shingles").alias("n"),
            F.first("bands").alias("bands"),
        )
    )
    classes = stored(classes, "classes")
    banded = classes.select("class", "n", F.explode("bands").alias("band"))
    shared = (
        banded.groupBy("band")
        .agg(F.min("class").alias("leader"), F.count("*").alias("members"))
        .where("members > 1")
    )
    # The members of shared buckets only; every later step reads this table.
    banded = stored(banded.join(shared, "band"), "banded")

    heads = classes.select(F.col("class").alias("leader"), F.col("n").alias("m"))
    pairs = (
        banded.select("leader", "class", "n")
        .where("class != leader")
        .distinct()
        .join(heads, "leader")
        .where(_sizes_fit("n", "m", percent))
        .select(F.col("class").alias("a"), F.col("leader").alias("b"))
    )
    wanted = classes.join(banded.select("class").distinct(), "class", "left_semi")
    sets = stored(_class_sets(docs, wanted, length), "sets")
    links = stored(_linked(pairs, sets, percent), "verified")
    roots = stored(components(links), "roots")
    _, roots = _second_leaders(banded, sets, links, roots, percent)

    rooted = classes.select("class", "doc_id").join(
        roots, F.col("class") == F.col("node"), "left"
    )
    return signed, rooted.select("class", "doc_id", F.coalesce("root", "class").alias("root"))
