"""Exact nearest neighbours of a query set by a block matrix join.

Queries and candidates are dealt into blocks of a bounded size, and each pair of blocks is a
tile, worked out by one task. Vectors are rounded to eight-bit whole numbers with a scale of their own;
the products of these are exact, and with the lengths of what rounding lost they bound
every distance of the tile from both sides:

    |rounded distance - distance| <= lost by the query + lost by the candidate

Pairs whose lower bound exceeds what the query's heap or the upper bounds of the tile
guarantee are dropped; distances of the others are computed in double precision from the original vectors and
enter the heap. Tiles give back as many entries a query as its heap holds, so neither memory nor the shuffle
depends on how many vectors lie close together.

Equal vectors are one candidate with its smallest ids, and one query: a vector that a third
of all rows share is searched for once, and its rows only read the answer.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sportlake.llm.tables import stored

#: Bytes of candidates and of queries in a tile, and vectors that a block of candidates needs
#: before small inputs are cut further to use all tasks.
CANDIDATES, QUERIES, FEWEST = 1 << 20, 1 << 24, 256
#: Candidates and queries whose products are formed at once, and numbers of a float product that
#: stays exact: 1024 * 127 * 127 < 2^24.
WIDE, HIGH, EXACT = 1024, 512, 1024
#: Numbers that are recomputed at once.
RECOMPUTED = 1 << 21
#: Allowance for rounding in the bounds, as a share of both lengths.
ROUNDING = 1e-7


class Rounded:
    """Vectors as eight-bit whole numbers: ``codes``, ``scale``, rounded ``square`` and what was ``lost``."""

    def __init__(self, vectors: np.ndarray) -> None:
        self.vectors = vectors
        self.scale = np.abs(vectors).max(axis=1) / 127
        # Of tiny vectors the scale may round to zero; then all is lost, and the bounds still hold.
        steps = np.divide(vectors, self.scale[:, None], out=np.zeros_like(vectors), where=self.scale[:, None] > 0)
        self.codes = np.rint(steps).clip(-127, 127).astype(np.int8)
        whole = self.codes.astype(np.float64)
        self.square = self.scale**2 * (whole**2).sum(axis=1)
        self.lost = np.sqrt(((vectors - self.scale[:, None] * whole) ** 2).sum(axis=1))
        self.slack = self.lost + ROUNDING * (np.sqrt(self.square) + self.lost)

    def part(self, low: int, high: int) -> tuple[np.ndarray, ...]:
        return tuple(x[low:high] for x in (self.codes, self.scale, self.square, self.slack))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of the rows of eight-bit matrices, exact."""
    total = np.zeros((len(a), len(b)), np.float64)
    for low in range(0, a.shape[1], EXACT):
        left, right = (x[:, low : low + EXACT].astype(np.float32) for x in (a, b))
        total += left @ right.T
    return total


def bounds(query: tuple[np.ndarray, ...], other: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of all distances between two parts of rounded vectors."""
    codes, scale, square, slack = query
    codes2, scale2, square2, slack2 = other
    about = products(codes, codes2) * (-2 * scale[:, None] * scale2[None, :])
    about += square[:, None] + square2[None, :]
    about = np.sqrt(np.maximum(about, 0))
    around = slack[:, None] + slack2[None, :]
    return about - around, about + around


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of the rows of two matrices, squares added in the order of the numbers."""
    total = np.zeros(max(len(a), len(b)))
    for square in np.ascontiguousarray(np.square(a - b).T):
        total += square
    return np.sqrt(total)


def tile(queries: np.ndarray, candidates: np.ndarray, ids: list[list[int]], keep: int) -> list[list[tuple[float, int]]]:
    """For each query the ``keep`` nearest ``(distance, id)``, ties by smaller id.

    ``ids`` has the ids of each candidate vector.
    """
    heaps: list[list[tuple[float, int]]] = [[] for _ in queries]
    reach = np.full(len(queries), np.inf)
    rounded, others = Rounded(queries), Rounded(candidates)
    rows = max(1, RECOMPUTED // queries.shape[1])
    for left in range(0, len(candidates), WIDE):
        right = min(left + WIDE, len(candidates))
        for top in range(0, len(queries), HIGH):
            bottom = min(top + HIGH, len(queries))
            lowest, highest = bounds(rounded.part(top, bottom), others.part(left, right))
            near = reach[top:bottom]
            if right - left >= keep:
                near = np.fmin(near, np.partition(highest, keep - 1, axis=1)[:, keep - 1])
            # Not "<=", so that bounds that overflow to NaN drop nothing.
            who, whom = np.nonzero(~(lowest > near[:, None]))
            who, whom = who + top, whom + left
            for low in range(0, len(who), rows):
                mine, its = who[low : low + rows], whom[low : low + rows]
                found = distances(queries[mine], candidates[its])
                close = ~(found > reach[mine])
                for query, other, distance in zip(
                    mine[close].tolist(), its[close].tolist(), found[close].tolist(), strict=True
                ):
                    heap = heaps[query]
                    for own in ids[other]:
                        entry = (-distance, -own)
                        if len(heap) < keep:
                            heapq.heappush(heap, entry)
                        else:
                            heapq.heappushpop(heap, entry)
                    if len(heap) == keep:
                        reach[query] = -heap[0][0]
    return [sorted((-distance, -own) for distance, own in heap) for heap in heaps]


def _matrix(column: pa.ChunkedArray, size: int) -> np.ndarray:
    values = column.combine_chunks().flatten()
    return np.asarray(values).astype(np.float64).reshape(-1, size)


def _tiles(keep: int):
    def found(key: tuple, candidates: pa.Table, queries: pa.Table) -> pa.Table:
        least, mark, distance, ids = [], [], [], []
        if len(candidates) and len(queries):
            size = key[0].as_py()
            nearest = tile(
                _matrix(queries["vector"], size),
                _matrix(candidates["vector"], size),
                candidates["ids"].to_pylist(),
                keep,
            )
            heads = zip(queries["least"].to_pylist(), queries["mark"].to_pylist(), nearest, strict=True)
            for own, hashed, entries in heads:
                least += [own] * len(entries)
                mark += [hashed] * len(entries)
                distance += [d for d, _ in entries]
                ids += [i for _, i in entries]
        return pa.table(
            {
                "least": pa.array(least, pa.int64()),
                "mark": pa.array(mark, pa.int64()),
                "score": pa.array(distance, pa.float64()),
                "vec_id": pa.array(ids, pa.int64()),
            }
        )

    return found


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, vector`` of the rows that take part, each pair once."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("vector"))
    if rows.schema["vector"].dataType.simpleString() != "array<float>":
        rows = rows.withColumn("vector", F.col("vector").cast("array<double>"))
    number = "x is not null and not isnan(x) and abs(x) < double('infinity')"
    rows = rows.where(f"vec_id is not null and vector is not null and forall(vector, x -> {number})")
    # Adding zero makes one of both zeros.
    rows = rows.withColumn("vector", F.transform("vector", lambda x: x + F.lit(0).cast("float")))
    return rows.where("exists(vector, x -> x <> 0)").dropDuplicates(["vec_id", "vector"])


def classes(rows: DataFrame, keep: int) -> DataFrame:
    """Distinct vectors with their ``keep`` smallest ids, and whether any of its rows is a query."""
    order = W.partitionBy("vector", "is_query").orderBy("vec_id")
    few = rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= keep)
    grouped = few.groupBy("vector").agg(
        F.slice(F.sort_array(F.collect_list("vec_id")), 1, keep).alias("ids"),
        F.max("is_query").alias("is_query"),
    )
    return grouped.select("vector", "ids", "is_query", F.size("vector").alias("size"), F.xxhash64("vector").alias("mark"))


def nearest(vectors: DataFrame, is_query: Column, k: int = 10) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` rows nearest to each query, by Euclidean distance.

    ``vectors`` has ``vec_id``, ``embedding`` (numbers of float or double) and maybe more columns; ``is_query``
    is a condition on ``vec_id``. All rows are candidates but those with the query's id. Ranks are from 1,
    ties go to the smaller ``vec_id``; a query with fewer candidates lists them all.

    Rows without id, and vectors that are null, empty or zero or hold null or non-finite numbers,
    take no part. Only vectors of one length are compared. A row that is repeated counts once;
    an id with several vectors is several queries. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    keep = k + 1  # a query's own row is among them
    rows = stored(usable(vectors).withColumn("is_query", F.coalesce(is_query, F.lit(False))), "vectors")
    found = stored(classes(rows, keep).withColumn("least", F.col("ids")[0]), "classes")
    held = found.agg(
        F.count("*").alias("n"),
        F.coalesce(F.sum("size"), F.lit(0)).alias("numbers"),
        F.coalesce(F.sum(F.when(F.col("is_query"), F.col("size"))), F.lit(0)).alias("asked"),
    ).first()
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    across = max(1, -(-held["numbers"] * 4 // CANDIDATES), min(tasks, held["n"] // FEWEST))
    down = max(1, -(-held["asked"] * 4 // QUERIES))

    def dealt(name: str, salt: int, blocks: int) -> Column:
        return F.pmod(F.xxhash64("mark", F.lit(salt)), F.lit(blocks)).cast("int").alias(name)

    def every(name: str, blocks: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias(name)

    candidates = found.select("size", "vector", "ids", dealt("across", 1, across), every("down", down))
    queries = found.where("is_query")
    asked = queries.select("size", "vector", "least", "mark", dealt("down", 2, down), every("across", across))
    keys = ["size", "down", "across"]
    tiles = candidates.groupBy(*keys).cogroup(asked.groupBy(*keys))
    entries = tiles.applyInArrow(_tiles(keep), "least bigint, mark bigint, score double, vec_id bigint")
    order = W.partitionBy("least", "mark").orderBy("score", "vec_id")
    merged = (
        entries.withColumn("place", F.row_number().over(order))
        .where(F.col("place") <= keep)
        .groupBy("least", "mark")
        .agg(F.sort_array(F.collect_list(F.struct("score", "vec_id"))).alias("entries"))
    )
    answers = queries.select("least", "mark", "vector").join(merged, ["least", "mark"])
    asking = rows.where("is_query").select(F.col("vec_id").alias("query_id"), "vector", F.xxhash64("vector").alias("mark"))
    own = F.slice(F.filter("entries", lambda e: e["vec_id"] != F.col("query_id")), 1, k)
    return (
        asking.join(answers, ["mark", "vector"])
        .select("query_id", F.posexplode(own).alias("place", "entry"))
        .select("query_id", (F.col("place") + 1).alias("rank"), "entry.vec_id", "entry.score")
    )
