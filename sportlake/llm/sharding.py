"""Balanced label propagation: linked documents move to one shard, shards stay even.

Documents are linked by keys that they share: their text, and the smallest hashes of their
five-word shingles under several permutations. Copies of a text form one vertex with a
weight, or several if they would fill more than a part of a shard. Vertices start in the order
of one key, cut into even stretches. In each round every key names the shard that holds most
of its weight, and a vertex moves to the shard that most of its keys name: in exchange for
one of equal weight, or as far as the shard's quota lasts. Rounds end when the weight that
keys have outside the shard they name, the cut, stops falling. No link is ever expanded into
pairs. At the end, rows beyond a shard's even count go to shards below it, rows that share no
key first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sportlake.llm.tables import stored
from sportlake.llm.words import mix, shingle_sets

#: Words in a shingle, keys from shingles, and how much a quota exceeds an even share.
LENGTH, KEYS, SLACK = 5, 6, 0.04
#: A round that lowers the cut by less than this share counts as idle; so many idle ones end it.
TOLERANCE, IDLE = 0.005, 2
#: A vertex has at most this share of a shard; cells that orders are computed in.
VERTEX_SHARE, CELLS = 0.25, 64


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seeds = mix(np.arange(1, KEYS + 1, dtype=np.uint64))
    for batch in batches:
        keys = []
        for found in shingle_sets(batch.column(1), LENGTH):
            lowest = [mix(found ^ s).min() for s in seeds] if len(found) else []
            keys.append(mix(np.array(lowest, np.uint64) + seeds[: len(lowest)]).view(np.int64))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(keys, pa.list_(pa.int64()))], names=["group", "keys"]
        )


def _start(vertices: DataFrame, shards: int, total: int) -> DataFrame:
    """Even stretches of the vertices in the order of their first key."""
    lead = F.coalesce(F.get("keys", F.lit(0)), F.col("v"))
    cells = (
        vertices.withColumn("lead", lead)
        .withColumn("cell", F.expr("shiftrightunsigned(lead, 54)"))
        .withColumn("part", F.expr(f"pmod(xxhash64(v, 3L), {CELLS})"))
    )
    sums = cells.groupBy("cell", "part").agg(F.sum("w").alias("words"))
    sums = sums.withColumn("ahead", F.sum("words").over(W.orderBy("cell", "part")) - F.col("words"))
    running = F.sum("w").over(W.partitionBy("cell", "part").orderBy("lead", "v"))
    placed = cells.withColumn("running", running).join(sums, ["cell", "part"])
    at = (F.col("ahead") + F.col("running") - F.col("w") / 2) * shards / F.lit(float(max(1, total)))
    return placed.select("v", "w", F.least(at.cast("int"), F.lit(shards - 1)).alias("shard"))


def _named(links: DataFrame, labels: DataFrame) -> DataFrame:
    """For each key the shard with most of its weight, and the weight elsewhere (``outside``)."""
    share = links.join(labels, "v").groupBy("key", "shard").agg(F.sum("w").alias("held"))
    most = F.max(F.struct("held", "shard"))
    return share.groupBy("key").agg(
        most.getField("shard").alias("named"), (F.sum("held") - most.getField("held")).alias("outside")
    )


def _running(rows: DataFrame, by: list[str], order: list[Column], weight: Column) -> DataFrame:
    """Sum of ``weight`` up to each row within ``by``: offsets of cells, and sums in a cell."""
    sums = rows.groupBy(*by, "cell").agg(F.sum(weight).alias("sum"))
    ahead = F.sum("sum").over(W.partitionBy(*by).orderBy("cell")) - F.col("sum")
    sums = sums.select(*by, "cell", ahead.alias("ahead"))
    within = F.sum(weight).over(W.partitionBy(*by, "cell").orderBy(*order))
    placed = rows.withColumn("within", within).join(sums, [*by, "cell"])
    return placed.withColumn("running", F.col("ahead") + F.col("within")).drop("ahead", "within")


def _moved(
    links: DataFrame, named: DataFrame, labels: DataFrame, shards: int, total: int, turn: int
) -> DataFrame:
    """One round: labels after the moves that quotas allow.

    First vertices of equal weight change places between two shards, which needs no room.
    What other vertices wish fills the room of each shard, largest gain first. Room is what
    linked rows leave of a quota, as rows that share no key give way in the end.
    """
    votes = links.join(named, "key").groupBy("v", "named").agg(F.count("*").alias("votes"))
    here = F.sum(F.when(F.col("named") == F.col("shard"), F.col("votes")).otherwise(0))
    best = F.max(F.struct("votes", F.xxhash64("v", "named").alias("tie"), "named"))
    gain = F.col("best.votes") - F.col("here")
    wishes = (
        votes.join(labels, "v")
        .groupBy("v", "w", "shard")
        .agg(here.alias("here"), best.alias("best"))
        .where("best.votes > here and best.named != shard")
        # Half of the vertices move in a round, so that neighbours don't change places.
        .where(F.pmod(F.xxhash64("v", F.lit(turn // 2)), F.lit(2)) == turn % 2)
        .select("v", "w", "shard", F.col("best.named").alias("to"), gain.alias("gain"))
        .withColumn("cell", (KEYS + 1 - F.col("gain")) * CELLS + F.pmod(F.xxhash64("v"), F.lit(CELLS)))
    )
    wishes = stored(wishes, "wishes")
    order = [F.desc("gain"), F.col("v")]
    counts = wishes.groupBy("shard", "to", "w").agg(F.count("*").alias("back"))
    back = counts.select(F.col("to").alias("shard"), F.col("shard").alias("to"), "w", "back")
    ranked = _running(wishes, ["shard", "to", "w"], order, F.lit(1)).join(back, ["shard", "to", "w"], "left")
    ranked = stored(ranked.withColumn("swap", F.coalesce(F.col("running") <= F.col("back"), F.lit(False))), "swaps")

    held = labels.where("heavy").groupBy("shard").agg(F.sum("w").alias("n")).collect()
    loads = {r["shard"]: r["n"] for r in held}
    quota = total / shards * (1 + SLACK)
    room = F.get(F.array(*[F.lit(max(0.0, quota - loads.get(s, 0))) for s in range(shards)]), F.col("to"))
    # A vertex that no room can hold must not count against those after it.
    rest = ranked.where(~F.col("swap") & (F.col("w") <= room)).drop("running")
    entering = _running(rest, ["to"], order, F.col("w")).where(F.col("running") <= room)
    moves = ranked.where("swap").select("v", "to").unionByName(entering.select("v", "to"))
    return labels.join(moves, "v", "left").select("v", "w", "heavy", F.coalesce("to", "shard").alias("shard"))


def _step(values: list[int], at: Column) -> Column:
    """Number of the interval, given by ascending starts, that ``at`` lies in."""
    starts = F.array(*[F.lit(int(v)).cast("long") for v in values])
    return F.size(F.filter(starts, lambda s: s <= at)) - 1


def sharded(docs: DataFrame, shards: int = 40, rounds: int | None = None) -> DataFrame:
    """Shard of every row of ``docs`` (doc_id, text, more columns).

    Rounds go on until the cut stops falling, or for ``rounds`` at most if that is given.

    Returns ``row, doc_id, size, text_crc32, shard, slot`` for each row: ``size`` is the
    text's UTF-8 bytes plus 16, ``slot`` counts a shard's rows without gap from 0, and the
    shards' row counts differ by one at most. ``row`` is a hash of id and text.

    Null and empty texts are equal and count as copies of each other. Copies of a text are
    in one shard unless they exceed a quarter of it. Ids may be null, rows may repeat. The
    result depends on the rows only, not on their partitions. With fewer rows than shards
    some shards stay empty.
    """
    text = F.coalesce("text", F.lit(""))
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("doc_id", "text").alias("row"),
        F.xxhash64(text).alias("group"),
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    rows = stored(keyed, "rows")
    groups = rows.groupBy("group").agg(F.count("*").alias("n"))
    total = rows.count()
    part = max(1, int(total / shards * VERTEX_SHARE))
    # Fewer than shards / VERTEX_SHARE groups can exceed a part of a shard.
    large = groups.where(F.col("n") > part).select(
        "group", F.expr(f"cast(ceil(n / {part}D) as long)").alias("parts")
    )
    rows = rows.join(F.broadcast(large), "group", "left")
    number = F.when(F.col("parts").isNull(), F.lit(0).cast("long")).otherwise(F.pmod(F.xxhash64("row", F.lit(5)), "parts"))
    rows = rows.withColumn("v", F.xxhash64("group", number)).drop("parts")
    keys = docs.select(F.xxhash64(text).alias("group"), "text").mapInArrow(
        _keyed, "group bigint, keys array<bigint>"
    )
    keys = stored(keys, "keys").groupBy("group").agg(F.first("keys").alias("keys"))
    vertices = rows.groupBy("group", "v").agg(F.count("*").alias("w")).join(keys, "group")
    vertices = stored(vertices, "vertices")
    links = vertices.select(
        "v", F.explode(F.array_distinct(F.concat("keys", F.array("group")))).alias("key")
    )
    common = links.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    links = stored(links.join(common, "key"), "links")
    linked = links.select("v").distinct().withColumn("linked", F.lit(True))
    heavy = ((F.col("w") > 1) | F.coalesce("linked", F.lit(False))).alias("heavy")
    labels = _start(vertices, shards, total).join(linked, "v", "left").select("v", "w", "shard", heavy)
    labels = stored(labels, "labels")
    best, lowest, idle, turn = labels, float("inf"), 0, 0
    while turn != rounds:
        named = stored(_named(links, labels), "named")
        cut = named.agg(F.sum("outside").alias("cut")).first()["cut"] or 0
        idle = 0 if cut < lowest * (1 - TOLERANCE) else idle + 1
        if cut < lowest:
            best, lowest = labels, cut
        if cut == 0 or idle == IDLE:
            labels = best
            break
        labels = stored(_moved(links, named, labels, shards, total, turn), "labels")
        turn += 1

    labels = labels.select("v", "shard", F.col("heavy").alias("linked"))
    # Place of each row in its shard, linked rows first: offsets of cells, and rank in a cell.
    cell = F.pmod(F.xxhash64("v", F.lit(9)), F.lit(CELLS)) + F.when(F.col("linked"), 0).otherwise(CELLS)
    salted = F.pmod(F.xxhash64("row", F.lit(11)), F.lit(CELLS))
    placed = stored(rows.join(labels, "v").withColumn("cell", cell * CELLS + salted), "placed")
    counts = placed.groupBy("shard", "cell").agg(F.count("*").alias("n"))
    ahead = F.sum("n").over(W.partitionBy("shard").orderBy("cell")) - F.col("n")
    counts = counts.withColumn("ahead", ahead)
    within = F.row_number().over(W.partitionBy("shard", "cell").orderBy("v", "row"))
    placed = placed.withColumn("within", within).join(counts, ["shard", "cell"])
    placed = placed.withColumn("slot", (F.col("ahead") + F.col("within") - 1).cast("long"))
    held = {r["shard"]: r["n"] for r in counts.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    even = [total // shards + (s < total % shards) for s in range(shards)]
    over = np.cumsum([0] + [max(0, held.get(s, 0) - even[s]) for s in range(shards)])
    under = np.cumsum([0] + [max(0, even[s] - held.get(s, 0)) for s in range(shards)])
    pick = lambda values, by: F.get(F.array(*[F.lit(int(v)).cast("long") for v in values]), by)
    limit = pick(even, F.col("shard"))
    place = pick(over[:-1], F.col("shard")) + F.col("slot") - limit
    placed = placed.withColumn("surplus", F.when(F.col("slot") >= limit, place))
    to = _step(list(under[:-1]), F.col("surplus"))
    placed = placed.withColumn("to", F.when(F.col("surplus").isNotNull(), to))
    filled = pick([min(held.get(s, 0), even[s]) for s in range(shards)], F.col("to"))
    slot = filled + F.col("surplus") - pick(under[:-1], F.col("to"))
    return placed.select(
        "row",
        "doc_id",
        "size",
        "text_crc32",
        F.coalesce("to", "shard").cast("int").alias("shard"),
        F.when(F.col("to").isNotNull(), slot).otherwise(F.col("slot")).alias("slot"),
    )


def assigned(docs: DataFrame, shards: int = 40) -> DataFrame:
    """``docs`` with columns ``shard`` and ``slot``; equal rows get different slots."""
    nth = W.partitionBy("__row").orderBy("__shard", "__slot")
    found = sharded(docs, shards).select(
        F.col("row").alias("__row"), F.col("shard").alias("__shard"), F.col("slot").alias("__slot")
    )
    found = found.withColumn("__nth", F.row_number().over(nth))
    own = docs.withColumn("__row", F.xxhash64("doc_id", "text"))
    own = own.withColumn("__nth", F.row_number().over(W.partitionBy("__row").orderBy("__row")))
    keep = [c for c in docs.columns if c not in ("shard", "slot")]
    return own.join(found, ["__row", "__nth"]).select(
        *keep, F.col("__shard").alias("shard"), F.col("__slot").alias("slot")
    )
