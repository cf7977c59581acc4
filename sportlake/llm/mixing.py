"""Mixing of sources to target weights along a low-discrepancy schedule, in SQL functions only.

Slot n of the schedule takes the point n * g mod 1 (g: the golden ratio's fraction, in exact
arithmetic modulo 2^31) through the cumulated target shares to a source. The texts of a source
stand in a shuffled order that their hashes fix, and are cut into blocks of ``block`` words;
the j-th slot of a source gets its j-th block, going round again when all are used. Slots
beyond a source's target are left out, and slots it still lacks follow at the end, so every
source gives its target's words and any stretch of the schedule is close to the targets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sportlake.llm.tables import stored

WORD = r"[^\x20\x09-\x0D]+"
#: Weights of sources by rank, over and over; how often a source's words may be used.
WEIGHTS, REPEATS = (5, 2, 1), 3
#: Cells that a source's texts are sorted in, and cells of the schedule's points.
CELLS, GRID = 1024, 1 << 12
_STEP, _RANGE = 1_327_217_885, 1 << 31


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """``sizes`` (source, source_size) with ``target``: words that each source should give.

    Sources ranked by code point, null last, weigh ``weights`` in turn and share all words.
    A target stops at ``repeats`` times its source's size; what is beyond is shared again by
    weight among the others until none is above. In closed form: with the sources in order
    of size per weight, the first ones are full and the others get one rate per weight.
    The table has one row a source and is ordered as a whole.
    """
    by_name = W.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    place = (F.row_number().over(by_name) - 1) % len(weights) + 1
    whole = W.partitionBy()
    by_rate = W.orderBy(F.col("cap") / F.col("weight"), "place")
    before = by_rate.rowsBetween(W.unboundedPreceding, -1)
    ranked = (
        sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), place).cast("double"))
        .withColumn("place", F.row_number().over(by_name))
        .withColumn("cap", (F.col("source_size") * repeats).cast("double"))
        .withColumn("left", F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("heavy", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("nth", F.row_number().over(by_rate))
    )
    # The first source that its share does not fill sets the rate.
    first = F.min(F.when(F.expr("cap > left / heavy * weight"), F.struct("nth", F.expr("left / heavy").alias("rate"))))
    return ranked.withColumn("open", first.over(whole)).select(
        "source",
        "source_size",
        F.expr("if(open is null or nth < open.nth, cap, open.rate * weight)").alias("target"),
    )


def _sid() -> Column:
    """Key of a source; null is a source of its own."""
    return F.xxhash64("source", F.col("source").isNull()).alias("sid")


def _golden(n: Column) -> Column:
    """Point of slot n as a whole number below 2^31."""
    return (n % _RANGE) * _STEP % _RANGE


def schedule(goals: DataFrame, block: int) -> DataFrame:
    """Slots ``sid, position, j, block, first, last`` of the mix.

    ``goals``: sid, source_size, target. ``first`` to below ``last`` are the words of the
    source's shuffled order that the slot takes; they lie in one block, and in the block's
    beginning only where a source ends or its target is reached.
    """
    spark = goals.sparkSession
    goals = stored(
        goals.where("source_size > 0")
        .withColumn("goal", F.round("target").cast("long"))
        .withColumn("blocks", F.expr(f"cast(ceil(source_size / {block}D) as bigint)"))
        .withColumn("rounds", F.expr("goal div source_size"))
        .withColumn("rest", F.expr("goal % source_size"))
        .withColumn("need", F.expr(f"rounds * blocks + cast(ceil(rest / {block}D) as bigint)"))
        .withColumn("high", F.sum("target").over(W.orderBy("sid")))
        .withColumn("all_words", F.sum("target").over(W.partitionBy()))
        .withColumn("low", F.expr(f"cast((high - target) / all_words * {_RANGE} as bigint)"))
        .withColumn("high", F.expr(f"cast(high / all_words * {_RANGE} as bigint)")),
        "goals",
    )
    slots = goals.agg(F.sum("need")).first()[0] or 0
    width = _RANGE // GRID
    cells = goals.where("high > low").select(
        "sid", "low", "high", F.explode(F.expr(f"sequence(low div {width}, (high - 1) div {width})")).alias("cell")
    )
    points = spark.range(slots).select(F.col("id").alias("position"), _golden(F.col("id")).alias("point"))
    placed = points.withColumn("cell", F.expr(f"point div {width}")).join(cells, "cell")
    placed = placed.where("point >= low and point < high").select(
        "sid", "position", F.expr("position div 65536").alias("part")
    )
    # Rank within a source in two steps: within parts of the schedule, then over the parts.
    counts = placed.groupBy("sid", "part").agg(F.count("*").alias("n"))
    ahead = W.partitionBy("sid").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    counts = counts.withColumn("ahead", F.coalesce(F.sum("n").over(ahead), F.lit(0)))
    within = F.row_number().over(W.partitionBy("sid", "part").orderBy("position"))
    ranked = (
        placed.withColumn("within", within)
        .join(counts, ["sid", "part"])
        .select("sid", "position", (F.col("within") - 1 + F.col("ahead")).alias("j"))
    )
    given = counts.groupBy("sid").agg(F.sum("n").alias("given"))
    late = (
        goals.join(given, "sid", "left")
        .withColumn("given", F.coalesce("given", F.lit(0)))
        .where("given < need")
        .select("sid", F.explode(F.expr("sequence(given, need - 1)")).alias("j"))
        .select("sid", (F.lit(slots) + F.col("j")).alias("position"), "j")
    )
    return (
        ranked.unionByName(late)
        .join(goals, "sid")
        .where("j < need")
        .withColumn("block", F.expr("j % blocks"))
        .withColumn("first", F.expr(f"block * {block}"))
        .withColumn(
            "last",
            F.expr(f"least(first + {block}, if(j div blocks < rounds, source_size, rest))"),
        )
        .select("sid", "position", "j", "block", "first", "last")
    )


def mixed(
    docs: DataFrame,
    block: int = 2048,
    weights: tuple[int, ...] = WEIGHTS,
    repeats: int = REPEATS,
) -> DataFrame:
    """How often the words of each row of ``docs`` (doc_id, text, source, ...) are mixed in.

    Returns ``doc_id, row, source, size, source_size, target, taken``, a row for each row;
    ``row`` is a hash of id and text. ``size`` counts words (runs of bytes other than space
    and 0x09 to 0x0D), ``target`` and ``source_size`` are the source's, ``taken`` is how many
    words the schedule takes from the text, repeats counted. Each source's taken words add
    up to its target rounded, and no text exceeds ``repeats`` times its size.

    Texts without words, empty and null ones, have size and taken 0. A null source is a
    source, the last by name. Null ids are allowed; repeated rows are texts of their own. The
    order of texts and so the result depends on ids and texts only, not on partitions.
    """
    row = F.xxhash64("doc_id", "text").alias("row")
    sizes = stored(
        docs.select("doc_id", row, F.col("source").cast("string").alias("source"), word_count("text").alias("size"))
        .withColumn("sid", _sid())
        .withColumn("cell", F.pmod(F.xxhash64("row", F.lit("cell")), F.lit(CELLS))),
        "sizes",
    )
    sums = sizes.groupBy("sid", "source", "cell").agg(F.sum("size").alias("words"))
    sums = stored(sums, "cells")
    goals = targets(sums.groupBy("source").agg(F.sum("words").alias("source_size")), weights, repeats)
    goals = stored(goals.withColumn("sid", _sid()), "targets")
    slots = stored(schedule(goals.drop("source"), block), "schedule")
    ahead = W.partitionBy("sid").orderBy("cell").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.select("sid", "cell", F.coalesce(F.sum("words").over(ahead), F.lit(0)).alias("ahead"))
    order = W.partitionBy("sid", "cell").orderBy("row", "doc_id", "size")
    running = F.sum("size").over(order.rowsBetween(W.unboundedPreceding, 0))
    placed = (
        sizes.where("size > 0")
        .withColumn("running", running)
        .join(sums, ["sid", "cell"])
        .withColumn("end", F.col("ahead") + F.col("running"))
        .withColumn("begin", F.col("end") - F.col("size"))
    )
    parts = placed.select(
        "sid",
        "begin",
        "end",
        "doc_id",
        "row",
        "size",
        F.explode(F.expr(f"sequence(begin div {block}, (end - 1) div {block})")).alias("block"),
    )
    common = F.greatest(F.lit(0), F.least("end", "last") - F.greatest("begin", "first"))
    taken = F.coalesce(F.sum(F.when(F.col("first").isNotNull(), common)), F.lit(0))
    parts = (
        parts.join(slots, ["sid", "block"], "left")
        .groupBy("sid", "begin", "doc_id", "row", "size")
        .agg(taken.alias("taken"))
    )
    empty = sizes.where("size = 0").select("sid", "doc_id", "row", "size", F.lit(0).cast("long").alias("taken"))
    return (
        parts.drop("begin")
        .unionByName(empty)
        .join(goals, "sid")
        .select("doc_id", "row", "source", "size", "source_size", "target", F.col("taken").cast("long"))
    )


def applied(docs: DataFrame, **options) -> DataFrame:
    """``docs`` as the mix takes them, all columns as they are.

    Each row comes as many times as the mix takes its words, rounded; per source only the one
    text that the target cuts is rounded at all. Texts without words take no share and stay
    out, as do those that the schedule does not reach.
    """
    found = mixed(docs, **options)
    copy = F.row_number().over(W.partitionBy("row").orderBy(F.desc("taken")))
    found = found.where("taken * 2 >= size and size > 0").withColumn("nth", copy)
    found = found.select("row", "nth", F.expr("cast(round(taken / size) as int)").alias("copies"))
    own = docs.withColumn("__row", F.xxhash64("doc_id", "text"))
    own = own.withColumn("__nth", F.row_number().over(W.partitionBy("__row").orderBy("__row")))
    joined = own.join(found, (F.col("__row") == found["row"]) & (F.col("__nth") == found["nth"]))
    copies = F.explode(F.array_repeat(F.lit(1), found["copies"])).alias("__copy")
    return joined.select(*[own[c] for c in docs.columns], copies).drop("__copy")
