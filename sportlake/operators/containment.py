"""Which names occur inside which texts, as an equality join.

Testing every name against every text would be a cross join. Instead each name gets one
anchor that any text holding the name must also hold, texts are taken apart into the same
kind of keys, and only pairs that agree on a key are tested. The result is exact, whatever
the names and texts are.

Texts and names are split at single spaces. For a name of several parts,

* a part between two others stands in the text as a whole word,
* the last part starts a word of the text,

and a name of one part lies within one word. The piece that the fewest texts have is the anchor; names of
three parts and more need no piece that only starts a word. Whatever piece is taken, the result is the
same, so what the choice goes by need not be exact: a filter of fixed size holds the keys of all
names, and only keys of texts that pass it are shuffled, once, for the count and for the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Pieces of words are compared up to this length, which bounds the keys per letter of text.
MAX_PIECE = 16
#: 64-bit words of the filter of keys, and parts that the texts of one key are dealt over.
FILTER_WORDS, PARTS = 1 << 12, 8

WORD, START, INSIDE = "word", "start", "inside"


def contained_names(texts: DataFrame, names: DataFrame, on: tuple[str, ...] = ()) -> DataFrame:
    """Pairs ``(text_id, name_id)`` such that the text contains the name.

    ``texts`` has ``text_id, text`` and ``names`` has ``name_id, name``; ids are unique.
    Columns in ``on`` must agree as well, and a text may stand once for each value of them.
    Empty names name nobody.
    """
    options = (
        names.where("name IS NOT NULL AND name <> ''")
        .select("name_id", "name", *on, F.explode(_anchors(F.col("name"))).alias("anchor"))
        .withColumn("key", _key(F.col("anchor.kind"), F.col("anchor.piece")))
    )
    keyed_texts = (
        _keyed(texts, options, on)
        .where(_passes(F.col("key"), _filter(options)))
        .withColumn("part", F.pmod(F.xxhash64("text_id"), F.lit(PARTS)))
        .repartition(*on, "key", "part")
    )
    # Counting ids, not rows, keeps both readings of the keys alike, so that Spark shuffles once.
    counts = keyed_texts.groupBy(*on, "key", "part").agg(F.count("text_id").alias("texts"))
    counts = counts.groupBy(*on, "key").agg(F.sum("texts").alias("texts"))
    keyed_names = (
        options.join(counts, [*on, "key"], "left")
        .groupBy("name_id", "name", *on)
        .agg(F.min_by("key", F.struct(F.coalesce("texts", F.lit(0)), "key")).alias("key"))
        .withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(PARTS - 1).cast("long"))))
    )
    candidates = keyed_texts.join(keyed_names, [*on, "key", "part"])
    candidates = candidates.select("text_id", "name_id", "name", *on).distinct()
    return (
        candidates.join(texts.select("text_id", "text", *on), ["text_id", *on])
        .where(F.contains("text", "name"))
        .select("text_id", "name_id")
    )


def first_contained(texts: DataFrame, names: DataFrame) -> DataFrame:
    """First name by ``name_id`` contained in each text; texts without one are left out."""
    return (
        contained_names(texts, names)
        .groupBy("text_id")
        .agg(F.min("name_id").alias("name_id"))
    )


def _key(kind: Column, piece: Column) -> Column:
    """Join key; a clash of hashes only adds a pair that the final test removes."""
    return F.xxhash64(kind, piece)


def _anchors(name: Column) -> Column:
    """Pieces that every text with the name must have, each with its kind."""
    parts = F.split(name, " ")
    count = F.size(parts)

    def option(kind: str, piece: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), piece.alias("piece"))

    last = F.element_at(parts, -1)
    single = F.array(option(INSIDE, F.right(last, F.lit(MAX_PIECE))))
    pair = F.array(option(START, F.left(last, F.lit(MAX_PIECE))))
    several = F.transform(F.slice(parts, 2, F.greatest(count - 2, F.lit(0))), lambda w: option(WORD, w))
    return F.array_distinct(F.when(count == 1, single).when(count == 2, pair).otherwise(several))


def _filter(options: DataFrame) -> Column:
    """Bits of the keys of all names, as one array whose size does not depend on them."""
    bits = options.select(
        F.pmod(F.shiftright("key", 6), F.lit(FILTER_WORDS)).cast("int").alias("word"),
        F.expr("shiftleft(1L, cast(key & 63 as int))").alias("bits"),
    )
    none = options.sparkSession.range(FILTER_WORDS).select(F.col("id").cast("int").alias("word"), F.lit(0).cast("long").alias("bits"))
    whole = bits.unionByName(none).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    entries = F.sort_array(F.collect_list(F.struct("word", "bits")))
    return whole.agg(F.transform(entries, lambda e: e["bits"])).scalar()


def _passes(key: Column, bits: Column) -> Column:
    """Whether some name may have the key."""
    word = F.get(bits, F.pmod(F.shiftright(key, 6), F.lit(FILTER_WORDS)).cast("int"))
    return F.getbit(word, key.bitwiseAND(F.lit(63)).cast("int")) == 1


def _keyed(texts: DataFrame, options: DataFrame, on: tuple[str, ...]) -> DataFrame:
    """``text_id, key`` for the words of texts, of the kinds and lengths of anchors that names use.

    Spark finds these before it reads texts; there are ``MAX_PIECE`` lengths of a kind at most. Pieces
    of words are a branch of their own, which reads no text where no name asks for them.
    """

    def lengths(kind: str) -> Column:
        of = F.when(F.col("anchor.kind") == kind, F.length("anchor.piece"))
        return options.agg(F.collect_set(of)).scalar()

    def words(rows: DataFrame, *more: Column) -> DataFrame:
        return rows.select("text_id", *on, *more, F.explode(F.split("text", " ")).alias("word"))

    by_word = words(texts.where(options.agg(F.bool_or(F.col("anchor.kind") == WORD)).scalar()))
    by_word = by_word.select("text_id", *on, _key(F.lit(WORD), F.col("word")).alias("key"))
    starts, insides = lengths(START), lengths(INSIDE)
    pieces = words(texts.where(F.size(starts) + F.size(insides) > 0)).withColumns(
        {"starts": starts, "insides": insides}
    )
    return by_word.unionByName(pieces.select("text_id", *on, F.explode(_pieces(F.col("word"))).alias("key")))


def _pieces(word: Column) -> Column:
    """Keys of the pieces of a word, by the lengths in ``starts`` and ``insides``."""
    of_starts = F.transform(
        F.filter("starts", lambda n: F.length(word) >= n), lambda n: _key(F.lit(START), F.left(word, n))
    )
    of_insides = F.transform(
        F.filter("insides", lambda n: F.length(word) >= n),
        lambda n: F.transform(
            F.sequence(F.lit(1), F.length(word) - n + 1), lambda i: _key(F.lit(INSIDE), F.substr(word, i, n))
        ),
    )
    return F.concat(of_starts, F.flatten(of_insides))
