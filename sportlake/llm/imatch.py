"""I-Match fingerprints with randomised lexicons, in SQL functions only.

Terms are the distinct words of a text, hashed. A term belongs to the lexicon if its document
frequency lies in a band; every term hash is counted for itself. Of this lexicon many random
subsets are taken: the hash of a term chooses one of ``LEXICONS`` or, mostly, none. A text's fingerprint has
a value for each subset that holds any of its terms, the hash of the set of these; terms of a set are
combined by adding their hashes, which does not depend on order and so stands for hashing the sorted
terms. Texts of equal term sets agree in all values, and one differing term changes one value at most.

A term that no subset takes is never looked up, so a tenth of the terms of a text meet the
frequencies, by one join that is the same at every size. Terms above the band never reach it: they are as many as
a text has terms, divided by ``LARGEST``, at most. So no term of the join is in more than that share of the texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sportlake.llm.tables import stored

#: The band: least document frequency, largest share of all texts.
LEAST, LARGEST = 2, 0.1
#: Of ``OF`` terms ``TAKEN`` are in a subset of the lexicon; subsets.
TAKEN, OF, LEXICONS = 12, 128, 256
#: Texts in a bucket of neighbouring ids; buckets up to which that holds, beyond them buckets grow.
BUCKET, BUCKETS = 4096, 1 << 16
#: Bits of term hashes that are added up.
_LOW = (1 << 40) - 1


def _terms(text: str) -> str:
    """SQL for the hashes of the distinct words of a text column."""
    words = f"filter(split(lower({text}), '[\\\\x20\\\\x09-\\\\x0D]+'), w -> w != '')"
    return f"array_distinct(transform({words}, w -> xxhash64(w)))"


def _taken(terms: str) -> str:
    """SQL for those of some terms that a subset of the lexicon takes."""
    return f"filter({terms}, t -> (xxhash64(t, 77L) & {OF - 1}) < {TAKEN})"


def _every(terms: str) -> Column:
    """All terms of a text as one number, null without any."""
    return F.expr(f"if(size({terms}) > 0, aggregate({terms}, 0L, (s, t) -> s + (t & {_LOW})), null)")


def lexicon(texts: DataFrame, least: int = LEAST, largest: float = LARGEST) -> DataFrame:
    """Terms of at least ``least`` texts that a subset takes: ``in_band``, or not as they are in too many."""
    # Every text adds to the null term, which so counts texts.
    terms = F.explode(F.expr(f"concat(array(cast(null as bigint)), {_taken(_terms('text'))})"))
    counts = texts.select(terms.alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    counts = stored(counts.where((F.col("df") >= least) | F.col("term").isNull()), "frequencies")
    total = counts.where("term is null").first()
    bound = largest * (total["df"] if total else 0)
    known = counts.where(F.col("term").isNotNull() & (F.col("df") >= least))
    return known.select("term", (F.col("df") <= bound).alias("in_band"))


def _values(entries: DataFrame, known: DataFrame) -> DataFrame:
    """``row, own, edited``: values of both texts of a row, from ``row, flag, term``.

    ``flag`` has bit 0 for terms of the text and bit 1 for those of its edit. A value is the number of its
    subset and 32 bits of hash; lists ascend.
    """
    above = known.where("not in_band").select("term")  # bounded, see above
    near = entries.join(F.broadcast(above), "term", "left_anti")
    kept = near.join(known.where("in_band").select("term"), "term")
    # All that follows groups by the row first, so this is the only shuffle of it.
    sides = kept.repartition("row").select(
        "row",
        "term",
        F.expr(f"shiftrightunsigned(xxhash64(term, 77L), 7) & {LEXICONS - 1}").alias("subset"),
        F.explode(F.expr("filter(array(1, 2), s -> (flag & s) != 0)")).alias("side"),
    )
    sums = sides.groupBy("row", "side", "subset").agg(F.sum(F.expr(f"term & {_LOW}")).alias("total"))
    value = F.expr("shiftleft(subset, 32) | (xxhash64(total) & 4294967295L)")
    of = lambda side: F.sort_array(F.collect_list(F.when(F.col("side") == side, value)))
    return sums.groupBy("row").agg(of(1).alias("own"), of(2).alias("edited"))


def printed(every: str, values: str) -> Column:
    """The fingerprint as text: a hash of all terms, or a dash, and then subset and hash of each value."""
    digits = lambda x, n: f"lower(lpad(hex({x}), {n}, '0'))"
    whole = F.expr(f"if({every} is null, '-', {digits(f'xxhash64({every}) & 4294967295L', 8)})")
    return F.concat_ws(".", whole, F.expr(f"transform({values}, v -> {digits('v', 10)})"))


def likeness(a: str, a_every: str, b: str, b_every: str) -> Column:
    """Share of equal values among the subsets of which either text has terms.

    Without any, the texts are alike if all their terms are the same.
    """
    subsets = f"array_distinct(transform(concat({a}, {b}), v -> shiftright(v, 32)))"
    share = f"cast(size(array_intersect({a}, {b})) as double) / size({subsets})"
    return F.expr(f"if(size({a}) + size({b}) > 0, {share}, if({a_every} <=> {b_every}, 1D, 0D))")


_ENTRIES = "transform({terms}, t -> named_struct('flag', {flag}, 'term', t))"


def fingerprints(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``doc_id, fingerprint`` for each row of ``docs`` (doc_id, text, more columns).

    Null texts count as empty; without terms a fingerprint has no value. Equal texts have
    equal fingerprints. Repeated rows give repeated results; ids may be null.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    known = stored(lexicon(texts), "lexicon") if known is None else known
    rows = texts.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.expr(_terms("text")).alias("terms"))
    entries = F.expr(_ENTRIES.format(terms=_taken("terms"), flag=1)).alias("entries")
    rows = stored(rows.select("row", "doc_id", _every("terms").alias("every"), entries), "terms")
    found = _values(rows.select("row", F.inline("entries")), known)
    joined = rows.drop("entries").join(found, "row", "left").withColumn("own", _none_if_null("own"))
    return joined.select("doc_id", printed("every", "own").alias("fingerprint"))


def _none_if_null(values: str) -> Column:
    return F.coalesce(F.col(values), F.array().cast("array<bigint>"))


def _bucketed(texts: DataFrame) -> DataFrame:
    """Texts by buckets of neighbouring ids, each closed by the first text of the next bucket.

    ``guest`` marks that text; the last bucket's is the first text of all. Texts without id follow all
    others in buckets by the hash that orders them.
    """
    count, nulls = texts.agg(F.count("*"), F.count_if(F.col("doc_id").isNull())).first()
    wanted = max(1, min(BUCKETS, count // BUCKET))
    side = max(1, round(wanted**0.5))
    shares = [i / (side * side) for i in range(1, side * side)]
    splits = []
    if shares:
        splits = texts.agg(F.percentile_approx("doc_id", shares, 100 * side * side).alias("s")).first()["s"] or []
    splits = sorted(set(splits))
    groups = [splits[i : i + side] for i in range(0, len(splits), side)] or [[]]
    longs = lambda xs: "array(" + ", ".join(f"{x}L" for x in xs) + ")" if xs else "array(9223372036854775807L)"
    # Two short searches instead of one over all splits: the group, then the place in it.
    coarse = f"size(filter({longs([g[-1] for g in groups if g])}, s -> s < doc_id))"
    fine = f"get(array({', '.join(map(longs, [*groups, []]))}), {coarse})"
    place = f"{coarse} * {side} + size(filter({fine}, s -> s < doc_id))"
    # The hash ascends, and buckets are taken in descending order.
    unnamed = max(1, min(BUCKETS, nulls // BUCKET))
    by_hash = f"-1 - int(floor((rid / 18446744073709551616D + 0.5D) * {unnamed}))"
    texts = texts.withColumn("bucket", F.expr(f"if(doc_id is null, {by_hash}, {place})"))
    firsts = texts.groupBy("bucket").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("x"), F.bitwise_not("doc_id").alias("y"), "rid", "row")).alias("f")
    )
    firsts = firsts.select("bucket", "f.row").orderBy(F.desc("bucket")).collect()  # one a bucket
    guests = [(firsts[(i + 1) % len(firsts)]["row"], r["bucket"]) for i, r in enumerate(firsts)]
    guests = texts.sparkSession.createDataFrame(guests, "row bigint, closes int")
    places = F.expr("if(closes is null, array(bucket), array(bucket, closes))")
    return (
        texts.join(F.broadcast(guests), "row", "left")
        .withColumn("nth", F.explode(F.expr("if(closes is null, array(0), array(0, 1))")))
        .withColumn("bucket", F.get(places, F.col("nth")))
        .withColumn("guest", F.col("nth") == 1)
    )


def compared(docs: DataFrame) -> DataFrame:
    """Fingerprints of texts, of edited texts, and how alike they are.

    The edited text has the last third of its code points (rounded down) replaced by the
    first as many, or all, of the next document's in descending doc_id (null last, ties by a
    hash of the text); the last is followed by the first. Returns ``doc_id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` for each row.

    Null texts count as empty. A text alone is its own next one. An empty table gives none.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.withColumn("rid", F.xxhash64("doc_id", "text"))
    texts = texts.withColumn("row", F.monotonically_increasing_id())
    known = stored(lexicon(texts), "lexicon")
    order = W.partitionBy("bucket").orderBy("guest", F.col("doc_id").desc_nulls_last(), "rid", "row")
    if texts.isEmpty():
        bucketed = texts.selectExpr("*", "0 as bucket", "false as guest")
    else:
        bucketed = _bucketed(texts)
    following = (
        bucketed.withColumn("next_row", F.lead("row").over(order))
        .withColumn("next_text", F.lead("text").over(order))
        .where("not guest")
        .withColumn("n_chars", F.length("text").cast("long"))
    )
    edited = F.expr(
        "concat(substring(text, 1, cast(n_chars - n_chars div 3 as int)),"
        " substring(next_text, 1, cast(n_chars div 3 as int)))"
    )
    following = following.withColumn("edited", edited)
    following = following.withColumn("terms", F.expr(_terms("text"))).withColumn("new_terms", F.expr(_terms("edited")))
    following = following.withColumn("a", F.expr(_taken("terms"))).withColumn("b", F.expr(_taken("new_terms")))
    # A term that text and edit share is looked up once.
    parts = (("array_intersect(a, b)", 3), ("array_except(a, b)", 1), ("array_except(b, a)", 2))
    entries = F.concat(*[F.expr(_ENTRIES.format(terms=terms, flag=flag)) for terms, flag in parts])
    rows = following.select(
        "row",
        "next_row",
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        _every("terms").alias("every"),
        _every("new_terms").alias("edited_every"),
        entries.alias("entries"),
    )
    rows = stored(rows, "edits")
    found = _values(rows.select("row", F.inline("entries")), known)
    prints = rows.drop("entries").join(found, "row", "left")
    prints = stored(prints.withColumns({name: _none_if_null(name) for name in ("own", "edited")}), "prints")
    following = prints.select(F.col("row").alias("next_row"), F.col("every").alias("next_every"), F.col("own").alias("next_own"))
    return prints.join(following, "next_row").select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        printed("every", "own").alias("fingerprint"),
        printed("edited_every", "edited").alias("edited_fingerprint"),
        likeness("own", "every", "edited", "edited_every").alias("near_edited"),
        likeness("own", "every", "next_own", "next_every").alias("near_next"),
    )
