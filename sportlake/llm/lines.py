"""Near-equal lines by a deletion-neighbourhood join, in SQL functions only.

Two lines are near if one edit (a character replaced, inserted or deleted) turns one into the
other. Deleting one character from each, at the right places, then leaves equal strings, so
the hashes of all such strings are join keys. A line of n characters has n of them, each n long;
so deletion starts with windows: a line without one of its halves is hashed first, and only
halves whose remainder another line shares are cut into eighths, and so on, down to windows
of at most ``SMALL`` characters, in which single characters are deleted. Near lines share
the remainder at every level, and each level passes on the few lines that do.

Lines that share a key with a replaced character are near each other; lines that share one
with an insertion are near the line without it. So a key needs its earliest member only, not
pairs, and a key that very many lines share sends one row from each task.

With a bound of k > 1 edits a line is cut into k + 1 segments, one of which the edits leave
whole, so that it stands in the near line at most k places off. Lines that share a segment
are compared with the earliest one first; only lines that this leaves meet all others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sportlake.llm.tables import stored

#: Characters of a window in which single characters are deleted, and windows at each level.
SMALL, PARTS = 16, (8, 8, 8)


def _windows(parts: int) -> Column:
    """Numbers of the windows of a segment with ``w`` characters (one more if ``d`` is 1)."""
    return F.expr(f"sequence(0, cast(ceil(w / ceil(w / {parts}D)) as int) - 1)")


def _cut(segments: DataFrame, parts: int) -> DataFrame:
    """Every segment without one of its windows (as a hash, ``ctx``), and that window."""
    keep = [c for c in segments.columns if c not in ("ctx", "w", "segment")]
    return (
        segments.withColumn("step", F.expr(f"cast(ceil(w / {parts}D) as int)"))
        .withColumn("i", F.explode(_windows(parts)))
        .withColumn("low", F.expr("i * step"))
        .withColumn("high", F.expr("least(w, low + step)"))
        .select(
            *keep,
            F.expr(
                "xxhash64(ctx, w, i, substring(segment, 1, low),"
                " substring(segment, high + d + 1, w - high))"
            ).alias("ctx"),
            F.expr("high - low").alias("w"),
            F.expr("substring(segment, low + 1, high - low + d)").alias("segment"),
        )
    )


def _shared(segments: DataFrame) -> DataFrame:
    """Contexts of several lines, at least one of them of the shorter length."""
    return (
        segments.groupBy("ctx")
        .agg(F.min("line_id").alias("low"), F.max("line_id").alias("high"), F.min("d").alias("least"))
        .where("low != high and least = 0")
        .select("ctx")
    )


def _bases(least: int) -> Column:
    """d = 0: as the shorter line of a pair or one of two equally long; 1: as the longer."""
    long = f"if(length(line) > {least}, array(0, 1), array(0))"
    return F.explode(F.expr(f"if(length(line) < {least}, array(), {long})")).alias("d")


def _segments(lines: DataFrame, least: int) -> DataFrame:
    return lines.select("line_id", "line", _bases(least)).select(
        "line_id",
        "d",
        F.lit(0).cast("long").alias("ctx"),
        F.expr("length(line) - d").alias("w"),
        F.col("line").alias("segment"),
    )


def _near_by_segments(found: DataFrame, least: int, edits: int) -> DataFrame:
    """``line_id`` of the lines of ``found`` (line_id, place, line) near an earlier one."""
    count = edits + 1
    # Of the whole segments some i has at most i edits before it and edits - i after it, so it is
    # s places off in a line longer by d, with |s| <= i and |d - s| <= edits - i.
    shifts = range(-edits, edits + 1)
    shifts = {i: [(d, s) for d in range(count) for s in shifts if abs(s) <= i and abs(d - s) <= edits - i] for i in range(count)}
    own = [f"struct(0 as probe, {i} as i, 0 as d, 0 as s)" for i in range(count)]
    own += [f"struct(1 as probe, {i} as i, {d} as d, {s} as s)" for i in range(count) for d, s in shifts[i]]
    low = f"((x.i * n) div {count})"
    high = f"(((x.i + 1) * n) div {count})"
    keyed = (
        found.where(F.length("line") >= least)
        .select("line_id", "line", F.explode(F.expr(f"array({', '.join(own)})")).alias("x"))
        .withColumn("n", F.expr("length(line) - x.d"))
        .where(F.expr(f"n >= {least} and {low} + x.s >= 0 and {high} + x.s <= length(line)"))
        .select(
            "line_id",
            "x.probe",
            F.expr(f"xxhash64(n, x.i, substring(line, cast({low} + x.s + 1 as int), cast({high} - {low} as int)))").alias("key"),
        )
    )
    # Keys alone first: most have one line only.
    shared = keyed.groupBy("key").agg(
        F.min("line_id").alias("low"), F.max("line_id").alias("high"), F.bit_or(F.col("probe") + 1).alias("kinds")
    )
    shared = stored(shared.where("low != high and kinds = 3").select("key"), "shared")
    keyed = keyed.join(shared, "key", "left_semi").distinct().join(found.select("line_id", "place"), "line_id")
    keyed = stored(keyed, "segments")
    member = F.struct("place", "line_id")
    first = keyed.groupBy("key").agg(
        F.min(F.when(F.col("probe") == 0, member)).alias("own"),
        F.min(F.when(F.col("probe") == 1, member)).alias("other"),
    )
    keyed = keyed.join(first, "key")
    left = found.select("line_id", "line")
    right = found.select(F.col("line_id").alias("earlier"), F.col("line").alias("earlier_line"))

    def near(pairs: DataFrame) -> DataFrame:
        met = pairs.distinct().join(left, "line_id").join(right, "earlier")
        return met.where(F.levenshtein("line", "earlier_line", edits) >= 0).select("line_id").distinct()

    rival = F.expr("if(probe = 0, other, own)")
    pairs = keyed.withColumn("rival", rival).where("rival.place < place")
    early = stored(near(pairs.select("line_id", F.col("rival.line_id").alias("earlier"))), "near-first")
    rest = pairs.join(early, "line_id", "left_anti").select("key", "line_id", "place", "probe")
    others = keyed.select(
        "key", F.col("line_id").alias("earlier"), F.col("place").alias("before"), (1 - F.col("probe")).alias("probe")
    )
    pairs = rest.join(others, ["key", "probe"]).where("before < place").select("line_id", "earlier")
    return early.unionByName(near(pairs))


def _lines_of(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """The lines at ``row, number`` of ``wanted`` (with line_id, place), read from ``texts``."""
    wanted = wanted.groupBy("row").agg(F.collect_set(F.struct("number", "line_id", "place")).alias("wanted"))
    found = (
        texts.select("row", "lines")
        .join(wanted, "row")
        .select("lines", F.explode("wanted").alias("x"))
        .select("x.line_id", "x.place", F.expr("lines[x.number]").alias("line"))
        .dropDuplicates(["line_id"])
    )
    return stored(found, "near-lines")


def _near_by_windows(texts: DataFrame, classes: DataFrame, least: int) -> DataFrame:
    """``line_id`` of the lines of ``classes`` (line_id, place, keys) one edit from an earlier one."""
    halved = classes.select("line_id", "place", F.inline("keys"))
    shared = stored(_shared(halved), "contexts")
    wanted = halved.join(shared, "ctx", "left_semi").select("place.row", "place.number", "line_id", "place")
    found = _lines_of(texts, wanted)

    segments = _cut(_segments(found, least), 2).join(shared, "ctx", "left_semi")
    for parts in PARTS:
        segments = stored(segments, "windows")
        cut = stored(_cut(segments.where(F.col("w") > SMALL), parts), "cut")
        cut = cut.join(_shared(cut), "ctx", "left_semi")
        segments = segments.where(F.col("w") <= SMALL).unionByName(cut)
    segments = stored(segments, "windows")

    without = "concat(substring(segment, 1, i), substring(segment, i + 2))"
    places = F.expr("if(length(segment) > 0, sequence(0, length(segment) - 1), array())")
    deleted = segments.withColumn("i", F.explode(places))
    keyed = (
        deleted.where("d = 0")
        .select("line_id", "d", F.lit("replaced").alias("kind"), F.expr(f"xxhash64('r', ctx, i, {without})").alias("key"))
        .unionByName(
            deleted.where("d = 1").select(
                "line_id", "d", F.lit("longer").alias("kind"), F.expr(f"xxhash64('i', ctx, {without})").alias("key")
            )
        )
        .unionByName(
            segments.where("d = 0").select(
                "line_id", "d", F.lit("longer").alias("kind"), F.expr("xxhash64('i', ctx, segment)").alias("key")
            )
        )
        .distinct()
        .join(found.select("line_id", "place"), "line_id")
    )
    keyed = stored(keyed, "deletions")
    own = F.struct("place", "line_id")
    best = keyed.groupBy("key").agg(
        F.min(F.when(F.col("d") == 0, own)).alias("short"),
        F.min(F.when(F.col("d") == 1, own)).alias("long"),
        F.count("*").alias("members"),
    )
    rival = F.expr("if(kind = 'longer' and d = 0, long, short)")
    pairs = (
        keyed.join(best.where("members > 1"), "key")
        .withColumn("rival", rival)
        .where("rival.place < place")
        .select("line_id", F.col("rival.line_id").alias("earlier"))
        .distinct()
    )
    left = found.select("line_id", "line")
    right = found.select(F.col("line_id").alias("earlier"), F.col("line").alias("earlier_line"))
    return (
        pairs.join(left, "line_id")
        .join(right, "earlier")
        .where(F.levenshtein("line", "earlier_line", 1) == 1)
        .select("line_id")
        .distinct()
    )


def near_lines(docs: DataFrame, least: int = 20, edits: int = 1) -> DataFrame:
    """Lines of ``docs`` (doc_id, text, more columns) that repeat an earlier line.

    Lines end at a newline and are ordered by doc_id (null last), a hash of the text, and
    their number in the text. A line goes if an earlier one is equal, or if an earlier one is
    within ``edits`` edits and both have at least ``least`` characters; whether the earlier line
    itself stays does not matter. Empty lines stay and remove nothing.

    Returns ``row, doc_id, n_lines, n_removed, removed`` for each row: ``removed`` lists the
    numbers of the lines that go, from 0; ``row`` is a hash of id and text. Null texts have no
    line, empty texts one that is empty. Rows repeated with equal id and text count as one
    text, and get the same result.
    """
    row = F.xxhash64("doc_id", "text").alias("row")
    texts = docs.select(row, F.col("doc_id").cast("long").alias("doc_id"), F.split("text", "\n").alias("lines"))
    lines = texts.select("row", "doc_id", F.posexplode("lines").alias("number", "line")).where("line != ''")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row", "number").alias("place")
    halves = F.expr(
        f"""transform(
            filter(array(0, 1), d -> length(line) - d >= {least}),
            d -> struct(d, length(line) - d as w, cast(ceil((length(line) - d) / 2D) as int) as step))"""
    )
    keys = F.expr(
        """flatten(transform(halves, h -> array(
            struct(h.d as d, xxhash64(0L, h.w, 0, '', substring(line, h.step + h.d + 1, h.w - h.step)) as ctx),
            struct(h.d as d, xxhash64(0L, h.w, 1, substring(line, 1, h.step), '') as ctx))))"""
    )
    lines = stored(
        lines.withColumn("halves", halves).select(place, F.xxhash64("line").alias("line_id"), keys.alias("keys")),
        "lines",
    )
    # One row for each different line: its earliest place.
    classes = lines.groupBy("line_id").agg(F.min(F.struct("place", "keys")).alias("first"))
    classes = stored(classes.select("line_id", "first.place", "first.keys"), "line-classes")
    if edits == 1:
        gone = _near_by_windows(texts, classes, least)
    else:
        found = _lines_of(texts, classes.select("place.row", "place.number", "line_id", "place"))
        gone = _near_by_segments(found, least, edits).distinct()
    gone = gone.withColumn("near", F.lit(True))
    kept = classes.select("line_id", F.col("place").alias("first")).join(gone, "line_id", "left")
    removed = (
        lines.select("place", "line_id")
        .join(kept, "line_id")
        .where("near or place != first")
        .groupBy("place.row")
        .agg(F.array_sort(F.collect_set("place.number")).alias("removed"))
    )
    counts = docs.select(
        row, "doc_id", F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).cast("long").alias("n_lines")
    )
    none = F.array().cast("array<int>")
    return (
        counts.withColumn("n_lines", F.greatest("n_lines", F.lit(0).cast("long")))
        .join(removed, "row", "left")
        .withColumn("removed", F.coalesce("removed", none))
        .select("row", "doc_id", "n_lines", F.size("removed").cast("long").alias("n_removed"), "removed")
    )


def without_near_lines(docs: DataFrame, least: int = 20, edits: int = 1) -> DataFrame:
    """``docs`` with the lines that ``near_lines`` lists taken out of ``text``."""
    found = near_lines(docs, least, edits).select("row", "removed").where("size(removed) > 0")
    found = found.dropDuplicates(["row"])
    keyed = docs.withColumn("__row", F.xxhash64("doc_id", "text"))
    found = found.select(F.col("row").alias("__row"), F.col("removed").alias("__removed"))
    joined = keyed.join(found, "__row", "left")
    rest = F.expr(
        """if(__removed is null, text, array_join(
            transform(filter(transform(split(text, '\\n'), (l, i) -> struct(l, i)),
                             x -> not array_contains(__removed, x.i)), x -> x.l), '\\n'))"""
    )
    return joined.withColumn("text", rest).select(*docs.columns)
