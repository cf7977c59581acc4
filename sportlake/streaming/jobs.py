"""Streaming jobs: lines in, tables out.

Every table is a folder with one part per micro-batch (see ``tables``), which a replayed
batch overwrites. So a job that is restarted from its checkpoint leaves the same tables as
one that never stopped. Readers combine the parts.

``start_facts`` and ``start_counters`` turn lines into tables of facts. ``start_ratings`` keeps
ratings, the curve and predictions up to date from these, and ``start_chemistry`` the pairs from changed
ratings; both hold keyed state, so what they read in a batch follows the batch, not the history.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import codes, schemas
from ..operators import appearances as appearance_ops
from ..operators import chemistry as chemistry_ops
from ..operators import events as event_ops
from ..operators import models as model_ops
from ..operators import profiles as profile_ops
from ..operators import ratings as rating_ops
from ..operators import records as record_ops
from . import state, tables
from .tables import write as _write

INTERVAL = "100 seconds"

COUNTERS = "match_id long, player_id long, " + ", ".join(f"{c} long" for c in codes.COUNTERS)
EVENTS = "event_code int, sub_event int, match_id long, player_id long, tags array<int>"
SENT = ("sent_at", "sent_in", "sent_from")
APPEARANCES = state.APPEARANCE.rpartition(",")[0]
CURVE = "age int, n long, rating_sum double"
PAIRS = "player_a long, player_b long, contribution double"
PREDICTIONS = "age int, rating double"

#: Schema of each table that parts of many batches make up, and how they merge.
MERGED = {
    "counters": (COUNTERS, tables.last_of(["match_id", "player_id"])),
    "fact_counts": (COUNTERS, tables.sum_of(["match_id", "player_id"])),
    "rating_changes": (state.CHANGED, tables.last_of(["player_id", "match_id"])),
    "pair_changes": (PAIRS, tables.sum_of(["player_a", "player_b"])),
    "curve_changes": (CURVE, tables.sum_of(["age"])),
    "predictions": (PREDICTIONS, tables.last_of(["age"])),
}


def stream_session(spark: SparkSession, partitions: int | None = None) -> SparkSession:
    """Session of the same application with the settings that state needs.

    The number of partitions is fixed with the first batch of a checkpoint.
    """
    session = spark.newSession()
    session.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    session.conf.set("spark.sql.session.timeZone", "UTC")
    if partitions is not None:
        session.conf.set("spark.sql.shuffle.partitions", str(partitions))
    return session


def read_lines(
    spark: SparkSession, path: str, max_files: int | None = None
) -> DataFrame:
    """JSON lines of a folder that grows, with the time and place they were sent from.

    Any other line source with ``value`` will do.
    """
    reader = spark.readStream.format("text")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.load(path).selectExpr(
        "value",
        "_metadata.file_modification_time AS sent_at",
        "_metadata.file_path AS sent_in",
        "_metadata.file_block_start AS sent_from",
    )


# Jobs -------------------------------------------------------------------------------------


def start_records(
    lines: DataFrame, out: str, checkpoint: str, interval: str | None = INTERVAL
) -> StreamingQuery:
    """Keeps typed matches and events, and the malformed lines in quarantine."""

    def keep(batch: DataFrame, batch_id: int) -> None:
        parsed = record_ops.compact(_parsed(batch)).persist()
        _write(_first_matches(parsed), out, "matches", batch_id)
        _write(record_ops.event_records(parsed), out, "events", batch_id)
        _write(record_ops.bad_lines(parsed).select("value"), out, "bad_lines", batch_id)
        parsed.unpersist()

    return _start(lines, "append", keep, checkpoint, interval)


def start_counters(
    lines: DataFrame, out: str, checkpoint: str, interval: str | None = INTERVAL
) -> StreamingQuery:
    """Keeps counters per match and player with the engine's own aggregation state."""
    counted = event_ops.counters(event_ops.classify(record_ops.event_records(lines)))

    def keep(batch: DataFrame, batch_id: int) -> None:
        _write(batch, out, "counters", batch_id)

    return _start(counted, "update", keep, checkpoint, interval)


def start_facts(
    lines: DataFrame,
    out: str,
    checkpoint: str,
    interval: str | None = INTERVAL,
    after: Callable[[int], None] | None = None,
) -> StreamingQuery:
    """Keeps the facts that ratings follow from: counters and appearances of each batch.

    Nothing is rated while records still arrive, and no state is held, so it does not matter
    whether events come before, with or after the record of their match, or in which order
    matches come. Each batch is read once and writes what it alone holds; ``ratings`` and
    the tables after it apply the batch operators to all facts.
    """

    def keep(batch: DataFrame, batch_id: int) -> None:
        parsed = record_ops.compact(_parsed(batch)).persist()
        counted = event_ops.counters(event_ops.classify(record_ops.event_records(parsed)))
        _write(counted, out, "fact_counts", batch_id)
        listed = appearance_ops.appearances(_first_matches(parsed))
        _write(listed, out, "fact_appearances", batch_id)
        parsed.unpersist()

    return _start(lines, "append", keep, checkpoint, interval, after)


def start_ratings(
    session: SparkSession,
    out: str,
    players: DataFrame,
    checkpoint: str,
    interval: str | None = INTERVAL,
    max_files: int | None = None,
    after: Callable[[int], None] | None = None,
) -> StreamingQuery:
    """Keeps rating changes, curve statistics and predictions from the tables of facts.

    A match counts in the first form sent, each player's ratings follow in keyed state whatever the order of arrival,
    and only ratings that change are written, next to what they were. Statistics of the curve add these
    differences up; predictions are those of the curve after the batch, for ages with a changed rating.
    ``players`` must belong to ``session``.
    """
    counted = stream(session, out, "counters", COUNTERS, max_files)
    gains = event_ops.ratios(counted, "batch_id").selectExpr(
        "player_id",
        "'counted' AS kind",
        "match_id",
        "CAST(NULL AS date) AS match_date",
        "CAST(NULL AS string) AS team_id",
        "CAST(NULL AS int) AS age",
        "CAST(NULL AS double) AS weight",
        f"{rating_ops.CONTRIBUTION} AS gain",
        "batch_id",
    )
    born = players.where("birth_date IS NOT NULL").select("player_id")
    first = state.first_forms(stream(session, out, "fact_appearances", APPEARANCES, max_files))
    listed = rating_ops.with_age(first.where("played AND match_date IS NOT NULL"), players).selectExpr(
        "player_id",
        "'listed' AS kind",
        "match_id",
        "match_date",
        "team_id",
        "age",
        f"{rating_ops.WEIGHT} AS weight",
        "0D AS gain",
        "batch_id",
    )
    rows = listed.unionByName(gains.join(born, "player_id", "left_semi"))

    def keep(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        _write(batch, out, "rating_changes", batch_id)
        # The state must run once per batch, so the rest starts from what was written.
        changes = spark.read.schema(state.CHANGED).parquet(tables.part(out, "rating_changes", batch_id))
        _write(model_ops.quadratic_changes(changes), out, "curve_changes", batch_id)
        stats = curve_sums(spark, out, batch_id)
        predicted = model_ops.predict_ages(stats, model_ops.solve_quadratic(stats))
        now = changes.select("age").distinct()
        _write(predicted.join(now, "age", "left_semi"), out, "predictions", batch_id)

    return _start(state.rated(rows), "append", keep, checkpoint, interval, after)


def start_chemistry(
    session: SparkSession,
    out: str,
    checkpoint: str,
    interval: str | None = INTERVAL,
    blocks: int = 1,
    max_files: int | None = None,
) -> StreamingQuery:
    """Keeps what the pairs of touched matches change by, from the changed ratings of ``start_ratings``."""
    changes = stream(session, out, "rating_changes", state.CHANGED, max_files)

    def keep(batch: DataFrame, batch_id: int) -> None:
        summed = chemistry_ops.contributions(batch.withColumnRenamed("change", "contribution"))
        _write(summed, out, "pair_changes", batch_id)

    return _start(state.pair_changes(changes, blocks), "append", keep, checkpoint, interval)


def stream(
    session: SparkSession, out: str, table: str, schema: str, max_files: int | None = None
) -> DataFrame:
    """A table as a stream of its parts. A replayed batch comes again, with the same ``batch_id``."""
    tables.create(session, out, table, schema)
    reader = session.readStream.schema(tables.with_batch(schema)).option("ignoreMissingFiles", "true")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.parquet(f"{out}/{table}").where(F.col("batch_id") > tables.NONE)


def _parsed(batch: DataFrame) -> DataFrame:
    """Lines of a batch, parsed once, with their order of arrival: files by their time, then lines."""
    known = [c for c in SENT if c in batch.columns]
    return record_ops.parsed(batch.select("value", *known, F.monotonically_increasing_id().alias("arrival")))


def _first_matches(lines: DataFrame) -> DataFrame:
    """Matches of a batch, in the first form sent."""
    return record_ops.first_matches(lines, [c for c in (*SENT, "arrival") if c in lines.columns])


def finish(query: StreamingQuery, timeout: int | None = None) -> None:
    """Waits for a job that stops by itself; fails if it does not within ``timeout`` seconds."""
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"stream still running after {timeout} s")


def _start(
    rows: DataFrame,
    mode: str,
    keep: Callable[[DataFrame, int], None],
    checkpoint: str,
    interval: str | None,
    after: Callable[[int], None] | None = None,
) -> StreamingQuery:
    """``after`` is called between a batch's last write and its commit."""

    def kept(batch: DataFrame, batch_id: int) -> None:
        keep(batch, batch_id)
        if after is not None:
            after(batch_id)

    writer = (
        rows.writeStream.outputMode(mode)
        .foreachBatch(kept)
        .option("checkpointLocation", checkpoint)
    )
    if interval is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()


# Tables -----------------------------------------------------------------------------------


def _merged(spark: SparkSession, out: str, table: str, upto: int | None = None) -> DataFrame:
    schema, merge = MERGED[table]
    return merge(tables.read(spark, out, table, schema, upto)).drop("batch_id")


def compact(spark: SparkSession, out: str, table: str, upto: int) -> None:
    """Merges the parts of a table up to batch ``upto``, which must be over."""
    schema, merge = MERGED[table]
    tables.compact(spark, out, table, schema, merge, upto)


def rating_changes(spark: SparkSession, out: str) -> DataFrame:
    """Current rating after each match, from the keyed state's changes."""
    columns = "player_id match_id match_date team_id rating delta matches age".split()
    return _merged(spark, out, "rating_changes").select(*columns)


def signed_chemistry(spark: SparkSession, out: str) -> DataFrame:
    """Current coefficients from the sums of signed contributions."""
    return chemistry_ops.coefficients(_merged(spark, out, "pair_changes"))


def curve_sums(spark: SparkSession, out: str, upto: int | None = None) -> DataFrame:
    """Current statistics of the rating-versus-age curve, summed by batches."""
    return _merged(spark, out, "curve_changes", upto).where("n > 0")


def predictions(spark: SparkSession, out: str) -> DataFrame:
    """Last prediction of each age; an age without a new one keeps the old."""
    return _merged(spark, out, "predictions")


def matches(spark: SparkSession, out: str) -> DataFrame:
    """Stored matches; the first form of a match stays."""
    stored = tables.read(spark, out, "matches", schemas.MATCH)
    return record_ops.first_per_key(stored, ["wyId"], ["batch_id"]).drop("batch_id")


def events(spark: SparkSession, out: str) -> DataFrame:
    """Stored events."""
    return tables.read(spark, out, "events", EVENTS).drop("batch_id")


def quarantine(spark: SparkSession, out: str) -> DataFrame:
    """Stored lines that hold no record."""
    return tables.read(spark, out, "bad_lines", "value string").drop("batch_id")


def counters(spark: SparkSession, out: str) -> DataFrame:
    """Current counters: the value of the last batch that changed a key."""
    return _merged(spark, out, "counters")


def _fact_appearances(spark: SparkSession, out: str) -> DataFrame:
    rows = tables.read(spark, out, "fact_appearances", APPEARANCES)
    first = rows.groupBy("match_id").agg(F.min("batch_id").alias("first_batch"))
    return rows.join(first, "match_id")


def ratings(spark: SparkSession, out: str, players: DataFrame) -> DataFrame:
    """Rating history from all facts so far; of a match sent again the first form counts."""
    listed = _fact_appearances(spark, out).where("batch_id = first_batch")
    counted = _merged(spark, out, "fact_counts")
    joined = rating_ops.player_match(listed.drop("batch_id", "first_batch"), event_ops.ratios(counted))
    return rating_ops.history(rating_ops.match_steps(rating_ops.with_age(joined, players)))


def repeated_appearances(spark: SparkSession, out: str) -> DataFrame:
    """Appearances in matches that an earlier batch had sent; they change no rating."""
    return (
        _fact_appearances(spark, out)
        .where("batch_id > first_batch")
        .select("player_id", "match_id", "match_date", "team_id", "batch_id")
    )


def chemistry(rated: DataFrame) -> DataFrame:
    """Current coefficients from ``ratings``."""
    return chemistry_ops.chemistry(rated)


def curve_stats(rated: DataFrame) -> DataFrame:
    """Current statistics of the rating-versus-age curve from ``ratings``."""
    return model_ops.quadratic_stats(rated)


def profile(spark: SparkSession, out: str, players: DataFrame) -> DataFrame:
    """Final profile from the tables of the jobs for facts and counters."""
    return profile_ops.final_profile(
        rating_ops.latest(ratings(spark, out, players)), profile_ops.totals(counters(spark, out))
    )
