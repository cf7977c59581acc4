"""Appearances next to their events by a join of two streams, with state that is freed in time.

Lines carry ``sent_at``. A line sent more than the delay before the newest line of earlier batches is late: it
goes to a table of its own, and the join never waits for it. All other lines are on time, so
the join's watermark drops none of them. Both sides are held as long as the other may still send a partner.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import codes
from ..operators import appearances as appearance_ops
from ..operators import events as event_ops
from ..operators import ratings as rating_ops
from ..operators import records as record_ops
from . import tables
from .jobs import APPEARANCES, INTERVAL, _start, stream

DELAY, REACH, SLOT = "2 days", "2 days", "1 hour"
LINES = "value string, sent_at timestamp"
#: A line of both kinds that records nothing. Sources that fall silent send it, so that time goes on.
HEARTBEAT = '{"wyId": null, "eventId": null}'
JOINED = f"{APPEARANCES}, " + ", ".join(f"{c} long" for c in codes.COUNTERS)


def start_arrivals(
    lines: DataFrame, out: str, checkpoint: str, delay: str = DELAY, interval: str | None = INTERVAL
) -> StreamingQuery:
    """Parts lines (``value, sent_at``) into the tables ``on_time`` and ``late``.

    A line without time is late. The newest time of each batch is a table of one row a batch.
    """

    def keep(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.select("value", "sent_at").persist()
        times = tables.read(spark, out, "arrival_times", "newest timestamp", batch_id - 1)
        bound = times.agg(F.max("newest") - F.expr(f"INTERVAL {delay}")).scalar()
        late = F.coalesce(F.col("sent_at") < bound, F.col("sent_at").isNull(), F.lit(False))
        marked = batch.withColumn("late", late)
        tables.write(marked.where("NOT late").drop("late"), out, "on_time", batch_id)
        tables.write(marked.where("late").drop("late"), out, "late", batch_id)
        tables.write(batch.agg(F.max("sent_at").alias("newest")), out, "arrival_times", batch_id)
        batch.unpersist()

    return _start(lines, "append", keep, checkpoint, interval)


def start_player_match(
    session: SparkSession,
    out: str,
    checkpoint: str,
    delay: str = DELAY,
    reach: str = REACH,
    slot: str = SLOT,
    interval: str | None = INTERVAL,
    max_files: int | None = None,
) -> StreamingQuery:
    """Joins appearances with the counters of events sent within ``reach`` of their match's record.

    Events are summed by slots of time before they are joined, so state holds a row for each
    player, match and slot. Of a match sent again within the delay the form that comes first counts. An
    appearance without events comes out once the watermark has passed its reach.
    """
    lines = stream(session, out, "on_time", LINES, max_files)
    lines = lines.select("value", "sent_at").withWatermark("sent_at", delay)
    matches = record_ops.match_records(lines).dropDuplicatesWithinWatermark(["wyId"])
    listed = appearance_ops.appearances(matches, "sent_at")
    classified = event_ops.classify(record_ops.event_records(lines, "sent_at"), "sent_at")
    counted = (
        classified.groupBy(F.window("sent_at", slot), "match_id", "player_id")
        .agg(*[F.sum(c).alias(c) for c in codes.COUNTERS])
        .select(
            F.window_time("window").alias("counted_at"),
            F.col("match_id").alias("of_match"),
            F.col("player_id").alias("of_player"),
            *codes.COUNTERS,
        )
    )
    near = f"""match_id = of_match AND player_id = of_player
               AND counted_at >= sent_at - INTERVAL {reach} AND counted_at <= sent_at + INTERVAL {reach}"""
    joined = listed.join(counted, F.expr(near), "left").drop("of_match", "of_player", "counted_at", "sent_at")

    def keep(batch: DataFrame, batch_id: int) -> None:
        tables.write(batch, out, "joined", batch_id)

    return _start(joined, "append", keep, checkpoint, interval)


def player_match(spark: SparkSession, out: str, players: DataFrame) -> DataFrame:
    """Appearances that came out, with the ratios of their events and the player's age."""
    rows = tables.read(spark, out, "joined", JOINED)
    of = [c for c in rows.columns if c not in (*codes.COUNTERS, "batch_id")]
    summed = rows.groupBy(*of).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in codes.COUNTERS])
    ratios = event_ops.ratios(summed, *[c for c in of if c not in ("match_id", "player_id")])
    return rating_ops.with_age(ratios, players)
