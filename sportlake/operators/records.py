"""From raw JSON lines to typed match and event records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas


def label_lines(lines: DataFrame) -> DataFrame:
    """Adds ``is_match``, ``is_event`` and ``is_bad`` to lines with a ``value`` column.

    A record is what its top-level keys say: ``wyId`` makes a match and ``eventId`` an
    event, whatever the values; both make both. Text that is no JSON object is bad and
    is kept for a quarantine table instead of failing the job.
    """
    keys = F.json_object_keys("value")
    return (
        lines.withColumn("keys", keys)
        .withColumn("is_match", F.coalesce(F.array_contains("keys", "wyId"), F.lit(False)))
        .withColumn("is_event", F.coalesce(F.array_contains("keys", "eventId"), F.lit(False)))
        .withColumn("is_bad", F.col("keys").isNull())
        .drop("keys")
    )


def parsed(lines: DataFrame) -> DataFrame:
    """Labelled lines with ``record``, the fields of both kinds from one parse; null for other lines.

    What takes lines takes these as well, without parsing them again, so a job that keeps them
    parses a line once, whatever it reads from it.
    """
    record = F.when(F.col("is_match") | F.col("is_event"), F.from_json("value", _RECORD))
    return label_lines(lines).withColumn("record", record)


def compact(lines: DataFrame) -> DataFrame:
    """Parsed lines to be kept in memory: the text of bad lines only, ``record`` of matches only.

    What ``event_records`` reads lies in columns of its own, as ``EVENT_COLUMNS``.
    """
    carried = [c for c in lines.columns if c not in ("value", "record")]
    match = F.struct(*[f"record.{name}" for name in schemas.MATCH.names])
    typed = event_columns(lines.select(*lines.columns, *[f"record.{name}" for name in schemas.EVENT.names]), *lines.columns)
    return typed.select(
        *carried,
        F.when(F.col("is_bad"), F.col("value")).alias("value"),
        F.when(F.col("is_match"), match).alias("record"),
        *EVENT_COLUMNS,
    )


EVENT_COLUMNS = ("event_code", "sub_event", "match_id", "player_id", "tags")
_RECORD = T.StructType([*schemas.MATCH.fields, *schemas.EVENT.fields])
_PARSED = ("is_match", "is_event", "is_bad", "record")


def match_records(lines: DataFrame) -> DataFrame:
    """Typed matches; other columns of the lines, such as an arrival order, stay."""
    return _typed(lines, F.col("is_match"), schemas.MATCH)


def first_matches(lines: DataFrame, order: list[str]) -> DataFrame:
    """Typed matches, each in the first form sent, by the given columns of the lines.

    Appearances start from these, so that a match sent again is not played twice.
    """
    return first_per_key(match_records(lines), ["wyId"], order).drop(*order)


def event_records(lines: DataFrame, *carried: str) -> DataFrame:
    """Typed events as ``event_code, sub_event, match_id, player_id, tags``; columns ``carried`` stay."""
    if "event_code" in lines.columns:  # compact lines
        return lines.where("is_event").select(*carried, *EVENT_COLUMNS)
    return event_columns(_typed(lines, F.col("is_event"), schemas.EVENT), *carried)


def event_columns(records: DataFrame, *carried: str) -> DataFrame:
    """Engine names for the fields of typed event records."""
    return records.select(
        *carried,
        F.col("eventId").alias("event_code"),
        F.col("subEventId").alias("sub_event"),
        F.col("matchId").alias("match_id"),
        F.col("playerId").alias("player_id"),
        F.col("tags.id").alias("tags"),
    )


def bad_lines(lines: DataFrame) -> DataFrame:
    """Quarantine: the lines that hold no JSON object."""
    labelled = lines if "record" in lines.columns else label_lines(lines)
    return labelled.where("is_bad").drop(*_PARSED, *EVENT_COLUMNS)


def _typed(lines: DataFrame, kind: Column, schema: T.StructType) -> DataFrame:
    rows = lines if "record" in lines.columns else parsed(lines)
    carried = [c for c in lines.columns if c not in ("value", *_PARSED, *EVENT_COLUMNS)]
    return rows.where(kind).select(*carried, *[f"record.{name}" for name in schema.names])


def first_per_key(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """First row of every key in the given order: a match sent twice keeps its first form.

    ``min_by`` combines before the shuffle, so a key with a great many copies sends one
    row per map task.
    """
    values = [c for c in rows.columns if c not in keys]
    return (
        rows.groupBy(*keys)
        .agg(
            F.min_by(
                F.struct(*[F.col(c).alias(c) for c in values]), F.struct(*order)
            ).alias("first")
        )
        .select(*keys, "first.*")
    )
