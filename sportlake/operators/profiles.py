"""Cumulative player profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOTALS = {
    "fouls": "fouls",
    "goals": "goals",
    "own_goals": "own_goals",
    "on_target": "shots_on_target",
    "anp": "anp",
    "akp": "akp",
    "np": "np",
    "kp": "kp",
}


def totals(counted: DataFrame) -> DataFrame:
    """Sums per player over all matches, from classified events or from counters."""
    return counted.groupBy("player_id").agg(
        *[F.sum(source).cast("long").alias(name) for source, name in TOTALS.items()]
    )


def final_profile(latest: DataFrame, summed: DataFrame) -> DataFrame:
    """The 13-column profile: latest rating next to the totals."""
    return latest.join(summed, "player_id").select(
        "player_id", "rating", "delta", "matches", "age", *TOTALS.values()
    )
