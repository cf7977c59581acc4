"""Chemistry: a coefficient per pair of players who met in matches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import codes

BLOCK_ROWS = 256


def deltas(rated: DataFrame) -> DataFrame:
    """Rating changes per match, the input of the pairs."""
    return rated.select("match_id", "player_id", "team_id", "delta")


def pairs(changes: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Every two players of the same match once, ``player_a < player_b``.

    The pairs are the result itself: a match of ``n`` players has ``n (n - 1) / 2``. Squads
    bound ``n``, so the join on the match grows with the number of appearances. A match
    with more rows than ``block_rows`` is cut into blocks of players and every two blocks
    meet under a join key of their own, which spreads that match over many tasks.
    """
    sizes = (
        changes.groupBy("match_id")
        .agg(F.expr(f"ceil(count(*) / {block_rows}) AS blocks"))
        .where("blocks > 1")
    )
    placed = (
        changes.join(sizes, "match_id", "left")
        .selectExpr(
            *changes.columns,
            "pmod(xxhash64(player_id), coalesce(blocks, 1)) AS block",
            "explode(sequence(0L, coalesce(blocks, 1) - 1)) AS other",
        )
        .selectExpr(
            "match_id",
            "least(block, other) AS low",
            "greatest(block, other) AS high",
            "block",
            "player_id",
            "team_id",
            "delta",
        )
    )
    # Two players of one block share many cells and meet in the diagonal one only.
    meet = F.expr(
        """a.match_id = b.match_id AND a.low = b.low AND a.high = b.high
           AND a.player_id < b.player_id AND (a.block <> b.block OR a.low = a.high)"""
    )
    return (
        placed.alias("a")
        .join(placed.alias("b"), meet)
        .selectExpr(
            "a.match_id",
            "a.player_id AS player_a",
            "b.player_id AS player_b",
            f"{_CONTRIBUTION} AS contribution",
        )
    )


# What one shared match adds to a pair's coefficient. Team mates gain by changing alike and
# lose by strictly opposite changes; for opponents it is the other way round. A change of
# zero is opposite to nothing.
_MEAN = "(a.delta + b.delta) / 2"
_OPPOSITE = "(a.delta > 0 AND b.delta < 0 OR a.delta < 0 AND b.delta > 0)"
_TOGETHER = f"CASE WHEN {_OPPOSITE} THEN -abs({_MEAN}) ELSE {_MEAN} END"
_CONTRIBUTION = f"""
    CASE WHEN a.team_id = b.team_id THEN {_TOGETHER} ELSE -({_TOGETHER}) END"""


def contributions(paired: DataFrame) -> DataFrame:
    """Sum of contributions per pair; sums of disjoint sets of matches add up."""
    return paired.groupBy("player_a", "player_b").agg(
        F.sum("contribution").alias("contribution")
    )


def coefficients(summed: DataFrame) -> DataFrame:
    """Coefficient per pair from its summed contributions."""
    return summed.select(
        "player_a",
        "player_b",
        (codes.START_CHEMISTRY + F.col("contribution")).alias("coeff"),
    )


def chemistry(rated: DataFrame) -> DataFrame:
    """Coefficient of every pair that shared a match."""
    return coefficients(contributions(pairs(deltas(rated))))


def mirrored(coeffs: DataFrame) -> DataFrame:
    """Both directions of every pair."""
    return coeffs.selectExpr(
        """inline(array(
             struct(player_a, player_b, coeff),
             named_struct('player_a', player_b, 'player_b', player_a, 'coeff', coeff)))"""
    )
