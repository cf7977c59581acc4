"""Event classification and per-match counters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import codes


def _tagged(code: int) -> str:
    return f"coalesce(array_contains(tags, {code}), false)"


_ACCURATE = _tagged(codes.TAG_ACCURATE)
_KEY = _tagged(codes.TAG_KEY_PASS)
_GOAL = _tagged(codes.TAG_GOAL)
_PASS = f"event_code = {codes.PASS}"
_DUEL = f"event_code = {codes.DUEL}"
_SHOT = f"event_code = {codes.SHOT}"
_FREE_KICK = f"event_code = {codes.FREE_KICK}"
_FOUL = f"event_code = {codes.FOUL}"

# Condition under which an event counts, per counter.
CONDITIONS = {
    "anp": f"{_PASS} AND {_ACCURATE} AND NOT {_KEY}",
    "akp": f"{_PASS} AND {_ACCURATE} AND {_KEY}",
    "np": f"{_PASS} AND NOT {_KEY}",
    "kp": f"{_PASS} AND {_KEY}",
    "dw": f"{_DUEL} AND {_tagged(codes.TAG_WON)}",
    "nd": f"{_DUEL} AND {_tagged(codes.TAG_NEUTRAL)}",
    "td": _DUEL,
    "shots": _SHOT,
    "on_target_goal": f"{_SHOT} AND {_ACCURATE} AND {_GOAL}",
    "on_target_notgoal": f"{_SHOT} AND {_ACCURATE} AND NOT {_GOAL}",
    "on_target": f"{_SHOT} AND {_ACCURATE}",
    "fouls": _FOUL,
    "own_goals": _tagged(codes.TAG_OWN_GOAL),
    "free_kicks": _FREE_KICK,
    "eff_free_kicks": f"{_FREE_KICK} AND {_ACCURATE}",
    "penalties": f"{_FREE_KICK} AND sub_event = {codes.PENALTY} AND {_GOAL}",
    "goals": f"({_PASS} OR {_DUEL} OR {_SHOT} OR {_FREE_KICK} OR {_FOUL}) AND {_GOAL}",
}


def classify(events: DataFrame, *carried: str) -> DataFrame:
    """One row per event with 17 counters of 0 or 1 next to match and player.

    Goals count for the five known kinds of event only. An own goal counts for any event;
    events of other kinds add nothing else. The columns ``carried`` stay.
    """
    return events.selectExpr(
        *carried,
        "match_id",
        "player_id",
        *[f"CASE WHEN {CONDITIONS[c]} THEN 1 ELSE 0 END AS {c}" for c in codes.COUNTERS],
    )


def counters(classified: DataFrame) -> DataFrame:
    """Counter sums per match and player, each event counted once.

    Sums combine before the shuffle, so a player or match holding a large share of all
    events sends one row per map task.
    """
    return classified.groupBy("match_id", "player_id").agg(
        *[F.expr(f"sum({c}) AS {c}") for c in codes.COUNTERS]
    )


def ratios(counted: DataFrame, *carried: str) -> DataFrame:
    """Pass accuracy, duel, shot and free-kick effectiveness; 0 where nothing was tried.

    The columns ``carried`` stay.
    """

    def share(part: str, whole: str, name: str) -> str:
        return f"coalesce(try_divide(double({part}), double({whole})), 0D) AS {name}"

    return counted.selectExpr(
        *carried,
        "match_id",
        "player_id",
        share("anp + 2 * akp", "np + 2 * kp", "pa"),
        share("dw + nd * 0.5D", "td", "de"),
        share("on_target_goal + on_target_notgoal * 0.5D", "shots", "se"),
        "fouls",
        "own_goals",
        "on_target AS target",
        share("eff_free_kicks + penalties", "free_kicks", "fk_eff"),
        "goals",
        "anp",
        "akp",
        "np",
        "kp",
    )
