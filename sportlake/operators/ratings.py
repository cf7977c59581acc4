"""Player ratings: an ordered recurrence over the matches of each player.

With ``w`` the weight of the pitch time and ``c`` the contribution in the match, a rating
moves from ``r`` to ``w * (c + r) / 2``. That is an affine map of ``r``, and affine maps
compose associatively. So the matches of a player are the leaves of a tree over the calendar: chunks of
one day, periods of days, the player. Maps are composed up the tree; then
the rating at the start of each node is handed down from its parent, and the chunks are run through
independently. Where a match belongs follows from its date and id alone, so nothing is
ordered or numbered over a player's matches. A list holds the children of a node: those of a player are the
periods of the calendar that were played in, however many matches these hold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import codes
from ..functions import age_rounded

#: Days of a period, and match ids of a day that fall into one chunk.
PERIOD_DAYS = 64
CHUNK_ROWS = 64
SLICE_NODES = 128


def player_match(appearances: DataFrame, ratios: DataFrame) -> DataFrame:
    """Appearances with the ratios of the same match; 0 where a player has no events."""
    measures = [c for c in ratios.columns if c not in ("match_id", "player_id")]
    return (
        appearances.join(ratios, ["match_id", "player_id"], "left")
        .fillna(0, subset=measures)
    )


def with_age(rows: DataFrame, players: DataFrame) -> DataFrame:
    """Adds the age on the match day. Players without a birth date are not rated."""
    births = players.select("player_id", "birth_date").where(F.col("birth_date").isNotNull())
    return (
        rows.join(births, "player_id")
        .withColumn("age", age_rounded("birth_date", "match_date"))
        .drop("birth_date")
    )


_MINUTES = "(end_minute - start_minute)"
_GAIN = "((pa + de + fk_eff + target) / 4)"
_LOST = f"({codes.FOUL_PENALTY}D * fouls + {codes.OWN_GOAL_PENALTY}D * own_goals)"

#: Weight of an appearance by its minutes, and contribution of a match by its ratios. Shots on target
#: enter as a count; shot effectiveness does not enter at all.
WEIGHT = f"""CASE WHEN {_MINUTES} = {codes.FULL_MATCH} THEN {codes.FULL_MATCH_BONUS}D
                 ELSE {_MINUTES} / {codes.FULL_MATCH} END"""
CONTRIBUTION = f"{_GAIN} - {_LOST} * {_GAIN}"


def match_steps(rows: DataFrame) -> DataFrame:
    """Weight and contribution per played match, the input of the recurrence."""
    return rows.where("played AND match_date IS NOT NULL").selectExpr(
        "player_id",
        "match_id",
        "match_date",
        "team_id",
        "age",
        f"{WEIGHT} AS weight",
        f"{CONTRIBUTION} AS contribution",
    )


def history(
    steps: DataFrame, period_days: int = PERIOD_DAYS, chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """Rating after every match, in order of match date and id.

    A chunk holds the matches of a player on one day whose ids share ``id div chunk_rows``.
    """
    chunks = _chunks(steps, chunk_rows)
    leaves = chunks.selectExpr("player_id", "day", "part", "size(steps) AS played", f"{_COMPOSE} AS map")
    periods = _parents(
        leaves.withColumn("period", F.expr(f"floor(day / {period_days})")), ["period"], ["day", "part"]
    )
    players = _parents(_nodes(periods, ["period"]), [], ["period"]).selectExpr(
        "player_id", "children", f"{codes.START_RATING}D AS seed", "0 AS played_before"
    )
    of_periods = _seeds(players)
    of_chunks = _seeds(periods.join(of_periods, ["player_id", "period"]))
    return (
        chunks.join(of_chunks, ["player_id", "day", "part"])
        .selectExpr("player_id", f"inline({_RUN})")
        .select(
            "player_id", "match_id", "match_date", "team_id", "rating", "delta", "matches", "age"
        )
    )


def _chunks(steps: DataFrame, chunk_rows: int) -> DataFrame:
    step = "struct(match_date, match_id, team_id, age, weight, contribution)"
    # The chunks are read twice, for their maps and for the run. Saying what the join on
    # the keys implies here keeps both readings alike, so that Spark shuffles once.
    return (
        steps.where("player_id IS NOT NULL AND match_date IS NOT NULL AND match_id IS NOT NULL")
        .withColumn("day", F.expr("bigint(unix_date(match_date))"))
        .withColumn("part", F.expr(f"floor(match_id / {chunk_rows})"))
        .where("day IS NOT NULL AND part IS NOT NULL")
        .groupBy("player_id", "day", "part")
        .agg(F.expr(f"array_sort(collect_list({step})) AS steps"))
    )


# The composed map of a chunk: rating at its end = scale * rating at its start + shift.
_COMPOSE = """
    aggregate(
      steps,
      named_struct('scale', 1D, 'shift', 0D),
      (map, step) -> named_struct(
        'scale', step.weight / 2 * map.scale,
        'shift', step.weight / 2 * (map.shift + step.contribution)
      )
    )"""

# The same for a node from its children, with the number of matches.
_COMPOSE_CHILDREN = """
    aggregate(
      children,
      named_struct('played', 0, 'map', named_struct('scale', 1D, 'shift', 0D)),
      (acc, child) -> named_struct(
        'played', acc.played + child.played,
        'map', named_struct(
          'scale', child.map.scale * acc.map.scale,
          'shift', child.map.scale * acc.map.shift + child.map.shift)
      )
    )"""


def _parents(nodes: DataFrame, parent: list[str], own: list[str]) -> DataFrame:
    """Nodes by parent, as a list in order of their own keys."""
    known = " AND ".join(f"{c} IS NOT NULL" for c in ["player_id", *parent])
    child = F.struct(*own, "played", "map")
    return nodes.where(known).groupBy("player_id", *parent).agg(F.array_sort(F.collect_list(child)).alias("children"))


def _nodes(parents: DataFrame, keys: list[str]) -> DataFrame:
    """The parents as nodes themselves."""
    return parents.select("player_id", *keys, F.expr(_COMPOSE_CHILDREN).alias("node")).select(
        "player_id", *keys, "node.played", "node.map"
    )


def _seeds(parents: DataFrame) -> DataFrame:
    """Rating and number of matches before each child, from those before the parent.

    The fold appends to a list, which copies it, so a long list of children is folded in slices.
    """
    element = parents.schema["children"].dataType.elementType
    own = [f.name for f in element.fields if f.name not in ("played", "map")]
    seeds = f"array<struct<{', '.join(f'{c}: bigint' for c in own)}, seed: double, played_before: int>>"
    keys = ", ".join(f"'{c}', child.{c}" for c in own)
    of_slice = f"""
        aggregate(
          part,
          named_struct(
            'seeds', cast(array() AS {seeds}),
            'rating', element_at(done, -1).rating,
            'played', element_at(done, -1).played
          ),
          (acc, child) -> named_struct(
            'seeds', concat(acc.seeds, array(named_struct(
              {keys}, 'seed', acc.rating, 'played_before', acc.played))),
            'rating', child.map.scale * acc.rating + child.map.shift,
            'played', acc.played + child.played
          )
        )"""
    folded = f"""
        aggregate(
          transform(
            sequence(0, (size(children) - 1) div {SLICE_NODES}),
            i -> slice(children, int(i * {SLICE_NODES} + 1), {SLICE_NODES})
          ),
          array(named_struct('seeds', cast(array() AS {seeds}), 'rating', seed, 'played', played_before)),
          (done, part) -> concat(done, array({of_slice})),
          done -> flatten(done.seeds)
        )"""
    return parents.selectExpr("player_id", f"inline({folded})")


# The rated matches of a chunk, from its seed on.
_NEXT = "step.weight * ((step.contribution + acc.rating) / 2)"


def on_grid(rating: str) -> str:
    """SQL for a rating on the grid, on which its changes, and sums of them below 32, have no rounding errors.

    What the tree hands down and what a stream runs through one by one differ in the last bits; on the grid
    they are the same number but where they lie on either side of its middle.
    """
    return f"(rint({rating} * {codes.RATING_GRID}D) / {codes.RATING_GRID}D)"


_RUN = f"""
    aggregate(
      steps,
      named_struct(
        'rated', cast(array() AS
          array<struct<match_id: bigint, match_date: date, team_id: string, rating: double,
                       delta: double, matches: int, age: int>>),
        'rating', seed,
        'matches', played_before
      ),
      (acc, step) -> named_struct(
        'rated', concat(acc.rated, array(named_struct(
          'match_id', step.match_id, 'match_date', step.match_date, 'team_id', step.team_id,
          'rating', {on_grid(_NEXT)}, 'delta', {on_grid(_NEXT)} - {on_grid('acc.rating')},
          'matches', acc.matches + 1, 'age', step.age))),
        'rating', {_NEXT},
        'matches', acc.matches + 1
      ),
      acc -> acc.rated
    )"""


def latest(rated: DataFrame) -> DataFrame:
    """Rating of each player after the last match."""
    values = ["rating", "delta", "matches", "age"]
    return (
        rated.groupBy("player_id")
        .agg(F.max_by(F.struct(*values), F.struct("match_date", "match_id")).alias("last"))
        .select("player_id", "last.*")
    )


def current_match(rated: DataFrame, player_matches: DataFrame) -> DataFrame:
    """Rated matches next to their ratios and minutes."""
    measures = player_matches.drop("match_date", "team_id", "age")
    return rated.join(measures, ["match_id", "player_id"])
