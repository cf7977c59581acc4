"""Keyed state of streams: first forms of matches, ratings, and the pairs of a match.

Each processor takes rows that say what holds now, with the batch that says so as their version. A row
that comes twice, or after a newer one, changes nothing, so a replay upstream does no harm.
"""

from __future__ import annotations

import math
import pickle
import sys
from collections.abc import Iterator
from itertools import combinations

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.stateful_processor import ValueState

from ..codes import RATING_GRID, START_RATING

# Processors travel with the query, so workers need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

APPEARANCE = """match_id long, player_id long, match_date date, team_id string, start_minute int,
    end_minute int, played boolean, batch_id long"""
CHANGED = """player_id long, match_id long, match_date date, team_id string, age int, rating double,
    delta double, matches int, old_rating double, old_delta double"""
PAIR = "match_id long, player_a long, player_b long, change double"
_Changed = Row(*(column.split()[0] for column in CHANGED.split(",")))
_Pair = Row(*(column.split()[0] for column in PAIR.split(",")))

#: Matches of a player that one row of state holds, the newest ones; it is halved when it has more.
KEPT = 128


def on_grid(rating: float) -> float:
    """A rating on the grid, as ``operators.ratings`` has it in columns."""
    return round(rating * RATING_GRID) / RATING_GRID if math.isfinite(rating) else rating


class FirstForm(StatefulProcessor):
    """Passes the appearances of a match from the first batch that has any, and none of later ones.

    State: one number for each match.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._first = handle.getValueState("first", "batch_id long")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        rows = list(rows)  # the squads of one match
        known = self._first.get()
        if known is not None:
            first = known[0]
        else:
            first = min(row["batch_id"] for row in rows)
            self._first.update((first,))
        yield from (row for row in rows if row["batch_id"] <= first)

    def close(self) -> None:
        pass


class Ratings(StatefulProcessor):
    """Ratings of a player after each match, kept up to date whatever the order of arrival.

    State: a step for each match of the player, with all that its rating follows from and the match
    before it, and what is known of each match. A call to the state costs far more than the work on a match, so the
    newest of both lie in one row, ``recent``, of at most ``KEPT`` each; older ones are in a map, a row for each match.
    The matches form a chain that is followed backwards from the last one to where something changed; a match
    that comes in order reads no other row, and a late one reads the steps after it only. From there the recurrence
    runs forward and stops as soon as a rating and its number stay as they were.

    Rows: ``kind`` 'listed' (an appearance with its weight) or 'counted' (a match's contribution).
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        step = "team_id string, age int, weight double, gain double, rating double, delta double, matches int"
        before = "before_date date, before_match long"
        self._recent = handle.getValueState("recent", "rows binary")
        self._steps = handle.getMapState("steps", "match_date date, match_id long", f"{step}, {before}")
        self._known = handle.getMapState("known", "match_id long", "match_date date, gain double, version long")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        listed, counted = {}, {}
        for row in rows:
            if row["kind"] == "listed":
                listed.setdefault(row["match_id"], row)
            elif row["match_id"] not in counted or row["batch_id"] >= counted[row["match_id"]]["batch_id"]:
                counted[row["match_id"]] = row
        held = self._recent.get()
        # Steps by (match_date, match_id), what is known by match_id, and whether the maps hold any.
        steps, known, older = pickle.loads(held[0]) if held is not None else ({}, {}, False)

        # New and changed steps by (match_date, match_id); None stands for what the state holds.
        fresh: dict[tuple, tuple | None] = {}
        gains: dict[tuple, float] = {}
        changed = False
        for match in listed.keys() | counted.keys():
            before, is_older = known.get(match), False
            if before is None and older:
                before = self._known.getValue((match,))
                is_older = before is not None
            before = date, gain, version = tuple(before or (None, 0.0, -1))
            if match in counted and counted[match]["batch_id"] >= version:
                gain, version = counted[match]["gain"], counted[match]["batch_id"]
            if match in listed and date is None:
                row = listed[match]
                date = row["match_date"]
                fresh[date, match] = (row["team_id"], row["age"], row["weight"])
            elif date is not None and gain != before[1]:
                fresh[date, match] = None
            if (date, match) in fresh:
                gains[date, match] = gain
            if (date, gain, version) != before:
                if is_older:
                    self._known.updateValue((match,), (date, gain, version))
                else:
                    known[match], changed = (date, gain, version), True
        if fresh:
            changed = True
            yield from self._run(key[0], fresh, gains, steps, older)
        if changed:
            older = self._halve(steps, known) or older
            self._recent.update((pickle.dumps((steps, known, older), pickle.HIGHEST_PROTOCOL),))

    def _run(self, player: int, fresh: dict, gains: dict, steps: dict, older: bool) -> Iterator[Row]:
        earliest, latest = min(fresh), max(fresh)
        at = max(steps, default=None)
        oldest = min(steps) if older and steps else None  # whatever the map holds lies before it
        stored = {}
        while at is not None and at >= earliest:
            stored[at] = self._step(at, steps)
            before = stored[at][-2:]
            at = before if before[0] is not None else None
        rating, matches = START_RATING, 0
        if at is not None:
            _, _, _, _, rating, _, matches, _, _ = self._step(at, steps)
        before = at
        for place in sorted(stored.keys() | fresh.keys()):
            old = stored.get(place)
            team, age, weight = fresh.get(place) or old[:3]
            gain = gains[place] if place in gains else old[3]
            after = weight * ((gain + rating) / 2)
            change = on_grid(after) - on_grid(rating)
            rating, matches = after, matches + 1
            step = (team, age, weight, gain, rating, change, matches, *(before or (None, None)))
            if old != step:
                if oldest is None or place >= oldest:
                    steps[place] = step
                else:
                    self._steps.updateValue(place, step)
            if old is None or (old[4], old[5], old[6]) != step[4:7]:
                was = (on_grid(old[4]), old[5]) if old else (None, None)
                yield _Changed(player, place[1], place[0], team, age, on_grid(rating), change, matches, *was)
            elif place > latest:
                break  # what follows is as it was
            before = place

    def _step(self, place: tuple, steps: dict) -> tuple:
        return steps[place] if place in steps else tuple(self._steps.getValue(place))

    def _halve(self, steps: dict, known: dict) -> bool:
        """Moves the older half of what has grown too long to the maps; tells whether anything moved."""
        moved = False
        if len(steps) > KEPT:
            for place in sorted(steps)[: len(steps) - KEPT // 2]:
                self._steps.updateValue(place, steps.pop(place))
            moved = True
        if len(known) > KEPT:
            for match in list(known)[: len(known) - KEPT // 2]:
                self._known.updateValue((match,), known.pop(match))
            moved = True
        return moved

    def close(self) -> None:
        pass


def rated(rows: DataFrame) -> DataFrame:
    """Changed ratings of a stream of ``kind, batch_id, gain`` and appearance columns."""
    return rows.groupBy("player_id").transformWithState(
        statefulProcessor=Ratings(), outputStructType=CHANGED, outputMode="Append", timeMode="None"
    )


def first_forms(appearances: DataFrame) -> DataFrame:
    """Appearances of a stream without those in matches that an earlier batch had sent."""
    return appearances.select(*T.StructType.fromDDL(APPEARANCE).names).groupBy("match_id").transformWithState(
        statefulProcessor=FirstForm(), outputStructType=APPEARANCE, outputMode="Append", timeMode="None"
    )


def contribution(same_team: bool, a: float, b: float) -> float:
    """What two rating changes add to a pair, as ``operators.chemistry`` has it in columns."""
    mean = (a + b) / 2
    together = -abs(mean) if a > 0 > b or a < 0 < b else mean
    return together if same_team else -together


class _Cell:
    """The players of a cell, as a map that is read and written in one piece."""

    def __init__(self, state: ValueState) -> None:
        self._state = state

    def iterator(self) -> Iterator[tuple]:
        held = self._state.get()
        self._players = pickle.loads(held[0]) if held is not None else {}
        return iter(list(self._players.items()))

    def updateValue(self, player: tuple, value: tuple) -> None:
        self._players[player] = value

    def write(self) -> None:
        self._state.update((pickle.dumps(self._players, pickle.HIGHEST_PROTOCOL),))


class Pairs(StatefulProcessor):
    """Changes of the pairs of a match: minus what they added before, plus what they add now.

    State: team and rating change of each player of the match in this cell, in one row. Only pairs of a player
    whose change is new are worked out.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._held = _Cell(handle.getValueState("held", "players binary"))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        match, low, high = key
        old = {player[0]: tuple(value) for player, value in self._held.iterator()}
        new = dict(old)
        for row in rows:
            player = row["player_id"]
            if player not in new or row["batch_id"] >= new[player][3]:
                new[player] = (row["team_id"], row["delta"], row["block"], row["batch_id"])
        changed = {player for player, value in new.items() if old.get(player, (None,) * 4)[:2] != value[:2]}
        for player, value in new.items():
            if old.get(player) != value:
                self._held.updateValue((player,), value)
        if new != old and isinstance(self._held, _Cell):
            self._held.write()
        for a, b in combinations(sorted(new), 2):
            if a not in changed and b not in changed:
                continue
            if low != high and new[a][2] == new[b][2]:
                continue  # they meet in the cell of their own block
            change = contribution(new[a][0] == new[b][0], new[a][1], new[b][1])
            if a in old and b in old:
                change -= contribution(old[a][0] == old[b][0], old[a][1], old[b][1])
            yield _Pair(match, a, b, change)

    def close(self) -> None:
        pass


def pair_changes(changes: DataFrame, blocks: int = 1) -> DataFrame:
    """Signed contributions of pairs from changed ratings with their ``batch_id``.

    ``blocks`` cuts the players of a match into blocks of which every two meet in a cell
    of their own, so that no cell holds a large match whole. It must stay the same for a checkpoint.
    """
    return (
        changes.selectExpr(
            "match_id", "player_id", "team_id", "delta", "batch_id",
            f"pmod(xxhash64(player_id), {blocks}) AS block",
            f"explode(sequence(0L, {blocks - 1}L)) AS other",
        )
        .selectExpr("*", "least(block, other) AS low", "greatest(block, other) AS high")
        .groupBy("match_id", "low", "high")
        .transformWithState(
            statefulProcessor=Pairs(), outputStructType=PAIR, outputMode="Append", timeMode="None"
        )
    )
