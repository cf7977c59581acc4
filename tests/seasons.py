"""Small seasons of match and event records, and plain-Python versions of the rules."""

from __future__ import annotations

import datetime
import json
import random

FIRST = datetime.date(2023, 8, 1)


def match_record(match, day, teams, **other):
    """JSON line of a match; ``teams`` maps a team id to (lineup, bench, substitutions)."""
    date = FIRST + datetime.timedelta(days=day)

    def member(entry):
        if isinstance(entry, dict):
            return entry
        return {
            "playerId": entry,
            "goals": "0",
            "ownGoals": "0",
            "redCards": "0",
            "yellowCards": "0",
        }

    record = {
        "wyId": match,
        "date": f"{date:%B} {date.day}, {date.year} at 3:00:00 PM GMT+1",
        "dateutc": f"{date} 14:00:00",
        "label": f"A{match} - B{match}, 1 - 0",
        "duration": "Regular",
        "winner": int(next(iter(teams))),
        "gameweek": 1,
        "venue": "Ground",
        "teamsData": {
            team: {
                "formation": {
                    "lineup": [member(p) for p in lineup],
                    "bench": [member(p) for p in bench],
                    "substitutions": subs
                    if isinstance(subs, str)
                    else [
                        {"playerIn": i, "playerOut": o, "minute": m} for i, o, m in subs
                    ],
                }
            }
            for team, (lineup, bench, subs) in teams.items()
        },
    }
    record.update(other)
    return json.dumps(record)


def event_record(match, player, code, tags=(), sub_event=0):
    return json.dumps(
        {
            "eventId": code,
            "subEventId": sub_event,
            "matchId": match,
            "playerId": player,
            "tags": [{"id": t} for t in tags],
        }
    )


def random_season(days=6, players=24, seed=7):
    """Per day the lines of its events and matches; two matches a day, shuffled squads."""
    rng = random.Random(seed)
    out = []
    for day in range(days):
        ids = list(range(1, players + 1))
        rng.shuffle(ids)
        half = players // 2
        events, matches = [], []
        for i, group in enumerate((ids[:half], ids[half:])):
            match = 100 * day + i
            teams = {}
            for side in (0, 1):
                squad = group[side::2]
                lineup, bench = squad[:-2], squad[-2:]
                subs = [(bench[0], lineup[0], rng.choice([30, 60, 90, 92]))]
                teams[str(10 * (i + 1) + side)] = (lineup, bench, subs)
            for _ in range(60):
                events.append(
                    event_record(
                        match,
                        rng.choice(group),
                        rng.choice([8, 8, 8, 1, 10, 3, 2, 7]),
                        [t for t in (101, 102, 302, 702, 703, 1801) if rng.random() < 0.3],
                        rng.choice([0, 35]),
                    )
                )
            matches.append(match_record(match, day, teams))
        out.append(events + matches)
    return out


def players_table(spark, numbers):
    rows = [(n, datetime.date(1990, 1, 1) + datetime.timedelta(days=97 * n)) for n in numbers]
    return spark.createDataFrame(rows, "player_id long, birth_date date")


def rated_by_loop(steps):
    """Rating, change and count after each (weight, contribution)."""
    rating, out = 0.5, []
    for n, (weight, gain) in enumerate(steps, 1):
        after = weight * ((gain + rating) / 2)
        out.append((after, after - rating, n))
        rating = after
    return out
