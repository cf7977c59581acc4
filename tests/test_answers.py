import datetime
import json

import pytest
from seasons import FIRST, match_record

from sportlake import schemas
from sportlake.operators import records
from sportlake.plans import answers
from sportlake.sources import files

PLAYERS = """player_id long, name string, birth_area string, birth_date date, foot string,
    role string, height int, passport_area string, weight int, file_order long"""


def _players(spark, named):
    """``named`` is a list of (id, name, role)."""
    born = datetime.date(1990, 1, 1)
    return spark.createDataFrame(
        [
            (i, name, "X", born, "left", role, 180, "X", 75, order)
            for order, (i, name, role) in enumerate(named)
        ],
        PLAYERS,
    )


def test_routes(spark):
    lines = spark.createDataFrame(
        [
            (json.dumps({"request_id": i, **kind}),)
            for i, kind in enumerate([{"req_type": 1}, {"req_type": 2}, {}, {"req_type": 8}])
        ],
        "value string",
    )
    routed = answers.route(files.parse_requests(lines))
    ids = {k: sorted(r.request_id for r in v.collect()) for k, v in routed.items()}
    assert ids == {"win_chance": [0], "profile": [1], "match": [2, 3]}


def test_request_members(spark):
    line = json.dumps(
        {
            "request_id": 5,
            "req_type": 1,
            "date": "2024-01-01",
            "team1": {"name": "P", "players": ["a", "b"]},
            "team2": {"name": "Q", "players": ["c"]},
        }
    )
    parsed = files.parse_requests(spark.createDataFrame([(line,)], "value string"))
    got = sorted((r.side, r.name) for r in answers.request_members(parsed).collect())
    assert got == [(1, "a"), (1, "b"), (2, "c")]


def test_request_members_as_sent(spark):
    line = """{"request_id": 6, "req_type": 1, "date": "2024-01-01",
        "team1": {"name": "P", "player1": "b", "player2": "a", "other": null},
        "team2": {"player1": "c", "name": "Q"}}""".replace("\n", " ")
    parsed = files.parse_requests(spark.createDataFrame([(line,)], "value string"))
    (request,) = parsed.collect()
    assert (request.team1.name, request.team1.players) == ("P", ["b", "a"])
    assert (request.team2.name, request.team2.players) == ("Q", ["c"])


def test_resolve_exact_then_contained(spark):
    players = _players(spark, [(3, "Ana Li", "GK"), (4, "Li", "DF"), (5, "Ana Li", "MD")])
    names = spark.createDataFrame(
        [("Ana Li",), ("Li",), ("Mrs Ana Li",), ("Lin Bo",), ("Bo",), ("Bo",)], "name string"
    )
    got = {r.name: r.player_id for r in answers.resolve_players(names, players).collect()}
    assert got == {"Ana Li": 3, "Li": 4, "Mrs Ana Li": 3, "Lin Bo": 4, "Bo": None}


def test_profiles(spark):
    players = _players(spark, [(1, "A", "GK"), (2, "B", "DF"), (3, "C", "DF")])
    profile = spark.createDataFrame(
        [(1, 0.5, 0.0, 3, 20, 4, 5, 1, 9, 70, 3, 90, 4), (2, 0.5, 0.0, 3, 20, 4, 5, 1, 9, 0, 0, 0, 0)],
        """player_id long, rating double, delta double, matches int, age int, fouls long,
           goals long, own_goals long, shots_on_target long, anp long, akp long, np long, kp long""",
    )
    asked = spark.createDataFrame(
        [(1, "A"), (2, "B"), (3, "C"), (4, "D")], "request_id long, name string"
    )
    got = {r.request_id: r for r in answers.player_profile(asked, players, profile).collect()}
    assert got[1].percent_pass_accuracy == int(76 / 98 * 100)
    assert (got[1].fouls, got[1].percent_shots_on_target) == (4, 9)
    assert (got[2].percent_pass_accuracy, got[2].goals) == (0, 5)
    assert (got[3].registered, got[3].goals) == (True, 0)
    assert (got[4].registered, got[4].goals, got[4].role) == (False, None, None)


def test_rosters(spark):
    roles = ["GK", "DF", "DF", "MD", "MD", "FW", "GK"]
    players = _players(spark, [(i, f"P{i}", role) for i, role in enumerate(roles)])
    rosters = {1: range(6), 2: range(7), 3: range(1, 6), 4: [0, 1, 2, 3, 4, 5, 77]}
    members = spark.createDataFrame(
        [(r, f"P{p}") for r, ps in rosters.items() for p in ps], "roster_id long, name string"
    )
    got = {r.roster_id: r for r in answers.roster_checks(members, players).collect()}
    assert {k: r.valid for k, r in got.items()} == {1: True, 2: False, 3: False, 4: True}
    assert (got[4].unknown, got[2].gk, got[1].md) == (1, 2, 2)


def _fixture(spark, rated):
    return spark.createDataFrame(
        rated, "fixture_id long, side int, player_id long, rating double"
    )


def test_win_chance_worked_example(spark):
    rated = _fixture(spark, [(1, 1, 1, 0.7), (1, 1, 2, 0.5), (1, 2, 3, 0.4)])
    none = spark.createDataFrame([], "player_a long, player_b long, coeff double")
    (row,) = answers.win_chance(rated, none).collect()
    assert (row.chance_1, row.chance_2) == pytest.approx((105.0, -5.0))
    (row,) = answers.win_chance(rated, none, centered=True).collect()
    assert (row.chance_1, row.chance_2) == pytest.approx((55.0, 45.0))


def test_win_chance_of_large_fixtures(spark):
    rated = [
        (f, side, p, 0.1 * (p % 7))
        for f, ps in {1: range(0, 40), 2: range(30, 36), 3: [1, 2, 2, 50]}.items()
        for p in ps
        for side in [1 + p % 2]
    ]
    known = [(a, b, 0.01 * (a - b)) for a in range(0, 45, 3) for b in range(a + 1, 45, 2)]
    chem = spark.createDataFrame(known, "player_a long, player_b long, coeff double")
    frame = _fixture(spark, rated)
    plain = sorted(answers.win_chance(frame, chem).collect())
    table = {(a, b): c for a, b, c in known}
    for row in plain:
        sides = [[r[2] for r in rated if r[:2] == (row.fixture_id, s)] for s in (1, 2)]
        coeffs = [table.get((min(a, b), max(a, b)), 0.5) for a in sides[0] for b in sides[1]]
        assert row.chem == pytest.approx(sum(coeffs) / len(coeffs))


def test_fixture_checks_in_order(spark):
    roles = ["GK", "DF", "DF", "MD", "MD", "FW"]
    named = [(10 * t + i, f"T{t}P{i}", r) for t in range(3) for i, r in enumerate(roles)]
    players = _players(spark, named)
    squads = {t: [f"T{t}P{i}" for i in range(6)] for t in range(3)}
    fixtures = {
        1: (squads[0], squads[1]),
        2: (squads[0][1:], squads[1][1:]),
        3: (squads[0], squads[1][1:]),
        4: (squads[0], squads[2]),
    }
    members = spark.createDataFrame(
        [
            (f, side, "2020-01-01", n)
            for f, teams in fixtures.items()
            for side, names in enumerate(teams, 1)
            for n in names
        ],
        "fixture_id long, side int, date string, name string",
    )
    latest = spark.createDataFrame([(20, -0.01)], "player_id long, rating double")
    none = spark.createDataFrame([], "player_a long, player_b long, coeff double")
    got = {
        r.fixture_id: (r.status, r.chance_1)
        for r in answers.fixture_answers(members, players, latest, none).collect()
    }
    assert got[1] == ("ok", pytest.approx((0.5 + 0.25 + 0.25) * 100))
    assert got[2] == ("team 1 invalid", None)
    assert got[3] == ("team 2 invalid", None)
    assert got[4] == ("retired players", None)

    requests = spark.createDataFrame(
        [
            (f, 1, "2020-01-01", None, None, ("Reds", teams[0]), ("Blues", teams[1]))
            for f, teams in {**fixtures, 5: ([], squads[0])}.items()
        ],
        schemas.REQUEST,
    )
    named = answers.win_chance_answers(requests, players, latest, none)
    got = {r.request_id: json.loads(r.answer) for r in answers.as_json(named).collect()}
    assert got[1]["team1"] == {"name": "Reds", "winning chance": pytest.approx(100.0)}
    assert got[1]["retired_names"] == [] and len(got[4]["retired_names"]) == 1
    assert got[1]["team2"] == {"name": "Blues", "winning chance": pytest.approx(0.0)}
    assert [got[n]["status"] for n in (2, 4, 5)] == [
        "team 1 invalid", "retired players", "team 1 invalid",
    ]


def test_fixtures_read_their_members_before_they_are_answered(spark, tmp_path):
    players = _players(spark, [(i, f"P{i}", "MD") for i in range(1, 8)])
    rows = [(1, 1, "P1"), (1, 1, "P2"), (1, 1, "P2"), (1, 2, "P3"), (1, 2, "P4"), (1, 2, "nobody"), (1, 2, None)]
    rows += [(2, 1, "P5"), (2, 2, "P6"), (3, 1, "P1"), (3, 2, "P7"), (None, 1, "P7"), (None, 2, "P1")]
    schema = "fixture_id long, side int, date string, name string"
    sent = spark.createDataFrame([(f, s, "2020-01-01", n) for f, s, n in rows], schema)
    sent.write.parquet(f"{tmp_path}/members")
    members = spark.read.schema(schema).parquet(f"{tmp_path}/members")
    latest = spark.createDataFrame([(1, 0.2), (3, 0.4), (5, 0.6), (7, -0.3)], "player_id long, rating double")
    # Player 2 has coefficients without a rating, player 5 a rating without coefficients.
    known = {(1, 3): 0.9, (2, 3): 0.7, (2, 4): 0.1}
    chem = spark.createDataFrame([(a, b, c) for (a, b), c in known.items()], "player_a long, player_b long, coeff double")
    found = answers.fixture_answers(members, players, latest, chem, quotas={"GK": (0, 0), "MD": (1, None)})
    assert not [f for f in found.inputFiles() if f"{tmp_path}/members" in f]
    got = {r.fixture_id: r for r in found.collect()}
    pairs = [(1, 3), (1, 4), (2, 3), (2, 4), (2, 3), (2, 4)]
    c = sum(known.get(p, 0.5) for p in pairs) / len(pairs)
    one, two = (0.2 + 0.5 + 0.5) / 3 * c, (0.4 + 0.5) / 2 * c
    assert got[1].status == "ok" and got[1].chance_1 == pytest.approx((0.5 + one + (one + two) / 2) * 100)
    assert got[2].chance_1 == pytest.approx((0.5 + 0.3 + (0.3 + 0.25) / 2) * 100)
    for fixture in (3, None):
        assert (got[fixture].status, got[fixture].retired_names, got[fixture].chance_1) == ("retired players", ["P7"], None)
    assert len(got) == 4


def test_fallback_ratings(spark):
    rated = spark.createDataFrame(
        [(1, 0.3, 20), (2, None, 20), (3, None, 99)], "player_id long, rating double, age int"
    )
    curve = spark.createDataFrame([(20, 0.7)], "age int, rating double")
    default = answers.fallback_rating(rated, curve).orderBy("player_id").collect()
    by_age = answers.fallback_rating(rated, curve, "age").orderBy("player_id").collect()
    assert [r.rating for r in default] == [0.3, 0.5, 0.5]
    assert [r.rating for r in by_age] == [0.3, 0.7, 0.5]
    with pytest.raises(ValueError):
        answers.fallback_rating(rated, curve, "none")


def _entry(player, goals="0", own="0", red="0", yellow="0"):
    return {
        "playerId": player, "goals": goals, "ownGoals": own, "redCards": red,
        "yellowCards": yellow,
    }


def test_match_details(spark):
    teams = {
        "30": ([_entry(1, goals="2"), _entry(2, red="44")], [_entry(3, goals="1")], []),
        "20": ([_entry(4, own="1", yellow="12"), _entry(5, goals=None, red="x")], [], []),
    }
    lines = [
        match_record(9, 0, teams, label="Bournemouth - Leeds, 3 - 0", winner=20),
        match_record(8, 1, teams, label="Bournemouth - Leeds, 3 - 0", winner=0),
        match_record(7, 0, teams, label="Leeds - Bournemouth, 0 - 3"),
    ]
    matches = records.match_records(spark.createDataFrame([(v,) for v in lines], "value string"))
    players = _players(spark, [(i, f"N{i}", "MD") for i in (1, 2, 3, 5)] + [(4, "N4", "DF")])
    day = [str(FIRST), str(FIRST + datetime.timedelta(days=1))]
    asked = spark.createDataFrame(
        [
            (1, day[0], "Bournmouth - Leeds, 3 - 0"),
            (2, day[1], "Bournemouth - Leeds"),
            (3, day[0][:7], "Bournemouth - Leeds"),
            (4, day[0], "Leeds - Leeds"),
            (5, "2020-01-01", "Bournemouth - Leeds"),
            (6, None, "Bournemouth - Leeds"),
        ],
        "request_id long, date string, label string",
    )
    got = {r.request_id: r for r in answers.match_details(asked, matches, players).collect()}
    assert sorted(got) == [1, 2, 3]
    first = got[1]
    assert (first.winner, first.date, first.venue) == ("Leeds", day[0], "Ground")
    assert [tuple(g) for g in first.goals] == [("N3", "Bournemouth", 1), ("N1", "Bournemouth", 2)]
    assert [tuple(g) for g in first.own_goals] == [("N4", "Leeds", 1)]
    assert (first.red_cards, first.yellow_cards) == (["N2"], ["N4"])
    assert got[2].winner is None
    assert got[3].winner is None  # the first match by id
    (answer,) = answers.as_json(answers.match_details(asked.where("request_id = 1"), matches, players)).collect()
    assert json.loads(answer.answer)["goals"][1]["number_of_goals"] == 2


def test_date_may_stand_anywhere(spark):
    matches = spark.createDataFrame(
        [
            (1, "A - B, 1 - 0", "Sat 2023-08-01 14:00:00"),
            (2, "A - B, 1 - 0", "12023-08-02"),
            (3, "A - B, 1 - 0", None),
            (4, "A - B, 1 - 0", "2023"),
        ],
        "wyId long, label string, dateutc string",
    )
    asked = [("2023-08-01", "A - B"), ("2023-08-02", "A - B"), ("2023-08-03", "A - B"), ("14:00", "A - B")]
    found = answers.find_matches(spark.createDataFrame(asked, "date string, label string"), matches)
    got = {(r.date, r.match_id) for r in found.collect()}
    assert got == {("2023-08-01", 1), ("2023-08-02", 2), ("14:00", 1)}
