import datetime
import random

import pytest
from seasons import rated_by_loop

from sportlake.functions import age_floor, age_rounded, match_day
from sportlake.operators import ratings

COLUMNS = """player_id long, match_id long, match_date date, team_id string, age int,
    start_minute int, end_minute int, played boolean, pa double, de double, fk_eff double,
    target long, fouls long, own_goals long"""


def _match(player, n, minutes, pa=0.0, de=0.0, fk_eff=0.0, target=0, fouls=0, own=0):
    day = datetime.date(2024, 1, 1) + datetime.timedelta(days=n)
    start, end = (0, minutes) if minutes >= 0 else (90 - minutes, 90)
    return (player, n, day, "1", 20, start, end, True, pa, de, fk_eff, target, fouls, own)


def test_worked_examples(spark):
    rows = [
        _match(1, 1, 90, pa=0.8, de=0.5, target=1, fouls=1),
        _match(1, 2, 30, pa=1.0),
        _match(3, 1, -2, pa=1.0),
        _match(4, 1, 93),
        _match(5, 1, 90, pa=1.0, de=1.0, fk_eff=1.0, target=2, own=1),
    ]
    frame = spark.createDataFrame(rows, COLUMNS)
    got = {
        (r.player_id, r.matches): (r.rating, r.delta)
        for r in ratings.history(ratings.match_steps(frame)).collect()
    }
    expected = {
        (1, 1): (0.562865625, 0.062865625),
        (1, 2): (0.13547760416666665, -0.4273880208333334),
        (3, 1): (-0.008333333333333333, -0.5083333333333333),
        (4, 1): (0.25833333333333336, -0.24166666666666664),
        (5, 1): (0.8859375, 0.3859375),
    }
    assert got.keys() == expected.keys()
    for key, (rating, delta) in expected.items():
        assert got[key] == pytest.approx((rating, delta), abs=1e-14)


STEPS = "player_id long, match_id long, match_date date, team_id string, age int, " \
    "weight double, contribution double"


@pytest.mark.parametrize("period_days,chunk_rows", [(365, 64), (30, 5), (1, 1)])
def test_history_equals_a_loop(spark, period_days, chunk_rows):
    rng = random.Random(3)
    rows, expected = [], {}
    for player in range(12):
        n = 300 if player == 0 else rng.randint(1, 40)
        keys = sorted(
            (datetime.date(2022, 1, 1) + datetime.timedelta(days=rng.randint(0, 900)), m)
            for m in range(n)
        )
        steps = [(rng.choice([1.05, 0.0, -0.02, 1.1, rng.random()]), rng.random() * 2) for _ in keys]
        rows += [
            (player, m, day, "1", 20, w, c) for (day, m), (w, c) in zip(keys, steps)
        ]
        for (_, m), rated in zip(keys, rated_by_loop(steps)):
            expected[player, m] = rated
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, STEPS)
    got = ratings.history(frame, period_days, chunk_rows).collect()
    assert len(got) == len(expected)
    for r in got:
        rating, delta, matches = expected[r.player_id, r.match_id]
        assert (r.rating, r.delta) == pytest.approx((rating, delta), abs=1e-12)
        assert r.matches == matches


def test_many_matches_of_one_player_on_few_days(spark):
    frame = spark.range(20_000).selectExpr(
        "1L AS player_id",
        "id AS match_id",
        "date_add(DATE'2024-01-01', int(id % 7)) AS match_date",
        "'1' AS team_id",
        "20 AS age",
        "0.5D + (id % 50) / 100D AS weight",
        "(id % 13) / 10D AS contribution",
    )
    got = ratings.history(frame).orderBy("matches").collect()
    order = sorted(range(20_000), key=lambda i: (i % 7, i))
    expected = rated_by_loop([(0.5 + (i % 50) / 100, (i % 13) / 10) for i in order])
    assert [r.match_id for r in got] == order
    assert all(abs(r.rating - e[0]) < 1e-12 for r, e in zip(got, expected))


def test_latest_and_unplayed(spark):
    unused = (9, 1, datetime.date(2024, 1, 1), "1", 20, None, None, False, 1.0, 1.0, 0.0, 0, 0, 0)
    frame = spark.createDataFrame([_match(1, 1, 90), _match(1, 2, 45), unused], COLUMNS)
    history = ratings.history(ratings.match_steps(frame))
    (last,) = ratings.latest(history).collect()
    assert (last.player_id, last.matches) == (1, 2)


def test_players_without_events_or_birth_date(spark):
    listed = spark.createDataFrame(
        [(1, 1, datetime.date(2017, 8, 12)), (1, 2, datetime.date(2017, 8, 12))],
        "match_id long, player_id long, match_date date",
    )
    ratios = spark.createDataFrame(
        [(1, 2, 0.5, 3)], "match_id long, player_id long, pa double, target long"
    )
    joined = ratings.player_match(listed, ratios)
    got = {r.player_id: (r.pa, r.target) for r in joined.collect()}
    assert got == {1: (0.0, 0), 2: (0.5, 3)}
    players = spark.createDataFrame(
        [(1, datetime.date(1989, 3, 6)), (2, None)], "player_id long, birth_date date"
    )
    (row,) = ratings.with_age(joined, players).collect()
    assert (row.player_id, row.age) == (1, 28)


def test_ages_and_dates(spark):
    row = spark.range(1).select(
        age_rounded(_date("1990-01-01"), _date("2010-10-01")).alias("rounded"),
        age_floor(_date("1990-01-01"), _date("2010-10-01")).alias("floored"),
        match_day(_text("August 12, 2017 at 1:30:00 PM GMT+2")).alias("day"),
        match_day(_text("12.8.2017")).alias("bad"),
    ).first()
    assert (row.rounded, row.floored) == (21, 20)
    assert row.day == datetime.date(2017, 8, 12) and row.bad is None


def _text(value):
    from pyspark.sql import functions as F

    return F.lit(value)


def _date(value):
    return _text(value).cast("date")
