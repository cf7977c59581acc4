import datetime

from seasons import FIRST, event_record, match_record

from sportlake.operators import appearances, records


def _lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_kinds_follow_top_level_keys(spark):
    values = [
        match_record(1, 0, {"1": ([1], [], [])}),
        event_record(1, 1, 8),
        '{"wyId": null}',
        '{"wyId": 3, "eventId": 8}',
        '{"other": {"wyId": 1}}',
        '{"wyId": 1,',
        "[1, 2]",
        "null",
        "",
    ]
    got = [tuple(r)[1:] for r in records.label_lines(_lines(spark, values)).collect()]
    match, event, bad = (True, False, False), (False, True, False), (False, False, True)
    assert got == [match, event, match, (True, True, False), (False,) * 3, bad, bad, bad, bad]
    assert records.match_records(_lines(spark, values)).count() == 3
    assert records.event_records(_lines(spark, values)).count() == 2
    assert records.bad_lines(_lines(spark, values)).count() == 4


def test_first_form_of_a_match_stays(spark):
    frame = spark.createDataFrame(
        [(1, "b", 2), (1, "a", 5), (2, "c", 1), (1, "z", 9)],
        "match_id long, label string, arrival long",
    )
    got = records.first_per_key(frame, ["match_id"], ["arrival"]).select("match_id", "label")
    assert sorted(map(tuple, got.collect())) == [(1, "b"), (2, "c")]


def test_pitch_time(spark):
    teams = {
        "7": ([1, 2, 3, 4], [5, 6, 9], [(5, 1, 60), (6, 5, 70), (8, 2, 0), (5, 1, 80), (99, 3, 92)]),
        "8": ([11], [12], "none"),
        "9": ([21], [], []),
    }
    line = match_record(50, 3, teams)
    typed = records.match_records(_lines(spark, [line]))
    got = {r.player_id: r for r in appearances.appearances(typed).collect()}
    minutes = {p: (r.start_minute, r.end_minute, r.played) for p, r in got.items()}
    assert minutes == {
        1: (0, 60, True),
        2: (0, 0, True),
        3: (0, 92, True),
        4: (0, 90, True),
        5: (60, 90, True),
        6: (70, 90, True),
        9: (None, None, False),
        11: (0, 90, True),
        12: (None, None, False),
        21: (0, 90, True),
    }
    assert got[1].match_date == FIRST + datetime.timedelta(days=3)
    assert (got[1].team_id, got[12].team_id) == ("7", "8")


def test_match_sent_again_is_played_once(spark):
    squads = {"1": ([1], [], []), "2": ([2], [], [])}
    sent = [(match_record(7, 0, squads, label=x), i) for i, x in enumerate("ab")]
    lines = spark.createDataFrame(sent, "value string, arrival int")
    first = records.first_matches(lines, ["arrival"])
    assert [m.label for m in first.collect()] == ["a"]
    assert appearances.appearances(first).count() == 2
