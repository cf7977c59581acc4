import itertools

from sportlake import codes
from sportlake.operators import events, profiles


def _classify(spark, rows):
    frame = spark.createDataFrame(
        rows,
        "event_code int, sub_event int, match_id long, player_id long, tags array<int>",
    )
    return [r.asDict() for r in events.classify(frame).collect()]


def _expected(code, sub, tags):
    accurate, key, goal = 1801 in tags, 302 in tags, 101 in tags
    out = dict.fromkeys(codes.COUNTERS, 0)
    out["own_goals"] = int(102 in tags)
    out["goals"] = int(goal and code in (8, 1, 10, 3, 2))
    if code == 8:
        out["kp" if key else "np"] = 1
        if accurate:
            out["akp" if key else "anp"] = 1
    elif code == 1:
        out.update(td=1, dw=int(703 in tags), nd=int(702 in tags))
    elif code == 10:
        out.update(
            shots=1,
            on_target=int(accurate),
            on_target_goal=int(accurate and goal),
            on_target_notgoal=int(accurate and not goal),
        )
    elif code == 3:
        out.update(
            free_kicks=1, eff_free_kicks=int(accurate), penalties=int(sub == 35 and goal)
        )
    elif code == 2:
        out["fouls"] = 1
    return out


def test_every_kind_with_every_set_of_tags(spark):
    known = [101, 102, 302, 702, 703, 1801]
    sets = [s for n in range(len(known) + 1) for s in itertools.combinations(known, n)]
    rows = [
        (code, sub, 1, i, list(tags))
        for code in (8, 1, 10, 3, 2, 7)
        for sub in (35, 0)
        for i, tags in enumerate(sets)
    ]
    got = _classify(spark, rows)
    assert len(got) == len(rows)
    for row, (code, sub, match, player, tags) in zip(got, rows):
        assert row == {"match_id": match, "player_id": player, **_expected(code, sub, tags)}


def test_missing_tags_count_nothing(spark):
    (row,) = _classify(spark, [(8, None, 1, 1, None)])
    assert row["np"] == 1 and row["anp"] == 0 and row["goals"] == 0


def test_counters_and_totals_agree(spark, sf_dir):
    from sportlake.plans import bindings

    classified = bindings.classified(spark, sf_dir)
    from_events = profiles.totals(classified)
    from_counters = profiles.totals(events.counters(classified))
    assert sorted(from_events.collect()) == sorted(from_counters.collect())
    bad = events.counters(classified).where(
        "anp > np OR akp > kp OR on_target <> on_target_goal + on_target_notgoal"
        " OR on_target > shots OR dw + nd > td"
    )
    assert bad.count() == 0


def test_ratios_without_attempts_are_zero(spark):
    zero = {c: 0 for c in codes.COUNTERS}
    row = {"match_id": 1, "player_id": 1, **zero, "np": 2, "anp": 1, "kp": 1, "akp": 1}
    schema = "match_id long, player_id long, " + ", ".join(f"{c} long" for c in codes.COUNTERS)
    frame = spark.createDataFrame([tuple(row.values())], schema)
    (got,) = events.ratios(frame).collect()
    assert (got.pa, got.de, got.se, got.fk_eff) == (3 / 4, 0.0, 0.0, 0.0)
