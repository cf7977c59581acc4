import itertools
import os
import time

import pytest
from seasons import event_record, match_record, players_table, random_season

from sportlake.operators import appearances, chemistry, events, models, ratings, records
from sportlake.streaming import jobs

PLAYERS = range(1, 23)  # two of the players have no birth date on record


@pytest.fixture(scope="module")
def season():
    return random_season()


_ARRIVALS = itertools.count(int(time.time()) - 10_000)


def _write(folder, name, lines):
    """Adds a file that is a second newer than the one before; streams go by file times."""
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")
    at = next(_ARRIVALS)
    os.utime(folder / name, (at, at))


def _run(spark, folder, out, max_files=None):
    session = jobs.stream_session(spark, 2)
    lines = jobs.read_lines(session, str(folder), max_files)
    for query in (
        jobs.start_counters(lines, f"{out}", f"{out}-c", interval=None),
        jobs.start_facts(lines, f"{out}", f"{out}-r", interval=None),
    ):
        jobs.finish(query, 300)


def _rated(spark, out):
    return jobs.ratings(spark, out, players_table(spark, PLAYERS))


def _rows(frame, places=9):
    return sorted(
        tuple(round(v, places) if isinstance(v, float) else v for v in r) for r in frame.collect()
    )


def _batch(spark, days):
    lines = spark.createDataFrame([(v,) for day in days for v in day], "value string")
    counted = events.counters(events.classify(records.event_records(lines)))
    listed = appearances.appearances(records.match_records(lines))
    joined = ratings.player_match(listed, events.ratios(counted))
    aged = ratings.with_age(joined, players_table(spark, PLAYERS))
    history = ratings.history(ratings.match_steps(aged))
    return counted, history


def _same(spark, out, days):
    counted, history = _batch(spark, days)
    assert _rows(jobs.counters(spark, out)) == _rows(counted)
    columns = history.columns
    assert _rows(_rated(spark, out).select(*columns)) == _rows(history)
    assert _rows(jobs.chemistry(_rated(spark, out))) == _rows(chemistry.chemistry(history))
    assert _rows(models.solve_quadratic(jobs.curve_stats(_rated(spark, out))), 6) == _rows(
        models.fit_quadratic(history), 6
    )
    assert jobs.profile(spark, out, players_table(spark, PLAYERS)).count() == history.select("player_id").distinct().count()


@pytest.mark.parametrize("files", [1, 6])
def test_stream_equals_batch(spark, tmp_path, season, files):
    folder, out = tmp_path / "lines", f"{tmp_path}/out"
    if files == 1:
        _write(folder, "all", itertools.chain.from_iterable(season))
        _run(spark, folder, out)
    else:
        # One day at a time; each run goes on from the checkpoint of the one before.
        for n, day in enumerate(season):
            _write(folder, f"day-{n}", day)
            if n % 2:
                _run(spark, folder, out, max_files=1)
    _same(spark, out, season)


def test_restart_and_replay(spark, tmp_path, season):
    folder, out = tmp_path / "lines", f"{tmp_path}/out"
    _write(folder, "a", season[0] + season[1])
    _run(spark, folder, out)
    before = _rows(jobs.chemistry(_rated(spark, out)))
    # Forget that the batch was committed: it runs again and must change nothing.
    for job in "cr":
        for commit in (tmp_path / f"out-{job}" / "commits").glob("*0*"):
            commit.unlink()
    _run(spark, folder, out)
    assert _rows(jobs.chemistry(_rated(spark, out))) == before
    _write(folder, "b", season[2])
    _run(spark, folder, out)
    _same(spark, out, season[:3])


def test_late_and_repeated_matches(spark, tmp_path):
    folder, out = tmp_path / "lines", f"{tmp_path}/out"
    squads = {"1": ([1, 2], [3], []), "2": ([4], [], [])}
    _write(folder, "a", [event_record(20, 1, 8, [1801]), match_record(20, 5, squads)])
    _run(spark, folder, out)
    late = [
        match_record(20, 5, squads, label="again"),
        match_record(10, 2, {"1": ([1], [], []), "2": ([5], [], [])}),
    ]
    _write(folder, "b", late)
    _run(spark, folder, out)
    got = {(r.match_id, r.player_id) for r in _rated(spark, out).collect()}
    assert got == {(20, 1), (20, 2), (20, 4), (10, 1), (10, 5)}
    again = {(r.match_id, r.player_id) for r in jobs.repeated_appearances(spark, out).collect()}
    assert again >= {(20, 1), (20, 2), (20, 4)} and all(m == 20 for m, _ in again)
    assert {(r.player_a, r.player_b) for r in jobs.chemistry(_rated(spark, out)).collect()} == {
        (1, 2), (1, 4), (2, 4), (1, 5),
    }


def test_records_and_quarantine(spark, tmp_path):
    folder, out = tmp_path / "lines", f"{tmp_path}/out"
    squads = {"1": ([1], [], []), "2": ([2], [], [])}
    _write(folder, "a", [match_record(1, 0, squads), event_record(1, 1, 8), "{bad", "[]"])
    session = jobs.stream_session(spark, 2)
    lines = jobs.read_lines(session, str(folder))
    jobs.finish(jobs.start_records(lines, out, f"{out}-k", interval=None), 120)
    assert [m.wyId for m in jobs.matches(spark, out).collect()] == [1]
    assert spark.read.parquet(f"{out}/events").count() == 1
    assert spark.read.parquet(f"{out}/bad_lines").count() == 2


def test_processing_time_trigger(spark, tmp_path):
    folder, out = tmp_path / "lines", f"{tmp_path}/out"
    _write(folder, "a", [event_record(1, 1, 8)])
    session = jobs.stream_session(spark, 2)
    query = jobs.start_counters(
        jobs.read_lines(session, str(folder)), out, f"{out}-c", interval="1 second"
    )
    try:
        query.processAllAvailable()
        assert jobs.counters(spark, out).count() == 1
        with pytest.raises(TimeoutError):
            jobs.finish(query, 1)
        assert not query.isActive
    finally:
        query.stop()


def test_order_of_arrival_does_not_matter(spark, tmp_path, season):
    """Events before, with and after the record of their match, one batch for each file."""
    folder, out = tmp_path / "lines", f"{tmp_path}/out"
    lines = [line for day in season for line in day]
    matches = [line for line in lines if '"wyId"' in line]
    rest = [line for line in lines if '"wyId"' not in line]
    _write(folder, "a", rest[::3])
    _write(folder, "b", rest[1::3] + matches[::-1])
    _write(folder, "c", rest[2::3])
    _run(spark, folder, out, max_files=1)
    _same(spark, out, season)


def test_what_a_batch_keeps_in_memory_is_smaller_than_its_lines(spark):
    """Three steps read the lines of a batch; every one reads all that is kept of them."""
    lines = [event_record(m, p, 8, (101, 302, 1801)) for m in range(200) for p in range(50)]
    lines += [match_record(1, 1, {"1": ([1, 2], [3], [])}), "no record", '{"wyId": 2, "eventId": 8, "playerId": 4}']
    frame = spark.createDataFrame([(v,) for v in lines], "value string").coalesce(1)
    parsed = records.parsed(frame)
    kept = records.compact(parsed).persist()
    try:
        assert sorted(map(str, records.event_records(kept).collect())) == sorted(map(str, records.event_records(parsed).collect()))
        assert records.match_records(kept).collect() == records.match_records(parsed).collect()
        assert [r.value for r in records.bad_lines(kept).collect()] == ["no record"]
        size = sum(i.memSize() for i in spark.sparkContext._jsc.sc().getRDDStorageInfo())
    finally:
        kept.unpersist()
    assert size < sum(map(len, lines))
