"""Streams with keyed state: ratings, chemistry, curve and predictions kept batch by batch."""

import datetime
import itertools
import os
import subprocess
import sys
import time

import pytest
from pyspark.sql import functions as F
from seasons import event_record, match_record, players_table, random_season, rated_by_loop

from sportlake.operators import appearances, chemistry, events, models, ratings, records
from sportlake.streaming import jobs, joined, state, tables

PLAYERS = range(1, 23)  # two of the players have no birth date on record
_ARRIVALS = itertools.count(int(time.time()) - 10_000)


def _write(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")
    at = next(_ARRIVALS)
    os.utime(folder / name, (at, at))


def _rows(frame, places=9):
    return sorted(
        tuple(round(v, places) if isinstance(v, float) else v for v in r) for r in frame.collect()
    )


def _session(spark):
    return jobs.stream_session(spark, 2)


def _feed(spark, folder, out):
    """Facts of the lines so far."""
    lines = jobs.read_lines(_session(spark), str(folder))
    for start, checkpoint in ((jobs.start_counters, "c"), (jobs.start_facts, "f")):
        jobs.finish(start(lines, out, f"{out}-{checkpoint}", interval=None), 300)


def _rate(spark, out):
    session = _session(spark)
    query = jobs.start_ratings(session, out, players_table(session, PLAYERS), f"{out}-r", interval=None)
    jobs.finish(query, 300)
    return query


def _pair(spark, out, blocks=1):
    jobs.finish(jobs.start_chemistry(_session(spark), out, f"{out}-p", interval=None, blocks=blocks), 300)


def _history(spark, days):
    lines = spark.createDataFrame([(v,) for day in days for v in day], "value string")
    counted = events.counters(events.classify(records.event_records(lines)))
    listed = appearances.appearances(records.match_records(lines))
    joined_rows = ratings.player_match(listed, events.ratios(counted))
    return ratings.history(ratings.match_steps(ratings.with_age(joined_rows, players_table(spark, PLAYERS))))


def _same(spark, out, history):
    assert _rows(jobs.rating_changes(spark, out).select(*history.columns)) == _rows(history)
    assert _rows(jobs.signed_chemistry(spark, out)) == _rows(chemistry.chemistry(history))
    assert _rows(jobs.curve_sums(spark, out)) == _rows(models.quadratic_stats(history))


@pytest.fixture(scope="module")
def season():
    return random_season()


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory, season):
    """A season in five batches: events before their match, late matches, matches sent again."""
    folder, out = tmp_path_factory.mktemp("state") / "lines", f"{tmp_path_factory.mktemp('state')}/out"

    def part(day, matches):
        return [line for line in season[day] if ('"wyId"' in line) == matches]

    other = match_record(100, 1, {"77": ([1, 2, 3], [], [])}, label="another form")
    batches = [
        season[1] + part(3, True),
        part(0, False) + season[2][:40],
        season[2][40:] + part(0, True) + part(1, True),
        season[4] + part(3, False)[:30] + [other],
        part(3, False)[30:] + season[5],
    ]
    rated = []
    for n, lines in enumerate(batches):
        _write(folder, f"batch-{n}", lines)
        _feed(spark, folder, out)
        rated.append(_rate(spark, out).lastProgress)
        if n in (1, 4):
            _pair(spark, out)
    return out, rated, _history(spark, season).persist()


def test_state_equals_batch(spark, run):
    out, _, history = run
    _same(spark, out, history)


def test_state_is_bounded(spark, run):
    """A row for each match of a player in two maps, one for each player, one for each match."""
    out, progress, history = run
    rows = sorted(o["numRowsTotal"] for o in progress[-1]["stateOperators"])
    matches = spark.read.parquet(f"{out}/fact_appearances").select("match_id").distinct().count()
    known = spark.read.parquet(f"{out}/counters").select("match_id", "player_id").distinct().count()
    steps = history.count()
    assert rows[0] == matches and rows[1] <= steps + (steps + known) + len(PLAYERS)


def test_batches_write_what_changed(spark, run):
    out, _, history = run
    parts = spark.read.parquet(f"{out}/rating_changes").groupBy("batch_id").count().collect()
    assert len(parts) >= 4 and all(r["count"] < history.count() for r in parts)
    new = spark.read.parquet(f"{out}/rating_changes").where("old_rating IS NULL").count()
    assert new == history.count()


def test_predictions_keep_old_ages(spark, run):
    out, _, history = run
    found = {r.age: r.rating for r in jobs.predictions(spark, out).collect()}
    assert set(found) == {r.age for r in history.select("age").distinct().collect()}
    last = spark.read.parquet(f"{out}/predictions").groupBy().max("batch_id").first()[0]
    fresh = models.predict_ages(models.quadratic_stats(history), models.fit_quadratic(history))
    ages = {r.age for r in spark.read.parquet(f"{out}/predictions").where(f"batch_id = {last}").collect()}
    assert ages and all(abs(found[r.age] - r.rating) < 1e-6 for r in fresh.collect() if r.age in ages)


def test_replay_changes_nothing(spark, run, tmp_path):
    """Forget that the last batch of each job was committed: it runs again."""
    out, _, history = run
    for job in "rp":
        commits = sorted((p for p in os.scandir(f"{out}-{job}/commits") if p.name.isdigit()), key=lambda p: int(p.name))
        os.unlink(commits[-1].path)
        crc = f"{out}-{job}/commits/.{commits[-1].name}.crc"
        if os.path.exists(crc):
            os.unlink(crc)
    _rate(spark, out)
    _pair(spark, out)
    _same(spark, out, history)


def test_blocks_of_a_match_give_the_same(spark, run):
    out, _, history = run
    jobs.finish(jobs.start_chemistry(_session(spark), out, f"{out}-b", interval=None, blocks=3), 300)
    # The second job wrote parts of its own over those of the first, all of them in one batch.
    part = spark.read.parquet(tables.part(out, "pair_changes", 0)).groupBy("player_a", "player_b").sum("contribution")
    coefficients = {(r[0], r[1]): round(r[2] + 0.5, 9) for r in part.collect()}
    assert coefficients == {(r[0], r[1]): round(r[2], 9) for r in chemistry.chemistry(history).collect()}


def test_pairs_read_what_the_batch_touches():
    """Rows that a processor gives for one changed player: that player's pairs, no others."""

    class Map(dict):
        def iterator(self):
            return iter([((k,), v) for (k,), v in self.items()])

        def updateValue(self, key, value):
            self[key] = value

    processor = state.Pairs()
    processor._held = Map({(p,): ("t", 0.1 * p, 0, 0) for p in range(1, 6)})
    row = {"player_id": 3, "team_id": "t", "delta": 0.9, "block": 0, "batch_id": 1}
    found = list(processor.handleInputRows((7, 0, 0), iter([row]), None))
    assert {(r.player_a, r.player_b) for r in found} == {(1, 3), (2, 3), (3, 4), (3, 5)}
    assert all(abs(r.change - 0.3) < 1e-12 for r in found)
    assert list(processor.handleInputRows((7, 0, 0), iter([row]), None)) == []


class Calls:
    """State of one key in memory that counts how often it is asked."""

    def __init__(self):
        self.calls, self.rows = 0, {}

    def getValueState(self, name, schema):
        return Calls.One(self, name)

    def getMapState(self, name, key, schema):
        return Calls.Map(self, name)

    class One:
        def __init__(self, owner, name):
            self.owner, self.name = owner, name

        def get(self):
            self.owner.calls += 1
            return self.owner.rows.get(self.name)

        def exists(self):
            return self.get() is not None

        def update(self, value):
            self.owner.calls += 1
            self.owner.rows[self.name] = value

    class Map(One):
        def getValue(self, key):
            self.owner.calls += 1
            return self.owner.rows.get((self.name, key))

        def updateValue(self, key, value):
            self.owner.calls += 1
            self.owner.rows[self.name, key] = value

        def iterator(self):
            self.owner.calls += 1
            return iter([(k[1], v) for k, v in self.owner.rows.items() if k[0] == self.name])


def _player_rows(order, batch):
    """Rows of one player's matches, on days out of order and with gains of their own."""
    day = datetime.date(2024, 1, 1)
    for m in order:
        yield {"kind": "listed", "match_id": m, "match_date": day + datetime.timedelta(days=m // 2), "team_id": "t",
               "age": 20, "weight": 0.5 + m % 3 / 4, "gain": 0.0, "batch_id": batch}
        yield {"kind": "counted", "match_id": m, "gain": m % 7 / 10 + batch / 100, "batch_id": batch}


def _rated_in_batches(batches):
    """Last rating of each match, and the calls of the state, of one player's matches in batches."""
    handle, found, calls = Calls(), {}, []
    processor = state.Ratings()
    processor.init(handle)
    for n, order in enumerate(batches):
        before = handle.calls
        for r in processor.handleInputRows((1,), _player_rows(order, n), None):
            found[r.match_date, r.match_id] = (r.rating, r.delta, r.matches)
        calls.append(handle.calls - before)
    return found, calls


@pytest.mark.parametrize("kept", [2, 3, 10, 1000])
def test_matches_that_left_the_recent_row_rate_the_same(monkeypatch, kept):
    monkeypatch.setattr(state, "KEPT", kept)
    batches = [range(20, 40), range(0, 20, 3), [41, 25, 1], range(30), [5], range(38, 60)]
    last = {m: n for n, order in enumerate(batches) for m in order}
    found, _ = _rated_in_batches(batches)
    steps = [(0.5 + m % 3 / 4, m % 7 / 10 + last[m] / 100) for m in sorted(last)]
    want = rated_by_loop(steps)
    assert [m for _, m in sorted(found)] == sorted(last)
    assert [found[k] for k in sorted(found)] == [pytest.approx(w, abs=1e-12) for w in want]


def test_state_is_asked_by_player_and_not_by_match():
    """A call goes to another process; thirty matches of a player and a late one take a few."""
    _, calls = _rated_in_batches([range(10, 40), [3], range(40, 50)])
    assert max(calls) <= 3
    handle, processor = Calls(), state.Pairs()
    processor.init(handle)
    squad = [{"player_id": p, "team_id": "t", "delta": 0.1 * p, "block": 0, "batch_id": 0} for p in range(24)]
    assert len(list(processor.handleInputRows((7, 0, 0), iter(squad), None))) == 24 * 23 // 2
    assert handle.calls <= 3


def test_processors_load_without_the_package(tmp_path):
    """Workers on a cluster, or started elsewhere, do not see this package."""
    from pyspark import cloudpickle

    for kind in (state.Ratings, state.FirstForm, state.Pairs):
        (tmp_path / "processor").write_bytes(cloudpickle.dumps(kind()))
        load = "import pickle; print(type(pickle.load(open('processor', 'rb'))).__name__)"
        done = subprocess.run(
            [sys.executable, "-c", load], cwd=tmp_path, capture_output=True, text=True, check=True
        )
        assert done.stdout.strip() == kind.__name__


# Compaction -------------------------------------------------------------------------------


def _part(spark, out, batch, rows):
    tables.write(spark.createDataFrame(rows, jobs.CURVE), out, "curve_changes", batch)


def test_compaction(spark, tmp_path):
    out, want = f"{tmp_path}/out", {}
    for batch in range(50):
        _part(spark, out, batch, [(20 + batch % 3, 1, 0.5), (30, 1, float(batch))])
        for age, total in ((20 + batch % 3, 0.5), (30, float(batch))):
            n, y = want.get(age, (0, 0.0))
            want[age] = (n + 1, y + total)
        if batch in (19, 47):
            jobs.compact(spark, out, "curve_changes", batch)
    found = jobs.curve_sums(spark, out)
    assert {r.age: (r.n, r.rating_sum) for r in found.collect()} == want
    read = tables.read(spark, out, "curve_changes", jobs.CURVE).select(F.input_file_name())
    folders = {os.path.dirname(r[0]) for r in read.collect()}
    assert len(folders) == 3 and sum("curve_changes-base" in f for f in folders) == 1
    # A covered batch that runs again, and a compaction that comes again or too late, change nothing.
    _part(spark, out, 30, [(30, 100, 100.0)])
    jobs.compact(spark, out, "curve_changes", 47)
    jobs.compact(spark, out, "curve_changes", 10)
    assert {r.age: (r.n, r.rating_sum) for r in jobs.curve_sums(spark, out).collect()} == want
    tables.vacuum(spark, out, "curve_changes")
    assert sorted(os.listdir(f"{out}/curve_changes")) == ["batch_id=48", "batch_id=49"]
    assert os.listdir(f"{out}/curve_changes-base") == ["upto=47"]
    assert {r.age: (r.n, r.rating_sum) for r in jobs.curve_sums(spark, out).collect()} == want
    _part(spark, out, 50, [(30, 1, 1.0)])
    assert jobs.curve_sums(spark, out).where("age = 30").first().n == 51


def test_compaction_that_stops_half_way(spark, tmp_path):
    out = f"{tmp_path}/out"
    for batch in range(3):
        _part(spark, out, batch, [(20, 1, 1.0)])

    def broken(rows):
        jobs.MERGED["curve_changes"][1](rows).write.parquet(f"{out}/curve_changes-base/upto=2")
        raise OSError("lost")

    with pytest.raises(OSError, match="lost"):
        tables.compact(spark, out, "curve_changes", jobs.CURVE, broken, 2)
    assert jobs.curve_sums(spark, out).first().n == 3
    jobs.compact(spark, out, "curve_changes", 2)
    assert jobs.curve_sums(spark, out).first().n == 3
    assert tables.read(spark, f"{tmp_path}/none", "curve_changes", jobs.CURVE).count() == 0


def test_latest_rows_stay_through_compaction(spark, tmp_path):
    out = f"{tmp_path}/out"
    for batch, rating in enumerate((1.0, 2.0, 3.0)):
        rows = [(20, rating), *([(30, 9.0)] if batch == 0 else [])]
        tables.write(spark.createDataFrame(rows, jobs.PREDICTIONS), out, "predictions", batch)
        if batch == 1:
            jobs.compact(spark, out, "predictions", 1)
    assert _rows(jobs.predictions(spark, out)) == [(20, 3.0), (30, 9.0)]


# Join of streams --------------------------------------------------------------------------

DAY = datetime.datetime(2024, 1, 1)


def _sent(spark, folder, lines):
    rows = [(value, DAY + datetime.timedelta(hours=hours)) for value, hours in lines]
    spark.createDataFrame(rows, joined.LINES).coalesce(1).write.mode("append").parquet(folder)


def _join(spark, folder, out):
    session = _session(spark)
    lines = session.readStream.schema(joined.LINES).parquet(folder)
    jobs.finish(joined.start_arrivals(lines, out, f"{out}-a", interval=None), 300)
    query = joined.start_player_match(session, out, f"{out}-j", interval=None)
    jobs.finish(query, 300)
    return query


def test_stream_join_equals_batch(spark, tmp_path, season):
    folder, out = f"{tmp_path}/lines", f"{tmp_path}/out"
    held = []
    for n, day in enumerate(season):
        matches = [(line, 24 * n + 20) for line in day if '"wyId"' in line]
        rest = [(line, 24 * n + i % 20) for i, line in enumerate(line for line in day if '"wyId"' not in line)]
        again = [(line, 24 * n + 3) for line in season[n - 1] if n and '"wyId"' in line]
        _sent(spark, folder, matches + rest + again)
        if n % 2:
            held.append(sum(o["numRowsTotal"] for o in _join(spark, folder, out).lastProgress["stateOperators"]))
    late = event_record(0, 1, 8)
    _sent(spark, folder, [(late, 5), (joined.HEARTBEAT, 24 * 30)])
    _join(spark, folder, out)
    _sent(spark, folder, [(joined.HEARTBEAT, 24 * 31)])
    last = _join(spark, folder, out).lastProgress
    lines = spark.createDataFrame([(v,) for day in season for v in day], "value string")
    counted = events.counters(events.classify(records.event_records(lines)))
    want = ratings.player_match(
        appearances.appearances(records.match_records(lines)), events.ratios(counted)
    )
    want = ratings.with_age(want, players_table(spark, PLAYERS))
    found = joined.player_match(spark, out, players_table(spark, PLAYERS))
    assert _rows(found.select(*want.columns)) == _rows(want)
    assert [r.value for r in spark.read.parquet(f"{out}/late").collect()] == [late]
    assert max(held) > 0 and sum(o["numRowsTotal"] for o in last["stateOperators"]) <= 1  # the heartbeat
