"""The driver's tables read as sports data.

Every event is an event of a player (its user) on a day. Players meet in matches of at most
24 neighbouring ids, shifted by five each day, so matches stay small at any scale while
partners change. ``SLOT`` below is that neighbourhood; the rest is arithmetic on ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import codes
from ..operators import events as event_ops
from ..operators import ratings as rating_ops

SQUAD = 24
DAY_SHIFT = 5
# Match ids are day * MATCHES_PER_DAY + slot.
MATCHES_PER_DAY = 1_000_000_000
FIRST_DAY = "2024-01-01"
FIRST_BIRTH = "1985-01-01"


# Columns of the driver's tables that are used. Naming them spares a look into the files.
TABLES = {
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, "
    "value double, props string",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "orders": "o_orderkey long, o_custkey long",
    "lineitem": "l_orderkey long, l_partkey long",
    "documents": "doc_id long, text string",
    "benchmark": "item_id long, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


# Which event code a kind of table event stands for.
EVENT_CODES = {
    "view": codes.PASS,
    "click": codes.DUEL,
    "purchase": codes.SHOT,
    "signup": codes.FREE_KICK,
    "error": codes.FOUL,
}

# Conditions on the event's number k under which it carries a tag.
EVENT_TAGS = {
    "k % 2 = 0": codes.TAG_ACCURATE,
    "k % 5 = 0": codes.TAG_KEY_PASS,
    "k % 10 = 0": codes.TAG_GOAL,
    "k = 99": codes.TAG_OWN_GOAL,
    "k % 3 = 0": codes.TAG_WON,
    "k % 3 = 1": codes.TAG_NEUTRAL,
}


def bound_events(events: DataFrame) -> DataFrame:
    """Event records in the engine's columns. Works on static and streaming tables."""
    kinds = " ".join(f"WHEN '{kind}' THEN {code}" for kind, code in EVENT_CODES.items())
    tags = ", ".join(f"CASE WHEN {when} THEN {tag} ELSE 0 END" for when, tag in EVENT_TAGS.items())
    return events.selectExpr(
        "event_id",
        "user_id AS player_id",
        f"bigint(datediff(date(ts), DATE'{FIRST_DAY}')) AS day",
        f"CASE event_type {kinds} ELSE 0 END AS event_code",
        "int(get_json_object(props, '$.k')) AS k",
    ).selectExpr(
        "event_id",
        "event_code",
        f"CASE WHEN k >= 90 THEN {codes.PENALTY} ELSE 0 END AS sub_event",
        f"day * {MATCHES_PER_DAY} + floor((player_id + {DAY_SHIFT} * day) / {SQUAD}) AS match_id",
        "player_id",
        f"array({tags}) AS tags",
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bound_events(table(spark, sf_dir, "events"))


def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_ops.classify(events(spark, sf_dir))


def counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_ops.counters(classified(spark, sf_dir))


def ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_ops.ratios(counters(spark, sf_dir))


def day_of(match: Column) -> Column:
    return F.floor(match / MATCHES_PER_DAY).cast("int")


def slot_of(match: Column) -> Column:
    return match % MATCHES_PER_DAY


def appearances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One appearance per player and day with events.

    One in eight sits on the bench, half of those unused; a third of the starters is taken
    off. Minutes reach beyond 90, so some players come on after the end.
    """
    return _placed(events(spark, sf_dir).select("match_id", "player_id").distinct())


def _placed(listed: DataFrame) -> DataFrame:
    """Appearances of listed players, from match and player alone; more columns stay."""
    more = [c for c in listed.columns if c not in ("match_id", "player_id")]
    return (
        listed.withColumn("day", day_of(F.col("match_id")))
        .selectExpr(
            "*",
            "player_id + day AS turn",
            "int(48 + (7 * player_id + 11 * day) % 48) AS minute",
        )
        .selectExpr(
            "match_id",
            "player_id",
            f"date_add(DATE'{FIRST_DAY}', day) AS match_date",
            f"string(1 + 2 * (match_id % {MATCHES_PER_DAY}) + player_id % 2) AS team_id",
            """CASE WHEN turn % 16 = 0 THEN NULL WHEN turn % 8 = 0 THEN minute
                    ELSE 0 END AS start_minute""",
            f"""CASE WHEN turn % 16 = 0 THEN NULL
                     WHEN turn % 8 <> 0 AND turn % 3 = 0 THEN minute
                     ELSE {codes.FULL_MATCH} END AS end_minute""",
            "turn % 16 <> 0 AS played",
            *more,
        )
    )


def players(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Player dimension from customers with their nations and regions."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    key = F.col("c_custkey")
    roles = {"MACHINERY": "GK", "BUILDING": "DF", "AUTOMOBILE": "MD", "HOUSEHOLD": "FW"}
    role = F.lit("MD")
    for segment, name in roles.items():
        role = F.when(F.col("c_mktsegment") == segment, name).otherwise(role)
    return (
        table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            key.alias("player_id"),
            F.col("c_name").alias("name"),
            F.col("n_name").alias("birth_area"),
            birth_date(key).alias("birth_date"),
            F.when(key % 4 == 0, "left").otherwise("right").alias("foot"),
            role.alias("role"),
            (165 + key % 35).cast("int").alias("height"),
            F.col("r_name").alias("passport_area"),
            (60 + key % 30).cast("int").alias("weight"),
            key.alias("file_order"),
        )
    )


def birth_date(player: Column) -> Column:
    return F.date_add(F.lit(FIRST_BIRTH).cast("date"), (37 * (player % 150)).cast("int"))


def births(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Birth dates alone; only the key column of the customers is read."""
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        key.alias("player_id"), birth_date(key).alias("birth_date")
    )


def player_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rating_ops.with_age(
        rating_ops.player_match(appearances(spark, sf_dir), ratios(spark, sf_dir)),
        births(spark, sf_dir),
    )


def rating_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In these tables a player appears in the matches that have events of theirs, so one
    aggregate of the events gives appearances and ratios, where records need a join."""
    played = rating_ops.with_age(_placed(ratios(spark, sf_dir)), births(spark, sf_dir))
    return rating_ops.match_steps(played)


def rating_history(spark: SparkSession, sf_dir: str, **chunking) -> DataFrame:
    return rating_ops.history(rating_steps(spark, sf_dir), **chunking)


def latest_rating(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rating_ops.latest(rating_history(spark, sf_dir))


# Match records ----------------------------------------------------------------------------


def team_names(slot: Column) -> tuple[Column, Column]:
    home = F.when(slot % 5 == 0, "Bournemouth ").otherwise("Rovers ")
    return F.concat(home, slot.cast("string")), F.concat(
        F.lit("United "), slot.cast("string")
    )


def match_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed match records with squads; a squad has at most 24 players."""
    listed = appearances(spark, sf_dir).join(
        counters(spark, sf_dir).select("match_id", "player_id", "goals", "own_goals", "fouls"),
        ["match_id", "player_id"],
    )
    player = F.col("player_id")
    starter = F.col("played") & (F.col("start_minute") == 0)
    member = F.struct(
        player.alias("playerId"),
        F.col("goals").cast("string").alias("goals"),
        F.col("own_goals").cast("string").alias("ownGoals"),
        F.when(player % 13 == 0, "n/a")
        .when((player % 17 == 0) & (F.col("fouls") > 0), "75")
        .otherwise("0")
        .alias("redCards"),
        F.when(F.col("fouls") >= 2, "40").otherwise("0").alias("yellowCards"),
    )
    taken_off = starter & (F.col("end_minute") != codes.FULL_MATCH)
    came_on = F.col("played") & ~starter
    no_one = F.lit(None).cast("bigint")
    substitution = F.when(
        taken_off | came_on,
        F.struct(
            F.when(came_on, player).otherwise(no_one).alias("playerIn"),
            F.when(taken_off, player).otherwise(no_one).alias("playerOut"),
            F.when(came_on, F.col("start_minute"))
            .otherwise(F.col("end_minute"))
            .alias("minute"),
        ),
    )
    teams = listed.groupBy("match_id", "match_date", "team_id").agg(
        F.array_sort(F.collect_list(substitution)).alias("substitutions"),
        F.array_sort(F.collect_list(F.when(~starter, member))).alias("bench"),
        F.array_sort(F.collect_list(F.when(starter, member))).alias("lineup"),
    )
    team = F.struct(
        F.col("team_id").cast("long").alias("number"),
        "team_id",
        F.struct(F.struct("substitutions", "bench", "lineup").alias("formation")).alias("team"),
    )
    whole = teams.groupBy("match_id", "match_date").agg(
        F.array_sort(F.collect_list(team)).alias("teams")
    )
    slot, day = slot_of(F.col("match_id")), day_of(F.col("match_id"))
    home, away = team_names(slot)
    goals_1, goals_2 = slot % 4, (slot + day) % 3
    return whole.select(
        F.col("match_id").alias("wyId"),
        F.concat(F.date_format("match_date", "MMMM d, yyyy"), F.lit(" at 3:00:00 PM GMT+1")).alias(
            "date"
        ),
        F.concat(F.date_format("match_date", "yyyy-MM-dd"), F.lit(" 15:00:00")).alias("dateutc"),
        F.concat(
            home, F.lit(" - "), away, F.lit(", "), goals_1.cast("string"), F.lit(" - "),
            goals_2.cast("string"),
        ).alias("label"),
        F.lit("Regular").alias("duration"),
        F.when(goals_1 > goals_2, 1 + 2 * slot)
        .when(goals_1 < goals_2, 2 + 2 * slot)
        .otherwise(0)
        .cast("long")
        .alias("winner"),
        (F.floor(day / 7) + 1).cast("int").alias("gameweek"),
        F.concat(F.lit("Ground "), slot.cast("string")).alias("venue"),
        F.map_from_entries(
            F.transform("teams", lambda t: F.struct(t["team_id"], t["team"]))
        ).alias("teamsData"),
    )


def match_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Match records as JSON lines."""
    return match_records(spark, sf_dir).select(F.to_json(F.struct("*")).alias("value"))


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event records as JSON lines."""
    return events(spark, sf_dir).select(
        F.to_json(
            F.struct(
                F.col("event_code").alias("eventId"),
                F.col("sub_event").alias("subEventId"),
                F.col("match_id").alias("matchId"),
                F.col("player_id").alias("playerId"),
                F.transform("tags", lambda t: F.struct(t.alias("id"))).alias("tags"),
            )
        ).alias("value")
    )


def timed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines with the time they are sent: events through the day of their match, which follows at 22:00."""
    match = F.coalesce(F.get_json_object("value", "$.matchId"), F.get_json_object("value", "$.wyId")).cast("long")
    hour = F.when(F.get_json_object("value", "$.wyId").isNotNull(), 22).otherwise(F.pmod(F.xxhash64("value"), F.lit(22)))
    day = F.date_add(F.lit(FIRST_DAY).cast("date"), day_of(match)).cast("timestamp")
    lines = event_lines(spark, sf_dir).unionByName(match_lines(spark, sf_dir))
    return lines.select("value", F.timestamp_add("HOUR", hour.cast("int"), day).alias("sent_at"))


# Requests ---------------------------------------------------------------------------------


def player_name(number: Column) -> Column:
    return F.concat(F.lit("Customer#"), F.lpad(number.cast("string"), 9, "0"))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per order: profiles, matches, and some of no known type."""
    order, customer = F.col("o_orderkey"), F.col("o_custkey")
    day = (order % 33).cast("int")
    slot = F.floor(customer / 240)
    home = F.when(slot % 5 == 0, "Bournmouth ").otherwise("Rovers ")
    pairing = F.concat(
        home, slot.cast("string"), F.lit(" - United "), slot.cast("string")
    )
    score = F.concat(
        F.lit(", "), (slot % 4).cast("string"), F.lit(" - "), ((slot + day) % 3).cast("string")
    )
    return table(spark, sf_dir, "orders").select(
        order.alias("request_id"),
        F.when(order % 4 == 0, 1).when(order % 4 == 1, 2).when(order % 4 == 2, 9).alias(
            "req_type"
        ),
        F.date_format(F.date_add(F.lit(FIRST_DAY).cast("date"), day), "yyyy-MM-dd").alias("date"),
        player_name(F.when(order % 7 == 0, customer + 100_000_000).otherwise(customer)).alias(
            "name"
        ),
        F.when(order % 2 == 0, F.concat(pairing, score)).otherwise(pairing).alias("label"),
    )


def roster_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rosters are orders and their members the line items; some names belong to nobody."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("roster_id"), player_name(F.col("l_partkey")).alias("name")
    )


def fixture_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixtures set an even order against the odd one after it."""
    order = F.col("l_orderkey")
    return table(spark, sf_dir, "lineitem").select(
        F.floor(order / 2).alias("fixture_id"),
        (order % 2 + 1).cast("int").alias("side"),
        F.lit("2024-02-01").alias("date"),
        player_name(F.col("l_partkey")).alias("name"),
    )


def fixture_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Win-chance requests of the fixtures, in the form users send: one key for each player."""
    names = [
        F.expr(f"array_sort(collect_list(name) FILTER (WHERE side = {side})) AS names_{side}") for side in (1, 2)
    ]
    teams = [
        f"""if(listed_{side} = 0, null, map_from_arrays(
            concat(array('name'), transform(names_{side}, (n, i) -> concat('player', i + 1))),
            concat(array(concat('Team ', 2 * request_id + {side} - 1)), names_{side}))) AS team{side}"""
        for side in (1, 2)
    ]
    # Hardly two members of a fixture are read by one task, so they are brought together before they are grouped.
    return (
        fixture_members(spark, sf_dir)
        .repartition("fixture_id")
        .groupBy(F.col("fixture_id").alias("request_id"), "date")
        .agg(*names, *[F.count_if(F.col("side") == side).alias(f"listed_{side}") for side in (1, 2)])
        .selectExpr("request_id", "date", *teams)
        .select(
            F.to_json(F.struct("request_id", F.lit(1).alias("req_type"), "date", "team1", "team2")).alias("value")
        )
    )
