"""Answers to requests. Requests are rows of a table, so one job answers all of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import codes
from ..functions import age_floor, as_percent, fix_label, is_positive, iso_date, ratio
from ..operators.containment import contained_names, first_contained
from ..operators.records import first_per_key
from ..session import scratch_folder
from .season import kept

WIN_CHANCE, PROFILE, MATCH = 1, 2, 3


# Requests ---------------------------------------------------------------------------------


def with_route(requests: DataFrame) -> DataFrame:
    """Adds ``route``: 1 win chance, 2 profile, and 3 match details for all others."""
    kind = F.coalesce("req_type", F.lit(MATCH))
    return requests.withColumn(
        "route", F.when(kind.isin(WIN_CHANCE, PROFILE), kind).otherwise(F.lit(MATCH))
    )


def route(requests: DataFrame) -> dict[str, DataFrame]:
    """Requests split by what they ask for."""
    routed = with_route(requests)
    return {
        "win_chance": routed.where(F.col("route") == WIN_CHANCE),
        "profile": routed.where(F.col("route") == PROFILE),
        "match": routed.where(F.col("route") == MATCH),
    }


def request_members(requests: DataFrame) -> DataFrame:
    """Named players of win-chance requests as ``request_id, side, date, name``."""
    sides = F.array(
        F.struct(F.lit(1).alias("side"), F.col("team1.players").alias("players")),
        F.struct(F.lit(2).alias("side"), F.col("team2.players").alias("players")),
    )
    return (
        requests.select("request_id", "date", F.inline(sides))
        .select("request_id", "side", "date", F.explode("players").alias("name"))
    )


# Players ----------------------------------------------------------------------------------


def players_by_name(players: DataFrame) -> DataFrame:
    """One player per name, the first in file order."""
    return first_per_key(players, ["name"], ["file_order"])


def resolve_players(names: DataFrame, players: DataFrame) -> DataFrame:
    """Distinct given names with the player they mean.

    An exact name wins; otherwise it is the first player, in file order, whose name lies
    within the given text. Names of nobody have a null ``player_id``. Only exact names have
    a ``role``.
    """
    wanted = names.select("name").where("name IS NOT NULL").distinct()
    known = players_by_name(players)
    exact = wanted.join(known.select("name", "player_id", "role"), "name", "left")

    open_names = exact.where("player_id IS NULL").selectExpr("name AS text_id", "name AS text")
    within = first_contained(
        open_names, known.selectExpr("struct(file_order, player_id) AS name_id", "name")
    ).selectExpr("text_id AS name", "name_id.player_id AS within_id")
    return exact.join(within, "name", "left").select(
        "name", F.coalesce("player_id", "within_id").alias("player_id"), "role"
    )


def player_profile(requests: DataFrame, players: DataFrame, profile: DataFrame) -> DataFrame:
    """Profile of the named player per request; zeros for players who never played.

    Requests for unregistered names stay, with ``registered`` false and null columns.
    """
    counts = {
        "fouls": F.col("fouls"),
        "goals": F.col("goals"),
        "ownGoals": F.col("own_goals"),
        "percent_pass_accuracy": as_percent(
            ratio(F.col("anp") + 2 * F.col("akp"), F.col("np") + 2 * F.col("kp"))
        ),
        "percent_shots_on_target": F.col("shots_on_target"),
    }
    measured = profile.select("player_id", *[c.alias(n) for n, c in counts.items()])
    registered = F.col("player_id").isNotNull()
    return (
        requests.select("request_id", "name")
        .join(players_by_name(players), "name", "left")
        .join(measured, "player_id", "left")
        .select(
            "request_id",
            "name",
            registered.alias("registered"),
            "birth_area",
            "birth_date",
            "foot",
            "role",
            "height",
            "passport_area",
            "weight",
            *[F.when(registered, F.coalesce(n, F.lit(0))).alias(n) for n in counts],
        )
    )


def unregistered(requests: DataFrame, players: DataFrame) -> DataFrame:
    """Requests that name nobody in the player dimension."""
    return requests.join(players.select("name"), "name", "left_anti").select(*requests.columns)


# Rosters ----------------------------------------------------------------------------------


def roster_checks(
    members: DataFrame,
    players: DataFrame,
    quotas: dict[str, tuple[int, int | None]] = codes.ROSTER_QUOTAS,
) -> DataFrame:
    """Players per role of each roster and whether the quotas hold.

    Names that belong to nobody count for no role and are reported in ``unknown``.
    """
    roles = players_by_name(players).select("name", "role", F.lit(True).alias("known"))
    return (
        members.join(roles, "name", "left")
        .groupBy("roster_id")
        .agg(
            *[F.count_if(F.col("role") == r).alias(r.lower()) for r in ("GK", "DF", "MD", "FW")],
            F.count_if(F.col("known").isNull()).alias("unknown"),
        )
        .withColumn("valid", _quotas_hold(quotas, "{}"))
    )


def _quotas_hold(quotas: dict[str, tuple[int, int | None]], column: str) -> Column:
    """Whether the role counts, in columns named like ``column``, keep to the quotas."""
    valid = F.lit(True)
    for role, (least, most) in quotas.items():
        count = F.col(column.format(role))
        valid = valid & (count >= least)
        if most is not None:
            valid = valid & (count <= most)
    return valid


def retired(rated: DataFrame, threshold: float = 0.0) -> DataFrame:
    """Rows whose rating lies below the threshold; such players count as retired."""
    return rated.where(F.col("rating") < threshold)


def fallback_rating(
    rated: DataFrame, predictions: DataFrame, fallback: str = "default"
) -> DataFrame:
    """Fills missing ratings of rows with ``rating, age``.

    ``default`` puts 0.5 in place; ``age`` takes the prediction for the age and 0.5 where
    there is none.
    """
    start = F.lit(codes.START_RATING)
    if fallback == "default":
        return rated.withColumn("rating", F.coalesce("rating", start))
    if fallback != "age":
        raise ValueError(f"unknown fallback {fallback!r}")
    by_age = predictions.select("age", F.col("rating").alias("predicted"))
    return (
        rated.join(by_age, "age", "left")
        .withColumn("rating", F.coalesce("rating", "predicted", start))
        .select(*rated.columns)
    )


def member_ratings(
    members: DataFrame,
    players: DataFrame,
    latest: DataFrame,
    predictions: DataFrame | None = None,
) -> DataFrame:
    """Members with the rating that counts for the fixture; null where there is no player.

    Without predictions an unrated player gets 0.5. With them, the prediction for the
    age on the request's date, and 0.5 beyond the predicted ages.
    """
    rated = members.join(latest.select("player_id", "rating"), "player_id", "left")
    return _filled_ratings(rated, players, predictions)


def _filled_ratings(
    rated: DataFrame, players: DataFrame, predictions: DataFrame | None
) -> DataFrame:
    if predictions is None:
        filled = fallback_rating(rated, None)
    else:
        births = players.select("player_id", "birth_date")
        aged = rated.join(births, "player_id", "left").withColumn(
            "age", age_floor("birth_date", iso_date("date"))
        )
        filled = fallback_rating(aged.drop("birth_date"), predictions, "age")
    return filled.withColumn("rating", F.expr("IF(player_id IS NULL, NULL, rating)"))


# Win chance -------------------------------------------------------------------------------


def win_chance(
    rated: DataFrame,
    chemistry: DataFrame,
    rosters: DataFrame | None = None,
    centered: bool = False,
) -> DataFrame:
    """Chances of both sides per fixture from ``fixture_id, side, player_id, rating``.

    ``rosters`` may give the same rows without their ratings, where those are cheaper.

    Each side's strength is its mean rating times the fixture's chemistry, the mean
    coefficient over all cross-team pairs with 0.5 for pairs that never met. The default
    formula adds the mean strength, so it is not bound to 0..100; ``centered`` subtracts it.
    """
    sides = (
        rated.groupBy("fixture_id").agg(*_side_sums()).where("players_1 > 0 AND players_2 > 0")
    )
    listed = rated if rosters is None else rosters
    excess = _chemistry_excess(listed, chemistry)
    return (
        sides.join(excess, "fixture_id", "left")
        .selectExpr("*", _CHEM)
        .selectExpr("fixture_id", "chem", _chance(centered))
        .selectExpr("*", "100 - chance_1 AS chance_2")
    )


def _side_sums() -> list[Column]:
    """Size and mean rating of both sides of a fixture."""
    return [
        F.expr(text)
        for side in (1, 2)
        for text in (
            f"count_if(side = {side} AND rating IS NOT NULL) AS players_{side}",
            f"avg(rating) FILTER (WHERE side = {side}) AS mean_{side}",
        )
    ]


_CHEM = f"""{codes.START_CHEMISTRY}D
    + coalesce(excess, 0D) / nullif(players_1 * players_2, 0) AS chem"""


def _chance(centered: bool) -> str:
    sign = "-" if centered else "+"
    return f"""(0.5D + mean_1 * chem {sign} (mean_1 * chem + mean_2 * chem) / 2) * 100
        AS chance_1"""


def _chemistry_excess(rosters: DataFrame, chemistry: DataFrame) -> DataFrame:
    """Sum of ``coeff - 0.5`` over the cross-team pairs that ever met, per fixture.

    The mean over a fixture's cross-team pairs is asked for, so these pairs are the work; they
    come from an equality join on the fixture. Pairs that never met add nothing.
    """
    listed = rosters.select("fixture_id", "side", "player_id")
    one = listed.where("side = 1").alias("a")
    two = listed.where("side = 2").alias("b")
    return (
        one.join(two, F.expr("a.fixture_id = b.fixture_id"))
        .selectExpr(
            "a.fixture_id",
            "least(a.player_id, b.player_id) AS player_a",
            "greatest(a.player_id, b.player_id) AS player_b",
        )
        .join(chemistry, ["player_a", "player_b"])
        .selectExpr("fixture_id", f"coeff - {codes.START_CHEMISTRY}D AS gain")
        .groupBy("fixture_id")
        .agg(F.sum("gain").alias("excess"))
    )


def fixture_answers(
    members: DataFrame,
    players: DataFrame,
    latest: DataFrame,
    chemistry: DataFrame,
    predictions: DataFrame | None = None,
    quotas: dict[str, tuple[int, int | None]] = codes.ROSTER_QUOTAS,
    threshold: float = 0.0,
    centered: bool = False,
) -> DataFrame:
    """Full answer to win-chance requests from ``fixture_id, side, date, name``.

    ``status`` tells the first check that failed: an invalid roster of side 1, then of
    side 2, then retired players, whom ``retired_names`` lists. Only fixtures with status
    ``ok`` have chances.
    """
    rated = _rated_members(members, players, latest, chemistry, predictions)
    excess = _chemistry_excess(rated.where("met"), chemistry)
    counted = [
        F.count_if((F.col("side") == side) & (F.col("role") == role)).alias(f"{role}_{side}")
        for side in (1, 2)
        for role in quotas
    ]
    listed = [F.count_if(F.col("side") == side).alias(f"listed_{side}") for side in (1, 2)]
    below = retired(rated, threshold)
    names = below.groupBy(F.col("fixture_id").alias("retired_id")).agg(
        F.count("*").alias("retired"), F.array_sort(F.collect_set("name")).alias("names")
    )
    status = (
        F.when((F.col("listed_1") == 0) | ~_quotas_hold(quotas, "{}_1"), "team 1 invalid")
        .when((F.col("listed_2") == 0) | ~_quotas_hold(quotas, "{}_2"), "team 2 invalid")
        .when(F.col("retired") > 0, "retired players")
        .otherwise("ok")
    )
    return (
        rated.groupBy("fixture_id")
        .agg(*_side_sums(), *counted, *listed)
        .join(names, F.expr("fixture_id <=> retired_id"), "left")
        .join(excess, "fixture_id", "left")
        .selectExpr("*", _CHEM)
        .selectExpr("*", _chance(centered))
        .withColumn("status", status)
        .selectExpr(
            "fixture_id",
            "status",
            "CASE WHEN status = 'ok' THEN chance_1 END AS chance_1",
            "CASE WHEN status = 'ok' THEN 100 - chance_1 END AS chance_2",
            "CASE WHEN status = 'retired players' THEN names ELSE array() END AS retired_names",
        )
    )


def _rated_members(
    members: DataFrame,
    players: DataFrame,
    latest: DataFrame,
    chemistry: DataFrame,
    predictions: DataFrame | None,
) -> DataFrame:
    """Members with ``player_id, role, rating`` and ``met``, whether their player has any coefficient.

    What follows from a name is looked up once for each name, and members take it by one join. Names and
    members are written, since each is read several times from here on.
    """
    spark = members.sparkSession
    wanted = members.select("name").where("name IS NOT NULL").distinct()
    wanted = kept(wanted, scratch_folder(spark, "names"))
    paired = chemistry.select(F.explode(F.array("player_a", "player_b")).alias("player_id")).distinct()
    known = (
        resolve_players(wanted, players)
        .join(latest.select("player_id", "rating"), "player_id", "left")
        .join(paired.withColumn("met", F.lit(True)), "player_id", "left")
    )
    rated = _filled_ratings(members.join(known, "name", "left"), players, predictions)
    rated = rated.select("fixture_id", "side", "name", "player_id", "role", "rating", "met")
    return kept(rated, scratch_folder(spark, "members"))


def win_chance_answers(
    requests: DataFrame,
    players: DataFrame,
    latest: DataFrame,
    chemistry: DataFrame,
    predictions: DataFrame | None = None,
    **rules,
) -> DataFrame:
    """Answers to win-chance requests: name and chance of both teams, names of the retired."""
    members = request_members(requests).withColumnRenamed("request_id", "fixture_id")
    answered = fixture_answers(members, players, latest, chemistry, predictions, **rules)
    return requests.join(
        answered.withColumnRenamed("fixture_id", "request_id"), "request_id", "left"
    ).selectExpr(
        "request_id",
        "coalesce(status, 'team 1 invalid') AS status",
        "coalesce(retired_names, array()) AS retired_names",
        *[
            f"named_struct('name', team{n}.name, 'winning chance', chance_{n}) AS team{n}"
            for n in (1, 2)
        ],
    )


# Match details ----------------------------------------------------------------------------


def find_matches(asked: DataFrame, matches: DataFrame) -> DataFrame:
    """First match, by id, whose label and date text contain a given ``date, label``.

    A full date can only mean matches whose text holds that day somewhere, so day and label
    anchor are one join key. Any other date text is looked for in all matches that the label
    leaves.
    """
    is_day = r"^\d{4}-\d{2}-\d{2}$"
    names = (
        asked.where("date IS NOT NULL AND label IS NOT NULL")
        .select("date", "label")
        .distinct()
        .select(
            F.struct("date", "label").alias("name_id"),
            F.when(F.col("date").rlike(is_day), F.col("date")).otherwise("").alias("day"),
            fix_label("label").alias("name"),
        )
    )
    # Every place counts, overlapping ones too, so that no date text is missed.
    days = F.expr(
        r"""filter(
            transform(sequence(1, greatest(1, length(dateutc) - 9)), i -> substring(dateutc, i, 10)),
            d -> d rlike '^[0-9]{4}-[0-9]{2}-[0-9]{2}$')"""
    )
    days = F.coalesce(days, F.array().cast("array<string>"))
    listed = matches.select(
        F.col("wyId").alias("text_id"),
        F.col("label").alias("text"),
        "dateutc",
        F.explode(F.array_distinct(F.concat(days, F.array(F.lit(""))))).alias("day"),
    )
    return (
        contained_names(listed, names, on=("day",))
        .join(matches.select(F.col("wyId").alias("text_id"), "dateutc"), "text_id")
        .where(F.contains("dateutc", "name_id.date"))
        .groupBy("name_id")
        .agg(F.min("text_id").alias("match_id"))
        .select("name_id.*", "match_id")
    )


def match_details(requests: DataFrame, matches: DataFrame, players: DataFrame) -> DataFrame:
    """Header, cards and goals of the match each request means; none where none is found.

    Team names come from the request's label and go to the teams in the order in which the
    match record lists them. A draw has no winner. Entries keep record order, bench before
    lineup, and a player's goals are summed. What many requests ask alike is worked out once.
    """
    asked = ["date", "label"]
    teams = F.split(F.substring_index(fix_label("label"), ",", 1), "-")
    found = (
        find_matches(requests, matches)
        .join(matches.withColumnRenamed("wyId", "match_id").drop(*asked), "match_id")
        .withColumn("teams", F.transform(teams, lambda t: F.trim(t)))
        .withColumn("team_ids", F.map_keys("teamsData"))
        .withColumn(
            "winner",
            F.try_element_at(
                "teams",
                F.nullif(
                    F.coalesce(
                        F.array_position("team_ids", F.col("winner").cast("string")), F.lit(0)
                    ),
                    F.lit(0),
                ).cast("int"),
            ),
        )
    )
    header = found.select(*asked, "duration", "winner", "gameweek", "venue")
    lists = _match_lists(match_entries(found, players))
    answers = header.join(lists, asked, "left").select(
        *header.columns,
        *[
            F.coalesce(c, F.array().cast(t)).alias(c)
            for c, t in (
                ("red_cards", "array<string>"),
                ("yellow_cards", "array<string>"),
                ("goals", _GOALS),
                ("own_goals", _GOALS),
            )
        ],
    )
    return (
        requests.select("request_id", *asked)
        .join(answers, asked)
        .select("request_id", *[c for c in answers.columns if c != "label"])
    )


_GOALS = "array<struct<name:string,team_name:string,number_of_goals:bigint>>"


def match_entries(found: DataFrame, players: DataFrame) -> DataFrame:
    """Cards and goals one by one: ``date, label, place, kind, name, team_name, amount``."""

    def squad(team: Column, part: str, section: int) -> Column:
        listed = F.coalesce(
            team["formation"][part],
            F.array().cast(
                "array<struct<playerId:bigint,goals:string,ownGoals:string,"
                "redCards:string,yellowCards:string>>"
            ),
        )
        return F.transform(
            listed,
            lambda p, i: F.struct(
                F.lit(section).alias("section"), i.alias("spot"), p.alias("player")
            ),
        )

    listed = (
        found.select(
            "date", "label", "teams", F.posexplode("teamsData").alias("side", "team_id", "team")
        )
        .select(
            "date",
            "label",
            "side",
            F.try_element_at("teams", F.col("side") + 1).alias("team_name"),
            F.explode(
                F.concat(
                    squad(F.col("team"), "bench", 0), squad(F.col("team"), "lineup", 1)
                )
            ).alias("listed"),
        )
        .select("date", "label", "side", "team_name", "listed.section", "listed.spot", "listed.player.*")
    )
    kinds = {
        "red_cards": "redCards",
        "yellow_cards": "yellowCards",
        "goals": "goals",
        "own_goals": "ownGoals",
    }
    entries = F.array(
        *[
            F.struct(F.lit(kind).alias("kind"), F.col(field).alias("amount"))
            for kind, field in kinds.items()
        ]
    )
    names = players.select(F.col("player_id").alias("playerId"), "name")
    return (
        listed.select(
            "date",
            "label",
            "playerId",
            "team_name",
            F.struct("side", "section", "spot").alias("place"),
            F.inline(entries),
        )
        .where(is_positive("amount"))
        .join(names, "playerId")
        .groupBy("date", "label", "kind", "playerId", "name", "team_name")
        .agg(
            F.min("place").alias("place"),
            F.sum(F.trim("amount").cast("long")).alias("amount"),
        )
    )


def _match_lists(entries: DataFrame) -> DataFrame:
    row = F.struct("place", "name", "team_name", F.col("amount").alias("number_of_goals"))

    def ordered(kind: str) -> Column:
        return F.array_sort(F.collect_list(F.when(F.col("kind") == kind, row)))

    def cards(kind: str) -> Column:
        return F.transform(ordered(kind), lambda e: e["name"]).alias(kind)

    def goals(kind: str) -> Column:
        return F.transform(
            ordered(kind),
            lambda e: F.struct(
                e["name"].alias("name"),
                e["team_name"].alias("team_name"),
                e["number_of_goals"].alias("number_of_goals"),
            ),
        ).alias(kind)

    return entries.groupBy("date", "label").agg(
        cards("red_cards"), cards("yellow_cards"), goals("goals"), goals("own_goals")
    )


# Output -----------------------------------------------------------------------------------


def as_json(answers: DataFrame, key: str = "request_id") -> DataFrame:
    """Answers as one JSON object per request."""
    return answers.select(key, F.to_json(F.struct("*")).alias("answer"))
