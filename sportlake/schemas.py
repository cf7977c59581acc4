"""Input and output schemas. Nothing is ever inferred from the data."""

from __future__ import annotations

from pyspark.sql import types as T

SQUAD_MEMBER = T.StructType(
    [
        T.StructField("playerId", T.LongType()),
        T.StructField("goals", T.StringType()),
        T.StructField("ownGoals", T.StringType()),
        T.StructField("redCards", T.StringType()),
        T.StructField("yellowCards", T.StringType()),
    ]
)

SUBSTITUTION = T.StructType(
    [
        T.StructField("playerIn", T.LongType()),
        T.StructField("playerOut", T.LongType()),
        T.StructField("minute", T.IntegerType()),
    ]
)

FORMATION = T.StructType(
    [
        T.StructField("substitutions", T.ArrayType(SUBSTITUTION)),
        T.StructField("bench", T.ArrayType(SQUAD_MEMBER)),
        T.StructField("lineup", T.ArrayType(SQUAD_MEMBER)),
    ]
)

MATCH = T.StructType(
    [
        T.StructField("wyId", T.LongType()),
        T.StructField("date", T.StringType()),
        T.StructField("dateutc", T.StringType()),
        T.StructField("label", T.StringType()),
        T.StructField("duration", T.StringType()),
        T.StructField("winner", T.LongType()),
        T.StructField("gameweek", T.IntegerType()),
        T.StructField("venue", T.StringType()),
        T.StructField(
            "teamsData",
            T.MapType(T.StringType(), T.StructType([T.StructField("formation", FORMATION)])),
        ),
    ]
)

EVENT = T.StructType(
    [
        T.StructField("eventId", T.IntegerType()),
        T.StructField("subEventId", T.IntegerType()),
        T.StructField("matchId", T.LongType()),
        T.StructField("playerId", T.LongType()),
        T.StructField("tags", T.ArrayType(T.StructType([T.StructField("id", T.IntegerType())]))),
    ]
)

PLAYERS = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("birthArea", T.StringType()),
        T.StructField("birthDate", T.StringType()),
        T.StructField("foot", T.StringType()),
        T.StructField("role", T.StringType()),
        T.StructField("height", T.IntegerType()),
        T.StructField("passportArea", T.StringType()),
        T.StructField("weight", T.IntegerType()),
        T.StructField("Id", T.LongType()),
    ]
)

PROFILE = T.StructType(
    [
        T.StructField("player_id", T.LongType()),
        T.StructField("rating", T.DoubleType()),
        T.StructField("delta", T.DoubleType()),
        T.StructField("matches", T.IntegerType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("fouls", T.LongType()),
        T.StructField("goals", T.LongType()),
        T.StructField("own_goals", T.LongType()),
        T.StructField("shots_on_target", T.LongType()),
        T.StructField("anp", T.LongType()),
        T.StructField("akp", T.LongType()),
        T.StructField("np", T.LongType()),
        T.StructField("kp", T.LongType()),
    ]
)

PREDICTIONS = T.StructType(
    [T.StructField("age", T.IntegerType()), T.StructField("rating", T.DoubleType())]
)

CHEMISTRY = T.StructType(
    [
        T.StructField("player_a", T.LongType()),
        T.StructField("player_b", T.LongType()),
        T.StructField("coeff", T.DoubleType()),
    ]
)

REQUEST = T.StructType(
    [
        T.StructField("request_id", T.LongType()),
        T.StructField("req_type", T.IntegerType()),
        T.StructField("date", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("label", T.StringType()),
        T.StructField(
            "team1",
            T.StructType(
                [
                    T.StructField("name", T.StringType()),
                    T.StructField("players", T.ArrayType(T.StringType())),
                ]
            ),
        ),
        T.StructField(
            "team2",
            T.StructType(
                [
                    T.StructField("name", T.StringType()),
                    T.StructField("players", T.ArrayType(T.StringType())),
                ]
            ),
        ),
    ]
)

_TEAM_LINE = T.MapType(T.StringType(), T.StringType())

# A request as sent: a team is its name and then its players, each under a key of its own.
REQUEST_LINE = T.StructType(
    [
        T.StructField(f.name, _TEAM_LINE if f.name in ("team1", "team2") else f.dataType)
        for f in REQUEST.fields
    ]
)
