"""Each registered query as SQL over the driver's tables, written independently of Spark."""

from __future__ import annotations

from .. import codes

# Doubles are compared to six places. The shift keeps short decimals that end right between
# two of them from rounding either way.
PLACES = 6
OFF_TIES = 1.234567e-10

COUNTERS = codes.COUNTERS
TOTALS = ["fouls", "goals", "own_goals", "shots_on_target", "anp", "akp", "np", "kp"]
PROFILE = ["rating", "delta", "matches", "age", *TOTALS]


def _r(expression: str, name: str | None = None) -> str:
    """Value rounded like ``registry.rounded`` does, without a negative zero."""
    shifted = f"CAST({expression} AS DOUBLE) + CAST({OFF_TIES!r} AS DOUBLE)"
    return f"round({shifted}, {PLACES}) + CAST(0 AS DOUBLE) AS {name or expression}"


# Common table expressions, by name; each may use the ones before it.

EVENTS = """
ev AS (
  SELECT *, d * 1000000000 + (player_id + 5 * d) // 24 AS match_id
  FROM (
    SELECT event_id, user_id AS player_id, event_type, value,
           CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS BIGINT) AS d,
           CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k
    FROM events
  )
)"""

CLASSIFIED = """
cl AS (
  SELECT event_id, match_id, player_id,
    CAST(event_type = 'view' AND k % 2 = 0 AND k % 5 <> 0 AS INTEGER) AS anp,
    CAST(event_type = 'view' AND k % 2 = 0 AND k % 5 = 0 AS INTEGER) AS akp,
    CAST(event_type = 'view' AND k % 5 <> 0 AS INTEGER) AS np,
    CAST(event_type = 'view' AND k % 5 = 0 AS INTEGER) AS kp,
    CAST(event_type = 'click' AND k % 3 = 0 AS INTEGER) AS dw,
    CAST(event_type = 'click' AND k % 3 = 1 AS INTEGER) AS nd,
    CAST(event_type = 'click' AS INTEGER) AS td,
    CAST(event_type = 'purchase' AS INTEGER) AS shots,
    CAST(event_type = 'purchase' AND k % 2 = 0 AND k % 10 = 0 AS INTEGER) AS on_target_goal,
    CAST(event_type = 'purchase' AND k % 2 = 0 AND k % 10 <> 0 AS INTEGER) AS on_target_notgoal,
    CAST(event_type = 'purchase' AND k % 2 = 0 AS INTEGER) AS on_target,
    CAST(event_type = 'error' AS INTEGER) AS fouls,
    CAST(k = 99 AS INTEGER) AS own_goals,
    CAST(event_type = 'signup' AS INTEGER) AS free_kicks,
    CAST(event_type = 'signup' AND k % 2 = 0 AS INTEGER) AS eff_free_kicks,
    CAST(event_type = 'signup' AND k >= 90 AND k % 10 = 0 AS INTEGER) AS penalties,
    CAST(k % 10 = 0 AS INTEGER) AS goals
  FROM ev
)"""

COUNTED = f"""
ct AS (
  SELECT match_id, player_id,
    {", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in COUNTERS)}
  FROM cl GROUP BY match_id, player_id
)"""

RATIOS = """
ra AS (
  SELECT match_id, player_id,
    CASE WHEN np + 2 * kp = 0 THEN CAST(0 AS DOUBLE)
         ELSE CAST(anp + 2 * akp AS DOUBLE) / CAST(np + 2 * kp AS DOUBLE) END AS pa,
    CASE WHEN td = 0 THEN CAST(0 AS DOUBLE)
         ELSE (CAST(dw AS DOUBLE) + CAST(nd AS DOUBLE) / 2) / CAST(td AS DOUBLE) END AS de,
    CASE WHEN shots = 0 THEN CAST(0 AS DOUBLE)
         ELSE (CAST(on_target_goal AS DOUBLE) + CAST(on_target_notgoal AS DOUBLE) / 2)
              / CAST(shots AS DOUBLE) END AS se,
    fouls, own_goals, on_target AS target,
    CASE WHEN free_kicks = 0 THEN CAST(0 AS DOUBLE)
         ELSE CAST(eff_free_kicks + penalties AS DOUBLE) / CAST(free_kicks AS DOUBLE) END AS fk_eff,
    goals, anp, akp, np, kp
  FROM ct
)"""

APPEARANCES = """
ap AS (
  SELECT match_id, player_id, match_date, team_id, played,
    CASE WHEN NOT played THEN NULL WHEN turn % 8 = 0 THEN minute ELSE 0 END AS start_minute,
    CASE WHEN NOT played THEN NULL WHEN turn % 8 <> 0 AND turn % 3 = 0 THEN minute
         ELSE 90 END AS end_minute
  FROM (
    SELECT DISTINCT match_id, player_id,
      CAST(DATE '2024-01-01' + CAST(d AS INTEGER) AS DATE) AS match_date,
      CAST(1 + 2 * (match_id % 1000000000) + player_id % 2 AS VARCHAR) AS team_id,
      player_id + d AS turn,
      CAST(48 + (7 * player_id + 11 * d) % 48 AS INTEGER) AS minute,
      (player_id + d) % 16 <> 0 AS played
    FROM ev
  )
)"""

BIRTHS = """
bi AS (
  SELECT c_custkey AS player_id,
    CAST(DATE '1985-01-01' + CAST(37 * (c_custkey % 150) AS INTEGER) AS DATE) AS birth_date
  FROM customer
)"""

PLAYER_MATCH = """
pm AS (
  SELECT ap.*, pa, de, se, fouls, own_goals, target, fk_eff, goals, anp, akp, np, kp,
    CAST(round(CAST(date_diff('day', birth_date, match_date) AS DOUBLE) / 365) AS INTEGER) AS age
  FROM ap JOIN ra USING (match_id, player_id) JOIN bi USING (player_id)
)"""

HISTORY = """
st AS (
  SELECT player_id, match_id, match_date, team_id, age,
    CASE WHEN end_minute - start_minute = 90 THEN CAST(1.05 AS DOUBLE)
         ELSE CAST(end_minute - start_minute AS DOUBLE) / 90 END AS w,
    (pa + de + fk_eff + target) / 4
      * (1 - (CAST(0.005 AS DOUBLE) * fouls + CAST(0.05 AS DOUBLE) * own_goals)) AS c,
    row_number() OVER (PARTITION BY player_id ORDER BY match_date, match_id) AS n
  FROM pm WHERE played
),
hi AS (
  SELECT player_id, match_id, match_date, team_id, age, n,
    w * (c + CAST(0.5 AS DOUBLE)) / 2 AS rating,
    w * (c + CAST(0.5 AS DOUBLE)) / 2 - CAST(0.5 AS DOUBLE) AS delta
  FROM st WHERE n = 1
  UNION ALL
  SELECT s.player_id, s.match_id, s.match_date, s.team_id, s.age, s.n,
    s.w * (s.c + h.rating) / 2, s.w * (s.c + h.rating) / 2 - h.rating
  FROM hi h JOIN st s ON s.player_id = h.player_id AND s.n = h.n + 1
)"""

LATEST = """
la AS (
  SELECT player_id, rating, delta, CAST(n AS INTEGER) AS matches, age
  FROM hi QUALIFY row_number() OVER (PARTITION BY player_id ORDER BY n DESC) = 1
)"""

TOTALLED = """
tt AS (
  SELECT player_id, CAST(sum(fouls) AS BIGINT) AS fouls, CAST(sum(goals) AS BIGINT) AS goals,
    CAST(sum(own_goals) AS BIGINT) AS own_goals,
    CAST(sum(on_target) AS BIGINT) AS shots_on_target,
    CAST(sum(anp) AS BIGINT) AS anp, CAST(sum(akp) AS BIGINT) AS akp,
    CAST(sum(np) AS BIGINT) AS np, CAST(sum(kp) AS BIGINT) AS kp
  FROM cl GROUP BY player_id
)"""

FINAL = f"""
fp AS (
  SELECT player_id, {", ".join(PROFILE)} FROM la JOIN tt USING (player_id)
)"""

PAIRS = """
pr AS (
  SELECT match_id, player_a, player_b,
    CASE WHEN same THEN together ELSE -together END AS contribution
  FROM (
    SELECT a.match_id, a.player_id AS player_a, b.player_id AS player_b,
      a.team_id = b.team_id AS same,
      CASE WHEN a.delta * b.delta < 0 THEN -abs((a.delta + b.delta) / 2)
           ELSE (a.delta + b.delta) / 2 END AS together
    FROM hi a JOIN hi b ON a.match_id = b.match_id AND a.player_id < b.player_id
  )
)"""

CHEMISTRY = """
ch AS (
  SELECT player_a, player_b, CAST(0.5 AS DOUBLE) + sum(contribution) AS coeff
  FROM pr GROUP BY player_a, player_b
)"""

_CURVE = """
cs AS (
  SELECT count(*) AS s0, sum(x) AS s1, sum(x * x) AS s2, sum(x * x * x) AS s3,
    sum(x * x * x * x) AS s4, sum(rating) AS t0, sum(rating * x) AS t1,
    sum(rating * x * x) AS t2, count(DISTINCT x) AS ages
  FROM (SELECT CAST(age - 28 AS DOUBLE) AS x, rating FROM {rated})
),
cu AS (
  SELECT
    (t0 * (s2 * s4 - s3 * s3) - s1 * (t1 * s4 - t2 * s3) + s2 * (t1 * s3 - t2 * s2)) / det AS c0,
    (s0 * (t1 * s4 - t2 * s3) - t0 * (s1 * s4 - s2 * s3) + s2 * (s1 * t2 - s2 * t1)) / det AS c1,
    (s0 * (s2 * t2 - s3 * t1) - s1 * (s1 * t2 - s2 * t1) + t0 * (s1 * s3 - s2 * s2)) / det AS c2
  FROM (
    SELECT *, CASE WHEN ages >= 3 THEN s0 * (s2 * s4 - s3 * s3) - s1 * (s1 * s4 - s2 * s3)
              + s2 * (s1 * s3 - s2 * s2) END AS det
    FROM cs
  )
),
co AS (
  SELECT c0 - 28 * c1 + 784 * c2 AS intercept, c1 - 56 * c2 AS linear, c2 AS quadratic FROM cu
)"""

CURVE = _CURVE.format(rated="la")

PLAYERS = """
pl AS (
  SELECT c_custkey AS player_id, c_name AS name, n_name AS birth_area,
    CAST(DATE '1985-01-01' + CAST(37 * (c_custkey % 150) AS INTEGER) AS DATE) AS birth_date,
    CASE WHEN c_custkey % 4 = 0 THEN 'left' ELSE 'right' END AS foot,
    CASE c_mktsegment WHEN 'MACHINERY' THEN 'GK' WHEN 'BUILDING' THEN 'DF'
      WHEN 'HOUSEHOLD' THEN 'FW' ELSE 'MD' END AS role,
    CAST(165 + c_custkey % 35 AS INTEGER) AS height, r_name AS passport_area,
    CAST(60 + c_custkey % 30 AS INTEGER) AS weight
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""

REQUESTS = """
rq AS (
  SELECT request_id, req_type, date, name,
    CASE WHEN request_id % 2 = 0 THEN pairing || score ELSE pairing END AS label
  FROM (
    SELECT o_orderkey AS request_id,
      CASE o_orderkey % 4 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 9 END AS req_type,
      strftime(DATE '2024-01-01' + CAST(o_orderkey % 33 AS INTEGER), '%Y-%m-%d') AS date,
      'Customer#' || lpad(CAST(CASE WHEN o_orderkey % 7 = 0 THEN o_custkey + 100000000
                               ELSE o_custkey END AS VARCHAR), 9, '0') AS name,
      CASE WHEN (o_custkey // 240) % 5 = 0 THEN 'Bournmouth ' ELSE 'Rovers ' END
        || (o_custkey // 240) || ' - United ' || (o_custkey // 240) AS pairing,
      ', ' || (o_custkey // 240) % 4 || ' - '
        || ((o_custkey // 240) + o_orderkey % 33) % 3 AS score
    FROM orders
  )
)"""

MATCHES = """
mt AS (
  SELECT match_id, slot, home || ' - ' || away || ', ' || g1 || ' - ' || g2 AS label,
    strftime(DATE '2024-01-01' + CAST(d AS INTEGER), '%Y-%m-%d') AS day,
    home, away, g1, g2, CAST(d // 7 + 1 AS INTEGER) AS gameweek, 'Ground ' || slot AS venue,
    teams
  FROM (
    SELECT match_id, slot, d, g1, g2, teams,
      CASE WHEN slot % 5 = 0 THEN 'Bournemouth ' ELSE 'Rovers ' END || slot AS home,
      'United ' || slot AS away
    FROM (
      SELECT match_id, match_id % 1000000000 AS slot, match_id // 1000000000 AS d,
        (match_id % 1000000000) % 4 AS g1,
        (match_id % 1000000000 + match_id // 1000000000) % 3 AS g2,
        list(DISTINCT CAST(team_id AS BIGINT) ORDER BY CAST(team_id AS BIGINT)) AS teams
      FROM ap GROUP BY match_id
    )
  )
),
fo AS (
  SELECT r.request_id, r.date, min(match_id) AS match_id,
    any_value(trim(split_part(split_part(fixed, ',', 1), '-', 1))) AS name_1,
    any_value(trim(split_part(split_part(fixed, ',', 1), '-', 2))) AS name_2
  FROM (SELECT *, replace(label, 'Bournmouth', 'Bournemouth') AS fixed FROM rq) r
  JOIN mt ON mt.day = r.date AND contains(mt.label, r.fixed)
  GROUP BY r.request_id, r.date
),
hd AS (
  SELECT fo.request_id, fo.date, 'Regular' AS duration,
    CASE WHEN w IS NULL THEN NULL WHEN w = teams[1] THEN name_1
         WHEN w = teams[2] THEN name_2 END AS winner,
    gameweek, venue
  FROM fo JOIN (
    SELECT *, CASE WHEN g1 > g2 THEN 1 + 2 * slot WHEN g1 < g2 THEN 2 + 2 * slot END AS w FROM mt
  ) m USING (match_id)
),
sq AS (
  SELECT ap.match_id, ap.player_id, CAST(team_id AS BIGINT) AS team,
    CASE WHEN played AND start_minute = 0 THEN 1 ELSE 0 END AS section,
    goals, own_goals,
    CASE WHEN player_id % 13 = 0 THEN 0 WHEN player_id % 17 = 0 AND fouls > 0 THEN 75
         ELSE 0 END AS red,
    CASE WHEN fouls >= 2 THEN 40 ELSE 0 END AS yellow
  FROM ap JOIN ct USING (match_id, player_id)
),
en AS (
  SELECT request_id, kind, player_id, name, team, section, amount,
    CASE WHEN team = teams[1] THEN name_1 ELSE name_2 END AS team_name
  FROM fo JOIN mt USING (match_id) JOIN (
    SELECT match_id, player_id, team, section, 'red_cards' AS kind, red AS amount FROM sq
    UNION ALL SELECT match_id, player_id, team, section, 'yellow_cards', yellow FROM sq
    UNION ALL SELECT match_id, player_id, team, section, 'goals', goals FROM sq
    UNION ALL SELECT match_id, player_id, team, section, 'own_goals', own_goals FROM sq
  ) USING (match_id) JOIN pl USING (player_id)
  WHERE amount > 0
)"""

_CTES = [
    ("ev", EVENTS, ()),
    ("cl", CLASSIFIED, ("ev",)),
    ("ct", COUNTED, ("cl",)),
    ("ra", RATIOS, ("ct",)),
    ("ap", APPEARANCES, ("ev",)),
    ("bi", BIRTHS, ()),
    ("pm", PLAYER_MATCH, ("ap", "ra", "bi")),
    ("hi", HISTORY, ("pm",)),
    ("la", LATEST, ("hi",)),
    ("tt", TOTALLED, ("cl",)),
    ("fp", FINAL, ("la", "tt")),
    ("pr", PAIRS, ("hi",)),
    ("ch", CHEMISTRY, ("pr",)),
    ("co", CURVE, ("la",)),
    ("pl", PLAYERS, ()),
    ("rq", REQUESTS, ()),
    ("en", MATCHES, ("ap", "ct", "rq", "pl")),
]


def _with(needed: tuple[str, ...], select: str, extra: str = "") -> str:
    """Query with the common table expressions it needs."""
    wanted = set(needed)
    for name, _, uses in reversed(_CTES):
        if name in wanted:
            wanted.update(uses)
    parts = [text.strip() for name, text, _ in _CTES if name in wanted]
    if extra:
        parts.append(extra.strip())
    return f"WITH RECURSIVE {', '.join(parts)}\n{select.strip()}"


def _name(number: str) -> str:
    return f"'Customer#' || lpad(CAST({number} AS VARCHAR), 9, '0')"


_HISTORY = _with(
    ("hi",),
    f"""SELECT player_id, match_id, match_date, team_id, {_r("rating")}, {_r("delta")},
           CAST(n AS INTEGER) AS matches, age FROM hi""",
)
_PROFILE_COLUMNS = f"""player_id, {_r("rating")}, {_r("delta")}, matches, age,
    {", ".join(TOTALS)}"""
_PROFILE = _with(("fp",), f"SELECT {_PROFILE_COLUMNS} FROM fp")
_PLAYER_MATCH = _with(
    ("pm",),
    f"""SELECT match_id, player_id, match_date, team_id, start_minute, end_minute, played,
          {_r("pa")}, {_r("de")}, {_r("se")}, fouls, own_goals, target, {_r("fk_eff")},
          goals, anp, akp, np, kp, age FROM pm""",
)
# The curve after each of three batches, over all ratings until then, and the last one of each age.
_LATEST_PREDICTION = _with(
    ("hi",),
    f"""SELECT age, {_r("c0 + c1 * (age - 28) + c2 * (age - 28) * (age - 28)", "rating")}
        FROM (SELECT DISTINCT age, b FROM bt) JOIN cu ON b = k
        QUALIFY row_number() OVER (PARTITION BY age ORDER BY b DESC) = 1""",
    """
bt AS (
  SELECT age, rating, CASE
    WHEN d = max(d) OVER () AND match_id % 1000000000 % 3 = 0 THEN 2 WHEN d < 25 THEN 0 ELSE 1 END AS b
  FROM (SELECT *, match_id // 1000000000 AS d FROM hi)
),
cs AS (
  SELECT k, count(*) AS s0, sum(x) AS s1, sum(x * x) AS s2, sum(x * x * x) AS s3,
    sum(x * x * x * x) AS s4, sum(rating) AS t0, sum(rating * x) AS t1,
    sum(rating * x * x) AS t2, count(DISTINCT x) AS ages
  FROM (SELECT unnest([0, 1, 2]) AS k) JOIN (SELECT CAST(age - 28 AS DOUBLE) AS x, rating, b FROM bt) ON b <= k
  GROUP BY k
),
cu AS (
  SELECT k,
    (t0 * (s2 * s4 - s3 * s3) - s1 * (t1 * s4 - t2 * s3) + s2 * (t1 * s3 - t2 * s2)) / det AS c0,
    (s0 * (t1 * s4 - t2 * s3) - t0 * (s1 * s4 - s2 * s3) + s2 * (s1 * t2 - s2 * t1)) / det AS c1,
    (s0 * (s2 * t2 - s3 * t1) - s1 * (s1 * t2 - s2 * t1) + t0 * (s1 * s3 - s2 * s2)) / det AS c2
  FROM (
    SELECT *, CASE WHEN ages >= 3 THEN s0 * (s2 * s4 - s3 * s3) - s1 * (s1 * s4 - s2 * s3)
              + s2 * (s1 * s3 - s2 * s2) END AS det
    FROM cs
  )
)""",
)
_CHEMISTRY = _with(("ch",), f"SELECT player_a, player_b, {_r('coeff')} FROM ch")
_COUNTERS = _with(("ct",), "SELECT * FROM ct")
_APPEARANCES = _with(
    ("ap",),
    """SELECT match_id, player_id, match_date, team_id, start_minute, end_minute, played
       FROM ap""",
)
_LATEST = _with(
    ("la",), f"SELECT player_id, {_r('rating')}, {_r('delta')}, matches, age FROM la"
)
_FIT = _with(("co",), f"SELECT {_r('intercept')}, {_r('linear')}, {_r('quadratic')} FROM co")
_GRID = _with(
    ("co",),
    f"""SELECT CAST(x AS INTEGER) AS age,
          {_r("intercept + linear * x + quadratic * x * x", "rating")}
        FROM co, range(11, 61) t(x)""",
)
_PLAYER_COLUMNS = """player_id, name, birth_area, birth_date, foot, role, height, passport_area,
    weight"""

_SIDES = f"""
me AS (
  SELECT l_orderkey // 2 AS fixture_id, CAST(l_orderkey % 2 + 1 AS INTEGER) AS side,
    {_name("l_partkey")} AS name
  FROM lineitem
),
ck AS (
  SELECT fixture_id, side,
    count(*) FILTER (role = 'GK') <= 2 AND count(*) FILTER (role = 'MD') >= 1 AS valid
  FROM me LEFT JOIN pl USING (name) GROUP BY fixture_id, side
),
vd AS (
  SELECT fixture_id, coalesce(bool_or(valid) FILTER (side = 1), false) AS valid_1,
    coalesce(bool_or(valid) FILTER (side = 2), false) AS valid_2
  FROM ck GROUP BY fixture_id
),
rt AS (
  SELECT fixture_id, side, player_id, coalesce(rating, CAST(0.5 AS DOUBLE)) AS rating
  FROM me JOIN pl USING (name) LEFT JOIN la USING (player_id)
),
go AS (
  SELECT fixture_id, count(*) AS gone FROM rt WHERE rating < CAST(0.05 AS DOUBLE)
  GROUP BY fixture_id
)"""

_CHANCES = """
cm AS (
  SELECT a.fixture_id, avg(coalesce(coeff, CAST(0.5 AS DOUBLE))) AS chem
  FROM rt a JOIN rt b ON a.fixture_id = b.fixture_id AND a.side = 1 AND b.side = 2
  LEFT JOIN ch ON player_a = least(a.player_id, b.player_id)
              AND player_b = greatest(a.player_id, b.player_id)
  GROUP BY a.fixture_id
),
sr AS (
  SELECT fixture_id, avg(rating) FILTER (side = 1) AS m1, avg(rating) FILTER (side = 2) AS m2
  FROM rt GROUP BY fixture_id
),
wc AS (
  SELECT fixture_id, chem,
    (CAST(0.5 AS DOUBLE) + m1 * chem + (m1 * chem + m2 * chem) / 2) * 100 AS chance_1,
    (CAST(0.5 AS DOUBLE) + m1 * chem - (m1 * chem + m2 * chem) / 2) * 100 AS centered_1
  FROM cm JOIN sr USING (fixture_id)
)"""

_MATCH_SIDES = """
rt AS (
  SELECT match_id AS fixture_id, CAST(player_id % 2 + 1 AS INTEGER) AS side, player_id,
    rating
  FROM ap JOIN la USING (player_id) WHERE played
)"""

_CENTERS = """
av AS (
  SELECT player_id % 5 AS cluster, {means} FROM fp GROUP BY 1
)"""


def _assigned() -> str:
    means = ", ".join(f"avg({c}) AS m_{c}" for c in PROFILE)
    distance = " + ".join(f"({c} - m_{c}) * ({c} - m_{c})" for c in PROFILE)
    return _with(
        ("fp",),
        f"""SELECT player_id, av.cluster FROM fp, av
            QUALIFY row_number() OVER (
              PARTITION BY player_id ORDER BY {distance}, av.cluster) = 1""",
        _CENTERS.format(means=means),
    )


def _lists(kind: str, value: str) -> str:
    return f"""coalesce((SELECT string_agg({value}, ';' ORDER BY team, section, player_id)
        FROM en WHERE en.request_id = hd.request_id AND kind = '{kind}'), '') AS {kind}"""


def _json_list(kind: str, value: str) -> str:
    return f"""'"{kind}":[' || coalesce((SELECT string_agg({value}, ',' ORDER BY team, section, player_id)
        FROM en WHERE en.request_id = hd.request_id AND kind = '{kind}'), '') || ']'"""


_PROFILE_ANSWER = [
    "weight", "fouls", "goals", '"ownGoals"', "percent_pass_accuracy", "percent_shots_on_target",
]
_JSON_NAME = """'"' || name || '"'"""
_JSON_GOALS = """'{"name":"' || name || '","team_name":"' || team_name || '","number_of_goals":' || amount || '}'"""


def _json_field(name: str, quoted: bool) -> str:
    value = f"""'"' || {name} || '"'""" if quoted else f"CAST({name} AS VARCHAR)"
    return f"""coalesce(',"{name.strip('"')}":' || {value}, '')"""


ORACLES: dict[str, str] = {
    "classify_events": _with(("cl",), "SELECT * EXCLUDE (event_id) FROM cl"),
    "counters": _COUNTERS,
    "ratios": _with(("ra",), "SELECT * FROM ra"),
    "appearances": _APPEARANCES,
    "player_match": _PLAYER_MATCH,
    "match_steps": _with(
        ("hi",),
        f"""SELECT player_id, match_id, match_date, team_id, age, {_r("w", "weight")},
              {_r("c", "contribution")} FROM st""",
    ),
    "rating_history": _HISTORY,
    "rating_history_by_week": _HISTORY,
    "latest_rating": _LATEST,
    "current_match": _with(
        ("hi",),
        f"""SELECT match_id, hi.player_id, {_r("rating")}, {_r("delta")}, start_minute,
              end_minute, target, goals
            FROM hi JOIN pm USING (match_id, player_id)""",
    ),
    "rating_deltas": _with(
        ("hi",), f"SELECT match_id, player_id, team_id, {_r('delta')} FROM hi"
    ),
    "profile_totals": _with(("tt",), "SELECT * FROM tt"),
    "final_profile": _PROFILE,
    "chem_pairs": _with(
        ("pr",), f"SELECT match_id, player_a, player_b, {_r('contribution')} FROM pr"
    ),
    "chemistry": _CHEMISTRY,
    "chemistry_mirrored": _with(
        ("ch",),
        f"""SELECT player_a, player_b, {_r("coeff")} FROM ch UNION ALL
            SELECT player_b, player_a, {_r("coeff")} FROM ch""",
    ),
    "quadratic_features": _with(
        ("la",),
        f"""SELECT player_id, {_r("rating")}, CAST(age AS DOUBLE) AS age_1,
              CAST(age * age AS DOUBLE) AS age_2 FROM la""",
    ),
    "fit_quadratic": _FIT,
    "predict_grid": _GRID,
    "predict_by_age": _with(
        ("co",),
        f"""SELECT DISTINCT age,
              {_r("intercept + linear * age + quadratic * age * age", "rating")}
            FROM la, co""",
    ),
    "latest_prediction": """
        SELECT CAST(16 + user_id % 30 AS INTEGER) AS age, arg_max(value, event_id) AS rating
        FROM events GROUP BY 1""",
    "cluster_means": _with(
        ("fp",),
        f"""SELECT player_id % 5 AS cluster, {_r("avg(rating)", "cluster_rating")}
            FROM fp GROUP BY 1""",
    ),
    "cold_start": _with(
        ("fp",),
        f"""SELECT player_id, matches, {_r('''CASE WHEN matches < 25
              THEN avg(rating) OVER (PARTITION BY player_id % 5) ELSE rating END''', "rating")}
            FROM fp""",
    ),
    "assign_nearest": _assigned(),
    "roster_checks": _with(
        ("pl",),
        """SELECT *, gk = 1 AND fw >= 1 AND md >= 2 AND df >= 2 AS valid FROM (
             SELECT l_orderkey AS roster_id, count(*) FILTER (role = 'GK') AS gk,
               count(*) FILTER (role = 'DF') AS df, count(*) FILTER (role = 'MD') AS md,
               count(*) FILTER (role = 'FW') AS fw, count(*) FILTER (role IS NULL) AS unknown
             FROM lineitem LEFT JOIN pl ON l_partkey = player_id GROUP BY l_orderkey)""",
    ),
    "retired": _with(
        ("la", "pl"),
        f"""SELECT l_orderkey AS roster_id, name, {_r("rating")}
            FROM lineitem JOIN pl ON l_partkey = player_id JOIN la USING (player_id)
            WHERE rating < CAST(0.1 AS DOUBLE)""",
    ),
    "fallback_rating": _with(
        ("co",),
        f"""SELECT player_id, age, {_r('''coalesce(rating, CASE WHEN age BETWEEN 11 AND 60
               THEN intercept + linear * age + quadratic * age * age END, 0.5)''', "rating")}
            FROM (
              SELECT bi.player_id, la.rating, CAST(floor(CAST(
                date_diff('day', birth_date, DATE '2024-02-01') AS DOUBLE) / 365) AS INTEGER) AS age
              FROM bi LEFT JOIN la USING (player_id)
            ), co""",
    ),
    "win_chance": _with(
        ("la", "ap", "ch"),
        f"""SELECT fixture_id, {_r("chem")}, {_r("chance_1")},
              {_r("100 - chance_1", "chance_2")} FROM wc""",
        _MATCH_SIDES + "," + _CHANCES,
    ),
    "win_chance_centered": _with(
        ("la", "ap", "ch"),
        f"""SELECT fixture_id, {_r("chem")}, {_r("centered_1", "chance_1")},
              {_r("100 - centered_1", "chance_2")} FROM wc""",
        _MATCH_SIDES + "," + _CHANCES,
    ),
    "fixture_answers": _with(
        ("la", "pl", "ch"),
        f"""SELECT fixture_id, status,
              {_r("CASE WHEN status = 'ok' THEN chance_1 END", "chance_1")},
              {_r("CASE WHEN status = 'ok' THEN 100 - chance_1 END", "chance_2")}
            FROM (
              SELECT vd.fixture_id, chance_1,
                CASE WHEN NOT valid_1 THEN 'team 1 invalid' WHEN NOT valid_2 THEN 'team 2 invalid'
                  WHEN gone > 0 THEN 'retired players' ELSE 'ok' END AS status
              FROM vd LEFT JOIN go USING (fixture_id) LEFT JOIN wc USING (fixture_id)
            )""",
        _SIDES + "," + _CHANCES,
    ),
    "win_chance_answers": _with(
        ("la", "pl", "ch"),
        f"""SELECT fixture_id AS request_id, status, team1_name, team2_name,
              {_r("CASE WHEN status = 'ok' THEN chance_1 END", "chance_1")},
              {_r("CASE WHEN status = 'ok' THEN 100 - chance_1 END", "chance_2")},
              CASE WHEN status = 'retired players' THEN names ELSE '' END AS retired_names
            FROM (
              SELECT vd.fixture_id, chance_1, names, team1_name, team2_name,
                CASE WHEN NOT valid_1 THEN 'team 1 invalid' WHEN NOT valid_2 THEN 'team 2 invalid'
                  WHEN gone > 0 THEN 'retired players' ELSE 'ok' END AS status
              FROM vd LEFT JOIN go USING (fixture_id) LEFT JOIN wc USING (fixture_id)
              LEFT JOIN (
                SELECT fixture_id, string_agg(DISTINCT pl.name, ';' ORDER BY pl.name) AS names
                FROM rt JOIN pl USING (player_id) WHERE rating < CAST(0.05 AS DOUBLE)
                GROUP BY fixture_id
              ) USING (fixture_id)
              LEFT JOIN (
                SELECT fixture_id,
                  max(CASE WHEN side = 1 THEN 'Team ' || (2 * fixture_id) END) AS team1_name,
                  max(CASE WHEN side = 2 THEN 'Team ' || (2 * fixture_id + 1) END) AS team2_name
                FROM me GROUP BY fixture_id
              ) USING (fixture_id)
            )""",
        _SIDES + "," + _CHANCES,
    ),
    "player_profile": _with(
        ("rq", "pl", "fp"),
        """SELECT request_id, rq.name, pl.name IS NOT NULL AS registered, birth_area, birth_date,
             foot, role, height, passport_area, weight,
             CASE WHEN pl.name IS NOT NULL THEN coalesce(fouls, 0) END AS fouls,
             CASE WHEN pl.name IS NOT NULL THEN coalesce(goals, 0) END AS goals,
             CASE WHEN pl.name IS NOT NULL THEN coalesce(own_goals, 0) END AS "ownGoals",
             CASE WHEN pl.name IS NOT NULL THEN CAST(coalesce(trunc(
               CASE WHEN np + 2 * kp > 0
                    THEN CAST(anp + 2 * akp AS DOUBLE) / CAST(np + 2 * kp AS DOUBLE) * 100
                    ELSE 0 END), 0) AS INTEGER) END
               AS percent_pass_accuracy,
             CASE WHEN pl.name IS NOT NULL THEN coalesce(shots_on_target, 0) END
               AS percent_shots_on_target
           FROM rq LEFT JOIN pl ON rq.name = pl.name
           LEFT JOIN fp USING (player_id) WHERE req_type = 2""",
    ),
    "unregistered": _with(
        ("rq",),
        """SELECT request_id, name FROM rq
           WHERE req_type = 2 AND name NOT IN (SELECT c_name FROM customer)""",
    ),
    "resolve_contains": """
        SELECT doc_id, min(item_id) AS item_id
        FROM documents d JOIN benchmark b ON contains(d.text, b.text) GROUP BY doc_id""",
    "resolve_players": f"""
        WITH nm AS (
          SELECT DISTINCT CASE o_orderkey % 3 WHEN 0 THEN {_name("o_custkey")}
            WHEN 1 THEN 'Dr ' || {_name("o_custkey")} || ' II'
            ELSE 'Customer ' || o_custkey END AS name
          FROM orders
        ),
        wi AS (
          SELECT nm.name, min(c_custkey) AS player_id
          FROM nm JOIN customer ON contains(nm.name, c_name) GROUP BY nm.name
        )
        SELECT nm.name, coalesce(c_custkey, wi.player_id) AS player_id
        FROM nm LEFT JOIN customer ON nm.name = c_name LEFT JOIN wi ON nm.name = wi.name""",
    "match_details": _with(
        ("en",),
        f"""SELECT hd.*, {_lists("red_cards", "name")}, {_lists("yellow_cards", "name")},
              {_lists("goals", "name || '|' || team_name || '|' || amount")},
              {_lists("own_goals", "name || '|' || team_name || '|' || amount")}
            FROM hd""",
    ),
    "match_answers_json": _with(
        ("en",),
        f"""SELECT request_id, '{{"request_id":' || request_id || {_json_field("date", True)}
              || {_json_field("duration", True)} || {_json_field("winner", True)}
              || {_json_field("gameweek", False)} || {_json_field("venue", True)} || ','
              || {_json_list("red_cards", _JSON_NAME)} || ','
              || {_json_list("yellow_cards", _JSON_NAME)} || ','
              || {_json_list("goals", _JSON_GOALS)} || ','
              || {_json_list("own_goals", _JSON_GOALS)} || '}}' AS answer
            FROM hd""",
    ),
    "kmeans_checks": _with(
        ("fp",),
        """SELECT count(*) AS players, least(5, count(*)) AS clusters, true AS at_nearest, true AS same_again,
             true AS means_fit FROM fp""",
    ),
    "profile_csv": _PROFILE,
    "route_requests": """
        SELECT o_orderkey AS request_id, CASE WHEN o_orderkey % 4 < 2
          THEN CAST(o_orderkey % 4 + 1 AS INTEGER) ELSE 3 END AS route FROM orders""",
    "first_event": """
        SELECT user_id AS player_id, event_id, event_type, value FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1""",
    "parse_records": _with(
        ("ev",),
        """SELECT 'event' AS kind, count(*) AS records FROM ev
           UNION ALL SELECT 'match', count(DISTINCT match_id) FROM ev
           UNION ALL SELECT 'bad', count(*) FROM documents
             WHERE NOT starts_with(trim(text), '{')""",
    ),
    "json_counters": _COUNTERS,
    "json_appearances": _APPEARANCES,
    "dedupe_matches": _with(
        ("ev",), """SELECT match_id, CAST(min(d) AS INTEGER) AS day, min(event_id) AS event_id
           FROM ev GROUP BY match_id"""
    ),
    "matches_file": _with(
        ("en",),
        "SELECT match_id, label, day || ' 15:00:00' AS dateutc, gameweek, venue FROM mt",
    ),
    "players_csv": _with(("pl",), f"SELECT {_PLAYER_COLUMNS} FROM pl"),
    "profile_tsv": _PROFILE,
    "predictions_csv": _GRID,
    "chemistry_text": _CHEMISTRY,
    "stream_counters": _COUNTERS,
    "stream_ratings": _HISTORY,
    "stream_ratings_batches": _HISTORY,
    "stream_ratings_state": _HISTORY,
    "stream_recovery": _HISTORY,
    "stream_player_match": _PLAYER_MATCH,
    "stream_records": _with(
        ("en",),
        """SELECT 'bad' AS kind, count(*) AS records, CAST(sum(length(text)) AS BIGINT) AS total FROM documents
           UNION ALL
           SELECT 'event', count(*), CAST(sum(CASE event_type WHEN 'view' THEN 8 WHEN 'click' THEN 1
             WHEN 'purchase' THEN 10 WHEN 'signup' THEN 3 WHEN 'error' THEN 2 ELSE 0 END) AS BIGINT) FROM events
           UNION ALL
           SELECT 'match', count(*), CAST(sum(gameweek) AS BIGINT) FROM mt""",
    ),
    "stream_latest_prediction": _LATEST_PREDICTION,
    "stream_chemistry": _CHEMISTRY,
    "stream_quadratic": _with(
        ("hi",),
        f"""SELECT age, count(*) AS n, {_r("sum(rating)", "rating_sum")} FROM hi GROUP BY age""",
    ),
    "stream_predictions": _with(
        ("hi",),
        f"""SELECT DISTINCT age,
              {_r("intercept + linear * age + quadratic * age * age", "rating")}
            FROM hi, co""",
        _CURVE.format(rated="hi"),
    ),
    "stream_profile": _PROFILE,
}

ORACLES["profile_answers_json"] = f"""SELECT request_id, '{{"request_id":' || request_id
    || {_json_field("name", True)} || {_json_field("registered", False)}
    || {" || ".join(_json_field(c, True) for c in ("birth_area", "birth_date", "foot", "role"))}
    || {_json_field("height", False)} || {_json_field("passport_area", True)}
    || {" || ".join(_json_field(c, False) for c in _PROFILE_ANSWER)} || '}}' AS answer
  FROM ({ORACLES["player_profile"]})"""
