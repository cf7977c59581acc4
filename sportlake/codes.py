"""Fixed values of the event feed and of the rating rules."""

# Event codes.
PASS = 8
DUEL = 1
SHOT = 10
FREE_KICK = 3
FOUL = 2

# Tag codes.
TAG_GOAL = 101
TAG_OWN_GOAL = 102
TAG_KEY_PASS = 302
TAG_NEUTRAL = 702
TAG_WON = 703
TAG_ACCURATE = 1801

# Fixed value: sub-event code of a penalty.
PENALTY = 35

# Start of the rating and chemistry scales.
START_RATING = 0.5
# Parts of one that ratings are given in, a power of two.
RATING_GRID = 1 << 47
START_CHEMISTRY = 0.5

# A full match in minutes and the bonus for playing all of it.
FULL_MATCH = 90
FULL_MATCH_BONUS = 1.05

# Share of the contribution lost per foul and per own goal.
FOUL_PENALTY = 0.005
OWN_GOAL_PENALTY = 0.05

# Days per year when ages are derived from day counts.
YEAR_DAYS = 365

# Spelling fixes applied to requested match labels.
LABEL_ALIASES = {"Bournmouth": "Bournemouth"}

# A valid roster, as role -> (least, most); None is open ended.
ROSTER_QUOTAS = {"GK": (1, 1), "FW": (1, None), "MD": (2, None), "DF": (2, None)}

COUNTERS = [
    "anp",
    "akp",
    "np",
    "kp",
    "dw",
    "nd",
    "td",
    "shots",
    "on_target_goal",
    "on_target_notgoal",
    "on_target",
    "fouls",
    "own_goals",
    "free_kicks",
    "eff_free_kicks",
    "penalties",
    "goals",
]
