"""Event classification, expected goals (xG) and the win-probability heuristic."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from matchlive.functions.clock import FULL_TIME

# Labels used in the event documents.
SHOT = "Shot"
PASS = "Pass"
GOAL = "Goal"
ATTACKING_TYPES = (
    "Shot",
    "Dribble",
    "Carry",
    "Pass",
    "Ball Receipt*",
    "Dribbled Past",
    "Miscontrol",
)

# Types of event in which a player has the ball.
TOUCH_TYPES = ("Shot", "Dribble", "Carry", "Pass", "Ball Receipt*", "Miscontrol")

# The box of the side that is attacked, on a 120 by 80 pitch.
BOX_X, BOX_Y = 102, (18, 62)

# Weights of the win-probability model.
GOAL_WEIGHT_START = 1.5
GOAL_WEIGHT_GAIN = 2.0
XG_WEIGHT_START = 0.6


def _known(predicate: Column) -> Column:
    return F.coalesce(predicate, F.lit(False))


def is_shot(event_type: Column) -> Column:
    return _known(event_type == SHOT)


def is_goal(event_type: Column, shot_outcome: Column) -> Column:
    return _known((event_type == SHOT) & (shot_outcome == GOAL))


def is_attacking(event_type: Column) -> Column:
    return _known(event_type.isin(*ATTACKING_TYPES))


def is_touch(event_type: Column, x: Column, y: Column) -> Column:
    """A player's event with the ball at a known place."""
    return _known(event_type.isin(*TOUCH_TYPES)) & x.isNotNull() & y.isNotNull()


def in_box(x: Column, y: Column) -> Column:
    """Whether a place lies in the attacked box; null where it is unknown."""
    return F.when(x.isNotNull() & y.isNotNull(), (x >= BOX_X) & y.between(*BOX_Y))


def is_completed(is_pass: Column, pass_outcome: Column) -> Column:
    """A pass without an outcome arrived; what is no pass did not."""
    return is_pass & pass_outcome.isNull()


def safe_xg(xg: Column) -> Column:
    """xG with null, negative and non-numeric (NaN) values counted as 0."""
    value = xg.cast("double")
    return F.greatest(F.lit(0.0), F.coalesce(F.when(~F.isnan(value), value), F.lit(0.0)))


def win_probability(goal_diff: Column, xg_diff: Column, minutes_left: Column) -> Column:
    """Chance, to 4 decimals, of the team that the differences favour when positive.

    A logistic curve: as time runs out a goal weighs more and xG weighs less.
    """
    left = F.when(minutes_left < 0, 0).when(minutes_left > FULL_TIME, FULL_TIME).otherwise(minutes_left)
    played = F.lit(1.0) - left / F.lit(float(FULL_TIME))
    goal_weight = F.lit(GOAL_WEIGHT_START) + F.lit(GOAL_WEIGHT_GAIN) * played
    xg_weight = F.lit(XG_WEIGHT_START) * (F.lit(1.0) - played)
    logit = goal_weight * goal_diff + xg_weight * xg_diff
    return F.round(F.lit(1.0) / (F.lit(1.0) + F.exp(-logit)), 4)
