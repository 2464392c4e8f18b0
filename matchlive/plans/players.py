"""What each player, team and match adds up to."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchlive.functions import is_goal, is_shot, is_touch, safe_xg
from matchlive.functions.rules import PASS

PLAYER = ("match_id", "team_name", "player_id")
NAMED_PLAYER = (*PLAYER, "player_name")
SUMS = ("shots", "goals", "passes", "touches", "xg_total")
LEVELS = {0: "player", 1: "team", 3: "match"}


def player_totals(silver: DataFrame) -> DataFrame:
    """Shots, goals, passes, touches and xG per name of a player of a team in a match.

    Events without a player are a player of their own, with a null id. A touch
    is an event with the ball at a known place.
    """
    kind = F.col("event_type")
    return silver.groupBy(*NAMED_PLAYER).agg(
        F.count_if(is_shot(kind)).alias("shots"),
        F.count_if(is_goal(kind, F.col("shot_outcome"))).alias("goals"),
        F.count_if(F.coalesce(kind == PASS, F.lit(False))).alias("passes"),
        F.count_if(is_touch(kind, F.col("loc_x"), F.col("loc_y"))).alias("touches"),
        F.sum(safe_xg(F.col("xg"))).alias("xg_total"),
    )


def player_spotlight(totals: DataFrame) -> DataFrame:
    """The totals together with those per team and per match.

    A player has the last of its names in alphabetical order. ``level`` tells subtotals from the rows of events without a player or team,
    which have nulls in the same places. The subtotals are made of the players'
    rows, not of events.
    """
    sums = [F.sum(name).alias(name) for name in SUMS]
    level = F.grouping_id()
    names = F.create_map(*[F.lit(part) for pair in LEVELS.items() for part in pair])
    found = totals.groupingSets([PLAYER, PLAYER[:2], PLAYER[:1]], *PLAYER).agg(
        level.cast("int").alias("_level"), F.max("player_name").alias("player_name"), *sums
    )
    name = F.when(F.col("_level") == 0, F.col("player_name"))
    return found.select(
        F.try_element_at(names, F.col("_level")).alias("level"), *PLAYER, name.alias("player_name"), *SUMS
    )


def player_top(totals: DataFrame, rows: int) -> DataFrame:
    """The players of each match with the most xG; then goals, shots, touches and the smaller id decide.

    The rank limit runs in each task before the shuffle.
    """
    best = Window.partitionBy("match_id").orderBy(
        F.round("xg_total", 6).desc(), F.desc("goals"), F.desc("shots"), F.desc("touches"), "player_id", "team_name"
    )
    sums = [F.sum(name).alias(name) for name in SUMS]
    known = totals.filter(F.col("player_id").isNotNull())
    known = known.groupBy(*PLAYER).agg(F.max("player_name").alias("player_name"), *sums)
    ranked = known.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= rows)
    return ranked.select("match_id", "rank", "team_name", "player_id", "player_name", *SUMS)
