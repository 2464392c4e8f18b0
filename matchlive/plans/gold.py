"""Gold tables: shots, xG timeline, match state, momentum.

Every function takes Silver rows (or another Gold table) of any number of
matches of any size.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchlive.functions import (
    is_attacking,
    is_goal,
    is_shot,
    minutes_remaining,
    win_probability,
)
from matchlive.functions.rules import GOAL, SHOT
from matchlive.operators.skew import join_on, ordered_pieces, running_sum
from matchlive.schemas import MOMENTUM, SHOTS, columns

MATCH = ("match_id",)
TEAM = ("match_id", "team_name")
MOMENTUM_SECONDS = 300
EVEN_CHANCE = 0.5


def shots(silver: DataFrame) -> DataFrame:
    return silver.filter(F.col("event_type") == SHOT).select(*columns(SHOTS))


def xg_timeline(silver: DataFrame) -> DataFrame:
    """xG and number of shots per team and minute; events without positive xG do not count."""
    return (
        silver.filter(F.col("xg") > 0)
        .groupBy(*TEAM, "minute")
        .agg(F.sum("xg").alias("xg_total"), F.count(F.lit(1)).alias("shots_total"))
    )


def team_totals(silver: DataFrame) -> DataFrame:
    """Goals, xG and newest minute per team."""
    return silver.groupBy(*TEAM).agg(
        F.count_if(F.col("shot_outcome") == GOAL).alias("goals"),
        F.sum("xg").alias("xg_total"),
        F.max("minute").alias("latest_minute"),
    )


def with_win_probability(totals: DataFrame) -> DataFrame:
    """Adds each team's win probability; 0.5 unless the match has exactly two teams.

    Events without a team count as a team here, so a match of two named teams
    that also has such events stays at 0.5. The alphabetically first team gets
    the model's value and the other one the complement. The clock is that of the match's newest event. The rows are one
    per team, so a match is a small window group.
    """
    match = Window.partitionBy(*MATCH)
    in_order = match.orderBy("team_name")
    first = F.row_number().over(in_order) == 1
    other = {
        name: F.when(first, F.lead(name).over(in_order)).otherwise(F.lag(name).over(in_order))
        for name in ("goals", "xg_total")
    }
    left = minutes_remaining(F.max("latest_minute").over(match))
    lead = F.when(first, 1).otherwise(-1)
    of_first = win_probability(
        lead * (F.col("goals") - other["goals"]),
        lead * (F.col("xg_total") - other["xg_total"]),
        left,
    )
    of_row = F.when(first, of_first).otherwise(F.round(1 - of_first, 4))
    two_teams = F.count(F.lit(1)).over(match) == 2
    chance = F.when(two_teams, F.coalesce(of_row, F.lit(EVEN_CHANCE))).otherwise(EVEN_CHANCE)
    return totals.withColumn("win_probability", chance)


def match_state(silver: DataFrame) -> DataFrame:
    return with_win_probability(team_totals(silver))


def _with_time_window(per_second: DataFrame, by: Sequence[str], seconds: int) -> DataFrame:
    """Adds the time window that ends with the match's newest second; both ends belong to it."""
    newest = F.max("match_second").over(Window.partitionBy(*by))
    return per_second.withColumn("window_end_second", newest).withColumn(
        "window_start_second", F.greatest(F.lit(0), F.col("window_end_second") - seconds)
    )


def _share(by: Sequence[str]):
    total = F.sum("attacking_actions").over(Window.partitionBy(*by))
    return F.round(F.try_divide(F.col("attacking_actions"), total.cast("double")), 3)


def actions_per_second(silver: DataFrame, by: Sequence[str] = MATCH) -> DataFrame:
    """Attacking actions per team and second; seconds without one are there with 0."""
    return (
        silver.filter(F.col("match_second").isNotNull())
        .groupBy(*by, "team_name", "match_second")
        .agg(F.count_if(is_attacking(F.col("event_type"))).alias("actions"))
    )


def in_last_window(per_second: DataFrame, seconds: int = MOMENTUM_SECONDS) -> DataFrame:
    """The rows of ``actions_per_second`` that the momentum of a match is made of."""
    bounded = _with_time_window(per_second, MATCH, seconds)
    recent = bounded.filter(F.col("match_second") >= F.col("window_start_second"))
    return recent.drop("window_start_second", "window_end_second")


def momentum_of(
    per_second: DataFrame, by: Sequence[str] = MATCH, seconds: int = MOMENTUM_SECONDS
) -> DataFrame:
    """Momentum from ``actions_per_second``, separately for each value of ``by``."""
    in_window = (
        _with_time_window(per_second, by, seconds)
        .filter(F.col("match_second") >= F.col("window_start_second"))
        .filter(F.col("actions") > 0)
    )
    teams = in_window.groupBy(*by, "team_name").agg(
        F.sum("actions").alias("attacking_actions"),
        F.max("window_start_second").alias("window_start_second"),
        F.max("window_end_second").alias("window_end_second"),
    )
    extra = [name for name in by if name not in MATCH]
    return teams.withColumn("dominance_pct", _share(by)).select(*extra, *columns(MOMENTUM))


def momentum(silver: DataFrame, seconds: int = MOMENTUM_SECONDS) -> DataFrame:
    """Attacking actions per team in the last seconds of the match clock, and their share.

    Rows are counted per team and second first, so the window over a match sees
    seconds, not events.
    """
    return momentum_of(actions_per_second(silver), seconds=seconds)


def team_overview(silver: DataFrame, seconds: int = MOMENTUM_SECONDS) -> DataFrame:
    """Match state and momentum share of each team in one pass over Silver.

    The share is null for a team without an attacking action in the time window.
    """
    per_second = silver.groupBy(*TEAM, "match_second").agg(
        F.count_if(is_attacking(F.col("event_type"))).alias("actions"),
        F.count_if(F.col("shot_outcome") == GOAL).alias("goals"),
        F.sum("xg").alias("xg_total"),
        F.max("minute").alias("latest_minute"),
    )
    recent = F.col("match_second") >= F.col("window_start_second")
    teams = (
        _with_time_window(per_second, MATCH, seconds)
        .groupBy(*TEAM)
        .agg(
            F.sum("goals").alias("goals"),
            F.sum("xg_total").alias("xg_total"),
            F.max("latest_minute").alias("latest_minute"),
            F.sum(F.when(recent & (F.col("actions") > 0), F.col("actions"))).alias(
                "attacking_actions"
            ),
        )
    )
    shared = teams.withColumn("dominance_pct", _share(MATCH)).drop("attacking_actions")
    return with_win_probability(shared)


def momentum_series(silver: DataFrame, seconds: int = MOMENTUM_SECONDS) -> DataFrame:
    """Attacking actions of the event's team in the seconds up to each event.

    Counted per team and second, so that the window sees seconds, and joined
    back to the events of that second.
    """
    name = f"attacking_{seconds}s"
    rows = silver.filter(F.col("match_second").isNotNull()).select(
        *TEAM, "match_second", "event_index", "event_id", "event_type"
    )
    trailing = Window.partitionBy(*TEAM).orderBy("match_second").rangeBetween(-seconds, 0)
    counts = actions_per_second(rows).withColumn(name, F.sum("actions").over(trailing))
    joined = join_on(rows, counts.drop("actions"), (*TEAM, "match_second"))
    return joined.select(*TEAM, "match_second", "event_index", name)


def win_probability_by_shot(silver: DataFrame, pieces: int | None = None) -> DataFrame:
    """Win probability of ``team1`` after each shot.

    ``team1`` is the alphabetically first team that shoots in the match.
    """
    order = [F.coalesce("event_index", F.lit(0)), F.col("event_id")]
    rows = (
        silver.filter(is_shot(F.col("event_type")))
        .withColumn("goal", is_goal(F.col("event_type"), F.col("shot_outcome")).cast("bigint"))
        .select(*TEAM, "event_index", "event_id", "minute", "goal", "xg")
    )
    cut = ordered_pieces(rows, MATCH, order, pieces)
    firsts = cut.groupBy(*MATCH).agg(F.min("team_name").alias("team1"))
    for_team1 = F.when(F.col("team_name") == F.col("team1"), 1).otherwise(-1)
    summed = running_sum(
        join_on(cut, firsts, MATCH),
        MATCH,
        order,
        {"goal_diff": for_team1 * F.col("goal"), "xg_diff": for_team1 * F.col("xg")},
    )
    left = minutes_remaining(F.col("minute"))
    return summed.select(
        *MATCH,
        "event_index",
        "team1",
        "goal_diff",
        "xg_diff",
        left.alias("minutes_remaining"),
        win_probability(F.col("goal_diff"), F.col("xg_diff"), left).alias("p_team1"),
    )
