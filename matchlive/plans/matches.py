"""The catalogue of matches: who plays, the score, and whether it still goes on.

A match is played in one or more sittings: stretches of its events without a gap
in their time of arrival. A sitting is closed once the newest event of all
matches, less the lateness allowed, is a whole gap past its last one. A match
whose newest event lies in a closed sitting is finished, until it goes on.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchlive.functions.rules import GOAL
from matchlive.plans.views import DISPLAYED_TEAMS, NO_TEAM
from matchlive.schemas import SITTINGS, columns

MATCH = ("match_id",)
TEAM = ("match_id", "team_name")
GAP = "30 minutes"
LATENESS = "10 minutes"


def team_times(silver: DataFrame) -> DataFrame:
    """Goals, events, first and last arrival per team."""
    return silver.groupBy(*TEAM).agg(
        F.count_if(F.col("shot_outcome") == GOAL).alias("goals"),
        F.count(F.lit(1)).alias("events"),
        F.min("event_time").alias("first_event"),
        F.max("event_time").alias("last_event"),
    )


def sittings(events: DataFrame, gap: str = GAP, weight=None) -> DataFrame:
    """Stretches of a match's events that no gap interrupts; of a batch, or of a stream with a watermark."""
    each = F.lit(1) if weight is None else F.col(weight)
    found = events.groupBy(*MATCH, F.session_window("event_time", gap).alias("sitting")).agg(
        F.min("event_time").alias("sitting_start"),
        F.max("event_time").alias("sitting_end"),
        F.sum(each).cast("bigint").alias("events"),
    )
    return found.select(*columns(SITTINGS))


def closed_sittings(silver: DataFrame, gap: str = GAP, lateness: str = LATENESS) -> DataFrame:
    """The sittings that a stream of the same events would have closed at its end.

    Events are counted per time first, so that a large match comes to the session
    windows as its distinct times.
    """
    counted = silver.groupBy(*MATCH, "event_time").agg(F.count(F.lit(1)).alias("_events"))
    watermark = silver.agg(F.max("event_time") - F.expr(f"INTERVAL {lateness}")).scalar()
    over = F.col("sitting_end") + F.expr(f"INTERVAL {gap}") <= watermark
    return sittings(counted, gap, "_events").filter(over)


def catalogue(times: DataFrame, closed: DataFrame) -> DataFrame:
    """One row per match from ``team_times`` and its closed sittings.

    Teams are the first two in alphabetical order, ``?`` where there is none;
    events without a team count as events only. Both inputs have few rows a match.
    """
    position = F.row_number().over(Window.partitionBy(*MATCH).orderBy(F.asc_nulls_last("team_name")))
    placed = times.withColumn("position", F.when(F.col("team_name").isNotNull(), position))

    def of(team: int, column: str):
        return F.max(F.when(F.col("position") == team, F.col(column)))

    teams = {f"team{n}": F.coalesce(of(n, "team_name"), F.lit(NO_TEAM)) for n in range(1, DISPLAYED_TEAMS + 1)}
    goals = {f"goals{n}": F.coalesce(of(n, "goals"), F.lit(0)).cast("bigint") for n in range(1, DISPLAYED_TEAMS + 1)}
    matches = placed.groupBy(*MATCH).agg(
        *(value.alias(name) for name, value in {**teams, **goals}.items()),
        F.sum("events").alias("events"),
        F.min("first_event").alias("first_event"),
        F.max("last_event").alias("last_event"),
    )
    over = closed.groupBy(F.col("match_id").alias("_match")).agg(
        F.count(F.lit(1)).alias("closed"), F.max("sitting_end").alias("_end")
    )
    every = matches.join(over, F.col("match_id").eqNullSafe(F.col("_match")), "left")
    finished = F.coalesce(F.col("_end") >= F.col("last_event"), F.lit(False))
    return every.select(
        *matches.columns,
        F.coalesce("closed", F.lit(0)).cast("bigint").alias("closed_sittings"),
        F.when(finished, "finished").otherwise("live").alias("status"),
    )


def match_catalogue(silver: DataFrame, gap: str = GAP, lateness: str = LATENESS) -> DataFrame:
    return catalogue(team_times(silver), closed_sittings(silver, gap, lateness))
