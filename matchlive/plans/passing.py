"""Passing and pressure per team: completion of passes, and momentum by weighted chances.

The input is Silver with the columns of ``SILVER_DETAILS``. Rows are counted per
team and second first, so windows see seconds, not events.
"""

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchlive.functions import in_box, is_completed, is_shot, safe_xg
from matchlive.operators.skew import ordered_pieces, previous_value

MATCH = ("match_id",)
TEAM = ("match_id", "team_name")
SECOND = (*TEAM, "match_second")
POSSESSION = ("match_id", "possession", "team_name")
WINDOW_SECONDS = 300


class Weights(NamedTuple):
    """What one of each is worth."""

    shot: float = 1.0
    xg: float = 1.0
    key_pass: float = 1.0
    box_entry: float = 1.0


def trailing(per_second: DataFrame, sums: Sequence[str], seconds: int) -> DataFrame:
    """The sums over the seconds up to and including each second of a team; both ends belong to it."""
    frame = Window.partitionBy(*TEAM).orderBy("match_second").rangeBetween(-seconds, 0)
    return per_second.withColumns({name: F.sum(name).over(frame) for name in sums})


def pass_completion(silver: DataFrame, seconds: int = WINDOW_SECONDS) -> DataFrame:
    """Passes tried and completed by a team in the seconds up to each second in which it has an event.

    A pass is an event of that type with a pass object; without an outcome it
    arrived. The share is null where no pass was tried.
    """
    done = is_completed(F.col("is_pass"), F.col("pass_outcome"))
    per_second = (
        silver.filter(F.col("match_second").isNotNull())
        .groupBy(*SECOND)
        .agg(F.count_if("is_pass").alias("attempted"), F.count_if(done).alias("completed"))
    )
    share = F.round(F.try_divide(F.col("completed").cast("double"), F.col("attempted").cast("double")), 3)
    return trailing(per_second, ("attempted", "completed"), seconds).withColumn("completion_pct", share)


def chances_per_second(silver: DataFrame, pieces: int | None = None) -> DataFrame:
    """Shots, xG, key passes and box entries per team and second.

    A box entry is an event in the attacked box whose predecessor in the team's
    possession lay outside. Only events at a known place count as predecessors.
    Negative xG counts as none.
    """
    order = [F.coalesce("event_index", F.lit(0)), F.col("event_id")]
    rows = silver.select(
        *SECOND,
        "possession",
        "event_index",
        "event_id",
        in_box(F.col("loc_x"), F.col("loc_y")).alias("inside"),
        is_shot(F.col("event_type")).alias("is_shot"),
        safe_xg(F.col("xg")).alias("xg"),
        "is_key_pass",
    )
    cut = ordered_pieces(rows, POSSESSION, order, pieces)
    placed = cut.filter(F.col("possession").isNotNull() & F.col("inside").isNotNull())
    followed = previous_value(placed, POSSESSION, order, "inside", "was_inside")
    entries = followed.filter(F.col("inside") & ~F.col("was_inside"))
    nothing = F.lit(0).cast("bigint")
    of_events = cut.groupBy(*SECOND).agg(
        F.count_if("is_shot").alias("shots"),
        F.sum("xg").alias("xg_total"),
        F.count_if("is_key_pass").alias("key_passes"),
    )
    of_entries = entries.groupBy(*SECOND).agg(F.count(F.lit(1)).alias("box_entries"))
    both = of_events.withColumn("box_entries", nothing).unionByName(
        of_entries.withColumns({"shots": nothing, "xg_total": F.lit(0.0), "key_passes": nothing})
    )
    sums = {name: F.sum(name).alias(name) for name in MEASURES}
    return both.filter(F.col("match_second").isNotNull()).groupBy(*SECOND).agg(*sums.values())


MEASURES = ("shots", "xg_total", "key_passes", "box_entries")


def _weighted(weights: Weights) -> Column:
    parts = (F.lit(float(weight)) * F.col(name) for weight, name in zip(weights, MEASURES, strict=True))
    return sum(parts, F.lit(0.0))


def weighted_momentum_series(
    silver: DataFrame, weights: Weights = Weights(), seconds: int = WINDOW_SECONDS, pieces: int | None = None
) -> DataFrame:
    """Chances of a team in the seconds up to each second in which it has an event, and their weighted sum."""
    sums = trailing(chances_per_second(silver, pieces), MEASURES, seconds)
    return sums.withColumn("weighted", _weighted(weights))


def weighted_momentum(
    silver: DataFrame, weights: Weights = Weights(), seconds: int = WINDOW_SECONDS, pieces: int | None = None
) -> DataFrame:
    """The same at the newest second of the match, with each team's share of the match's sum.

    Every team with an event at a known second has a row; shares are null where nobody had a chance.
    """
    newest = F.max("match_second").over(Window.partitionBy(*MATCH))
    per_second = chances_per_second(silver, pieces).withColumn("window_end_second", newest)
    start = F.greatest(F.lit(0), F.col("window_end_second") - seconds)
    recent = F.col("match_second") >= start
    teams = per_second.groupBy(*TEAM).agg(
        *(F.coalesce(F.sum(F.when(recent, F.col(name))), F.lit(0)).alias(name) for name in MEASURES),
        F.max(start).alias("window_start_second"),
        F.max("window_end_second").alias("window_end_second"),
    )
    weighed = teams.withColumn("weighted", _weighted(weights))
    total = F.sum("weighted").over(Window.partitionBy(*MATCH))
    return weighed.withColumn("weighted_share", F.round(F.try_divide("weighted", total), 3))
