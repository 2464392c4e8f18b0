"""Tables for display, built on Silver and Gold."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchlive.functions import is_goal
from matchlive.operators.skew import join_on
from matchlive.schemas import SILVER, columns

MATCH = ("match_id",)
TEAM = ("match_id", "team_name")
DISPLAYED_TEAMS = 2
NO_TEAM = "?"
EVEN_CHANCE = 0.5

# Colours of the shot map.
OUTCOME_COLOURS = {
    "Goal": "gold",
    "Saved": "dodgerblue",
    "Off T": "tomato",
    "Blocked": "orange",
    "Wayward": "grey",
    "Post": "orchid",
}
TEAM_COLOURS = ("#75aadb", "#ffffff")

# Columns of the displayed event log.
EVENT_LOG_COLUMNS = ("minute", "second", "team_name", "player_name", "event_type", "xg")
EVENT_LOG_ROWS = 20


def displayed_teams(rows: DataFrame) -> DataFrame:
    """The first two teams of each match in alphabetical order, with their position.

    Names are made distinct and limited to two per match before the shuffle.
    """
    position = F.row_number().over(Window.partitionBy(*MATCH).orderBy("team_name"))
    names = rows.filter(F.col("team_name").isNotNull()).select(*TEAM).distinct()
    return names.withColumn("position", position).filter(
        F.col("position") <= DISPLAYED_TEAMS
    )


def team_list(rows: DataFrame) -> DataFrame:
    """Sorted team names per match and their number."""
    names = rows.filter(F.col("team_name").isNotNull()).select(*TEAM).distinct()
    return names.groupBy(*MATCH).agg(
        F.array_sort(F.collect_list("team_name")).alias("teams"),
        F.count(F.lit(1)).alias("team_count"),
    )


def xg_race(timeline: DataFrame) -> DataFrame:
    """Running xG per displayed team over the minutes.

    The input has one row per team and minute, so both windows stay small.
    """
    position = F.dense_rank().over(Window.partitionBy(*MATCH).orderBy("team_name"))
    so_far = (
        Window.partitionBy(*TEAM)
        .orderBy("minute")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    named = timeline.filter(F.col("team_name").isNotNull())
    shown = named.withColumn("_position", position).filter(
        F.col("_position") <= DISPLAYED_TEAMS
    )
    return shown.select(
        *TEAM, "minute", "xg_total", F.sum("xg_total").over(so_far).alias("xg_cumulative")
    )


def with_momentum(state: DataFrame, momentum: DataFrame) -> DataFrame:
    """The match-state table with each team's momentum share, null where there is none."""
    return join_on(state, momentum.select(*TEAM, "dominance_pct"), TEAM, "left")


def kpi_row(teams: DataFrame) -> DataFrame:
    """One row per match: goals, xG, win probability and momentum of both teams.

    The input is ``with_momentum`` or ``gold.team_overview``. Team 1 is the
    alphabetically first one; events without a team are not shown. Percentages
    are rounded in decimal arithmetic; the momentum ones are cut to whole numbers.
    """
    position = F.row_number().over(Window.partitionBy(*MATCH).orderBy("team_name"))
    named = teams.filter(F.col("team_name").isNotNull())
    shown = named.withColumn("position", position).filter(
        F.col("position") <= DISPLAYED_TEAMS
    )

    def of(team: int, column: str):
        return F.max(F.when(F.col("position") == team, F.col(column)))

    both = shown.groupBy(*MATCH).agg(
        of(1, "team_name").alias("team1"),
        F.coalesce(of(1, "goals"), F.lit(0)).alias("goals1"),
        F.coalesce(of(1, "xg_total"), F.lit(0.0)).alias("xg1"),
        F.coalesce(of(2, "team_name"), F.lit(NO_TEAM)).alias("team2"),
        F.coalesce(of(2, "goals"), F.lit(0)).alias("goals2"),
        F.coalesce(of(2, "xg_total"), F.lit(0.0)).alias("xg2"),
        F.coalesce(of(1, "win_probability"), F.lit(EVEN_CHANCE)).alias("chance"),
        F.coalesce(of(1, "dominance_pct"), F.lit(EVEN_CHANCE)).alias("share"),
    )

    def xg(name: str):
        return F.round(F.col(name).cast("decimal(18,6)"), 2).cast("double")

    percent = F.round(F.col("chance").cast("decimal(9,4)") * 100, 1)
    return both.select(
        *MATCH,
        "team1",
        "goals1",
        xg("xg1").alias("xg1"),
        "team2",
        "goals2",
        xg("xg2").alias("xg2"),
        percent.cast("double").alias("p1_pct"),
        (100 - percent).cast("double").alias("p2_pct"),
        (F.col("share") * 100).cast("int").alias("dom1_pct"),
        ((1 - F.col("share")) * 100).cast("int").alias("dom2_pct"),
    )


def _lookup(key: str, values: dict) -> Column:
    pairs = [F.lit(part) for pair in values.items() for part in pair]
    return F.try_element_at(F.create_map(*pairs), F.col(key))


def shot_map(shots: DataFrame) -> DataFrame:
    """Markers for the shots of the displayed teams with one of six outcomes.

    The teams are at most two rows per match, so a match with many shots is
    split by the join among tasks.
    """
    teams = displayed_teams(shots).select(*TEAM, "position")
    marked = join_on(shots, teams, TEAM).filter(F.col("shot_outcome").isin(*OUTCOME_COLOURS))
    team_colours = dict(enumerate(TEAM_COLOURS, start=1))
    return marked.select(
        *MATCH,
        "event_id",
        "team_name",
        "player_name",
        "loc_x",
        "loc_y",
        "xg",
        F.col("shot_outcome").alias("outcome"),
        (F.col("xg") * 60 + 6).alias("marker_size"),
        F.concat_ws(" — ", "team_name", "shot_outcome").alias("label"),
        _lookup("shot_outcome", OUTCOME_COLOURS).alias("colour"),
        _lookup("position", team_colours).alias("team_colour"),
    )


def shot_zone(x: Column, y: Column) -> Column:
    """Pitch zone of a shot towards x = 120 on a 120 by 80 pitch."""
    return (
        F.when(x.isNull() | y.isNull(), "unknown")
        .when((x >= 114) & y.between(30, 50), "six_yard")
        .when((x >= 102) & y.between(18, 62), "box")
        .when(x >= 60, "attacking_half")
        .otherwise("own_half")
    )


def shot_zones(shots: DataFrame) -> DataFrame:
    zone = shot_zone(F.col("loc_x"), F.col("loc_y"))
    return shots.groupBy(*MATCH, zone.alias("zone")).agg(
        F.count(F.lit(1)).alias("shots"),
        F.count_if(is_goal(F.lit("Shot"), F.col("shot_outcome"))).alias("goals"),
        F.sum("xg").alias("xg_total"),
    )


def newest_events(events: DataFrame, rows: int = EVENT_LOG_ROWS) -> DataFrame:
    """The newest events per match. The rank limit is applied in each task before the shuffle."""
    return _ranked(events).filter(F.col("rank") <= rows).drop("rank")


def _ranked(events: DataFrame) -> DataFrame:
    newest = Window.partitionBy(*MATCH).orderBy(
        F.desc("match_second"), F.desc("event_index"), F.desc("event_id")
    )
    return events.withColumn("rank", F.row_number().over(newest))


def event_log(events: DataFrame, rows: int = EVENT_LOG_ROWS) -> DataFrame:
    """Newest events per match with their rank; columns the input lacks are left out."""
    shown = [name for name in EVENT_LOG_COLUMNS if name in events.columns]
    return _ranked(events).filter(F.col("rank") <= rows).select(*MATCH, "rank", *shown)


def table_head(silver: DataFrame, rows: int = 10) -> DataFrame:
    order = ("event_index", "event_id", "match_id")
    return silver.orderBy(*order).limit(rows).select(*columns(SILVER))


def row_counts(table: DataFrame, names: dict[str, Column | None]) -> DataFrame:
    """Rows and distinct matches of a table and of named parts of it, in one pass.

    A part is given by a predicate, the whole table by None. Rows are counted
    per match first.
    """
    parts = {n: F.lit(True) if part is None else part for n, part in names.items()}
    per_match = table.groupBy(*MATCH).agg(
        *(F.count_if(part).alias(name) for name, part in parts.items())
    )
    known = F.col("match_id").isNotNull()
    totals = per_match.agg(
        *(
            F.struct(
                F.lit(name).alias("table_name"),
                F.coalesce(F.sum(name), F.lit(0)).cast("bigint").alias("row_count"),
                F.count_if((F.col(name) > 0) & known).alias("distinct_matches"),
            ).alias(name)
            for name in parts
        )
    )
    return totals.select(F.inline(F.array(*parts)))
