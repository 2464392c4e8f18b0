"""The views of a dashboard, read from the tables the jobs keep up to date."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlive.plans import matches, players, views
from matchlive.schemas import SHOTS, SILVER, SITTINGS
from matchlive.sources.tables import read_table
from matchlive.streaming import folded, jobs


def live_views(
    spark: SparkSession, silver_path: str, gold_path: str, match_id: int | None = None
) -> dict[str, DataFrame]:
    """KPI row, xG race, shot map, event log, players and catalogue entry of one match, or of all.

    The event log comes from the job that keeps the newest events, of which only
    the match's bucket is read; where that job does not run, from all of Silver.
    """

    def of_match(rows: DataFrame) -> DataFrame:
        return rows if match_id is None else rows.filter(F.col("match_id") == match_id)

    state = of_match(jobs.current_match_state(spark, f"{gold_path}/match_state"))
    momentum = of_match(jobs.current_momentum(spark, f"{gold_path}/momentum"))
    timeline = of_match(jobs.current_xg_timeline(spark, f"{gold_path}/xg_timeline"))
    shots = of_match(read_table(spark, f"{gold_path}/shots", SHOTS))
    players_now = of_match(jobs.current_player_totals(spark, f"{gold_path}/player_totals"))
    times = of_match(jobs.current_team_times(spark, f"{gold_path}/team_times"))
    closed = of_match(read_table(spark, f"{gold_path}/sittings", SITTINGS))
    newest = f"{gold_path}/event_log"
    if folded.exists(spark, newest):
        events = jobs.current_event_log(spark, newest, match_id)
    else:
        events = views.event_log(of_match(read_table(spark, silver_path, SILVER)))
    return {
        "kpi_row": views.kpi_row(views.with_momentum(state, momentum)),
        "xg_race": views.xg_race(timeline),
        "shot_map": views.shot_map(shots),
        "event_log": events,
        "player_spotlight": players.player_spotlight(players_now),
        "match_catalogue": matches.catalogue(times, closed),
    }
