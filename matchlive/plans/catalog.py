"""Every table and view as a query over the test tables."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlive import functions as rules
from matchlive.functions.rules import SHOT
from matchlive.operators import parse
from matchlive.operators.upsert import VERSION, latest_by_key, merge_additive
from matchlive.plans import gold, matches, passing, players, replay, views
from matchlive.schemas import SHOTS, SILVER, columns
from matchlive.sources.log import bronze_rows
from matchlive.sources.match_files import read_match_documents, read_match_events, write_match_documents
from matchlive.sources.tables import read_table
from matchlive.sources.testdata import event_documents, event_log, staggered_documents
from matchlive.workspace import new_run_dir

Query = Callable[[SparkSession, str], DataFrame]

PROGRESS_STEP = 25
#: A range so short that a match file of the test tables has several, and events lie across their ends.
FEW_BYTES = 8192
KEPT_DECIMALS = 6


def rounded(df: DataFrame, *names: str) -> DataFrame:
    """Sums of doubles depend on the order of the rows in their last digits."""
    return df.withColumns({n: F.round(n, KEPT_DECIMALS) for n in names})


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_rows(event_log(event_documents(spark, sf_dir)))


def silver(spark: SparkSession, sf_dir: str, wanted: str | None = None) -> DataFrame:
    """Silver, or the columns named."""
    return parse.silver_events(bronze(spark, sf_dir), wanted and wanted.split())


def one_match(documents: DataFrame) -> DataFrame:
    """All documents as those of one match, which then has every row."""
    return documents.withColumn("match_id", F.lit(0).cast("bigint"))


def large_silver(spark: SparkSession, sf_dir: str, wanted: str) -> DataFrame:
    log = event_log(one_match(event_documents(spark, sf_dir)))
    return parse.silver_events(bronze_rows(log), wanted.split())


# Columns of Silver that the tables are made of.
FOR_SHOTS = " ".join(columns(SHOTS)) + " event_type"
FOR_TIMELINE = "match_id team_name minute xg"
FOR_STATE = "match_id team_name shot_outcome xg minute"
FOR_MOMENTUM = "match_id team_name match_second event_type"
FOR_SERIES = "match_id team_name match_second event_index event_id event_type"
FOR_CHANCES = "match_id team_name event_index event_id event_type minute shot_outcome xg"


FOR_PLAYERS = "match_id team_name player_id player_name event_type shot_outcome loc_x loc_y xg"
FOR_PASSES = "match_id team_name match_second is_pass pass_outcome"
FOR_CHANCES_MADE = (
    "match_id team_name match_second event_index event_id event_type loc_x loc_y xg possession is_key_pass"
)
FOR_CATALOGUE = "match_id team_name shot_outcome event_time"

TOP_PLAYERS = 5
#: What the test queries take the parts of weighted momentum for.
WEIGHTS = passing.Weights(shot=1.0, xg=4.0, key_pass=0.5, box_entry=0.25)


def detailed_silver(spark: SparkSession, sf_dir: str, wanted: str, large: bool = False) -> DataFrame:
    """Silver columns of documents that have passes and possessions; as one match if ``large``."""
    documents = event_documents(spark, sf_dir, details=True)
    log = event_log(one_match(documents) if large else documents)
    return parse.silver_events(bronze_rows(log), wanted.split())


# --- log and Silver -------------------------------------------------------


def bronze_envelope(spark, sf_dir):
    return bronze(spark, sf_dir)


def silver_events(spark, sf_dir):
    return silver(spark, sf_dir)


def dedup_events(spark, sf_dir):
    return parse.repeated_events(bronze(spark, sf_dir))


def malformed_rows(spark, sf_dir):
    return parse.malformed_rows(bronze(spark, sf_dir))


def shootout_excluded(spark, sf_dir):
    return parse.excluded_shootouts(bronze(spark, sf_dir))


# --- Gold -----------------------------------------------------------------


def shots(spark, sf_dir):
    return gold.shots(silver(spark, sf_dir, FOR_SHOTS))


def xg_timeline(spark, sf_dir):
    return rounded(gold.xg_timeline(silver(spark, sf_dir, FOR_TIMELINE)), "xg_total")


def match_state(spark, sf_dir):
    return rounded(gold.match_state(silver(spark, sf_dir, FOR_STATE)), "xg_total")


def momentum(spark, sf_dir):
    return gold.momentum(silver(spark, sf_dir, FOR_MOMENTUM))


def momentum_series(spark, sf_dir):
    return gold.momentum_series(silver(spark, sf_dir, FOR_SERIES))


def momentum_series_large_match(spark, sf_dir):
    return gold.momentum_series(large_silver(spark, sf_dir, FOR_SERIES))


def win_probability(spark, sf_dir):
    result = gold.win_probability_by_shot(silver(spark, sf_dir, FOR_CHANCES))
    return rounded(result, "xg_diff")


def win_probability_large_match(spark, sf_dir):
    result = gold.win_probability_by_shot(large_silver(spark, sf_dir, FOR_CHANCES))
    return rounded(result, "xg_diff")


# --- passes, players, matches ---------------------------------------------


def pass_completion(spark, sf_dir):
    return passing.pass_completion(detailed_silver(spark, sf_dir, FOR_PASSES))


def weighted_momentum(spark, sf_dir):
    found = passing.weighted_momentum(detailed_silver(spark, sf_dir, FOR_CHANCES_MADE), WEIGHTS)
    return rounded(found, "xg_total", "weighted")


def weighted_momentum_series(spark, sf_dir):
    found = passing.weighted_momentum_series(detailed_silver(spark, sf_dir, FOR_CHANCES_MADE), WEIGHTS)
    return rounded(found, "xg_total", "weighted")


def weighted_momentum_series_large_match(spark, sf_dir):
    found = passing.weighted_momentum_series(detailed_silver(spark, sf_dir, FOR_CHANCES_MADE, large=True), WEIGHTS)
    return rounded(found, "xg_total", "weighted")


def player_spotlight(spark, sf_dir):
    totals = players.player_totals(silver(spark, sf_dir, FOR_PLAYERS))
    return rounded(players.player_spotlight(totals), "xg_total")


def player_top(spark, sf_dir):
    totals = players.player_totals(silver(spark, sf_dir, FOR_PLAYERS))
    return rounded(players.player_top(totals, TOP_PLAYERS), "xg_total")


def match_catalogue(spark, sf_dir):
    bronze = bronze_rows(event_log(staggered_documents(spark, sf_dir)))
    return matches.match_catalogue(parse.silver_events(bronze, FOR_CATALOGUE.split()))


# --- rules, row by row ----------------------------------------------------


def match_clock(spark, sf_dir):
    """The clock, null and counted as 0 where the minute is missing."""
    minute, second = F.col("minute"), F.col("second")
    return silver(spark, sf_dir, "match_id event_id minute second").select(
        "match_id",
        "event_id",
        rules.match_second(minute, second).alias("match_second"),
        rules.clock_or_zero(minute, second).alias("clock_or_zero"),
    )


def minute_label(spark, sf_dir):
    label = rules.minute_label(F.col("minute"), F.col("period"))
    return silver(spark, sf_dir, "match_id event_id period minute").select(
        "match_id", "event_id", "period", "minute", label.alias("label")
    )


def event_flags(spark, sf_dir):
    kind, outcome = F.col("event_type"), F.col("shot_outcome")
    return silver(spark, sf_dir, "match_id event_id event_type shot_outcome").select(
        "match_id",
        "event_id",
        rules.is_shot(kind).alias("is_shot"),
        rules.is_goal(kind, outcome).alias("is_goal"),
        rules.is_attacking(kind).alias("is_attacking"),
    )


def safe_xg(spark, sf_dir):
    """Of the documents as they come: xG may be missing, negative or NaN."""
    shot = "id STRING, shot STRUCT<statsbomb_xg: DOUBLE>"
    documents = event_documents(spark, sf_dir).select(
        "match_id", F.inline(F.array(F.from_json("payload", shot)))
    )
    xg = F.col("shot.statsbomb_xg")
    return documents.select("match_id", F.col("id").alias("event_id"), xg.alias("xg"), rules.safe_xg(xg).alias("safe_xg"))


# --- views ----------------------------------------------------------------


def xg_race(spark, sf_dir):
    race = views.xg_race(gold.xg_timeline(silver(spark, sf_dir, FOR_TIMELINE)))
    return rounded(race, "xg_total", "xg_cumulative")


def kpi_row(spark, sf_dir):
    return views.kpi_row(gold.team_overview(silver(spark, sf_dir, f"{FOR_STATE} {FOR_MOMENTUM}")))


def shot_map(spark, sf_dir):
    found = views.shot_map(gold.shots(silver(spark, sf_dir, FOR_SHOTS)))
    return rounded(found, "marker_size")


def shot_map_large_match(spark, sf_dir):
    found = views.shot_map(gold.shots(large_silver(spark, sf_dir, FOR_SHOTS)))
    return rounded(found, "marker_size")


def shot_zones(spark, sf_dir):
    return rounded(views.shot_zones(gold.shots(silver(spark, sf_dir, FOR_SHOTS))), "xg_total")


def event_log_rows(spark, sf_dir):
    wanted = "match_id event_id event_index match_second " + " ".join(views.EVENT_LOG_COLUMNS)
    return views.event_log(silver(spark, sf_dir, wanted))


def team_list(spark, sf_dir):
    teams = views.team_list(gold.xg_timeline(silver(spark, sf_dir, FOR_TIMELINE)))
    return teams.withColumn("teams", F.array_join("teams", ", "))


def table_head(spark, sf_dir):
    return views.table_head(silver(spark, sf_dir))


def table_summary(spark, sf_dir):
    events = views.row_counts(
        silver(spark, sf_dir, "match_id event_type"),
        {"silver": None, "shots": F.col("event_type") == SHOT},
    )
    return views.row_counts(bronze(spark, sf_dir), {"bronze": None}).unionByName(events)


# --- replay and files -----------------------------------------------------


def replay_schedule(spark, sf_dir):
    documents = event_documents(spark, sf_dir)
    return rounded(replay.replay_schedule(documents), "delay_s", "emit_at_s")


def replay_schedule_large_match(spark, sf_dir):
    documents = one_match(event_documents(spark, sf_dir))
    return rounded(replay.replay_schedule(documents), "delay_s", "emit_at_s")


def replay_progress(spark, sf_dir):
    documents = event_documents(spark, sf_dir)
    return replay.replay_progress(documents, PROGRESS_STEP)


def replay_progress_large_match(spark, sf_dir):
    return replay.replay_progress(one_match(event_documents(spark, sf_dir)), PROGRESS_STEP)


def publish_log_rows(spark, sf_dir):
    """Log rows written and read back."""
    path = new_run_dir(spark, "published-log")
    rows = replay.log_rows(replay.in_match_order(event_documents(spark, sf_dir)))
    replay.publish(rows, "parquet", path)
    return spark.read.parquet(path).select("match_id", "key", "value")


def _write_match_files(spark, sf_dir) -> list[str]:
    """One JSON array per match, and the folders that have them."""
    return write_match_documents(event_documents(spark, sf_dir), new_run_dir(spark, "match-files"))


def backfill_match_files(spark, sf_dir):
    events = read_match_events(spark, _write_match_files(spark, sf_dir))
    return events.groupBy("match_id").agg(
        F.count(F.lit(1)).alias("events"), F.max("index").alias("max_index")
    )


def backfill_by_ranges(spark, sf_dir):
    """The same from files cut into short ranges."""
    documents = read_match_documents(spark, _write_match_files(spark, sf_dir), range_bytes=FEW_BYTES)
    return documents.groupBy("match_id").agg(
        F.count(F.lit(1)).alias("events"),
        F.max(F.get_json_object("payload", "$.index").cast("int")).alias("max_index"),
    )


def backfill_silver(spark, sf_dir):
    """Match files to log rows to Silver."""
    documents = read_match_documents(spark, _write_match_files(spark, sf_dir))
    rows = replay.log_rows(documents).select(
        "match_id",
        F.col("key").alias("kafka_key"),
        F.col("value").alias("event_json"),
        F.lit(None).cast("timestamp").alias("kafka_timestamp"),
        F.lit(0).alias("partition"),
        F.lit(0).cast("bigint").alias("offset"),
    )
    return parse.silver_events(rows).drop("event_time")


def tolerant_scan(spark, sf_dir):
    """A table that exists together with one that does not."""
    path = new_run_dir(spark, "silver-table")
    silver(spark, sf_dir).write.parquet(path)
    missing = read_table(spark, f"{path}-missing", SILVER)
    return read_table(spark, path, SILVER).unionByName(missing)


# --- keyed writes ---------------------------------------------------------


def merge_additive_halves(spark, sf_dir):
    """The timeline of the first period merged with that of all other events."""
    events = silver(spark, sf_dir, f"{FOR_TIMELINE} period")
    in_first = F.col("period").eqNullSafe(1)
    first = gold.xg_timeline(events.filter(in_first))
    later = gold.xg_timeline(events.filter(~in_first))
    merged = merge_additive(
        first, later, ["match_id", "team_name", "minute"], ["xg_total", "shots_total"]
    )
    return rounded(merged, "xg_total")


def upsert_latest_by_key(spark, sf_dir):
    """Momentum at the end of each period, then the newest row per team.

    What lies before the first period is seen at its end.
    """
    first = F.greatest(F.col("period"), F.lit(1))
    after_period = F.explode(F.sequence(first, F.lit(parse.LAST_PERIOD_OF_PLAY)))
    events = silver(spark, sf_dir, f"{FOR_MOMENTUM} period")
    counted = gold.actions_per_second(events, by=("match_id", "period"))
    changes = gold.momentum_of(
        counted.withColumn(VERSION, after_period), by=(VERSION, "match_id")
    )
    return latest_by_key(changes, ["match_id", "team_name"])


BATCH: dict[str, Query] = {
    "bronze_envelope": bronze_envelope,
    "silver_events": silver_events,
    "dedup_events": dedup_events,
    "malformed_rows": malformed_rows,
    "shootout_excluded": shootout_excluded,
    "shots": shots,
    "xg_timeline": xg_timeline,
    "xg_race": xg_race,
    "match_state": match_state,
    "momentum": momentum,
    "momentum_series": momentum_series,
    "win_probability": win_probability,
    "pass_completion": pass_completion,
    "weighted_momentum": weighted_momentum,
    "weighted_momentum_series": weighted_momentum_series,
    "player_spotlight": player_spotlight,
    "player_top": player_top,
    "match_catalogue": match_catalogue,
    "match_clock": match_clock,
    "minute_label": minute_label,
    "event_flags": event_flags,
    "safe_xg": safe_xg,
    "kpi_row": kpi_row,
    "shot_map": shot_map,
    "shot_zones": shot_zones,
    "event_log": event_log_rows,
    "team_list": team_list,
    "table_head": table_head,
    "table_summary": table_summary,
    "replay_schedule": replay_schedule,
    "replay_progress": replay_progress,
    "publish_log_rows": publish_log_rows,
    "backfill_match_files": backfill_match_files,
    "backfill_by_ranges": backfill_by_ranges,
    "backfill_silver": backfill_silver,
    "tolerant_scan": tolerant_scan,
    "merge_additive": merge_additive_halves,
    "upsert_latest_by_key": upsert_latest_by_key,
    "momentum_series_large_match": momentum_series_large_match,
    "win_probability_large_match": win_probability_large_match,
    "shot_map_large_match": shot_map_large_match,
    "replay_schedule_large_match": replay_schedule_large_match,
    "replay_progress_large_match": replay_progress_large_match,
    "weighted_momentum_series_large_match": weighted_momentum_series_large_match,
}
