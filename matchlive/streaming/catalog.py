"""Every streaming table as a query: the log arrives in slices, the table is read back.

Each slice is a run of its own, so all jobs go through a restart per slice.
"""

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlive.plans import matches, players
from matchlive.plans.catalog import rounded
from matchlive.plans.views import row_counts
from matchlive.schemas import BRONZE, SHOTS, SILVER, SITTINGS, XG_TIMELINE, columns
from matchlive.sources.log import read_log_stream
from matchlive.sources.tables import append_version, read_table
from matchlive.sources.testdata import (
    EVENTS_PER_MATCH,
    event_documents,
    event_log,
    parallel_documents,
    staggered_documents,
)
from matchlive.streaming import jobs, progress
from matchlive.streaming.change_log import version
from matchlive.streaming.serving import live_views
from matchlive.workspace import new_run_dir

SLICES = 3
SLICE = "slice"


class Run:
    """Folders and session of one run of the jobs over a sliced log."""

    def __init__(self, spark: SparkSession, name: str):
        self.root = new_run_dir(spark, name)
        # Chosen once: the state keeps the number of partitions of its first run.
        self.session = jobs.job_session(spark, spark.sparkContext.defaultParallelism)
        self.interval: str | None = None
        self.observed: dict[tuple[str, int], int] = {}

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def checkpoint(self, table: str) -> str:
        return f"{self.root}/checkpoints/{table}"

    def bronze(self):
        log = read_log_stream(self.session, "parquet", self.path("log"))
        return jobs.start_bronze(log, self.path("bronze"), self.checkpoint("bronze"))

    def silver(self, **settings):
        return jobs.start_silver(
            self.session, self.path("bronze"), self.path("silver"), self.checkpoint("silver"), **settings
        )

    def gold(self, start: Callable, table: str):
        return start(self.session, self.path("silver"), self.path(table), self.checkpoint(table))

    def feed(self, log: DataFrame, starts: Sequence[Callable], slices: int = SLICES) -> None:
        """Appends one slice after the other to the log, running the jobs after each."""
        for number in range(slices):
            part = log.filter(F.col(SLICE) == number).drop(SLICE)
            part.write.mode("append").parquet(self.path("log"))
            for start in starts:
                query = start()
                if self.runs_on(query):
                    query.processAllAvailable()
                    query.stop()
                query.awaitTermination()
                self.finished(number, query)

    def runs_on(self, query) -> bool:
        """Whether the query waits for more rows, rather than ending with those there are."""
        return self.interval is not None and query.isActive

    def finished(self, number: int, query) -> None:
        """Adds up what the query's batches report of the slice."""
        for batch in query.recentProgress:
            for name, row in (batch.observedMetrics or {}).items():
                key = (name, number)
                self.observed[key] = self.observed.get(key, 0) + row["rows"]


def by_time(documents: DataFrame, slices: int = SLICES) -> DataFrame:
    """Cuts the documents' time span into equal slices."""
    at = F.unix_micros("ts")
    first, last = documents.agg(F.min(at), F.max(at)).first()
    width = (last - first) // slices + 1
    return documents.withColumn(SLICE, F.floor((at - first) / width).cast("int"))


def by_position(documents: DataFrame, slices: int = SLICES) -> DataFrame:
    """Cuts every match into slices; for matches played in parallel."""
    position = F.col("source_id") % EVENTS_PER_MATCH
    return documents.withColumn(SLICE, F.floor(position * slices / EVENTS_PER_MATCH).cast("int"))


def _timed(spark, sf_dir):
    return event_log(by_time(event_documents(spark, sf_dir)), [SLICE])


def _parallel(spark, sf_dir):
    return event_log(by_position(parallel_documents(spark, sf_dir)), [SLICE])


def stream_bronze(spark, sf_dir):
    run = Run(spark, "stream-bronze")
    run.feed(_timed(spark, sf_dir), [run.bronze])
    return read_table(spark, run.path("bronze"), BRONZE)


def _silver(spark, log, name):
    run = Run(spark, name)
    run.feed(log, [run.bronze, run.silver])
    return read_table(spark, run.path("silver"), SILVER)


def stream_silver(spark, sf_dir):
    return _silver(spark, _timed(spark, sf_dir), "stream-silver")


def stream_processing_time(spark, sf_dir):
    """Silver by jobs that trigger by the clock and are stopped once they have seen all rows."""
    run = Run(spark, "stream-processing-time")
    run.interval = "1 second"
    every = {"processingTime": run.interval}
    run.feed(_timed(spark, sf_dir), [run.bronze, lambda: run.silver(trigger=every)])
    return read_table(spark, run.path("silver"), SILVER)


def stream_replayed_match(spark, sf_dir):
    """The whole log once more, an hour after its end: no event counts twice."""
    log = _timed(spark, sf_dir)
    first, last = log.agg(F.min("timestamp"), F.max("timestamp")).first()
    later = F.col("timestamp") + F.lit(last - first) + F.expr("INTERVAL 1 HOUR")
    again = log.withColumn("timestamp", later).withColumn(SLICE, F.lit(SLICES))
    run = Run(spark, "stream-replayed-match")
    run.feed(log.unionByName(again), [run.bronze, run.silver], SLICES + 1)
    return read_table(spark, run.path("silver"), SILVER)


def stream_batch_metrics(spark, sf_dir):
    """Rows that the jobs themselves reported to have written, per slice of the log."""
    run = Run(spark, "stream-batch-metrics")
    run.feed(_timed(spark, sf_dir), [run.bronze, run.silver])
    rows = [(name, number, rows) for (name, number), rows in run.observed.items()]
    return spark.createDataFrame(rows, "table_name STRING, slice INT, rows BIGINT")


def stream_table_versions(spark, sf_dir):
    """Rows and version of an appended table and of a keyed one, as a dashboard's footer shows them."""
    run = Run(spark, "stream-table-versions")
    run.feed(
        _parallel(spark, sf_dir),
        [run.bronze, run.silver, lambda: run.gold(jobs.start_shots, "shots"),
         lambda: run.gold(jobs.start_xg_timeline, "xg_timeline")],
    )
    versions = {
        "bronze": append_version(run.path("bronze")),
        "shots": append_version(run.path("shots")),
        "xg_timeline": version(spark, run.path("xg_timeline"), XG_TIMELINE),
    }
    tables = {
        "bronze": read_table(spark, run.path("bronze"), BRONZE),
        "shots": read_table(spark, run.path("shots"), SHOTS),
        "xg_timeline": jobs.current_xg_timeline(spark, run.path("xg_timeline")),
    }
    counted = [row_counts(tables[name], {name: None}) for name in tables]
    numbers = F.create_map(*[F.lit(part) for pair in versions.items() for part in pair])
    every = counted[0].unionByName(counted[1]).unionByName(counted[2])
    return every.withColumn("version", F.try_element_at(numbers, F.col("table_name")).cast("bigint"))


def stream_restart(spark, sf_dir):
    """Silver, with the second job started only twice: on half the log and on the rest."""
    run = Run(spark, "stream-restart")
    log = _parallel(spark, sf_dir).withColumn(SLICE, (F.col(SLICE) > 0).cast("int"))
    run.feed(log, [run.bronze, run.silver], slices=2)
    return read_table(spark, run.path("silver"), SILVER).select(
        *(name for name in columns(SILVER) if name != "event_time")
    )


def _sent_again(spark, sf_dir):
    """Every event once more under a new id, after all others."""
    documents = parallel_documents(spark, sf_dir)
    on_time = _parallel(spark, sf_dir)
    new_id = F.regexp_replace("payload", r'^\{"id":"', '{"id":"again-')
    again = event_log(documents.withColumn("payload", new_id))
    resent = again.filter(F.col("offset") % 2 == 0).withColumn(SLICE, F.lit(SLICES))
    return on_time.unionByName(resent)


def stream_late_rows(spark, sf_dir):
    """Of events sent once more at the end only those within ten minutes of the newest one are still taken."""
    run = Run(spark, "stream-late-rows")
    run.feed(_sent_again(spark, sf_dir), [run.bronze, run.silver], SLICES + 1)
    return read_table(spark, run.path("silver"), SILVER).select("match_id", "event_id")


def stream_dropped_rows(spark, sf_dir):
    """Rows in and rows dropped as late, by job, as the jobs' batches have reported them."""
    run = Run(spark, "stream-dropped-rows")
    listener = progress.BatchTable(run.session, run.path("batches"))
    run.session.streams.addListener(listener)
    try:
        run.feed(_sent_again(spark, sf_dir), [run.bronze, run.silver], SLICES + 1)
        listener.wait_for(2 * (SLICES + 1))
    finally:
        run.session.streams.removeListener(listener)
    sums = {name: F.sum(name).cast("bigint").alias(name) for name in ("rows_in", "rows_late")}
    return progress.batches(spark, run.path("batches")).groupBy("query_name").agg(*sums.values())


def stream_state_rows(spark, sf_dir):
    """What the jobs' state holds for each match: event ids, and keys of the xG timeline."""
    run = Run(spark, "stream-state-rows")
    run.feed(
        _parallel(spark, sf_dir),
        [run.bronze, run.silver, lambda: run.gold(jobs.start_xg_timeline, "xg_timeline")],
    )

    def held(table: str, name: str) -> DataFrame:
        state = run.session.read.format("statestore").load(run.checkpoint(table))
        return state.groupBy(F.col("key.match_id").alias("match_id")).agg(F.count(F.lit(1)).alias(name))

    return held("silver", "ids").join(held("xg_timeline", "minutes"), "match_id", "full_outer")


def stream_event_log(spark, sf_dir):
    run = Run(spark, "stream-event-log")
    run.feed(
        _parallel(spark, sf_dir),
        [run.bronze, run.silver, lambda: run.gold(jobs.start_event_log, "event_log")],
    )
    return jobs.current_event_log(spark, run.path("event_log"))


def stream_player_spotlight(spark, sf_dir):
    path = _gold_run(spark, sf_dir, jobs.start_player_totals, "player_totals")
    return rounded(players.player_spotlight(jobs.current_player_totals(spark, path)), "xg_total")


def stream_match_catalogue(spark, sf_dir):
    """Matches that start one after the other and pause; the first ones are over when the log ends."""
    run = Run(spark, "stream-match-catalogue")
    run.feed(
        event_log(by_time(staggered_documents(spark, sf_dir)), [SLICE]),
        [run.bronze, run.silver, lambda: run.gold(jobs.start_team_times, "team_times"),
         lambda: run.gold(jobs.start_sittings, "sittings")],
    )
    closed = read_table(spark, run.path("sittings"), SITTINGS)
    return matches.catalogue(jobs.current_team_times(spark, run.path("team_times")), closed)


def _gold_run(spark, sf_dir, start, table):
    run = Run(spark, f"stream-{table}")
    run.feed(
        _parallel(spark, sf_dir), [run.bronze, run.silver, lambda: run.gold(start, table)]
    )
    return run.path(table)


def stream_shots(spark, sf_dir):
    return read_table(spark, _gold_run(spark, sf_dir, jobs.start_shots, "shots"), SHOTS)


def stream_xg_timeline(spark, sf_dir):
    path = _gold_run(spark, sf_dir, jobs.start_xg_timeline, "xg_timeline")
    return rounded(jobs.current_xg_timeline(spark, path), "xg_total")


def stream_match_state(spark, sf_dir):
    path = _gold_run(spark, sf_dir, jobs.start_team_totals, "match_state")
    return rounded(jobs.current_match_state(spark, path), "xg_total")


def stream_momentum(spark, sf_dir):
    path = _gold_run(spark, sf_dir, jobs.start_momentum, "momentum")
    return jobs.current_momentum(spark, path)


def stream_kpi_row(spark, sf_dir):
    """The KPI row from the tables two jobs keep up to date."""
    run = Run(spark, "stream-kpi-row")
    state = (jobs.start_team_totals, "gold/match_state")
    momentum = (jobs.start_momentum, "gold/momentum")
    run.feed(
        _parallel(spark, sf_dir),
        [run.bronze, run.silver, lambda: run.gold(*state), lambda: run.gold(*momentum)],
    )
    return live_views(spark, run.path("silver"), run.path("gold"))["kpi_row"]


STREAMS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "stream_bronze": stream_bronze,
    "stream_silver": stream_silver,
    "stream_shots": stream_shots,
    "stream_xg_timeline": stream_xg_timeline,
    "stream_match_state": stream_match_state,
    "stream_momentum": stream_momentum,
    "stream_kpi_row": stream_kpi_row,
    "stream_late_rows": stream_late_rows,
    "stream_dropped_rows": stream_dropped_rows,
    "stream_state_rows": stream_state_rows,
    "stream_event_log": stream_event_log,
    "stream_player_spotlight": stream_player_spotlight,
    "stream_match_catalogue": stream_match_catalogue,
    "stream_restart": stream_restart,
    "stream_processing_time": stream_processing_time,
    "stream_replayed_match": stream_replayed_match,
    "stream_batch_metrics": stream_batch_metrics,
    "stream_table_versions": stream_table_versions,
}
