"""Streaming jobs: log to Bronze to Silver to the Gold tables.

Each function starts one query. Append-only tables use the parquet file sink,
whose commit log makes a retried batch count once. Keyed tables are streaming
aggregations whose changed rows go to a change log. The number of shuffle
partitions of a stateful query is fixed by its first run.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from matchlive.operators.parse import EVENT_KEY, parse_events
from matchlive.operators.skew import join_on
from matchlive.plans import gold, matches, players, views
from matchlive.schemas import BRONZE, MOMENTUM, PLAYER_TOTALS, SILVER, TEAM_TIMES, TEAM_TOTALS, XG_TIMELINE
from matchlive.sources.log import bronze_rows
from matchlive.sources.tables import stream_table
from matchlive.streaming import folded
from matchlive.streaming.change_log import current, refuse_older, write_changes

TEAM = ("match_id", "team_name")
SECONDS = "match_id BIGINT, team_name STRING, match_second INT, actions BIGINT"
NEWEST_EVENTS = """
    match_id BIGINT,
    event_id STRING,
    event_index INT,
    match_second INT,
    minute INT,
    second INT,
    team_name STRING,
    player_name STRING,
    event_type STRING,
    xg DOUBLE
"""
TEAM_MINUTE = (*TEAM, "minute")
LATENESS = "10 minutes"
ONCE = {"availableNow": True}

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def job_session(
    spark: SparkSession, state_partitions: int | None = None, rocksdb: bool = True
) -> SparkSession:
    """A session of its own for streaming jobs, so their settings stay with them.

    RocksDB keeps state off the JVM heap, uploads only changes, and does not
    look up each key just to count the rows.
    """
    session = spark.newSession()
    # sessions of a large match are joined in each task before they are shuffled
    session.conf.set("spark.sql.sessionWindow.merge.sessions.in.local.partition", "true")
    zone = "spark.sql.session.timeZone"
    session.conf.set(zone, spark.conf.get(zone))
    if state_partitions is not None:
        session.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    if rocksdb:
        store = "spark.sql.streaming.stateStore"
        session.conf.set(f"{store}.providerClass", ROCKSDB)
        session.conf.set(f"{store}.rocksdb.changelogCheckpointing.enabled", "true")
        session.conf.set(f"{store}.rocksdb.trackTotalNumberOfRows", "false")
    return session


def _append(
    rows: DataFrame, name: str, path: str, checkpoint: str, trigger: dict
) -> StreamingQuery:
    """Appends to a parquet table; the progress reports the rows under ``name``."""
    return (
        rows.observe(name, F.count(F.lit(1)).alias("rows"))
        .writeStream.format("parquet")
        .queryName(name)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
        .trigger(**trigger)
        .start()
    )


def start_bronze(
    log: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict = ONCE,
    match_id: Column | None = None,
) -> StreamingQuery:
    return _append(bronze_rows(log, match_id), "bronze", path, checkpoint, trigger)


def deduplicated(events: DataFrame, lateness: str = LATENESS, forget: bool = False) -> DataFrame:
    """Streaming events without repeated ids.

    An id is never forgotten, so a match that is replayed later does not count
    twice; state grows by an id per event, which RocksDB keeps on disk. With
    ``forget`` an id goes once the watermark has passed the event by
    ``lateness``: state is bounded, and what is repeated after that counts
    again. Rows older than the watermark are dropped either way.
    """
    marked = events.withWatermark("event_time", lateness)
    if forget:
        return marked.dropDuplicatesWithinWatermark(list(EVENT_KEY))
    return marked.dropDuplicates(list(EVENT_KEY))


def start_silver(
    spark: SparkSession,
    bronze_path: str,
    path: str,
    checkpoint: str,
    trigger: dict = ONCE,
    lateness: str = LATENESS,
    forget: bool = False,
    **options,
) -> StreamingQuery:
    events = parse_events(stream_table(spark, bronze_path, BRONZE, **options))
    kept = deduplicated(events, lateness, forget)
    return _append(kept, "silver", path, checkpoint, trigger)


def silver_stream(spark: SparkSession, silver_path: str, **options) -> DataFrame:
    return stream_table(spark, silver_path, SILVER, **options)


def start_shots(
    spark: SparkSession, silver_path: str, path: str, checkpoint: str, trigger: dict = ONCE, **options
) -> StreamingQuery:
    rows = gold.shots(silver_stream(spark, silver_path, **options))
    return _append(rows, "shots", path, checkpoint, trigger)


def _keep_changes(
    totals: DataFrame, name: str, path: str, checkpoint: str, trigger: dict
) -> StreamingQuery:
    checked = False

    def store(rows: DataFrame, batch_id: int) -> None:
        nonlocal checked
        if not checked:
            refuse_older(rows.sparkSession, batch_id, path)
            checked = True
        write_changes(rows, batch_id, path)

    return (
        totals.writeStream.queryName(name)
        .outputMode("update")
        .foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def start_xg_timeline(
    spark: SparkSession, silver_path: str, path: str, checkpoint: str, trigger: dict = ONCE, **options
) -> StreamingQuery:
    """Running xG totals; Spark's state holds them, so each batch stores sums, not steps."""
    totals = gold.xg_timeline(silver_stream(spark, silver_path, **options))
    return _keep_changes(totals, "xg_timeline", path, checkpoint, trigger)


def current_xg_timeline(spark: SparkSession, path: str) -> DataFrame:
    return current(spark, path, XG_TIMELINE, TEAM_MINUTE)


def start_team_totals(
    spark: SparkSession, silver_path: str, path: str, checkpoint: str, trigger: dict = ONCE, **options
) -> StreamingQuery:
    totals = gold.team_totals(silver_stream(spark, silver_path, **options))
    return _keep_changes(totals, "match_state", path, checkpoint, trigger)


def current_match_state(spark: SparkSession, path: str) -> DataFrame:
    """Team totals with the win probability, which needs both teams, added on reading."""
    return gold.with_win_probability(current(spark, path, TEAM_TOTALS, TEAM))


def start_player_totals(
    spark: SparkSession, silver_path: str, path: str, checkpoint: str, trigger: dict = ONCE, **options
) -> StreamingQuery:
    totals = players.player_totals(silver_stream(spark, silver_path, **options))
    return _keep_changes(totals, "player_totals", path, checkpoint, trigger)


def current_player_totals(spark: SparkSession, path: str) -> DataFrame:
    return current(spark, path, PLAYER_TOTALS, players.NAMED_PLAYER)


def start_team_times(
    spark: SparkSession, silver_path: str, path: str, checkpoint: str, trigger: dict = ONCE, **options
) -> StreamingQuery:
    times = matches.team_times(silver_stream(spark, silver_path, **options))
    return _keep_changes(times, "team_times", path, checkpoint, trigger)


def current_team_times(spark: SparkSession, path: str) -> DataFrame:
    return current(spark, path, TEAM_TIMES, TEAM)


def start_sittings(
    spark: SparkSession,
    silver_path: str,
    path: str,
    checkpoint: str,
    trigger: dict = ONCE,
    gap: str = matches.GAP,
    lateness: str = LATENESS,
    **options,
) -> StreamingQuery:
    """Appends a sitting of a match once the watermark has passed its end by the gap; then its state goes."""
    marked = silver_stream(spark, silver_path, **options).withWatermark("event_time", lateness)
    return _append(matches.sittings(marked, gap), "sittings", path, checkpoint, trigger)


def _fold_batches(
    rows: DataFrame, name: str, checkpoint: str, trigger: dict, state: str, store
) -> StreamingQuery:
    """Calls ``store`` with each batch, after a look that the state is none of a later one."""
    checked = False

    def store_checked(batch: DataFrame, batch_id: int) -> None:
        nonlocal checked
        if not checked:
            folded.refuse_older(batch.sparkSession, batch_id, state)
            checked = True
        store(batch, batch_id)

    return (
        rows.writeStream.queryName(name)
        .foreachBatch(store_checked)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def start_event_log(
    spark: SparkSession,
    silver_path: str,
    path: str,
    checkpoint: str,
    trigger: dict = ONCE,
    rows: int = views.EVENT_LOG_ROWS,
    buckets: int = folded.BUCKETS,
    **options,
) -> StreamingQuery:
    """The newest events of each match: those of a batch merged with those kept before.

    Neither a batch nor a reader looks at older events; at most ``rows`` of a match are kept.
    """

    def newest(events: DataFrame) -> DataFrame:
        return views.newest_events(events, rows)

    def store(batch: DataFrame, batch_id: int) -> None:
        folded.fold(newest(batch), batch_id, path, NEWEST_EVENTS, newest, buckets)

    events = silver_stream(spark, silver_path, **options)
    return _fold_batches(events, "event_log", checkpoint, trigger, path, store)


def current_event_log(spark: SparkSession, path: str, match_id: int | None = None) -> DataFrame:
    return views.event_log(folded.current(spark, path, NEWEST_EVENTS, match_id))


def start_momentum(
    spark: SparkSession,
    silver_path: str,
    path: str,
    checkpoint: str,
    trigger: dict = ONCE,
    buckets: int = folded.BUCKETS,
    **options,
) -> StreamingQuery:
    """Momentum of the matches with new events.

    Actions per team and second are kept beside the checkpoint as far back as the
    match's time window reaches, a few hundred rows a match however long it is. A
    finished match is touched no more, and no match is held in one task.
    """
    counts = f"{checkpoint}/seconds"
    checked = False

    def recent(seconds: DataFrame) -> DataFrame:
        sums = seconds.groupBy(*TEAM, "match_second").agg(F.sum("actions").alias("actions"))
        return gold.in_last_window(sums)

    def store(rows: DataFrame, batch_id: int) -> None:
        nonlocal checked
        if not checked:
            refuse_older(rows.sparkSession, batch_id, path)
            checked = True
        added = gold.actions_per_second(rows).persist()
        try:
            kept = folded.fold(added, batch_id, counts, SECONDS, recent, buckets)
            if kept is not None:
                theirs = join_on(kept, added.select(*gold.MATCH).distinct(), gold.MATCH, "left_semi")
                write_changes(gold.momentum_of(theirs), batch_id, path)
        finally:
            added.unpersist()

    events = silver_stream(spark, silver_path, **options)
    return _fold_batches(events, "momentum", checkpoint, trigger, counts, store)


def current_momentum(spark: SparkSession, path: str) -> DataFrame:
    """Teams without a recent attacking action keep the row of an earlier batch."""
    return current(spark, path, MOMENTUM, TEAM)
