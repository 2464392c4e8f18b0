"""Runs the jobs: ``spark-submit`` or ``python -m matchlive <command>``."""

import argparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlive.plans import players, replay, views
from matchlive.schemas import (
    BRONZE,
    MOMENTUM,
    PLAYER_TOTALS,
    SHOTS,
    SILVER,
    SITTINGS,
    TEAM_TIMES,
    TEAM_TOTALS,
    XG_TIMELINE,
)
from matchlive.sources.log import match_id_in_header, match_id_in_topic, read_log_stream
from matchlive.sources.match_files import read_match_documents
from matchlive.sources.tables import append_version, read_table
from matchlive.streaming import change_log, folded, jobs, progress
from matchlive.streaming.serving import live_views

BRONZE_EVERY = "2 seconds"
OTHERS_EVERY = "5 seconds"

GOLD_JOBS = {
    "shots": jobs.start_shots,
    "xg_timeline": jobs.start_xg_timeline,
    "match_state": jobs.start_team_totals,
    "momentum": jobs.start_momentum,
    "event_log": jobs.start_event_log,
    "player_totals": jobs.start_player_totals,
    "team_times": jobs.start_team_times,
    "sittings": jobs.start_sittings,
}
APPENDED = {"bronze": BRONZE, "silver": SILVER, "shots": SHOTS, "sittings": SITTINGS}
CHANGE_LOGS = {
    "xg_timeline": (XG_TIMELINE, jobs.current_xg_timeline),
    "match_state": (TEAM_TOTALS, jobs.current_match_state),
    "momentum": (MOMENTUM, jobs.current_momentum),
    "player_totals": (PLAYER_TOTALS, jobs.current_player_totals),
    "team_times": (TEAM_TIMES, jobs.current_team_times),
}
KEYS = {
    "xg_timeline": jobs.TEAM_MINUTE,
    "match_state": jobs.TEAM,
    "momentum": jobs.TEAM,
    "player_totals": players.NAMED_PLAYER,
    "team_times": jobs.TEAM,
}


def match_id_column(source: str) -> Column | None:
    """``column``, ``header``, ``topic``, or one fixed number."""
    known = {"column": lambda: None, "header": match_id_in_header, "topic": match_id_in_topic}
    return known[source]() if source in known else F.lit(int(source))


def trigger(args) -> dict:
    return jobs.ONCE if args.once else {"processingTime": args.every}


def run_bronze(spark: SparkSession, args) -> list:
    log = read_log_stream(spark, args.format, args.source, **dict(args.option))
    started = jobs.start_bronze(
        log, args.out, args.checkpoint, trigger(args), match_id_column(args.match_id)
    )
    return [started]


def run_silver(spark: SparkSession, args) -> list:
    started = jobs.start_silver(
        spark, args.source, args.out, args.checkpoint, trigger(args),
        args.lateness, args.forget, **dict(args.option),
    )
    return [started]


def run_gold(spark: SparkSession, args) -> list:
    return [
        GOLD_JOBS[name](
            spark, args.source, f"{args.out}/{name}", f"{args.checkpoint}/{name}",
            trigger(args), **dict(args.option),
        )
        for name in args.tables
    ]


def run_publish(spark: SparkSession, args) -> list:
    documents = replay.in_match_order(read_match_documents(spark, args.source))
    replay.publish(replay.log_rows(documents), args.format, args.out, **dict(args.option))
    return []


def table_now(spark: SparkSession, name: str, path: str) -> tuple[DataFrame, int | None]:
    """Current rows and version number of a table the jobs write."""
    if name in CHANGE_LOGS:
        schema, current = CHANGE_LOGS[name]
        return current(spark, path), change_log.version(spark, path, schema)
    if name == "event_log":
        return jobs.current_event_log(spark, path), folded.version(spark, path)
    return read_table(spark, path, APPENDED[name]), append_version(path)


def run_show(spark: SparkSession, args) -> list:
    rows, version = table_now(spark, args.table, args.source)
    count = views.row_counts(rows, {args.table: None}).first()
    print(f"{args.source}: {count.row_count} rows, {count.distinct_matches} matches, version {version}")
    rows.show(args.rows, truncate=False)
    return []


def run_compact(spark: SparkSession, args) -> list:
    schema, keys = CHANGE_LOGS[args.table][0], KEYS[args.table]
    change_log.compact(spark, args.source, args.out, schema, keys)
    return []


def run_views(spark: SparkSession, args) -> list:
    for name, rows in live_views(spark, args.source, args.gold, args.match).items():
        print(name)
        rows.show(args.rows, truncate=False)
    return []


def pair(text: str) -> tuple[str, str]:
    name, _, value = text.partition("=")
    return name, value


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="matchlive", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)

    def command(name, run, source_help, every=None, **source):
        sub = commands.add_parser(name)
        sub.set_defaults(run=run)
        sub.add_argument("--source", help=source_help, **source)
        sub.add_argument("--option", type=pair, action="append", default=[], metavar="NAME=VALUE")
        if every is not None:
            sub.add_argument("--out", required=True)
            sub.add_argument("--checkpoint", required=True)
            sub.add_argument("--every", default=every, help="trigger interval")
            sub.add_argument("--once", action="store_true", help="stop after the rows there are")
            sub.add_argument("--batches", help="table that every batch adds a row of its figures to")
        return sub

    bronze = command("bronze", run_bronze, "log files, if not Kafka", BRONZE_EVERY)
    bronze.add_argument("--format", default="kafka")
    bronze.add_argument("--match-id", default="header", help="column, header, topic or a number")
    silver = command("silver", run_silver, "Bronze table", OTHERS_EVERY, required=True)
    silver.add_argument("--lateness", default=jobs.LATENESS)
    silver.add_argument("--forget", action="store_true", help="forget event ids older than the lateness")
    gold = command("gold", run_gold, "Silver table", OTHERS_EVERY, required=True)
    gold.add_argument("--tables", nargs="+", choices=GOLD_JOBS, default=list(GOLD_JOBS))
    publish = command("publish", run_publish, "folder of match files", required=True)
    publish.add_argument("--format", default="kafka")
    publish.add_argument("--out", help="path, if not Kafka")
    show = command("show", run_show, "table path", required=True)
    show.add_argument("--table", required=True, choices=["bronze", "silver", *GOLD_JOBS])
    show.add_argument("--rows", type=int, default=10)
    compact = command("compact", run_compact, "change log of a stopped job", required=True)
    compact.add_argument("--table", required=True, choices=CHANGE_LOGS)
    compact.add_argument("--out", required=True, help="new path, in another Gold folder")
    shown = command("views", run_views, "Silver table", required=True)
    shown.add_argument("--gold", required=True, help="folder of the Gold tables")
    shown.add_argument("--match", type=int)
    shown.add_argument("--rows", type=int, default=20)
    return top


def main(arguments: list[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    spark = SparkSession.builder.appName(f"matchlive-{args.command}").getOrCreate()
    session = jobs.job_session(spark)
    watched = getattr(args, "batches", None)
    listener = progress.BatchTable(session, watched) if watched else None
    if listener is not None:
        session.streams.addListener(listener)
    queries = args.run(session, args)
    if args.command in ("bronze", "silver", "gold") and not args.once:
        session.streams.awaitAnyTermination()
    for query in queries:
        query.awaitTermination()
    if listener is not None:
        listener.wait_for(len(queries))
        session.streams.removeListener(listener)


if __name__ == "__main__":
    main()
