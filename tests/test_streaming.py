"""Streaming jobs: retries, restarts, late rows, keyed tables."""

import datetime
import json
import os
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from matchlive import __main__ as cli
from matchlive.operators.upsert import latest_by_key, merge_additive
from matchlive.plans import gold, views
from matchlive.schemas import BRONZE, LOG, SILVER, XG_TIMELINE
from matchlive.sources.tables import append_version, read_table, stream_table
from matchlive.streaming import change_log, folded, jobs, progress
from matchlive.streaming.serving import live_views
from matchlive.workspace import new_run_dir, shared_dir

NOON = datetime.datetime(2024, 1, 1, 12)
KEYS = ["match_id", "team_name", "minute"]


def shot(n, team="Home", minute=10, xg=0.25, goal=False, second=0, kind="Shot", match_id=1, after=0, period=1):
    outcome = "Goal" if goal else "Saved"
    fields = {
        "id": f"e{n}", "index": n, "period": period, "minute": minute, "second": second,
        "type": {"name": kind}, "team": {"id": 1, "name": team},
        "shot": {"statsbomb_xg": xg, "outcome": {"name": outcome}} if kind == "Shot" else None,
    }
    at = NOON + datetime.timedelta(minutes=after)
    return (match_id, "k", json.dumps(fields), "t", 0, n, at)


class Pipeline:
    """Bronze written by hand, the jobs run on demand."""

    def __init__(self, spark, root):
        self.spark, self.root = spark, str(root)
        self.session = jobs.job_session(spark, 4)

    def path(self, name):
        return f"{self.root}/{name}"

    def add(self, *rows, files=1):
        frame = self.spark.createDataFrame(list(rows), BRONZE)
        frame.coalesce(files).write.mode("append").parquet(self.path("bronze"))

    def silver(self, **options):
        run = jobs.start_silver(
            self.session, self.path("bronze"), self.path("silver"), self.path("ck/silver"), **options
        )
        run.awaitTermination()
        return run

    def gold(self, name):
        start = cli.GOLD_JOBS[name]
        run = start(self.session, self.path("silver"), self.path(name), self.path(f"ck/{name}"))
        run.awaitTermination()

    def forget_last_commit(self, name):
        """Leaves the checkpoint as a driver does that dies before it commits a batch."""
        commits = Path(self.path(f"ck/{name}/commits"))
        last = max((int(p.name) for p in commits.iterdir() if p.name.isdigit()))
        for part in (commits / str(last), commits / f".{last}.crc"):
            if part.exists():
                os.replace(part, f"{self.root}/undone-{name}-{part.name}")

    def table(self, name):
        return cli.table_now(self.spark, name, self.path(name))


@pytest.fixture
def pipe(spark, tmp_path):
    return Pipeline(spark, tmp_path)


def test_silver_keeps_one_copy_across_batches(pipe):
    pipe.add(shot(1), shot(1), shot(2))
    run = pipe.silver()
    assert run.recentProgress[0]["observedMetrics"]["silver"]["rows"] == 2
    pipe.add(shot(2, after=1), shot(3, after=1), shot(2, match_id=2, after=1))
    pipe.silver()
    rows, version = pipe.table("silver")
    assert sorted((r.match_id, r.event_id) for r in rows.collect()) == [
        (1, "e1"), (1, "e2"), (1, "e3"), (2, "e2"),
    ]
    assert version is not None and version >= 1


def test_copies_within_a_batch_are_dropped(pipe):
    pipe.add(*(shot(n % 7) for n in range(500)), shot(9, period=5), files=2)
    pipe.silver()
    rows, _ = pipe.table("silver")
    assert sorted(r.event_id for r in rows.collect()) == [f"e{n}" for n in range(7)]


def test_ids_are_forgotten_only_if_wanted(spark, tmp_path):
    counts = {}
    for forget in (False, True):
        pipe = Pipeline(spark, tmp_path / str(forget))
        for after, n in ((0, 1), (60, 2), (61, 3), (62, 1)):
            pipe.add(shot(n, after=after))
            pipe.silver(forget=forget)
        counts[forget] = pipe.table("silver")[0].filter("event_id = 'e1'").count()
    assert counts == {False: 1, True: 2}


def test_a_new_checkpoint_over_an_old_table_is_refused(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = spark.createDataFrame([(1, "a", 2, 0.5, 1)], XG_TIMELINE)
    for batch_id in (0, 1, 3):
        change_log.refuse_older(spark, batch_id, path)
        change_log.write_changes(rows, batch_id, path)
    change_log.refuse_older(spark, 3, path)  # the last batch once more
    with pytest.raises(ValueError, match="checkpoint"):
        change_log.refuse_older(spark, 0, path)


def test_late_row_is_dropped(pipe):
    for rows in ([shot(1, after=0)], [shot(2, after=40)], [shot(3, after=41)], [shot(4, after=5), shot(5, after=42)]):
        pipe.add(*rows)
        run = pipe.silver()
    ids = sorted(r.event_id for r in pipe.table("silver")[0].collect())
    assert ids == ["e1", "e2", "e3", "e5"]
    dropped = sum(
        op["numRowsDroppedByWatermark"] for p in run.recentProgress for op in p["stateOperators"]
    )
    assert dropped == 1


def test_retried_silver_batch_adds_nothing(pipe):
    pipe.add(shot(1), shot(2))
    pipe.silver()
    pipe.forget_last_commit("silver")
    pipe.silver()
    pipe.add(shot(3))
    pipe.silver()
    assert pipe.table("silver")[0].count() == 3


def totals(pipe):
    timeline = {(r.team_name, r.minute): (r.xg_total, r.shots_total) for r in pipe.table("xg_timeline")[0].collect()}
    state = {r.team_name: (r.goals, r.xg_total, r.latest_minute, r.win_probability) for r in pipe.table("match_state")[0].collect()}
    return timeline, state


def test_retried_totals_are_not_added_twice(pipe):
    pipe.add(shot(1), shot(2, goal=True), shot(3, "Away", xg=0.5))
    pipe.silver()
    for name in ("xg_timeline", "match_state"):
        pipe.gold(name)
    before = totals(pipe)
    for name in ("xg_timeline", "match_state"):
        pipe.forget_last_commit(name)
        pipe.gold(name)
    assert totals(pipe) == before
    assert before[0] == {("Home", 10): (0.5, 2), ("Away", 10): (0.5, 1)}

    pipe.add(shot(4, goal=True, minute=11), shot(5, "Away", minute=11, xg=0.0), shot(6))
    pipe.silver()
    for name in ("xg_timeline", "match_state"):
        pipe.gold(name)
    timeline, state = totals(pipe)
    assert timeline == {("Home", 10): (0.75, 3), ("Home", 11): (0.25, 1), ("Away", 10): (0.5, 1)}
    assert state["Home"][:3] == (2, 1.0, 11) and state["Away"][:3] == (0, 0.5, 11)
    assert state["Home"][3] > 0.5 and state["Home"][3] + state["Away"][3] == pytest.approx(1)


def test_one_row_for_events_without_a_team(pipe):
    for n in (1, 2):
        pipe.add(shot(n, team=None))
        pipe.silver()
        pipe.gold("match_state")
    [row] = pipe.table("match_state")[0].collect()
    assert (row.team_name, row.xg_total, row.win_probability) == (None, 0.5, 0.5)


def test_momentum_keeps_the_row_of_a_quiet_team(pipe):
    pipe.add(shot(1, "Away", minute=1), shot(2, minute=2), shot(9, minute=50, match_id=2))
    pipe.silver()
    pipe.gold("momentum")
    pipe.add(shot(3, minute=20), shot(4, minute=21), shot(5, minute=22, kind="Foul Committed"))
    pipe.silver()
    pipe.gold("momentum")
    rows, version = pipe.table("momentum")
    got = {(r.match_id, r.team_name): tuple(r)[2:] for r in rows.collect()}
    assert got == {
        (1, "Away"): (1, 0.5, 0, 120),
        (1, "Home"): (2, 1.0, 1020, 1320),
        (2, "Home"): (1, 1.0, 2700, 3000),
    }
    assert version == 1


def test_momentum_of_random_batches_against_a_loop(pipe):
    rng = random.Random(11)
    seen, want, number = {}, {}, 0
    for _ in range(4):
        batch = []
        for _ in range(60):
            number += 1
            kind = rng.choice(["Shot", "Pass", "Foul Committed"])
            team, match_id = rng.choice(["A", "B", None]), rng.choice([1, 2, None])
            minute, second = rng.randrange(40), rng.randrange(60)
            batch.append(shot(number, team, minute, second=second, kind=kind, match_id=match_id))
            seen.setdefault(match_id, []).append((minute * 60 + second, team, kind))
        pipe.add(*batch, files=3)
        pipe.silver()
        pipe.gold("momentum")
        for match_id in {row[0] for row in batch}:
            end = max(at for at, _, _ in seen[match_id])
            start = max(0, end - 300)
            acting = [t for at, t, kind in seen[match_id] if at >= start and kind != "Foul Committed"]
            for team in set(acting):
                n = acting.count(team)
                want[match_id, team] = (n, round(n / len(acting), 3), start, end)
    rows, _ = pipe.table("momentum")
    got = {(r.match_id, r.team_name): tuple(r)[2:] for r in rows.collect()}
    assert got == want


def test_retried_momentum_batch_counts_once(pipe):
    for n in (1, 2):
        pipe.add(shot(n, minute=n))
        pipe.silver()
        pipe.gold("momentum")
    before = sorted(map(tuple, pipe.table("momentum")[0].collect()))
    pipe.forget_last_commit("momentum")
    pipe.gold("momentum")
    assert sorted(map(tuple, pipe.table("momentum")[0].collect())) == before
    pipe.add(shot(3, minute=3))
    pipe.silver()
    pipe.gold("momentum")
    [row] = pipe.table("momentum")[0].collect()
    assert row.attacking_actions == 3


def versions(path):
    return {p.name: sorted(int(v.name.split("=")[1]) for v in p.iterdir() if v.name.startswith("batch_id=")) for p in Path(path).glob("match_bucket=*")}


def test_state_by_bucket_does_not_grow_with_batches(pipe):
    for n in range(6):
        pipe.add(shot(2 * n, minute=n * 9), shot(2 * n + 1, minute=n, match_id=n + 10))
        pipe.silver()
        pipe.gold("momentum")
        pipe.gold("event_log")
        for folder in ("ck/momentum/seconds", "event_log"):
            assert all(len(found) <= 2 for found in versions(pipe.path(folder)).values())
    kept = folded.current(pipe.spark, pipe.path("ck/momentum/seconds"), jobs.SECONDS, match_id=1).collect()
    assert [row.match_second for row in kept] == [45 * 60]  # all else is out of the last window's reach


def test_event_log_of_random_batches(pipe):
    rng = random.Random(4)
    for batch in range(4):
        rows = [
            shot(100 * batch + n, rng.choice(["A", None]), rng.randrange(90), match_id=rng.choice([1, 2, 3, None]))
            for n in range(45)
        ]
        rng.shuffle(rows)
        pipe.add(*rows, *rows[:5], files=2)
        pipe.silver()
        pipe.gold("event_log")
        if batch == 2:
            pipe.forget_last_commit("event_log")  # the batch once more
            pipe.gold("event_log")
    rows, version = pipe.table("event_log")
    key = lambda row: tuple((x is not None, x) for x in row[:2])
    want = views.event_log(pipe.table("silver")[0])
    assert sorted(map(tuple, rows.collect()), key=key) == sorted(map(tuple, want.collect()), key=key)
    assert version == 3
    kept = folded.current(pipe.spark, pipe.path("event_log"), jobs.NEWEST_EVENTS)
    assert kept.groupBy("match_id").count().agg(F.max("count")).first()[0] == 20
    one = jobs.current_event_log(pipe.spark, pipe.path("event_log"), 2)
    assert one.count() == 20 and one.inputFiles() and all("match_bucket" in name for name in one.inputFiles())
    assert len({name.split("match_bucket=")[1].split("/")[0] for name in one.inputFiles()}) == 1


def test_a_new_checkpoint_over_old_state_is_refused(spark, pipe):
    rows = spark.createDataFrame([(1, "H", 5, 2)], jobs.SECONDS)
    merge = lambda both: both.groupBy("match_id", "team_name", "match_second").agg(F.sum("actions").alias("actions"))
    path = pipe.path("state")
    assert folded.version(spark, path) is None and not folded.exists(spark, path)
    assert folded.current(spark, path, jobs.SECONDS).count() == 0
    assert folded.fold(rows.limit(0), 0, path, jobs.SECONDS, merge) is None
    for batch_id in (0, 1, 1, 3):  # one of them twice
        folded.refuse_older(spark, batch_id, path)
        folded.fold(rows, batch_id, path, jobs.SECONDS, merge)
    assert [tuple(row) for row in folded.current(spark, path, jobs.SECONDS).collect()] == [(1, "H", 5, 6)]
    with pytest.raises(ValueError, match="checkpoint"):
        folded.refuse_older(spark, 2, path)


def test_sittings_are_closed_by_the_watermark(pipe):
    """A match that goes on within the gap, one after it, and one whose last sitting is still open."""
    for after in ([(1, 0), (2, 0)], [(1, 20)], [(2, 60), (1, 49)], [(3, 100), (2, 61)], [(3, 131)]):
        pipe.add(*(shot(100 * match_id + at, match_id=match_id, after=at) for match_id, at in after))
        pipe.silver()
        for name in ("sittings", "team_times"):
            pipe.gold(name)
    minutes = lambda at: int((at - NOON).total_seconds() // 60)
    got = sorted((r.match_id, minutes(r.sitting_start), minutes(r.sitting_end), r.events) for r in pipe.table("sittings")[0].collect())
    assert got == [(1, 0, 49, 3), (2, 0, 0, 1), (2, 60, 61, 2)]
    found = live_views(pipe.spark, pipe.path("silver"), pipe.root)["match_catalogue"]
    assert {r.match_id: (r.events, r.closed_sittings, r.status) for r in found.collect()} == {
        1: (3, 1, "finished"), 2: (3, 2, "finished"), 3: (2, 0, "live"),
    }


def test_batches_become_rows_of_a_table(pipe):
    table = pipe.path("batches")
    listener = progress.BatchTable(pipe.session, table, rows_per_file=2)
    pipe.session.streams.addListener(listener)
    try:
        for rows in ([shot(1, after=0), shot(1, after=0)], [shot(2, after=40)], [shot(3, after=41)], [shot(4, after=5), shot(5, after=42)]):
            pipe.add(*rows)
            pipe.silver()
        listener.wait_for(4)
    finally:
        pipe.session.streams.removeListener(listener)
    found = progress.batches(pipe.spark, table)
    assert {row.query_name for row in found.select("query_name").collect()} == {"silver"}
    sums = found.agg(F.sum("rows_in"), F.sum("rows_late"), F.count_distinct("run_id"), F.min("milliseconds")).first()
    assert tuple(sums)[:3] == (6, 1, 4) and sums[3] >= 0


def test_momentum_needs_no_python_worker(spark, pipe):
    pipe.add(shot(1))
    pipe.silver()
    rows = gold.actions_per_second(pipe.table("silver")[0])
    assert "Python" not in rows._jdf.queryExecution().toString()


def test_shots_and_batch_agree_after_restarts(pipe):
    for start in range(0, 30, 10):
        pipe.add(*(shot(n, kind="Shot" if n % 3 else "Pass", minute=n) for n in range(start, start + 10)))
        pipe.silver()
        pipe.gold("shots")
    silver = pipe.table("silver")[0]
    key = ["event_id"]
    streamed = pipe.table("shots")[0].orderBy(*key).collect()
    assert streamed == gold.shots(silver).orderBy(*key).collect()
    assert len(streamed) == 20


def test_job_goes_on_with_a_compacted_table(pipe):
    for n in (1, 2, 3):
        pipe.add(shot(n, minute=n % 2))
        pipe.silver()
        pipe.gold("xg_timeline")
    old, new = pipe.path("xg_timeline"), pipe.path("compacted/xg_timeline")
    cli.main(["compact", "--table", "xg_timeline", "--source", old, "--out", new])
    assert len(list(Path(new).glob("batch_id=*"))) == 1
    pipe.add(shot(4, minute=1))
    pipe.silver()
    cli.main(["gold", "--tables", "xg_timeline", "--source", pipe.path("silver"), "--out", pipe.path("compacted"), "--checkpoint", pipe.path("ck"), "--once"])
    rows = jobs.current_xg_timeline(pipe.spark, new).collect()
    assert {r.minute: (r.xg_total, r.shots_total) for r in rows} == {0: (0.25, 1), 1: (0.75, 3)}


def timeline_rows(spark, *rows):
    return spark.createDataFrame(list(rows), XG_TIMELINE)


def test_change_log_retry_version_and_compaction(spark, tmp_path):
    path, smaller = str(tmp_path / "log"), str(tmp_path / "smaller")
    assert change_log.version(spark, path, XG_TIMELINE) is None
    assert change_log.current(spark, path, XG_TIMELINE, KEYS).count() == 0
    change_log.write_changes(timeline_rows(spark, (1, "H", 1, 0.1, 1), (1, None, 1, 0.2, 1)), 0, path)
    for _ in range(2):
        change_log.write_changes(timeline_rows(spark, (1, "H", 1, 0.3, 2), (1, "H", 2, 0.5, 1)), 11, path)
    want = {("H", 1): (0.3, 2), ("H", 2): (0.5, 1), (None, 1): (0.2, 1)}

    def now(at):
        rows = change_log.current(spark, at, XG_TIMELINE, KEYS).collect()
        assert len(rows) == len({(r.team_name, r.minute) for r in rows})
        return {(r.team_name, r.minute): (r.xg_total, r.shots_total) for r in rows}

    assert now(path) == want
    assert change_log.version(spark, path, XG_TIMELINE) == 11
    change_log.compact(spark, path, smaller, XG_TIMELINE, KEYS)
    assert now(smaller) == want
    assert change_log.version(spark, smaller, XG_TIMELINE) == 11
    change_log.write_changes(timeline_rows(spark, (1, "H", 1, 0.9, 3)), 12, smaller)
    assert now(smaller) == {**want, ("H", 1): (0.9, 3)}


def test_merge_additive(spark):
    target = timeline_rows(spark, (1, "H", 1, 0.5, 1), (1, None, 2, 0.25, 1), (1, "A", 3, None, 1))
    batch = timeline_rows(spark, (1, "H", 1, 0.25, 2), (1, None, 2, 0.5, 1), (2, "H", 1, 0.5, 4), (1, "A", 3, 0.5, 1))
    merged = merge_additive(target, batch, KEYS, ["xg_total", "shots_total"])
    assert sorted(map(tuple, merged.collect()), key=str) == sorted(
        [(1, "H", 1, 0.75, 3), (1, None, 2, 0.75, 2), (2, "H", 1, 0.5, 4), (1, "A", 3, 0.5, 2)], key=str
    )


def test_latest_by_key_keeps_unmentioned_keys(spark):
    changes = spark.createDataFrame(
        [("a", 1, 0), ("b", 2, 0), ("a", None, 3), (None, 7, 1)], "k STRING, v INT, batch_id BIGINT"
    )
    rows = latest_by_key(changes, ["k"]).collect()
    assert {r.k: r.v for r in rows} == {"a": None, "b": 2, None: 7}


def test_commands(spark, tmp_path, capsys):
    root = str(tmp_path)
    events = [json.loads(shot(n, "Home" if n % 2 else "Away", minute=n)[2]) for n in range(1, 7)]
    os.mkdir(f"{root}/files")
    Path(f"{root}/files/events_5.json").write_text(json.dumps(events, indent=2))
    cli.main(["publish", "--source", f"{root}/files", "--format", "parquet", "--out", f"{root}/rows"])
    published = spark.read.parquet(f"{root}/rows")
    assert {r.key for r in published.collect()} == {"unknown"}
    log = published.select(
        F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"),
        F.lit("t").alias("topic"), F.lit(0).alias("partition"),
        F.lit(0).cast("bigint").alias("offset"), F.lit(NOON).alias("timestamp"), "match_id",
    )
    log.write.parquet(f"{root}/log")
    cli.main(["bronze", "--format", "parquet", "--source", f"{root}/log", "--match-id", "column", "--out", f"{root}/bronze", "--checkpoint", f"{root}/ck/bronze", "--once"])
    cli.main(["silver", "--source", f"{root}/bronze", "--out", f"{root}/silver", "--checkpoint", f"{root}/ck/silver", "--once"])
    cli.main(["gold", "--source", f"{root}/silver", "--out", f"{root}/gold", "--checkpoint", f"{root}/ck/gold", "--once"])
    cli.main(["show", "--source", f"{root}/gold/shots", "--table", "shots"])
    assert "6 rows, 1 matches, version 0" in capsys.readouterr().out
    cli.main(["show", "--source", f"{root}/gold/momentum", "--table", "momentum"])
    assert "2 rows, 1 matches, version 0" in capsys.readouterr().out
    cli.main(["views", "--source", f"{root}/silver", "--gold", f"{root}/gold", "--match", "5"])
    shown = capsys.readouterr().out
    assert [shown.count(name) for name in ("kpi_row", "xg_race", "shot_map", "event_log")] == [1] * 4
    assert "Away — Saved" in shown


def test_missing_table_is_empty_but_other_errors_show(spark, tmp_path):
    missing = read_table(spark, str(tmp_path / "nothing"), SILVER)
    assert missing.count() == 0 and missing.columns[0] == "match_id"
    assert append_version(str(tmp_path / "nothing")) is None
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "part.parquet").write_text("not parquet")
    with pytest.raises(Exception, match="(?i)parquet"):
        read_table(spark, str(tmp_path / "broken"), SILVER).count()


def test_work_folders_lie_in_the_named_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark) == named
    first, second = new_run_dir(spark, "a"), new_run_dir(spark, "a")
    assert first != second and first.startswith(named)


class Cluster:
    """As much of a session as is looked at, on a cluster."""

    master = "yarn"
    settings = {}

    @property
    def sparkContext(self):
        return self

    @property
    def conf(self):
        return self.settings

    def getCheckpointDir(self):
        return None


def test_a_cluster_must_name_its_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Cluster())


def test_log_schema_is_read_as_a_stream(spark, tmp_path):
    assert stream_table(spark, str(tmp_path), LOG).isStreaming
