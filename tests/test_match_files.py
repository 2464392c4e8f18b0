"""Match files written by tasks, and what listing and reading many of them takes."""

import json
from pathlib import Path

from pyspark.sql import functions as F

from matchlive.plans import catalog
from matchlive.sources import match_files
from matchlive.sources.match_files import read_match_documents, read_match_events, write_match_documents


def contents(folders):
    """Name to elements of all files, each found once."""
    files = [file for folder in folders for file in Path(folder.removeprefix("file:")).rglob("*") if file.is_file()]
    assert len({file.name for file in files}) == len(files)
    return {file.name: json.loads(file.read_text()) for file in files}


def tasks(spark, group, job):
    """What a job returns, and the numbers of tasks of its stages."""
    spark.sparkContext.setJobGroup(group, group)
    try:
        found = job()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    stages = {stage for n in tracker.getJobIdsForGroup(group) for stage in tracker.getJobInfo(n).stageIds}
    return found, [info.numTasks for stage in stages if (info := tracker.getStageInfo(stage))]


def test_a_file_per_match(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(match_files, "FOLDER_FILES", 3)
    rows = [(n % 20 - 5, json.dumps({"id": f"é{n}", "list": [n]}, ensure_ascii=False)) for n in range(400)]
    rows += [(None, '{"id": "x"}'), (None, '{"id": "x"}'), (1, None), (77, None), (78, None), (78, "7"), (78, None)]
    want = {}
    for match, text in rows:
        found = want.setdefault(f"events_{'without_id' if match is None else match}.json", [])
        found += [] if text is None else [json.loads(text)]
    documents = spark.createDataFrame(rows, "match_id bigint, payload string").repartition(5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        folders = write_match_documents(documents, str(tmp_path / "files"))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    key = lambda found: sorted(json.dumps(one) for one in found)
    got = contents(folders)
    assert {name: key(found) for name, found in got.items()} == {name: key(found) for name, found in want.items()}
    assert len(folders) == len(set(folders)) >= len(got) / 3
    back = read_match_documents(spark, folders, range_bytes=50).groupBy("match_id").count().collect()
    counts = {row.match_id: row["count"] for row in back}
    assert counts == {**{n: 20 for n in range(15)}, 78: 1, None: 5 * 20 + 2}
    events = read_match_events(spark, folders).where("match_id < 15")
    assert events.groupBy("match_id").count().where("count = 20").count() == 15


def test_no_documents(spark, tmp_path):
    none = spark.createDataFrame([], "match_id bigint, payload string")
    folders = write_match_documents(none, str(tmp_path / "files"))
    assert read_match_documents(spark, folders).collect() == []
    assert read_match_events(spark, folders).collect() == []


def test_what_an_earlier_attempt_left_is_not_read(spark, tmp_path):
    rows = spark.createDataFrame([(4, '{"id": 1}')], "match_id bigint, payload string")
    first = write_match_documents(rows, str(tmp_path / "files"))
    again = write_match_documents(rows, str(tmp_path / "files"))
    assert read_match_documents(spark, again).count() == 1 and read_match_documents(spark, first + again).count() == 2


def test_many_files_are_listed_in_few_tasks_and_scanned_once(spark, tmp_path):
    """By a task for each split there were 600 here, three times over."""
    for n in range(600):
        (tmp_path / f"events_{n}.json").write_text(json.dumps([{"id": n}, {"id": -n, "text": "x" * 40}]))
    spark.conf.set("spark.sql.files.maxPartitionBytes", 1)
    try:
        for width in (30, 1 << 20):
            found, numbers = tasks(spark, f"list-{width}", lambda w=width: read(spark, tmp_path, w))
            assert found == 1200 and max(numbers) <= 32
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def read(spark, folder, width):
    documents = read_match_documents(spark, str(folder), range_bytes=width)
    plan = documents._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan binaryFile") == 1
    return documents.where(F.col("payload").isNotNull()).count()


def made_events(spark, path, matches):
    """An events table of two events a match, written as the test tables are."""
    kind = "CASE WHEN id % 3 = 0 THEN 'purchase' ELSE 'view' END AS event_type"
    rows = spark.range(matches * 2).selectExpr(
        "id div 2 * 100 + id % 2 AS event_id", "TIMESTAMP '2024-01-01 00:00:00' AS ts", "id % 50 AS user_id", kind,
        "CAST(id AS DOUBLE) AS value", "concat('{\"k\": ', id % 100, '}') AS props",
    )
    rows.write.parquet(f"{path}/events.parquet")
    return str(path)


def test_backfill_silver_spends_no_task_on_a_match(spark, tmp_path):
    """A folder per match took a task each to list: 1,000 here, and most of the time with many matches."""
    sf_dir = made_events(spark, tmp_path, 1000)
    rows, numbers = tasks(spark, "silver", lambda: catalog.backfill_silver(spark, sf_dir).collect())
    assert max(numbers) < 100
    direct = catalog.silver(spark, sf_dir).where("event_id IS NOT NULL")
    assert len(rows) == 2000 and len({(row.match_id, row.event_id) for row in rows}) == 2000
    parsed = {(row.match_id, row.event_id): row for row in rows}
    for row in direct.drop("event_time").collect():
        assert parsed[row.match_id, row.event_id] == row
