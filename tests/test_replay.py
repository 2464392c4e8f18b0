"""Replay order, waiting times and log rows."""

import json
import random

import pytest
from pyspark.sql import functions as F

from matchlive.operators import skew
from matchlive.plans import replay
from matchlive.sources.log import bronze_rows, match_id_in_header, match_id_in_topic
from matchlive.sources.match_files import read_match_documents, read_match_events


def document(index=None, minute=None, second=None, id=None, team="Home"):
    fields = {"id": id, "index": index, "minute": minute, "second": second, "period": 1}
    kept = {k: v for k, v in fields.items() if v is not None}
    return json.dumps({**kept, "possession_team": {"name": team}, "type": {"name": "Pass"}})


def frame(spark, rows):
    return spark.createDataFrame(rows, "match_id BIGINT, payload STRING")


def schedule(spark, texts, **options):
    rows = replay.replay_schedule(frame(spark, [(1, t) for t in texts]), **options)
    return [tuple(r) for r in rows.orderBy("emit_at_s", "event_index").collect()]


def test_order_is_by_index(spark):
    texts = [document(3, 2, 0), document(1, 0, 0), document(2, 1, 0)]
    assert [r[1] for r in schedule(spark, texts, speed=1000)] == [1, 2, 3]


def test_first_wait_is_zero_and_others_scaled(spark):
    texts = [document(1, 0, 0), document(2, 0, 10), document(3, 0, 70)]
    rows = schedule(spark, texts, speed=10, longest_wait=100)
    assert [r[3] for r in rows] == [0.0, 1.0, 6.0]
    assert [r[4] for r in rows] == [0.0, 1.0, 7.0]


def test_waits_are_capped_and_never_negative(spark):
    texts = [document(1, 0, 0), document(2, 45, 0), document(3, 44, 0)]
    rows = schedule(spark, texts, speed=1, longest_wait=3)
    assert sorted(r[3] for r in rows) == [0.0, 0.0, 3.0]


def test_missing_numbers_count_as_zero(spark):
    rows = schedule(spark, [document(2, 1), document(None, None, 5), document(3)], speed=1, longest_wait=90)
    assert [(r[1], r[2], r[3]) for r in rows] == [(0, 5, 0.0), (2, 60, 55.0), (3, 0, 0.0)]


@pytest.fixture(scope="module")
def matches(spark):
    rng = random.Random(5)
    rows = []
    for match_id, size in ((1, 400), (2, 30), (None, 90)):
        for n in range(size):
            index = rng.choice([None, n, n, n // 4])
            rows.append((match_id, document(index, rng.randrange(90), rng.randrange(60), f"i{n:04d}")))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("pieces", [None, 40])
def test_schedule_against_a_loop(spark, matches, pieces):
    want = []
    for match_id in (1, 2, None):
        events = [json.loads(text) for m, text in matches if m == match_id]
        events.sort(key=lambda e: (e.get("index", 0), e["id"]))
        previous, due = None, 0.0
        for e in events:
            clock = e["minute"] * 60 + e["second"]
            wait = 0.0 if previous is None else min(max(0, clock - previous) / 60, 3)
            previous, due = clock, due + wait
            want.append((match_id, e.get("index", 0), clock, round(wait, 6), round(due, 6)))
    documents = frame(spark, matches).repartition(4)
    got = replay.replay_schedule(documents, pieces=pieces)
    rows = got.withColumns({n: F.round(n, 6) for n in ("delay_s", "emit_at_s")}).collect()
    assert sorted(map(tuple, rows), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("pieces", [None, 40])
def test_progress(spark, matches, pieces):
    documents = frame(spark, matches)
    rows = replay.replay_progress(documents, 25, pieces).collect()
    marks = sorted((r.match_id or 0, r.emitted) for r in rows)
    assert marks == [(0, n) for n in (25, 50, 75)] + [(1, n) for n in range(25, 401, 25)] + [(2, 25)]


def test_log_rows_keep_the_document(spark):
    text = '{"id":"a","possession_team":{"name":"Home"},"extra":{"deep":[1,2.50]}}'
    rows = replay.log_rows(frame(spark, [(1, text), (1, '{"id":"b"}'), (1, "{")])).collect()
    assert [(r.key, r.value) for r in rows] == [("Home", text), ("unknown", '{"id":"b"}'), ("unknown", "{")]


def test_documents_are_sent_in_match_order(spark, matches, tmp_path):
    documents = frame(spark, matches).repartition(4)
    replay.publish(replay.log_rows(replay.in_match_order(documents)), "parquet", str(tmp_path / "rows"))
    order = []
    for part in sorted((tmp_path / "rows").glob("part-*")):
        for r in spark.read.parquet(str(part)).coalesce(1).collect():
            order.append((r.match_id or 0, json.loads(r.value).get("index", 0)))
    assert len(order) == len(matches) and order == sorted(order)


def test_match_files(spark, tmp_path):
    events = [json.loads(document(n, n, 0, f"e{n}")) | {"extra": {"n": n}} for n in (1, 2, 3)]
    (tmp_path / "events_77.json").write_text(json.dumps(events, indent=1))
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "events_78.json").write_text(json.dumps(events[:1]))
    typed = read_match_events(spark, str(tmp_path)).collect()
    assert sorted((r.match_id, r.id) for r in typed) == [(77, "e1"), (77, "e2"), (77, "e3"), (78, "e1")]
    texts = read_match_documents(spark, str(tmp_path)).filter("match_id = 77").collect()
    assert [json.loads(r.payload) for r in texts] == events


def test_match_id_from_header_or_topic(spark):
    log = spark.createDataFrame(
        [
            (b"k", b"{}", "match.events.12", [("other", b"1"), ("match_id", b"34")]),
            (b"k", b"{}", "match.events", None),
        ],
        "key BINARY, value BINARY, topic STRING, headers ARRAY<STRUCT<key: STRING, value: BINARY>>",
    ).selectExpr("*", "0 AS partition", "0L AS offset", "timestamp '2024-01-01' AS timestamp")
    by_header = bronze_rows(log, match_id_in_header()).collect()
    by_topic = bronze_rows(log, match_id_in_topic()).collect()
    assert [r.match_id for r in by_header] == [34, None]
    assert [r.match_id for r in by_topic] == [12, None]
    assert by_header[0].kafka_key == "k" and by_header[0].event_json == "{}"


def test_large_group_is_cut_into_many_pieces(spark, matches):
    documents = frame(spark, matches).repartition(4)
    pieces = skew.ordered_pieces(documents, ["match_id"], [F.col("payload")], 26)
    sizes = {tuple(r)[:2]: r["count"] for r in pieces.groupBy("match_id", "_piece").count().collect()}
    assert sum(sizes.values()) == len(matches)
    large = [n for (match_id, _), n in sizes.items() if match_id == 1]
    assert len(large) > 10 and max(large) < 100


def test_documents_without_index_and_id_are_cut_too(spark):
    """Only the hash of the text tells them apart."""
    rows = [(1, document(None, n % 90, n % 60, None, f"team {n}")) for n in range(600)]
    documents = frame(spark, rows).repartition(4)
    sizes = skew.ordered_pieces(replay._clocked(documents), ["match_id"], replay._order(), 12)
    assert max(r["count"] for r in sizes.groupBy("_piece").count().collect()) <= 100
    hashes = {r.payload: r.h for r in documents.select("payload", F.xxhash64("payload").alias("h")).collect()}
    want, due, previous = [], 0.0, None
    for text in sorted(hashes, key=hashes.get):
        event = json.loads(text)
        clock = event["minute"] * 60 + event["second"]
        wait = 0.0 if previous is None else min(max(0, clock - previous) / 60, 3)
        previous, due = clock, due + wait
        want.append((clock, round(wait, 6), round(due, 6)))
    got = replay.replay_schedule(documents, pieces=12).collect()
    assert sorted((r.match_second, round(r.delay_s, 6), round(r.emit_at_s, 6)) for r in got) == sorted(want)
