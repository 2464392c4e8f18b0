"""Log text to Silver rows, by hand-written edge cases."""

import datetime
import json

import pytest

from matchlive.operators import parse
from matchlive.schemas import BRONZE

BASE = {
    "id": "x",
    "index": 7,
    "period": 1,
    "minute": 7,
    "second": 5,
    "type": {"name": "Shot"},
    "team": {"id": 1, "name": "Home"},
    "player": {"id": 9, "name": "P9"},
    "location": [108, 40],
    "shot": {"statsbomb_xg": 0.7835, "outcome": {"name": "Goal"}},
}
NOON = datetime.datetime(2024, 1, 1, 12)


def document(**changes):
    changed = {**BASE, **changes}
    return json.dumps({k: v for k, v in changed.items() if v != "absent"})


def bronze(spark, texts, match_id=1):
    rows = [
        (match_id, "Home", text, "t", 0, n, NOON + datetime.timedelta(seconds=n))
        for n, text in enumerate(texts)
    ]
    return spark.createDataFrame(rows, BRONZE)


def silver(spark, *texts):
    return parse.silver_events(bronze(spark, texts)).collect()


def test_complete_shot(spark):
    [row] = silver(spark, document(extra={"a": [1]}, possession_team={"name": "Home"}))
    assert (row.event_id, row.event_index, row.match_second) == ("x", 7, 425)
    assert (row.loc_x, row.loc_y, row.xg, row.shot_outcome) == (108.0, 40.0, 0.7835, "Goal")
    assert (row.team_id, row.team_name, row.player_id, row.player_name) == (1, "Home", 9, "P9")
    assert row.event_time == NOON


@pytest.mark.parametrize(
    "changes, expected",
    [
        ({"location": [60.0]}, {"loc_x": 60.0, "loc_y": None}),
        ({"location": []}, {"loc_x": None, "loc_y": None}),
        ({"location": "absent"}, {"loc_x": None, "loc_y": None}),
        ({"minute": "absent"}, {"minute": None, "match_second": None}),
        ({"minute": "7"}, {"minute": None, "match_second": None}),
        ({"minute": 2**31 - 1}, {"match_second": None}),
        ({"shot": "absent"}, {"xg": 0.0, "shot_outcome": None}),
        ({"shot": {"statsbomb_xg": -0.1}}, {"xg": -0.1, "shot_outcome": None}),
        ({"period": 4}, {"period": 4}),
    ],
)
def test_kept(spark, changes, expected):
    [row] = silver(spark, document(**changes))
    assert {name: row[name] for name in expected} == expected


@pytest.mark.parametrize(
    "text",
    [
        document(period=5),
        document(period="absent"),
        document(id="absent"),
        document()[:20],
        "",
        f"[{document()}]",
        "null",
        None,
    ],
)
def test_dropped(spark, text):
    assert silver(spark, text) == []


def test_malformed_rows_are_those_without_id(spark):
    texts = [document(), document(period=5), document(id="absent"), document()[:20], "", None]
    found = parse.malformed_rows(bronze(spark, texts))
    assert sorted(row.offset for row in found.collect()) == [2, 3, 4, 5]


def test_first_copy_is_kept(spark):
    texts = [document(second=s) for s in range(50)]
    [row] = silver(spark, *reversed(texts))
    assert (row.second, row.event_time) == (49, NOON)


def test_same_id_in_two_matches(spark):
    both = bronze(spark, [document()], 1).union(bronze(spark, [document()], 2))
    rows = parse.silver_events(both).collect()
    assert sorted(row.match_id for row in rows) == [1, 2]


def test_repeated_events(spark):
    rows = parse.repeated_events(
        bronze(spark, [document(), document(id="y"), document(), document()])
    ).collect()
    assert [(r.event_id, r.copies, r.kept_time) for r in rows] == [("x", 3, NOON)]


def test_shootout_counts_events_once(spark):
    texts = [document(period=5), document(period=5), document(period=5, id="y", type=None)]
    [row] = parse.excluded_shootouts(bronze(spark, texts)).collect()
    assert (row.events, row.shots) == (2, 1)


def test_copies_are_dropped_before_the_shuffle(spark):
    plan = parse.silver_events(bronze(spark, [document()]))._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan ==") :]
    partial = physical.index("row_number(), 1, Partial")
    assert physical.index("Exchange hashpartitioning") < partial
    assert physical.count("from_json") == 1
