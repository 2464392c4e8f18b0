"""Passes, players and matches against plain Python."""

import datetime
import json
import random

import pytest
from pyspark.sql import functions as F

from matchlive.operators.parse import parse_documents
from matchlive.plans import matches, passing, players
from matchlive.schemas import BRONZE, SILVER, SILVER_DETAILS, columns

NOON = datetime.datetime(2024, 1, 1, 12)
NAMES = (*columns(SILVER), *columns(SILVER_DETAILS))
KINDS = ["Shot", "Pass", "Carry", "Dribble", "Foul Committed", None]


def event(n, rng=None, **own):
    rng = rng or random.Random(n)
    kind = rng.choice(KINDS)
    found = {
        "match_id": rng.choice([1, 1, 1, 2, None]), "event_id": f"e{n:04d}", "event_index": rng.choice([None, n, n, n // 2]),
        "period": 1, "minute": 0, "second": 0, "match_second": rng.choice([None, *range(0, 2000, 7)]),
        "event_type": kind, "team_id": None, "team_name": rng.choice(["Home", "Away", "Away", None]),
        "player_id": rng.choice([None, 1, 2, 3]), "player_name": rng.choice(["A", "B", None]),
        "loc_x": rng.choice([None, 50.0, 101.9, 102.0, 119.0]), "loc_y": rng.choice([17.9, 18.0, 40.0, 62.0, 62.1, None]),
        "xg": rng.choice([0.0, -0.1, 0.25]) if kind == "Shot" else 0.0,
        "shot_outcome": rng.choice(["Goal", "Saved", None]) if kind == "Shot" else None, "event_time": None,
        "possession": rng.choice([None, *range(12)]), "is_pass": kind == "Pass" and rng.random() < 0.8,
        "pass_outcome": rng.choice([None, None, "Incomplete"]), "is_key_pass": kind == "Pass" and rng.random() < 0.2,
    }
    return found | own


def frame(spark, events):
    schema = f"{SILVER}, {SILVER_DETAILS}"
    return spark.createDataFrame([tuple(e[n] for n in NAMES) for e in events], schema).repartition(4)


@pytest.fixture(scope="module")
def events():
    rng = random.Random(11)
    return [event(n, rng) for n in range(900)]


@pytest.fixture(scope="module")
def silver(spark, events):
    return frame(spark, events)


def seconds_of(events):
    """Per team the seconds with an event, and its events with a second."""
    teams = {}
    for e in events:
        if e["match_second"] is not None:
            teams.setdefault((e["match_id"], e["team_name"]), []).append(e)
    return teams


def test_pass_completion(silver, events):
    want = {}
    for team, own in seconds_of(events).items():
        for second in {e["match_second"] for e in own}:
            tried = [e for e in own if second - 300 <= e["match_second"] <= second and e["is_pass"]]
            done = sum(e["pass_outcome"] is None for e in tried)
            want[(*team, second)] = (len(tried), done, round(done / len(tried), 3) if tried else None)
    got = {tuple(row)[:3]: tuple(row)[3:] for row in passing.pass_completion(silver).collect()}
    assert got == want
    assert None in {share for _, _, share in want.values()}


def inside(e):
    return e["loc_x"] >= 102 and 18 <= e["loc_y"] <= 62


def entries(events):
    groups = {}
    for e in events:
        if None not in (e["possession"], e["loc_x"], e["loc_y"]):
            groups.setdefault((e["match_id"], e["possession"], e["team_name"]), []).append(e)
    found = []
    for own in groups.values():
        own.sort(key=lambda e: (e["event_index"] or 0, e["event_id"]))
        found += [b for a, b in zip(own, own[1:], strict=False) if inside(b) and not inside(a)]
    return found


def chances(events, picked):
    """shots, xG, key passes and entries of the events that ``picked`` takes."""
    own, entered = [e for e in events if picked(e)], [e for e in entries(events) if picked(e)]
    shots = sum(e["event_type"] == "Shot" for e in own)
    xg = sum(max(e["xg"], 0) for e in own)
    return shots, round(xg, 6), sum(e["is_key_pass"] for e in own), len(entered)


@pytest.mark.parametrize("pieces", [None, 7])
def test_weighted_momentum_series(silver, events, pieces):
    weights = passing.Weights(1, 3, 0.5, 0.25)
    want = {}
    for team, own in seconds_of(events).items():
        for second in {e["match_second"] for e in own}:
            parts = chances(
                events,
                lambda e, team=team, second=second: (e["match_id"], e["team_name"]) == team
                and e["match_second"] is not None and second - 300 <= e["match_second"] <= second,
            )
            want[(*team, second)] = (*parts, round(sum(w * p for w, p in zip(weights, parts, strict=True)), 6))
    found = passing.weighted_momentum_series(silver, weights, pieces=pieces)
    found = found.withColumns({name: F.round(name, 6) for name in ("xg_total", "weighted")})
    assert {tuple(row)[:3]: tuple(row)[3:] for row in found.collect()} == want
    assert sum(parts[3] for parts in want.values()) > 0


def test_weighted_momentum_at_the_end(silver, events):
    got = {(row.match_id, row.team_name): row for row in passing.weighted_momentum(silver).collect()}
    teams = seconds_of(events)
    assert set(got) == set(teams)
    for match in {match for match, _ in teams}:
        own = [e["match_second"] for (m, _), found in teams.items() if m == match for e in found]
        total = sum(row.weighted for (m, _), row in got.items() if m == match)
        for (m, team), row in got.items():
            if m == match:
                assert (row.window_start_second, row.window_end_second) == (max(0, max(own) - 300), max(own))
                parts = chances(events, lambda e, team=team: e["match_id"] == match and e["team_name"] == team
                                and e["match_second"] is not None and e["match_second"] >= max(own) - 300)
                assert (row.shots, round(row.xg_total, 6), row.key_passes, row.box_entries) == parts
                assert row.weighted_share == (round(row.weighted / total, 3) if total else None)


def test_nobody_had_a_chance(spark):
    rows = [event(n, event_type="Carry", is_key_pass=False, xg=0.0, loc_x=None, match_id=1, match_second=n, team_name=t) for n, t in enumerate("AB")]
    assert [row.weighted_share for row in passing.weighted_momentum(frame(spark, rows)).collect()] == [None, None]


def sums(own):
    touch = {"Shot", "Dribble", "Carry", "Pass", "Ball Receipt*", "Miscontrol"}
    return (
        sum(e["event_type"] == "Shot" for e in own),
        sum(e["event_type"] == "Shot" and e["shot_outcome"] == "Goal" for e in own),
        sum(e["event_type"] == "Pass" for e in own),
        sum(e["event_type"] in touch and None not in (e["loc_x"], e["loc_y"]) for e in own),
        round(sum(max(e["xg"], 0) for e in own), 6),
    )


def test_player_spotlight(silver, events):
    want = {}
    for level, keys in (("player", players.PLAYER), ("team", players.PLAYER[:2]), ("match", players.PLAYER[:1])):
        groups = {}
        for e in events:
            groups.setdefault(tuple(e[k] for k in keys), []).append(e)
        for key, own in groups.items():
            names = [e["player_name"] for e in own if e["player_name"]]
            name = max(names, default=None) if level == "player" else None
            want[(level, *key, *[None] * (3 - len(key)))] = (name, *sums(own))
    found = players.player_spotlight(players.player_totals(silver)).withColumn("xg_total", F.round("xg_total", 6))
    rows = found.collect()
    assert len(rows) == len(want)
    assert {tuple(row)[:4]: tuple(row)[4:] for row in rows} == want
    assert {("player", 1, None, None), ("team", 1, None, None), ("match", 1, None, None)} <= set(want)


def test_player_top(silver, events):
    groups = {}
    for e in events:
        if e["player_id"] is not None:
            groups.setdefault(tuple(e[k] for k in players.PLAYER), []).append(e)
    want = []
    for match in {key[0] for key in groups}:
        best = [(key, sums(own)) for key, own in groups.items() if key[0] == match]
        best.sort(key=lambda row: (-row[1][4], -row[1][1], -row[1][0], -row[1][3], row[0][2], row[0][1] or ""))
        want += [(match, rank, key[1], key[2]) for rank, (key, _) in enumerate(best[:4], 1)]
    got = [tuple(row)[:4] for row in players.player_top(players.player_totals(silver), 4).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def at(minutes, match_id=1, team="Home", goal=False):
    return event(0, match_id=match_id, team_name=team, event_type="Shot" if goal else "Carry",
                 shot_outcome="Goal" if goal else None, event_time=NOON + datetime.timedelta(minutes=minutes))


def test_match_catalogue(spark):
    """A match that pauses inside and outside the gap, one that goes on, one without a named team."""
    rows = [at(0), at(20, team="Away", goal=True), at(49)]
    rows += [at(0, 2), at(31, 2, goal=True), at(31, 2, team=None), at(100, 2, goal=True)]
    rows += [at(0, 3, team=None), at(1, 3, team=None)]
    rows += [at(0, 4), at(120, 4, team="Away"), at(120, 4, team="Third", goal=True), at(80, 5), at(81, None, team="Solo")]
    got = {row.match_id: tuple(row)[1:] for row in matches.match_catalogue(frame(spark, rows)).collect()}
    time = lambda minutes: NOON + datetime.timedelta(minutes=minutes)
    assert got == {
        1: ("Away", "Home", 1, 0, 3, time(0), time(49), 1, "finished"),
        2: ("Home", "?", 2, 0, 4, time(0), time(100), 2, "live"),
        3: ("?", "?", 0, 0, 2, time(0), time(1), 1, "finished"),
        4: ("Away", "Home", 0, 0, 3, time(0), time(120), 1, "live"),
        5: ("Home", "?", 0, 0, 1, time(80), time(80), 1, "finished"),
        None: ("Solo", "?", 0, 0, 1, time(81), time(81), 0, "live"),
    }
    assert matches.match_catalogue(frame(spark, rows).limit(0)).collect() == []


def test_details_of_documents(spark):
    documents = [
        {"id": "a", "type": {"name": "Pass"}, "possession": 4, "pass": {}},
        {"id": "b", "type": {"name": "Pass"}},
        {"id": "c", "type": {"name": "Pass"}, "pass": {"outcome": {"name": "Out"}, "shot_assist": True}},
        {"id": "d", "type": {"name": "Pass"}, "pass": {"outcome": None}},
        {"id": "e", "type": {"name": "Pass"}, "pass": None},
        {"id": "f", "type": {"name": "Carry"}, "pass": {"outcome": {}}},
        {"id": "g"},
    ]
    rows = [(1, "k", json.dumps(one), "t", 0, 0, NOON) for one in documents]
    wanted = ("event_id", *columns(SILVER_DETAILS))
    got = [tuple(row) for row in parse_documents(spark.createDataFrame(rows, BRONZE), wanted=wanted).collect()]
    assert sorted(got) == [
        ("a", 4, True, None, False), ("b", None, False, None, False), ("c", None, True, "Out", True),
        ("d", None, True, None, False), ("e", None, False, None, False), ("f", None, False, None, False),
        ("g", None, False, None, False),
    ]
