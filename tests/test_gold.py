"""Gold tables and views against plain Python on small random matches."""

import math
import random

import pytest
from pyspark.sql import functions as F

from matchlive.plans import gold, views
from matchlive.schemas import MOMENTUM, SILVER

KINDS = ["Shot", "Pass", "Carry", "Foul Committed", "Miscontrol", None]
OUTCOMES = ["Goal", "Saved", "Off T", "Saved to Post", None]
ATTACKING = {"Shot", "Pass", "Carry", "Miscontrol"}


def event(match_id, n, rng, teams=("Away", "Home")):
    minute = rng.choice([None, *range(95)])
    second = rng.randrange(60)
    kind = rng.choice(KINDS)
    shot = kind == "Shot"
    return {
        "match_id": match_id,
        "event_id": f"{match_id}-{n:04d}",
        "event_index": rng.choice([None, n, n]),
        "period": 1,
        "minute": minute,
        "second": second,
        "match_second": None if minute is None else minute * 60 + second,
        "event_type": kind,
        "team_id": None,
        "team_name": rng.choice(teams),
        "player_id": None,
        "player_name": "P",
        "loc_x": rng.choice([None, rng.uniform(0, 120)]),
        "loc_y": rng.uniform(0, 80),
        "xg": rng.choice([0.0, -0.1, round(rng.random(), 3)]) if shot else 0.0,
        "shot_outcome": rng.choice(OUTCOMES) if shot else None,
        "event_time": None,
    }


@pytest.fixture(scope="module")
def events():
    rng = random.Random(3)
    rows = []
    for match_id, size in ((1, 300), (2, 40), (3, 15), (None, 60)):
        rows += [event(match_id, n, rng) for n in range(size)]
    rows += [event(4, n, rng, ("Solo",)) for n in range(20)]
    rows += [event(5, n, rng, ("A", "B", "C")) for n in range(60)]
    rows += [event(6, n, rng, (None, "Home")) for n in range(30)]
    return rows


@pytest.fixture(scope="module")
def silver(spark, events):
    names = list(events[0])
    return spark.createDataFrame([tuple(e[n] for n in names) for e in events], SILVER)


def groups(rows, *keys):
    found = {}
    for row in rows:
        found.setdefault(tuple(row[k] for k in keys), []).append(row)
    return found


def test_xg_timeline(silver, events):
    counted = groups((e for e in events if e["xg"] > 0), "match_id", "team_name", "minute")
    want = {k: (round(sum(e["xg"] for e in v), 6), len(v)) for k, v in counted.items()}
    got = {
        (r.match_id, r.team_name, r.minute): (round(r.xg_total, 6), r.shots_total)
        for r in gold.xg_timeline(silver).collect()
    }
    assert got == want


def logistic(goal_diff, xg_diff, left):
    left = max(0, min(90, left))
    played = 1 - left / 90
    logit = (1.5 + 2 * played) * goal_diff + 0.6 * (1 - played) * xg_diff
    return round(1 / (1 + math.exp(-logit)), 4)


def expected_state(events):
    want = {}
    for (match_id,), rows in groups(events, "match_id").items():
        teams = {}
        for (team,), mine in groups(rows, "team_name").items():
            minutes = [e["minute"] for e in mine if e["minute"] is not None]
            teams[team] = (
                sum(e["shot_outcome"] == "Goal" for e in mine),
                sum(e["xg"] for e in mine),
                max(minutes),
            )
        order = sorted(teams, key=lambda t: (t is not None, t))
        chance = dict.fromkeys(order, 0.5)
        if len(order) == 2:
            a, b = (teams[t] for t in order)
            left = max(0, 90 - max(a[2], b[2]))
            first = logistic(a[0] - b[0], a[1] - b[1], left)
            chance = {order[0]: first, order[1]: round(1 - first, 4)}
        for team, (goals, xg, minute) in teams.items():
            want[match_id, team] = (goals, round(xg, 6), minute, chance[team])
    return want


def state_of(rows):
    return {
        (r.match_id, r.team_name): (r.goals, round(r.xg_total, 6), r.latest_minute, r.win_probability)
        for r in rows
    }


def test_match_state(silver, events):
    assert state_of(gold.match_state(silver).collect()) == expected_state(events)


def expected_momentum(events, seconds=300):
    want = {}
    clocked = [e for e in events if e["match_second"] is not None]
    for (match_id,), rows in groups(clocked, "match_id").items():
        end = max(e["match_second"] for e in rows)
        start = max(0, end - seconds)
        acting = [
            e for e in rows if e["event_type"] in ATTACKING and start <= e["match_second"] <= end
        ]
        for (team,), mine in groups(acting, "team_name").items():
            share = round(len(mine) / len(acting), 3)
            want[match_id, team] = (len(mine), share, start, end)
    return want


@pytest.mark.parametrize("seconds", [60, 300, 10_000])
def test_momentum(silver, events, seconds):
    got = {
        (r.match_id, r.team_name): (
            r.attacking_actions, r.dominance_pct, r.window_start_second, r.window_end_second,
        )
        for r in gold.momentum(silver, seconds=seconds).collect()
    }
    assert got == expected_momentum(events, seconds)


def test_team_overview_is_state_with_momentum(silver):
    names = ["match_id", "team_name", "goals", "xg_total", "latest_minute", "win_probability", "dominance_pct"]
    joined = views.with_momentum(gold.match_state(silver), gold.momentum(silver))

    def rows(frame):
        rounded = frame.withColumn("xg_total", F.round("xg_total", 6)).select(*names)
        return sorted(rounded.collect(), key=str)

    assert rows(gold.team_overview(silver)) == rows(joined)


def test_momentum_series(silver, events):
    clocked = [e for e in events if e["match_second"] is not None]
    want = []
    for mine in groups(clocked, "match_id", "team_name").values():
        for e in mine:
            at = e["match_second"]
            n = sum(
                x["event_type"] in ATTACKING and at - 300 <= x["match_second"] <= at for x in mine
            )
            want.append((e["match_id"], e["team_name"], at, e["event_index"], n))
    got = gold.momentum_series(silver)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("pieces", [None, 40])
def test_win_probability_by_shot(silver, events, pieces):
    want = []
    shots = [e for e in events if e["event_type"] == "Shot"]
    for (match_id,), rows in groups(shots, "match_id").items():
        named = [e["team_name"] for e in rows if e["team_name"] is not None]
        team1 = min(named) if named else None
        goals = xg = 0
        for e in sorted(rows, key=lambda e: (e["event_index"] or 0, e["event_id"])):
            side = 1 if e["team_name"] is not None and e["team_name"] == team1 else -1
            goals += side * (e["shot_outcome"] == "Goal")
            xg += side * e["xg"]
            left = None if e["minute"] is None else max(0, 90 - e["minute"])
            want.append((match_id, e["event_index"], team1, goals, round(xg, 6), left))
    got = gold.win_probability_by_shot(silver, pieces)
    kept = got.withColumn("xg_diff", F.round("xg_diff", 6) + 0.0).drop("p_team1").collect()

    def clean(rows):
        return sorted(((*r[:4], r[4] + 0.0 if r[4] else 0.0, r[5]) for r in map(tuple, rows)), key=str)

    assert clean(kept) == clean(want)


def test_shot_map(silver, events):
    want = set()
    shots = [e for e in events if e["event_type"] == "Shot"]
    for (match_id,), rows in groups(shots, "match_id").items():
        teams = sorted({e["team_name"] for e in rows} - {None})[:2]
        for e in rows:
            if e["team_name"] in teams and e["shot_outcome"] in ("Goal", "Saved", "Off T"):
                colour = views.TEAM_COLOURS[teams.index(e["team_name"])]
                want.add((match_id, e["event_id"], f"{e['team_name']} — {e['shot_outcome']}", colour))
    found = views.shot_map(gold.shots(silver)).collect()
    assert {(r.match_id, r.event_id, r.label, r.team_colour) for r in found} == want
    assert len(found) == len(want)


def test_xg_race(silver, events):
    positive = [e for e in events if e["xg"] > 0 and e["team_name"] is not None]
    want = {}
    for (match_id,), rows in groups(positive, "match_id").items():
        for team in sorted({e["team_name"] for e in rows})[:2]:
            total = 0
            mine = groups((e for e in rows if e["team_name"] == team), "minute")
            for (minute,), parts in sorted(mine.items(), key=lambda m: (m[0][0] is not None, m[0])):
                total += sum(e["xg"] for e in parts)
                want[match_id, team, minute] = round(total, 6)
    race = views.xg_race(gold.xg_timeline(silver)).collect()
    assert {(r.match_id, r.team_name, r.minute): round(r.xg_cumulative, 6) for r in race} == want


def test_kpi_row_with_one_team_and_without_momentum(spark, silver):
    state = gold.match_state(silver.filter("match_id = 4"))
    nothing = spark.createDataFrame([], MOMENTUM)
    [row] = views.kpi_row(views.with_momentum(state, nothing)).collect()
    assert (row.team1, row.team2, row.goals2, row.xg2) == ("Solo", "?", 0, 0.0)
    assert (row.p1_pct, row.p2_pct, row.dom1_pct, row.dom2_pct) == (50.0, 50.0, 50, 50)


def test_kpi_row_takes_the_first_two_of_three_teams(silver, events):
    [row] = views.kpi_row(gold.team_overview(silver.filter("match_id = 5"))).collect()
    assert (row.team1, row.team2) == ("A", "B")
    state = expected_state(events)
    assert (row.goals1, row.goals2) == (state[5, "A"][0], state[5, "B"][0])


def test_team_list(silver):
    teams = {r.match_id: (r.teams, r.team_count) for r in views.team_list(silver).collect()}
    assert teams[5] == (["A", "B", "C"], 3)
    assert teams[6] == (["Home"], 1)


def test_event_log(silver, events):
    log = views.event_log(silver.drop("xg"), rows=7)
    assert log.columns == ["match_id", "rank", "minute", "second", "team_name", "player_name", "event_type"]
    mine = [e for e in events if e["match_id"] == 1 and e["match_second"] is not None]
    newest = sorted((e["match_second"] for e in mine), reverse=True)[:7]
    rows = log.filter("match_id = 1").orderBy("rank").collect()
    assert [r.minute * 60 + r.second for r in rows] == newest


def test_row_counts(spark, silver, events):
    parts = {"silver": None, "shots": F.col("event_type") == "Shot"}
    counts = {r.table_name: (r.row_count, r.distinct_matches) for r in views.row_counts(silver, parts).collect()}
    assert counts["silver"] == (len(events), 6)
    assert counts["shots"][0] == sum(e["event_type"] == "Shot" for e in events)
    empty = views.row_counts(silver.limit(0), parts).collect()
    assert [(r.table_name, r.row_count, r.distinct_matches) for r in empty] == [
        ("silver", 0, 0), ("shots", 0, 0),
    ]


@pytest.mark.parametrize(
    "x, y, zone",
    [
        (114, 30, "six_yard"), (114, 29, "box"), (102, 62, "box"), (102, 63, "attacking_half"),
        (60, 0, "attacking_half"), (59.9, 40, "own_half"), (None, 40, "unknown"), (110, None, "unknown"),
    ],
)
def test_shot_zone(spark, x, y, zone):
    frame = spark.createDataFrame([(x and float(x), None if y is None else float(y))], "x DOUBLE, y DOUBLE")
    assert frame.select(views.shot_zone(F.col("x"), F.col("y"))).first()[0] == zone


def test_kpi_row_leaves_events_without_a_team_out(spark, silver):
    rows = [(9, None, 5), (9, "Home", 1), (9, "Away", 2)]
    named = spark.createDataFrame(rows, "match_id BIGINT, team_name STRING, goals BIGINT").selectExpr(
        "*", "0.5D AS xg_total", "0.5D AS win_probability", "0.5D AS dominance_pct"
    )
    [row] = views.kpi_row(named).collect()
    assert (row.team1, row.goals1, row.team2, row.goals2) == ("Away", 2, "Home", 1)


def test_plans_have_no_nested_loops(silver):
    for frame in (
        gold.momentum_series(silver),
        gold.win_probability_by_shot(silver),
        views.shot_map(gold.shots(silver)),
    ):
        text = frame._jdf.queryExecution().toString()
        assert "NestedLoop" not in text and "CartesianProduct" not in text
