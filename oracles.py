"""DuckDB SQL for the queries, written from the source table ``events``.

Duplicates disappear in Silver and cut-off values never reach it, so the SQL
starts from one row per source event.
"""

EVENTS = """
src AS (
  SELECT event_id AS eid, event_id // 100 AS match_id, event_id // 100 AS own_match, event_id % 100 AS pos,
         CAST(regexp_extract(props, ':\\s*([0-9]+)', 1) AS INTEGER) AS k,
         ts, user_id, event_type AS kind, value
  FROM events
),
ev AS (
  SELECT eid, match_id, ts, k, 'e' || eid AS event_id, CAST(pos + 1 AS INTEGER) AS event_index,
         CASE WHEN pos < 40 THEN 1 WHEN pos < 80 THEN 2 WHEN pos < 88 THEN 3
              WHEN pos < 96 THEN 4 ELSE 5 END AS period,
         CAST(CASE WHEN kind = 'view' AND k = 50 THEN NULL WHEN pos < 40 THEN pos * 48 // 40
                   WHEN pos < 80 THEN 45 + (pos - 40) * 50 // 40
                   WHEN pos < 88 THEN 90 + (pos - 80) * 2
                   WHEN pos < 96 THEN 105 + (pos - 88) * 2 ELSE 120 END AS INTEGER) AS minute,
         CAST(user_id % 60 AS INTEGER) AS second,
         CASE kind WHEN 'view' THEN ['Pass', 'Dribble', 'Dribbled Past', 'Miscontrol'][k % 4 + 1]
                   WHEN 'click' THEN 'Carry'
                   WHEN 'signup' THEN 'Ball Receipt*' WHEN 'purchase' THEN 'Shot'
                   WHEN 'error' THEN 'Foul Committed' END AS event_type,
         CASE WHEN own_match % 10 = 3 AND user_id % 7 = 1 THEN 3
              WHEN own_match % 10 = 4 AND user_id % 7 = 1 THEN NULL
              WHEN own_match % 10 = 5 OR user_id % 2 = 0 THEN 1 ELSE 2 END AS team_id,
         ['Home', 'Away', 'Third'][team_id] AS team_name,
         CASE WHEN k = 99 THEN 'unknown' WHEN k % 2 = 0 THEN 'Home' ELSE 'Away' END AS log_key,
         CAST(user_id AS INTEGER) AS player_id, 'P' || user_id AS player_name,
         CASE WHEN kind <> 'error' THEN k * CAST(1.2 AS DOUBLE) END AS loc_x,
         CASE WHEN kind <> 'error' THEN CAST(user_id % 81 AS DOUBLE) END AS loc_y,
         CASE WHEN kind = 'purchase' THEN
           CASE k WHEN 13 THEN NULL WHEN 14 THEN CAST(-0.1 AS DOUBLE) WHEN 15 THEN CAST('NaN' AS DOUBLE)
                  ELSE least(CAST(0.99 AS DOUBLE), value / CAST(500 AS DOUBLE)) END END AS raw_xg,
         CASE WHEN raw_xg IS NULL OR isnan(raw_xg) THEN CAST(0 AS DOUBLE) ELSE raw_xg END AS xg,
         CASE WHEN kind = 'purchase' THEN
           CASE WHEN k < 12 THEN 'Goal' WHEN k < 40 THEN 'Saved' WHEN k < 60 THEN 'Off T'
                WHEN k < 75 THEN 'Blocked' WHEN k < 85 THEN 'Wayward' WHEN k < 90 THEN 'Post'
                ELSE 'Saved to Post' END END AS shot_outcome
  FROM src
),
log AS (
  SELECT e.*, c.copy, e.eid * 2 + c.copy AS "offset",
         e.ts + to_seconds(30 * c.copy) AS "timestamp", CAST(e.match_id % 4 AS INTEGER) AS part
  FROM ev e JOIN (SELECT unnest([0, 1]) AS copy) c ON c.copy = 0 OR e.eid % 7 = 0
),
silver AS (
  SELECT match_id, event_id, event_index, period, minute, second,
         CAST(minute * 60 + second AS INTEGER) AS match_second, event_type, team_id, team_name,
         player_id, player_name, loc_x, loc_y, xg, shot_outcome, ts AS event_time
  FROM ev WHERE eid % 97 <> 0 AND period <= 4
),
shots AS (
  SELECT match_id, event_id, team_name, player_name, minute, match_second, loc_x, loc_y, xg,
         shot_outcome
  FROM silver WHERE event_type = 'Shot'
),
xg_timeline AS (
  SELECT match_id, team_name, minute, sum(xg) AS xg_total, count(*) AS shots_total
  FROM silver WHERE xg > 0 GROUP BY ALL
),
totals AS (
  SELECT match_id, team_name,
         CAST(sum(CASE WHEN shot_outcome = 'Goal' THEN 1 ELSE 0 END) AS BIGINT) AS goals,
         sum(xg) AS xg_total, max(minute) AS latest_minute
  FROM silver GROUP BY ALL
),
pairs AS (
  SELECT match_id, count(*) AS n, min(team_name) AS t1, max(team_name) AS t2,
         greatest(0, 90 - max(latest_minute)) AS left_over
  FROM totals GROUP BY match_id
),
chances AS (
  SELECT p.match_id, p.t1, p.t2,
         round(1 / (1 + exp(-(
           (1.5::DOUBLE + 2::DOUBLE * (1 - p.left_over / 90::DOUBLE)) * (a.goals - b.goals)
           + 0.6::DOUBLE * (p.left_over / 90::DOUBLE) * (a.xg_total - b.xg_total)))), 4) AS p1
  FROM pairs p
  JOIN totals a ON a.match_id = p.match_id AND a.team_name = p.t1
  JOIN totals b ON b.match_id = p.match_id AND b.team_name = p.t2
  WHERE p.n = 2
),
match_state AS (
  SELECT t.match_id, t.team_name, t.goals, t.xg_total, t.latest_minute,
         CASE WHEN c.p1 IS NULL THEN 0.5::DOUBLE
              WHEN t.team_name = c.t1 THEN c.p1 ELSE round(1 - c.p1, 4) END AS win_probability
  FROM totals t LEFT JOIN chances c ON c.match_id = t.match_id
),
named AS (
  SELECT *, row_number() OVER (PARTITION BY match_id ORDER BY team_name) AS place
  FROM match_state WHERE team_name IS NOT NULL
),
ends AS (
  SELECT match_id, max(match_second) AS window_end_second,
         greatest(0, max(match_second) - 300) AS window_start_second
  FROM silver GROUP BY match_id
),
actions AS (
  SELECT s.match_id, s.team_name, count(*) AS attacking_actions,
         e.window_start_second, e.window_end_second
  FROM silver s JOIN ends e ON e.match_id = s.match_id
   AND s.match_second BETWEEN e.window_start_second AND e.window_end_second
  WHERE s.event_type IN ('Shot', 'Dribble', 'Carry', 'Pass', 'Ball Receipt*', 'Dribbled Past',
                         'Miscontrol')
  GROUP BY ALL
),
momentum AS (
  SELECT match_id, team_name, attacking_actions,
         round(attacking_actions / CAST(sum(attacking_actions) OVER (PARTITION BY match_id)
               AS DOUBLE), 3) AS dominance_pct,
         window_start_second, window_end_second
  FROM actions
)
"""

SILVER_COLUMNS = """match_id, event_id, event_index, period, minute, second, match_second,
  event_type, team_id, team_name, player_id, player_name, loc_x, loc_y, xg, shot_outcome"""

# The documents as text. Small numbers are written as 1.4E-4 there, 0.00014 or 1.4e-04 here.
DOCUMENTS = """,
numbers AS (
  SELECT eid, CAST(xg AS VARCHAR) AS t, ltrim(substr(CAST(xg AS VARCHAR), 3), '0') AS digits FROM ev
),
documents AS (
  SELECT e.eid,
    '{"id":"' || event_id || '","index":' || event_index || ',"period":' || period
    || CASE WHEN minute IS NULL THEN '' ELSE ',"minute":' || minute END || ',"second":' || second
    || ',"type":{"name":"' || event_type || '"}'
    || CASE WHEN team_id IS NULL THEN '' ELSE ',"team":{"id":' || team_id || ',"name":"' || team_name || '"}' END
    || CASE WHEN log_key = 'unknown' THEN ''
            ELSE ',"possession_team":{"name":"' || log_key || '"}' END
    || ',"player":{"id":' || player_id || ',"name":"' || player_name || '"}'
    || CASE WHEN loc_x IS NULL THEN '' ELSE ',"location":[' || loc_x || ',' || loc_y || ']' END
    || CASE WHEN shot_outcome IS NULL THEN ''
            WHEN raw_xg IS NULL THEN ',"shot":{"outcome":{"name":"' || shot_outcome || '"}}'
            ELSE ',"shot":{"statsbomb_xg":' ||
              CASE WHEN isnan(raw_xg) THEN '"NaN"' WHEN xg <= 0 OR xg >= 0.001 THEN t
                   WHEN contains(t, 'e') THEN
                     CASE WHEN contains(t, '.') THEN split_part(t, 'e', 1)
                          ELSE split_part(t, 'e', 1) || '.0' END
                     || 'E' || CAST(split_part(t, 'e', 2) AS INTEGER)
                   ELSE left(digits, 1) || '.'
                     || CASE WHEN length(digits) > 1 THEN substr(digits, 2) ELSE '0' END
                     || 'E-' || (length(t) - 1 - length(digits)) END
              || ',"outcome":{"name":"' || shot_outcome || '"}}' END
    || '}' AS payload
  FROM ev e JOIN numbers n ON n.eid = e.eid
)
"""


def _with(select: str, more: str = "") -> str:
    return f"WITH {EVENTS}{more}\n{select}"


XG_TIMELINE = _with(
    "SELECT match_id, team_name, minute, round(xg_total, 6) AS xg_total, shots_total FROM xg_timeline"
)
MATCH_STATE = _with(
    """SELECT match_id, team_name, goals, round(xg_total, 6) AS xg_total, latest_minute,
  win_probability FROM match_state"""
)
MOMENTUM = _with("SELECT * FROM momentum")
SILVER = _with(f"SELECT {SILVER_COLUMNS}, event_time FROM silver")
SHOTS = _with("SELECT * FROM shots")

# Replay runs over the source documents, before the log repeats or cuts any.
CLOCKED = """,
clocked AS (
  SELECT match_id, event_index, event_id, coalesce(minute, 0) AS minute,
         CAST(coalesce(minute, 0) * 60 + second AS INTEGER) AS match_second,
         lag(coalesce(minute, 0) * 60 + second) OVER (PARTITION BY match_id ORDER BY event_index, event_id) AS previous
  FROM ev
),
waits AS (
  SELECT *, CASE WHEN previous IS NULL THEN 0::DOUBLE
    ELSE least(greatest(0, match_second - previous) / 60::DOUBLE, 3::DOUBLE) END AS delay_s
  FROM clocked
)
"""

RUNNING = """,
led AS (
  SELECT *, CASE WHEN team_name = team1 THEN 1 ELSE -1 END AS side
  FROM (SELECT *, min(team_name) OVER (PARTITION BY match_id) AS team1
        FROM silver WHERE event_type = 'Shot')
),
running AS (
  SELECT match_id, event_index, team1, greatest(0, 90 - minute) AS minutes_remaining,
    CAST(sum(CASE WHEN shot_outcome = 'Goal' THEN side ELSE 0 END) OVER w AS BIGINT) AS goal_diff,
    sum(side * xg) OVER w AS xg_diff
  FROM led
  WINDOW w AS (PARTITION BY match_id ORDER BY event_index, event_id ROWS UNBOUNDED PRECEDING)
)
"""

# Momentum at several cut-offs; the last cut-off at which a team has a row wins.
CUT_MOMENTUM = """,
cut_ends AS (
  SELECT cut, match_id, max(match_second) AS e, greatest(0, max(match_second) - 300) AS b
  FROM seen GROUP BY ALL
),
cut_actions AS (
  SELECT s.cut, s.match_id, s.team_name, count(*) AS n, x.b, x.e
  FROM seen s JOIN cut_ends x ON x.cut = s.cut AND x.match_id = s.match_id
   AND s.match_second BETWEEN x.b AND x.e
  WHERE s.event_type IN ('Shot', 'Dribble', 'Carry', 'Pass', 'Ball Receipt*', 'Dribbled Past',
                         'Miscontrol') GROUP BY ALL
),
cut_momentum AS (
  SELECT *, round(n / CAST(sum(n) OVER (PARTITION BY cut, match_id) AS DOUBLE), 3) AS share,
         row_number() OVER (PARTITION BY match_id, team_name ORDER BY cut DESC) AS age
  FROM cut_actions
)
"""

KPI_ROW = """SELECT a.match_id, a.team_name AS team1, a.goals AS goals1,
  CAST(round(CAST(a.xg_total AS DECIMAL(18,6)), 2) AS DOUBLE) AS xg1,
  coalesce(b.team_name, '?') AS team2, coalesce(b.goals, 0) AS goals2,
  CAST(round(CAST(coalesce(b.xg_total, 0) AS DECIMAL(18,6)), 2) AS DOUBLE) AS xg2,
  CAST(round(CAST(a.win_probability AS DECIMAL(9,4)) * 100, 1) AS DOUBLE) AS p1_pct,
  CAST(100 - round(CAST(a.win_probability AS DECIMAL(9,4)) * 100, 1) AS DOUBLE) AS p2_pct,
  CAST(trunc(coalesce(m.dominance_pct, 0.5::DOUBLE) * 100) AS INTEGER) AS dom1_pct,
  CAST(trunc((1 - coalesce(m.dominance_pct, 0.5::DOUBLE)) * 100) AS INTEGER) AS dom2_pct
FROM named a
LEFT JOIN named b ON b.match_id = a.match_id AND b.place = 2
LEFT JOIN {momentum} m ON m.match_id = a.match_id AND m.team_name = a.team_name
WHERE a.place = 1"""

NEWEST_MOMENTUM = """SELECT match_id, team_name, n AS attacking_actions, share AS dominance_pct,
  b AS window_start_second, e AS window_end_second
FROM cut_momentum WHERE age = 1"""

BY_PERIOD = """,
seen AS (
  SELECT s.*, cut FROM silver s JOIN (SELECT unnest([1, 2, 3, 4]) AS cut) ON s.period <= cut
)"""

# The streams get each match in three slices.
BY_SLICE = """,
seen AS (
  SELECT s.*, cut FROM silver s
  JOIN (SELECT unnest([0, 1, 2]) AS cut) ON (s.event_index - 1) * 3 // 100 <= cut
)"""

# Seconds since kick-off at which the parallel log brings an event, and the watermark at its end.
ARRIVALS = """,
arrivals AS (
  SELECT match_id, event_id, (eid % 100) * 60 AS first_at,
         (eid % 100) * 60 + CASE WHEN eid % 7 = 0 THEN 30 ELSE 0 END AS last_at
  FROM ev WHERE eid % 97 <> 0 AND period <= 4
)"""

# The slices of the source's time span that the log arrives in.
TIME_SLICES = """,
span AS (SELECT min(epoch_us(ts)) AS first, max(epoch_us(ts)) AS last FROM ev),
sliced AS (
  SELECT eid, event_id, CAST((epoch_us(ts) - first) // ((last - first) // 3 + 1) AS INTEGER) AS slice
  FROM ev, span
)"""

# Passes and possessions of the detailed documents; a possession is five events of a match.
DETAILED = """,
detailed AS (
  SELECT s.*, eid, event_type = 'Pass' AND player_id % 9 <> 0 AS is_pass,
    CASE WHEN player_id % 5 = 0 THEN 'Incomplete' END AS pass_outcome,
    event_type = 'Pass' AND player_id % 9 <> 0 AND player_id % 4 = 0 AS is_key_pass,
    CASE WHEN k <> 98 THEN (eid % 100) // 5 + 1 END AS possession
  FROM silver s JOIN (SELECT eid, k, event_id FROM ev) e USING (event_id)
)"""

# Chances per second, and box entries: inside, with the placed event before in the team's possession outside.
CHANCES_MADE = DETAILED + """,
placed AS (
  SELECT *, loc_x >= 102 AND loc_y BETWEEN 18 AND 62 AS inside,
    lag(loc_x >= 102 AND loc_y BETWEEN 18 AND 62) OVER (
      PARTITION BY match_id, possession, team_name ORDER BY event_index, event_id) AS was_inside
  FROM detailed WHERE possession IS NOT NULL AND loc_x IS NOT NULL AND loc_y IS NOT NULL
),
made AS (
  SELECT match_id, team_name, match_second, count(*) FILTER (event_type = 'Shot') AS shots,
    sum(greatest(0::DOUBLE, xg)) AS xg_total, count(*) FILTER (is_key_pass) AS key_passes, 0 AS box_entries
  FROM detailed GROUP BY ALL
  UNION ALL
  SELECT match_id, team_name, match_second, 0, 0, 0, count(*) FROM placed WHERE inside AND NOT was_inside GROUP BY ALL
),
per_second AS (
  SELECT match_id, team_name, match_second, sum(shots) AS shots, sum(xg_total) AS xg_total,
    sum(key_passes) AS key_passes, sum(box_entries) AS box_entries
  FROM made WHERE match_second IS NOT NULL GROUP BY ALL
)"""

WEIGHTED = "1 * shots + 4 * xg_total + 0.5::DOUBLE * key_passes + 0.25::DOUBLE * box_entries"

PLAYER_TOTALS = """,
player_totals AS (
  SELECT match_id, team_name, player_id, max(player_name) AS player_name,
    count(*) FILTER (event_type = 'Shot') AS shots,
    count(*) FILTER (event_type = 'Shot' AND shot_outcome = 'Goal') AS goals,
    count(*) FILTER (event_type = 'Pass') AS passes,
    count(*) FILTER (loc_x IS NOT NULL AND loc_y IS NOT NULL AND event_type IN
      ('Shot', 'Dribble', 'Carry', 'Pass', 'Ball Receipt*', 'Miscontrol')) AS touches,
    sum(greatest(0::DOUBLE, xg)) AS xg_total
  FROM silver GROUP BY match_id, team_name, player_id
)"""

# Matches that start one after the other; sittings are cut where half an hour passes without an event.
SITTINGS = """,
staggered AS (
  SELECT s.match_id, s.team_name, s.shot_outcome, e.eid,
    TIMESTAMP '2024-01-01' + to_minutes(CAST(s.match_id // 7 * 40 + e.eid % 100 + CASE WHEN e.eid % 100 < 50 THEN 0
      WHEN s.match_id % 10 = 7 THEN 10 WHEN s.match_id % 10 = 8 THEN 120 ELSE 0 END AS INTEGER)) AS seen_at
  FROM silver s JOIN (SELECT eid, event_id FROM ev) e USING (event_id)
),
cut_times AS (
  SELECT match_id, seen_at, CASE WHEN seen_at - lag(seen_at) OVER w < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh
  FROM staggered WINDOW w AS (PARTITION BY match_id ORDER BY seen_at)
),
sittings AS (
  SELECT match_id, min(seen_at) AS b, max(seen_at) AS e
  FROM (SELECT *, sum(fresh) OVER (PARTITION BY match_id ORDER BY seen_at) AS n FROM cut_times) GROUP BY match_id, n
),
closed AS (
  SELECT match_id, count(*) AS n, max(e) AS e FROM sittings
  WHERE e + INTERVAL 30 MINUTE <= (SELECT max(seen_at) - INTERVAL 10 MINUTE FROM staggered) GROUP BY match_id
),
named_teams AS (
  SELECT *, row_number() OVER (PARTITION BY match_id ORDER BY team_name) AS place
  FROM (SELECT match_id, team_name, count(*) FILTER (shot_outcome = 'Goal') AS goals
        FROM staggered WHERE team_name IS NOT NULL GROUP BY ALL)
)"""

ORACLES: dict[str, str] = {
    "bronze_envelope": _with(
        """SELECT match_id, log_key AS kafka_key,
  CASE WHEN l.eid % 97 = 0 THEN left(payload, 20) ELSE payload END AS event_json,
  'match.events' AS topic, part AS partition, "offset", "timestamp" AS kafka_timestamp
FROM log l JOIN documents d ON d.eid = l.eid""",
        DOCUMENTS,
    ),
    "silver_events": SILVER,
    "dedup_events": _with(
        """SELECT match_id, event_id, CAST(2 AS BIGINT) AS copies, ts AS kept_time
FROM ev WHERE eid % 7 = 0 AND eid % 97 <> 0 AND period <= 4"""
    ),
    "malformed_rows": _with(
        """SELECT match_id, 'match.events' AS topic, part AS partition, "offset",
  left(payload, 20) AS event_json
FROM log l JOIN documents d ON d.eid = l.eid WHERE l.eid % 97 = 0""",
        DOCUMENTS,
    ),
    "shootout_excluded": _with(
        """SELECT match_id, count(*) AS events,
  CAST(sum(CASE WHEN event_type = 'Shot' THEN 1 ELSE 0 END) AS BIGINT) AS shots
FROM ev WHERE eid % 97 <> 0 AND period > 4 GROUP BY match_id"""
    ),
    "shots": SHOTS,
    "xg_timeline": XG_TIMELINE,
    "xg_race": _with(
        """SELECT match_id, team_name, minute, round(xg_total, 6) AS xg_total,
  round(sum(xg_total) OVER (PARTITION BY match_id, team_name ORDER BY minute
        ROWS UNBOUNDED PRECEDING), 6) AS xg_cumulative
FROM (SELECT *, dense_rank() OVER (PARTITION BY match_id ORDER BY team_name) AS pos
      FROM xg_timeline WHERE team_name IS NOT NULL)
WHERE pos <= 2"""
    ),
    "match_state": MATCH_STATE,
    "momentum": MOMENTUM,
    "momentum_series": _with(
        """SELECT match_id, team_name, match_second, event_index,
  CAST(sum(CASE WHEN event_type IN ('Shot', 'Dribble', 'Carry', 'Pass', 'Ball Receipt*',
                'Dribbled Past', 'Miscontrol') THEN 1 ELSE 0 END)
    OVER (PARTITION BY match_id, team_name ORDER BY match_second
          RANGE BETWEEN 300 PRECEDING AND CURRENT ROW) AS BIGINT) AS attacking_300s
FROM silver WHERE match_second IS NOT NULL"""
    ),
    "win_probability": _with(
        """SELECT match_id, event_index, team1, goal_diff, round(xg_diff, 6) AS xg_diff,
  minutes_remaining,
  round(1 / (1 + exp(-(
    (1.5::DOUBLE + 2::DOUBLE * (1 - least(90, minutes_remaining) / 90::DOUBLE)) * goal_diff
    + 0.6::DOUBLE * (least(90, minutes_remaining) / 90::DOUBLE) * xg_diff))), 4) AS p_team1
FROM running""",
        RUNNING,
    ),
    "pass_completion": _with(
        """SELECT match_id, team_name, match_second, attempted, completed,
  CASE WHEN attempted > 0 THEN round(completed / CAST(attempted AS DOUBLE), 3) END AS completion_pct
FROM (SELECT match_id, team_name, match_second, CAST(sum(a) OVER w AS BIGINT) AS attempted,
        CAST(sum(c) OVER w AS BIGINT) AS completed
      FROM (SELECT match_id, team_name, match_second, count(*) FILTER (is_pass) AS a,
              count(*) FILTER (is_pass AND pass_outcome IS NULL) AS c
            FROM detailed WHERE match_second IS NOT NULL GROUP BY ALL)
      WINDOW w AS (PARTITION BY match_id, team_name ORDER BY match_second
                   RANGE BETWEEN 300 PRECEDING AND CURRENT ROW))""",
        DETAILED,
    ),
    "weighted_momentum": _with(
        f"""SELECT match_id, team_name, CAST(shots AS BIGINT) AS shots, round(xg_total, 6) AS xg_total,
  CAST(key_passes AS BIGINT) AS key_passes, CAST(box_entries AS BIGINT) AS box_entries,
  CAST(greatest(0, newest - 300) AS INTEGER) AS window_start_second, newest AS window_end_second,
  round({WEIGHTED}, 6) AS weighted,
  CASE WHEN sum({WEIGHTED}) OVER (PARTITION BY match_id) <> 0
       THEN round(({WEIGHTED}) / sum({WEIGHTED}) OVER (PARTITION BY match_id), 3) END AS weighted_share
FROM (SELECT match_id, team_name, newest, coalesce(sum(shots) FILTER (match_second >= newest - 300), 0) AS shots,
        coalesce(sum(xg_total) FILTER (match_second >= newest - 300), 0) AS xg_total,
        coalesce(sum(key_passes) FILTER (match_second >= newest - 300), 0) AS key_passes,
        coalesce(sum(box_entries) FILTER (match_second >= newest - 300), 0) AS box_entries
      FROM (SELECT *, max(match_second) OVER (PARTITION BY match_id) AS newest FROM per_second) GROUP BY ALL)""",
        CHANCES_MADE,
    ),
    "weighted_momentum_series": _with(
        f"""SELECT match_id, team_name, match_second, CAST(shots AS BIGINT) AS shots, round(xg_total, 6) AS xg_total,
  CAST(key_passes AS BIGINT) AS key_passes, CAST(box_entries AS BIGINT) AS box_entries,
  round({WEIGHTED}, 6) AS weighted
FROM (SELECT match_id, team_name, match_second, sum(shots) OVER w AS shots, sum(xg_total) OVER w AS xg_total,
        sum(key_passes) OVER w AS key_passes, sum(box_entries) OVER w AS box_entries
      FROM per_second WINDOW w AS (PARTITION BY match_id, team_name ORDER BY match_second
                                   RANGE BETWEEN 300 PRECEDING AND CURRENT ROW))""",
        CHANCES_MADE,
    ),
    "player_spotlight": _with(
        """SELECT CASE grouping(team_name) + grouping(player_id) WHEN 0 THEN 'player' WHEN 1 THEN 'team' ELSE 'match' END
    AS level, match_id, team_name, player_id,
  CASE WHEN grouping(player_id) = 0 THEN max(player_name) END AS player_name,
  CAST(sum(shots) AS BIGINT) AS shots, CAST(sum(goals) AS BIGINT) AS goals, CAST(sum(passes) AS BIGINT) AS passes,
  CAST(sum(touches) AS BIGINT) AS touches, round(sum(xg_total), 6) AS xg_total
FROM player_totals
GROUP BY GROUPING SETS ((match_id, team_name, player_id), (match_id, team_name), (match_id))""",
        PLAYER_TOTALS,
    ),
    "player_top": _with(
        """SELECT match_id, CAST(place AS INTEGER) AS rank, team_name, player_id, player_name, shots, goals, passes,
  touches, round(xg_total, 6) AS xg_total
FROM (SELECT *, row_number() OVER (PARTITION BY match_id ORDER BY round(xg_total, 6) DESC, goals DESC, shots DESC,
        touches DESC, player_id, team_name NULLS FIRST) AS place
      FROM player_totals WHERE player_id IS NOT NULL)
WHERE place <= 5""",
        PLAYER_TOTALS,
    ),
    "match_catalogue": _with(
        """SELECT m.match_id, coalesce(a.team_name, '?') AS team1, coalesce(b.team_name, '?') AS team2,
  coalesce(a.goals, 0) AS goals1, coalesce(b.goals, 0) AS goals2, m.events, first_event, last_event,
  coalesce(c.n, 0) AS closed_sittings, CASE WHEN c.e >= last_event THEN 'finished' ELSE 'live' END AS status
FROM (SELECT match_id, count(*) AS events, min(seen_at) AS first_event, max(seen_at) AS last_event
      FROM staggered GROUP BY match_id) m
LEFT JOIN named_teams a ON a.match_id = m.match_id AND a.place = 1
LEFT JOIN named_teams b ON b.match_id = m.match_id AND b.place = 2
LEFT JOIN closed c ON c.match_id = m.match_id""",
        SITTINGS,
    ),
    "match_clock": _with(
        """SELECT match_id, event_id, match_second,
  CAST(coalesce(minute, 0) * 60 + second AS INTEGER) AS clock_or_zero FROM silver"""
    ),
    "minute_label": _with(
        """SELECT match_id, event_id, period, minute,
  CASE WHEN minute > base THEN base || '+' || (minute - base) ELSE CAST(minute AS VARCHAR) END
    AS label
FROM (SELECT *, CASE period WHEN 1 THEN 45 WHEN 2 THEN 90 WHEN 3 THEN 90 ELSE 105 END AS base
      FROM silver)"""
    ),
    "event_flags": _with(
        """SELECT match_id, event_id, event_type = 'Shot' AS is_shot,
  event_type = 'Shot' AND shot_outcome = 'Goal' AS is_goal,
  event_type IN ('Shot', 'Dribble', 'Carry', 'Pass', 'Ball Receipt*', 'Dribbled Past',
                 'Miscontrol') AS is_attacking
FROM silver"""
    ),
    "safe_xg": _with(
        """SELECT match_id, event_id, raw_xg AS xg, greatest(0::DOUBLE, xg) AS safe_xg FROM ev"""
    ),
    "kpi_row": _with(KPI_ROW.format(momentum="momentum")),
    "shot_map": _with(
        """SELECT s.match_id, event_id, s.team_name, player_name, loc_x, loc_y, xg,
  shot_outcome AS outcome, round(xg * 60 + 6, 6) AS marker_size,
  s.team_name || ' — ' || shot_outcome AS label,
  CASE shot_outcome WHEN 'Goal' THEN 'gold' WHEN 'Saved' THEN 'dodgerblue'
    WHEN 'Off T' THEN 'tomato' WHEN 'Blocked' THEN 'orange' WHEN 'Wayward' THEN 'grey'
    ELSE 'orchid' END AS colour,
  CASE pos WHEN 1 THEN '#75aadb' ELSE '#ffffff' END AS team_colour
FROM shots s
JOIN (SELECT match_id, team_name, row_number() OVER (PARTITION BY match_id ORDER BY team_name) AS pos
      FROM (SELECT DISTINCT match_id, team_name FROM shots WHERE team_name IS NOT NULL)) t
  ON t.match_id = s.match_id AND t.team_name = s.team_name AND pos <= 2
WHERE shot_outcome IN ('Goal', 'Saved', 'Off T', 'Blocked', 'Wayward', 'Post')"""
    ),
    "shot_zones": _with(
        """SELECT match_id,
  CASE WHEN loc_x IS NULL OR loc_y IS NULL THEN 'unknown'
       WHEN loc_x >= 114 AND loc_y BETWEEN 30 AND 50 THEN 'six_yard'
       WHEN loc_x >= 102 AND loc_y BETWEEN 18 AND 62 THEN 'box'
       WHEN loc_x >= 60 THEN 'attacking_half' ELSE 'own_half' END AS zone,
  count(*) AS shots,
  CAST(sum(CASE WHEN shot_outcome = 'Goal' THEN 1 ELSE 0 END) AS BIGINT) AS goals,
  round(sum(xg), 6) AS xg_total
FROM shots GROUP BY ALL"""
    ),
    "event_log": _with(
        """SELECT match_id, CAST(r AS INTEGER) AS rank, minute, second, team_name, player_name,
  event_type, xg
FROM (SELECT *, row_number() OVER (PARTITION BY match_id
        ORDER BY match_second DESC, event_index DESC, event_id DESC) AS r FROM silver)
WHERE r <= 20"""
    ),
    "team_list": _with(
        """SELECT match_id, string_agg(team_name, ', ' ORDER BY team_name) AS teams,
  count(*) AS team_count
FROM (SELECT DISTINCT match_id, team_name FROM xg_timeline WHERE team_name IS NOT NULL) GROUP BY match_id"""
    ),
    "table_head": _with(
        f"""SELECT {SILVER_COLUMNS}, event_time FROM silver
ORDER BY event_index, event_id, match_id LIMIT 10"""
    ),
    "table_summary": _with(
        """SELECT 'bronze' AS table_name, count(*) AS row_count,
  count(DISTINCT match_id) AS distinct_matches FROM log
UNION ALL SELECT 'silver', count(*), count(DISTINCT match_id) FROM silver
UNION ALL SELECT 'shots', count(*), count(DISTINCT match_id) FROM shots"""
    ),
    "replay_schedule": _with(
        """SELECT match_id, event_index, match_second, round(delay_s, 6) AS delay_s,
  round(sum(delay_s) OVER (PARTITION BY match_id ORDER BY event_index, event_id
        ROWS UNBOUNDED PRECEDING), 6) AS emit_at_s
FROM waits""",
        CLOCKED,
    ),
    "replay_progress": _with(
        """SELECT match_id, emitted, minute
FROM (SELECT *, row_number() OVER (PARTITION BY match_id ORDER BY event_index, event_id) AS emitted
      FROM clocked)
WHERE emitted % 25 = 0""",
        CLOCKED,
    ),
    "publish_log_rows": _with(
        """SELECT match_id, log_key AS key, payload AS value
FROM ev e JOIN documents d ON d.eid = e.eid""",
        DOCUMENTS,
    ),
    "backfill_match_files": _with(
        """SELECT match_id, count(*) AS events, max(event_index) AS max_index
FROM ev GROUP BY match_id"""
    ),
    "backfill_by_ranges": _with(
        """SELECT match_id, count(*) AS events, max(event_index) AS max_index
FROM ev GROUP BY match_id"""
    ),
    "backfill_silver": _with(
        f"""SELECT {SILVER_COLUMNS}
FROM (SELECT *, CAST(minute * 60 + second AS INTEGER) AS match_second FROM ev)
WHERE period <= 4"""
    ),
    "tolerant_scan": SILVER,
    "merge_additive": XG_TIMELINE,
    "upsert_latest_by_key": _with(
        NEWEST_MOMENTUM, BY_PERIOD + CUT_MOMENTUM
    ),
    "stream_silver": SILVER,
    "stream_shots": SHOTS,
    "stream_xg_timeline": XG_TIMELINE,
    "stream_match_state": MATCH_STATE,
    "stream_momentum": _with(NEWEST_MOMENTUM, BY_SLICE + CUT_MOMENTUM),
    "stream_kpi_row": _with(
        KPI_ROW.format(momentum=f"({NEWEST_MOMENTUM})"), BY_SLICE + CUT_MOMENTUM
    ),
    "stream_late_rows": _with(
        """SELECT match_id, event_id FROM arrivals
UNION ALL
SELECT match_id, 'again-' || event_id FROM arrivals
WHERE first_at > (SELECT max(last_at) FROM arrivals) - 600""",
        ARRIVALS,
    ),
    # a row of the log that comes late is counted once; of resent rows there is one copy each
    "stream_dropped_rows": _with(
        """SELECT 'bronze' AS query_name, (SELECT count(*) FROM log) + (SELECT count(*) FROM ev) AS rows_in,
  0::BIGINT AS rows_late
UNION ALL
SELECT 'silver', (SELECT count(*) FROM log) + (SELECT count(*) FROM ev),
  (SELECT count(*) FROM arrivals WHERE first_at <= (SELECT max(last_at) FROM arrivals) - 600)""",
        ARRIVALS,
    ),
    "stream_state_rows": _with(
        """SELECT match_id, ids, minutes FROM (SELECT match_id, count(*) AS ids FROM silver GROUP BY match_id)
FULL JOIN (SELECT match_id, count(*) AS minutes FROM xg_timeline GROUP BY match_id) USING (match_id)"""
    ),
    "stream_restart": _with(f"SELECT {SILVER_COLUMNS} FROM silver"),
    "stream_processing_time": SILVER,
    "stream_replayed_match": SILVER,
    "stream_batch_metrics": _with(
        """SELECT 'bronze' AS table_name, slice, count(*) AS rows
FROM log l JOIN sliced s ON s.eid = l.eid GROUP BY slice
UNION ALL
SELECT 'silver', slice, count(*) FROM silver v JOIN sliced s ON s.event_id = v.event_id GROUP BY slice""",
        TIME_SLICES,
    ),
    "stream_table_versions": _with(
        """SELECT 'bronze' AS table_name, count(*) AS row_count,
  count(DISTINCT match_id) AS distinct_matches, CAST(2 AS BIGINT) AS version FROM log
UNION ALL SELECT 'shots', count(*), count(DISTINCT match_id), 2 FROM shots
UNION ALL SELECT 'xg_timeline', count(*), count(DISTINCT match_id), 2 FROM xg_timeline"""
    ),
}

ORACLES["stream_bronze"] = ORACLES["bronze_envelope"]
for _name in ("event_log", "player_spotlight", "match_catalogue"):
    ORACLES[f"stream_{_name}"] = ORACLES[_name]

# The same with every event in one match.
ORACLES |= {
    f"{name}_large_match": ORACLES[name].replace("event_id // 100 AS match_id", "CAST(0 AS BIGINT) AS match_id")
    for name in (
        "momentum_series", "win_probability", "shot_map", "replay_schedule", "replay_progress",
        "weighted_momentum_series",
    )
}
