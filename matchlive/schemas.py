"""Table schemas, as DDL text."""

# The field names and types of an event document.
EVENT = """
    id STRING,
    index INT,
    period INT,
    minute INT,
    second INT,
    type STRUCT<name: STRING>,
    team STRUCT<id: INT, name: STRING>,
    player STRUCT<id: INT, name: STRING>,
    location ARRAY<DOUBLE>,
    shot STRUCT<statsbomb_xg: DOUBLE, outcome: STRUCT<name: STRING>>
"""

# Further fields, read only for the tables that ask for a column made of them.
EVENT_DETAILS = """
    possession INT,
    pass STRUCT<outcome: STRUCT<name: STRING>, shot_assist: BOOLEAN>
"""

# The fields of the event document that the replay clock and the log need.
CLOCK_FIELDS = """
    id STRING,
    index INT,
    minute INT,
    second INT
"""
LOG_FIELDS = """
    index INT,
    possession_team STRUCT<name: STRING>
"""

LOG = """
    key BINARY,
    value BINARY,
    topic STRING,
    partition INT,
    offset BIGINT,
    timestamp TIMESTAMP,
    match_id BIGINT
"""

BRONZE = """
    match_id BIGINT,
    kafka_key STRING,
    event_json STRING,
    topic STRING,
    partition INT,
    offset BIGINT,
    kafka_timestamp TIMESTAMP
"""

SILVER = """
    match_id BIGINT,
    event_id STRING,
    event_index INT,
    period INT,
    minute INT,
    second INT,
    match_second INT,
    event_type STRING,
    team_id INT,
    team_name STRING,
    player_id INT,
    player_name STRING,
    loc_x DOUBLE,
    loc_y DOUBLE,
    xg DOUBLE,
    shot_outcome STRING,
    event_time TIMESTAMP
"""

# Columns that Silver can have besides, where they are asked for.
SILVER_DETAILS = """
    possession INT,
    is_pass BOOLEAN,
    pass_outcome STRING,
    is_key_pass BOOLEAN
"""

SHOTS = """
    match_id BIGINT,
    event_id STRING,
    team_name STRING,
    player_name STRING,
    minute INT,
    match_second INT,
    loc_x DOUBLE,
    loc_y DOUBLE,
    xg DOUBLE,
    shot_outcome STRING
"""

XG_TIMELINE = """
    match_id BIGINT,
    team_name STRING,
    minute INT,
    xg_total DOUBLE,
    shots_total BIGINT
"""

TEAM_TOTALS = """
    match_id BIGINT,
    team_name STRING,
    goals BIGINT,
    xg_total DOUBLE,
    latest_minute INT
"""

MOMENTUM = """
    match_id BIGINT,
    team_name STRING,
    attacking_actions BIGINT,
    dominance_pct DOUBLE,
    window_start_second INT,
    window_end_second INT
"""


PLAYER_TOTALS = """
    match_id BIGINT,
    team_name STRING,
    player_id INT,
    player_name STRING,
    shots BIGINT,
    goals BIGINT,
    passes BIGINT,
    touches BIGINT,
    xg_total DOUBLE
"""

TEAM_TIMES = """
    match_id BIGINT,
    team_name STRING,
    goals BIGINT,
    events BIGINT,
    first_event TIMESTAMP,
    last_event TIMESTAMP
"""

SITTINGS = """
    match_id BIGINT,
    sitting_start TIMESTAMP,
    sitting_end TIMESTAMP,
    events BIGINT
"""


def columns(ddl: str) -> list[str]:
    """Top-level column names of one of the schemas above."""
    lines = (line.strip() for line in ddl.strip().splitlines())
    return [line.split(" ", 1)[0] for line in lines if line]
