"""Match-event log rows made from the ``events`` test table (FIXTURES.md, part B).

Some matches have one team, three, or events without a team; some events lack
the minute or have an xG that is missing, negative or NaN.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TOPIC = "match.events"
EVENTS_PER_MATCH = 100
KICK_OFF = "2024-01-01 00:00:00"

POSITION = f"event_id % {EVENTS_PER_MATCH} AS pos"
EVENT_NUMBER = "CAST(get_json_object(props, '$.k') AS INT) AS k"

POSSESSION = "CASE WHEN k = 99 THEN NULL WHEN k % 2 = 0 THEN 'Home' ELSE 'Away' END AS possession"

TEAM = """CASE WHEN match_id % 10 = 3 AND user_id % 7 = 1 THEN 3
            WHEN match_id % 10 = 4 AND user_id % 7 = 1 THEN 0
            WHEN match_id % 10 = 5 OR user_id % 2 = 0 THEN 1 ELSE 2 END AS team"""
MATCH = f"event_id div {EVENTS_PER_MATCH} AS match_id"

DOCUMENT = """
  'id', concat('e', event_id),
  'index', CAST(pos + 1 AS INT),
  'period', CASE WHEN pos < 40 THEN 1 WHEN pos < 80 THEN 2 WHEN pos < 88 THEN 3
                 WHEN pos < 96 THEN 4 ELSE 5 END,
  'minute', CAST(CASE WHEN event_type = 'view' AND k = 50 THEN NULL
                      WHEN pos < 40 THEN pos * 48 div 40
                      WHEN pos < 80 THEN 45 + (pos - 40) * 50 div 40
                      WHEN pos < 88 THEN 90 + (pos - 80) * 2
                      WHEN pos < 96 THEN 105 + (pos - 88) * 2
                      ELSE 120 END AS INT),
  'second', CAST(user_id % 60 AS INT),
  'type', named_struct('name', CASE event_type
     WHEN 'view' THEN element_at(array('Pass', 'Dribble', 'Dribbled Past', 'Miscontrol'), k % 4 + 1)
     WHEN 'click' THEN 'Carry' WHEN 'signup' THEN 'Ball Receipt*'
     WHEN 'purchase' THEN 'Shot' WHEN 'error' THEN 'Foul Committed' END),
  'team', CASE team WHEN 1 THEN named_struct('id', 1, 'name', 'Home')
                    WHEN 2 THEN named_struct('id', 2, 'name', 'Away')
                    WHEN 3 THEN named_struct('id', 3, 'name', 'Third') END,
  'possession_team', CASE WHEN possession IS NOT NULL THEN named_struct('name', possession) END,
  'player', named_struct('id', CAST(user_id AS INT), 'name', concat('P', user_id)),
  'location', CASE WHEN event_type <> 'error'
     THEN array(k * CAST(1.2 AS DOUBLE), CAST(user_id % 81 AS DOUBLE)) END,
  'shot', CASE WHEN event_type = 'purchase' THEN named_struct(
     'statsbomb_xg', CASE k WHEN 13 THEN NULL WHEN 14 THEN CAST(-0.1 AS DOUBLE)
        WHEN 15 THEN CAST('NaN' AS DOUBLE)
        ELSE least(CAST(0.99 AS DOUBLE), value / CAST(500 AS DOUBLE)) END,
     'outcome', named_struct('name', CASE
        WHEN k < 12 THEN 'Goal' WHEN k < 40 THEN 'Saved' WHEN k < 60 THEN 'Off T'
        WHEN k < 75 THEN 'Blocked' WHEN k < 85 THEN 'Wayward' WHEN k < 90 THEN 'Post'
        ELSE 'Saved to Post' END)) END
"""

# Further fields of the documents. Some passes lack the object, some have an outcome without a name.
DETAILS = """,
  'possession', CASE WHEN k <> 98 THEN CAST(pos div 5 + 1 AS INT) END,
  'pass', CASE WHEN event_type = 'view' AND k % 4 = 0 AND user_id % 9 <> 0 THEN named_struct(
     'outcome', CASE WHEN user_id % 5 = 0 THEN named_struct('name', 'Incomplete')
                     WHEN user_id % 5 = 1 THEN named_struct('name', CAST(NULL AS STRING)) END,
     'shot_assist', CASE WHEN user_id % 4 = 0 THEN true WHEN user_id % 4 = 1 THEN false END)
     WHEN event_type = 'click' AND k % 4 = 0 THEN
     named_struct('outcome', CAST(NULL AS STRUCT<name: STRING>), 'shot_assist', false) END
"""


def source_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source table, spread over all cores if it comes in fewer splits than those."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    cores = spark.sparkContext.defaultParallelism
    if events.rdd.getNumPartitions() >= cores:
        return events
    return events.repartition(cores, "event_id")


def event_documents(spark: SparkSession, sf_dir: str, details: bool = False) -> DataFrame:
    """One JSON event document per source row: match_id, source_id, ts, log_key, payload."""
    document = DOCUMENT + DETAILS if details else DOCUMENT
    return (
        source_events(spark, sf_dir)
        .selectExpr("*", POSITION, EVENT_NUMBER, MATCH)
        .selectExpr("*", POSSESSION, TEAM)
        .selectExpr(
            "match_id",
            "event_id AS source_id",
            "CAST(ts AS TIMESTAMP) AS ts",
            "coalesce(possession, 'unknown') AS log_key",
            f"to_json(named_struct({document})) AS payload",
        )
    )


def parallel_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as if all matches kicked off together, one event a minute."""
    minute = f"make_dt_interval(0, 0, CAST(source_id % {EVENTS_PER_MATCH} AS INT))"
    kick_off = F.expr(f"TIMESTAMP '{KICK_OFF}' + {minute}")
    return event_documents(spark, sf_dir).withColumn("ts", kick_off)


def staggered_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as if matches kicked off one after the other on seven pitches, an event a minute.

    Some matches pause after half of their events, for ten minutes or for two hours.
    """
    position = f"source_id % {EVENTS_PER_MATCH}"
    pause = f"CASE WHEN {position} < 50 THEN 0 WHEN match_id % 10 = 7 THEN 10 WHEN match_id % 10 = 8 THEN 120 ELSE 0 END"
    minutes = f"CAST(match_id div 7 * 40 + {position} + {pause} AS INT)"
    start = F.expr(f"TIMESTAMP '{KICK_OFF}' + make_dt_interval(0, 0, {minutes})")
    return event_documents(spark, sf_dir).withColumn("ts", start)


def event_log(documents: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Log rows with some values cut short and some messages sent twice."""
    copies = "explode(CASE WHEN source_id % 7 = 0 THEN array(0, 1) ELSE array(0) END) AS copy"
    value = "CASE WHEN source_id % 97 = 0 THEN substring(payload, 1, 20) ELSE payload END"
    return documents.selectExpr("*", copies).selectExpr(
        "CAST(log_key AS BINARY) AS key",
        f"CAST({value} AS BINARY) AS value",
        f"'{TOPIC}' AS topic",
        "CAST(match_id % 4 AS INT) AS partition",
        "source_id * 2 + copy AS offset",
        "ts + make_dt_interval(0, 0, 0, copy * 30) AS timestamp",
        "match_id",
        *carry,
    )
