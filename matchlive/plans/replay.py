"""Replaying match files onto the log: order, waiting times, log rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlive.functions import clock_or_zero
from matchlive.operators.skew import ordered_pieces, previous_value, running_sum
from matchlive.schemas import CLOCK_FIELDS, LOG_FIELDS
from matchlive.sources.log import UNKNOWN_KEY

MATCH = ("match_id",)
SPEED = 60.0
LONGEST_WAIT = 3.0
PROGRESS_STEP = 200


def _clocked(documents: DataFrame) -> DataFrame:
    """Position and clock of each document, a missing number counting as 0."""
    parsed = F.inline(F.array(F.from_json("payload", CLOCK_FIELDS)))
    fields = documents.select(*MATCH, F.xxhash64("payload").alias("_hash"), parsed)
    return fields.select(
        *MATCH,
        F.col("id").alias("event_id"),
        F.coalesce("index", F.lit(0)).alias("event_index"),
        F.coalesce("minute", F.lit(0)).alias("minute"),
        clock_or_zero(F.col("minute"), F.col("second")).alias("match_second"),
        "_hash",
    )


def _order():
    """By index and id; a hash tells documents apart that lack both."""
    return [F.col("event_index"), F.col("event_id"), F.col("_hash")]


def replay_schedule(
    documents: DataFrame,
    speed: float = SPEED,
    longest_wait: float = LONGEST_WAIT,
    pieces: int | None = None,
) -> DataFrame:
    """Seconds to wait before each event and the time it is due since the replay's start."""
    rows = ordered_pieces(_clocked(documents), MATCH, _order(), pieces)
    rows = previous_value(rows, MATCH, _order(), "match_second", "_previous")
    gap = F.greatest(F.lit(0), F.col("match_second") - F.col("_previous")) / F.lit(float(speed))
    wait = F.when(F.col("_previous").isNull(), 0.0).otherwise(
        F.least(gap, F.lit(float(longest_wait)))
    )
    rows = running_sum(
        rows.withColumn("delay_s", wait), MATCH, _order(), {"emit_at_s": F.col("delay_s")}
    )
    return rows.select(*MATCH, "event_index", "match_second", "delay_s", "emit_at_s")


def replay_progress(
    documents: DataFrame, step: int = PROGRESS_STEP, pieces: int | None = None
) -> DataFrame:
    """Every ``step``-th event of a match in replay order, with its minute."""
    rows = ordered_pieces(_clocked(documents), MATCH, _order(), pieces)
    rows = running_sum(rows, MATCH, _order(), {"emitted": F.lit(1).cast("bigint")})
    return rows.filter(F.col("emitted") % step == 0).select(*MATCH, "emitted", "minute")


def in_match_order(documents: DataFrame) -> DataFrame:
    """Documents sorted by match and index, so that each task sends its share in order.

    A distributed sort: a large match is spread over several tasks, also where
    many documents lack an index, since the hash tells those apart. The tasks of
    one match write side by side, so a log partition gets each task's share in
    order but the shares in any order; one task at a time keeps the whole order.
    """
    index = F.from_json("payload", LOG_FIELDS)["index"]
    return documents.orderBy("match_id", F.coalesce(index, F.lit(0)), F.xxhash64("payload"))


def log_rows(documents: DataFrame) -> DataFrame:
    """Key and value for the log: the possessing team and the document, untouched."""
    team = F.from_json("payload", LOG_FIELDS)["possession_team"]["name"]
    return documents.select(
        "match_id",
        F.coalesce(team, F.lit(UNKNOWN_KEY)).alias("key"),
        F.col("payload").alias("value"),
    )


def publish(rows: DataFrame, fmt: str = "kafka", path: str | None = None, **options) -> None:
    """Writes log rows; the match id goes along as a message header for Kafka."""
    if fmt == "kafka":
        header = F.struct(
            F.lit("match_id").alias("key"),
            F.col("match_id").cast("string").cast("binary").alias("value"),
        )
        rows = rows.select("key", "value", F.array(header).alias("headers"))
    rows.write.format(fmt).options(**options).mode("append").save(path)
