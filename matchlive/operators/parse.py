"""From log rows to typed, de-duplicated event rows."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from matchlive.functions import match_second
from matchlive.functions.rules import PASS
from matchlive.schemas import EVENT, EVENT_DETAILS, SILVER, SILVER_DETAILS, columns

LAST_PERIOD_OF_PLAY = 4
EVENT_KEY = ("match_id", "event_id")
ARRIVAL = ("event_time", "partition", "offset")


# The fields of the event document that a column of Silver is made of, where that is not its name.
FIELDS = {
    "event_id": ("id",),
    "event_index": ("index",),
    "match_second": ("minute", "second"),
    "event_type": ("type",),
    "team_id": ("team",),
    "team_name": ("team",),
    "player_id": ("player",),
    "player_name": ("player",),
    "loc_x": ("location",),
    "loc_y": ("location",),
    "xg": ("shot",),
    "shot_outcome": ("shot",),
    "is_pass": ("type", "pass"),
    "pass_outcome": ("pass",),
    "is_key_pass": ("pass",),
}


def silver_columns(wanted: Sequence[str] | None) -> list[str]:
    """Silver's columns without it, otherwise those of Silver and its details that are wanted."""
    if wanted is None:
        return columns(SILVER)
    return [name for name in (*columns(SILVER), *columns(SILVER_DETAILS)) if name in wanted]


def parse_documents(
    bronze: DataFrame,
    event_time: str = "kafka_timestamp",
    carry: Sequence[str] = (),
    wanted: Sequence[str] | None = None,
) -> DataFrame:
    """Flat typed columns of every row; all null where the text is not a JSON object.

    Only the fields for the ``wanted`` columns are read, all of Silver's without
    it; those of ``SILVER_DETAILS`` have to be asked for. ``inline`` keeps the optimizer from pushing later filters below the
    parse, which would parse a row once more for each field they name; it also
    hides from it which fields are used. NaN is no xG.
    """
    wanted = silver_columns(wanted)
    read = {field for name in wanted for field in FIELDS.get(name, (name,))}
    fields = [*StructType.fromDDL(EVENT), *StructType.fromDDL(EVENT_DETAILS)]
    schema = StructType([field for field in fields if field.name in read])
    document = F.inline(F.array(F.from_json("event_json", schema)))
    parsed = bronze.select("match_id", F.col(event_time).alias("event_time"), *carry, document)
    flat = {
        "event_id": F.col("id"),
        "event_index": F.col("index"),
        "match_second": match_second(F.col("minute"), F.col("second")),
        "event_type": F.col("type.name"),
        "team_id": F.col("team.id"),
        "team_name": F.col("team.name"),
        "player_id": F.col("player.id"),
        "player_name": F.col("player.name"),
        "loc_x": F.try_element_at("location", F.lit(1)),
        "loc_y": F.try_element_at("location", F.lit(2)),
        "xg": F.coalesce(F.nullif(F.col("shot.statsbomb_xg"), F.lit(float("nan"))), F.lit(0.0)),
        "shot_outcome": F.col("shot.outcome.name"),
        "is_pass": F.coalesce((F.col("type.name") == PASS) & F.col("pass").isNotNull(), F.lit(False)),
        "pass_outcome": F.col("pass.outcome.name"),
        "is_key_pass": F.coalesce(F.col("pass.shot_assist"), F.lit(False)),
    }
    return parsed.select(*(flat.get(name, F.col(name)).alias(name) for name in wanted), *carry)


def parse_events(
    bronze: DataFrame,
    event_time: str = "kafka_timestamp",
    carry: Sequence[str] = (),
    wanted: Sequence[str] | None = None,
) -> DataFrame:
    """Events of play: rows with an id, without the penalty shoot-out.

    A row whose period is missing is dropped too.
    """
    read = None if wanted is None else {*wanted, *EVENT_KEY, "period"}
    parsed = parse_documents(bronze, event_time, carry, read)
    return parsed.filter(
        F.col("event_id").isNotNull() & (F.col("period") <= LAST_PERIOD_OF_PLAY)
    )


def first_arrivals(events: DataFrame) -> DataFrame:
    """One row per event: the copy that arrived first.

    ``row_number() <= 1`` plans a group limit below the shuffle, so each task
    sends at most one copy of an event however often it was repeated.
    """
    arrival = Window.partitionBy(*EVENT_KEY).orderBy(*ARRIVAL)
    return events.withColumn("_copy", F.row_number().over(arrival)).filter("_copy <= 1").drop("_copy")


def silver_events(bronze: DataFrame, wanted: Sequence[str] | None = None) -> DataFrame:
    """The Silver table of a batch of Bronze rows, or some columns of it."""
    read = None if wanted is None else {*wanted, "event_time"}
    events = parse_events(bronze, carry=("partition", "offset"), wanted=read)
    return first_arrivals(events).select(*silver_columns(wanted))


def repeated_events(bronze: DataFrame) -> DataFrame:
    """Events of play that were logged more than once, with the time of the copy kept."""
    return (
        parse_events(bronze, wanted=("event_time",))
        .groupBy(*EVENT_KEY)
        .agg(F.count(F.lit(1)).alias("copies"), F.min("event_time").alias("kept_time"))
        .filter(F.col("copies") > 1)
    )


def malformed_rows(bronze: DataFrame) -> DataFrame:
    """Log rows from which no event id can be read."""
    event_id = F.from_json("event_json", "id STRING")["id"]
    return bronze.filter(event_id.isNull()).select(
        "match_id", "topic", "partition", "offset", "event_json"
    )


def excluded_shootouts(bronze: DataFrame) -> DataFrame:
    """Distinct events and shots per match that lie after the last period of play."""
    wanted = (*EVENT_KEY, "period", "event_type")
    late = parse_documents(bronze, wanted=wanted).filter(
        F.col("event_id").isNotNull() & (F.col("period") > LAST_PERIOD_OF_PLAY)
    )
    once = late.groupBy(*EVENT_KEY).agg(
        F.max((F.col("event_type") == "Shot").cast("int")).alias("shot")
    )
    return once.groupBy("match_id").agg(
        F.count(F.lit(1)).alias("events"),
        F.coalesce(F.sum("shot"), F.lit(0)).cast("bigint").alias("shots"),
    )
