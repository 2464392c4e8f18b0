"""The match-event log: a Kafka topic, or files with the same columns."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlive.schemas import LOG

UNKNOWN_KEY = "unknown"


def read_log_stream(
    spark: SparkSession, fmt: str = "kafka", path: str | None = None, **options
) -> DataFrame:
    """The log as a stream, from its beginning unless the options say otherwise.

    Files need the ``LOG`` schema. Bound a batch with ``maxOffsetsPerTrigger``
    (Kafka) or ``maxFilesPerTrigger`` (files).
    """
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        options = {"startingOffsets": "earliest", "includeHeaders": "true", **options}
    else:
        reader = reader.schema(LOG)
    return reader.options(**options).load(path)


def match_id_in_header(name: str = "match_id") -> Column:
    """The match id sent as text in a Kafka message header."""
    header = F.filter("headers", lambda h: h["key"] == name)
    return F.try_element_at(header, F.lit(1))["value"].cast("string").try_cast("bigint")


def match_id_in_topic(pattern: str = r"(\d+)$") -> Column:
    """The match id as part of the topic name."""
    return F.regexp_extract("topic", pattern, 1).try_cast("bigint")


def bronze_rows(log: DataFrame, match_id: Column | None = None) -> DataFrame:
    """The log envelope with key and value as text, the payload unparsed."""
    match_id = F.col("match_id") if match_id is None else match_id
    return log.select(
        match_id.cast("bigint").alias("match_id"),
        F.col("key").cast("string").alias("kafka_key"),
        F.col("value").cast("string").alias("event_json"),
        "topic",
        "partition",
        "offset",
        F.col("timestamp").alias("kafka_timestamp"),
    )
