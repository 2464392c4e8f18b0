"""Mutable keyed tables as a log of changed rows, one partition per micro-batch.

A batch that is run again replaces its own partition, so a retry changes
nothing. The rows hold totals, not increments.
"""

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlive.operators.upsert import VERSION, latest_by_key
from matchlive.sources.tables import read_table

ROWS_PER_FILE = 1_000_000


def write_changes(
    rows: DataFrame, batch_id: int, path: str, rows_per_file: int = ROWS_PER_FILE
) -> None:
    """Stores the rows as the changes of one batch, replacing an earlier attempt.

    Adaptive execution is off in streaming, so the rows are kept and counted
    first: a small batch becomes one file, a large one is written by all tasks.
    An empty batch is skipped.
    """
    rows.persist()
    try:
        files = math.ceil(rows.count() / rows_per_file)
        if files > 0:
            target = f"{path}/{VERSION}={batch_id}"
            rows.coalesce(files).write.mode("overwrite").parquet(target)
    finally:
        rows.unpersist()


def refuse_older(spark: SparkSession, batch_id: int, path: str) -> None:
    """Fails if the table has changes of a later batch than the one a job is about to write.

    That is so when a job starts with a new checkpoint over an old path: its
    changes would be numbered below the old ones and never be seen.
    """
    newest = version(spark, path, f"{VERSION} BIGINT")
    if newest is not None and newest > batch_id:
        raise ValueError(
            f"{path} has changes up to batch {newest}, the checkpoint goes on with {batch_id}: "
            "use the checkpoint that belongs to the path, or a new path"
        )


def read_changes(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return read_table(spark, path, schema if VERSION in schema else f"{schema}, {VERSION} BIGINT")


def current(spark: SparkSession, path: str, schema: str, keys: Sequence[str]) -> DataFrame:
    """The table's rows now."""
    return latest_by_key(read_changes(spark, path, schema), keys)


def version(spark: SparkSession, path: str, schema: str) -> int | None:
    """Number of the newest batch with changes, None for an empty table."""
    return read_changes(spark, path, schema).agg(F.max(VERSION)).first()[0]


def compact(
    spark: SparkSession,
    path: str,
    target: str,
    schema: str,
    keys: Sequence[str],
) -> None:
    """Writes the current rows to a new path as one batch of the same version.

    For a stopped job, which then goes on with the new path and its old
    checkpoint: its next batches have higher numbers.
    """
    newest = version(spark, path, schema)
    if newest is None:
        return
    write_changes(current(spark, path, schema, keys), newest, target)
