"""Small state of a job per match, kept in tables by match bucket.

A batch reads the buckets that its matches lie in, as the batches before left
them, and writes them anew under its own number. A batch that runs again starts
from the same state and replaces what it wrote. Versions that no batch can start
from any more are deleted, so that what a batch lists does not grow with time.
"""

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from matchlive.operators.upsert import VERSION

BUCKET = "match_bucket"
BUCKETS = 16


def bucket_of(match_id: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(match_id), F.lit(buckets)).cast("int")


def bucket_number(spark: SparkSession, match_id: int | None, buckets: int = BUCKETS) -> int:
    value = F.lit(match_id).cast("bigint")
    return spark.range(1).select(bucket_of(value, buckets)).first()[0]


def _folder(spark: SparkSession, path: str):
    """Hadoop's file system and path, for any store that Spark writes to."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def _numbers(spark: SparkSession, path: str, name: str) -> list[int]:
    """The values of the partition folders ``name=value`` of a path, sorted."""
    store, folder = _folder(spark, path)
    if not store.exists(folder):
        return []
    found = (status.getPath().getName() for status in store.listStatus(folder))
    return sorted(int(one.split("=")[1]) for one in found if one.startswith(f"{name}="))


def _versions(spark: SparkSession, path: str, bucket: int) -> list[int]:
    return _numbers(spark, f"{path}/{BUCKET}={bucket}", VERSION)


def _read(spark: SparkSession, path: str, schema: str, newest: dict[int, int]) -> DataFrame:
    names = StructType.fromDDL(schema).names
    folders = [f"{path}/{BUCKET}={bucket}/{VERSION}={version}" for bucket, version in sorted(newest.items())]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*folders).select(*names)


def exists(spark: SparkSession, path: str) -> bool:
    return bool(_numbers(spark, path, BUCKET))


def version(spark: SparkSession, path: str) -> int | None:
    """Number of the newest batch that changed the state, None before the first."""
    return max((_versions(spark, path, number)[-1] for number in _numbers(spark, path, BUCKET)), default=None)


def current(
    spark: SparkSession, path: str, schema: str, match_id: int | None = None, buckets: int = BUCKETS
) -> DataFrame:
    """The state now; of one match only its bucket is listed and read."""
    known = _numbers(spark, path, BUCKET)
    if match_id is not None:
        known = [number for number in known if number == bucket_number(spark, match_id, buckets)]
    rows = _read(spark, path, schema, {number: _versions(spark, path, number)[-1] for number in known})
    return rows if match_id is None else rows.filter(F.col("match_id") == match_id)


def refuse_older(spark: SparkSession, batch_id: int, path: str) -> None:
    """Fails if the state is of a later batch than the one a job is about to run."""
    newest = version(spark, path)
    if newest is not None and newest > batch_id:
        raise ValueError(
            f"{path} is the state after batch {newest}, the checkpoint goes on with {batch_id}: "
            "use the checkpoint that belongs to the path, or a new path"
        )


def fold(
    added: DataFrame,
    batch_id: int,
    path: str,
    schema: str,
    merge: Callable[[DataFrame], DataFrame],
    buckets: int = BUCKETS,
) -> DataFrame | None:
    """Merges a batch's rows into the state; the state of the matches in its buckets, None for an empty batch.

    ``merge`` gets the old rows together with the new ones and has to give few
    rows for each match: a bucket is written by one task.
    """
    spark = added.sparkSession
    names = StructType.fromDDL(schema).names
    added = added.select(*names).persist()
    try:
        number = bucket_of(F.col("match_id"), buckets)
        touched = [row[0] for row in added.select(number).distinct().collect()]  # ``buckets`` at most
        if not touched:
            return None
        before = {one: [v for v in _versions(spark, path, one) if v < batch_id] for one in touched}
        newest = {one: versions[-1] for one, versions in before.items() if versions}
        merged = merge(_read(spark, path, schema, newest).unionByName(added))
        (
            merged.withColumns({BUCKET: number, VERSION: F.lit(batch_id)})
            .repartition(len(touched), BUCKET)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(BUCKET, VERSION)
            .parquet(path)
        )
    finally:
        added.unpersist()
    _forget(spark, path, before)
    return _read(spark, path, schema, dict.fromkeys(touched, batch_id))


def _forget(spark: SparkSession, path: str, before: dict[int, Sequence[int]]) -> None:
    """Deletes the versions before the one that this batch started from."""
    for number, versions in before.items():
        for old in versions[:-1]:
            store, folder = _folder(spark, f"{path}/{BUCKET}={number}/{VERSION}={old}")
            store.delete(folder, True)
